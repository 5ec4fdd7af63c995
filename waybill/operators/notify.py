"""Notifications: one per event, and the queries on them.

A notification has the columns ``id, shipment_id, type, message, timestamp``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill import schemas as S
from waybill.functions import messages, text
from waybill.operators.events import by_type
from waybill.operators.skew import sized_broadcast
from waybill.operators.validate import notification_error

LATEST = 10
NO_SHIPMENT = "Notification shipmentId must not be null or empty"


def refused() -> Column:
    """Whether a parsed record (see sources.decode) is an event that makes no notification."""
    kinds = (S.CREATED_EVENT, S.SCANNED_EVENT, S.DELIVERED_EVENT)
    return F.col("value").isNotNull() & F.col("event_type").isin(*kinds) & text.is_empty(F.col("e.shipmentId"))


def usable(events: DataFrame) -> DataFrame:
    """What notifications are made of: events (see operators.events) with a shipment id."""
    return events.filter(~text.is_empty("shipment_id")).select(
        "event_type", "shipment_id", "destination", "location", F.col("event_at").alias("timestamp"), "record_id"
    )


def identified(rows: DataFrame, *also: str) -> DataFrame:
    """Usable events under their notification's id; ``also`` names columns to keep."""
    return rows.select(
        F.sha2("record_id", 256).alias("id"),
        "event_type", "shipment_id", "destination", "location", "timestamp", *also,
    )


def worded(rows: DataFrame, *also: str) -> DataFrame:
    """Notifications of identified events.  Their texts are longer than what they are
    made of: whatever moves the rows is better done before."""
    return rows.select(
        "id",
        "shipment_id",
        by_type(*[F.lit(t) for t in S.NOTIFICATION_TYPES]).alias("type"),
        by_type(
            messages.created_message(), messages.scanned_message(), messages.delivered_message()
        ).alias("message"),
        "timestamp",
        *also,
    )


def notifications(events: DataFrame) -> DataFrame:
    """One notification per event with a shipment id."""
    return worded(identified(usable(events)))


def notification_by_id(notes: DataFrame, id_: str | None) -> DataFrame:
    """The id is trimmed; a missing one finds nothing."""
    wanted = (id_ or "").strip()
    return notes.filter(F.col("id") == wanted) if wanted else notes.limit(0)


def notifications_for_shipment(notes: DataFrame, shipment_id: str | None) -> DataFrame:
    wanted = (shipment_id or "").strip()
    return notes.filter(F.col("shipment_id") == wanted) if wanted else notes.limit(0)


def notification_count(notes: DataFrame) -> DataFrame:
    return notes.agg(F.count(F.lit(1)).alias("count"))


def notifications_by_type(notes: DataFrame) -> DataFrame:
    """Count per type, zero included."""
    spark = notes.sparkSession
    types = spark.createDataFrame([(t,) for t in S.NOTIFICATION_TYPES], "type string")
    counted = notes.groupBy("type").agg(F.count(F.lit(1)).alias("n"))
    # three rows at most on either side after the aggregate
    return types.join(F.broadcast(counted.filter(F.col("type").isin(*S.NOTIFICATION_TYPES))), "type", "left").select(
        "type", F.coalesce("n", F.lit(0)).cast("bigint").alias("count")
    )


def notifications_by_shipment(notes: DataFrame, top_n: int | None = None) -> DataFrame:
    """Count per shipment; all of them unless ``top_n`` is given."""
    counted = notes.groupBy("shipment_id").agg(F.count(F.lit(1)).alias("count"))
    if top_n is None:
        return counted
    return counted.orderBy(F.col("count").desc(), "shipment_id").limit(top_n)


def recent_notifications(notes: DataFrame, limit: int = LATEST) -> DataFrame:
    """The latest by time, ties by id."""
    return notes.orderBy(F.col("timestamp").desc(), "id").limit(limit)


def notification_preview(notes: DataFrame) -> DataFrame:
    return notes.select("id", text.preview("message").alias("preview"))


def notification_type_parse(raw: DataFrame, column: str = "raw_type") -> DataFrame:
    """A type's name from text; anything else means created.  Once ignoring case, once not."""
    default = S.NOTIFICATION_TYPES[0]
    return raw.select(
        "*",
        text.one_of(column, S.NOTIFICATION_TYPES, default, ignore_case=True).alias("any_case"),
        text.one_of(column, S.NOTIFICATION_TYPES, default).alias("exact_case"),
    )


def notification_validation(notes: DataFrame, absent=None) -> DataFrame:
    return notes.select("id", notification_error(absent=absent).alias("error_message"))


# First byte of a packed id, and the ids that are digits of a hash.
_HASH, _OTHER = "00", "01"
_HASH_SHAPE = r"\A[0-9a-f]{64}\z"


def _packed(id_: Column) -> Column:
    """An id as bytes, half as many where it is a hash in hexadecimal digits, as the ids
    of notifications are; different ids stay different."""
    return F.when(id_.rlike(_HASH_SHAPE), F.unhex(F.concat(F.lit(_HASH), id_))).otherwise(
        F.concat(F.unhex(F.lit(_OTHER)), id_.cast("binary"))
    )


def _unpacked(key: Column) -> Column:
    rest = F.substring(key, 2, 2_147_483_647)
    is_hash = F.substring(key, 1, 1) == F.unhex(F.lit(_HASH))
    return F.when(is_hash, F.lower(F.hex(rest))).otherwise(rest.cast("string"))


def _ids(deletions: DataFrame) -> DataFrame:
    """Trimmed ids to delete, each once, packed as ``wanted``."""
    trimmed = deletions.select(text.trimmed("id").alias("id")).filter("id <> ''")
    return trimmed.select(_packed(F.col("id")).alias("wanted")).distinct()


def delete_notifications(notes: DataFrame, deletions: DataFrame) -> DataFrame:
    """Notifications, or what they are made of, whose id is not among the (trimmed) ids
    to delete."""
    others = [c for c in notes.columns if c != "id"]
    kept = notes.select(_packed(F.col("id")).alias("wanted"), *others).join(_ids(deletions), "wanted", "left_anti")
    return kept.select(_unpacked(F.col("wanted")).alias("id"), *others)


def deletion_results(notes: DataFrame, deletions: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Answer to each deletion by id, in the order of the columns ``order``: a blank
    or absent id is an error, and so is an id that an earlier request deleted.

    Only the ids asked for are looked up, so the notifications are filtered by a
    list that is written, and broadcast if it is short, rather than shuffled.  Which of several requests for
    one id is first is settled by a minimum per id; requests without an id take no part.
    """
    order = order or ["request_id"]
    asked = deletions.withColumn("wanted", _packed(text.trimmed("id")))
    blank = text.is_empty("id")
    named = asked.filter(~blank)
    first = sized_broadcast(named.groupBy("wanted").agg(F.min(F.struct(*order)).alias("first")))
    present = (
        notes.select(_packed(F.col("id")).alias("wanted"))
        .join(first, "wanted", "left_semi").distinct().withColumn("found", F.lit(True))
    )
    known = first.join(present, "wanted", "left")
    absent = F.concat(F.lit("Notification not found with ID: "), F.col("id"))
    succeeds = F.col("found").isNotNull() & (F.struct(*order) == F.col("first"))
    answered = named.join(known, "wanted").select(
        *order, "id", F.when(~succeeds, absent).alias("error_message")
    )
    refused = asked.filter(blank).select(
        *order, "id", F.lit("Notification ID must not be null or empty").alias("error_message")
    )
    return answered.unionByName(refused).select(
        *order, "id", F.col("error_message").isNull().alias("success"), "error_message"
    )


def deletion_counts(notes: DataFrame, deletions: DataFrame | None = None) -> DataFrame:
    """How many go and how many stay; without ``deletions`` all go."""
    if deletions is None:
        marked = notes.select(F.lit(1).alias("gone"))
    else:
        ids = _ids(deletions).withColumn("gone", F.lit(1))
        marked = notes.select(_packed(F.col("id")).alias("wanted")).join(ids, "wanted", "left")
    return marked.agg(
        F.count(F.col("gone")).alias("deleted_count"),
        F.count_if(F.col("gone").isNull()).alias("remaining_count"),
    )
