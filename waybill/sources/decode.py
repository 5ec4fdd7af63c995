"""Event JSON to typed columns, and the records that cannot be decoded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill import schemas as S
from waybill.functions import times

_CORRUPT = "_corrupt"
UNKNOWN_TYPE = "Object"

# All events' fields in one schema, so that a value is parsed once.
_ANY_EVENT = T.StructType(
    list({f.name: f for schema in S.WIRE.values() for f in schema.fields}.values())
    + [T.StructField(_CORRUPT, T.StringType())]
)

_KNOWN_TYPES = tuple(S.WIRE)
_DATE_FIELDS = {
    S.CREATED_EVENT: "createdAt",
    S.SCANNED_EVENT: "scannedAt",
    S.DELIVERED_EVENT: "deliveredAt",
}


def _event_type() -> Column:
    """The producer's class header (full or short name), else the type in the
    value, else the topic's own; a foreign class is no event."""
    named = F.coalesce(F.substring_index("type_id", ".", -1), F.col("e.eventType"))
    by_topic = F.lit(None).cast("string")
    for topic, event in S.EVENT_OF_TOPIC.items():
        by_topic = F.when(F.col("topic") == topic, event).otherwise(by_topic)
    return (
        F.when(named.isin(*_KNOWN_TYPES), named)
        .when(named.isNull(), F.coalesce(by_topic, F.lit(UNKNOWN_TYPE)))
        .otherwise(UNKNOWN_TYPE)
    )


def _field(name: str) -> Column:
    """A field, where the record's type has it."""
    owners = [event for event, schema in S.WIRE.items() if name in schema.fieldNames()]
    return F.when(F.col("event_type").isin(*owners), F.col(f"e.{name}"))


def _moment(name: str) -> Column:
    """The event's own time, where it is called ``name``."""
    owners = [event for event, field in _DATE_FIELDS.items() if field == name]
    return F.when(F.col("event_type").isin(*owners), F.col("event_at"))


def record_id(records: DataFrame) -> Column:
    """What names a record: its topic, partition and offset; for a line of a file,
    the file and the line's place in it, so that identical lines are records of their
    own.  Places hold for one way of splitting files: those above
    ``spark.sql.files.openCostInBytes`` may be cut elsewhere under other settings.
    Where neither is known, a hash of the value stands in."""
    placed = F.col("partition").isNotNull() & F.col("offset").isNotNull()

    def given(name: str) -> Column:
        return F.col(name) if name in records.columns else F.lit(None).cast("string")

    place = F.coalesce(given("source_line"), F.sha2(F.coalesce("value", F.lit("")), 256))
    return F.when(placed, F.concat_ws(":", "topic", "partition", "offset")).otherwise(
        F.concat_ws(":", "topic", F.coalesce(given("source_file"), F.lit("")), place)
    )


_WITH_OFFSET = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?[+-]\d{2}:?\d{2}$"


def envelope_time(text) -> Column:
    """The envelope's time in UTC: a date-time (with Z, an offset or neither), its
    array form, or seconds since 1970 with a fraction."""
    raw = F.trim(F.col(text))
    seconds = F.when(~raw.startswith("["), raw.try_cast("decimal(38,9)"))
    micros = F.floor(seconds * 1_000_000).cast("bigint")
    return F.coalesce(
        times.read_datetime(F.regexp_replace(raw, "Z$", "")),
        F.timestamp_add("MICROSECOND", micros, times.epoch()),
        times.from_instant(F.when(raw.rlike(_WITH_OFFSET), raw).try_cast("timestamp")),
    )


def parse(records: DataFrame, where: Column | str | None = None) -> DataFrame:
    """``where`` picks records by topic, partition, offset, timestamp or key; given
    here it reaches the scan, while filters on the result stay above the parser.

    Adds ``event_type``, the raw fields, the event's own time ``event_at`` and
    ``reason``, which says why a record cannot be used; an absent value is no
    event and no failure."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    chosen = records if where is None else records.filter(where)
    raw = chosen.withColumn("e", F.from_json("value", _ANY_EVENT, options)).withColumn(
        "record_id", record_id(records)
    )
    known = raw.withColumn("event_type", _event_type())
    date = F.lit(None).cast("string")
    for event, name in _DATE_FIELDS.items():
        date = F.when(F.col("event_type") == event, F.col(f"e.{name}")).otherwise(date)
    dated = known.withColumn("event_date", date).withColumn(
        "event_at", times.read_datetime("event_date")
    ).withColumn("envelope_at", envelope_time("e.timestamp"))
    malformed = F.col(f"e.{_CORRUPT}").isNotNull() | F.col("e").isNull()
    reason = (
        F.when(F.col("value").isNull(), F.lit(None))
        .when(malformed, "malformed JSON")
        .when(F.col("event_type") == UNKNOWN_TYPE, "unknown event type")
        .when(F.col("event_date").isNotNull() & F.col("event_at").isNull(), "unreadable date")
        .when(F.col("e.timestamp").isNotNull() & F.col("envelope_at").isNull(), "unreadable timestamp")
    )
    # ``_task`` holds filters on the outcome above this point: pushed further
    # down, they would repeat the parsing once per field they look at.
    return dated.withColumn("reason", reason).withColumn("_task", F.spark_partition_id())


def typed(parsed: DataFrame) -> DataFrame:
    """Usable records as typed events with their metadata; envelope defaults are
    the record's time and version v1."""
    usable = parsed.filter("reason IS NULL AND value IS NOT NULL AND _task >= 0")
    return usable.select(
        "topic",
        "partition",
        "offset",
        "event_type",
        _field("shipmentId").alias("shipment_id"),
        _field("destination").alias("destination"),
        _field("location").alias("location"),
        _moment("createdAt").alias("created_at"),
        _moment("scannedAt").alias("scanned_at"),
        _moment("deliveredAt").alias("delivered_at"),
        _field("notificationId").alias("notification_id"),
        _field("type").alias("type"),
        _field("message").alias("message"),
        F.col("e.correlationId").alias("correlation_id"),
        F.coalesce("envelope_at", "timestamp").alias("timestamp"),
        F.coalesce("e.version", F.lit(S.DEFAULT_VERSION)).alias("version"),
        F.col("timestamp").alias("record_timestamp"),
        "record_id",
        *(["source_file"] if "source_file" in parsed.columns else []),
    )


def decode(records: DataFrame, where: Column | str | None = None) -> DataFrame:
    return typed(parse(records, where))


# The outcomes of decoding, by the name of their count: event type and status.
OUTCOMES = {event: (event, "success") for event in S.WIRE} | {"error": ("error", "failure")}


def outcome_counts() -> list[Column]:
    """One count for each of OUTCOMES, over what ``parse`` gives; absent values don't count."""
    usable = F.col("reason").isNull() & F.col("value").isNotNull()
    return [
        F.count_if(F.col("reason").isNotNull() if status == "failure" else usable & (F.col("event_type") == event)).alias(name)
        for name, (event, status) in OUTCOMES.items()
    ]


def _of_type(events: DataFrame, event_type: str, *columns: str) -> DataFrame:
    return events.filter(F.col("event_type") == event_type).select(
        *columns, "correlation_id", "timestamp", "version"
    )


def created(events: DataFrame) -> DataFrame:
    return _of_type(events, S.CREATED_EVENT, "shipment_id", "destination", "created_at")


def scanned(events: DataFrame) -> DataFrame:
    return _of_type(events, S.SCANNED_EVENT, "shipment_id", "location", "scanned_at", "destination")


def delivered(events: DataFrame) -> DataFrame:
    return _of_type(
        events, S.DELIVERED_EVENT, "shipment_id", "destination", "location", "delivered_at", "record_timestamp"
    )


def dead_letters(parsed: DataFrame) -> DataFrame:
    """Unusable records with the topic they go to; the partition stays."""
    return parsed.filter("reason IS NOT NULL AND _task >= 0").select(
        "topic",
        F.concat("topic", F.lit(S.DEAD_LETTER_SUFFIX)).alias("dead_letter_topic"),
        "partition",
        "offset",
        "key",
        "value",
        "reason",
    )
