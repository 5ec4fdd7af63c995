"""Scan requests checked against the shipments known when they arrive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill import schemas as S
from waybill.functions import text
from waybill.operators.skew import HotKeys, Running, with_running
from waybill.operators.validate import scan_error


def known_shipments(created: DataFrame, arrival: list[str] = ("created_at",)) -> DataFrame:
    """Latest created event per shipment; a repeated create starts the shipment afresh.

    Keys hardly repeat, so rows are placed by shipment first: a struct's maximum is
    aggregated over sorted rows, which then are sorted once.
    """
    last = F.max_by(F.struct("destination", "created_at"), F.struct(*arrival))
    return (
        created.repartition("shipment_id").groupBy("shipment_id")
        .agg(last.alias("c"))
        .select("shipment_id", "c.destination", "c.created_at", F.lit(S.CREATED).alias("status"))
    )


def _timeline(
    requests: DataFrame, created: DataFrame, order: list[str]
) -> tuple[DataFrame, list[str]]:
    """Creates and scan requests as one stream per shipment; at the same moment
    the create comes first."""
    creates = created.select(
        "shipment_id", F.col("created_at").alias("at"), F.lit(0).alias("kind"),
        F.struct("destination", "created_at").alias("create"),
    )
    asked = requests.withColumn("at", F.col("scanned_at")).withColumn("kind", F.lit(1))
    return asked.unionByName(creates, allowMissingColumns=True), ["at", "kind", *order]


def scan_results(
    requests: DataFrame,
    created: DataFrame,
    order: list[str],
    chunk: list[Column] | None = None,
    keys: DataFrame | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Answer every scan request.

    ``requests`` has ``shipment_id, location, scanned_at`` and the columns of
    ``order``, which rank requests of one shipment at the same moment;
    ``created`` has ``shipment_id, destination, created_at``.  A shipment is
    known from its create on, and the destination is that of its latest create
    before the scan.  Adds ``success``, ``error_message`` and ``destination``.
    """
    # Requests that are wrong in themselves need no history, nor do blank ids unless
    # a create has one; both would be keys with very many rows.
    wrong = scan_error().isNotNull()
    blank = text.is_blank("shipment_id")
    nameless = blank if created.filter(blank).isEmpty() else F.lit(False)
    named = requests.filter(~wrong & ~nameless)
    both, full_order = _timeline(named, created.filter(~nameless), order)
    answered = with_running(
        both, "shipment_id", full_order, chunk or [F.col("at")],
        [Running("known", "last", F.col("create"))], hot=hot,
        keys=None if keys is None else keys.filter(~nameless),
    ).filter("kind = 1")
    found = answered.select(*requests.columns, F.col("known.destination").alias("destination"), "known")
    others = requests.filter(wrong | nameless).withColumn("destination", F.lit(None).cast("string"))
    not_found = F.concat(F.lit("Shipment with ID "), F.col("shipment_id"), F.lit(" not found."))
    error = F.coalesce(scan_error(), F.when(F.col("known").isNull(), not_found))
    return found.unionByName(others, allowMissingColumns=True).select(
        *requests.columns,
        "destination",
        error.isNull().alias("success"),
        error.alias("error_message"),
        scan_error().isNotNull().alias("invalid"),
    )


def scan_answers(results: DataFrame) -> DataFrame:
    return results.select("request_id", "shipment_id", "location", "success", "error_message")


def scan_accepted(results: DataFrame) -> DataFrame:
    """Scanned events of the accepted requests, with the stored destination."""
    return results.filter("success").select(
        "shipment_id", "location", "scanned_at", "destination", F.col("request_id").alias("correlation_id")
    )


def scan_rejected(results: DataFrame) -> DataFrame:
    """Well-formed requests for shipments that are not known."""
    return results.filter("not success and not invalid").select(
        "request_id", "shipment_id", "location", "error_message"
    )


def early_requests(requests: DataFrame, created: DataFrame) -> DataFrame:
    """What ``scan_rejected`` gives, from the requests and creates themselves: those that
    come before a shipment's first create.  A minimum per shipment and one join, no replay."""
    blank = text.is_blank("shipment_id")
    nameless = blank if created.filter(blank).isEmpty() else F.lit(False)
    fine = requests.filter(scan_error().isNull()).select("request_id", "shipment_id", "location", "scanned_at")
    # a struct, as a create without a time comes first of all
    first = created.filter(~nameless).groupBy("shipment_id").agg(F.min(F.struct("created_at")).alias("first"))
    since = F.col("first.created_at")
    known = F.col("first").isNotNull() & (since.isNull() | F.coalesce(F.col("scanned_at") >= since, F.lit(False)))
    early = fine.filter(~nameless).join(first, "shipment_id", "left").filter(~known)
    return early.select(*fine.columns).unionByName(fine.filter(nameless)).select(
        "request_id", "shipment_id", "location",
        F.concat(F.lit("Shipment with ID "), F.col("shipment_id"), F.lit(" not found.")).alias("error_message"),
    )


def scan_state(requests: DataFrame, created: DataFrame, order: list[str]) -> DataFrame:
    """The scanning side's view: in transit after any accepted scan, never delivered.

    Every request after a shipment's latest create is accepted, and the create
    resets the row, so the last of each kind decides.
    """
    both, full_order = _timeline(requests.filter(scan_error().isNull()), created, order)
    position = F.struct(*full_order)
    scan = F.col("kind") == 1
    latest = both.repartition("shipment_id").groupBy("shipment_id").agg(
        F.max(F.when(~scan, F.struct(position.alias("p"), "create"))).alias("c"),
        F.max(F.when(scan, F.struct(position.alias("p"), "location", "scanned_at"))).alias("s"),
    )
    moved = F.col("s.p") > F.col("c.p")
    return latest.filter(F.col("c").isNotNull()).select(
        "shipment_id",
        F.col("c.create.destination").alias("destination"),
        F.when(moved, F.col("s.location")).alias("last_location"),
        F.when(moved, F.col("s.scanned_at")).alias("last_scanned_at"),
        F.when(moved, S.IN_TRANSIT).otherwise(S.CREATED).alias("status"),
    )


def scan_known_check(lookups: DataFrame, known: DataFrame) -> DataFrame:
    """Whether an id has the right shape and, if so, whether it is known."""
    present = known.select("shipment_id").withColumn("found", F.lit(True))
    shaped = text.has_id_shape("shipment_id")
    return lookups.join(present, "shipment_id", "left").select(
        "shipment_id",
        shaped.alias("valid_id"),
        (shaped & F.coalesce("found", F.lit(False))).alias("known"),
    )
