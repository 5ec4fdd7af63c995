"""A shipment's life cycle, replayed from its scans in arrival order.

The first scan fixes the destination, every scan moves the last location, a
scan at the destination delivers.  Delivered shipments stay delivered, and a
further scan at the destination delivers again.  Where an online service would
stamp "now", the scan's own time is used, so that replays agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill import schemas as S
from waybill.functions import text
from waybill.operators.skew import FIRST, HotKeys, Running, with_running


def usable_scans(scans: DataFrame) -> DataFrame:
    """Scans with a shipment id."""
    return scans.filter(~text.is_blank("shipment_id"))


def at_destination(location="location", destination="destination") -> Column:
    """Same place regardless of case, both given; not trimmed."""
    return F.coalesce(
        ~text.is_blank(location)
        & ~text.is_blank(destination)
        & (text.folded(location) == text.folded(destination)),
        F.lit(False),
    )


def replay(
    scans: DataFrame,
    order: list[str],
    chunk: list[Column],
    keys: DataFrame | None = None,
    hot: HotKeys | None = None,
    before: DataFrame | None = None,
) -> DataFrame:
    """Every scan with the shipment's state right after it.

    ``order`` is the total order of arrival within a shipment and ``chunk`` how
    to cut an overfull shipment (see skew.with_running).  Adds ``seq``, ``created_at``,
    ``delivered`` (this scan delivers), ``delivered_at`` and ``status``;
    ``destination`` is the shipment's, ``scan_destination`` the event's own.

    ``before`` is the state (see ``shipment_state``) that earlier scans left; the replay
    goes on from there.
    """
    delivers = at_destination(F.col("location"), F.col(f"{FIRST}.destination"))
    rows = with_running(
        usable_scans(scans), "shipment_id", order, chunk,
        [
            Running("seq", "count"),
            Running("was_delivered", "max", delivers),
            # wrapped: a delivering scan without a time still sets the field
            Running("delivery", "last", F.when(delivers, F.struct("scanned_at"))),
        ],
        first=F.struct("destination", "scanned_at"),
        hot=hot,
        keys=keys,
        carry=None if before is None else _carried(before),
    )
    return rows.select(
        *[c for c in scans.columns if c != "destination"],
        F.col("destination").alias("scan_destination"),
        F.col(f"{FIRST}.destination").alias("destination"),
        "seq",
        F.col(f"{FIRST}.scanned_at").alias("created_at"),
        delivers.alias("delivered"),
        F.col("delivery.scanned_at").alias("delivered_at"),
        F.when(F.col("was_delivered"), S.DELIVERED).otherwise(S.IN_TRANSIT).alias("status"),
    )


def _carried(state: DataFrame) -> DataFrame:
    """A state in terms of the replay's running values."""
    delivered = F.col("status") == S.DELIVERED
    return state.select(
        "shipment_id",
        F.struct("destination", F.col("created_at").alias("scanned_at")).alias(FIRST),
        "seq",
        delivered.alias("was_delivered"),
        F.when(delivered, F.struct(F.col("delivered_at").alias("scanned_at"))).alias("delivery"),
    )


def lifecycle(replayed: DataFrame) -> DataFrame:
    return replayed.select(
        "shipment_id", "seq", "status", F.col("location").alias("last_location"),
        "destination", "delivered", "delivered_at",
    )


def delivered_events(replayed: DataFrame, dedupe: bool = False) -> DataFrame:
    """One event per delivering scan; with ``dedupe`` only a shipment's first."""
    events = replayed.filter("delivered").select(
        "shipment_id", "destination", "location",
        F.col("scanned_at").alias("delivered_at"), "correlation_id",
        *(["seq"] if dedupe else []),
    )
    if not dedupe:
        return events
    first = F.min(F.struct("seq", "destination", "location", "delivered_at", "correlation_id"))
    return (
        events.groupBy("shipment_id")
        .agg(first.alias("e"))
        .select("shipment_id", "e.destination", "e.location", "e.delivered_at", "e.correlation_id")
    )


def shipment_state(replayed: DataFrame, seq: bool = False) -> DataFrame:
    """Current state: what holds after a shipment's last scan; ``seq`` adds how many
    scans that took, which a later replay needs to go on."""
    last = F.max(
        F.struct("seq", "destination", "location", "created_at", "scanned_at", "delivered_at", "status")
    )
    return (
        replayed.groupBy("shipment_id")
        .agg(last.alias("s"))
        .select(
            "shipment_id", "s.destination", F.col("s.location").alias("last_location"),
            "s.created_at", F.col("s.scanned_at").alias("last_scanned_at"),
            "s.delivered_at", "s.status", *(["s.seq"] if seq else []),
        )
    )


def response(state: DataFrame) -> DataFrame:
    """State rows as answers to a query."""
    return state.select(
        "shipment_id", "status", F.col("last_location").alias("location"), "delivered_at",
        F.lit(True).alias("success"), F.lit(None).cast("string").alias("error_message"),
    )


def shipment_by_id(state: DataFrame, shipment_id: str | None, strict: bool = True) -> DataFrame:
    """Rows of one shipment, by the id exactly as given.

    ``strict`` rejects a missing id; without it a missing id finds nothing.
    """
    if shipment_id is None or not shipment_id.strip():
        if strict:
            raise ValueError("shipmentId must not be null or empty")
        if shipment_id is None:
            return state.limit(0)
    return state.filter(F.col("shipment_id") == shipment_id)


def status_lookup(requests: DataFrame, state: DataFrame) -> DataFrame:
    """Status by shipment id, ``Unknown`` where there is no such shipment."""
    return requests.join(state.select("shipment_id", "status"), "shipment_id", "left").select(
        "shipment_id", F.coalesce("status", F.lit("Unknown")).alias("status")
    )


def mark_delivered(requests: DataFrame, state: DataFrame) -> DataFrame:
    """Answer manual delivery requests.

    ``requests``: ``request_id``, ``requested_at`` and the struct ``request``
    (``shipment_id``, ``location``), null for an absent request.  Status is not
    tested: a delivered shipment can be delivered again.
    """
    asked = requests.select(
        "request_id", "requested_at",
        F.col("request").isNull().alias("absent"),
        F.col("request.shipment_id").alias("shipment_id"),
        F.col("request.location").alias("location"),
    )
    stored = state.select("shipment_id", "destination").withColumn("known", F.lit(True))
    refusal = text.first_failure(
        (F.col("absent"), "Request must not be null"),
        (text.is_blank("shipment_id"), "shipmentId must not be null or empty"),
        (text.is_blank("location"), "location must not be null or empty"),
    )
    checked = asked.withColumn("error_message", refusal)
    # what is refused needs no state, and its blank ids would meet in one task
    refused = checked.filter("error_message IS NOT NULL").withColumn("destination", F.lit(None).cast("string"))
    unknown = F.concat(F.lit("Shipment not found: "), F.col("shipment_id"))
    looked_up = checked.filter("error_message IS NULL").join(stored, "shipment_id", "left").withColumn(
        "error_message", F.when(F.col("known").isNull(), unknown)
    )
    done = F.col("error_message").isNull()
    return looked_up.select(*refused.columns).unionByName(refused).select(
        "request_id",
        F.when(done, F.col("shipment_id")).alias("shipment_id"),
        done.alias("success"),
        F.when(done, F.lit(S.DELIVERED)).alias("status"),
        F.when(done, F.col("location")).alias("location"),
        F.when(done, F.col("destination")).alias("destination"),
        F.when(done, F.col("requested_at")).alias("delivered_at"),
        "error_message",
    )


def manual_deliveries(marked: DataFrame) -> DataFrame:
    """Delivered events of the requests that succeeded."""
    return marked.filter("success").select(
        "shipment_id", "destination", "location", "delivered_at",
        F.col("request_id").alias("correlation_id"),
    )


def apply_deliveries(state: DataFrame, marked: DataFrame) -> DataFrame:
    """State after the requests: status, location and delivery time of the last one
    each; of requests at the same moment the one with the greater id."""
    last = F.max(F.struct("delivered_at", "request_id", "location"))
    changed = marked.filter("success").groupBy("shipment_id").agg(last.alias("d"))
    hit = F.col("d").isNotNull()
    return state.join(changed, "shipment_id", "left").select(
        "shipment_id", "destination",
        F.when(hit, F.col("d.location")).otherwise(F.col("last_location")).alias("last_location"),
        "created_at", "last_scanned_at",
        F.when(hit, F.col("d.delivered_at")).otherwise(F.col("delivered_at")).alias("delivered_at"),
        F.when(hit, F.lit(S.DELIVERED)).otherwise(F.col("status")).alias("status"),
    )
