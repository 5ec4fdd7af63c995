"""Notifications and the scan gate as streams, and the chain from scans to counts.

Every batch goes to its own folder, which a retry replaces, so tables built here hold
each record's effect once.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle

from waybill import schemas as S
from waybill.functions import times
from waybill.operators import counts, events, lifecycle, notify
from waybill.operators.validate import scan_error
from waybill.sources import decode
from waybill.streaming import lifecycle as stream_lifecycle
from waybill.streaming import sinks

NOTIFICATION = S.struct(
    "id string, shipment_id string, type string, message string, timestamp timestamp_ntz"
)
ANSWER = S.struct(
    "request_id string, shipment_id string, location string, scanned_at timestamp_ntz, destination string, "
    "success string, error_message string"
)
CREATE = S.struct("destination string, created_at timestamp_ntz")


def notification_stream(records: DataFrame) -> DataFrame:
    """One notification for each created, scanned and delivered record of a stream of
    topic records (or of a table of them); no state is kept."""
    return notify.notifications(events.decoded_events(decode.decode(records)))


REDELIVERY = "1 day"


def once(records: DataFrame, within: str = REDELIVERY) -> DataFrame:
    """Records of a stream without those delivered again ``within`` that time of the
    records' clock: the state is one id per record, and goes after that time."""
    instant = times.to_instant(F.col("timestamp"))
    named = records.withColumn("record_id", decode.record_id(records)).withColumn("_at", instant)
    return named.withWatermark("_at", within).dropDuplicatesWithinWatermark(["record_id"]).drop("_at", "record_id")


def notifications_writer(
    records: DataFrame, path: str, dead_letters_path: str, within: str = REDELIVERY
) -> DataStreamWriter:
    """Notifications to one table, records that can't be used to another, each record once.

    An event without a shipment id can't become a notification and is a dead letter
    too, with its own reason.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        parsed = decode.parse(batch).persist()
        try:
            made = events.decoded_events(decode.typed(parsed))
            sinks.write_batch(notify.notifications(made), path, batch_id)
            unusable = decode.dead_letters(parsed)
            refused = decode.dead_letters(
                parsed.withColumn("reason", F.when(F.col("reason").isNull() & notify.refused(), F.lit(notify.NO_SHIPMENT)))
            )
            sinks.write_batch(unusable.unionByName(refused), dead_letters_path, batch_id)
        finally:
            parsed.unpersist()

    return once(records, within).writeStream.foreachBatch(write)


def read_notifications(spark: SparkSession, path: str) -> DataFrame:
    """All notifications, as written: the stream has dropped what was delivered again."""
    return sinks.read_batches(spark, path, NOTIFICATION).select(*NOTIFICATION.names)


class GateProcessor(StatefulProcessor):
    """Keeps a shipment's latest create and answers the requests that come after it."""

    def __init__(self, order: list[str]):
        self.order = order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.create = handle.getValueState("create", CREATE)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        # at the same moment the create comes first; nulls before all else, as Spark sorts
        def arrival(row: Row):
            values = [row["at"], row["kind"] == "scan", *(row[c] for c in self.order)]
            return [(v is not None, v) if v is not None else (False,) for v in values]

        known = self.create.get() if self.create.exists() else None
        created = None
        for row in sorted(rows, key=arrival):
            if row["kind"] == "create":
                if known is None or known[1] is None or (row["at"] is not None and row["at"] >= known[1]):
                    known = created = (row["destination"], row["at"])
                continue
            seen = known is not None and (known[1] is None or (row["at"] is not None and row["at"] >= known[1]))
            error = row["error"] or (None if seen else f"Shipment with ID {row['shipment_id']} not found.")
            yield Row(
                request_id=row["request_id"], shipment_id=row["shipment_id"], location=row["location"],
                scanned_at=row["at"], destination=known[0] if seen else None,
                success=str(error is None).lower(), error_message=error,
            )
        if created is not None:
            self.create.update(created)

    def close(self) -> None:
        pass


def gate_stream(records: DataFrame, order: list[str]) -> DataFrame:
    """Scan requests checked against the creates that came before them or with them.

    ``records`` is a stream with ``kind`` (create or scan), ``at``, ``shipment_id``,
    ``destination``, ``location`` and ``request_id``.  The state is one create per
    shipment, the latest by ``at``; a request older than it counts as one before it.  So a
    batch costs what its own rows cost, however many creates there have been.  Requests
    that are wrong in themselves need no state and are spread by their own id; what one
    shipment hands to a task is bounded by the trigger.
    """
    asked = F.col("kind") == "scan"
    rows = records.filter(asked | (F.col("kind") == "create")).withColumn("error", F.when(asked, scan_error()))
    alone = F.concat(F.lit("\0"), F.coalesce("request_id", F.lit("")))
    key = F.when(F.col("error").isNotNull(), alone).otherwise(F.coalesce("shipment_id", F.lit("")))
    return rows.withColumn("key", key).groupBy("key").transformWithState(
        statefulProcessor=GateProcessor(list(order)), outputStructType=ANSWER, outputMode="Append", timeMode="None",
    )


def gate_writer(records: DataFrame, answers_path: str, order: list[str]) -> DataStreamWriter:
    return gate_stream(records, order).writeStream.outputMode("append").foreachBatch(sinks.to_batches(answers_path))


def read_answers(spark: SparkSession, path: str) -> DataFrame:
    rows = sinks.read_batches(spark, path, ANSWER).drop("batch_id")
    return rows.withColumn("success", F.col("success") == "true")


def chain_writer(
    scans: DataFrame, order: list[str], chunk: list[Column], replayed_path: str, state_path: str, counts_path: str,
    size: str = counts.WINDOW,
) -> DataStreamWriter:
    """Scans to life cycles to deliveries to counts, in one stream.

    A batch's deliveries are counted by themselves; ``read_chained_counts`` adds the
    batches up, so no batch has to know an earlier one's counts.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        replayed = stream_lifecycle.replay_batch(batch, batch_id, replayed_path, state_path, order, chunk)
        counted = counts.delivery_counts(lifecycle.delivered_events(replayed), size)
        sinks.write_batch(counted, counts_path, batch_id)

    return scans.writeStream.foreachBatch(write)


def read_chained_counts(spark: SparkSession, path: str) -> DataFrame:
    return counts.merge_counts(sinks.read_batches(spark, path, S.DELIVERY_COUNT))
