"""The life cycle as a stream: each batch goes on from the state that the last one left.

A batch's scans run through the same windows as a whole table's (operators.lifecycle),
on top of the stored state of just the shipments they name.  Within a batch scans are
taken in the order given; across batches as they come.  A busy shipment is cut as in a
table.  The state is one row per shipment in batch folders, of which a compaction is
written every ``COMPACT`` batches, so a batch reads one row per shipment and what
changed since.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from waybill import schemas as S
from waybill.operators import lifecycle
from waybill.operators.skew import HotKeys
from waybill.session import cleared
from waybill.streaming import latest, sinks

REPLAYED = S.struct(
    "shipment_id string, seq bigint, location string, destination string, scanned_at timestamp_ntz, "
    "created_at timestamp_ntz, delivered boolean, delivered_at timestamp_ntz, status string, correlation_id string"
)
STATE = T.StructType([*S.SHIPMENT_STATE.fields, T.StructField("seq", T.LongType())])
KEY = ["shipment_id"]
COMPACT = 20
FILES = 16


def read_state(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """The current state of every shipment, or that before a batch."""
    return latest.view(spark, path, STATE, KEY, before)


def go_on(
    batch: DataFrame, batch_id: int, state_path: str, order: list[str], chunk: list[Column], hot: HotKeys | None = None
) -> DataFrame:
    """One batch's scans with the shipments' states after them."""
    scans = lifecycle.usable_scans(batch)
    state = read_state(batch.sparkSession, state_path, batch_id)
    known = state.join(scans.select(*KEY).distinct(), KEY, "left_semi")
    return lifecycle.replay(scans, order, chunk, hot=hot, before=known).select(*REPLAYED.names)


def replay_batch(
    batch: DataFrame, batch_id: int, replayed_path: str, state_path: str, order: list[str], chunk: list[Column],
    hot: HotKeys | None = None, compact: int = COMPACT,
) -> DataFrame:
    """Writes a batch's life cycles and the states they leave; returns the former as stored.

    A repeated attempt reads the states before the batch and replaces what it wrote.
    """
    spark = batch.sparkSession
    kept = batch.persist()
    try:
        with cleared(spark):
            sinks.write_batch(go_on(kept, batch_id, state_path, order, chunk, hot), replayed_path, batch_id)
    finally:
        kept.unpersist()
    replayed = spark.read.schema(REPLAYED).parquet(f"{replayed_path}/batch_id={batch_id}")
    sinks.write_batch(lifecycle.shipment_state(replayed, seq=True).select(*STATE.names), state_path, batch_id)
    if batch_id % compact == compact - 1:
        latest.compact(spark, state_path, STATE, KEY, FILES)
    return replayed


def replay_writer(
    scans: DataFrame, order: list[str], chunk: list[Column], replayed_path: str, state_path: str,
    hot: HotKeys | None = None, compact: int = COMPACT,
) -> DataStreamWriter:
    """Every scan of a stream with the shipment's state after it, as
    operators.lifecycle.replay gives for a table, and the states."""

    def write(batch: DataFrame, batch_id: int) -> None:
        replay_batch(batch, batch_id, replayed_path, state_path, order, chunk, hot, compact)

    return scans.writeStream.foreachBatch(write)
