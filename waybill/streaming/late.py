"""Counts from a stream by the exact late-data rule (operators.late).

The state is what each clock showed last, one row per clock.  A batch is judged by the
arrivals that close windows within it and by the clocks before it, so the outcome doesn't
depend on where the stream was cut into batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from waybill import schemas as S
from waybill.operators import counts, late
from waybill.session import cleared
from waybill.streaming import latest, sinks

FILES = 4
COMPACT = 20


def _clock_schema(events: DataFrame, clock: list[str], time: str) -> T.StructType:
    return T.StructType([events.schema[c] for c in [*clock, time]])


def late_writer(
    events: DataFrame, order: list[str], counts_path: str, late_path: str, clocks_path: str,
    clock: list[str] = ("location",), time: str = "delivered_at", compact: int = COMPACT, **options,
) -> DataStreamWriter:
    """Each batch's events in time are counted, those too late are kept apart.

    ``order`` is the order of arrival within a batch; batches arrive one after the other.
    ``options`` are those of operators.late.with_lateness.  Counts of a window may come
    in several batches; ``read_counts`` adds them up.
    """
    clock = list(clock)
    schema = _clock_schema(events, clock, time)
    options = {"clock": clock, "time": time} | options

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        kept = batch.persist()
        try:
            with cleared(spark):
                shown = latest.view(spark, clocks_path, schema, clock, batch_id)
                judged = late.with_lateness(kept, order, before=shown, **options).persist()
                counted = judged.filter("not late").groupBy("location", "window_start", "window_end").agg(
                    F.count(F.lit(1)).alias("count")
                )
                sinks.write_batch(counted, counts_path, batch_id)
                sinks.write_batch(judged.filter("late").drop("late"), late_path, batch_id)
                judged.unpersist()
                moved = late.clocks(kept, clock, time)
                # a clock never goes back, but only clocks of this batch are written
                before = shown.join(moved.select(*clock).distinct(), clock, "left_semi") if clock else shown
                after = late.clocks(moved, clock, time, before)
                sinks.write_batch(after.select(*schema.names), clocks_path, batch_id)
        finally:
            kept.unpersist()
        if batch_id % compact == compact - 1:
            latest.compact(spark, clocks_path, schema, clock, FILES)

    return events.writeStream.foreachBatch(write)


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    return counts.merge_counts(sinks.read_batches(spark, path, S.DELIVERY_COUNT))
