"""Tables of batch folders in which the last batch's row of a key counts.

Beside the batches lie compactions: the whole table as of one batch, under that batch's
number.  Readers take one compaction and the batches after it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.streaming import sinks

BASE = "_base"


def last_batch(spark: SparkSession, path: str, before: int | None = None) -> int | None:
    here = [b for b in sinks.batch_ids(spark, path) if before is None or b < before]
    return max(here, default=None)


def view(spark: SparkSession, path: str, schema: T.StructType, key: list[str], before: int | None = None) -> DataFrame:
    """Each key's row as the latest batch left it, or as it was before batch ``before``."""
    base = last_batch(spark, path + BASE, before)
    rows = newer = sinks.read_batches(spark, path, schema)
    if base is not None:
        newer = rows.filter(F.col("batch_id") > base)
    newer = newer if before is None else newer.filter(F.col("batch_id") < before)
    if base is not None:
        kept = sinks.read_batches(spark, path + BASE, schema)
        newer = kept.filter(F.col("batch_id") == base).unionByName(newer)
    values = [f.name for f in schema.fields if f.name not in key]
    if len(values) == 1:
        return newer.groupBy(*key).agg(F.max_by(values[0], "batch_id").alias(values[0]))
    return newer.groupBy(*key).agg(F.max_by(F.struct(*values), "batch_id").alias("_v")).select(
        *[f"_v.{f.name}" if f.name in values else f.name for f in schema.fields]
    )


def compact(
    spark: SparkSession, path: str, schema: T.StructType, key: list[str], files: int,
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> int | None:
    """Write the whole table as of now beside the batches, into few files; readers then
    skip the batches it covers, and see the same rows as before, or of those the ones
    that ``keep`` leaves.  Reads the last compaction and what came after it.  Returns the
    last batch covered, None if there is none."""
    last = last_batch(spark, path)
    if last is None or last_batch(spark, path + BASE) == last:
        return last
    current = view(spark, path, schema, key)
    current = current if keep is None else keep(current)
    sinks.write_batch(current.coalesce(files), path + BASE, last)
    return last


def remove_covered(spark: SparkSession, path: str) -> int:
    """Delete the batches that the latest compaction covers, and older compactions.

    For when no reader is at work on an older view, and the stream that writes here is
    past the covered batches.  Returns how many folders went.
    """
    base = last_batch(spark, path + BASE)
    if base is None:
        return 0
    gone = 0
    for table, covered in ((path, base), (path + BASE, base)):
        for batch_id in sinks.batch_ids(spark, table):
            if batch_id < covered:
                gone += sinks.delete_batch(spark, table, batch_id)
    return gone
