"""Tables derived once and read by many queries: hourly counts by day, notifications
by shipment and by day, shipment states in buckets.

A table lies in the shared folder, laid out for the questions asked of it, and goes
when the application ends.  Within a session it is made once for the same input files.
How many buckets a table has follows its size.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.functions import text
from waybill.session import materialise, size_in_bytes, temporary_folder

BUCKET_BYTES = 64 << 20
FEWEST = 16
# a stored notification, most of which is its id
NOTE_BYTES = 48
_made: dict[tuple, str] = {}


def _files(spark: SparkSession, paths: list[str]) -> tuple:
    """Name, length and time of every input file, so that changed files are read anew."""
    found = []
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = place.getFileSystem(spark._jsc.hadoopConfiguration())
        for status in files.listStatus(place):
            found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return tuple(sorted(found))


def once(spark: SparkSession, name: str, inputs: list[str], write: Callable[[str], None]) -> DataFrame:
    """The table that ``write`` puts into a folder, made unless it is there already.

    Runs the job at the first call.
    """
    key = (spark.sparkContext.applicationId, name, _files(spark, inputs))
    if key not in _made:
        folder = temporary_folder(spark, name)
        write(folder)
        _made[key] = folder
    return spark.read.parquet(_made[key])


def write_counts(counts: DataFrame, folder: str) -> None:
    """Counts in one folder a day; rows of a day are placed together first."""
    dated = counts.withColumn("day", F.col("window_start").cast("date"))
    dated.repartition("day").write.partitionBy("day").parquet(folder)


def counts_of_days(counts: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """The stored counts of the days from ``start`` to ``end``; other folders aren't read."""
    day = F.col("day")
    return counts.filter(day.between(F.lit(start.date()), F.lit(end.date()))).drop("day")


def buckets_of(size: int) -> int:
    """Of BUCKET_BYTES each."""
    return max(FEWEST, -(-size // BUCKET_BYTES))


def buckets_for(rows: DataFrame) -> int:
    """By the optimizer's size; exact for stored rows."""
    return buckets_of(size_in_bytes(rows))


def _unchanged(rows: DataFrame, *also: str) -> DataFrame:
    return rows


def write_notifications(
    rows: DataFrame, folder: str, buckets: int | None = None, make: Callable[..., DataFrame] = _unchanged
) -> None:
    """Notifications in one folder for each bucket of shipments, sorted by shipment, so
    that a shipment's are in few pages of one folder, with a Bloom filter on the id for
    each row group.  A bucket with more rows than a task should write is split by size.

    ``rows`` are notifications, or shorter rows with their ``shipment_id`` and
    ``timestamp`` that are moved and sorted in their stead; ``make(rows, "bucket")``
    gives the notifications, and the bucket beside them.  Without a number of
    ``buckets`` the rows are written once more, to learn their size.
    """
    if buckets is None:
        rows = materialise(rows)
        buckets = buckets_for(rows)
    placed = rows.withColumn("bucket", F.pmod(F.xxhash64("shipment_id"), F.lit(buckets)).cast("int"))
    sorted_ = placed.hint("rebalance", "bucket").sortWithinPartitions("bucket", "shipment_id", "timestamp")
    make(sorted_, "bucket").write.option("parquet.bloom.filter.enabled#id", "true").option(
        "compression", "zstd"
    ).partitionBy("bucket").parquet(f"{folder}/buckets={buckets}")


def notifications_of(notes: DataFrame, shipment_id: str) -> DataFrame:
    """The stored notifications of one shipment's bucket; other folders aren't read."""
    wanted = F.pmod(F.xxhash64(text.trimmed(F.lit(shipment_id))), F.col("buckets")).cast("int")
    return notes.filter(F.col("bucket") == wanted).drop("buckets", "bucket")


def write_by_day(rows: DataFrame, folder: str, make: Callable[..., DataFrame] = _unchanged) -> None:
    """Notifications in one folder a day; a busy day is split by size.  ``rows`` and
    ``make`` as in ``write_notifications``."""
    dated = rows.withColumn("day", F.col("timestamp").cast("date"))
    make(dated.hint("rebalance", "day").sortWithinPartitions("day"), "day").write.option(
        "compression", "zstd"
    ).partitionBy("day").parquet(folder)


def newest_days(notes: DataFrame, rows: int) -> DataFrame:
    """The newest days of a table by day that together have at least so many rows, or
    all: whatever is left out is older than so many others.  Counts day by day, the
    newest first, and no more of a day than is still missing."""
    days = sorted((r["day"] for r in notes.select("day").distinct().collect() if r["day"] is not None), reverse=True)
    for day in days:
        rows -= notes.filter(F.col("day") == F.lit(day)).limit(rows).count()
        if rows <= 0:
            return notes.filter(F.col("day") >= F.lit(day)).drop("day")
    return notes.drop("day")


def once_bucketed(spark: SparkSession, name: str, inputs: list[str], make: Callable[[], DataFrame], key: str) -> DataFrame:
    """A table in buckets of ``key``, each sorted by it, made unless it is there already.

    Lookups of a key read one bucket; joins and aggregates by the key take the rows as
    they lie.  The catalogue entry is the session's; the files go with the application.
    """
    made = (spark.sparkContext.applicationId, name, _files(spark, inputs))
    if made not in _made:
        rows = materialise(make())
        folder = temporary_folder(spark, name)
        table = folder.rsplit("/", 1)[-1].replace("-", "_")
        count = buckets_for(rows)
        rows.repartition(count, key).write.bucketBy(count, key).sortBy(key).option("path", folder).saveAsTable(table)
        _made[made] = table
    return spark.table(_made[made])
