"""Where streams end: idempotent batch folders, record topics, dead letters.

A batch is written to the folder ``batch_id=N`` of a table, replacing what an
earlier attempt at the same batch left there.  With the query's checkpoint this
makes each batch count once, however often it is retried.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from waybill.sources import decode

TRIGGER = "10 seconds"


def start(
    writer: DataStreamWriter, checkpoint: str, available_now: bool = False, every: str = TRIGGER
) -> StreamingQuery:
    """Run on a trigger, or once over all that is there."""
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)
    return writer.start()


def write_batch(batch: DataFrame, path: str, batch_id: int) -> None:
    batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def to_batches(path: str) -> Callable[[DataFrame, int], None]:
    return lambda batch, batch_id: write_batch(batch, path, batch_id)


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All batches with their ``batch_id``; no rows where nothing was written yet."""
    full = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    try:
        return spark.read.schema(full).option("basePath", path).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], full)


def batch_ids(spark: SparkSession, path: str) -> list[int]:
    """The batches that have a folder, from a listing of the table's folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(place):
        return []
    names = [status.getPath().getName() for status in files.listStatus(place)]
    return sorted(int(n.removeprefix("batch_id=")) for n in names if n.startswith("batch_id="))


def delete_batch(spark: SparkSession, path: str, batch_id: int) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batch_id={batch_id}")
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def kafka_writer(records: DataFrame, servers: str, mode: str = "append") -> DataStreamWriter:
    """Records (``topic, key, value``) to Kafka; at least once, so readers rely on keys and ids."""
    return (
        records.writeStream.format("kafka").outputMode(mode).option("kafka.bootstrap.servers", servers)
    )


OUTCOMES = T.StructType([
    T.StructField("event_type", T.StringType()), T.StructField("status", T.StringType()), T.StructField("count", T.LongType()),
])


def split_writer(
    records: DataFrame, events_path: str, dead_letters_path: str, metrics_path: str | None = None
) -> DataStreamWriter:
    """Usable events to one table, the others to another, decoding each batch once.

    ``metrics_path`` gets each batch's events by type and outcome, counted by an
    observation while the batch is decoded, not by another pass; ``read_outcomes`` adds
    them up.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        parsed = decode.parse(batch)
        seen = Observation()
        if metrics_path is not None:
            parsed = parsed.observe(seen, *decode.outcome_counts())
        parsed = parsed.persist()
        try:
            write_batch(decode.typed(parsed), events_path, batch_id)
            write_batch(decode.dead_letters(parsed), dead_letters_path, batch_id)
        finally:
            parsed.unpersist()
        if metrics_path is not None:
            rows = [(*decode.OUTCOMES[name], n) for name, n in seen.get.items() if n]
            write_batch(batch.sparkSession.createDataFrame(rows, OUTCOMES).coalesce(1), metrics_path, batch_id)

    return records.writeStream.foreachBatch(write)


def read_outcomes(spark: SparkSession, path: str) -> DataFrame:
    """Events by type and outcome over all batches."""
    return read_batches(spark, path, OUTCOMES).groupBy("event_type", "status").agg(F.sum("count").alias("count"))
