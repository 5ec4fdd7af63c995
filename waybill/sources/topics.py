"""Topic records, as a table or as a stream: ``topic, partition, offset,
timestamp, type_id, key, value``."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.functions import times

TYPE_HEADER = "__TypeId__"
# Bounds of one trigger, and so of what a busy key hands to one task at a time.
RECORDS_PER_TRIGGER = 1_000_000
FILES_PER_TRIGGER = 64


def kafka_records(
    spark: SparkSession,
    servers: str,
    topics: list[str],
    streaming: bool = True,
    starting_offsets: str = "earliest",
    max_per_trigger: int = RECORDS_PER_TRIGGER,
) -> DataFrame:
    """Records of Kafka topics (needs Spark's Kafka connector on the class path)."""
    reader = (spark.readStream if streaming else spark.read).format("kafka")
    reader = (
        reader.option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", starting_offsets)
        .option("includeHeaders", "true")
    )
    if streaming:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    header = F.filter("headers", lambda h: h["key"] == TYPE_HEADER)
    return reader.load().select(
        "topic",
        "partition",
        "offset",
        times.from_instant("timestamp").alias("timestamp"),
        F.get(header, F.lit(0))["value"].cast("string").alias("type_id"),
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
    )


def file_records(
    spark: SparkSession,
    path: str,
    topic: str,
    streaming: bool = False,
    max_files_per_trigger: int = FILES_PER_TRIGGER,
) -> DataFrame:
    """One JSON event per line.  Files have no partition or offset; the file's
    path and time stand in for the record's metadata, and ``source_line`` for its place:
    where the task's part of the file begins, and the line's number in that part."""
    reader = spark.readStream if streaming else spark.read
    if streaming:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.format("text").load(path).select(
        "value",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_modification_time").alias("modified"),
    ).mapInArrow(_numbered, "value string, source_file string, modified timestamp, source_line string")
    return lines.select(
        F.lit(topic).alias("topic"),
        F.lit(None).cast("int").alias("partition"),
        F.lit(None).cast("bigint").alias("offset"),
        times.from_instant(F.col("modified")).alias("timestamp"),
        F.lit(None).cast("string").alias("type_id"),
        F.lit(None).cast("string").alias("key"),
        "value",
        "source_file",
        "source_line",
    )


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task reads its parts of files one after the other, each from its beginning."""
    part, done = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        files = batch.column("source_file").dictionary_encode()
        codes, starts = files.indices.to_numpy(), batch.column("start").to_numpy()
        new = np.flatnonzero((codes[1:] != codes[:-1]) | (starts[1:] != starts[:-1])) + 1
        bounds = [0, *new.tolist(), batch.num_rows]
        places = []
        for begin, end in zip(bounds[:-1], bounds[1:]):
            here = (batch.column("source_file")[begin].as_py(), int(starts[begin]))
            if here != part:
                part, done = here, 0
            places += [f"{here[1]}:{n}" for n in range(done, done + end - begin)]
            done += end - begin
        yield pa.RecordBatch.from_arrays(
            [batch.column("value"), batch.column("source_file"), batch.column("modified"), pa.array(places, pa.string())],
            names=["value", "source_file", "modified", "source_line"],
        )
