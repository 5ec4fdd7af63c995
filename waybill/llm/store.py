"""Tables between two steps, written to the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from waybill.session import shared_dir


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
TEXTS_AT_ONCE = 500  # whole texts that one Arrow batch between the JVM and Python holds


def stored(df: DataFrame, arrow_rows: int = TEXTS_AT_ONCE) -> DataFrame:
    """``df`` written once as Parquet under the shared folder and read again.

    What follows reads whole files from storage that outlives any executor.  The
    folder goes when the application ends.  While it is written, Arrow batches have
    at most ``arrow_rows`` rows, as the usual ten thousand would be tens of MB of text
    in the JVM and in Python for each task.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}"
    schema = df.schema
    before = spark.conf.get(ARROW_ROWS)
    spark.conf.set(ARROW_ROWS, str(min(arrow_rows, int(before)) if int(before) > 0 else arrow_rows))
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(ARROW_ROWS, before)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(schema).parquet(path)


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns; says which are missing instead of failing later."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*names)


def unused(columns: list[str], name: str) -> str:
    """``name``, or one like it that none of the columns has, in whatever case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
