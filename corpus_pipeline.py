"""A corpus made ready for training, in stages that each store what they keep."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from waybill.llm import stages
from waybill.llm.store import stored

STAGES = [
    ("quality classifier", stages.quality_stage),
    ("n-gram Jaccard join", stages.jaccard_stage),
    ("benchmark decontamination", stages.decontamination_stage),
    ("secret scans", stages.secrets_stage),
    ("SentencePiece encoding and decoding", stages.pieces_stage),
]

# The classifier, the latent search and the merge rounds can't be written in SQL;
# tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the stages make of ``documents``, one after the other."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
