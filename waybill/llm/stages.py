"""The stages of the corpus pipeline: (session, documents, table folder) -> documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.llm import decontaminate, jaccard, pieces, quality, secrets
from waybill.llm.store import unused

# In every stage: null and empty texts are texts like any other, rows that repeat are
# judged alike, columns may have any name, and an empty table gives an empty one.


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier rejects; a null id has no label to learn from."""
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = unused(docs.columns, "quality_score")
    return quality.classify(docs, model, score=score).filter(F.col(score) >= quality.PREDICTED).drop(score)


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar ones: the one with the smallest id.

    Documents without words all stay; see ``jaccard.one_of_each_class`` for null ids.
    """
    return jaccard.one_of_each_class(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a benchmark item.

    A document is judged by its text alone: of rows that share an id only those go whose
    text holds an item, and so do those without an id.
    """
    digest = F.md5(F.col("text").cast("binary"))
    asked = docs.select(digest.alias("digest"), "text").filter("text is not null")
    hits = decontaminate.find(asked, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), doc_id="digest")
    key = unused(docs.columns, "text_digest")
    gone = hits.select(F.col("digest").alias(key)).distinct()
    return docs.withColumn(key, digest).join(gone, key, "left_anti").select(*docs.columns)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret masked; n_chars follows the text."""
    spans = unused(docs.columns, "spans")
    found = secrets.find(docs, keep=docs.columns, spans=spans)
    has = F.size(spans) > 0
    out = found.withColumn("text", F.when(has, secrets.masked(F.col("text"), F.col(spans))).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(has, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every text as ids, and the digest of what they decode to; a null text is empty."""
    coded = pieces.encode(docs.select("doc_id", "lang", "source", "text"), "text", "ids")
    return pieces.decode(coded, "ids", "decoded").select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
