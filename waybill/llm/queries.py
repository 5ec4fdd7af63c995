"""The registered queries of this subpackage, each over its whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.functions import times
from waybill.llm import (
    decontaminate, extract, jaccard, lexical, oracle, packing, pieces, quality, scoring, secrets, substrings, topk, trie, urls,
)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, and where."""
    return decontaminate.find(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every text without windows of an earlier document."""
    return substrings.remove_repeats(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document against the documents labelled as good, relative to all others."""
    good = read(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return scoring.cross_entropy_difference(read(spark, sf_dir, "documents"), good)


def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best partners of every fiftieth vector."""
    return topk.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every text; base_sha256 leaves out what the test battery adds."""
    found = secrets.find(read(spark, sf_dir, "documents"))

    def of(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"] < 3)
    return found.select(
        "doc_id",
        of(0).alias("n_assign"), of(1).alias("n_access"), of(2).alias("n_hex"),
        F.sha2(secrets.as_text(base), 256).alias("base_sha256"),
        secrets.as_text(F.col("spans")).alias("spans"),
        of(3).alias("n_random"),
    )


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The probability that a text is good, learnt from labels of rows that aren't held out."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    return quality.classify(docs, model).select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= quality.PREDICTED).cast("int").alias("predicted"),
    )


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = read(spark, sf_dir, "pages")
    return extract.extract(pages, extract.fit(pages), ["page_id", "url"]).withColumn(
        "n_chars", F.length("text").cast("long")
    )


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text and their decoding, as digests."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    coded = pieces.encode(docs, "text", "ids").select("doc_id", "ids")
    return pieces.decode(coded, "ids", "decoded").select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similarity class of every document."""
    return jaccard.similar_classes(read(spark, sf_dir, "documents"))


def _number(text: Column, modulus: int) -> Column:
    """A number that SQL engines agree on, from a text."""
    return F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("long") % modulus


def captures_of(pages: DataFrame) -> DataFrame:
    """The pages with a fetch time in 2024; the table has none of its own."""
    second = _number(F.concat_ws("|", "url", F.col("page_id").cast("string")), 366 * 86400)
    return pages.select("page_id", "url", F.timestamp_seconds(F.lit(1704067200) + second).alias("fetched_at"))


def list_log_of(pages: DataFrame) -> DataFrame:
    """Dated list entries for every host of ``pages``, so that the lists grow with them."""
    hosts = pages.select(urls.host_of(F.col("url")).alias("host")).filter("host is not null").distinct()
    n = _number(F.col("host"), 1 << 27)
    moment = F.timestamp_seconds(F.lit(1704067200) + n % (200 * 86400))
    later = F.timestamp_seconds(F.lit(1704067200) + n % (200 * 86400) + (n % 97 + 1) * 86400)
    domain = F.array_join(F.slice(F.split("host", r"\."), -2, 2), ".")
    two = F.size(F.split("host", r"\.")) > 1

    def entry(name: str, action: str, kind: str, pattern: Column, at: Column, op: str, when: Column) -> Column:
        return F.when(when, F.struct(
            F.lit(name).alias("list"), F.lit(action).alias("action"), F.lit(kind).alias("kind"),
            pattern.alias("pattern"), at.alias("at"), F.lit(op).alias("op"),
        ))

    rows = F.array(
        entry("hosts", "block", "host", F.col("host"), moment, "add", n % 3 == 0),
        entry("hosts", "block", "host", F.col("host"), later, "remove", n % 6 == 0),
        entry("domains", "block", "domain", domain, moment, "add", (n % 4 == 0) & two),
        entry("domains", "block", "domain", domain, later, "remove", (n % 2 == 0) & two),
        entry("paths", "allow", "prefix", F.concat("host", F.lit("/en/")), later, "add", n % 5 < 2),
    )
    return hosts.select(F.explode(F.array_compact(rows)).alias("e")).select("e.*")


def op10_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by the lists as of its fetch time."""
    pages = read(spark, sf_dir, "pages")
    return urls.evaluate(captures_of(pages), list_log_of(pages)).withColumn(
        "fetched_at", times.from_instant("fetched_at")
    )


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces, and where they lie in sequences of 2048 tokens."""
    return packing.pack(read(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of conversations that begin with turns of every twentieth one."""
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    turns, convs = trie.branched(
        trie.turns_of(read(spark, sf_dir, "conversations")), F.col("conv_id") - F.col("conv_id") % 20, shared, 3
    )
    return trie.trie(turns, convs).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifty best documents of every benchmark item."""
    return lexical.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_exact_topk": op4_exact_topk,
    "op5_secret_scan": op5_secret_scan,
    "op6_quality": op6_quality,
    "op7_html_extraction": op7_html_extraction,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_url_lists": op10_url_lists,
    "op11_packing": op11_packing,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_lexical_search": op13_lexical_search,
}
ORACLE = {
    "op2_substring_dedup": oracle.OP2,
    "op3_lm_scoring": oracle.OP3,
    "op4_exact_topk": oracle.OP4,
    "op9_jaccard_join": oracle.OP9,
    "op10_url_lists": oracle.OP10,
    "op12_conversation_trie": oracle.OP12,
    "op13_lexical_search": oracle.OP13,
}
