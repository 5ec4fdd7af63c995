"""Dated URL lists, applied to captures as of the time they were fetched.

A list is a log: (list, action, kind, pattern, at, op).  ``op`` is add or remove,
``action`` is allow or block, and ``kind`` says what the pattern names: a ``host``, a
``domain`` with all below it, a ``prefix`` of host and path up to a slash, or a
``url``.  The log becomes validity intervals, and every capture meets the entries
active when it was fetched.  The most specific one decides (url, then the longer
prefix, then host, then the longer domain); block wins a tie.

Intervals are cut at month ends.  A capture looks up its few keys in its own month, so
a host that a third of the captures share is spread over the months, and an entry
with a long history doesn't meet captures of other times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm.store import only

KINDS = ["domain", "host", "prefix", "url"]  # ascending; the place decides
ENTRY = ["list", "action", "kind", "pattern", "at", "op"]


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and final dot; null if there is none."""
    found = F.regexp_extract(F.trim(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.nullif(F.lower(F.regexp_replace(found, r"\.$", "")), F.lit(""))


def path_of(url: Column) -> Column:
    """The path, / if empty; without query and fragment."""
    found = F.regexp_extract(F.trim(url), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.when(found == "", F.lit("/")).otherwise(found)


def url_of(url: Column) -> Column:
    """Host, path and query: what a ``url`` entry names."""
    query = F.regexp_extract(url, r"(\?[^#]*)", 1)
    return F.concat(host_of(url), path_of(url), query)


def _keys(host: Column, path: Column, whole: Column, labels_most: int, steps_most: int) -> Column:
    """(kind, pattern, weight) of everything in the lists' reach that may name the capture."""
    labels = F.split(host, r"\.")

    def key(kind: str, pattern: Column, length: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), pattern.alias("pattern"),
            (F.lit(KINDS.index(kind)) * 1_000_000 + length).cast("int").alias("weight"),
        )

    domains = F.transform(
        F.sequence(F.greatest(F.lit(1), F.size(labels) + 1 - labels_most), F.size(labels)),
        lambda i: key("domain", F.array_join(F.slice(labels, i, F.size(labels)), "."), F.size(labels) - i + 1),
    )
    steps = F.split(path, "/")
    prefixes = F.transform(
        F.sequence(F.lit(1), F.least(F.size(steps), F.lit(steps_most))),
        lambda i: key("prefix", F.concat(host, F.array_join(F.slice(steps, 1, i), "/"), F.when(i < F.size(steps), "/").otherwise("")), i),
    )
    return F.when(
        host.isNotNull(),
        F.array_distinct(F.concat(
            domains, F.array(key("host", host, F.lit(0)), key("url", whole, F.lit(0))), prefixes,
        )),
    )


def intervals(log: DataFrame) -> DataFrame:
    """(list, action, kind, pattern, start, end): when each entry held; end is open or null.

    Of changes at the same moment a remove counts last.  Rows with a null part are
    left out, and so are removes of what isn't listed.
    """
    entry = ["list", "action", "kind", "pattern"]
    each = only(log, *ENTRY).dropna().groupBy(*entry, "at").agg(
        F.max(F.when(F.col("op") == "remove", 1).otherwise(0)).alias("removed")
    )
    history = Window.partitionBy(*entry).orderBy("at")
    before = F.lag("removed").over(history)
    changes = each.withColumn("before", before).filter(
        (F.col("removed") != F.coalesce("before", F.lit(1)))
    )
    return changes.withColumn("end", F.lead("at").over(history)).filter("removed = 0").select(
        *entry, F.col("at").alias("start"), "end"
    )


def evaluate(
    captures: DataFrame, log: DataFrame, capture_id: str = "page_id", url: str = "url", fetched_at: str = "fetched_at",
) -> DataFrame:
    """Per capture: its id, url, fetched_at, verdict, and the entry that decided.

    The verdict is ``block``, ``allow`` or, if no active entry names the capture,
    ``unlisted``; so are captures without a readable URL or time.  Repeated captures
    stay.  Other columns are not carried.
    """
    rows = only(captures, capture_id, url, fetched_at).select(
        F.col(capture_id).alias("id"), F.col(url).alias("url"), F.col(fetched_at).cast("timestamp").alias("t")
    ).groupBy("id", "url", "t").agg(F.count(F.lit(1)).alias("copies"))
    # names with more parts than any pattern has can't be listed
    reach = log.filter(F.col("kind").isin("domain", "prefix")).groupBy("kind").agg(
        F.max(F.size(F.split("pattern", F.when(F.col("kind") == "domain", r"\.").otherwise("/")))).alias("most")
    )
    most = {r["kind"]: r["most"] or 1 for r in reach.collect()}
    asked = rows.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url"))).withColumn(
        "whole", url_of(F.col("url"))
    ).select(
        "id", "url", "t", "copies", F.date_trunc("month", "t").alias("month"),
        F.explode_outer(_keys(
            F.col("host"), F.col("path"), F.col("whole"), most.get("domain", 1), most.get("prefix", 1),
        )).alias("k"),
    ).select("id", "url", "t", "copies", "month", "k.*")
    last = captures.agg(F.max(F.col(fetched_at).cast("timestamp")).alias("last"))
    horizon = last.first()["last"]  # open intervals reach as far as the captures
    held = intervals(log).withColumn("until", F.coalesce("end", F.lit(horizon).cast("timestamp")))
    months = held.filter(F.col("start") <= F.col("until")).withColumn("month", F.explode(F.sequence(
        F.date_trunc("month", "start"), F.date_trunc("month", "until"), F.expr("interval 1 month")
    )))
    met = asked.join(months.withColumnRenamed("month", "m"), (
        (asked["month"] == F.col("m")) & (asked["kind"] == months["kind"]) & (asked["pattern"] == months["pattern"])
        & (F.col("t") >= F.col("start")) & (F.col("end").isNull() | (F.col("t") < F.col("end")))
    ), "left").select(
        "id", asked["url"], "t", "copies",
        F.when(F.col("m").isNotNull(), F.struct(
            "weight", (F.col("action") == "block").alias("blocks"), asked["kind"].alias("kind"),
            asked["pattern"].alias("pattern"), F.col("list").alias("list"),
        )).alias("hit"),
    )
    best = met.groupBy("id", "url", "t").agg(F.max("hit").alias("hit"), F.max("copies").alias("copies"))
    return best.select(
        "*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")
    ).select(
        F.col("id").alias(capture_id), F.col("url").alias(url), F.col("t").alias(fetched_at),
        F.when(F.col("hit").isNull(), "unlisted").when(F.col("hit.blocks"), "block").otherwise("allow").alias("verdict"),
        F.col("hit.list").alias("list"), F.col("hit.kind").alias("kind"), F.col("hit.pattern").alias("pattern"),
    )
