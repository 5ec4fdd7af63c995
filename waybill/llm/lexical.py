"""Ranked lexical search, exact, by sequential reads of impact-sorted lists (NRA).

A query's terms have one list each, of documents by falling impact.  The lists are read
side by side, a stretch at a time and never by document.  Every document met has an
interval: at least the sum of what was read of it, at most that and the next unread
impact of each list in which it has not turned up.  Reading goes on until the k best
are certain: every other document's upper end is below the k-th lower end, and the
intervals of those that remain, ties with the k-th included, have closed to one score.

Documents lie in shards, each with its own lists, so a task holds one shard and a block
of queries.  Shards are made while texts are read, where the texts are, and hold only
the queries' terms: postings don't travel.  The statistics (documents, all terms, and
in how many documents each term stands) cover all documents.  One shard is searched
first; its k-th scores are a bound that all other shards begin with, so that most of
their lists needn't be read to the end.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm.store import only, stored
from waybill.llm.words import hand_back, raw_texts

TOP = 50
BLOCK_TERMS = 50_000  # terms of the queries that are searched together
SHARD_POSTINGS = 1 << 20
SHARD_DOCS = 1 << 17
READ = 64  # entries of each list that the first round reads; every round reads twice as many
PART = 1 << 20  # bytes of text taken at once

# ASCII other than 0-9, A-Z and a-z parts terms; A-Z are lowered; all else stays.
TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)

STATS = "documents long, tokens long"
HITS = "item int, doc_id long, score long"
HITS_ARROW = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(TABLE).split()


class Known(dict):
    """term -> its number, -1 for all others."""

    def __missing__(self, term: bytes) -> int:
        return -1


class Queries:
    """A block of queries as numbers of their distinct terms."""

    def __init__(self, rows: list[tuple[int | None, list[str]]]):
        sets: dict = {}
        for item, texts in rows:
            sets.setdefault(item, set()).update(t for text in texts for t in terms_of(text.encode()))
        self.ids = list(sets)
        self.numbers = Known((t, n) for n, t in enumerate(sorted(set().union(*sets.values()))))
        self.terms = [np.array(sorted(self.numbers[t] for t in s), np.int64) for s in sets.values()]


def _parts(text: bytes):
    """``text`` in stretches of about PART bytes that end between terms."""
    at = 0
    while at < len(text):
        end = at + PART
        while end < len(text) and TABLE[text[end]] != 32:
            end += 1
        yield text[at:end]
        at = end


def counted(texts: list[bytes], numbers: Known) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Number of terms of every text; and text, term, times of every query term in it."""
    sizes = np.zeros(len(texts), np.int64)
    keys, many = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i, text in enumerate(texts):
        found = [np.zeros(0, np.int64)]
        for part in _parts(text):
            terms = terms_of(part)
            sizes[i] += len(terms)
            known = np.fromiter(map(numbers.__getitem__, terms), np.int64, len(terms))
            found.append(known[known >= 0])
        term, times = np.unique(np.concatenate(found), return_counts=True)
        keys.append(term + i * len(numbers))
        many.append(times)
    key = np.concatenate(keys)
    base = max(1, len(numbers))
    return sizes, key // base, key % base, np.concatenate(many)


def sharded(docs: DataFrame, numbers) -> DataFrame:
    """(doc_id, text) as shards: rows of SHARDS with one task's next documents each.

    ``numbers`` is the broadcast Known of the queries' terms.  A shard ends at
    SHARD_POSTINGS or SHARD_DOCS.  ``docs`` and ``known`` (is the id not null) have one
    entry for each document with a query term; terms and dfs say in how many documents
    of the shard each term stands.  A row without docs carries counts alone, in ``sizes``.
    """

    def each(batches):
        known_terms = numbers.value
        held, postings, count, number = [], 0, 0, 0
        documents = tokens = 0

        def shard():
            nonlocal held, postings, count
            ids, known, sizes, doc, term, tf = (np.concatenate(c) for c in zip(*held))
            held, postings, count = [], 0, 0
            have, df = np.unique(term, return_counts=True)
            return pa.RecordBatch.from_pydict({
                "docs": pa.array([ids.tobytes()]), "known": pa.array([known.tobytes()]),
                "sizes": pa.array([sizes.tobytes()]), "term": pa.array([term.astype("<i4").tobytes()]),
                "doc": pa.array([doc.astype("<i4").tobytes()]), "tf": pa.array([tf.astype("<i4").tobytes()]),
                "terms": pa.array([have], pa.list_(pa.int32())), "dfs": pa.array([df], pa.list_(pa.int64())),
                "documents": pa.array([None], pa.int64()), "tokens": pa.array([None], pa.int64()),
            })

        for batch in batches:
            hand_back()
            sizes, doc, term, tf = counted(raw_texts(batch.column("text")), known_terms)
            documents += int((sizes > 0).sum())
            tokens += int(sizes.sum())
            have = np.unique(doc)
            ids = batch.column("doc_id")
            known = ids.is_valid().to_numpy(zero_copy_only=False)[have]
            ids = ids.fill_null(0).to_numpy(zero_copy_only=False)[have]
            held.append((ids, known, sizes[have], np.searchsorted(have, doc) + count, term, tf))
            postings, count = postings + len(doc), count + len(have)
            if postings >= SHARD_POSTINGS or count >= SHARD_DOCS:
                yield shard()
        if count:
            yield shard()
        yield pa.RecordBatch.from_pydict({
            **{c: pa.array([None], pa.binary()) for c in ("docs", "known", "sizes", "term", "doc", "tf")},
            "terms": pa.array([None], pa.list_(pa.int32())), "dfs": pa.array([None], pa.list_(pa.int64())),
            "documents": pa.array([documents]), "tokens": pa.array([tokens]),
        })
        hand_back()

    columns = "docs binary, known binary, sizes binary, term binary, doc binary, tf binary, terms array<int>, dfs array<long>"
    return docs.mapInArrow(each, f"{columns}, {STATS}")


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


class Shard:
    """One shard's lists, each by falling impact."""

    def __init__(self, row: dict, documents: int, tokens: int, weights: np.ndarray):
        self.ids = np.frombuffer(row["docs"], np.int64)
        self.known = np.frombuffer(row["known"], bool)
        sizes = np.frombuffer(row["sizes"], np.int64)
        term, doc, tf = (np.frombuffer(row[c], "<i4").astype(np.int64) for c in ("term", "doc", "tf"))
        m = 50 + 50 * sizes * documents // tokens
        impact = weights[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m[doc]))
        by = np.lexsort((-impact, term))
        self.doc, self.impact = doc[by], impact[by]
        self.begin = np.searchsorted(term[by], np.arange(len(weights) + 1))
        # places in the order in which equal scores are ranked
        self.place = np.empty(len(self.ids), np.int64)
        self.place[np.lexsort((self.ids, ~self.known))] = np.arange(len(self.ids))

    def search(self, terms: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of the k best by (score, id), of which ``least`` or more is
        asked; a score above 0 always is."""
        begin, end = self.begin[terms], self.begin[terms + 1]
        at = begin.copy()
        least = max(least, 1)
        lower = np.zeros(len(self.ids), np.int64)
        unread = np.zeros(len(self.ids), np.int64)  # a bit for each list in which a document was met
        wide = np.zeros((len(self.ids), -(-len(terms) // 62)), np.int64) if len(terms) > 62 else None
        met = np.zeros(0, np.int64)
        step = READ
        while True:
            fresh = []
            for i in range(len(terms)):
                upto = min(int(end[i]), int(at[i]) + step)
                if upto > at[i]:
                    docs = self.doc[at[i]:upto]
                    lower[docs] += self.impact[at[i]:upto]
                    if wide is None:
                        unread[docs] |= 1 << i
                    else:
                        wide[docs, i // 62] |= 1 << i % 62
                    fresh.append(docs)
                    at[i] = upto
            step *= 2
            met = np.unique(np.concatenate([met, *fresh]))
            ahead = np.where(at < end, self.impact[np.minimum(at, len(self.impact) - 1)], 0)
            rest = int(ahead.sum())
            upper = lower[met] + rest
            for i in np.flatnonzero(ahead).tolist():
                bits = unread[met] if wide is None else wide[met, i // 62]
                upper -= np.where(bits >> i % 62 & 1, ahead[i], 0)
            if len(met) >= k:
                least = max(least, int(np.partition(lower[met], len(met) - k)[len(met) - k]))
            # what can no longer reach the k-th is forgotten; it stays readable, never returned
            alive = upper >= least
            met, upper = met[alive], upper[alive]
            # a document not met yet, or met and forgotten, would have to beat the k-th
            if rest < least and (upper == lower[met]).all():
                break
        by = np.lexsort((self.place[met], -lower[met]))[:k]
        return met[by], lower[met][by]


def _searched(shared, k: int):
    def each(batches):
        queries, documents, tokens, weights, least = shared.value
        for batch in batches:
            for row in batch.to_pylist():
                hand_back()
                shard = Shard(row, documents, tokens, weights)
                for i, terms in enumerate(queries):
                    found, scores = shard.search(terms, k, int(least[i])) if len(terms) else ((), ())
                    if len(found):
                        yield pa.RecordBatch.from_arrays([
                            pa.array(np.full(len(found), i), pa.int32()),
                            pa.array(shard.ids[found], pa.int64(), mask=~shard.known[found]),
                            pa.array(scores),
                        ], schema=HITS_ARROW)

    return each


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    """The k best of each item; what a shard gave is sorted already, and cut again here."""
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def search(
    docs: DataFrame, items: DataFrame, k: int = TOP, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the k best documents of every item.

    A score is the sum over the item's distinct terms; see the module for the order of
    reading and ``Shard`` for the numbers.  Ties go to the smaller doc_id, a null one last.
    Rows of items that share an id are one query of all their terms; rows of documents
    that share an id are documents of their own.  Null or empty texts have no terms: such
    documents are not counted and such items get no rows.  An empty table on either side
    gives no rows.  Other columns are not carried.

    The items are taken in blocks of about BLOCK_TERMS terms, so what is broadcast and
    collected (a block, its terms' counts, its k-th scores) doesn't grow with the tables;
    the documents are read once for each block.
    """
    rows = only(docs, doc_id, text).select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    asked = only(items, item_id, item_text).select(
        F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text")
    ).filter("text is not null").groupBy("item_id").agg(F.collect_set("text").alias("texts"))
    asked = stored(asked)
    size = asked.agg(F.sum(F.size(F.split(F.array_join("texts", " "), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")))).first()[0]
    parts = max(1, -(-(size or 0) // BLOCK_TERMS))
    out = None
    for part in range(parts):
        block = asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part).collect()
        block.sort(key=lambda r: (r["item_id"] is None, r["item_id"] or 0))
        found = _search_block(rows, Queries([(r["item_id"], r["texts"]) for r in block]), k)
        out = found if out is None else out.union(found)
    return out


def _search_block(rows: DataFrame, queries: Queries, k: int) -> DataFrame:
    spark = rows.sparkSession
    schema = "item_id long, rank int, doc_id long, score long"
    if not queries.numbers:
        return spark.createDataFrame([], schema)
    context = spark.sparkContext
    kept = stored(sharded(rows, context.broadcast(queries.numbers)).withColumn("shard", F.expr("uuid()")))
    totals = kept.agg(F.sum("documents").alias("d"), F.sum("tokens").alias("t")).first()
    if not totals["d"]:
        return spark.createDataFrame([], schema)
    # one row for each term of the block
    dfs = kept.select(F.explode(F.arrays_zip("terms", "dfs")).alias("e")).groupBy("e.terms").agg(F.sum("e.dfs").alias("n"))
    weights = np.zeros(len(queries.numbers), np.int64)
    for r in dfs.collect():
        weights[r["terms"]] = weight(totals["d"], r["n"])
    shards = kept.filter("docs is not null").select("shard", "docs", "known", "sizes", "term", "doc", "tf")
    first = kept.filter("docs is not null").agg(F.max("shard")).first()[0]
    if first is None:
        return spark.createDataFrame([], schema)

    def given(least):
        return _searched(context.broadcast((queries.terms, totals["d"], totals["t"], weights, least)), k)

    nothing = np.zeros(len(queries.terms), np.int64)
    one = stored(shards.filter(F.col("shard") == first).mapInArrow(given(nothing), HITS))
    least = nothing.copy()
    for r in one.groupBy("item").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("s")).filter(F.col("n") >= k).collect():
        least[r["item"]] = r["s"]
    rest = shards.filter(F.col("shard") != first).mapInArrow(given(least), HITS)
    ids = spark.createDataFrame(list(enumerate(queries.ids)), "item int, item_id long")
    return _ranked(one.union(rest), k).join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")
