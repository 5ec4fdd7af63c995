"""Exact top-k by integer inner product, with KD-trees per shard.

Rows are dealt into shards by a hash of their id, and each shard becomes one KD-tree:
median splits of the widest side, a tight box for every node, leaves of LEAF rows.  A
query walks a tree best-first: the node whose box allows the highest score comes
next, and the walk ends when that bound is below the k-th best score so far.  Each
block of queries searches one shard first; the k-th scores found there go along to
all other shards, so that those walks begin with a bound to beat.
"""

from __future__ import annotations

import heapq
import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm.store import only, stored

SHARD_ROWS = 8192
BLOCK_ROWS = 256
LEAF = 256

HITS = "query_id long, vec_id long, score long"
LOWEST = np.iinfo(np.int64).min


def _packed(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _unpacked(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data)) as held:
        return {name: held[name] for name in held.files}


def build(ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF) -> dict[str, np.ndarray]:
    """A tree as flat arrays: boxes lo and hi, children (-1 in leaves), row ranges."""
    order = np.lexsort((ids,))
    ids, vectors = ids[order], vectors[order]
    rows = np.arange(len(ids))
    lo, hi, left, begin, end = [], [], [], [], []
    todo = [(0, len(ids))]
    # breadth first, so that the two children of a node are neighbours
    at = 0
    while at < len(todo):
        b, e = todo[at]
        at += 1
        part = vectors[rows[b:e]]
        low, high = part.min(axis=0), part.max(axis=0)
        lo.append(low), hi.append(high), begin.append(b), end.append(e)
        spread = high - low
        if e - b <= leaf or not spread.any():  # equal rows stay together, smallest ids first
            rows[b:e].sort()
            left.append(-1)
            continue
        half = (e - b) // 2
        rows[b:e] = rows[b:e][np.argpartition(part[:, spread.argmax()], half)]
        left.append(len(todo))
        todo += [(b, b + half), (b + half, e)]
    return {
        "ids": ids[rows], "vectors": vectors[rows], "lo": np.array(lo), "hi": np.array(hi),
        "left": np.array(left), "begin": np.array(begin), "end": np.array(end),
    }


def search(
    tree: dict[str, np.ndarray], query_ids: np.ndarray, queries: np.ndarray, k: int, kth: np.ndarray,
) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per query the ids and scores in ``tree`` that may be among its k best.

    ``kth`` are scores that k rows elsewhere reach already.  A row that only equals
    it is kept, as its id may be smaller.
    """
    # Whole numbers; doubles hold the sums exactly below 2**53, and multiply faster.
    top = max((int(np.abs(a).max()) for a in (tree["vectors"], queries) if a.size), default=0)
    kind = np.float64 if top * top * max(1, queries.shape[1]) < 1 << 52 else np.int64
    vectors, lo, hi, q = (a.astype(kind) for a in (tree["vectors"], tree["lo"], tree["hi"], queries))
    bounds = (np.maximum(q, 0) @ hi.T + np.minimum(q, 0) @ lo.T).astype(np.int64)
    left, begin, end = tree["left"].tolist(), tree["begin"].tolist(), tree["end"].tolist()
    same = [not (h - low).any() for h, low in zip(hi, lo)]
    out = []
    for i in range(len(q)):
        bound, own = bounds[i].tolist(), query_ids[i]
        ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        least = int(kth[i])
        heap = [(-bound[0], 0)]
        while heap:
            high, node = heapq.heappop(heap)
            if -high < least:
                break
            if left[node] >= 0:
                for child in (left[node], left[node] + 1):
                    if bound[child] >= least:
                        heapq.heappush(heap, (-bound[child], child))
                continue
            b, e = begin[node], end[node]
            if same[node]:  # of equal rows, the k with the smallest ids do, the query's own left out
                first, last = np.searchsorted(tree["ids"][b:e], [own, own + 1])
                e = min(e, b + k + (int(last - first) if first < k else 0))
            got = (vectors[b:e] @ q[i]).astype(np.int64)
            keep = np.flatnonzero((got >= least) & (tree["ids"][b:e] != own))
            if not len(keep):
                continue
            ids = np.append(ids, tree["ids"][b:e][keep])
            scores = np.append(scores, got[keep])
            by = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[by], scores[by]
            if len(ids) == k:
                least = max(least, int(scores[-1]))
        out.append((ids, scores))
    return out


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _tree_of(table: pa.Table) -> pa.Table:
    tree = build(table.column("vec_id").to_numpy(), _matrix(table.column("q")))
    return pa.table({
        "shard": table.column("shard")[:1], "dim": table.column("dim")[:1], "tree": pa.array([_packed(**tree)], pa.binary()),
    })


def _block_of(table: pa.Table) -> pa.Table:
    ids, vectors = table.column("vec_id").to_numpy(), _matrix(table.column("q"))
    return pa.table({
        "block": table.column("block")[:1], "dim": table.column("dim")[:1],
        "asked": pa.array([_packed(ids=ids, vectors=vectors, kth=np.full(len(ids), LOWEST))], pa.binary()),
    })


def _searched(k: int):
    """Rows with a block and a tree -> hits, and the block again with its new k-th scores."""

    def each(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                asked = _unpacked(batch.column("asked")[i].as_py())
                tree = _unpacked(batch.column("tree")[i].as_py())
                found = search(tree, asked["ids"], asked["vectors"], k, asked["kth"])
                kth = [int(s[-1]) if len(s) == k else LOWEST for _, s in found]
                asked["kth"] = np.maximum(asked["kth"], np.array(kth, np.int64))
                yield pa.RecordBatch.from_pydict({
                    "block": batch.column("block")[i:i + 1], "dim": batch.column("dim")[i:i + 1],
                    "asked": pa.array([_packed(**asked)], pa.binary()),
                    "queries": pa.array([np.repeat(asked["ids"], [len(x) for x, _ in found])], pa.list_(pa.int64())),
                    "ids": pa.array([np.concatenate([x for x, _ in found])], pa.list_(pa.int64())),
                    "scores": pa.array([np.concatenate([s for _, s in found])], pa.list_(pa.int64())),
                })

    return each


LINE_ROWS = 16  # trees and blocks in one Arrow batch


def _in_line(k: int):
    """Rows by shard, each tree ahead of the blocks that are searched in it -> hits."""

    def each(batches):
        tree, place = None, None
        for batch in batches:
            for row in batch.to_pylist():
                here = row["shard"], row["dim"]
                if row["block"] < 0:
                    tree, place = _unpacked(row["asked"]), here
                elif place == here:  # a shard may hold no vector of that length
                    asked = _unpacked(row["asked"])
                    found = search(tree, asked["ids"], asked["vectors"], k, asked["kth"])
                    yield pa.RecordBatch.from_pydict({
                        "query_id": pa.array(np.repeat(asked["ids"], [len(x) for x, _ in found]), pa.int64()),
                        "vec_id": pa.array(np.concatenate([x for x, _ in found]), pa.int64()),
                        "score": pa.array(np.concatenate([s for _, s in found]), pa.int64()),
                    })

    return each


FOUND = "block int, dim int, asked binary, queries array<long>, ids array<long>, scores array<long>"


def _hits(found: DataFrame) -> DataFrame:
    return found.select(F.explode(F.arrays_zip("queries", "ids", "scores")).alias("h")).select(
        F.col("h.queries").alias("query_id"), F.col("h.ids").alias("vec_id"), F.col("h.scores").alias("score")
    )


def quantised(vectors: DataFrame, vec_id: str, embedding: str, scale: int) -> DataFrame:
    """(vec_id, dim, q) with q = floor(scale * x); vectors with null or non-finite parts are left out."""
    x = F.col(embedding)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return only(vectors, vec_id, embedding).filter(
        F.col(vec_id).isNotNull() & x.isNotNull() & (F.size(x) > 0) & finite
    ).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.size(x).alias("dim"),
        F.transform(x, lambda v: F.floor(scale * v.cast("double")).cast("long")).alias("q"),
    )


def nearest(
    vectors: DataFrame, queries, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = 256,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k highest inner products.

    ``queries`` is a condition on vec_id that says which rows ask; all others and
    those answer.  Ties go to the smaller id; an id equal to the query's counts as the
    query itself; vectors of another length don't meet.  Null ids, and vectors that
    are null, empty or hold null or non-finite parts, take no part.  Parts must be
    below 2**31 / scale in size, so that scores fit a long.
    """
    rows = stored(quantised(vectors, vec_id, embedding, scale))
    asking = rows.filter(queries)
    shards = max(1, -(-rows.count() // SHARD_ROWS))
    blocks = max(1, -(-asking.count() // BLOCK_ROWS))
    trees = stored(
        rows.select(F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard"), "vec_id", "dim", "q")
        .groupBy("shard", "dim").applyInArrow(_tree_of, "shard int, dim int, tree binary")
    )
    asked = (
        asking.select(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"), "vec_id", "dim", "q")
        .groupBy("block", "dim").applyInArrow(_block_of, "block int, dim int, asked binary")
    )
    home = F.pmod(F.col("block"), F.lit(shards))
    # a home shard may hold no vector of that length
    first = stored(
        asked.withColumn("shard", home).join(trees, ["shard", "dim"])
        .select("block", "dim", "asked", "tree").mapInArrow(_searched(k), FOUND)
    )
    rest = asked.join(first.select("block", "dim"), ["block", "dim"], "left_anti").select(
        "block", "dim", "asked"
    ).union(first.select("block", "dim", "asked"))
    others = F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: s != home)
    visits = rest.select(F.explode(others).alias("shard"), "dim", "block", "asked")
    # a tree travels once: it stands ahead of all blocks that are searched in it
    lined_up = trees.select("shard", "dim", F.lit(-1).alias("block"), F.col("tree").alias("asked")).unionByName(visits)
    second = stored(
        lined_up.repartition("shard", "dim").sortWithinPartitions("shard", "dim", "block")
        .mapInArrow(_in_line(k), HITS), arrow_rows=LINE_ROWS,
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return _hits(first).union(second).withColumn("rank", F.row_number().over(best)).filter(
        F.col("rank") <= k
    ).select("query_id", "rank", "vec_id", "score")
