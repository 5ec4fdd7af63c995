"""Prefix sums along linked lists that no single task could hold.

Rows are dealt into groups that fit a task.  A group follows the links between its own
rows, and each stretch of them shrinks to one row: its first element, the link that
leaves it, and the sums over it.  What is left is a shorter list, dealt anew, until one
stretch is all.  Then the way back: an element's sum is that of its stretch's first
element, plus its own within the stretch.

Groups are ranges of the elements' keys, which is where links are short if the keys were
chosen well.  Where that shortens a list by less than a quarter, the next rounds pair
elements by lot: one that draws heads goes where its successor is, one that draws tails
stays, so a quarter of the links lie within a group whatever the keys are like.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.store import stored

ROWS = 1 << 16  # elements of a group
LEAST = 0.75  # of the elements may stay; else the next round draws lots

LINKS = ["a", "b", "next_a", "next_b"]


def _keys(a: np.ndarray, b: np.ndarray, next_a: np.ndarray, next_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's key and its successor's as one number; -1 for a successor that can't be here."""
    known = np.unique(a)
    width = int(max(b.max(), next_b.max())) + 1
    at = np.minimum(np.searchsorted(known, next_a), len(known) - 1)
    after = np.where((known[at] == next_a) & (next_b >= 0), at * width + next_b, -1)
    return np.searchsorted(known, a) * width + b, after


def stretches(keys: np.ndarray, after: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row: the first row of its stretch, the sums of the rows ahead of it there, and
    (for first rows, else -1) the last row."""
    order = np.argsort(keys)
    at = np.minimum(np.searchsorted(keys[order], after), len(keys) - 1)
    linked = keys[order[at]] == after
    successor = order[at]
    head = np.arange(len(keys))
    head[successor[linked]] = np.flatnonzero(linked)  # so far the row ahead
    ahead = np.zeros_like(sums)
    ahead[successor[linked]] = sums[linked]
    while True:
        further = head[head]
        if (further == head).all():
            break
        ahead += ahead[head]
        head = further
    last = np.full(len(keys), -1)
    ends = np.flatnonzero(~linked)
    last[head[ends]] = ends
    return head, ahead, last


def _shortened(weights: int):
    names = [f"w{i}" for i in range(weights)]

    def each(batches):
        rows = pa.Table.from_batches(list(batches)) if batches else None
        if rows is None or not rows.num_rows:
            return
        a, b, next_a, next_b = (rows.column(c).to_numpy() for c in LINKS)
        sums = np.stack([rows.column(n).to_numpy() for n in names], axis=1)
        head, ahead, last = stretches(*_keys(a, b, next_a, next_b), sums)
        first = last >= 0
        total = ahead[last] + sums[last]
        out = {
            "a": a, "b": b, "head_a": a[head], "head_b": b[head],
            **{f"o{i}": ahead[:, i] for i in range(weights)},
            "next_a": pa.array(next_a[last], mask=~first), "next_b": pa.array(next_b[last], mask=~first),
            **{f"t{i}": pa.array(total[:, i], mask=~first) for i in range(weights)},
        }
        yield pa.RecordBatch.from_pydict({k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in out.items()})

    return each


def _materialised(batches):
    return [b for b in batches if b.num_rows]


def prefix_sums(links: DataFrame, weights: int, rows: int = ROWS) -> DataFrame:
    """(a, b, o0, o1, ...): per element the sums of w0, w1, ... over all elements ahead of it.

    ``links`` has longs a, b (the element's key; b not negative), next_a, next_b (its
    successor's; next_b is -1 at the end) and w0, w1, ...  It must be one list.
    """
    spark = links.sparkSession
    names = [f"w{i}" for i in range(weights)]
    sums, totals = [f"o{i}" for i in range(weights)], [f"t{i}" for i in range(weights)]
    schema = ", ".join(
        f"{c} long" for c in ["a", "b", "head_a", "head_b", *sums, "next_a", "next_b", *totals]
    )
    shorten = _shortened(weights)
    here = stored(links.select(*LINKS, *names))
    many = here.count()
    levels: list[DataFrame] = []
    by_lot = False
    while many:
        groups = -(-many // rows)
        if groups == 1:
            dealt = here.coalesce(1)
        elif by_lot:
            heads = F.xxhash64("a", "b", F.lit(len(levels))) % 2 == 0
            mate_a = F.when(heads, F.col("next_a")).otherwise(F.col("a"))
            mate_b = F.when(heads, F.col("next_b")).otherwise(F.col("b"))
            dealt = here.repartition(groups, mate_a, mate_b)
        else:
            dealt = here.repartitionByRange(groups, "a", "b")
        levels.append(stored(dealt.mapInArrow(lambda batches: shorten(_materialised(batches)), schema)))
        shorter = levels[-1].filter("next_b is not null").select(
            "a", "b", "next_a", "next_b", *[F.col(t).alias(n) for t, n in zip(totals, names)]
        )
        left = shorter.count()
        if left <= 1:
            break
        by_lot = by_lot or left > LEAST * many
        here, many = shorter, left
    if not levels:
        return spark.createDataFrame([], ", ".join(f"{c} long" for c in ["a", "b", *sums]))
    placed = levels[-1].select("a", "b", *sums)
    for level in reversed(levels[:-1]):
        known = placed.select(
            F.col("a").alias("head_a"), F.col("b").alias("head_b"), *[F.col(s).alias(f"h_{s}") for s in sums]
        )
        placed = level.join(known, ["head_a", "head_b"]).select(
            "a", "b", *[(F.col(s) + F.col(f"h_{s}")).alias(s) for s in sums]
        )
    return placed
