"""Removal of word sequences that an earlier document has already.

Every window of ``width`` words gets its Rabin-Karp hash.  A window is repeated if
its hash also begins somewhere in a document with a smaller id; all windows are
judged on the input.  Repeated windows that touch or overlap merge into maximal
intervals, and the words inside go.

Documents are grouped by ranges of their id, so a window found in an earlier group
needs no more than that one bit from the exchange, and the order inside a group is
seen in place.  Hashes have 64 bits: among n windows about n * n / 2**65 pairs of
unlike ones meet, 5e-4 for the 1.3e8 windows of half a gigabyte.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm import exchange
from waybill.llm.store import only
from waybill.llm.words import inside, raw_texts, rolling, word_hashes

WIDTH = 13

RESULT = "doc_id long, n_words long, n_removed long, removed array<struct<start:int,end:int>>, kept string"
RESULT_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
    ("removed", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("kept", pa.string()),
])


def _windows(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and text of every window, and where each text's words begin."""
    hashes, ends = word_hashes(texts)
    start, owner = inside(ends, width)
    return rolling(hashes, width)[start], start, owner, ends


def _known(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Document ids, and which are not null."""
    ids = table.column("doc_id").combine_chunks()
    return ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), ids.is_valid().to_numpy(zero_copy_only=False)


def id_groups(docs: DataFrame, groups: int) -> DataFrame:
    """``docs`` with g: ranges of doc_id with about equally many rows.  Null ids, which
    belong to no range, are dealt over all groups."""
    steps = [i / groups for i in range(1, groups)]
    found = docs.select(F.percentile_approx("doc_id", steps, max(10_000, 20 * groups)).alias("q")).first()["q"] if steps else None
    cuts = np.unique(np.array(found or [], np.int64))

    @F.arrow_udf("int")
    def range_of(ids: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(cuts, ids.to_numpy(zero_copy_only=False)), pa.int32())

    any_group = F.pmod(F.xxhash64("text"), F.lit(groups)).cast("int")
    known = F.col("doc_id").isNotNull()
    return docs.select(
        F.when(known, range_of(F.coalesce("doc_id", F.lit(0)))).otherwise(any_group).alias("g"), "doc_id", "text"
    )


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, removed (word intervals, end exclusive), kept.

    ``kept`` joins the words that stay by one space.  Null texts have no words.  Rows
    with a null id neither lose words nor make others lose any; rows that share an id
    don't make each other lose any, and meet in one task, which bounds how many there may
    be.  An empty table gives no rows.  Other columns are not carried.
    """
    rows = only(docs, doc_id, text).select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    groups = exchange.groups_for(rows)
    grouped = id_groups(rows, groups)

    def keys_of(table: pa.Table, _):
        _, known = _known(table)
        keys, _, owner, _ = _windows(raw_texts(table.column("text")), width)
        return np.unique(keys[known[owner]]), []

    def seen_before(run, first, payload, keys):
        return [(~first).astype(np.uint8)], []  # equal keys stand by group, so the first group's is new

    def finish(table: pa.Table, _, replies: list[np.ndarray], told) -> pa.Table:
        ids, known = _known(table)
        texts = raw_texts(table.column("text"))
        keys, start, owner, ends = _windows(texts, width)
        valid = known[owner]
        keys, start, owner = keys[valid], start[valid], owner[valid]
        distinct, at = np.unique(keys, return_inverse=True)
        earlier = replies[0]
        least = np.full(len(distinct), np.iinfo(np.int64).max)
        np.minimum.at(least, at, ids[owner])
        repeated = (earlier[at] > 0) | (ids[owner] > least[at])
        # words covered: a window opens at its first word and closes after its last
        depth = np.zeros(int(ends[-1]) + 1, np.int64)
        np.add.at(depth, start[repeated], 1)
        np.add.at(depth, start[repeated] + width, -1)
        gone = np.cumsum(depth[:-1]) > 0
        out = {"n_words": [], "n_removed": [], "removed": [], "kept": []}
        for i, raw in enumerate(texts):
            mine = gone[ends[i]:ends[i + 1]]
            words = raw.split()
            n = int(mine.sum())
            edges = np.flatnonzero(np.diff(np.concatenate([[False], mine, [False]]).astype(np.int8)))
            if n:
                words = [w for w, g in zip(words, mine.tolist()) if not g]
            out["n_words"].append(len(mine))
            out["n_removed"].append(n)
            out["removed"].append([{"start": a, "end": b} for a, b in edges.reshape(-1, 2).tolist()])
            out["kept"].append(b" ".join(words).decode())
        return pa.table({"doc_id": table.column("doc_id"), **out}, schema=RESULT_ARROW)

    side = exchange.no_side(docs)
    replies = exchange.replied(exchange.asked(grouped, keys_of, groups, side), seen_before)
    return exchange.finished(grouped, replies, finish, RESULT, side)
