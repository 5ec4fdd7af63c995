"""Asking the whole corpus about 64-bit keys, group of documents by group.

Documents are dealt into groups that fit one task.  Each group sorts its distinct
keys (hashes of windows, n-grams, shingles) and sends them, cut by key range into
buckets, with a small payload per key.  A bucket sees every group's keys of its
range, answers each one, and the answers go back to the group in the same order.

A key goes out once for each group, however often the group's documents hold it, so
a key that a third of all documents share costs one row per group and no more.
Sorted keys are stored as differences of just the bytes needed, which is what keeps
the shuffle small.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.llm.store import shuffle_partitions
from waybill.llm.words import hand_back
from waybill.session import size_in_bytes

# Of stored input for one group of documents.  Small enough for executors of 3 GB; with
# larger ones, larger groups send fewer and longer rows.
GROUP_BYTES = 3 << 20

ASKED = "b int, g int, keys binary, payload binary"
REPLIED = "g int, b int, reply binary"
ASKED_ARROW = pa.schema([("b", pa.int32()), ("g", pa.int32()), ("keys", pa.binary()), ("payload", pa.binary())])
REPLIED_ARROW = pa.schema([("g", pa.int32()), ("b", pa.int32()), ("reply", pa.binary())])


UNKNOWN_BYTES = 1 << 50


def groups_for(df: DataFrame, text: str = "text") -> int:
    """Groups of about GROUP_BYTES, and no fewer than the shuffle's partitions.

    The size is the optimizer's, which for files is theirs; where it has none, the
    texts are measured.
    """
    size = size_in_bytes(df)
    if size >= UNKNOWN_BYTES:
        size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(shuffle_partitions(df), -(-size // GROUP_BYTES))


def hashed_group(key: Column, groups: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(groups)).cast("int")


def pack(keys: np.ndarray) -> bytes:
    """Ascending uint64 keys as a width, the first key, and differences of that width."""
    if not len(keys):
        return b""
    steps = np.diff(keys)
    width = max(1, (int(steps.max()).bit_length() + 7) // 8) if len(steps) else 1
    body = np.ascontiguousarray(steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width])
    return bytes([width]) + int(keys[0]).to_bytes(8, "little") + body.tobytes()


def unpack(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.uint64)
    width = data[0]
    body = np.frombuffer(data, np.uint8, offset=9).reshape(-1, width)
    wide = np.zeros((len(body) + 1, 8), np.uint8)
    wide[0] = np.frombuffer(data, np.uint8, 8, 1)
    wide[1:, :width] = body
    return np.cumsum(wide.reshape(-1).view("<u8"), dtype=np.uint64)


def packed_columns(columns: list[np.ndarray]) -> bytes:
    """Arrays of non-negative integers: a byte for each that is below 255, and the
    others apart, as most counts are small and a few very large."""
    out = []
    for values in columns:
        large = values >= 255
        body = np.where(large, 255, values).astype(np.uint8).tobytes()
        rest = values[large].astype("<i8").tobytes()
        out += [len(body).to_bytes(4, "little"), body, len(rest).to_bytes(4, "little"), rest]
    return b"".join(out)


def unpacked_columns(data: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(data):
        size = int.from_bytes(data[at:at + 4], "little")
        values = np.frombuffer(data, np.uint8, size, at + 4).astype(np.int64)
        at += 4 + size
        size = int.from_bytes(data[at:at + 4], "little")
        values[values == 255] = np.frombuffer(data, "<i8", size // 8, at + 4)
        at += 4 + size
        out.append(values)
    return out


def bucket_bounds(keys: np.ndarray, buckets: int, bits: int = 64) -> np.ndarray:
    """Where each bucket's range begins in the ascending keys (and the end)."""
    edges = np.array([(b << bits) // buckets for b in range(1, buckets)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def asked(
    grouped: DataFrame,
    keys_of: Callable[[pa.Table, pa.Table], tuple[np.ndarray, list[np.ndarray]]],
    buckets: int,
    side: DataFrame,
    bits: int = 64,
) -> DataFrame:
    """Rows (b, g, keys, payload): what each group ``g`` asks each bucket.

    Keys are evenly spread over ``bits`` bits, which the buckets' ranges share out.

    ``keys_of`` gets a group's rows and its rows of ``side``, and returns ascending
    distinct keys with any number of non-negative integers for each.  A group asks
    every bucket, if only with no keys, so that all learn what the buckets tell all.
    """

    def send(table: pa.Table, beside: pa.Table) -> pa.Table:
        if not table.num_rows:
            return ASKED_ARROW.empty_table()
        hand_back()
        keys, payload = keys_of(table, beside)
        g = table.column("g")[0].as_py()
        cuts = bucket_bounds(keys, buckets, bits).tolist()
        parts = list(zip(cuts[:-1], cuts[1:]))
        return pa.table({
            "b": pa.array(range(buckets), pa.int32()),
            "g": pa.array([g] * buckets, pa.int32()),
            "keys": pa.array([pack(keys[x:y]) for x, y in parts], pa.binary()),
            "payload": pa.array([packed_columns([p[x:y] for p in payload]) for x, y in parts], pa.binary()),
        }, schema=ASKED_ARROW)

    return grouped.groupBy("g").cogroup(side.groupBy("g")).applyInArrow(send, ASKED)


def replied(
    asks: DataFrame,
    answer: Callable[[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray], tuple[list[np.ndarray], list[int]]],
) -> DataFrame:
    """Rows (g, b, reply) for each (b, g).

    ``answer`` gets all entries of a bucket by key, then group: the number of each
    one's run of equal keys, whether it begins the run, the payload, and the keys.  It
    returns arrays with a value for each entry, and numbers for every group.
    """

    def reply(table: pa.Table) -> pa.Table:
        hand_back()
        groups = table.column("g").to_numpy()
        by = np.argsort(groups, kind="stable")
        keys = [unpack(table.column("keys")[int(i)].as_py()) for i in by]
        payloads = [unpacked_columns(table.column("payload")[int(i)].as_py()) for i in by]
        flat = np.concatenate(keys)
        order = np.argsort(flat, kind="stable")
        flat = flat[order]
        first = np.ones(len(flat), bool)
        first[1:] = flat[1:] != flat[:-1]
        payload = [np.concatenate(p)[order] for p in zip(*payloads)]
        del payloads
        values, told = answer(np.cumsum(first) - 1, first, payload, flat)
        back = []
        for column in values:
            out = np.empty_like(column)
            out[order] = column
            back.append(out)
        ends = np.cumsum([len(k) for k in keys])
        b = table.column("b")[0].as_py()
        return pa.table({
            "g": pa.array(groups[by], pa.int32()),
            "b": pa.array([b] * len(by), pa.int32()),
            "reply": pa.array([
                packed_columns([np.array(told, np.int64), *(v[end - len(k):end] for v in back)])
                for k, end in zip(keys, ends.tolist())
            ], pa.binary()),
        }, schema=REPLIED_ARROW)

    return asks.groupBy("b").applyInArrow(reply, REPLIED)


def finished(
    grouped: DataFrame,
    replies: DataFrame,
    finish: Callable[[pa.Table, pa.Table, list[np.ndarray], np.ndarray], pa.Table],
    schema: str,
    side: DataFrame,
) -> DataFrame:
    """What ``finish`` makes of each group's rows.

    It also gets the group's rows of ``side``, the replies' arrays in the order of the
    group's keys, and the sums of the numbers that the buckets tell all.
    """
    names = [c for c in side.columns if c != "g"]
    beside = replies.unionByName(side, allowMissingColumns=True)

    def each(table: pa.Table, back: pa.Table) -> pa.Table:
        hand_back()
        place = back.column("b").to_numpy(zero_copy_only=False)
        told = np.isfinite(place.astype(float))
        by = np.flatnonzero(told)[np.argsort(place[told], kind="stable")]
        parts = [unpacked_columns(back.column("reply")[int(i)].as_py()) for i in by]
        values = [np.concatenate(v) for v in list(zip(*parts))[1:]]
        total = np.sum([p[0] for p in parts], axis=0) if parts else np.zeros(0, np.int64)
        return finish(table, back.select(names).filter(pa.array(~told)), values, total)

    return grouped.groupBy("g").cogroup(beside.groupBy("g")).applyInArrow(each, schema)


def no_side(df: DataFrame) -> DataFrame:
    """Nothing beside the documents, without a Python worker to make it."""
    return df.sparkSession.range(0).select(F.col("id").cast("int").alias("g"))
