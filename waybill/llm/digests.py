"""Digests of long sorted lists, one per key, without gathering a list anywhere."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

EMPTY = hashlib.sha256(b"").hexdigest()


def _runs(batch: pa.RecordBatch, keys: list[str]) -> list[int]:
    """Where runs of equal keys (longs, not null) begin, and the end."""
    columns = [batch.column(k).to_numpy() for k in keys]
    new = np.zeros(batch.num_rows, bool)
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    new[:1] = True
    return [*np.flatnonzero(new).tolist(), batch.num_rows]


def joined_sha256(rows: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Per key the lowercase SHA-256 hex of its values, as decimals by size, joined by commas.

    Keys and values are longs without nulls.  A key's values are sorted across tasks, each
    of which writes its stretch of them as text; a digest must run over all of them in
    order, so one task reads a key's stretches, one batch at a time.
    """

    def stretches(batches):
        for batch in batches:
            cuts = _runs(batch, keys)
            values = batch.column(value).to_pylist()
            at = pa.array(cuts[:-1], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(at) for c in [*keys, value]),
                 pa.array([",".join(map(str, values[x:y])).encode() for x, y in zip(cuts[:-1], cuts[1:])], pa.binary())],
                names=[*keys, value, "stretch"],
            )

    def digests(batches):
        current, digest = None, None
        for batch in batches:
            done, hexes = [], []
            for key, text in zip(zip(*(batch.column(k).to_pylist() for k in keys)), batch.column("stretch").to_pylist()):
                if key == current:
                    digest.update(b",")
                else:
                    if current is not None:
                        done.append(current), hexes.append(digest.hexdigest())
                    current, digest = key, hashlib.sha256()
                digest.update(text)
            yield _finished(done, hexes)
        if current is not None:
            yield _finished([current], [digest.hexdigest()])

    def _finished(done, hexes):
        columns = list(zip(*done)) if done else [[] for _ in keys]
        return pa.RecordBatch.from_arrays(
            [*(pa.array(c, pa.int64()) for c in columns), pa.array(hexes, pa.string())], names=[*keys, name]
        )

    longs = ", ".join(f"{k} long" for k in keys)
    cut = (
        rows.select(*keys, value).repartitionByRange(*keys, value).sortWithinPartitions(*keys, value)
        .mapInArrow(stretches, f"{longs}, {value} long, stretch binary")
    )
    return cut.repartition(*keys).sortWithinPartitions(*keys, value).mapInArrow(digests, f"{longs}, {name} string")
