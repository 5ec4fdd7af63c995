"""Compare a registered query with its SQL on the same tables."""

from __future__ import annotations

import datetime as dt
import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET threads = 4")
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            source = f"{path}/*.parquet" if path.is_dir() else str(path)
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{source}')")
    return con


def _plain(value):
    if isinstance(value, dt.datetime):
        assert value.tzinfo is None
        return value.isoformat()
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


SPARK_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN",
    "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP",
}


def compare(df, con, sql) -> int:
    """Fails on the first difference; returns the number of rows."""
    result = con.execute(sql)
    types = {d[0]: str(d[1]) for d in result.description}
    want_columns, want = _sorted_rows(list(types), result.fetchall())
    got_columns, got = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    assert got_columns == want_columns, (got_columns, want_columns)
    for name, spark_type in df.dtypes:
        assert SPARK_TYPES.get(spark_type) == types[name].split("_")[0], (name, spark_type, types[name])
    assert len(got) == len(want), f"{len(got)} rows, not {len(want)}"
    for mine, theirs in zip(got, want):
        assert mine == theirs, f"{mine}\n  is not\n{theirs}"
    return len(got)
