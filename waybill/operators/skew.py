"""Keys that hold a large share of the rows.

Two tools: ``with_running`` computes running values per key in arrival order
without ever putting a hot key into one task, and ``sized_broadcast`` hands a
table to every task only after its size has been checked.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.session import materialise, size_in_bytes


@dataclass(frozen=True)
class HotKeys:
    """When a key counts as hot.

    Keys are counted by hash slot, so the count shuffles at most ``slots`` rows
    per task.  A slot is hot when it has more than ``floor_rows`` rows and more
    than ``factor`` times the average slot; hence at most ``slots / factor``
    slots are hot, however large the table.  Taking too many or too few keys
    for hot changes the plan's cost, never its result.
    """

    slots: int = 65_536
    factor: int = 8
    floor_rows: int = 1_000_000

    def slot(self, key: str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.slots)).cast("int")

    def find(self, keys: DataFrame, key: str) -> list[int]:
        """Runs the count; the slots come back as a short list."""
        return sorted(self.find_rows(keys, key))

    def find_rows(self, keys: DataFrame, key: str) -> dict[int, int]:
        """The hot slots and their rows."""
        counted = keys.groupBy(self.slot(key).alias("slot")).agg(F.count(F.lit(1)).alias("rows"))
        gathered = counted.agg(
            F.sum("rows").alias("total"), F.collect_list(F.struct("slot", "rows")).alias("slots")
        )
        busy = F.filter(
            "slots",
            lambda s: (s["rows"] > self.floor_rows)
            & (s["rows"] * self.slots > F.col("total") * self.factor),
        )
        return {s["slot"]: s["rows"] for s in gathered.select(busy.alias("hot")).first()["hot"]}


class NoHotKeys(HotKeys):
    """For rows of so few keys that counting them would cost more than it saves."""

    def find_rows(self, keys: DataFrame, key: str) -> dict[int, int]:
        return {}


@dataclass(frozen=True)
class Running:
    """One running value: ``kind`` is count, sum (of values without nulls), last (ignoring nulls) or max."""

    name: str
    kind: str
    value: Column | None = None

    def over(self, window) -> Column:
        """The value within one chunk."""
        if self.kind == "count":
            return F.count(F.lit(1)).over(window)
        if self.kind == "sum":
            return F.sum(self.value).over(window)
        if self.kind == "last":
            return F.last(self.value, ignorenulls=True).over(window)
        return F.max(self.value).over(window)

    def total(self, position: Column) -> Column:
        """What a whole chunk contributes; a last value carries its position along."""
        if self.kind == "count":
            return F.count(F.lit(1))
        if self.kind == "sum":
            return F.sum(self.value)
        if self.kind == "last":
            placed = F.struct(position.alias("p"), self.value.alias("v"))
            return F.max(F.when(self.value.isNotNull(), placed))
        return F.max(self.value)

    def carried(self, total: str, before) -> Column:
        """What the chunks before contribute together."""
        if self.kind in ("count", "sum"):
            return F.sum(total).over(before)
        if self.kind == "last":
            return F.last(total, ignorenulls=True).over(before)["v"]
        return F.max(total).over(before)

    def joined(self, mine: Column, carry: Column) -> Column:
        if self.kind in ("count", "sum"):
            return mine + F.coalesce(carry, F.lit(0))
        if self.kind == "last":
            return F.coalesce(mine, carry)
        return F.greatest(mine, carry)


FIRST = "first_value"


def with_running(
    df: DataFrame,
    key: str,
    order: list[str],
    chunk: list[Column],
    values: list[Running],
    first: Column | None = None,
    hot: HotKeys | None = None,
    keys: DataFrame | None = None,
    carry: DataFrame | None = None,
) -> DataFrame:
    """``df`` with one more column per running value, per ``key`` in the total
    order of the columns ``order``; each value includes its own row.

    ``first``, if given, is evaluated on a key's first row and put on all of its
    rows as ``first_value``, which the running values may refer to.

    The keys are counted beforehand (in ``keys``, which may be a cheaper table), so
    building the plan runs jobs.  Without a hot key this is a plain window per key.

    Otherwise hot keys' rows are written once, all others take the plain window, and
    each hot key is cut into chunks of its arrival order, about ``floor_rows / 4``
    rows each, at quantiles of the first of the columns ``chunk`` (a number, a date
    or a time, a prefix of ``order`` or growing with it).  A single value that fills
    chunks of its own is cut by the other columns of ``chunk``.  So the chunks
    depend on the number of rows, not on how fine the times are.  Their totals are
    aggregated; then the rows are shuffled by key and chunk, and each chunk runs on
    its own, on top of the totals of the chunks before it.

    ``carry`` has what came before all these rows, for keys that had any: one row per
    key with the values' last results by their names and, where ``first`` is given, the
    key's ``first_value``.  Rows then go on from there, so that parts of a table in
    their order of arrival give what the whole table gives.

    Rows without a key belong to no group; their values mean nothing.
    """
    hot = hot or HotKeys()
    kept = df.columns
    found = hot.find_rows((df if keys is None else keys).select(key), key)
    if carry is not None:
        df = df.join(carry.select(key, F.struct(*[c for c in carry.columns if c != key]).alias(CARRY)), key, "left")
    if not found:
        return _resumed(_plain(df, key, order, values, first), kept, values, first)
    is_hot = F.coalesce(hot.slot(key).isin(*found), F.lit(False))
    pieces = -(-max(found.values()) * 4 // max(hot.floor_rows, 1))
    rows = _chunked(materialise(df.filter(is_hot)), key, chunk, min(max(pieces, 2), MOST_CHUNKS))
    return _resumed(
        _plain(df.filter(~is_hot), key, order, values, first).unionByName(
            _split(rows, df.columns, key, order, values, first)
        ), kept, values, first,
    )


CARRY = "_carry"


def _resumed(rows: DataFrame, kept: list[str], values: list[Running], first: Column | None) -> DataFrame:
    """The values on top of those that the key had before."""
    if CARRY not in rows.columns:
        return rows
    return rows.select(
        *kept, *([] if first is None else [FIRST]),
        *[v.joined(F.col(v.name), F.col(f"{CARRY}.{v.name}")).alias(v.name) for v in values],
    )


def _first_of_all(rows: DataFrame, own: Column) -> Column:
    """A key's first value: the one it had before these rows, if there were any."""
    if CARRY not in rows.columns:
        return own
    return F.when(F.col(CARRY).isNotNull(), F.col(f"{CARRY}.{FIRST}")).otherwise(own)


MOST_CHUNKS = 10_000


def _running(*group: str, order: list[str]):
    return Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _plain(df: DataFrame, key: str, order: list[str], values: list[Running], first: Column | None) -> DataFrame:
    here = _running(key, order=order)
    rows = df if first is None else df.withColumn(FIRST, _first_of_all(df, F.first(first).over(here)))
    return rows.select("*", *[v.over(here).alias(v.name) for v in values])


def _chunked(rows: DataFrame, key: str, chunk: list[Column], pieces: int) -> DataFrame:
    """Adds ``_chunk``, which grows with the order of arrival."""
    value = chunk[0]
    cuts = rows.groupBy(key).agg(
        F.percentile_approx(value, [i / pieces for i in range(1, pieces)], max(10_000, 20 * pieces)).alias("_cuts")
    )
    # the last cut of each block of them, so that a row looks at two short lists
    step = max(1, math.isqrt(pieces))
    last = F.filter("_cuts", lambda _, i: (i + 1) % step == 0)
    met = rows.join(sized_broadcast(cuts.withColumn("_last", last)), key, "left").withColumn("_at", value)

    def before(fits) -> Column:
        """How many cuts, which are sorted, come before the first that doesn't fit."""
        blocks = F.size(F.filter("_last", fits))
        return blocks * step + F.size(F.filter(F.slice("_cuts", blocks * step + 1, F.lit(step)), fits))

    # a value that is a cut is a chunk of its own, between those on either side
    below = before(lambda c: c < F.col("_at"))
    upto = before(lambda c: c <= F.col("_at"))
    full = upto - below > 1
    place = F.struct(
        F.when(F.col("_cuts").isNull(), 0).otherwise(below + upto).alias("c0"),
        *[F.when(full, c).alias(f"c{i}") for i, c in enumerate(chunk[1:], 1)],
    )
    return met.withColumn("_chunk", place).drop("_cuts", "_last", "_at")


def _split(
    rows: DataFrame, kept: list[str], key: str, order: list[str], values: list[Running], first: Column | None
) -> DataFrame:
    group = [key, "_chunk"]
    here = _running(*group, order=order)
    carry = sized_broadcast(_chunk_totals(rows, key, order, values, first))
    # Said outright: rows that lie partitioned by key alone would do for the
    # windows below, and leave the hot key where it is.
    rows = rows.repartition(*group).join(carry, group, "left")
    if first is not None:
        own = F.when(F.col("_first").isNotNull(), F.col("_first.v")).otherwise(F.first(first).over(here))
        rows = rows.withColumn(FIRST, _first_of_all(rows, own))
        kept = [*kept, FIRST]
    rows = rows.select("*", *[v.over(here).alias(f"_here_{v.name}") for v in values])
    return rows.select(
        *kept, *[v.joined(F.col(f"_here_{v.name}"), F.col(f"_c_{v.name}")).alias(v.name) for v in values]
    )


def _chunk_totals(
    rows: DataFrame, key: str, order: list[str], values: list[Running], first: Column | None
) -> DataFrame:
    """Per key and chunk what came before it, and the key's first value."""
    position = F.struct(*order)
    if first is not None:
        wrapped = F.min(F.struct(position.alias("p"), first.alias("v"))).alias("_first")
        firsts = sized_broadcast(rows.groupBy(key).agg(wrapped))
        rows = rows.join(firsts, key)
        rows = rows.withColumn(FIRST, _first_of_all(rows, F.col("_first.v")))
    totals = rows.groupBy(key, "_chunk").agg(
        *[v.total(position).alias(f"_c_{v.name}") for v in values],
        *([] if first is None else [F.min("_first").alias("_first")]),
    )
    before = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        key, "_chunk",
        *[v.carried(f"_c_{v.name}", before).alias(f"_c_{v.name}") for v in values],
        *([] if first is None else ["_first"]),
    )


BROADCAST_BYTES = 64 << 20


def sized_broadcast(small: DataFrame, max_rows: int = 1_000_000, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``small`` written out and counted; marked for broadcast only if it has at
    most ``max_rows`` rows and ``max_bytes`` in its files, else left to a shuffled
    join (which adaptive execution splits where a key is hot)."""
    kept = materialise(small)
    fits = size_in_bytes(kept) <= max_bytes and kept.count() <= max_rows
    return F.broadcast(kept) if fits else kept
