"""Exact similarity classes of documents by the Jaccard index of their word shingles.

Shingles are ordered globally, rare ones first (document frequency over the different
texts, then hash).  Two texts that are similar enough share a shingle among the first
few of both, which gives candidates.  A candidate pair's intersection is counted by
vertical partitioning: the global order is cut into fragments, each fragment of the
two sets is intersected on its own, and the partial counts are summed per pair.

Where two texts meet at their first common shingle, all that they have in common lies
from there on in the order.  So a text says at each of its rare shingles how large a
partner may be whose intersection could still be enough (``room``), and two texts are
a pair only where each fits into the other's room.

Classes are wanted, not all pairs, so a crowd of near copies is compared with a few
leaders at a time.  Within the texts that share a rare shingle, a leader is compared
with all that aren't in its class yet and then never again; classes merge; texts that
fit nobody of another class under a shingle leave it; and this goes on, with four times
as many leaders each time, until no shingle has two classes whose texts could fit.
Leaders are the texts with the fewest shingles of their own, the common origin of near
copies if it is there.  No link is lost, and a crowd that is one class costs one
comparison a text instead of one a pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.llm import exchange
from waybill.llm.graph import components as connected
from waybill.llm.store import only, stored, unused
from waybill.llm.words import hand_back, raw_texts, rolling, word_hashes
from waybill.operators.skew import sized_broadcast

SIZE = 5
PERCENT = 80
FRAGMENTS = 4
CODE_BITS = 48  # of a shingle's hash, for ordering and counting
DF_LIMIT = (1 << 15) - 1

SETS = "node binary, id long, n long, s long, rare array<long>, marks array<long>, ordered binary"
SETS_ARROW = pa.schema([
    ("node", pa.binary()), ("id", pa.int64()), ("n", pa.int64()), ("s", pa.int64()), ("rare", pa.list_(pa.int64())),
    ("marks", pa.list_(pa.int64())), ("ordered", pa.binary()),
])


def shingle_sets(texts: list[bytes], size: int = SIZE) -> list[np.ndarray]:
    """Each text's distinct shingle hashes; shorter texts are one shingle, empty ones none."""
    hashes, ends = word_hashes([t.lower() for t in texts])  # bytes: A to Z only
    windows = rolling(hashes, size)
    sets = []
    for begin, end in zip(ends[:-1].tolist(), ends[1:].tolist()):
        count = end - begin
        if count >= size:
            sets.append(np.unique(windows[begin:end - size + 1]))
        elif count:
            sets.append(rolling(hashes[begin:end], count) + np.uint64(count))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def _codes(one: np.ndarray) -> np.ndarray:
    return np.unique(one >> np.uint64(64 - CODE_BITS))


def _different(table: pa.Table) -> pa.Table:
    nodes = table.column("node").to_pylist()
    seen: dict[bytes, int] = {}
    for i, node in enumerate(nodes):
        seen.setdefault(node, i)
    return table.take(pa.array(sorted(seen.values())))


def _one_of_each(batches):
    """Drops copies that one task meets, so that a crowd of copies doesn't travel."""
    seen: set[bytes] = set()
    for batch in batches:
        hand_back()
        nodes = batch.column("node").to_pylist()
        fresh = []
        for i, node in enumerate(nodes):
            if node not in seen:
                seen.add(node)
                fresh.append(i)
        yield batch if len(fresh) == len(nodes) else batch.take(pa.array(fresh, pa.int64()))
        del batch, nodes
    hand_back()


def sets_of(texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Per different text (node, text): a number for it, set size, how many of its shingles
    other texts have (``s``), and for those that may have a partner the rare shingles to
    meet on and all shared ones in global order.

    Numbers count within a group, so only a written table of these rows has one numbering.
    """
    groups = exchange.groups_for(texts)
    grouped = texts.mapInArrow(_one_of_each, texts.schema).select(
        exchange.hashed_group(F.col("node"), groups).alias("g"), "node", "text"
    )

    def keys_of(table: pa.Table, _):
        flat = np.concatenate([_codes(s) for s in shingle_sets(raw_texts(_different(table).column("text")), size)])
        flat.sort()
        first = np.flatnonzero(np.append(True, flat[1:] != flat[:-1])) if len(flat) else np.zeros(0, np.int64)
        return flat[first], [np.diff(np.append(first, len(flat)))]

    def frequency(run, first, payload, keys):
        return [np.minimum(np.bincount(run, payload[0]).astype(np.int64)[run], DF_LIMIT)], []

    def finish(table: pa.Table, _, replies: list[np.ndarray], told) -> pa.Table:
        table = _different(table)
        sets = shingle_sets(raw_texts(table.column("text")), size)
        codes = [_codes(s) for s in sets]
        keys = np.unique(np.concatenate(codes))
        known = replies[0]
        rare, marks, ordered, common = [], [], [], []
        for one, code in zip(sets, codes):
            n = len(one)
            df = known[np.searchsorted(keys, code)]
            shared = df > 1
            common.append(int(shared.sum()))
            if not n or 100 * int(shared.sum()) < percent * n:  # no text shares enough of it
                rare.append([]), marks.append([]), ordered.append(None)
                continue
            order = np.sort((df[shared].astype(np.uint64) << np.uint64(CODE_BITS)) | code[shared])
            first = n + (-percent * n) // 100 + 1 - (n - len(order))
            rare.append(order[:max(first, 1)].astype(np.int64))
            marks.append(order[len(order) * np.arange(1, FRAGMENTS) // FRAGMENTS].astype(np.int64))
            ordered.append(exchange.pack(order))
        first_id = table.column("g")[0].as_py() << 32
        return pa.table({
            "node": table.column("node"), "id": range(first_id, first_id + len(sets)), "n": [len(s) for s in sets],
            "s": common, "rare": rare, "marks": marks, "ordered": ordered,
        }, schema=SETS_ARROW)

    side = exchange.no_side(texts)
    replies = exchange.replied(exchange.asked(grouped, keys_of, groups, side, CODE_BITS), frequency)
    return exchange.finished(grouped, replies, finish, SETS, side)


def fragments(sets: DataFrame) -> DataFrame:
    """(id, f, part): each set's shingles, cut where the global order is cut."""
    at = [i / FRAGMENTS for i in range(1, FRAGMENTS)]
    marks = sets.select(F.explode("marks").alias("m"))
    cuts = np.array(marks.select(F.percentile_approx("m", at).alias("q")).first()["q"] or [], np.uint64)

    def cut(batches):
        for batch in batches:
            ids, fs, parts = [], [], []
            for one, data in zip(batch.column("id").to_pylist(), batch.column("ordered").to_pylist()):
                order = exchange.unpack(data)
                for f, part in enumerate(np.split(order, np.searchsorted(order, cuts))):
                    if len(part):
                        ids.append(one), fs.append(f), parts.append(exchange.pack(part))
            yield pa.RecordBatch.from_pydict({
                "id": pa.array(ids, pa.int64()), "f": pa.array(fs, pa.int32()), "part": pa.array(parts, pa.binary()),
            })

    return sets.filter("ordered is not null").select("id", "ordered").mapInArrow(
        cut, "id long, f int, part binary"
    )


def _counted(batches):
    for batch in batches:
        counts = [
            len(np.intersect1d(exchange.unpack(x), exchange.unpack(y), assume_unique=True))
            for x, y in zip(batch.column("part_a").to_pylist(), batch.column("part_b").to_pylist())
        ]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("a", "b", "n_a", "n_b")), pa.array(counts, pa.int64())],
            names=["a", "b", "n_a", "n_b", "both"],
        )


SALTS = 16


def linked(pairs: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b, n_a, n_b) whose texts are similar.

    ``a`` are leaders: few, but one may stand in very many pairs, so its parts are
    laid out SALTS times.
    """
    leaders = parts.join(pairs.select(F.col("a").alias("id")).distinct(), "id", "left_semi")
    leaders = leaders.select(
        F.col("id").alias("a"), "f", F.col("part").alias("part_a"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"),
    )
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int"))
    others = parts.select(F.col("id").alias("b"), "f", F.col("part").alias("part_b"))
    return (
        salted.join(leaders, ["a", "salt"]).join(others, ["b", "f"])
        .select("a", "b", "n_a", "n_b", "part_a", "part_b")
        .mapInArrow(_counted, "a long, b long, n_a long, n_b long, both long")
        .groupBy("a", "b", "n_a", "n_b").agg(F.sum("both").alias("both"))
        .filter(100 * F.col("both") >= percent * (F.col("n_a") + F.col("n_b") - F.col("both")))
        .select("a", "b")
    )


def _postings(sets: DataFrame, percent: int) -> DataFrame:
    """(t, id, n, room, own, label): a text under each of its rare shingles.

    ``room`` is the largest partner whose intersection, if it lies from ``t`` on, can be
    enough; ``own`` the shingles that no other text has.
    """
    left = F.col("s") - F.col("place")
    return sets.select("id", "n", "s", F.posexplode("rare").alias("place", "t")).select(
        "t", "id", "n", (F.floor(left * (100 + percent) / percent) - F.col("n")).cast("long").alias("room"),
        (F.col("n") - F.col("s")).alias("own"), F.col("id").alias("label"),
    )


POSTING = ["t", "id", "n", "room", "own", "label"]


def _open(postings: DataFrame) -> DataFrame:
    """The postings that could fit one of another class under their shingle: by the
    smallest text and the widest room there, or those of another label than the text's."""
    met = postings.join(
        postings.groupBy("t").agg(
            F.min("label").alias("x"), F.max("label").alias("y"),
            F.min(F.struct("n", "label")).alias("small"), F.max(F.struct("room", "label")).alias("wide"),
        ).filter("x <> y").select("t", "small", "wide"), "t",
    )
    is_small, is_wide = F.col("label") == F.col("small.label"), F.col("label") == F.col("wide.label")
    second = met.groupBy("t").agg(
        F.min(F.when(~is_small, F.col("n"))).alias("next_small"), F.max(F.when(~is_wide, F.col("room"))).alias("next_wide")
    )
    fits = (
        (F.col("room") >= F.when(is_small, F.col("next_small")).otherwise(F.col("small.n")))
        & (F.col("n") <= F.when(is_wide, F.col("next_wide")).otherwise(F.col("wide.room")))
    )
    return met.join(second, "t").filter(fits).select(*POSTING)


def classes(sets: DataFrame, percent: int) -> DataFrame:
    """(id, label) of the texts that have links."""
    spark = sets.sparkSession
    parts = stored(fragments(sets))
    postings = stored(_open(_postings(sets, percent)))
    found = None
    slots = 1
    while not postings.isEmpty():
        slot = F.pmod(F.xxhash64("label", F.lit(slots)), F.lit(slots))
        leaders = postings.groupBy("t", slot.alias("slot")).agg(
            F.min(F.struct("own", (-F.col("room")).alias("less"), "id", "n", "label")).alias("leader")
        ).select(
            "t", F.col("leader.n").alias("n_a"), (-F.col("leader.less")).alias("room_a"),
            F.col("leader.id").alias("a"), F.col("leader.label").alias("label_a"),
        )
        pairs = stored(postings.join(leaders, "t").filter(
            (F.col("label") != F.col("label_a"))
            & (F.col("n") <= F.col("room_a")) & (F.col("n_a") <= F.col("room"))
            & (100 * F.least("n", "n_a") >= percent * F.greatest("n", "n_a"))
        ).select("a", F.col("id").alias("b"), "n_a", F.col("n").alias("n_b"), "label_a", "label").distinct())
        edges = linked(pairs.select("a", "b", "n_a", "n_b"), parts, percent)
        edges = stored(edges.join(pairs.select("a", "b", "label_a", "label"), ["a", "b"]).select(
            F.col("label_a").alias("a"), F.col("label").alias("b")
        ).distinct())
        # leaders have met all others of their shingle
        postings = postings.join(leaders.select("t", F.col("a").alias("id")), ["t", "id"], "left_anti")
        if not edges.isEmpty():
            merged = connected(edges).select(F.col("node").alias("label"), F.col("label").alias("class"))
            if found is None:  # so far a text's label is the text
                found = merged.select(F.col("label").alias("id"), F.col("class").alias("label"))
            else:
                merged = sized_broadcast(merged)
                moved = found.join(merged, "label", "left").select("id", F.coalesce("class", "label").alias("label"))
                fresh = merged.join(found.select(F.col("id").alias("label")), "label", "left_anti")
                found = stored(moved.union(fresh.select("label", "class")))
            # by the text, as one label may have very many postings
            postings = postings.drop("label").join(found, "id", "left").withColumn("label", F.coalesce("label", "id"))
        postings = stored(_open(postings.select(*POSTING)))
        slots *= 4
    return found if found is not None else spark.createDataFrame([], "id long, label long")


def _noded(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, node, text): a node stands for all rows with one text."""
    words = F.coalesce(F.col(text), F.lit(""))
    return only(docs, doc_id, text).select(
        F.col(doc_id).cast("long").alias("doc_id"), node_of(words).alias("node"), words.alias("text")
    )


def node_of(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def _placed(docs: DataFrame, doc_id: str, text: str, size: int, percent: int) -> DataFrame:
    """(doc_id, node, label, n_shingles, component_id) of every row; a class has one label."""
    rows = _noded(docs, doc_id, text)
    sets = stored(sets_of(rows.select("node", "text"), size, percent))
    labels = classes(sets, percent)
    nodes = sets.select("node", "id", "n").join(labels, "id", "left").select(
        "node", F.col("n").alias("n_shingles"), F.coalesce("label", "id").alias("label")
    )
    placed = stored(rows.select("doc_id", "node").join(nodes, "node"))
    least = placed.filter("n_shingles > 0").groupBy("label").agg(F.min("doc_id").alias("least"))
    return placed.join(least, "label", "left").select(
        "doc_id", "node", "label", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def similar_classes(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, percent: int = PERCENT,
) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the smallest id reachable by links, its own included).

    Null and empty texts, and those of white space, have no shingles and no links.  Rows
    that share a text are linked; those with a null id take part without giving one.
    Other columns are not carried.
    """
    return _placed(docs, doc_id, text, size, percent).select("doc_id", "n_shingles", "component_id")


def one_of_each_class(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, percent: int = PERCENT,
) -> DataFrame:
    """The rows of ``docs`` that stay when one of each class does: the one with the smallest id.

    Rows without shingles all stay, but for repeated rows of one id; so do classes in
    which no row has an id.  All columns are carried.
    """
    placed = _placed(docs, doc_id, text, size, percent)
    # of rows that share the smallest id, one text
    keep = placed.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("doc_id", "label").agg(
        F.min("node").alias("node")
    )
    own = F.col(doc_id).cast("long")
    row = unused(docs.columns, "keep_row")
    here = docs.withColumn(row, F.struct(own.alias("i"), node_of(F.coalesce(F.col(text), F.lit(""))).alias("n")))
    wanted = keep.select(F.struct(F.col("doc_id").alias("i"), F.col("node").alias("n")).alias(row))
    return here.join(wanted, row, "left_semi").dropDuplicates([row]).drop(row)
