"""The prefix trie, its list ranking and its digests against plain walks."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from waybill.llm import digests, listrank, trie
from waybill.operators import skew


def walked(rows):
    """The trie of (conv_id, turn, role, text, extra) rows with every conversation as it is."""
    convs = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            said = text or ""
            convs.setdefault(c, []).append(
                ((turn is not None, turn or 0), role or "", hashlib.md5(said.encode()).hexdigest(), said)
            )
    return measured({c: [(r, t) for _, r, _, t in sorted(v)] for c, v in convs.items()})


def measured(convs):
    nodes = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for key, members in nodes.items():
        below = [k for k in nodes if k[:len(key)] == key]
        kids = [k for k in below if len(k) == len(key) + 1]
        leaves = [k for k in below if not any(len(o) == len(k) + 1 and o[:len(k)] == k for o in nodes)]
        saved = sum((len(nodes[k]) - 1) * len(k[-1][1].encode().split()) for k in below if k)
        ended = ",".join(map(str, sorted(c for c in members if len(convs[c]) == len(key))))
        out.append((
            min(members), len(key), min(nodes[key[:-1]]) if key else None, len(members), len(kids), len(leaves), saved,
            hashlib.sha256(ended.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn int, role string, text string, depth string"


def of(spark, rows):
    turns = trie.turns_of(spark.createDataFrame(rows, SCHEMA))
    out = trie.trie(turns, turns.select("conv_id").distinct())
    got = [tuple(r[n] for n in NAMES) for r in out.collect()]
    return sorted(got, key=repr)


def test_small_tables(spark):
    rows = [
        (1, 0, "user", "a b", "x"), (1, 1, "bot", "c", "x"), (2, 0, "user", "a b", "x"), (2, None, "bot", "c", "x"),
        (3, 0, "user", "a b", "x"), (3, 0, "user", "a b", "x"), (4, 0, None, None, "x"), (5, 1, "", "", "x"),
        (-6, 0, "use", "ra b", "x"), (None, 0, "user", "a b", "x"), (7, 0, "user", "a\tb c  d", None),
        (8, 0, "user", "a b", "x"), (8, 1, "bot", "c", "x"), (9, 0, "b", "z", "x"), (9, 0, "a", "z", "x"), (9, 0, "a", "y", "x"),
        (30, 0, "user", "word " * 100_000, "x"), (31, 0, "user", "word " * 100_000, "x"),
    ]
    assert of(spark, rows) == walked(rows)
    assert of(spark, [(None, 0, "user", "a", "x")]) == of(spark, []) == []


def test_random_conversations(spark, monkeypatch):
    monkeypatch.setattr(listrank, "ROWS", 50)
    monkeypatch.setattr(listrank.prefix_sums, "__defaults__", (50,))
    chance = random.Random(5)
    rows = [
        (c, t, chance.choice("ab"), chance.choice(["x", "y z", None]), "q")
        for c in range(-20, 60) for t in range(chance.randrange(1, 7))
    ]
    assert of(spark, rows) == walked(rows)


def test_long_and_popular(spark, monkeypatch):
    """One long conversation, and one node with most of the children, cut like hot keys."""
    hot = skew.HotKeys(slots=64, factor=2, floor_rows=40)
    plain = skew.with_running

    def split(*args, **kwargs):
        return plain(*args, **kwargs, hot=hot)

    monkeypatch.setattr(trie, "with_running", split)
    rows = [(1, t, "user", f"w{t} v", "q") for t in range(150)] + [(c, 0, "user", f"own {c}", "q") for c in range(2, 200)]
    rows += [(c, 0, "user", "w0 v", "q") for c in range(300, 330)]
    assert of(spark, rows) == walked(rows)


def test_branches(spark):
    rows = [(c, t, "user", f"{c}.{t}", "q") for c in (0, 3, 20, 21, 45, 46, 47) for t in range(c % 5 + 1)]
    turns = trie.turns_of(spark.createDataFrame(rows, SCHEMA))
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    new, convs = trie.branched(turns, F.col("conv_id") - F.col("conv_id") % 20, shared, 3)
    out = trie.trie(new, convs).collect()
    own = {}
    for c, _, role, text, _ in rows:
        own.setdefault(c, []).append((role, text))
    built = {}
    for c, said in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = own.get(c - c % 20, [])[:h] + said[h:]
    assert sorted([tuple(r[n] for n in NAMES) for r in out], key=repr) == measured(built)
    # the tour's intervals are nested, and every subtree is the nodes inside
    for r in out:
        inside = [o for o in out if r.enter <= o.enter and o.leave <= r.leave]
        assert len(inside) == (r.leave - r.enter + 1) // 2
        assert sum(o.n_children == 0 for o in inside) == r.n_leaves


@pytest.mark.parametrize("local", [True, False])
def test_list_ranking(spark, local):
    n, chance = 4000, random.Random(1)
    keys = [(i // 5 - 100, i % 5) for i in range(n)]
    if not local:
        chance.shuffle(keys)
    weights = [(chance.randrange(5), 1) for _ in keys]
    rows = [(*k, *(keys[i + 1] if i + 1 < n else (0, -1)), *w) for i, (k, w) in enumerate(zip(keys, weights))]
    links = spark.createDataFrame(rows, "a long, b long, next_a long, next_b long, w0 long, w1 long")
    got = {(r.a, r.b): (r.o0, r.o1) for r in listrank.prefix_sums(links, 2, rows=300).collect()}
    ahead = np.cumsum([(0, 0), *weights], axis=0)
    assert got == {k: tuple(ahead[i].tolist()) for i, k in enumerate(keys)}


def test_digests_of_lists_in_many_batches(spark):
    lists = {(1, 0): list(range(-30000, 30000)), (1, 1): [5], (2, 0): [7, 1 << 40]}
    rows = [(*k, v) for k, vs in lists.items() for v in vs]
    random.Random(2).shuffle(rows)
    out = digests.joined_sha256(spark.createDataFrame(rows, "k long, l long, v long").repartition(7), ["k", "l"], "v", "sha")
    assert {(r.k, r.l): r.sha for r in out.collect()} == {
        k: hashlib.sha256(",".join(map(str, sorted(v))).encode()).hexdigest() for k, v in lists.items()
    }
