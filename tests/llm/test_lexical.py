"""Ranked search against a direct computation, list by list and over tables."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from waybill.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def direct(docs, items, k):
    """The k best by scoring every document."""
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    count, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, wanted in asked.items():
        scored = []
        for i, b in bags:
            m = 100 - 50 + (50 * sum(b.values()) * count) // total
            s = sum(
                math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * ((10**9 * b[t]) // (1000 * b[t] + 20 * m))
                for t in wanted if t in b
            )
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def table(spark, rows, schema):
    return spark.createDataFrame([(*r, "x") for r in rows], schema)


def found(spark, docs, items, k):
    out = lexical.search(
        table(spark, docs, "doc_id long, text string, score string"), table(spark, items, "item_id long, text string, rank string"), k
    )
    return sorted([tuple(r) for r in out.select("item_id", "rank", "doc_id", "score").collect()], key=repr)


def test_cases(spark):
    docs = [
        (1, "Alpha beta, GAMMA"), (2, "alpha alpha"), (3, None), (4, ""), (5, "..."), (6, "alpha beta gamma"), (6, "alpha beta gamma"),
        (None, "beta"), (None, "beta"), (7, "ÄÖ äö É42 beta_alpha"), (8, "delta " * 50_000 + "beta"), (9, "beta"),
    ]
    items = [
        (1, "alpha? Beta!"), (2, "äö É42"), (3, None), (4, "--"), (5, "nowhere"), (6, "delta"), (6, "gamma delta"), (None, "beta"),
        (7, "alpha alpha gamma"), (7, "alpha alpha gamma"),
    ]
    for k in (1, 3, 50):
        assert found(spark, docs, items, k) == direct(docs, items, k)
    assert found(spark, [], items, 3) == found(spark, docs, [], 3) == []
    assert found(spark, docs, [(1, None), (2, "...")], 3) == []


@pytest.mark.parametrize("size, shards", [(4, 1 << 20), (5, 40), (90, 200)])
def test_random_texts_in_many_shards(spark, monkeypatch, size, shards):
    """With long queries, many ties, and shards of a few documents."""
    monkeypatch.setattr(lexical, "SHARD_POSTINGS", shards)
    monkeypatch.setattr(lexical, "READ", 2)
    monkeypatch.setattr(lexical, "BLOCK_TERMS", 200)
    rng = np.random.default_rng(size)
    words = [f"w{int(i)}" for i in rng.zipf(1.3, 40_000) % 300]
    docs = [(int(rng.integers(0, 350)), " ".join(words[a:a + int(rng.integers(1, 40))])) for a in rng.integers(0, 39_000, 400)]
    items = [(i, " ".join(words[a:a + size])) for i, a in enumerate(rng.integers(0, 39_000, 12).tolist())]
    assert found(spark, docs, items, 10) == direct(docs, items, 10)


def test_reading_stops_early():
    """Most of a list's end is never read when a few documents stand out."""
    n = 20_000
    rng = np.random.default_rng(0)
    tf = np.append(rng.integers(1, 3, n), [200] * 5)
    row = {
        "docs": np.arange(n + 5).tobytes(), "known": np.ones(n + 5, bool).tobytes(),
        "sizes": np.full(n + 5, 300).tobytes(), "term": np.zeros(n + 5, "<i4").tobytes(),
        "doc": np.arange(n + 5, dtype="<i4").tobytes(), "tf": tf.astype("<i4").tobytes(),
    }
    shard = lexical.Shard(row, n + 5, 300 * (n + 5), np.array([700]))
    reads = []

    class Seen(np.ndarray):
        def __getitem__(self, at):
            if isinstance(at, slice):
                reads.append(at.stop - at.start)
            return super().__getitem__(at)

    shard.doc = shard.doc.view(Seen)
    got, scores = shard.search(np.array([0]), 5, 0)
    assert got.tolist() == list(range(n, n + 5)) and len(set(scores.tolist())) == 1
    assert sum(reads) < 1000
