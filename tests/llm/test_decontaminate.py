"""Planted items, word for word and reworded; recall of the latent search."""

import random

import numpy as np
import pytest

from waybill.llm import decontaminate as d
from waybill.llm import queries


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_longest_common_subsequence():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(1, 80))] for _ in range(2))
        assert d.common_subsequence(np.array(a), np.array(b))[0] == lcs(a, b)


def test_frequencies_and_sketch_are_those_of_the_passages(spark):
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, 9, n) for n in (0, 5, 20, 45, 133)]
    b = d.Blocks(texts)
    table = rng.normal(size=(9, 3)).astype(np.float32)
    table[0] = 0
    rows = b.of_passages(b.sums(table))
    want = []
    for t in texts:
        starts = [0] if 0 < len(t) <= d.HALF else range(0, len(t) - d.HALF, d.HALF)
        want += [table[t[s:s + d.WINDOW]].sum(axis=0) for s in starts]
    assert np.allclose(rows, want, atol=1e-4)


@pytest.fixture(scope="module")
def planted(spark, sf_dir):
    """Documents with an item in every tenth, some of its words changed, lost or put in."""
    rng = random.Random(0)
    items = [tuple(r) for r in queries.read(spark, sf_dir, "benchmark").select("item_id", "text").collect()]
    rows, truth = [], set()
    for r in queries.read(spark, sf_dir, "documents").select("doc_id", "text").orderBy("doc_id").collect():
        words = (r["text"] or "").split()
        if r["doc_id"] % 10 == 0:
            item, text = rng.choice(items)
            how = r["doc_id"] // 10 % 4
            new = [x for w in text.split() for x in (
                [w] if how == 0 else [w if rng.random() > 0.1 else "qqq"] if how == 1
                else [w] * (rng.random() > 0.1) if how == 2 else [w, "qqq"] if rng.random() < 0.15 else [w]
            )]
            at = rng.randrange(len(words) + 1)
            words[at:at] = new
            truth.add((r["doc_id"], item, how))
        rows.append((r["doc_id"], " ".join(words)))
    return spark.createDataFrame(rows, "doc_id long, text string"), rows, items, truth


def test_planted_items_are_found(spark, sf_dir, planted):
    docs, rows, items, truth = planted
    found = {(r["doc_id"], r["item_id"]) for r in d.find(docs, queries.read(spark, sf_dir, "benchmark")).collect()}
    assert {(i, item) for i, item, how in truth if how == 0} <= found
    changed = {(i, item) for i, item, how in truth if how}
    assert len(changed & found) >= 0.9 * len(changed)
    # nothing else but what holds an item word for word already
    def norm(t):
        return b" " + b" ".join(d.plain_words(t.encode())) + b" "

    exact = {(i, item) for i, t in rows for item, x in items if norm(x) in norm(t)}
    assert exact <= found
    assert found - exact <= changed


def test_nulls_blocks_and_empty_tables(spark, docs, monkeypatch):
    text = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    table = docs([(1, None), (2, ""), (3, f"x y {text}, z"), (None, text.upper()), (4, "alpha mu " * 30_000), (3, text)])
    items = spark.createDataFrame([(7, text), (8, None), (None, text), (9, ""), (10, "nu xi omicron pi rho")], "item_id long, text string")
    monkeypatch.setattr(d, "BLOCK_WORDS", 5)  # several blocks
    got = sorted(((r["doc_id"], r["item_id"], r["kind"], r["start"], r["end"]) for r in d.find(table, items).collect()), key=repr)
    assert got == sorted([(3, 7, "copy", 2, 14), (3, 7, "copy", 0, 12), (None, 7, "copy", 0, 12)], key=repr)
    assert d.find(table.limit(0), items).count() == 0
    assert d.find(table, items.limit(0)).count() == 0


def brute_force(texts, items):
    """The final rule at every passage for every item: (text, item, common words)."""
    out = {}
    for t, text in enumerate(texts):
        last = max(1, -(-len(text) // d.HALF) - 1)
        for i, item in enumerate(items.words):
            for start in range(0, last * d.HALF, d.HALF):
                span = text[max(0, start - len(item) // 2):start + d.WINDOW + len(item) // 2]
                length, end = d.common_subsequence(item, span)
                if length < d.PARAPHRASED * len(item):
                    continue
                _, back = d.common_subsequence(item[::-1], span[:end][::-1])
                answer = items.answers[i]
                rare = np.unique(answer[IDF[answer] >= np.median(IDF[answer])])
                answered = np.isin(rare, span).mean() >= d.ANSWERED
                if length >= d.COPIED * len(item) or answered and back <= 2 * len(item):
                    out[t, i] = max(out.get((t, i), 0), length)
    return {(t, i, n) for (t, i), n in out.items()}


IDF = np.append(0, np.linspace(1, 9, 900)).astype(np.float32)


def test_all_that_the_rule_accepts_is_found(monkeypatch):
    """With ``exact``: items of all lengths at all offsets among other words of the vocabulary,
    whatever the latent space says."""
    rng = random.Random(3)
    vocabulary = [f"w{n:03}" for n in range(900)]
    weights = [1 / (n + 1) for n in reversed(range(900))]  # the last are the most common, IDF says the opposite

    def some(n):
        return rng.choices(vocabulary, weights, k=n)

    items = d.Items([(-1, " ".join(vocabulary))] + [
        (n, " ".join(some(size - size // 3)) + ". " + " ".join(some(size // 3))) for n, size in enumerate([3, 8, *range(12, 60, 4), 150])
    ])
    ranked = {w: n for w, n in items.vocabulary.items()}
    texts, copies = [np.zeros(0, np.int64), np.array([0, 1])], set()
    for i, item in list(enumerate(items.words))[1:]:
        for how in range(4):
            for _ in range(2):
                rare = sorted(item, key=lambda w: -IDF[w])[:len(item) // 3]
                new = [x for w in item.tolist() for x in (
                    [w] if how == 0 else [rng.choice([0, 1])] * (rng.random() > 0.5) if how == 1 and rng.random() < 0.2
                    else [0] if how == 2 and w in rare else [w, 0] if how == 3 and rng.random() < 0.4 else [w]
                )]
                before, after = ([ranked[w.encode()] for w in some(rng.randrange(70))] for _ in range(2))
                if how == 0:
                    copies.add((len(texts), i, len(item)))
                texts.append(np.array(before + new + after))
    latent = np.random.default_rng(4).normal(size=(items.size, 5)).astype(np.float32)
    finder = d.Finder(items, IDF[:items.size], latent, exact=True)
    want = brute_force(texts, items)
    assert copies <= want and len(want) > 2 * len(copies)
    for places in (2_000_000, 50):  # in one piece and in many
        monkeypatch.setattr(d, "PLACES", places, raising=False)
        hits = finder.hits(texts)
        assert {(h[0], h[1], h[4]) for h in hits} == want
        assert all(-1.001 <= h[8] <= 1.001 for h in hits)


def test_passages_of_the_search():
    """Whole and half windows every step, and those of short texts; cosines against plain sums."""
    rng = np.random.default_rng(9)
    items = d.Items([(0, " ".join(f"a{i}" for i in range(20))), (1, " ".join(f"b{i}" for i in range(45))), (2, " ".join(f"c{i}" for i in range(130)))])
    latent = rng.normal(size=(items.size, 6)).astype(np.float32)
    latent[0] = 0
    texts = [rng.integers(0, items.size, n) for n in (0, 1, 9, 20, 45, 133)]
    texts += [np.concatenate([texts[4], items.words[i], texts[3]]) for i in range(3)]
    finder = d.Finder(items, np.ones(items.size, np.float32), latent)
    want = set()
    for i, item in enumerate(items.words):
        parts = [item] if len(item) <= d.LONGEST else [item[a:a + d.WINDOW] for a in range(0, len(item) - d.HALF, d.HALF)]
        size = d.HALF if len(item) <= d.SHORT else d.WINDOW
        margin = max(len(item) - d.STEP, len(item) // 2) if size == d.HALF else len(item) // 2
        for t, text in enumerate(texts):
            for at in range(0, len(text), d.STEP):
                if at and -(-(len(text) - at) // d.STEP) < size // d.STEP:
                    continue
                row = latent[text[at:at + size]].sum(axis=0)
                sums = [latent[p].sum(axis=0) for p in parts]
                cosine = max((row @ x / max(np.linalg.norm(row) * np.linalg.norm(x), 1e-9) for x in sums), default=0)
                span = text[max(0, at - margin):at + size + margin]
                common = sum(n for w, n in zip(*np.unique(item, return_counts=True)) if w in span)
                if cosine >= d.COSINE and common >= np.ceil(d.PARAPHRASED * len(item)):
                    want.add((t, i, max(0, at - margin), min(len(text), at + size + margin)))
    b, item, begin, end, cosine = finder.near(texts)
    text = finder._text_at(b, begin)
    start = b.text_starts[text]
    assert set(zip(text.tolist(), item.tolist(), (begin - start).tolist(), (end - start).tolist())) == want
    assert {(6, 0), (7, 1), (8, 2)} <= {w[:2] for w in want} and (cosine >= d.COSINE - 1e-6).all()


def test_recall_of_the_search(spark, sf_dir):
    """Copies, a fifth of the words changed, and the rarer words replaced, among many items,
    against all that the final rule accepts."""
    rng = random.Random(1)
    texts = sorted({r["text"] for r in queries.read(spark, sf_dir, "documents").collect() if r["text"] and len(r["text"].split()) > 80})
    rng.shuffle(texts)
    items = []
    for text in texts[:300]:
        words = text.split()
        for _ in range(3):
            n = rng.randrange(15, 60)
            at = rng.randrange(len(words) - n + 1)
            items.append(words[at:at + n])
    rows, truth = [], {}
    df = {}
    for text in texts:
        for w in set(d.plain_words(text.encode())):
            df[w] = df.get(w, 0) + 1
    for k, text in enumerate(texts[300:450]):
        words, item, how = text.split(), rng.randrange(len(items)), k % 3
        new = list(items[item])
        rare = sorted(range(len(new) - 6), key=lambda j: df.get(d.plain(new[j].encode()), 0))[:int(0.3 * len(new))]
        for j in range(len(new)):
            if how == 1 and rng.random() < 0.2 or how == 2 and j in rare:
                new[j] = rng.choice(words)
        at = rng.randrange(len(words) + 1)
        words[at:at] = new
        rows.append((k, " ".join(words)))
        truth[k, item] = how
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    asked = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    found, every = (
        {(r["doc_id"], r["item_id"]) for r in d.find(docs, asked, exact=exact).collect()} for exact in (False, True)
    )
    for how in range(3):
        accepted = {pair for pair, h in truth.items() if h == how} & every
        assert len(accepted) > 25 and len(accepted & found) >= 0.9 * len(accepted)
    assert len(found & every) >= 0.9 * len(every)
