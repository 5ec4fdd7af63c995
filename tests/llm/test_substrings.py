"""Repeated windows against a direct walk over all of them."""

import random

from waybill.llm import exchange, substrings

WIDTH = 3


def brute_force(rows, width):
    """doc -> what is kept, word by word."""
    first = {}
    for i, text in rows:
        words = (text or "").encode().split()
        for at in range(len(words) - width + 1):
            if i is not None:
                key = tuple(words[at:at + width])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, text in rows:
        words = (text or "").encode().split()
        gone = set()
        for at in range(len(words) - width + 1):
            if i is not None and first[tuple(words[at:at + width])] < i:
                gone.update(range(at, at + width))
        kept = b" ".join(w for at, w in enumerate(words) if at not in gone).decode()
        out.append((i, len(words), len(gone), kept))
    return sorted(out, key=repr)


def got(df, width):
    rows = substrings.remove_repeats(df, width=width).collect()
    for r in rows:  # intervals are maximal and say what is gone
        ends = [(x["start"], x["end"]) for x in r["removed"]]
        assert sum(e - s for s, e in ends) == r["n_removed"]
        assert all(a[1] < b[0] for a, b in zip(ends, ends[1:]))
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in rows), key=repr)


def test_against_brute_force(spark, docs):
    rng = random.Random(3)
    rows = [(rng.randrange(40), " ".join(rng.choice("abcde") for _ in range(rng.randrange(12)))) for _ in range(60)]
    rows += [(50 + i, "one two three four five six") for i in range(20)]  # a crowd of copies
    rows += [(None, "one two three four"), (7, None), (8, ""), (9, " \t\n"), (10, "x\x0by\x0cz w v x y z")]
    df = docs(rows).repartition(5)
    assert got(df, WIDTH) == brute_force(rows, WIDTH)
    assert got(df, 1) == brute_force(rows, 1)
    assert got(df, 13) == brute_force(rows, 13)


def test_a_long_text_repeats_itself_freely(spark, docs):
    text = "a b c d " * 20_000
    rows = [(1, text), (2, "a b c d"), (1, text)]
    assert got(docs(rows), WIDTH) == brute_force(rows, WIDTH)


def test_empty_table(spark, docs):
    assert substrings.remove_repeats(docs([(1, "a")]).limit(0)).count() == 0


def test_packing():
    import numpy as np

    rng = np.random.default_rng(1)
    for keys in ([], [5], [0, 2**64 - 1], sorted({int(x) for x in rng.integers(0, 2**63, 1000)})):
        keys = np.array(keys, np.uint64)
        assert (exchange.unpack(exchange.pack(keys)) == keys).all()
    columns = [np.array([0, 254, 255, 256, 2**40]), np.zeros(0, np.int64)]
    back = exchange.unpacked_columns(exchange.packed_columns(columns))
    assert [b.tolist() for b in back] == [c.tolist() for c in columns]


def test_buckets_share_out_the_range_of_the_keys():
    import numpy as np

    for bits in (48, 64):
        keys = np.sort(np.random.default_rng(2).integers(0, 1 << bits, 10_000, dtype=np.uint64))
        sizes = np.diff(exchange.bucket_bounds(keys, 10, bits))
        assert sizes.sum() == 10_000 and sizes.min() > 800 and sizes.max() < 1200
