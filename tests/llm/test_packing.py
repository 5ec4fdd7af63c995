"""Packing against a piece-by-piece best fit and the tokenizer itself."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from waybill.llm import packing, queries


def piece_by_piece(lengths, size):
    """What each window holds, by a walk over all open windows."""
    windows = []
    for length in sorted(lengths, reverse=True):
        fits = [w for w in windows if size - sum(w) >= length]
        if fits:
            max(fits, key=sum).append(length)
        else:
            windows.append([length])
    return windows


def contents(plan, counts, size):
    """What each window of a plan holds, and that its pieces follow each other."""
    placer = packing.Placer(plan, size, 1 << 30)
    held = {}
    for length, n in counts.items():
        window, offset, here = placer.place(np.full(n, length), np.arange(n))
        assert (here == length).all()
        for w, o in zip(window.tolist(), offset.tolist()):
            held.setdefault(w, []).append((o, length))
    out = []
    for w in range(plan.windows):
        at, row = 0, sorted(held[w])
        for o, length in row:
            assert o == at
            at += length
        out.append([length for _, length in row])
    return out


@settings(deadline=None, max_examples=150)
@given(st.lists(st.integers(1, 32), max_size=120), st.sampled_from([32, 33, 48]))
def test_runs_of_windows_are_best_fit_piece_by_piece(lengths, size):
    counts = dict(Counter(lengths))
    plan = packing.best_fit(counts, size)
    got = Counter(tuple(sorted(w)) for w in contents(plan, counts, size))
    want = Counter(tuple(sorted(w)) for w in piece_by_piece(lengths, size))
    # windows with equal room are alike, so only what is filled counts
    assert Counter(map(sum, got.elements())) == Counter(map(sum, want.elements()))
    assert plan.windows == sum(want.values())


@settings(deadline=None, max_examples=100)
@given(st.lists(st.integers(1, 32), max_size=120), st.integers(0, 8))
def test_windows_cut_anew_are_full(lengths, slack):
    counts = dict(Counter(lengths))
    placer = packing.Placer(packing.best_fit(counts, 32), 32, slack)
    filled = Counter()
    for length, n in counts.items():
        window, offset, here = placer.place(np.full(n, length), np.arange(n))
        filled.update(Counter(dict.fromkeys(window.tolist(), 0)))
        for w, o, h in zip(window.tolist(), offset.tolist(), here.tolist()):
            assert o + h <= 32
            filled[w] += h
            if h < length:
                assert o + h == 32
                filled[w + 1] += length - h
    assert sum(filled.values()) == sum(lengths)
    assert sorted(filled) == list(range(len(filled)))
    padding = packing.padding(np.array([filled[w] for w in sorted(filled)], np.int64), 32)
    assert (padding > slack).sum() <= 1


def test_segment_tree():
    tree, there = packing.Capacities(37), set()
    chance = random.Random(3)
    for _ in range(3000):
        at = chance.randrange(38)
        if chance.random() < 0.5:
            tree.put(at, True), there.add(at)
        else:
            tree.put(at, False), there.discard(at)
        ask = chance.randrange(38)
        assert tree.first_from(ask) == min((t for t in there if t >= ask), default=None)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(packing.default_path())


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END]


TEXTS = [
    "It's  we'll\tSAY 　so\x1c\x0b end", "é ́x café\ń", "ΣΑΣ ΑΣ İstanbul ǅ",
    "<|endoftext|> a<|endoftext|>b <|startoftext|>", "<| <|x", "日本語 テスト 🙂🙂", "123 45'd 'tis 's", " ", "",
]


@settings(deadline=None, max_examples=200)
@given(st.text(alphabet=st.sampled_from(list("aB'sé́ \t\n\x1c <|>12.!日Σİ")), max_size=40))
def test_words_alone_give_the_ids_of_the_text(text):
    mine = packing.loaded(packing.default_path())
    assert mine.ids(text.encode()).tolist() == mine.tokenizer.encode(text, add_special_tokens=False).ids


def check(rows, texts, tokenizer, size=packing.SIZE):
    """Every id in one piece, every sequence without a gap; the share of padding."""
    want = Counter((i, tuple(ids_of(tokenizer, t))) for i, t in texts)
    pieces, sequences = {}, {}
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length > 0
        pieces.setdefault(r.doc_id, []).append((r.start, ids, r.doc_tokens))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    if len({i for i, _ in texts}) == len(texts):
        for (i, ids), n in want.items():
            mine = sorted(pieces[i])
            at = 0
            for start, part, tokens in mine:
                assert start == at and tokens == len(ids)
                at += len(part)
            assert [x for _, part, _ in mine for x in part] == list(ids)
    assert sorted(sequences) == list(range(len(sequences)))
    filled = []
    for row in sequences.values():
        at = 0
        for offset, length in sorted(row):
            assert offset == at
            at += length
        assert at <= size
        filled.append(at)
    assert sum(filled) == sum(len(ids) * n for (_, ids), n in want.items())
    return packing.padding(np.array(filled, np.int64), size).sum() / max(1, sum(filled))


def test_small_tables(spark, docs, tokenizer):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(100, None), (101, "word " * 40_000), (102, "x" * 5000)]
    assert check(packing.pack(docs(rows, extra="slice")).collect(), rows, tokenizer) < 0.06
    twice = [(7, "a b c"), (7, "a b c"), (None, "d"), (None, "d")]
    got = packing.pack(docs(twice, extra="sequence_id")).collect()
    check(got, twice, tokenizer)
    assert [r.doc_id for r in got].count(None) == 2 and len(got) == 4
    assert packing.pack(docs([])).collect() == []


def test_small_windows_are_cut_anew(spark, docs, tokenizer):
    rows = [(i, "a b c d e f g h"[: 2 * (i % 8)]) for i in range(101)]
    out = packing.pack(docs(rows), size=8, slack=0).collect()
    padded = check(out, rows, tokenizer, 8)
    assert padded * sum(r.length for r in out) < 8  # one window


def test_query(spark, sf_dir, tokenizer):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert check(packing.pack(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect(), texts, tokenizer) < 0.005
    row = queries.op11_packing(spark, sf_dir).orderBy("doc_id", "start").first()
    ids = ids_of(tokenizer, dict(texts)[row.doc_id])[: row.length]
    assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
