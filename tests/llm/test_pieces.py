"""Encoding and decoding against the library itself."""

import hashlib

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from waybill.llm import pieces, queries

PATH = pieces.default_path()
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
MODEL = pieces.Pieces(PATH)


def check(texts):
    got = MODEL.encode(texts)
    want = LIBRARY.encode([t or "" for t in texts], num_threads=1)
    assert [list(g) for g in got] == want
    flat = np.concatenate([np.zeros(0, np.int64), *got]).astype(np.int64)
    ends = np.append(0, np.cumsum([len(g) for g in got]))
    assert MODEL.decode(flat, ends) == [LIBRARY.decode(w) for w in want]


def test_odd_texts():
    check([
        None, "", " ", "  ", "▁", "▁ ▁x", " a", "a ", "\n\t", "\x00a\x00", "<s>", "<unk></s>", "<0x0A>", "日本語の文字", "🙂é",
        "ing" * 300, "process" * 3 + " with" * 50, "a" * 5000, "x" + " " * 1000 + "y", " " * 40,
    ])


def test_a_very_long_run_of_spaces_and_a_word_without_end():
    check([" " * 50_000 + "end", "abcab" * 20_000])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(
    st.sampled_from("ab the in▁ \n.é日🙂"), st.characters(exclude_categories=["Cs"]),
), max_size=60), min_size=1, max_size=5))
def test_any_text(texts):
    check(texts)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 31_999)), max_size=12))
def test_decoding_any_ids(ids):
    got = MODEL.decode(np.array(ids, np.int64), np.array([0, len(ids)]))[0]
    assert got == LIBRARY.decode(ids)


def test_query_against_the_library(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in queries.read(spark, sf_dir, "documents").collect()}
    rows = queries.op8_sentencepiece(spark, sf_dir).collect()
    assert len(rows) == len(texts)

    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    for r in rows:
        ids = LIBRARY.encode(texts[r["doc_id"]] or "")
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == digest(",".join(map(str, ids)))
        assert r["decoded_sha256"] == digest(LIBRARY.decode(ids))


def test_empty_tables_nulls_and_clashing_names(spark, docs):
    rows = docs([(1, None), (2, ""), (2, "a b"), (None, "a b")], extra="decoded")
    with pytest.raises(ValueError, match="decoded"):
        pieces.decode(pieces.encode(rows))
    out = pieces.decode(pieces.encode(rows), text="back").collect()
    assert [(r["doc_id"], r["decoded"], list(r["ids"]), r["back"]) for r in out][:2] == [(1, "x", [], ""), (2, "x", [], "")]
    assert [r["back"] for r in out][2:] == ["a b", "a b"]
    assert pieces.decode(pieces.encode(rows.limit(0)), text="back").count() == 0
