"""Every stage on what its predecessor kept, against the operators' own checks."""

import hashlib

import pytest
import sentencepiece

import corpus_pipeline
from test_jaccard import brute_force
from test_secrets import base
from waybill.llm import decontaminate, pieces, quality, queries
from waybill.llm.store import stored


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs = queries.read(spark, sf_dir, "documents")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], sf_dir)))
    return out


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_columns_and_rows_shrink(stages):
    for before, after in zip(stages[:-2], stages[1:-1]):
        assert after.columns == before.columns
        assert after.count() <= before.count()


def test_rejected_documents_go(spark, sf_dir, stages):
    labels = {r["doc_id"]: r["quality"] for r in queries.read(spark, sf_dir, "labels").collect()}
    kept = {i for i, _ in rows(stages[1])}
    good = [i for i, q in labels.items() if q == 1]
    bad = [i for i, q in labels.items() if q == 0]
    assert sum(i in kept for i in good) >= 0.95 * len(good)
    assert sum(i in kept for i in bad) <= 0.1 * len(bad)


def test_one_of_each_class_stays(stages):
    wanted = {c for _, _, c in brute_force(rows(stages[1]))}
    assert sorted(i for i, _ in rows(stages[2])) == sorted(wanted)


def test_benchmark_documents_go(spark, sf_dir, stages):
    def norm(t):
        return b" " + b" ".join(decontaminate.plain_words((t or "").encode())) + b" "

    items = [norm(r["text"]) for r in queries.read(spark, sf_dir, "benchmark").collect()]
    held = {i for i, t in rows(stages[2]) if any(x in norm(t) for x in items)}
    kept = {i for i, _ in rows(stages[3])}
    assert held and kept == {i for i, _ in rows(stages[2])} - held


def test_secrets_are_masked(stages):
    before, after = dict(rows(stages[3])), dict(rows(stages[4]))
    assert before.keys() == after.keys()
    assert any(base(t) for t in before.values())
    for i, t in after.items():
        assert not base(t)
        if t != before[i]:
            assert "[secret]" in t
    lengths = {r["doc_id"]: (r["n_chars"], r["text"]) for r in stages[4].collect()}
    assert all(n == len(t) for n, t in lengths.values())


def test_ids_are_the_library_s(stages):
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.default_path())
    texts = dict(rows(stages[4]))
    last = stages[5].collect()
    assert len(last) == len(texts)
    for r in last:
        assert list(r["ids"]) == library.encode(texts[r["doc_id"]])
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(list(r["ids"])).encode()).hexdigest()


def test_threshold_is_the_query_s():
    assert quality.PREDICTED == 0.7


def test_stages_with_nulls_repeats_and_clashing_names(spark, sf_dir):
    """Every name that a stage uses inside is a user's column here."""
    item = queries.read(spark, sf_dir, "benchmark").first()["text"]
    good = queries.read(spark, sf_dir, "documents").join(
        queries.read(spark, sf_dir, "labels").filter("quality = 1"), "doc_id"
    ).limit(3).select("doc_id", "text").collect()
    rows = [(r["doc_id"], r["text"]) for r in good] + [
        (None, good[0]["text"] + " " + item), (7, item), (7, "another text under one id " * 9), (7, item), (8, None), (8, None), (9, ""),
        (10, "token=abcdefgh " * 3), (11, "word " * 200_000),
    ]
    names = "quality_score keep_row text_digest spans found_hex found_base kept_0 node label ids numbers score g".split()
    docs = spark.createDataFrame(
        [(i, t, "en", "s", len(t or ""), *range(len(names))) for i, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} int" for n in names),
    )
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns, name
            assert all(tuple(r)[5:] == tuple(range(len(names))) for r in out.collect()), name
            assert stage(spark, docs.limit(0), sf_dir).count() == 0
    clean = dict(corpus_pipeline.STAGES)["benchmark decontamination"](spark, docs, sf_dir)
    kept = sorted(((r["doc_id"], (r["text"] or "")[:20]) for r in clean.collect()), key=repr)
    assert (None, good[0]["text"][:20]) not in kept and kept.count((8, "")) == 2
    assert [k for k in kept if k[0] == 7] == [(7, "another text under o")]
