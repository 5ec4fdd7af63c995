"""Loss differences against counting by hand."""

import math
from collections import Counter

import pytest

from waybill.llm import scoring


END = None


def models(texts):
    """Per model: token counts, bigram counts; and the vocabulary with the end of texts."""
    count = {m: (Counter(), Counter()) for m in (True, False)}
    vocabulary = set()
    for words, m in texts:
        if words:
            one, two = count[m]
            one.update([*words, END])
            two.update(zip([END, *words], [*words, END]))
            vocabulary |= {*words, END}
    return count, vocabulary


def probability(one, two, vocabulary, v, w):
    total = max(sum(one.values()), 1)
    plain = one[w] / total
    after = two[v, w] / one[v] if one[v] > 0 else plain
    return scoring.BIGRAM * after + scoring.WORD * plain + scoring.FLOOR / len(vocabulary)


def brute_force(rows, wanted):
    texts = [((t or "").encode().lower().split(), i in wanted and i is not None) for i, t in rows]
    count, vocabulary = models(texts)
    out = []
    for (i, _), (words, mine) in zip(rows, texts):
        losses = []
        tokens = [*words, END] if words else []
        for m in (True, False):
            one, two = count[m]
            if m == mine:
                one, two = one - Counter(tokens), two - Counter(zip([END, *words], tokens))
            losses.append(sum(
                round(-math.log(probability(one, two, vocabulary, v, w)) * scoring.MICRO)
                for v, w in zip([END, *words], tokens)
            ))
        score = (losses[0] - losses[1]) / len(tokens) / scoring.MICRO if words else None
        out.append((i, mine, len(tokens), *losses, score))
    return sorted(out, key=repr)


def test_probabilities_sum_to_one():
    """Over all that may follow a word, the start included, with a text's own counts off or not."""
    texts = [(b"a b a c".split(), True), (b"b a".split(), True), (b"c c d".split(), False), ([], True)]
    count, vocabulary = models(texts)
    for m in (True, False):
        for own in ([], [t for t, mine in texts if mine == m][0]):
            one = count[m][0] - Counter([*own, END] if own else [])
            two = count[m][1] - Counter(zip([END, *own], [*own, END]) if own else [])
            if sum(one.values()):
                for v in vocabulary:
                    assert math.isclose(sum(probability(one, two, vocabulary, v, w) for w in vocabulary), 1)


def test_against_counting(spark, docs):
    rows = [(i, f"good words make good text number {i % 3}") for i in range(8)]
    rows += [(100 + i, f"bad words spoil text {i} x x x") for i in range(9)]
    rows += [(1, "another row of one id"), (50, None), (51, ""), (None, "good words"), (52, "One"), (53, "a b " * 3000)]
    wanted = {*range(8), 51, 52, 777}
    ids = spark.createDataFrame([(i,) for i in [*wanted, None, 3]], "doc_id long")
    table = docs(rows, extra="target_id").repartition(4)
    got = sorted((tuple(r) for r in scoring.cross_entropy_difference(table, ids).collect()), key=repr)
    want = brute_force(rows, wanted)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    for g, w in zip(got, want):
        assert g[3:5] == pytest.approx(w[3:5], abs=2) and (g[5] is None) == (w[5] is None)
    scores = {g[0]: g[5] for g in got}
    assert scores[2] < 0 < scores[105]


def test_no_targets_and_no_rows(spark, docs):
    none = spark.createDataFrame([], "doc_id long")
    assert scoring.cross_entropy_difference(docs([(1, "a b")]), none).first()["in_target"] is False
    assert scoring.cross_entropy_difference(docs([(1, "a")]).limit(0), none).count() == 0
