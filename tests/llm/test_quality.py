"""Held-out accuracy, and what a score may depend on."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from waybill.llm import quality, queries


@pytest.fixture(scope="module")
def scored(spark, sf_dir):
    return queries.op6_quality(spark, sf_dir).collect()


def test_held_out_rows(scored):
    for r in scored:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)


def test_held_out_accuracy(spark, sf_dir, scored):
    labels = {r["doc_id"]: r["quality"] for r in queries.read(spark, sf_dir, "labels").collect()}
    held = [(r["score"], r["predicted"], labels[r["doc_id"]]) for r in scored if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([p == q for _, p, q in held]) >= 0.95
    good, bad = ([s for s, _, q in held if q == c] for c in (1, 0))
    assert np.mean([[g > b for b in bad] for g in good]) >= 0.97


def test_scores_follow_the_text_alone(spark, docs):
    model = np.zeros(quality.BUCKETS + 1, np.float32)
    model[:-1] = np.random.default_rng(1).normal(size=quality.BUCKETS)
    texts = [None, "", " \n", "a", "One two, three!", "x" * 70_000, "word " * 20_000, "é日🙂\x00"]
    table = docs([(i, t) for i, t in enumerate(texts)] + [(None, "a")])
    got = {r["doc_id"]: r["score"] for r in quality.classify(table, model).collect()}
    alone = quality.scores([(t or "").encode() for t in texts], model)
    one = [quality.scores([(t or "").encode()], model)[0] for t in texts]
    assert np.allclose(alone, one) and np.allclose([got[i] for i in range(len(texts))], one)
    assert got[None] == got[3] and got[0] == got[1] == 0.5
    assert quality.classify(table.limit(0), model).count() == 0
    with pytest.raises(ValueError, match="score"):
        quality.classify(table.withColumn("score", F.lit(1)), model)


def test_few_or_no_labels(spark, docs):
    table = docs([(1, "a b c"), (3, "d e f")])
    for rows in ([], [(1, 1)], [(1, None), (None, 0)]):
        labels = spark.createDataFrame(rows, "doc_id long, quality int")
        assert quality.classify(table, quality.fit(table, labels)).count() == 2


def step_by_step(texts, labels):
    """The same training, one feature and one row at a time, in doubles."""
    rng = np.random.default_rng(quality.SEED)
    bags = []
    for t in texts:
        ids, _ = quality.features([t])
        bags.append({int(i): sum(ids == i) / len(ids) for i in set(ids.tolist())})
    embed = (rng.random((quality.BUCKETS, quality.DIMENSIONS)) - 0.5) / quality.DIMENSIONS
    layer, bias = np.zeros((quality.DIMENSIONS, 2)), np.zeros(2)
    share = [sum(labels == c) / len(labels) for c in (0, 1)]
    steps, step = quality.EPOCHS * -(-len(bags) // quality.BATCH), 0
    for _ in range(quality.EPOCHS):
        order = rng.permutation(len(bags))
        for begin in range(0, len(order), quality.BATCH):
            rate = quality.RATE * (1 - step / steps)
            step += 1
            rows = order[begin:begin + quality.BATCH].tolist()
            layer_step, bias_step, embed_steps = np.zeros_like(layer), np.zeros(2), []
            for i in rows:
                vector = sum(part * embed[b] for b, part in bags[i].items())
                odds = np.exp(vector @ layer + bias)
                error = odds / odds.sum() - np.eye(2)[labels[i]]
                error *= 0.5 / share[labels[i]]
                layer_step += np.outer(vector, error) / len(rows)
                bias_step += error / len(rows)
                pull = np.clip(layer @ error / len(rows), -quality.LARGEST_STEP, quality.LARGEST_STEP)
                embed_steps.append((i, rate * len(rows) * pull))
            layer -= rate * layer_step
            bias -= rate * bias_step
            for i, pull in embed_steps:
                for b, part in bags[i].items():
                    embed[b] -= part * pull
    return np.append(embed @ (layer[:, 1] - layer[:, 0]), bias[1] - bias[0])


def test_training_is_gradient_descent_on_the_softmax(monkeypatch):
    monkeypatch.setattr(quality, "BATCH", 3)
    monkeypatch.setattr(quality, "EPOCHS", 2)
    texts = [f"{'good words' if i % 3 else 'bad text'} number {i}".encode() for i in range(10)]
    labels = np.array([int(i % 3 > 0) for i in range(10)])
    got, want = quality.train(texts, labels), step_by_step(texts, labels)
    assert np.abs(want).max() > 0.01
    assert np.allclose(got, want, rtol=1e-3, atol=1e-4)


def test_the_sample_is_bounded_in_rows_and_bytes(spark, docs, monkeypatch):
    monkeypatch.setattr(quality, "TRAIN_TEXT", 100)
    rows = [(2, "good text")] * 50 + [(2, "other")] * 50 + [(3, "bad")] * 50 + [(3, "x" * 1000), (5, "y" * 1000)]
    labels = spark.createDataFrame([(2, 1), (3, 0), (5, 1)], "doc_id long, quality int")
    ids = [i for i in (2, 3, 5) if zlib.crc32(str(i).encode()) % 4 != 2]
    texts = {2: b"good text", 3: b"bad"}
    kept = [i for i in ids if i in texts]
    model = quality.fit(docs(rows), labels)
    if len({i == 2 for i in kept}) == 2:
        want = quality.train([texts[i] for i in kept], np.array([int(i == 2) for i in kept]))
        assert np.allclose(model, want)
    else:
        assert not model[:-1].any()
