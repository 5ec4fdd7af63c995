"""A text classifier with learned subword embeddings, trained by stochastic gradient descent.

A text's features are its words and the character n-grams of each word, between
boundary marks, hashed into BUCKETS rows of an embedding table.  The text's vector is
the mean of its features' rows; a softmax layer makes two probabilities of it.

Embeddings and output layer are trained on at most TRAIN_ROWS labelled rows of each
class (those whose ids hash lowest; whole texts), in one task.  The trained model is
linear in the features, so for scoring it is folded into one number per bucket:
1 MB, whatever the corpus, which is broadcast; scoring is one pass without a shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.llm.store import only
from waybill.llm.words import hand_back, raw_texts

BITS = 18
BUCKETS = 1 << BITS
NGRAMS = (3, 4)
DIMENSIONS = 16
TRAIN_ROWS = 1500  # of each class: the bound of the training sample
TRAIN_TEXT = 1 << 18  # bytes of a text in it
EPOCHS = 10
RATE = 2.0
BATCH = 8
LARGEST_STEP = 5.0  # of a text's gradient, so that training can't run away
SEED = 7
REPEATED_FROM = 5  # bytes of a word that may count as repeated
PREDICTED = 0.7

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
# Characters are told apart by class in a second view of each word, so that a word
# never seen still shows whether it is shouted, bare, or wrapped in signs.
SHAPES = np.full(256, ord("s"), np.uint8)
SHAPES[[*range(0x30, 0x3A)]] = ord("0")
SHAPES[[*range(0x41, 0x5B)]] = ord("A")
SHAPES[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = ord("a")
for _sign in b"\n.,;:!?'\"()-#$%&*|":
    SHAPES[_sign] = _sign

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _bucket(h: np.ndarray, salt: int) -> np.ndarray:
    h = (h ^ np.uint64(salt)) * _MIX
    h ^= h >> np.uint64(29)
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(64 - BITS)).astype(np.int32)


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All features' buckets, text by text, and each one's text.

    One feature for each word, each n-gram of bytes with marked word ends, each n-gram
    of character classes, and each longer word's being new or repeated.
    """
    joined = b" " + b" ".join(texts) + b" "
    raw = np.frombuffer(joined, np.uint8)
    sizes = np.array([len(t) + 1 for t in texts])
    owner = np.repeat(np.arange(len(texts)), sizes)
    owner = np.concatenate([[0], owner])  # the leading space
    white = WHITE[raw]
    marked = np.where(white, np.uint8(0x20), raw).astype(np.uint64)
    shapes = np.where(white, np.uint8(0x20), SHAPES[raw]).astype(np.uint64)
    out, whose = [], []
    starts = np.flatnonzero(~white[1:] & white[:-1]) + 1
    ends = np.flatnonzero(white[1:] & ~white[:-1]) + 1
    if len(starts):
        length = (ends - starts).astype(np.uint64)
        total = np.zeros(len(starts), np.uint64)
        longest = int(length.max())
        # long words take part with their first and last 32 bytes and their length
        for k in range(min(longest, 32)):
            here = length > k
            at = np.minimum(starts + k, len(raw) - 1)
            back = np.maximum(ends - 1 - k, 0)
            total = np.where(here, (total * np.uint64(1000003)) ^ (marked[at] + (marked[back] << np.uint64(8))), total)
        word = total + (length << np.uint64(56))
        out.append(_bucket(word, 1)), whose.append(owner[starts])
        # one more feature tells whether a longer word stood in the text before
        long = np.flatnonzero(length >= REPEATED_FROM)
        by = long[np.lexsort((long, word[long], owner[starts[long]]))]
        again = np.zeros(len(by), bool)
        again[1:] = (word[by[1:]] == word[by[:-1]]) & (owner[starts[by[1:]]] == owner[starts[by[:-1]]])
        out.append(_bucket(again.astype(np.uint64), 2)), whose.append(owner[starts[by]])
    for view, salt in ((marked, 100), (shapes, 200)):
        for n in NGRAMS:
            count = len(raw) - n + 1
            if count <= 0:
                continue
            h = np.zeros(count, np.uint64)
            crossing = np.zeros(count, bool)
            for k in range(n):
                h = (h << np.uint64(8)) | view[k:k + count]
                if 0 < k < n - 1:
                    crossing |= white[k:k + count]
            # inside a word, its end marks included
            at = np.flatnonzero(~crossing & ~(white[:count] & white[n - 1:n - 1 + count]))
            # a window's text is that of its first byte in a word
            out.append(_bucket(h[at], salt + n)), whose.append(owner[np.where(white[at], at + 1, at)])
    if not out:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    return np.concatenate(out), np.concatenate(whose)


def _bags(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each text's distinct buckets and their shares of its features."""
    bags = []
    for text in texts:
        ids, _ = features([text])
        distinct, counts = np.unique(ids, return_counts=True)
        bags.append((distinct, (counts / max(len(ids), 1)).astype(np.float32)))
    return bags


def train(texts: list[bytes], labels: np.ndarray) -> np.ndarray:
    """The folded model: BUCKETS weights of the log-odds of label 1, then the bias.

    Both classes weigh the same, however many rows each has.
    """
    rng = np.random.default_rng(SEED)
    bags = _bags(texts)
    embed = ((rng.random((BUCKETS, DIMENSIONS)) - 0.5) / DIMENSIONS).astype(np.float32)
    layer = np.zeros((DIMENSIONS, 2), np.float32)
    bias = np.zeros(2, np.float32)
    weight = np.array([0.5 / max((labels == c).mean(), 1e-9) for c in (0, 1)], np.float32)
    steps = EPOCHS * -(-len(bags) // BATCH)
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(bags))
        for begin in range(0, len(order), BATCH):
            rate = np.float32(RATE * (1 - step / steps))
            step += 1
            rows = order[begin:begin + BATCH]
            vectors = np.array([bags[i][1] @ embed[bags[i][0]] for i in rows])
            scores = vectors @ layer + bias
            scores = np.exp(scores - scores.max(axis=1, keepdims=True))
            wrong = scores / scores.sum(axis=1, keepdims=True)
            wrong[np.arange(len(rows)), labels[rows]] -= 1
            wrong *= weight[labels[rows]][:, None] / len(rows)
            back = wrong @ layer.T
            layer -= rate * (vectors.T @ wrong)
            bias -= rate * wrong.sum(axis=0)
            for i, gradient in zip(rows, back):
                ids, shares = bags[i]
                embed[ids] -= (rate * len(rows)) * shares[:, None] * np.clip(gradient, -LARGEST_STEP, LARGEST_STEP)
    folded = embed @ (layer[:, 1] - layer[:, 0])
    return np.append(folded, bias[1] - bias[0]).astype(np.float32)


def scores(texts: list[bytes], model: np.ndarray) -> np.ndarray:
    """Probability of label 1; texts without features get the bias alone."""
    ids, whose = features(texts)
    total = np.bincount(whose, model[:-1][ids], len(texts))
    count = np.bincount(whose, minlength=len(texts))
    odds = total / np.maximum(count, 1) + float(model[-1])
    return 1 / (1 + np.exp(-odds))


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learnt from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> np.ndarray:
    """The model learnt from the labelled rows that aren't held out.

    At most TRAIN_ROWS ids of each class, those that hash lowest, one text each (of rows
    that share an id the smallest text), and no text above TRAIN_TEXT bytes: this bounds
    what the one training task holds.  Without rows of both classes, or in an empty
    table, every text scores alike: near 1, or near 0 if all are of class 0.
    """
    known = only(labels, doc_id, label).select(
        F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label")
    ).filter(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("id")))
    known = known.groupBy("id").agg(F.max("label").alias("label"))
    mark = F.xxhash64("id", F.lit(SEED))
    chosen = [known.filter(F.col("label") == c).orderBy(mark, "id").limit(TRAIN_ROWS) for c in (0, 1)]
    sample = F.broadcast(chosen[0].union(chosen[1]))  # 2 * TRAIN_ROWS rows at most
    rows = only(docs, doc_id, text).select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(sample, "id")
    rows = rows.filter(F.octet_length(F.coalesce("text", F.lit(""))) <= TRAIN_TEXT).groupBy("id", "label").agg(
        F.min("text").alias("text")
    )

    def learn(batches):
        ids, texts, marks = [], [], []
        for batch in batches:
            ids += batch.column("id").to_pylist()
            texts += raw_texts(batch.column("text"))
            marks += batch.column("label").to_pylist()
        if len(set(marks)) < 2:
            model = _constant(1 if set(marks) <= {1} else 0)
        else:
            order = sorted(range(len(ids)), key=lambda i: (ids[i], texts[i]))
            model = train([texts[i] for i in order], np.array([marks[i] for i in order]))
        del texts
        hand_back()
        yield pa.RecordBatch.from_pydict({"model": pa.array([model.tobytes()], pa.binary())})

    made = rows.select("id", "text", "label").repartition(1).mapInArrow(learn, "model binary").first()
    return _constant(1) if made is None else np.frombuffer(made["model"], np.float32)


def _constant(label: int) -> np.ndarray:
    model = np.zeros(BUCKETS + 1, np.float32)
    model[-1] = 10.0 if label else -10.0
    return model


def classify(
    docs: DataFrame, model: np.ndarray, text: str = "text", score: str = "score",
) -> DataFrame:
    """Adds the probability of label 1; null texts are empty, and empty ones have a score too."""
    if score in docs.columns:
        raise ValueError(f"the table has a column {score} already")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema.fields, T.StructField(score, T.DoubleType())])

    def each(batches):
        for whole in batches:
            hand_back()
            for begin in range(0, whole.num_rows, 100):
                batch = whole.slice(begin, 100)
                made = scores(raw_texts(batch.column(text)), shared.value)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made)], names=[*batch.schema.names, score])
            del whole, batch, made
        hand_back()

    return docs.mapInArrow(each, schema)
