"""Documents scored by the difference of two language models' losses.

A target and a background model of the same form (bigrams smoothed by words and by a
uniform floor) share one vocabulary: every word of the corpus, and the end of a text,
which is a token like any other and is scored as one.  So whatever stands before, the
probabilities of all that may follow sum to one.  A document's score is the mean over
its tokens of the target's loss minus the background's: the lower, the more it reads
like the target.  Counts cover all documents and grow with them; no
document is scored by its own counts, which are taken off before.

Counts travel by ``exchange``: each group of documents sends its distinct words and
bigrams once, with both models' counts, and gets the corpus' counts back.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm import exchange
from waybill.llm.store import only
from waybill.llm.words import MULTIPLIER, raw_texts, scrambled, word_hashes

# Shares of bigram, word and floor in a probability, the same in both models.
BIGRAM, WORD, FLOOR = 0.6, 0.3, 0.1
MICRO = 1_000_000  # losses are summed as whole millionths of a nat, so any order gives the same
END = np.uint64(0x5851F42D4C957F2C)  # behind the last word, and so before the first

WORD_KEY, BIGRAM_KEY = np.uint64(0), np.uint64(1)

SCORES = "doc_id long, in_target boolean, n_tokens long, target_loss long, background_loss long, score double"
SCORES_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("in_target", pa.bool_()), ("n_tokens", pa.int64()), ("target_loss", pa.int64()),
    ("background_loss", pa.int64()), ("score", pa.float64()),
])


def _keyed(hashes: np.ndarray, kind: np.uint64) -> np.ndarray:
    """63 bits of the hash, then the kind."""
    return (hashes & ~np.uint64(1)) | kind


def ngrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per token its word's and its bigram's key, and where each text's tokens begin."""
    words, ends = word_hashes([t.lower() for t in texts])
    filled = np.diff(ends) > 0
    words = np.insert(words, ends[1:][filled], END)
    ends = ends + np.append(0, np.cumsum(filled))
    before = np.empty_like(words)
    before[1:] = words[:-1]
    before[:1] = END
    pairs = scrambled(before * MULTIPLIER + words)
    return _keyed(words, WORD_KEY), _keyed(pairs, BIGRAM_KEY), ends


def _after(per_word: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Per token what holds for the word before it; ``starts`` for each text's first."""
    out = np.empty_like(per_word)
    out[1:] = per_word[:-1]
    filled = np.diff(ends) > 0
    out[ends[:-1][filled]] = starts[filled]
    return out


def _targets(table: pa.Table, beside: pa.Table) -> np.ndarray:
    wanted = set(beside.column("target_id").to_pylist())
    return np.array([i in wanted and i is not None for i in table.column("doc_id").to_pylist()], bool)


def _own(keys: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How often each token's key stands in its own text."""
    out = np.empty(len(keys), np.int64)
    for begin, end in zip(ends[:-1].tolist(), ends[1:].tolist()):
        _, at, counts = np.unique(keys[begin:end], return_inverse=True, return_counts=True)
        out[begin:end] = counts[at]
    return out


def cross_entropy_difference(
    docs: DataFrame, target_ids: DataFrame, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Per row: doc_id, in_target, n_tokens, both losses (sums in millionths of a nat), score.

    ``target_ids`` has one column of the ids whose rows make the target model; all
    other rows make the background model.  Words are runs without white space, A to Z
    lowered; n_tokens counts them and the end.  Null and empty texts, and those without
    words, have no tokens and a null score; an empty table gives no rows.  Rows that share an
    id belong to the same model.  Other columns are not carried.
    """
    rows = only(docs, doc_id, text).select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    groups = exchange.groups_for(rows)
    # rows without an id are background, and may be anywhere
    placed = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))
    grouped = rows.select(F.pmod(placed, F.lit(groups)).cast("int").alias("g"), "doc_id", "text")
    ids = target_ids.select(F.col(target_ids.columns[0]).cast("long").alias("target_id")).dropna().distinct()
    side = ids.select(exchange.hashed_group(F.col("target_id"), groups).alias("g"), "target_id")

    def keys_of(table: pa.Table, beside: pa.Table):
        words, pairs, ends = ngrams(raw_texts(table.column("text")))
        chosen = _targets(table, beside)
        flat = np.concatenate([words, pairs])
        target = np.tile(np.repeat(chosen, np.diff(ends)), 2)
        keys, at = np.unique(flat, return_inverse=True)
        wanted = np.bincount(at, target, len(keys)).astype(np.int64)
        return keys, [wanted, np.bincount(at, minlength=len(keys)) - wanted]

    def totals(run, first, payload, keys):
        sums = [np.bincount(run, p).astype(np.int64) for p in payload]
        words = (keys & np.uint64(1)) == WORD_KEY
        texts = keys == END  # one at the end of each text that has words
        told = [int((first & words).sum()), *(int(p[w].sum()) for w in (words, texts) for p in payload)]
        return [s[run] for s in sums], told

    def finish(table: pa.Table, beside: pa.Table, values: list[np.ndarray], told: np.ndarray) -> pa.Table:
        words, pairs, ends = ngrams(raw_texts(table.column("text")))
        sizes = np.diff(ends)
        target = _targets(table, beside)
        _, at = np.unique(np.concatenate([words, pairs]), return_inverse=True)
        own_words, own_pairs = _own(words, ends), _own(pairs, ends)
        vocabulary = int(told[0])
        losses = []
        for model in (0, 1):
            mine = target == (model == 0)
            inside = np.repeat(mine, sizes)
            word = values[model][at[:len(words)]] - np.where(inside, own_words, 0)
            pair = values[model][at[len(words):]] - np.where(inside, own_pairs, 0)
            before = _after(word, int(told[3 + model]) - mine.astype(np.int64), ends)
            tokens = np.repeat(int(told[1 + model]) - np.where(mine, sizes, 0), sizes)
            plain = word / np.maximum(tokens, 1)
            after = np.where(before > 0, pair / np.maximum(before, 1), plain)
            p = BIGRAM * after + WORD * plain + FLOOR / max(vocabulary, 1)
            loss = np.rint(-np.log(p) * MICRO).astype(np.int64)
            losses.append(np.diff(np.append(0, np.cumsum(loss))[ends]))
        score = (losses[0] - losses[1]) / np.maximum(sizes, 1) / MICRO
        return pa.table({
            "doc_id": table.column("doc_id"), "in_target": target, "n_tokens": sizes,
            "target_loss": losses[0], "background_loss": losses[1],
            "score": pa.array(score, mask=sizes == 0),
        }, schema=SCORES_ARROW)

    replies = exchange.replied(exchange.asked(grouped, keys_of, groups, side), totals)
    return exchange.finished(grouped, replies, finish, SCORES, side)
