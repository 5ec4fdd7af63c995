"""Documents that hold benchmark items, word for word or paraphrased.

Latent semantic analysis says where to look, two checks on the words decide:

1. Texts become numbers of the benchmark's words (0 for all others), stored once;
   everything after reads only that.
2. Passages are WINDOW words long and start every half of it.  Their TF-IDF rows, with
   document frequencies over all half passages of the corpus, go through a randomised
   singular value decomposition: one distributed pass sums A' (A G) for a random G,
   and a small factorisation (Nystrom's, of a vocabulary by a few dozen columns) gives
   the latent directions.
3. Every passage of every document is held against every item by the cosine of their
   latent vectors.  This search takes passages every STEP words, and half as long ones
   for items of up to SHORT words, so that no item is lost among its neighbours.  What
   reaches COSINE is a candidate.
4. A candidate counts if the longest common subsequence of words between the item and
   the surrounding text covers COPIED of the item, or PARAPHRASED of it together with
   the item's answer (its last sentence), whose rarer words must be there.  Where the
   text has fewer of the item's words than that, in whatever order, it isn't computed.

With ``exact`` step 3 is a bound instead: a common subsequence of PARAPHRASED of an item
leaves out so few of its words that SEEDS of the rarest ones (as many as may be left
out, and SEEDS more) stand in the text around the passage.  That loses nothing, and is
what the recall of the cosine search is measured against.

The benchmark is read in blocks of at most BLOCK_WORDS words (or one item), so what
the driver holds and broadcasts doesn't grow with it; the corpus is never gathered.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.store import only, stored
from waybill.llm.words import hand_back, raw_texts

WINDOW = 40
HALF = WINDOW // 2
STEP = HALF // 2
SHORT = 30  # words of an item that is held against half windows
LONGEST = 60  # words of an item that is one passage
COSINE = 0.35
PASSAGES = 4096  # compared with all items at once
BLOCKS = 8192  # summed at once
RANK = 64
EXTRA = 8  # random columns beyond the rank
SEED = 11
SEEDS = 4  # rarer words of an item that must stand together (``bounded``)
COPIED = 0.75
PARAPHRASED = 0.55
ANSWERED = 0.6  # of the answer's rarer words
BLOCK_WORDS = 50_000
FIXED_POINT = 1 << 20  # sums of the sketch are whole numbers, so their order doesn't matter
CACHED = 300_000
PLACES = 2_000_000  # words of candidates, or places of rarer words, held at once

MEMBERS = 1 << 26  # bytes of a table of items by words

SIGNS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

HITS = (
    "item_id long, kind string, item_words long, common_words long, start long, end long, "
    "answer boolean, cosine double"
)
HITS_ARROW = pa.schema([
    ("item_id", pa.int64()), ("kind", pa.string()), ("item_words", pa.int64()),
    ("common_words", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("answer", pa.bool_()),
    ("cosine", pa.float64()),
])


def plain(word: bytes) -> bytes:
    """A to Z lowered, signs around the word gone."""
    return word.strip(SIGNS).lower()


def plain_words(text: bytes) -> list[bytes]:
    return [p for w in text.split() if (p := plain(w))]


class Numbers(dict):
    """word as written -> its number in the vocabulary, 0 outside it, -1 for bare signs."""

    def __init__(self, vocabulary: dict[bytes, int]):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED:
            self.clear()
        bare = plain(word)
        value = self[word] = self.vocabulary.get(bare, 0) if bare else -1
        return value


class Items:
    """A block of benchmark items: their words' numbers, and each one's answer."""

    def __init__(self, rows: list[tuple[int, str]]):
        self.ids = [i for i, _ in rows]
        texts = [t.encode() for _, t in rows]
        words = [plain_words(t) for t in texts]
        self.vocabulary = {w: n + 1 for n, w in enumerate(sorted({w for ws in words for w in ws}))}
        self.size = len(self.vocabulary) + 1
        self.words = [np.array([self.vocabulary[w] for w in ws], np.int64) for ws in words]
        self.answers = [
            np.array([self.vocabulary[w] for w in plain_words(_last_sentence(t))], np.int64) for t in texts
        ]


def _last_sentence(text: bytes) -> bytes:
    parts = [p for p in re.split(rb"(?<=[.!?])\s+", text.strip()) if plain_words(p)]
    return parts[-1] if parts else b""


def numbered(docs: DataFrame, items: Items) -> DataFrame:
    """(doc_id, numbers) with one little-endian integer for each word, bare signs left out."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(items.vocabulary)
    kind = "<u2" if items.size < 1 << 16 else "<u4"

    def each(batches):
        get = Numbers(vocabulary.value).__getitem__
        for batch in batches:
            hand_back()
            out = []
            for text in raw_texts(batch.column("text")):
                words = text.split()
                numbers = np.fromiter(map(get, words), np.int64, len(words))
                out.append(numbers[numbers >= 0].astype(kind).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(out, pa.binary())], names=["doc_id", "numbers"]
            )
            del batch, out
        hand_back()

    kind_of_id = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(each, f"doc_id {kind_of_id}, numbers binary")


class Blocks:
    """Blocks of ``unit`` words of many texts; with half windows, a passage is a block and
    the next of its text."""

    def __init__(self, texts: list[np.ndarray], unit: int = HALF):
        self.unit = unit
        self.flat = np.concatenate([np.zeros(0, np.int64), *texts])
        sizes = np.array([len(t) for t in texts], np.int64)
        self.text_starts = np.cumsum(sizes) - sizes
        counts = -(-sizes // unit)
        self.text_of = np.repeat(np.arange(len(texts)), counts)
        self.block_in = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        self.followed = np.append(self.text_of[1:] == self.text_of[:-1], False) if len(self.text_of) else np.zeros(0, bool)
        # a text's last block is a passage of its own only if it stands alone
        self.passages = np.flatnonzero(self.followed | (self.block_in == 0))
        place = np.arange(len(self.flat)) - np.repeat(self.text_starts, sizes)
        self.known = np.flatnonzero(self.flat > 0)
        self.words = self.flat[self.known]
        first = np.cumsum(counts) - counts
        block = np.repeat(first, sizes) + place // unit
        self.block_of = block[self.known]
        self.grid = np.zeros((len(self.text_of), unit), np.int32)  # the words of each block, 0 behind its end
        self.grid[block, place % unit] = self.flat

    def sums(self, rows: np.ndarray) -> np.ndarray:
        """Per block the sum of its words' ``rows``; row 0, for words outside the vocabulary, is zero."""
        out = np.empty((len(self.text_of), rows.shape[1]), np.float32)
        for begin in range(0, len(out), BLOCKS):
            words = self.grid[begin:begin + BLOCKS]
            part = rows[words[:, 0]]
            for k in range(1, self.unit):
                part += rows[words[:, k]]
            out[begin:begin + BLOCKS] = part
        return out

    def of_passages(self, blocks: np.ndarray) -> np.ndarray:
        """Per passage the sum of its two blocks' rows."""
        out = blocks[self.passages].copy()
        two = self.followed[self.passages]
        out[two] += blocks[self.passages[two] + 1]
        return out


def _texts(batch: pa.RecordBatch, kind: str) -> list[np.ndarray]:
    return [np.frombuffer(b, kind).astype(np.int64) for b in batch.column("numbers").to_pylist()]


def _slices(batches, rows: int = 500):
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            yield batch.slice(begin, rows)


def frequencies(numbers: DataFrame, items: Items) -> tuple[np.ndarray, int]:
    """In how many half passages each word stands, and how many of these there are."""
    size, kind = items.size, "<u2" if items.size < 1 << 16 else "<u4"

    def each(batches):
        total, blocks = np.zeros(size, np.int64), 0
        for batch in _slices(batches):
            b = Blocks(_texts(batch, kind))
            blocks += len(b.text_of)
            pairs = np.sort(b.block_of * size + b.words)
            pairs = pairs[np.append(True, pairs[1:] != pairs[:-1])] if len(pairs) else pairs
            total += np.bincount(pairs % size, minlength=size)
        total[0] = blocks
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["w", "n"])

    rows = numbers.mapInArrow(each, "w long, n long").groupBy("w").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(size, np.int64)
    for r in rows:  # one for each word of the block's vocabulary
        out[r["w"]] = r["n"]
    return out, int(out[0])


def weights(counts: np.ndarray, passages: int) -> np.ndarray:
    idf = np.log((1 + passages) / (1 + counts)).astype(np.float32)
    idf = np.maximum(idf, 1e-3)
    idf[0] = 0  # words outside the vocabulary
    return idf


SKETCH_ROWS = 256  # words of one piece of the sketch


def sketch(numbers: DataFrame, idf: np.ndarray, kind: str) -> np.ndarray:
    """A' (A G) over all passages, A being their unit TF-IDF rows and G random."""
    size = len(idf)
    columns = RANK + EXTRA
    random = np.random.default_rng(SEED).standard_normal((size, columns)).astype(np.float32)
    weighted = idf[:, None] * random
    squares = (idf * idf)[:, None]

    def each(batches):
        total = np.zeros((size, columns), np.float64)
        task = 0
        for batch in _slices(batches):
            b = Blocks(_texts(batch, kind))
            if not len(b.words):
                continue
            products = b.of_passages(b.sums(weighted))
            norms = np.maximum(b.of_passages(b.sums(squares)), 1e-6)  # of the rows, squared
            products /= norms
            # a block's words take part in the passage it opens and the one it closes
            back = np.zeros((len(b.text_of), columns), np.float32)
            back[b.passages] = products
            two = b.followed[b.passages]
            back[b.passages[two] + 1] += products[two]
            by = np.argsort(b.words, kind="stable")
            words = b.words[by]
            for begin in range(0, len(words), 200_000):
                part = words[begin:begin + 200_000]
                first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
                total[part[first]] += np.add.reduceat(back[b.block_of[by[begin:begin + 200_000]]], first, axis=0)
            task = (task + len(words)) % 1_000_003
        fixed = np.rint(total * idf[:, None] * FIXED_POINT).astype("<i8")
        pieces = range(0, size, SKETCH_ROWS)
        yield pa.RecordBatch.from_pydict({
            "piece": pa.array([p // SKETCH_ROWS for p in pieces], pa.int32()),
            "salt": pa.array([task % 64] * len(pieces), pa.int32()),
            "data": pa.array([fixed[p:p + SKETCH_ROWS].tobytes() for p in pieces], pa.binary()),
        })

    def added(table: pa.Table) -> pa.Table:
        data = table.column("data").to_pylist()
        total = np.frombuffer(data[0], "<i8").copy()
        for d in data[1:]:
            total += np.frombuffer(d, "<i8")
        return pa.table({
            "piece": table.column("piece")[:1], "salt": pa.array([0], pa.int32()),
            "data": pa.array([total.tobytes()], pa.binary()),
        })

    schema = "piece int, salt int, data binary"
    rows = (
        numbers.mapInArrow(each, schema).groupBy("piece", "salt").applyInArrow(added, schema)
        .groupBy("piece").applyInArrow(added, schema).collect()
    )
    out = np.zeros((size, columns))
    for r in rows:  # vocabulary by a few dozen columns
        part = np.frombuffer(r["data"], "<i8").reshape(-1, columns)
        out[r["piece"] * SKETCH_ROWS:][:len(part)] = part / FIXED_POINT
    return out, random


def directions(summed: np.ndarray, random: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Words' rows in latent space, idf included, from the sketch of A'A."""
    small = random.T.astype(np.float64) @ summed
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    keep = values > values.max(initial=0) * 1e-9
    if not keep.any():
        return np.zeros((len(idf), 1), np.float32)
    factor = summed @ vectors[:, keep] / np.sqrt(values[keep])
    left, singular, _ = np.linalg.svd(factor, full_matrices=False)
    # directions that common words fill would drown the others: each counts alike
    return (idf[:, None] * left[:, :RANK] / np.maximum(singular[:RANK], singular[0] * 1e-4)).astype(np.float32)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def common_subsequence(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Length of the longest common subsequence of words, by bit-parallel rows, and
    after how many words of ``text`` it is reached."""
    masks: dict[int, int] = {}
    for i, w in enumerate(item.tolist()):
        masks[w] = masks.get(w, 0) | 1 << i
    full = (1 << len(item)) - 1
    row, best, end = full, 0, 0
    for at, w in enumerate(text.tolist()):
        mask = masks.get(w)
        if mask is None:
            continue
        used = row & mask
        row = ((row + used) | (row - used)) & full
        length = len(item) - row.bit_count()
        if length > best:
            best, end = length, at + 1
    return best, end


class Finder:
    """What a task needs to judge documents against one block of items."""

    def __init__(self, items: Items, idf: np.ndarray, latent: np.ndarray, exact: bool = False):
        self.items, self.idf, self.latent, self.exact = items, idf, latent, exact
        # items up to LONGEST words are one passage, longer ones several
        parts = [
            (i, w[at:at + WINDOW]) for i, w in enumerate(items.words) if len(w)
            for at in (range(0, len(w) - HALF, HALF) if len(w) > LONGEST else [0])
        ]
        parts = [(i, w if len(items.words[i]) > LONGEST else items.words[i]) for i, w in parts]
        self.item_of = np.array([i for i, _ in parts], np.int64)
        self.passages = _unit(np.array([latent[w].sum(axis=0) for _, w in parts], np.float32).reshape(len(parts), -1))
        self.rare = []
        for answer in items.answers:
            middle = np.median(idf[answer]) if len(answer) else 0
            self.rare.append(np.unique(answer[idf[answer] >= middle]) if len(answer) else answer)
        sizes = np.array([len(w) for w in items.words], np.int64)
        self.least = np.ceil(PARAPHRASED * sizes).astype(np.int64)  # common words, see ``hits``
        self.margin = sizes // 2
        # a short passage may begin or end anywhere in its item
        self.short_margin = np.maximum(sizes - STEP, self.margin)
        self.short = sizes <= SHORT
        # (item, word) pairs, and how often the item has the word
        pairs = np.concatenate([np.zeros(0, np.int64), *(i * len(idf) + w for i, w in enumerate(items.words))])
        self.held, self.times = np.unique(pairs, return_counts=True)
        self.member = None
        if len(sizes) * len(idf) <= MEMBERS:
            self.member = np.zeros((len(sizes), len(idf)), bool)
            self.member.reshape(-1)[self.held] = True
        if exact:
            self._list_rarer(sizes)

    def _list_rarer(self, sizes: np.ndarray) -> None:
        """The items of which a word is among the rarer ones, once for each time it stands there."""
        self.spans = WINDOW + 2 * self.margin
        self.seeds = np.minimum(SEEDS, self.least)
        rarer = [
            w[np.argsort(-self.idf[w], kind="stable")][:len(w) - least + seeds]
            for w, least, seeds in zip(self.items.words, self.least, self.seeds)
        ]
        words = np.concatenate([np.zeros(0, np.int64), *rarer])
        by = np.argsort(words, kind="stable")
        self.listed = np.repeat(np.arange(len(rarer)), [len(w) for w in rarer])[by]
        self.listed_from = np.searchsorted(words[by], np.arange(len(self.idf) + 1))

    def near(self, texts: list[np.ndarray]) -> tuple[Blocks, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Items near a passage in latent space, and where around it to look: the item, begin
        and end (in ``flat``), and the cosine.

        Passages of WINDOW words begin every STEP words, and so do half as long ones, which
        items of up to SHORT words are held against.
        """
        b = Blocks(texts, STEP)
        sums = b.sums(self.latent)
        first, counts = self._first_blocks(b)
        left = counts[b.text_of] - b.block_in  # units of the text from here on
        out = []
        for units, passages in ((HALF // STEP, self.short[self.item_of]), (WINDOW // STEP, ~self.short[self.item_of])):
            which = np.flatnonzero(passages)
            rows = sums.copy()
            for k in range(1, units):
                rows[:-k][left[:-k] > k] += sums[k:][left[:-k] > k]
            starts = np.flatnonzero((left >= units) | (b.block_in == 0))
            norms = np.linalg.norm(rows[starts], axis=1)
            starts, norms = starts[norms > 0], norms[norms > 0]
            for begin in range(0, len(starts) if len(which) else 0, PASSAGES):
                part = starts[begin:begin + PASSAGES]
                cosine = (rows[part] / norms[begin:begin + PASSAGES, None]) @ self.passages[which].T
                passage, at = np.nonzero(cosine >= COSINE)
                out.append((part[passage], self.item_of[which[at]], np.full(len(at), units * STEP), cosine[passage, at]))
        block, item, size, cosine = (np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, np.int64),) * 4
        text = b.text_of[block]
        start = b.text_starts[text] + b.block_in[block] * STEP
        margin = np.where(size < WINDOW, self.short_margin[item], self.margin[item])
        end = np.append(b.text_starts[1:], len(b.flat))[text]
        begin, end = np.maximum(b.text_starts[text], start - margin), np.minimum(end, start + size + margin)
        keep = self._common(b, begin, end, item) >= self.least[item]  # fewer common words can't pass
        return b, item[keep], begin[keep], end[keep], cosine[keep]

    def bounded(self, texts: list[np.ndarray]) -> tuple[Blocks, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """As ``near``, but every passage that may pass the final rule, whatever its cosine:
        to measure recall against, or where nothing may be missed."""
        b = Blocks(texts)
        each = np.diff(self.listed_from)[b.words]
        at, each, words = b.known[each > 0], each[each > 0], b.words[each > 0]
        upto = np.cumsum(each)
        keys = [np.zeros(0, np.int64)]
        begin = 0
        while begin < len(at):
            done = upto[begin] - each[begin]
            end = max(begin + 1, int(np.searchsorted(upto, done + PLACES, "right")))
            # what begins here may end behind
            last = int(np.searchsorted(at, at[end - 1] + self.spans.max()))
            keys.append(self._seeded(b, at[begin:last], each[begin:last], words[begin:last], at[end - 1]))
            begin = end
        keys = np.unique(np.concatenate(keys))
        passage, item = keys // len(self.least), keys % len(self.least)
        begin, end = self._bounds(b, passage, item)
        keep = self._common(b, begin, end, item) >= self.least[item]
        cosine = np.array([self._cosine(b, p, i) for p, i in zip(passage[keep].tolist(), item[keep].tolist())], np.float32)
        return b, item[keep], begin[keep], end[keep], cosine

    def _seeded(self, b: Blocks, at: np.ndarray, each: np.ndarray, words: np.ndarray, last: int) -> np.ndarray:
        """passage * items + item, where enough of an item's rarer words stand around the passage,
        the first of them not behind ``last``."""
        place = np.repeat(at, each)
        within = np.arange(len(place)) - np.repeat(np.cumsum(each) - each, each)
        item = self.listed[within + np.repeat(self.listed_from[words], each)]
        key = np.sort(item * len(b.flat) + place)
        item, place = key // len(b.flat), key % len(b.flat)
        first = np.arange(len(key))
        final = first + self.seeds[item] - 1
        fits = (place <= last) & (final < len(key))
        first, final = first[fits], final[fits]
        text = np.searchsorted(b.text_starts, place[first], "right") - 1
        fits = (
            (item[final] == item[first]) & (place[final] - place[first] < self.spans[item[first]])
            & (np.searchsorted(b.text_starts, place[final], "right") - 1 == text)
        )
        first, final, text = first[fits], final[fits], text[fits]
        item, start = item[first], b.text_starts[text]
        # passages begin every HALF words; those around which both the first and the last stand
        low = np.maximum(0, -((start + WINDOW + self.margin[item] - 1 - place[final]) // HALF))
        high = (place[first] - start + self.margin[item]) // HALF
        many = np.maximum(0, high - low + 1)
        block = np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        opens, sizes = self._first_blocks(b)
        text = np.repeat(text, many)
        inside = (block == 0) | (block + 1 < sizes[text])
        return np.unique((opens[text] + block)[inside] * len(self.least) + np.repeat(item, many)[inside])

    @staticmethod
    def _first_blocks(b: Blocks) -> tuple[np.ndarray, np.ndarray]:
        """Of every text: its first block, and how many it has."""
        sizes = np.bincount(b.text_of, minlength=len(b.text_starts))
        return np.cumsum(sizes) - sizes, sizes

    def _bounds(self, b: Blocks, passage: np.ndarray, item: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in ``flat`` the text around each passage begins and ends."""
        text = b.text_of[passage]
        start = b.text_starts[text] + b.block_in[passage] * HALF
        text_end = np.append(b.text_starts[1:], len(b.flat))[text]
        return (
            np.maximum(b.text_starts[text], start - self.margin[item]),
            np.minimum(text_end, start + WINDOW + self.margin[item]),
        )

    def _common(self, b: Blocks, begin: np.ndarray, end: np.ndarray, item: np.ndarray) -> np.ndarray:
        """How many of the item's words stand between begin and end, in whatever order; 0
        may stand for too few."""
        out = np.zeros(len(item), np.int64)
        upto = np.cumsum(end - begin)
        done = 0
        while done < len(item):
            to = max(done + 1, int(np.searchsorted(upto, (upto[done - 1] if done else 0) + PLACES, "right")))
            long = (end - begin)[done:to]
            row = np.repeat(np.arange(to - done), long)
            place = np.arange(len(row)) - np.repeat(np.cumsum(long) - long - begin[done:to], long)
            word = b.flat[place]
            if self.member is not None:  # where even with repeats there are too few, they needn't be counted once
                row = row[inside := self.member[item[done:to][row], word]]
                word = word[inside]
                enough = np.bincount(row, minlength=to - done) >= self.least[item[done:to]]
                row, word = row[enough[row]], word[enough[row]]
            else:
                row, word = row[word > 0], word[word > 0]
            pair = item[done:to][row] * len(self.idf) + word
            found = np.minimum(np.searchsorted(self.held, pair), len(self.held) - 1)
            is_held = self.held[found] == pair
            # each word of a passage once
            once = np.unique(row[is_held] * len(self.held) + found[is_held])
            np.add.at(out, done + once // len(self.held), self.times[once % len(self.held)])
            done = to
        return out

    def hits(self, texts: list[np.ndarray]) -> list[tuple]:
        """(text, item, kind, item words, common words, start, end, answer, cosine), best per text and item."""
        best: dict[tuple[int, int], tuple] = {}
        b, items, begins, ends, cosines = (self.bounded if self.exact else self.near)(texts)
        for text, i, low, high, cosine in zip(
            self._text_at(b, begins).tolist(), items.tolist(), begins.tolist(), ends.tolist(), cosines.tolist()
        ):
            item, span = self.items.words[i], b.flat[low:high]
            low -= int(b.text_starts[text])
            length, end = common_subsequence(item, span)
            if length < PARAPHRASED * len(item):
                continue
            _, back = common_subsequence(item[::-1], span[:end][::-1])
            begin = end - back
            answer = bool(len(self.rare[i])) and bool(np.isin(self.rare[i], span).mean() >= ANSWERED)
            if length >= COPIED * len(item):
                kind = "copy"
            elif answer and end - begin <= 2 * len(item):
                kind = "paraphrase"
            else:
                continue
            found = (text, i, kind, len(item), length, low + begin, low + end, answer, round(cosine, 4))
            if (text, i) not in best or (length, cosine) > (best[text, i][4], best[text, i][8]):
                best[text, i] = found
        return list(best.values())

    @staticmethod
    def _text_at(b: Blocks, places: np.ndarray) -> np.ndarray:
        """The text that holds each place; empty texts hold none."""
        full = np.flatnonzero(np.diff(np.append(b.text_starts, len(b.flat))))
        return full[np.searchsorted(b.text_starts[full], places, "right") - 1]

    def _cosine(self, b: Blocks, passage: int, item: int) -> float:
        """The largest of a passage's cosines to the item's passages."""
        begin = int(b.text_starts[b.text_of[passage]] + b.block_in[passage] * HALF)
        end = min(begin + WINDOW, int(np.append(b.text_starts, len(b.flat))[b.text_of[passage] + 1]))
        words = b.flat[begin:end]
        row = _unit(self.latent[words[words > 0]].sum(axis=0)[None])[0]
        return float((self.passages[self.item_of == item] @ row).max())


def find(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", exact: bool = False,
) -> DataFrame:
    """One row per document row and item that it holds: the two ids (the document's of
    whatever type it is, and under its own name), kind (copy or
    paraphrase), lengths in words, the place in words (signs alone don't count), whether the
    answer is there, and the cosine that found it.  ``exact`` looks at every passage that
    could pass the final checks instead of those near an item in latent space.

    Null and empty texts and items hold nothing and are held by nothing.  Rows that
    repeat give repeated rows.  Other columns are not carried.
    """
    rows = only(docs, doc_id, text).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    asked = only(benchmark, item_id, item_text).select(
        F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text")
    ).filter("item_id is not null and text is not null")
    words = asked.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    parts = max(1, -(-words // BLOCK_WORDS))
    found = None
    for part in range(parts):
        block = asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part).orderBy("item_id", "text").collect()
        here = _find_block(rows, Items([(r["item_id"], r["text"]) for r in block]), exact)
        found = here if found is None else found.union(here)
    return found.withColumnRenamed("doc_id", doc_id)


def _find_block(rows: DataFrame, items: Items, exact: bool) -> DataFrame:
    spark = rows.sparkSession
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {HITS}"
    if items.size == 1:
        return spark.createDataFrame([], schema)
    kind = "<u2" if items.size < 1 << 16 else "<u4"
    numbers = stored(numbered(rows, items))
    counts, passages = frequencies(numbers, items)
    idf = weights(counts, passages)
    latent = directions(*sketch(numbers, idf, kind), idf)
    shared = spark.sparkContext.broadcast((items, idf, latent))

    def judge(batches):
        finder = Finder(*shared.value, exact)
        for batch in _slices(batches):
            ids = batch.column("doc_id")
            hits = finder.hits(_texts(batch, kind))
            if hits:
                columns = list(zip(*hits))
                yield pa.RecordBatch.from_arrays([
                    ids.take(pa.array(columns[0], pa.int64())),
                    pa.array([items.ids[i] for i in columns[1]], pa.int64()),
                    *(pa.array(c, f.type) for c, f in zip(columns[2:], list(HITS_ARROW)[1:])),
                ], names=["doc_id", *HITS_ARROW.names])

    return numbers.mapInArrow(judge, schema)
