"""Packing of documents into token sequences of one size with little padding.

Best-fit decreasing: pieces are taken from the longest to the shortest, and each goes
into the open window with the least room that still holds it; a segment tree over the
remaining capacity finds that window.  Documents longer than a window are first cut
into full windows and a rest.

There are no more different lengths than a window has tokens, and pieces of one length
are alike.  So best fit runs on the number of pieces of each length, whole runs of
windows at a time, and gives exactly what it gives piece by piece, over all documents
at once, however many there are.  What it yields are a few thousand rules "the pieces
of this length from the n-th on go to the windows from the m-th on".  Every piece then
finds its own rule by its number among the pieces of its length: its number in its
task, and the counts of the tasks before.  No piece meets another one in any task.

Windows that best fit leaves with more than ``slack`` tokens of padding are laid end to
end and cut anew at full windows, so all but the last of those are full.  A window with
a power of two of tokens needs no padding and stays as it is.
"""

from __future__ import annotations

import json
import re
from collections import deque
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm.store import only, stored
from waybill.llm.words import hand_back, raw_texts
from waybill.operators.skew import sized_broadcast

SIZE = 2048
SLACK = 16  # tokens of padding that a window may keep
END = 1  # the id behind every document
CACHED = 800_000  # parts of texts remembered by one Python worker
PART = 1 << 20  # bytes of text taken at once
SPECIAL = "<|"  # a special token may stand in such a word

PIECES = "doc_id long, start long, length int, doc_tokens long, ids binary, slice int, k long"
PIECES_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int32()), ("doc_tokens", pa.int64()),
    ("ids", pa.binary()), ("slice", pa.int32()), ("k", pa.int64()),
])


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# The pattern by which this kind of tokenizer parts texts, for ASCII and the
# letters of Latin-1, and the normalisation that goes with it.
CORES = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|'s|'t|'re|'ve|'m|'ll|'d|[^ \t\n\v\f\ra-z0-9ß-öø-ÿ]+")
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMAL = ["NFC", "Replace", "Lowercase"]
PLAIN = re.compile(r"[\x00-\x7FÀ-ÖØ-öø-ÿ]*")
SPACE = re.compile(r"[ \t\n\v\f\r]+")
WHOLE = " "  # marks a word that is no core


class Tokens:
    """A tokenizer whose ids of a text are those of its parts, one after the other.

    That holds where nothing joins across ASCII white space: the split keeps no white
    space, and the normalisation is by character.  Texts of ASCII and Latin-1 letters are
    parted here into cores, which a tokenizer without normalisation and split then
    encodes, each distinct one once; words with other characters, or with special tokens,
    are encoded as they are.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        with open(path) as f:
            made = json.load(f)
        steps = made["normalizer"].get("normalizers", []), made["pre_tokenizer"].get("pretokenizers", [])
        if (
            [n["type"] for n in steps[0]] != NORMAL or [p["type"] for p in steps[1]] != ["Split", "ByteLevel"]
            or steps[1][0]["pattern"] != {"Regex": SPLIT} or steps[1][1]["use_regex"] or steps[1][1]["add_prefix_space"]
        ):
            raise ValueError("only tokenizers with byte-level pairs over lowered words, without white space")
        self.bare = Tokenizer.from_file(path)
        self.bare.normalizer = normalizers.Sequence([])
        self.bare.pre_tokenizer = pre_tokenizers.Split(" ", "removed")
        self._forget()

    def _forget(self) -> None:
        self.numbers: dict[str, int] = {}
        self.spans = Spans()

    def _learn(self, parts: list[str]) -> None:
        cores = [p for p in parts if p[0] != WHOLE]
        begin = len(self.spans.sizes)
        self.numbers.update(zip(cores, range(begin, begin + len(cores))))
        if cores:
            shown = " ".join([c.encode().decode("latin-1").translate(BYTES) for c in cores])
            coded = self.bare.encode(shown, add_special_tokens=False)
            self.spans.add(np.array(coded.ids, np.uint32), np.bincount(coded.word_ids, minlength=len(cores)))
        words = [p for p in parts if p[0] == WHOLE]
        if words:
            begin += len(cores)
            self.numbers.update(zip(words, range(begin, begin + len(words))))
            ids = [np.array(self.tokenizer.encode(w[1:], add_special_tokens=False).ids, np.uint32) for w in words]
            self.spans.add(np.concatenate(ids), np.array([len(i) for i in ids], np.int64))

    @staticmethod
    def _parts(text: str) -> list[str]:
        if PLAIN.fullmatch(text) and SPECIAL not in text:
            return CORES.findall(text.lower())
        out = []
        for word in SPACE.split(text):
            if PLAIN.fullmatch(word) and SPECIAL not in word:
                out += CORES.findall(word.lower())
            else:
                out.append(WHOLE + word)
        return out

    def _coded(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.numbers) >= CACHED:
            self._forget()
        lists = [self._parts(t) for t in texts]
        flat = list(chain.from_iterable(lists))
        new = [p for p in set(flat) if p not in self.numbers]
        if new:
            self._learn(new)
        ids, sizes = self.spans.take(np.fromiter(map(self.numbers.__getitem__, flat), np.int64, len(flat)))
        ends = np.append(0, np.cumsum(sizes))[np.cumsum([0, *map(len, lists)])].tolist()
        return [ids[x:y] for x, y in zip(ends[:-1], ends[1:])]

    def ids(self, text: bytes) -> np.ndarray:
        """The ids of one text, about PART bytes of whole words at a time."""
        out, at = [np.zeros(0, np.uint32)], 0
        while at < len(text):
            end = at + PART
            while end < len(text) and text[end] not in b" \t\n\v\f\r":
                end += 1
            out += self._coded([text[at:end].decode("utf-8", "replace")])
            at = end
        return np.concatenate(out)

    def batch(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of several texts, short ones together."""
        out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
        held, size = [], 0

        def flush():
            for i, ids in zip(held, self._coded([texts[i].decode("utf-8", "replace") for i in held])):
                out[i] = ids

        for i, text in enumerate(texts):
            if len(text) > PART:
                out[i] = self.ids(text)
                continue
            held.append(i)
            size += len(text)
            if size > PART:
                flush()
                held, size = [], 0
        if held:
            flush()
        return out


class Spans:
    """Rows of ids of various lengths, one after the other."""

    def __init__(self):
        self.flat = np.zeros(0, np.uint32)
        self.starts = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int64)

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.starts = np.append(self.starts, len(self.flat) + np.cumsum(sizes) - sizes)
        self.sizes = np.append(self.sizes, sizes)
        self.flat = np.append(self.flat, ids)

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these rows together, and how many each has."""
        sizes = self.sizes[rows]
        ends = np.cumsum(sizes)
        place = np.arange(int(ends[-1]) if len(ends) else 0)
        place += np.repeat(self.starts[rows] - ends + sizes, sizes)
        return self.flat[place], sizes


def _byte_characters() -> dict[int, str]:
    """Every byte as a visible character: itself, or one from 256 on for those without."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)}


BYTES = _byte_characters()

_LOADED: dict[str, Tokens] = {}


def loaded(path: str) -> Tokens:
    if path not in _LOADED:
        _LOADED[path] = Tokens(path)
    return _LOADED[path]


def pieces_of(docs: DataFrame, path: str, size: int = SIZE) -> DataFrame:
    """(doc_id, text) as pieces of at most ``size`` ids: full windows and each one's rest.

    ``k`` numbers the pieces of one length in one task, the ``slice``.  Only a written
    table of these rows has one numbering.
    """

    def each(batches):
        tokens = loaded(path)
        slice_of = TaskContext.get().partitionId()
        seen = np.zeros(size + 1, np.int64)
        for batch in batches:
            hand_back()
            ids = batch.column("doc_id").to_pylist()
            coded = [np.append(i, np.uint32(END)) for i in tokens.batch(raw_texts(batch.column("text")))]
            owner, start = [], []
            for i, one in enumerate(coded):
                at = range(0, len(one), size)
                owner += [i] * len(at)
                start += at
            data = [coded[i][s:s + size].astype("<u4").tobytes() for i, s in zip(owner, start)]
            length = np.array([len(d) // 4 for d in data], np.int64)
            by = np.argsort(length, kind="stable")
            run = length[by]
            first = np.flatnonzero(np.append(True, run[1:] != run[:-1])) if len(run) else np.zeros(0, np.int64)
            many = np.diff(np.append(first, len(run)))
            k = np.empty(len(run), np.int64)
            k[by] = np.arange(len(run)) - np.repeat(first, many) + seen[run]
            seen[run[first]] += many
            yield pa.RecordBatch.from_arrays([
                pa.array([ids[i] for i in owner], pa.int64()), pa.array(start, pa.int64()),
                pa.array(length, pa.int32()), pa.array([len(coded[i]) for i in owner], pa.int64()),
                pa.array(data, pa.binary()), pa.array([slice_of] * len(k), pa.int32()), pa.array(k),
            ], schema=PIECES_ARROW)
            del batch, coded, data
        hand_back()

    return docs.mapInArrow(each, PIECES)


class Capacities:
    """A segment tree over 0..size that says where something stands."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.some = bytearray(2 * self.leaves)

    def put(self, at: int, some: bool) -> None:
        node = self.leaves + at
        self.some[node] = some
        while node > 1:
            node //= 2
            self.some[node] = self.some[2 * node] or self.some[2 * node + 1]

    def first_from(self, at: int) -> int | None:
        """The smallest place, from ``at`` on, where something stands."""
        node = self.leaves + at
        if self.some[node]:
            return at
        while node > 1 and (node % 2 or not self.some[node + 1]):
            node //= 2
        if node <= 1:
            return None
        node += 1
        while node < self.leaves:
            node *= 2
            node += not self.some[node]
        return node - self.leaves


@dataclass
class Plan:
    """Where the pieces go: rules by (length, number among its length), and the windows made.

    Pieces ``first`` to the next rule's first go to windows from ``window`` on, ``each``
    of them side by side in a window, from ``used`` on.  Windows come in runs that are
    filled alike: from ``run``, with ``filled`` tokens each.
    """

    length: np.ndarray
    first: np.ndarray
    each: np.ndarray
    window: np.ndarray
    used: np.ndarray
    run: np.ndarray
    filled: np.ndarray
    windows: int


def best_fit(counts: dict[int, int], size: int) -> Plan:
    """Best-fit decreasing of ``counts[length]`` pieces of each length."""
    tree = Capacities(size)
    open_at: list[deque] = [deque() for _ in range(size + 1)]  # runs (first window, how many) by room left

    def add(room: int, first: int, many: int) -> None:
        open_at[room].append((first, many))
        tree.put(room, True)

    rules, windows = [], 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            room = tree.first_from(length)
            if room is None:
                room = size
                first, many = windows, -(-left // (size // length))
                windows += many
            else:
                first, many = open_at[room].popleft()
                if not open_at[room]:
                    tree.put(room, False)
            each = room // length  # the window stays the tightest until no more go in
            full = min(many, left // each)
            rest = left - full * each if full < many else 0
            rules.append((length, counts[length] - left, each, first, size - room))
            left -= full * each + rest
            if full:
                add(room - each * length, first, full)
            if rest:
                add(room - rest * length, first + full, 1)
            if many - full - (rest > 0):
                add(room, first + full + (rest > 0), many - full - (rest > 0))
    made = sorted((first, size - room) for room, runs in enumerate(open_at) for first, _ in runs)
    columns = [np.array(c, np.int64) for c in zip(*sorted(rules))] or [np.zeros(0, np.int64)] * 5
    run, filled = (np.array(c, np.int64) for c in zip(*made)) if made else (np.zeros(0, np.int64),) * 2
    return Plan(*columns, run, filled, windows)


def padding(filled: np.ndarray, size: int) -> np.ndarray:
    """Tokens of padding of windows with so many tokens."""
    return np.where(filled & (filled - 1) == 0, 0, size - filled)


class Placer:
    """Gives every piece its sequence and offset, or several if it is cut anew."""

    def __init__(self, plan: Plan, size: int, slack: int):
        self.plan, self.size = plan, size
        many = np.diff(np.append(plan.run, plan.windows))
        self.recut = padding(plan.filled, size) > slack
        kept = np.where(self.recut, 0, many)
        self.number = np.cumsum(kept) - kept  # of a run's first window, among those kept
        tokens = np.where(self.recut, many * plan.filled, 0)
        self.ahead = np.cumsum(tokens) - tokens  # of a run, in the row of windows cut anew
        self.kept = int(kept.sum())
        # one number for (length, number): lengths come first
        self.key = (plan.length << 48) + plan.first

    def place(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sequence and offset of each piece, and how many of its tokens stand there (the rest opens the next)."""
        plan, size = self.plan, self.size
        rule = np.searchsorted(self.key, (length << 48) + number, "right") - 1
        within = number - plan.first[rule]
        window = plan.window[rule] + within // plan.each[rule]
        offset = plan.used[rule] + within % plan.each[rule] * length
        run = np.searchsorted(plan.run, window, "right") - 1
        nth = window - plan.run[run]
        place = self.ahead[run] + nth * plan.filled[run] + offset
        anew = self.recut[run]
        sequence = np.where(anew, self.kept + place // size, self.number[run] + nth)
        offset = np.where(anew, place % size, offset)
        return sequence, offset, np.minimum(length, size - offset)


PLACES = pa.list_(pa.struct([
    ("sequence_id", pa.int64()), ("offset", pa.int64()), ("skip", pa.int64()), ("length", pa.int64()),
]))


def _placed(placer: Placer):
    @F.arrow_udf("array<struct<sequence_id: long, offset: long, skip: long, length: long>>")
    def places(length: pa.Array, number: pa.Array) -> pa.Array:
        length, number = length.to_numpy().astype(np.int64), number.to_numpy()
        sequence, offset, here = placer.place(length, number)
        two = here < length
        ends = np.cumsum(1 + two)
        second = ends[two] - 1
        columns = [np.zeros(len(length) + int(two.sum()), np.int64) for _ in range(4)]
        for column, one, more in zip(
            columns, (sequence, offset, np.zeros_like(here), here),
            (sequence[two] + 1, 0, here[two], (length - here)[two]),
        ):
            column[ends - 1 - two] = one
            column[second] = more
        rows = pa.StructArray.from_arrays([pa.array(c) for c in columns], fields=list(PLACES.value_type))
        return pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), rows)

    return places


def pack(
    docs: DataFrame, path: str | None = None, doc_id: str = "doc_id", text: str = "text", size: int = SIZE,
    slack: int = SLACK,
) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids.

    ``ids`` are a piece's tokens as little-endian unsigned 32-bit numbers; every document
    ends with the id END, which ``doc_tokens`` counts.  Rows of one sequence, by offset,
    follow each other without a gap; sequences are numbered from 0.  ``path`` is a
    tokenizer file that every executor can read.

    A null or empty text is END alone.  Rows that repeat are documents of their own; a
    null id stays null; an empty table has no pieces.  Other columns are not carried.
    """
    path = path or default_path()
    rows = only(docs, doc_id, text).select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    pieces = stored(pieces_of(rows, path, size))
    counts = sized_broadcast(pieces.groupBy("slice", "length").agg(F.count(F.lit(1)).alias("n")))
    # at most one row for each length
    total = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    placer = Placer(best_fit(total, size), size, slack)
    before = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    ahead = sized_broadcast(
        counts.select("slice", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    )
    place = _placed(placer)(F.col("length"), F.col("ahead") + F.col("k"))
    placed = pieces.join(ahead, ["slice", "length"]).select(
        "doc_id", "start", "doc_tokens", "ids", F.explode(place).alias("p")
    )
    return placed.select(
        "doc_id", (F.col("start") + F.col("p.skip")).alias("start"), F.col("p.length").alias("length"), "doc_tokens",
        F.col("p.sequence_id").alias("sequence_id"), F.col("p.offset").alias("offset"),
        F.substring("ids", (4 * F.col("p.skip") + 1).cast("int"), (4 * F.col("p.length")).cast("int")).alias("ids"),
    )
