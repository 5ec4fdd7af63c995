"""SentencePiece BPE: encoding in vectorised merge rounds, and decoding.

``Pieces`` reads a model file; ``encode`` and ``decode`` apply it to a column.
Merging never joins across a space that follows other characters, since no piece
of such a model has one inside (checked on loading), so a text is cut there, each
distinct segment is merged once, and the results are put together again.

One round: every segment finds its best pair (the lowest rank over the segment's
pairs), merges that pair wherever it stands, leftmost first, and all segments'
symbols are compacted, until no segment has a pair left.  The library takes one
pair at a time instead.  Both agree as long as a merge doesn't make a better
pair beside itself; where it does, the round stops there for that segment.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from waybill.llm.words import hand_back

SPACE = "▁"
CACHED = 250_000  # segments remembered by one Python worker
SLICE = 500_000  # characters of text taken at once
ROWS = 400  # rows of a batch that Python holds at once
ROUND = 100_000  # characters of new segments merged at once; fits a processor's cache
NONE = np.int64(1) << 30
NORMAL, UNKNOWN, USER_DEFINED, BYTE = 1, 2, 4, 6


class Pieces:
    """A BPE model with byte fallback, without normalisation beyond spaces."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        rules = model.normalizer_spec
        kinds = [p.type for p in model.pieces]
        names = [p.piece for p in model.pieces]
        words = {names[i]: i for i, k in enumerate(kinds) if k == NORMAL}
        if (
            model.trainer_spec.model_type != pb.TrainerSpec.BPE or not model.trainer_spec.byte_fallback
            or rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.add_dummy_prefix
            or not rules.escape_whitespaces or model.trainer_spec.treat_whitespace_as_suffix
            or USER_DEFINED in kinds or any(SPACE in w.lstrip(SPACE) for w in words)
        ):
            raise ValueError("only BPE models with byte fallback, a dummy prefix and no normalisation")

        self.bytes_at = np.zeros(256, np.int64)
        for i, k in enumerate(kinds):
            if k == BYTE:
                self.bytes_at[int(names[i][1:-1], 16)] = i
        self.is_byte = np.array([k == BYTE for k in kinds])
        self.shown = [
            names[i].replace(SPACE, " ").encode() if k == NORMAL
            else bytes([int(names[i][1:-1], 16)]) if k == BYTE
            else " ⁇ ".encode() if k == UNKNOWN else b""
            for i, k in enumerate(kinds)
        ]
        self.flat = np.frombuffer(b"".join(self.shown), np.uint8)
        self.sizes = np.array([len(s) for s in self.shown], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

        # Symbols: pieces by id, then characters that only occur inside pieces.
        symbol = dict(words)
        for w in words:
            for c in w:
                symbol.setdefault(c, len(names) + len(symbol) - len(words))
        single = {ord(w): i for w, i in symbol.items() if len(w) == 1}
        self.code_points = np.array(sorted(single), np.int64)
        self.code_symbols = np.array([single[c] for c in self.code_points.tolist()], np.int64)
        self.chars = {i: ord(w) for w, i in symbol.items() if i >= len(names)}

        # rank: 0 for the best score; equal scores share a rank
        scores = {i: model.pieces[i].score for i in words.values()}
        order = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        keys, ranks, made = [], [], []
        for w, i in words.items():
            for cut in range(1, len(w)):
                left, right = symbol.get(w[:cut]), symbol.get(w[cut:])
                if left is not None and right is not None:
                    keys.append(left * (1 << 32) + right)
                    ranks.append(order[scores[i]])
                    made.append(i)
        self.keys = np.array(keys, np.int64)
        self.ranks = np.array([*ranks, NONE], np.int64)  # the last stands for "no pair"
        self.made = np.array([*made, -1], np.int64)
        self.no_pair = len(keys)
        self._index_pairs()

        # What the segments met so far became: flat ids, by the segment's number.
        self._forget()
        # Runs of spaces fall into equal blocks from the left, if such runs are
        # the worst pieces; seen on the model itself.
        self.run = max((len(w) for w in words if w == SPACE * len(w)), default=0)
        self.run_id = words.get(SPACE * self.run, -1)
        tried = [SPACE * k for k in range(1, 4 * self.run + 2)]  # one at least
        ids, sizes = self._segments_ids(tried)
        seen = [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]
        worst = min(scores.values(), default=0)
        if self.run < 2 or any(scores[words[t]] != worst for t in tried if len(t) > 1 and t in words) or any(
            seen[k] != [self.run_id, *seen[k - self.run]] for k in range(self.run, len(seen))
        ):
            self.run = 0

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.met_ids = np.zeros(1 << 16, np.int32)
        self.met_ends = np.zeros(1, np.int64)

    def _index_pairs(self) -> None:
        """An open-addressed table of the pairs, looked up for whole arrays at once."""
        bits = max(4, int(len(self.keys) * 8).bit_length())
        self.shift = np.uint64(64 - bits)
        self.table = np.full((1 << bits) + 64, -1, np.int64)
        table = self.table.tolist()
        for i, slot in enumerate(self._slots(self.keys).tolist()):
            while table[slot] >= 0:
                slot += 1
            table[slot] = i
        self.table = np.array(table, np.int64)

    def _slots(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    # -- encoding ---------------------------------------------------------

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Number of each pair; ``no_pair`` where the two don't merge."""
        out = np.full(len(left), self.no_pair)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        key = left[todo] * (1 << 32) + right[todo]
        slot = self._slots(key)
        while len(todo):
            at = self.table[slot]
            here = at >= 0
            same = here & (self.keys[at] == key) if len(self.keys) else here
            out[todo[same]] = at[same]
            on = here & ~same
            todo, key, slot = todo[on], key[on], slot[on] + 1
        return out

    def _merged(self, symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge rounds over flat symbols; ``owner`` is each one's segment, ascending."""
        done: list[tuple[np.ndarray, ...]] = []
        place = np.arange(len(symbols))
        # each symbol's pair with the next one of its segment
        pair = np.full(len(symbols), self.no_pair)
        near = np.flatnonzero(owner[:-1] == owner[1:])
        pair[near] = self._pairs(symbols[near], symbols[near + 1])
        while len(symbols):
            rank = self.ranks[pair]
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            sizes = np.diff(np.append(first, len(symbols)))
            best = np.minimum.reduceat(rank, first)
            live = best < NONE
            if not live.all():  # segments without a pair are finished
                keep = np.repeat(live, sizes)
                done.append((symbols[~keep], owner[~keep], place[~keep]))
                symbols, owner, place, pair, rank = (x[keep] for x in (symbols, owner, place, pair, rank))
                best, sizes = best[live], sizes[live]
                if not len(symbols):
                    break
            hit = np.flatnonzero(rank == np.repeat(best, sizes))
            # of overlapping occurrences every second one goes, from the left
            number = np.arange(len(hit))
            run = np.maximum.accumulate(np.where(np.append(True, np.diff(hit) != 1), number, 0))
            hit = hit[(number - run) % 2 == 0]
            new = self.made[pair[hit]]
            mine = owner[hit]
            # what would stand beside a merged pair: before it, what is merged already
            back, ahead = np.maximum(hit - 1, 0), np.minimum(hit + 2, len(symbols) - 1)
            before = np.where((hit > 0) & (owner[back] == mine), symbols[back], -1)
            joins = np.append(False, hit[1:] - hit[:-1] == 2) & (before >= 0)
            before[joins] = new[np.flatnonzero(joins) - 1]
            after = np.where((hit + 2 < len(symbols)) & (owner[ahead] == mine), symbols[ahead], -1)
            better = np.minimum(self.ranks[self._pairs(before, new)], self.ranks[self._pairs(new, after)])
            stops = better <= rank[hit]
            if stops.any():  # only the occurrences up to the segment's first such one
                number = np.arange(len(hit))
                begin = np.maximum.accumulate(np.where(np.append(True, mine[1:] != mine[:-1]), number, 0))
                so_far = np.cumsum(stops) - stops
                kept = so_far == so_far[begin]
                hit, new = hit[kept], new[kept]
            symbols[hit] = new
            changed = np.zeros(len(symbols), bool)
            changed[hit] = True
            changed[np.maximum(hit - 1, 0)] = True
            stay = np.ones(len(symbols), bool)
            stay[hit + 1] = False
            symbols, owner, place, pair, changed = (x[stay] for x in (symbols, owner, place, pair, changed))
            at = np.flatnonzero(changed)
            pair[at] = self.no_pair
            at = at[at + 1 < len(symbols)]
            at = at[owner[at] == owner[at + 1]]
            pair[at] = self._pairs(symbols[at], symbols[at + 1])
        symbols, owner, place = (np.concatenate(x) for x in zip(*done)) if done else (symbols, owner, place)
        by = np.argsort(place, kind="stable")
        return symbols[by], owner[by]

    def _segments_ids(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the segments, all merged together, and how many each has."""
        points = np.frombuffer("".join(segments).encode("utf-32-le"), np.uint32).astype(np.int64)
        owner = np.repeat(np.arange(len(segments)), [len(s) for s in segments])
        at = np.minimum(np.searchsorted(self.code_points, points), len(self.code_points) - 1)
        known = self.code_points[at] == points
        # characters outside the vocabulary are kept as such, below -1
        symbols, owner = self._merged(np.where(known, self.code_symbols[at], -2 - points), owner)
        odd = np.flatnonzero((symbols < 0) | (symbols >= len(self.shown)))
        if len(odd):  # characters that are no pieces are spelt in bytes
            spelt = [chr(self.chars.get(s, -2 - s)).encode() for s in symbols[odd].tolist()]
            times = np.ones(len(symbols), np.int64)
            times[odd] = [len(x) for x in spelt]
            owner, symbols = np.repeat(owner, times), np.repeat(symbols, times)
            symbols[(symbols < 0) | (symbols >= len(self.shown))] = self.bytes_at[list(b"".join(spelt))]
        return symbols.astype(np.int32), np.bincount(owner, minlength=len(segments))

    def _cut(self, text: str) -> list[str]:
        """Segments: some spaces and what follows them up to the next space."""
        parts = text.replace(" ", SPACE).split(SPACE)
        segments, spaces = [], 1  # the dummy prefix
        if parts[0]:
            segments.append(SPACE + parts[0])
            spaces = 0
        for part in parts[1:]:
            spaces += 1
            if part:
                segments.append(SPACE * spaces + part if spaces > 1 else SPACE + part)
                spaces = 0
        if spaces:
            segments.append(SPACE * spaces)
        return segments

    def _without_runs(self, segment: str) -> tuple[int, str]:
        """How many pieces of the longest run come first, and the rest."""
        if not self.run or not segment.startswith(SPACE * (self.run + 1)):
            return 0, segment
        spaces = len(segment) - len(segment.lstrip(SPACE))
        blocks = (spaces - 1) // self.run
        return blocks, segment[blocks * self.run:]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of every text, without begin and end; none for null and empty."""
        out: list[np.ndarray] = []
        begin = 0
        while begin < len(texts):  # slices bound what a round holds
            end, size = begin, 0
            while end < len(texts) and (end == begin or size < SLICE):
                size += len(texts[end] or "")
                end += 1
            out += self._encode_slice(texts[begin:end])
            begin = end
        return out

    def _encode_slice(self, texts: list[str | None]) -> list[np.ndarray]:
        if not texts:
            return []
        cut = [self._cut(t) if t else [] for t in texts]
        if len(self.number) > CACHED:
            self._forget()
        flat = list(chain.from_iterable(cut))
        at = np.fromiter(map(self.number.get, flat, repeat(-1)), np.int64, len(flat))
        new = np.flatnonzero(at < 0)
        if len(new):
            self._learn(list(dict.fromkeys(flat[i] for i in new.tolist())))
            at[new] = [self.number[flat[i]] for i in new.tolist()]
        starts = self.met_ends[at]
        sizes = self.met_ends[at + 1] - starts
        ends = np.append(0, np.cumsum(sizes))
        ids = self.met_ids[np.arange(ends[-1]) + np.repeat(starts - ends[:-1], sizes)]
        return np.split(ids, ends[np.cumsum([len(c) for c in cut])[:-1]])

    def _learn(self, segments: list[str]) -> None:
        begin = 0
        while begin < len(segments):
            end, size = begin, 0
            while end < len(segments) and (end == begin or size < ROUND):
                size += len(segments[end])
                end += 1
            part = segments[begin:end]
            rests = [self._without_runs(s) for s in part]
            ids, sizes = self._segments_ids([rest for _, rest in rests])
            blocks = np.array([n for n, _ in rests])
            if blocks.any():
                ids = np.insert(ids, np.repeat(np.cumsum(sizes) - sizes, blocks), self.run_id)
                sizes = sizes + blocks
            self._remember(part, ids, sizes)
            begin = end

    def _remember(self, segments: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        used, count = int(self.met_ends[-1]), len(self.met_ends) - 1
        if used + len(ids) > len(self.met_ids):
            self.met_ids = np.append(self.met_ids[:used], np.zeros(used + 2 * len(ids), np.int32))
        self.met_ids[used:used + len(ids)] = ids
        self.met_ends = np.append(self.met_ends, used + np.cumsum(sizes))
        self.number.update(zip(segments, range(count, count + len(segments))))

    # -- decoding ---------------------------------------------------------

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """The texts of flat ids; ``ends[i]`` to ``ends[i + 1]`` are text i's."""
        sizes = self.sizes[ids]
        stops = np.append(0, np.cumsum(sizes))
        at = np.arange(stops[-1]) + np.repeat(self.starts[ids] - stops[:-1], sizes)
        flat = self.flat[at].tobytes()
        out = []
        for begin, end in zip(ends[:-1].tolist(), ends[1:].tolist()):
            raw = flat[stops[begin]:stops[end]]
            # control pieces show nothing, so the first shown piece may come later
            if raw[:1] == b" " and (lead := self._first_shown(ids, begin, end)) is not None and not self.is_byte[lead]:
                raw = raw[1:] if self.shown[lead][:1] == b" " and lead != 0 else raw
            try:
                out.append(raw.decode())
            except UnicodeDecodeError:
                out.append(_one_by_one(raw))
        return out

    def _first_shown(self, ids: np.ndarray, begin: int, end: int) -> int | None:
        for i in range(begin, end):
            if self.sizes[ids[i]]:
                return int(ids[i])
        return None


def _one_by_one(raw: bytes) -> str:
    """UTF-8 with each byte that belongs to no character replaced on its own."""
    out, i = [], 0
    while i < len(raw):
        for n in (1, 2, 3, 4):
            try:
                out.append(raw[i:i + n].decode())
                i += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            i += 1
    return "".join(out)


_LOADED: dict[str, Pieces] = {}


def loaded(path: str) -> Pieces:
    """The model, read once by each Python worker."""
    if path not in _LOADED:
        _LOADED[path] = Pieces(path)
    return _LOADED[path]


def default_path() -> str:
    """$PIECE_MODEL, or the installed public vocabulary."""
    import public_tokenizers

    return os.environ.get("PIECE_MODEL") or public_tokenizers.path("piece_bpe_32k.model")


def _with(df: DataFrame, name: str, kind: T.DataType, column: str, make) -> DataFrame:
    if name in df.columns:
        raise ValueError(f"the table has a column {name} already")
    schema = T.StructType([*df.schema.fields, T.StructField(name, kind)])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            hand_back()
            for begin in range(0, whole.num_rows, ROWS):
                batch = whole.slice(begin, ROWS)
                made = make(batch.column(column))
                yield pa.RecordBatch.from_arrays([*batch.columns, made], names=[*batch.schema.names, name])
            del whole, batch, made
        hand_back()

    return df.mapInArrow(each, schema)


def encode(df: DataFrame, text: str = "text", ids: str = "ids", model: str | None = None) -> DataFrame:
    """Adds the array of ids of ``text``; null and empty texts have none.

    ``model`` is a path that every executor can read.
    """
    path = model or default_path()

    def make(column: pa.Array) -> pa.Array:
        parts = loaded(path).encode(column.to_pylist())
        ends = np.cumsum([0, *map(len, parts)])
        flat = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat, pa.int32()))

    return _with(df, ids, T.ArrayType(T.IntegerType()), text, make)


def decode(df: DataFrame, ids: str = "ids", text: str = "decoded", model: str | None = None) -> DataFrame:
    """Adds the text of the array ``ids``; null is read as no ids."""
    path = model or default_path()

    def make(column: pa.Array) -> pa.Array:
        lists = column.fill_null([]) if column.null_count else column
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.append(0, np.cumsum(_lengths(lists)))
        return pa.array(loaded(path).decode(flat, ends), pa.string())

    return _with(df, text, T.StringType(), ids, make)


def _lengths(lists: pa.ListArray) -> np.ndarray:
    return pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
