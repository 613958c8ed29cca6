"""Byte-level BPE encoding and decoding.

Pre-tokenisation runs without a regular expression. Every code point maps to a class; a class is a function on the
states of a small automaton; functions compose associatively, so their finite monoid is enumerated once and a whole
stream of characters is scanned in blocks with one table lookup a character. Boundaries follow from the state before
a character, its class and the class after it. The slices between boundaries go through pair merging behind a bounded
cache, and the byte offset at which each token ends is retained, with which any range of tokens decodes on its own.

Texts: null encodes as the empty text. Texts of any length are scanned in windows that end at sure boundaries.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from hexpanel.llm._util import slim

LETTER, NUMBER, OTHER, APOSTROPHE1, APOSTROPHE2, SPACE, WHITE, END = range(8)
BEGIN, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_SPACE, AFTER_WHITE, ONE_MORE, TWO_MORE = range(8)
BLOCK = 256
WINDOW = 1 << 18
SHORT = 48  # bytes of a piece up to which pieces merge together, and are cached
NONE = np.iinfo(np.int32).max

#: The code points with the Unicode property White_Space.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def _step(state: int, kind: int) -> int:
    if kind == END or state == ONE_MORE:
        return BEGIN
    if state == TWO_MORE:
        return ONE_MORE
    if kind in (APOSTROPHE1, APOSTROPHE2):  # a contraction only where a token begins with the apostrophe itself
        return IN_OTHERS if state in (IN_OTHERS, AFTER_SPACE) else ONE_MORE if kind == APOSTROPHE1 else TWO_MORE
    return {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS, SPACE: AFTER_SPACE, WHITE: AFTER_WHITE}[kind]


def _begins(state: int, kind: int, solid_next: bool) -> bool:
    """Whether a token begins at a character; solid_next: something other than white space follows it."""
    if kind == END or state in (ONE_MORE, TWO_MORE):
        return False
    if state == BEGIN:
        return True
    if kind in (SPACE, WHITE):
        return solid_next if state in (AFTER_SPACE, AFTER_WHITE) else True
    same = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS}.get(kind, IN_OTHERS)
    return state not in (same, AFTER_SPACE)


@lru_cache(1)
def _tables() -> tuple[np.ndarray, ...]:
    """Class of each code point; the monoid: element of each class, composition, application; step and boundary tables."""
    kinds = np.full(0x110000, OTHER, np.uint8)
    for c in range(0x110000):
        first = unicodedata.category(chr(c))[0]
        if first in "LN":
            kinds[c] = LETTER if first == "L" else NUMBER
    kinds[WHITE_SPACE] = WHITE
    kinds[0x20] = SPACE
    step = np.array([[_step(s, k) for k in range(8)] for s in range(8)], np.uint8)
    begins = np.array([[[_begins(s, k, n) for n in (False, True)] for k in range(8)] for s in range(8)])
    of_kind = [tuple(map(int, step[:, k])) for k in range(8)]
    elements = {tuple(range(8)): 0}
    frontier = list(elements)
    while frontier:
        f = frontier.pop()
        for g in of_kind:
            h = tuple(g[x] for x in f)
            if h not in elements:
                elements[h] = len(elements)
                frontier.append(h)
    listed = list(elements)
    compose = np.array([[elements[tuple(g[x] for x in f)] for g in listed] for f in listed], np.uint16)
    return kinds, np.array([elements[f] for f in of_kind], np.uint16), compose, np.array(listed, np.uint8), step, begins


def boundaries(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Positions in a stream of code points at which tokens begin. ends: positions of the marks that close each text."""
    kinds, element, compose, apply, step, begins = _tables()
    n = len(points)
    blocks = -(-(n + 1) // BLOCK)
    flat = np.full(blocks * BLOCK, END, np.uint8)
    np.take(kinds, points, out=flat[:n])
    flat[ends] = END
    at = np.flatnonzero(points == 0x27)
    if len(at):
        near = [np.where(flat[np.minimum(at + d, n)] == END, 0, points[np.minimum(at + d, n - 1)]) for d in (1, 2)]
        a, b = near
        flat[at[np.isin(a, [0x73, 0x74, 0x6D, 0x64])]] = APOSTROPHE1
        flat[at[((a == 0x72) | (a == 0x76)) & (b == 0x65) | (a == 0x6C) & (b == 0x6C)]] = APOSTROPHE2
        flat[ends] = END
    by_row = np.ascontiguousarray(flat.reshape(blocks, BLOCK).T)
    acc = element[by_row[0]]
    for row in by_row[1:]:
        acc = compose[acc, element[row]]
    reach = 1
    while reach < blocks:  # inclusive scan of the blocks' functions
        acc = np.concatenate([acc[:reach], compose[acc[:-reach], acc[reach:]]])
        reach *= 2
    state = np.empty(blocks, np.uint8)
    state[0] = BEGIN
    state[1:] = apply[acc[:-1], BEGIN]
    before = np.empty_like(by_row)
    for i, row in enumerate(by_row):
        before[i] = state
        state = step[state, row]
    solid = np.zeros(len(flat), np.uint8)
    solid[:-1] = flat[1:] < SPACE
    return np.flatnonzero(begins[np.ascontiguousarray(before.T).ravel(), flat, solid])


class Codec:
    """Encoder and decoder of one set of merge ranks."""

    def __init__(self, ranks: dict[bytes, int], cache: int = 1 << 16):
        self.ranks, self.cache, self.most = ranks, {}, cache
        size = max(ranks.values()) + 1
        self.words = [b""] * size
        for word, i in ranks.items():
            self.words[i] = word
        self.widths = np.array([len(w) for w in self.words], np.int64)
        self.bytes_ = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.pairs = self._pairs()

    @classmethod
    def parse(cls, data: bytes) -> Codec:
        return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a})

    def _pairs(self) -> tuple[np.ndarray, np.ndarray, int]:
        """Open-addressing table from two adjacent ids to the rank of their concatenation."""
        get, keys, found = self.ranks.get, [], []
        for word, rank in self.ranks.items():
            for k in range(1, len(word)):
                a, b = get(word[:k]), get(word[k:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    found.append(rank)
        bits = max(4, (4 * len(keys)).bit_length())
        table, ranks = np.full(1 << bits, -1, np.int64), np.full(1 << bits, NONE, np.int32)
        left, values = np.array(keys, np.int64), np.array(found, np.int32)
        at = self._slot(left, 64 - bits)
        while len(left):
            free = table[at] < 0
            first = np.zeros(len(left), bool)
            first[np.unique(np.where(free, at, -1), return_index=True)[1]] = True
            put = free & first
            table[at[put]], ranks[at[put]] = left[put], values[put]
            left, values, at = left[~put], values[~put], (at[~put] + (table[at[~put]] >= 0)) & (len(table) - 1)
        return table, ranks, 64 - bits

    @staticmethod
    def _slot(keys: np.ndarray, shift: int) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(shift)).astype(np.int64)

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        table, ranks, shift = self.pairs
        keys = a.astype(np.int64) << 32 | b
        at = self._slot(keys, shift)
        there = table[at]
        out = np.where(there == keys, ranks[at], NONE)
        look = np.flatnonzero((there != keys) & (there >= 0))
        while len(look):
            at[look] = (at[look] + 1) & (len(table) - 1)
            there = table[at[look]]
            hit = there == keys[look]
            out[look[hit]] = ranks[at[look[hit]]]
            look = look[~hit & (there >= 0)]
        return out

    def merge_all(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """Pair merging of many short pieces at once: in each round every piece merges its pair of lowest rank, the
        leftmost of equals, until none has one left. Parts are linked lists in the rows of a matrix."""
        rows, width = len(pieces), max(map(len, pieces))
        lengths = np.fromiter(map(len, pieces), np.int64, rows)
        raw = np.frombuffer(b"".join([x.ljust(width, b"\0") for x in pieces]), np.uint8).reshape(rows, width)
        part = self.bytes_[raw]
        place = np.arange(width)
        inside = place[None, :] < lengths[:, None]
        rank = np.full((rows, width), NONE, np.int32)
        if width > 1:
            both = inside[:, 1:]
            rank[:, :-1][both] = self._rank(part[:, :-1][both], part[:, 1:][both])
        after = np.broadcast_to(place + 1, (rows, width)).copy()
        ahead = np.broadcast_to(place - 1, (rows, width)).copy()
        live = np.arange(rows)
        while len(live):
            at = rank[live].argmin(axis=1)
            low = rank[live, at]
            go = low != NONE
            live, at, low = live[go], at[go], low[go]
            gone = after[live, at]
            beyond = after[live, gone]
            part[live, at], after[live, at], rank[live, gone], inside[live, gone] = low, beyond, NONE, False
            rank[live, at] = NONE
            more = beyond < lengths[live]
            r, i, j = live[more], at[more], beyond[more]
            ahead[r, j] = i
            rank[r, i] = self._rank(part[r, i], part[r, j])
            more = at > 0
            r, i = live[more], at[more]
            j = ahead[r, i]
            rank[r, j] = self._rank(part[r, j], part[r, i])
        ids, ends = part[inside].tolist(), np.cumsum(inside.sum(1)).tolist()
        return [tuple(ids[a:b]) for a, b in zip([0, *ends], ends, strict=False)]

    def _merge_long(self, piece: bytes) -> tuple[int, ...]:
        """The same for one long piece, by a heap over a linked list: n log n in its length."""
        ranks, n = self.ranks, len(piece)
        end = list(range(1, n + 1))  # end of the part that starts here; 0: merged into the one before
        prev = list(range(-1, n - 1))
        heap = []

        def offer(a: int) -> None:
            b = end[a]
            if b < n and (r := ranks.get(piece[a : end[b]])) is not None:
                heapq.heappush(heap, (r, a, b, end[b]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, a, b, c = heapq.heappop(heap)
            if end[a] != b or b >= n or end[b] != c:
                continue
            end[a], end[b] = c, 0
            if c < n:
                prev[c] = a
            offer(a)
            if a:
                offer(prev[a])
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : end[i]]])
            i = end[i]
        return tuple(out)

    def _ids(self, pieces: list[str]) -> list[tuple[int, ...]]:
        found = list(map(self.cache.get, pieces))
        new: dict[str, tuple[int, ...]] = dict.fromkeys(p for p, ids in zip(pieces, found, strict=True) if ids is None)
        short: dict[str, bytes] = {}
        for p in new:
            raw = p.encode()
            if raw in self.ranks:
                new[p] = (self.ranks[raw],)
            elif len(raw) > SHORT:
                new[p] = self._merge_long(raw)
            else:
                short[p] = raw
        by_length = sorted(short, key=lambda p: len(short[p]))
        for at in range(0, len(by_length), 8192):
            some = by_length[at : at + 8192]
            new.update(zip(some, self.merge_all([short[p] for p in some]), strict=True))
        if len(self.cache) + len(new) > self.most:
            self.cache.clear()
        self.cache.update((p, ids) for p, ids in islice(new.items(), self.most) if len(p) <= SHORT)
        return [new[p] if ids is None else ids for p, ids in zip(pieces, found, strict=True)]

    def _stream(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of some texts one after another, and the number of ids of each."""
        joined = "\0".join(texts) + "\0"
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        close = np.cumsum([len(t) + 1 for t in texts]) - 1
        starts = boundaries(points, close)
        after = np.minimum(np.append(starts[1:], len(joined)), close[np.searchsorted(close, starts)])
        ids = self._ids([joined[a:b] for a, b in zip(starts.tolist(), after.tolist(), strict=True)])
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.int32, int(counts.sum()))
        total = np.concatenate([[0], np.cumsum(counts)])
        upto = total[np.searchsorted(starts, close)]
        return flat, np.diff(upto, prepend=0)

    def _long(self, text: str) -> np.ndarray:
        """Windows over one long text; each ends where a token surely begins."""
        out, at, width = [], 0, WINDOW
        while at < len(text):
            part = text[at : at + width]
            if at + width < len(text):
                points = np.frombuffer(part.encode("utf-32-le"), np.uint32)
                starts = boundaries(points, np.empty(0, np.int64))
                solid = _tables()[0][points] < SPACE
                sure = starts[(starts < len(part) - 4) & (starts > 0)]
                sure = sure[solid[sure] & solid[sure - 1]]  # white space before a cut would read as the end of a text
                if not len(sure):
                    width *= 2
                    continue
                part = part[: sure[-1]]
            out.append(self._stream([part])[0])
            at, width = at + len(part), WINDOW
        return np.concatenate(out)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts in one array, ids a text, and the byte offset in its text at which each token ends."""
        ids, counts, batch, chars = [], [], [], 0

        def flush() -> None:
            nonlocal batch, chars
            if batch:
                flat, n = self._stream(batch)
                ids.append(flat)
                counts.append(n)
            batch, chars = [], 0

        for t in texts:
            if len(t) > 2 * WINDOW:
                flush()
                ids.append(self._long(t))
                counts.append(np.array([len(ids[-1])]))
                continue
            batch.append(t)
            chars += len(t)
            if chars > WINDOW:
                flush()
        flush()
        flat = np.concatenate([np.empty(0, np.int32), *ids])
        n = np.concatenate([np.empty(0, np.int64), *counts]).astype(np.int64)
        upto = np.cumsum(self.widths[flat])
        first = np.cumsum(n) - n
        base = np.where(n > 0, upto[np.minimum(first, max(len(flat) - 1, 0))] - self.widths[flat[np.minimum(first, max(len(flat) - 1, 0))]], 0) if len(flat) else np.zeros(len(n), np.int64)
        return flat, n, (upto - np.repeat(base, n)).astype(np.int64)

    def decode(self, ids: list[int]) -> bytes:
        words = self.words
        return b"".join([words[i] for i in ids])

    def decode_range(self, ids: list[int], ends: list[int], start: int, stop: int) -> tuple[int, bytes]:
        """Tokens start to stop alone: the byte offset of the first in its text, and their bytes."""
        return (ends[start - 1] if start else 0), self.decode(ids[start:stop])


_CODECS: dict[str, Codec] = {}


def _codec(data: bytes) -> Codec:
    key = hashlib.sha256(data).hexdigest()
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec.parse(data)
    return _CODECS[key]


def _share(df: DataFrame, ranks_path: str):
    """The rank file, read where the job is planned and broadcast: a vocabulary is under 2 MB whatever the corpus."""
    with open(ranks_path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


ROWS = 128  # rows a step: ids of one step, not of an Arrow batch, are held at a time


def _add(df: DataFrame, into: str, kind: str, arrow: pa.DataType, fill: Callable[[pa.RecordBatch], pa.Array]) -> DataFrame:
    """df with a column made from each few rows; a column of that name is replaced."""
    rest = df.drop(into) if into in df.columns else df
    names = rest.columns
    schema = StructType([*rest.schema.fields, StructField(into, _parse_datatype_string(kind))])

    @slim
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(names))), fill(part).cast(arrow)], [*names, into])

    return rest.mapInArrow(run, schema)


def _encoded(codec: Codec, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array, pa.Array]:
    """Ids of some texts one after another, where each text's begin, and the lists of ids and of ends."""
    ids, n, ends = codec.encode([t or "" for t in texts.to_pylist()])
    at = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
    return ids, at, pa.ListArray.from_arrays(pa.array(at), pa.array(ids, pa.int32())), pa.ListArray.from_arrays(pa.array(at), pa.array(ends.astype(np.int32)))


def encode(df: DataFrame, ranks_path: str, text: str = "text", into: str = "encoded") -> DataFrame:
    """Adds a struct column `into`: ids array<int> and ends array<int>, the byte offset in the UTF-8 text at which each
    token ends. Null and empty texts have empty arrays. The text column must not be called like `into`; another column
    of that name is replaced. Rows keep their number."""
    shared = _share(df, ranks_path)
    at_text = [c for c in df.columns if c != into].index(text)

    def fill(rows: pa.RecordBatch) -> pa.Array:
        return pa.StructArray.from_arrays(_encoded(_codec(shared.value), rows.column(at_text))[2:], ["ids", "ends"])

    return _add(df, into, "struct<ids:array<int>,ends:array<int>>", pa.struct([("ids", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32()))]), fill)


def round_trip(df: DataFrame, ranks_path: str, text: str = "text", into: str = "encoded") -> DataFrame:
    """As `encode`, with a third field, decoded binary: the bytes that the ids decode to. One Python worker does both, where
    `decode` after `encode` takes two workers a task, each with the vocabulary."""
    shared = _share(df, ranks_path)
    at_text = [c for c in df.columns if c != into].index(text)

    def fill(rows: pa.RecordBatch) -> pa.Array:
        codec = _codec(shared.value)
        flat, at, ids, ends = _encoded(codec, rows.column(at_text))
        decoded = [codec.decode(flat[a:b].tolist()) for a, b in zip(at, at[1:], strict=False)]
        return pa.StructArray.from_arrays([ids, ends, pa.array(decoded, pa.binary())], ["ids", "ends", "decoded"])

    kind = pa.struct([("ids", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())), ("decoded", pa.binary())])
    return _add(df, into, "struct<ids:array<int>,ends:array<int>,decoded:binary>", kind, fill)


def decode(df: DataFrame, ranks_path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """Adds a binary column `into`, the bytes of the tokens; null ids decode to no bytes. Unknown ids fail the job."""
    shared = _share(df, ranks_path)
    at_ids = [c for c in df.columns if c != into].index(ids)

    def fill(rows: pa.RecordBatch) -> pa.Array:
        codec, lists = _codec(shared.value), rows.column(at_ids)
        flat, at = lists.flatten().to_numpy(zero_copy_only=False).tolist(), np.cumsum([0, *lists.value_lengths().fill_null(0).to_pylist()]).tolist()
        return pa.array([codec.decode(flat[a:b]) for a, b in zip(at, at[1:], strict=False)], pa.binary())

    return _add(df, into, "binary", pa.binary(), fill)
