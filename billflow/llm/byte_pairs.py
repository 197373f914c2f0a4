"""Byte-level byte-pair encoding and decoding with vectorised splitting.

Splitting needs no pattern matching: each code point has a class (letter, number, white space, other), looked up
in one array. With what follows it folded in (an apostrophe before a contraction's letters, white space before
more white space or before something else) a character is one of eight symbols, and a small automaton says after
each symbol whether it began a new piece. Its transitions are functions from states to states, whose composition
is associative: a batch is laid out in rows, the functions of each row are composed for all states at once, a
doubling scan over the rows gives the state that enters each, and a second pass marks where pieces begin. The
first character of a text has a constant function, so texts of a batch stand one behind the other.

The pieces are slices of the batch's bytes; each different slice of a batch is merged once, and what short slices
give is kept from batch to batch (a bounded store). Pairs merge in order of rank, the leftmost first; long slices
use a heap, so that one without any blank costs n log n. Each row keeps its ids and the place where each id's
bytes end, both packed as little-endian unsigned 32-bit numbers. Decoding copies all tokens' bytes to the places
that these ends, or the tokens' lengths where there are none, name.

Rows stay where they are. Null text and empty text: no ids, decoded to nothing. Very long texts stand alone in
their batch (at most 4 GB by the packed ends). Repeated rows and rows of null doc_id are each answered. Empty
table: empty result. Only named columns are read, so further ones cannot clash.
"""

from __future__ import annotations

import base64
import heapq
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F

from billflow.llm.arrays import pieces, text_bytes

KEPT, KEPT_LENGTH = 400_000, 48  # slices, bytes of a slice
TEXT_AT_ONCE = 2 << 20  # bytes of text
SHORT = 64  # bytes up to which a slice is merged by plain search
NEVER = 1 << 40  # the rank of pairs that do not join

# fixed values: the contractions of the splitting pattern, by their number of letters
CONTRACTIONS = ("s", "t", "m", "d"), ("re", "ve", "ll")

# character classes
OTHER, LETTER, NUMBER, WHITE = range(4)
# symbols: characters with what follows them folded in
(S_LETTER, S_NUMBER, S_OTHER, S_QUOTE1, S_QUOTE2,
 S_WHITE,   # white space before white space or at the end
 S_JOIN,    # a blank before something else, which it joins
 S_LAST,    # other white space before something else
 ) = range(8)
# states: what the piece in progress is
(FRESH,     # complete: whatever comes begins a new one
 IN_LETTERS, IN_NUMBERS, IN_OTHERS, JOINING, IN_WHITE,
 ONE_MORE, TWO_MORE,  # letters of a contraction to come
 ) = range(8)


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """The next state and whether a piece begins, by (symbol, state)."""
    after = np.zeros((8, 8), dtype=np.uint8)
    begins = np.ones((8, 8), dtype=bool)
    after[S_LETTER], after[S_NUMBER], after[S_OTHER] = IN_LETTERS, IN_NUMBERS, IN_OTHERS
    after[S_QUOTE1], after[S_QUOTE2] = ONE_MORE, TWO_MORE
    after[S_WHITE], after[S_JOIN], after[S_LAST] = IN_WHITE, JOINING, FRESH
    for symbol, state in ((S_LETTER, IN_LETTERS), (S_NUMBER, IN_NUMBERS), (S_OTHER, IN_OTHERS)):
        begins[symbol, [state, JOINING]] = False
    for symbol in (S_QUOTE1, S_QUOTE2):  # an apostrophe within other characters is one of them
        after[symbol, [IN_OTHERS, JOINING]] = IN_OTHERS
        begins[symbol, [IN_OTHERS, JOINING]] = False
    begins[S_WHITE, IN_WHITE] = False
    after[:, ONE_MORE], after[:, TWO_MORE] = FRESH, ONE_MORE
    begins[:, [ONE_MORE, TWO_MORE]] = False
    return after, begins


_AFTER, _BEGINS = _automaton()
# the same with eight more symbols for a text's first character, whose functions are constant
_STEP = np.concatenate([_AFTER, np.repeat(_AFTER[:, FRESH:FRESH + 1], 8, 1)]).ravel()
_NEW = np.concatenate([_BEGINS, np.ones((8, 8), dtype=bool)]).ravel()


@lru_cache(maxsize=1)
def character_classes() -> bytes:
    """The class of every code point, compressed, as the library that is matched has it: one-class patterns over
    all code points tell which belong."""
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    text = "".join(map(chr, points))
    table = np.full(0x110000, OTHER, dtype=np.uint8)
    ranks = {bytes([b]): b for b in range(256)}
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (WHITE, r"\s")):
        one = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        of_class = bytes(one.encode_ordinary(text)).decode()
        table[np.frombuffer(of_class.encode("utf-32-le"), dtype=np.uint32)] = kind
    return zlib.compress(table.tobytes(), 6)


def symbols(points: np.ndarray, classes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The symbol of each code point; `first` marks where texts begin."""
    kind = classes[points]
    ends = np.ones(len(points), dtype=bool)
    ends[:-1] = first[1:]
    white = kind == WHITE
    before_other = np.zeros(len(points), dtype=bool)
    before_other[:-1] = ~white[1:]
    before_other &= ~ends
    out = np.array([S_OTHER, S_LETTER, S_NUMBER, S_WHITE], dtype=np.uint8)[kind]
    out[white & before_other] = S_LAST
    out[(points == 0x20) & before_other] = S_JOIN
    quote = np.flatnonzero(points == 0x27)
    if len(quote):
        padded = np.concatenate([points, np.zeros(2, dtype=points.dtype)])
        stop = np.concatenate([ends, np.ones(2, dtype=bool)])
        one, two = padded[quote + 1], padded[quote + 2]
        room = ~stop[quote]
        hit = room & np.isin(one, [ord(c) for c in CONTRACTIONS[0]])
        out[quote[hit]] = S_QUOTE1
        room &= ~stop[quote + 1]
        pairs = [ord(a) << 32 | ord(b) for a, b in CONTRACTIONS[1]]
        hit = room & np.isin(one.astype(np.int64) << 32 | two.astype(np.int64), pairs)
        out[quote[hit]] = S_QUOTE2
    out[first] += 8
    return out


def piece_starts(symbol: np.ndarray) -> np.ndarray:
    """Whether each character begins a piece, by composing the transitions."""
    n = len(symbol)
    if not n:
        return np.zeros(0, dtype=bool)
    columns = max(16, int(np.sqrt(n) / 4))
    rows = -(-n // columns)
    grid = np.zeros(rows * columns, dtype=np.uint8)
    grid[:n] = symbol
    grid = np.ascontiguousarray(grid.reshape(rows, columns).T) << 3  # one line for each step
    # what each row makes of every state
    maps = np.tile(np.arange(8, dtype=np.uint8), (rows, 1))
    for line in grid:
        maps = _STEP[line[:, None] | maps]
    # composed with all rows before
    reach = 1
    while reach < rows:
        maps[reach:] = np.take_along_axis(maps[reach:], maps[:-reach], 1)
        reach *= 2
    state = np.concatenate([[FRESH], maps[:-1, FRESH]]).astype(np.uint8)
    begins = np.empty((columns, rows), dtype=bool)
    for k, line in enumerate(grid):
        at = line | state
        begins[k] = _NEW[at]
        state = _STEP[at]
    return begins.T.ravel()[:n]


def read_ranks(content: bytes) -> dict[bytes, int]:
    """The tokens of a rank file: base64 bytes and rank on each line."""
    return {base64.b64decode(token): int(rank)
            for token, rank in (line.split() for line in content.splitlines() if line)}


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one piece: again and again the pair of the lowest rank joins, the leftmost of equal ones."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    if len(piece) <= SHORT:
        cuts = list(range(len(piece) + 1))
        joins = [ranks.get(piece[i:i + 2], NEVER) for i in range(len(piece) - 1)]
        while joins and (best := min(joins)) != NEVER:
            at = joins.index(best)
            del joins[at], cuts[at + 1]
            if at < len(joins):
                joins[at] = ranks.get(piece[cuts[at]:cuts[at + 2]], NEVER)
            if at:
                joins[at - 1] = ranks.get(piece[cuts[at - 1]:cuts[at + 1]], NEVER)
        return [ranks[piece[i:j]] for i, j in zip(cuts, cuts[1:])]
    n = len(piece)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # by where a part begins; 0: gone
    queue = []

    def offer(i: int) -> None:
        if end[i] < n:
            rank = ranks.get(piece[i:end[end[i]]])
            if rank is not None:
                queue.append((rank, i, end[end[i]]))

    for i in range(n):
        offer(i)
    heapq.heapify(queue)
    while queue:
        rank, i, stop = heapq.heappop(queue)
        if not end[i] or end[i] >= n or end[end[i]] != stop:
            continue
        gone = end[i]
        end[i], end[gone] = stop, 0
        if stop < n:
            before[stop] = i
        for k in (i, before[i]):
            if k >= 0 and end[k] < n:
                again = ranks.get(piece[k:end[end[k]]])
                if again is not None:
                    heapq.heappush(queue, (again, k, end[end[k]]))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i:end[i]]])
        i = end[i]
    return ids


class Encoder:
    """Encodes batches of texts; holds the vocabulary and what short slices gave before."""

    def __init__(self, ranks: dict[bytes, int], classes: np.ndarray) -> None:
        self.ranks, self.classes = ranks, classes
        self.kept: dict[bytes, list[int]] = {}
        self.length = np.zeros(max(ranks.values(), default=-1) + 1, dtype=np.int64)
        for token, rank in ranks.items():
            self.length[rank] = len(token)

    def piece(self, data: bytes) -> list[int]:
        ids = self.kept.get(data)
        if ids is None:
            ids = merged(data, self.ranks)
            if len(data) <= KEPT_LENGTH:
                if len(self.kept) >= KEPT:
                    self.kept.clear()
                self.kept[data] = ids
        return ids

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and where those of each text begin."""
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(bounds), np.int64)
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), dtype=np.uint32)
        if len(points) == len(data):
            starts = bounds
        else:
            place = np.flatnonzero(data & 0xC0 != 0x80)
            starts = np.searchsorted(place, bounds)
        first = np.zeros(len(points) + 1, dtype=bool)
        first[starts] = True
        begin = np.flatnonzero(piece_starts(symbols(points, self.classes, first[:-1])))
        if len(points) != len(data):
            begin = place[begin]
        slices = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(begin),
            [None, pa.py_buffer(np.append(begin, len(data)).astype(np.int64)),
             pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
        found = [self.piece(x) for x in slices.dictionary.to_pylist()]
        sizes = np.array([len(x) for x in found], dtype=np.int64)
        flat = np.array([i for x in found for i in x], dtype=np.uint32)
        which = slices.indices.to_numpy()
        count = sizes[which]
        upto = np.concatenate([[0], np.cumsum(count)])
        shift = (np.cumsum(sizes) - sizes)[which] - upto[:-1]
        ids = flat[np.arange(upto[-1]) + np.repeat(shift, count)]
        return ids, upto[np.searchsorted(begin, bounds)]


def _packed(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Parts of an array of unsigned 32-bit numbers as binary values."""
    data = np.ascontiguousarray(values.astype("<u4"))
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(bounds) - 1,
        [None, pa.py_buffer((4 * bounds).astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())


def _unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    flat = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = flat.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[flat.offset:flat.offset + len(flat) + 1] // 4
    if data is None:
        return np.zeros(0, dtype=np.uint32), np.zeros(len(flat) + 1, dtype=np.int64)
    return (np.frombuffer(data, dtype="<u4", count=bounds[-1])[bounds[0]:], bounds - bounds[0])


def encode(docs: DataFrame, ranks: bytes, *keep: str) -> DataFrame:
    """The columns in `keep`, n_tokens, ids and ends (packed little-endian unsigned 32-bit numbers: the tokens of
    each text, and the byte of the text where each ends). `ranks` is the content of a rank file (a fixed size,
    sent along with the task's function)."""
    kept = docs.select(*keep, "text")
    fields = kept.schema.fields[:-1]
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in fields],
                        "n_tokens bigint, ids binary, ends binary"])
    names = [*keep, "n_tokens", "ids", "ends"]
    classes = character_classes()
    sent = zlib.compress(ranks, 1)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(read_ranks(zlib.decompress(sent)),
                          np.frombuffer(zlib.decompress(classes), dtype=np.uint8))
        for batch in pieces(batches, size=TEXT_AT_ONCE):
            data, bounds = text_bytes(batch.column("text"))
            ids, at = encoder.encode(data, bounds)
            ends = np.cumsum(encoder.length[ids]) - np.repeat(bounds[:-1], np.diff(at))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f.name) for f in fields], pa.array(np.diff(at)),
                 _packed(ids, at), _packed(ends, at)], names=names)

    return kept.mapInArrow(work, schema)


def decode(encoded: DataFrame, ranks: bytes) -> DataFrame:
    """All columns but ids and ends, and ids and decoded: the bytes that the ids stand for. Without a column `ends`
    the tokens' lengths give the places."""
    others = [c for c in encoded.columns if c not in ("ids", "ends")]
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields
                          if f.name in others], "ids binary, decoded binary"])
    names = [*others, "ids", "decoded"]
    with_ends = "ends" in encoded.columns
    sent = zlib.compress(ranks, 1)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = read_ranks(zlib.decompress(sent))
        tokens = [b""] * (max(table.values(), default=-1) + 1)
        for token, rank in table.items():
            tokens[rank] = token
        length = np.array([len(t) for t in tokens], dtype=np.int64)
        begin = np.cumsum(length) - length
        content = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        for batch in pieces(batches, "ids", TEXT_AT_ONCE):
            ids, at = _unpacked(batch.column("ids"))
            size = length[ids]
            if with_ends:  # places within each row, shifted to its own beginning
                ends, _ = _unpacked(batch.column("ends"))
                last = at[1:][np.diff(at) > 0] - 1
                total = np.zeros(batch.num_rows, dtype=np.int64)
                total[np.diff(at) > 0] = ends[last]
                upto = ends + np.repeat(np.cumsum(total) - total, np.diff(at))
            else:
                upto = np.cumsum(size)
            n = int(upto[-1]) if len(upto) else 0
            data = content[np.arange(n) + np.repeat(begin[ids] - (upto - size), size)]
            cuts = np.concatenate([[0], upto])[at]
            decoded = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), batch.num_rows,
                [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in others], batch.column("ids"), decoded], names=names)

    return encoded.mapInArrow(work, schema)


def digests(decoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens and the digests of the packed ids and of the decoded bytes."""
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))
