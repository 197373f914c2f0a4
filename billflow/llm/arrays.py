"""Texts and words of Arrow batches as numpy arrays, in pieces of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 4 << 20  # bytes of text worked on at once

_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_RANDOM = np.random.RandomState(20240229)
_BYTE = _RANDOM.randint(0, 1 << 62, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads each bit over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pieces(batches: Iterator[pa.RecordBatch], text: str = "text", size: int = PIECE
           ) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most `size` bytes of text (a longer text stands alone)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        first = 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.slice(first, last - first)
            first = last


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, one after the other, and where each begins (and the last ends)."""
    flat = pc.fill_null(column.cast(pa.large_string()), "")
    flat = flat.combine_chunks() if isinstance(flat, pa.ChunkedArray) else flat
    _, offsets, data = flat.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[flat.offset:flat.offset + len(flat) + 1]
    if data is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(flat) + 1, dtype=np.int64)
    return (np.frombuffer(data, dtype=np.uint8)[bounds[0]:bounds[-1]], bounds - bounds[0])


def _power(kind: str, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        have = np.full(max(n, PIECE + 1), _BASE if kind == "up" else _BASE_INVERSE, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if n <= PIECE + 1:
            _powers[kind] = have
    return have[:n]


def _cuts(bounds: np.ndarray, separator: np.ndarray) -> list[int]:
    """Places at which the bytes may be cut without cutting a word, at most about PIECE apart."""
    cuts, total = [0], int(bounds[-1])
    while total - cuts[-1] > PIECE:
        goal = cuts[-1] + PIECE
        edge = int(bounds[np.searchsorted(bounds, goal, "right") - 1])
        if edge <= cuts[-1]:
            space = np.flatnonzero(separator[cuts[-1] + 1:goal])
            if len(space):
                edge = cuts[-1] + 1 + int(space[-1])
            else:
                after = np.flatnonzero(separator[goal:])
                edge = min(goal + int(after[0]) if len(after) else total,
                           int(bounds[np.searchsorted(bounds, goal, "left")]))
        cuts.append(edge)
    return [*cuts, total] if cuts[-1] < total else cuts


def words(data: np.ndarray, bounds: np.ndarray, lower: bool = True, head: int | None = None
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each word `[^\\x20\\x09-\\x0D]+`: where it begins and ends, a 64-bit hash (of no more
    than `head` bytes), its text's index."""
    first, last, hashes, of = words_by_heads(data, bounds, (head,), lower)
    return first, last, hashes[0], of


def words_by_heads(data: np.ndarray, bounds: np.ndarray, heads: tuple[int | None, ...],
                   lower: bool = True
                   ) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]:
    """As `words`, with a hash for each of `heads` from one pass."""
    separator = _SEPARATOR[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[bounds] = True
    starts, ends, hashes = [], [], [[] for _ in heads]
    cuts = _cuts(bounds, separator)
    for low, high in zip(cuts[:-1], cuts[1:]):
        inside = ~separator[low:high]
        begin = inside.copy()
        begin[1:] &= ~inside[:-1] | edge[low + 1:high]
        finish = inside.copy()
        finish[:-1] &= ~inside[1:] | edge[low + 1:high]
        first, last = np.flatnonzero(begin), np.flatnonzero(finish) + 1
        part = LOWER[data[low:high]] if lower else data[low:high]
        sums = np.zeros(high - low + 1, dtype=np.uint64)
        np.cumsum(_BYTE[part] * _power("up", high - low), out=sums[1:])
        for head, found in zip(heads, hashes):
            to = last if head is None else np.minimum(last, first + head)
            value = (sums[to] - sums[first]) * _power("down", high - low)[first]
            found.append(mix(value ^ (to - first).astype(np.uint64)))
        starts.append(first + low)
        ends.append(last + low)
    if not starts:
        nothing = np.zeros(0, dtype=np.int64)
        return nothing, nothing, [np.zeros(0, dtype=np.uint64) for _ in heads], nothing
    first = np.concatenate(starts)
    return (first, np.concatenate(ends), [np.concatenate(x) for x in hashes],
            np.searchsorted(bounds, first, "right") - 1)


def per_text(of: np.ndarray, n: int) -> np.ndarray:
    """Bounds of the runs of 0, 1, ... n-1 in a sorted array of text indexes."""
    return np.searchsorted(of, np.arange(n + 1))


def shingles(hashes: np.ndarray, of: np.ndarray, n: int, size: int = 5
             ) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed runs of `size` words of each text, sorted, and the bounds of each text's.

    A text of fewer words gives its whole sequence as one; a text of none gives nothing.
    """
    bounds = per_text(of, n)
    counts = np.diff(bounds)
    made = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    owner = np.repeat(np.arange(n), made)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(made) - made, made) + bounds[:-1][owner]
    value = np.zeros(len(owner), dtype=np.uint64)
    for k in range(size):
        there = place + k < bounds[1:][owner]
        at = np.where(there, place + k, 0)
        salt = np.uint64(0xD1B54A32D192ED03 * (2 * k + 1) & (1 << 64) - 1)
        word = hashes[at] if len(hashes) else value
        value += np.where(there, mix(word + salt), np.uint64(k))
    value = mix(value)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    fresh = np.ones(len(value), dtype=bool)
    fresh[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[fresh], owner[fresh]
    return value, per_text(owner, n)
