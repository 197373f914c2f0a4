"""Jaro-Winkler similarity, computed on whole Arrow batches with numpy."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F, types as T

# The function travels to the workers by value, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CELLS_PER_CHUNK = 4_000_000


def _codes(texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code-point matrix (rows padded with 0) and the row lengths."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    width = max(int(lengths.max(initial=0)), 1)
    codes = np.array(texts, dtype=f"U{width}").view(np.uint32).reshape(len(texts), width)
    return codes, lengths


def _packed(codes: np.ndarray, keep: np.ndarray) -> np.ndarray:
    """Each row's kept codes moved to the front, in order; the rest is 0."""
    order = np.argsort(~keep, axis=1, kind="stable")
    return np.take_along_axis(np.where(keep, codes, 0), order, axis=1)


def jaro_winkler_batch(left: np.ndarray, right: np.ndarray, floor: bool = True) -> np.ndarray:
    a, len_a = _codes(left)
    b, len_b = _codes(right)
    rows = np.arange(len(left))
    window = np.maximum(np.maximum(len_a, len_b) // 2 - 1, 0)
    place = np.arange(b.shape[1])
    free = place[None, :] < len_b[:, None]
    hit_a = np.zeros(a.shape, dtype=bool)
    for i in range(a.shape[1]):
        near = np.abs(place[None, :] - i) <= window[:, None]
        can = free & near & (b == a[:, i:i + 1]) & (i < len_a)[:, None]
        first = can.argmax(axis=1)
        found = can[rows, first]
        hit_a[:, i] = found
        free[rows[found], first[found]] = False
    hit_b = (place[None, :] < len_b[:, None]) & ~free
    matched = hit_a.sum(axis=1)
    width = max(int(matched.max(initial=0)), 1)
    moved = (_packed(a, hit_a)[:, :width] != _packed(b, hit_b)[:, :width]).sum(axis=1)
    swaps = moved // 2 if floor else moved / 2
    safe = np.maximum(matched, 1)
    jaro = np.where(matched == 0, 0.0, (
        matched / np.maximum(len_a, 1) + matched / np.maximum(len_b, 1)
        + (matched - swaps) / safe) / 3)
    head = min(4, a.shape[1], b.shape[1])
    same = (a[:, :head] == b[:, :head]) & (a[:, :head] != 0)
    prefix = np.logical_and.accumulate(same, axis=1).sum(axis=1)
    return np.where(jaro > 0.7, jaro + 0.1 * prefix * (1 - jaro), jaro)


def _in_chunks(a: np.ndarray, b: np.ndarray, floor: bool) -> np.ndarray:
    """Pairs of like length together, so that one long text costs only itself."""
    longest = np.array([max(len(x), len(y)) for x, y in zip(a, b)], dtype=np.int64)
    order = np.argsort(longest, kind="stable")
    out = np.empty(len(a))
    start = 0
    while start < len(order):
        first = int(longest[order[start]])
        size = max(CELLS_PER_CHUNK // max(2 * first, 16), 1)
        rows = order[start:start + size]
        rows = rows[longest[rows] <= max(2 * first, 16)]
        out[rows] = jaro_winkler_batch(a[rows], b[rows], floor)
        start += len(rows)
    return out


def jaro_winkler_series(left: pd.Series, right: pd.Series, floor: bool = True) -> pd.Series:
    """Scores a batch; a pair that repeats in it is scored once, a null on either side is null."""
    known = (left.notna() & right.notna()).to_numpy()
    out = np.full(len(left), np.nan)
    if known.any():
        a = left.to_numpy(dtype=object)[known]
        b = right.to_numpy(dtype=object)[known]
        places: dict = {}
        place = np.array([places.setdefault(pair, len(places)) for pair in zip(a, b)])
        each = np.array(list(places), dtype=object)
        out[known] = _in_chunks(each[:, 0], each[:, 1], floor)[place]
    return pd.Series(out).where(known)


@F.pandas_udf(T.DoubleType())
def _jw_floor(left: pd.Series, right: pd.Series) -> pd.Series:
    return jaro_winkler_series(left, right, floor=True)


@F.pandas_udf(T.DoubleType())
def _jw_half(left: pd.Series, right: pd.Series) -> pd.Series:
    return jaro_winkler_series(left, right, floor=False)


def jaro_winkler(left: Column, right: Column, transpositions: str = "floor") -> Column:
    """Similarity in [0, 1]; ``transpositions`` is ``floor`` or ``half`` for odd counts."""
    if transpositions not in ("floor", "half"):
        raise ValueError("transpositions must be 'floor' or 'half'")
    return (_jw_floor if transpositions == "floor" else _jw_half)(left, right)
