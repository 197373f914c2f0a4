"""Moves hashed features between documents and buckets as packed numpy columns.

A map task sends each key once for each piece of text it reads, so a key that a third of all
documents share costs a bucket one entry for each piece, not one for each document.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

BUCKET_BYTES = 8 << 20  # of text behind one bucket
_DOCUMENTS = ("doc", "own")  # columns of document ids


def buckets_for(docs: DataFrame, bytes_each: int = BUCKET_BYTES) -> int:
    """As many buckets as the texts need: grows with the input."""
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    return max(8, -(-size // bytes_each))


def packed(bucket: np.ndarray, columns: dict[str, np.ndarray], n_buckets: int,
           kinds: dict[str, type]) -> pa.RecordBatch:
    """One row for each bucket that occurs: its number and, as bytes, its part of each column of `kinds`
    (nothing where `columns` lacks it). Within a bucket rows are sorted by document; documents are stored as
    compressed differences."""
    order = np.lexsort((next(columns[c] for c in _DOCUMENTS if c in columns), bucket))
    bounds = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
    filled = np.flatnonzero(np.diff(bounds))
    out = [pa.array(filled.astype(np.int32))]
    for name, kind in kinds.items():
        if name not in columns:
            out.append(pa.array([b""] * len(filled), pa.binary()))
            continue
        data = np.ascontiguousarray(columns[name][order].astype(kind, copy=False))
        parts = [data[bounds[i]:bounds[i + 1]] for i in filled.tolist()]
        if name in _DOCUMENTS:
            parts = [zlib.compress(np.diff(x, prepend=0).tobytes(), 1) for x in parts]
        elif np.dtype(kind).kind == "V":  # strings of bytes
            parts = [zstandard.compress(x.tobytes(), 3) for x in parts]
        else:
            parts = [x.tobytes() for x in parts]
        out.append(pa.array(parts, pa.binary()))
    return pa.RecordBatch.from_arrays(out, names=["bucket", *kinds])


def unpacked(table: pa.Table, kinds: dict[str, type]) -> dict[str, np.ndarray]:
    """The columns of all rows of a bucket, joined."""
    def plain(name: str, kind: type) -> np.ndarray:
        if name in _DOCUMENTS:
            parts = [np.cumsum(np.frombuffer(zlib.decompress(x.as_buffer()), dtype=kind))
                     for x in table.column(name) if len(x.as_buffer())]
        elif np.dtype(kind).kind == "V":
            parts = [np.frombuffer(zstandard.decompress(x.as_buffer()), dtype=kind)
                     for x in table.column(name) if len(x.as_buffer())]
        else:
            parts = [np.frombuffer(x.as_buffer(), dtype=kind) for x in table.column(name)]
        return np.concatenate(parts or [np.zeros(0, dtype=kind)])
    return {name: plain(name, kind) for name, kind in kinds.items()}


def exchange(docs: DataFrame, send: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
             kinds: dict[str, type], answer: Callable[[dict[str, np.ndarray]], pa.Table],
             schema: str) -> DataFrame:
    """`send` packs features of texts by bucket, `answer` gets all of a bucket and gives rows."""
    fields = ", ".join(f"{name} binary" for name in kinds)
    return (docs.mapInArrow(send, f"bucket int, {fields}").groupBy("bucket")
            .applyInArrow(lambda table: answer(unpacked(table, kinds)), schema))
