"""Substring dedup by content-defined chunks.

A gear rolling hash over the last 16 bytes cuts each text where the hash is small, so cuts depend on
the bytes around them alone and an insertion moves no cut behind it. A chunk is a copy if a chunk of
the same digest is in a document with a smaller doc_id. Runs of neighbouring copies of at least
`least` bytes are removed; shorter ones are chance and stay.

Null text: stays null, counts 0. Empty text: unchanged. Null doc_id: the row is left as it is and is
nobody's original. Rows of equal doc_id are one document: none is a copy of the other, and all get the
same removals. Repeats inside one document stay. Other columns pass through. Empty table: empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from billflow.llm.arrays import mix, pieces, text_bytes
from billflow.llm.exchange import buckets_for, exchange, packed

CHUNK = 24  # mean bytes
LEAST = 128  # bytes of a run of copies
REACH = 16  # bytes that a cut depends on
KINDS = {"key": np.uint64, "doc": np.int64, "copy": np.bool_}

_GEAR = np.random.RandomState(7).randint(0, 1 << 16, 256).astype(np.uint16)
_BYTE = np.random.RandomState(8).randint(0, 1 << 62, 256).astype(np.uint64) * np.uint64(2) \
    + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15


def cuts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Ends of all chunks, ends of texts among them; never inside a character."""
    rolling = _GEAR[data]
    for k in (1, 2, 4, 8):  # sums over 2, 4, 8 and 16 bytes
        rolling[k:] = rolling[k:] + (rolling[:-k] << np.uint16(k))
    small = rolling < (1 << 16) // CHUNK
    small[:-1] &= (data[1:] & 0xC0) != 0x80
    ends = np.flatnonzero(small) + 1
    begin = bounds[np.searchsorted(bounds, ends - 1, "right") - 1]
    return np.union1d(ends[ends - begin >= REACH], bounds[1:][np.diff(bounds) > 0])


def chunks(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """End, 64-bit digest and text index of each chunk."""
    ends = cuts(data, bounds)
    if not len(ends):
        return ends, np.zeros(0, dtype=np.uint64), ends
    starts = np.concatenate([[0], ends[:-1]])
    power = np.full(int((ends - starts).max()) + 1, _BASE, dtype=np.uint64)
    power[0] = 1
    np.multiply.accumulate(power, out=power)
    place = np.arange(len(data)) - np.repeat(starts, ends - starts)
    sums = np.add.reduceat(_BYTE[data] * power[place], starts)
    digest = mix(sums ^ (ends - starts).astype(np.uint64))
    return ends, digest, np.searchsorted(bounds, starts, "right") - 1


def _send(n_buckets: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            batch = batch.filter(pc.is_valid(batch.column("doc_id")))
            if not batch.num_rows:
                continue
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            _, key, of = chunks(*text_bytes(batch.column("text")))
            doc = ids[of]
            order = np.lexsort((doc, key))
            key, doc = key[order], doc[order]
            fresh = np.ones(len(key), dtype=bool)
            fresh[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
            key, doc = key[fresh], doc[fresh]
            first = np.ones(len(key), dtype=bool)
            first[1:] = key[1:] != key[:-1]
            # a copy of something in this very piece is known as such and asks no bucket
            bucket = np.where(first, key % np.uint64(n_buckets),
                              mix(doc.astype(np.uint64)) % np.uint64(n_buckets)).astype(np.int32)
            yield packed(bucket, {"key": key, "doc": doc, "copy": ~first}, n_buckets,
                         KINDS)
    return send


def _answer(got: dict[str, np.ndarray]) -> pa.Table:
    key, doc, copy = got["key"], got["doc"], got["copy"]
    asked = ~copy
    akey, adoc = key[asked], doc[asked]
    order = np.lexsort((adoc, akey))
    akey, adoc = akey[order], adoc[order]
    first = np.ones(len(akey), dtype=bool)
    first[1:] = akey[1:] != akey[:-1]
    least = adoc[np.maximum.accumulate(np.where(first, np.arange(len(akey)), 0))] \
        if len(akey) else adoc
    found = adoc > least
    return pa.table({"_doc": np.concatenate([doc[copy], adoc[found]]),
                     "_key": np.concatenate([key[copy], akey[found]]).view(np.int64)})


def copied_chunks(docs: DataFrame) -> DataFrame:
    """_doc, _keys: digests of the chunks of a document that a document of smaller id has too."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    n_buckets = buckets_for(docs)
    found = exchange(docs, _send(n_buckets), KINDS, _answer, "_doc long, _key long")
    return found.groupBy("_doc").agg(F.collect_set("_key").alias("_keys"))


def spans(ends: np.ndarray, copied: np.ndarray, of: np.ndarray, least: int
          ) -> list[tuple[int, int]]:
    """Maximal runs of copied chunks within a text, of `least` bytes or more."""
    if not len(ends):
        return []
    edge = np.ones(len(ends), dtype=bool)
    edge[1:] = (copied[1:] != copied[:-1]) | (of[1:] != of[:-1])
    first = np.flatnonzero(edge)
    last = np.append(first[1:], len(ends)) - 1
    low = np.where(first > 0, ends[first - 1], 0)
    runs = zip(low.tolist(), ends[last].tolist(), copied[first].tolist())
    return [(a, b) for a, b, is_copy in runs if is_copy and b - a >= least]


def without_copies(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """The rows of `docs` with the copied passages cut out of `text`, and n_removed, n_spans.

    Columns of `docs` named like these two are replaced.
    """
    docs = docs.drop("n_removed", "n_spans")
    schema = T.StructType([*docs.schema.fields, T.StructField("n_removed", T.LongType()),
                           T.StructField("n_spans", T.LongType())])
    names = docs.columns
    digests = "_keys"
    while digests in names:
        digests = f"_{digests}"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            column, found = batch.column("text"), batch.column(digests)
            hit = np.flatnonzero(pc.is_valid(found).to_numpy(zero_copy_only=False))
            removed = np.zeros(batch.num_rows, dtype=np.int64)
            count = np.zeros(batch.num_rows, dtype=np.int64)
            if len(hit):
                texts = column.to_pylist()
                for i in hit.tolist():
                    data = np.frombuffer((texts[i] or "").encode(), dtype=np.uint8)
                    ends, key, of = chunks(data, np.array([0, len(data)]))
                    keys = found[i].values.to_numpy(zero_copy_only=False).view(np.uint64)
                    keep = np.ones(len(data), dtype=bool)
                    for a, b in spans(ends, np.isin(key, keys), of, least):
                        keep[a:b] = False
                        count[i] += 1
                    if count[i]:
                        removed[i] = len(data) - int(keep.sum())
                        texts[i] = data[keep].tobytes().decode()
                column = pa.array(texts, column.type)
            rest = [column if n == "text" else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(removed), pa.array(count)], names=schema.names)

    keys = copied_chunks(docs).select(F.col("_doc").alias(f"{digests}_of"),
                                      F.col("_keys").alias(digests))
    joined = docs.join(keys, docs["doc_id"] == keys[f"{digests}_of"], "left").select(
        *[docs[f"`{n}`"] for n in names], digests)
    return joined.mapInArrow(cut, schema)
