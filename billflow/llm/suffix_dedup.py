"""Exact substring dedup over a sparse suffix array with bucket-pointer refinement.

Suffixes are sampled where the hash of a gram is least among those of a 50-byte window, so equal windows
hold a sampled suffix at the same place. Buckets of equal first grams (one hash bucket holds all suffixes of
a gram) are the array's first order. Grams met in one document only leave. The suffixes of the others come
with the bytes around them, and their buckets are refined: the bucket of an offset is split by (bucket of
the next offset, byte), and these new buckets serve the next split at once, to both sides until 50 bytes are
told apart. A byte goes if a 50-byte string over it lies in a refined bucket with a smaller doc_id.

Null text: empty. Texts under 50 bytes: unchanged. Null doc_id: unchanged, nobody's original. Rows that
repeat a doc_id must repeat its text; they are one document. Matches inside one document do not count.
Other columns are not looked at. Empty table: empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from billflow.llm.arrays import mix, pieces, text_bytes
from billflow.llm.exchange import buckets_for, exchange, packed
from billflow.workspace import written

LENGTH = 50  # bytes of a match
GRAM = 16  # bytes of a first bucket
AROUND = LENGTH - GRAM  # bytes kept on each side of a gram
GRAMS = AROUND + 1  # grams of a window

_BYTE = np.random.RandomState(9).randint(0, 1 << 62, 256).astype(np.uint64) * np.uint64(2) \
    + np.uint64(1)
_SHARED = {"low": np.uint32, "high": np.uint8, "doc": np.int64, "many": np.bool_}
_AROUND = {"around": np.dtype((np.void, 2 * AROUND + GRAM)), "doc": np.int64, "at": np.int64,
           "left": np.uint8, "right": np.uint8}


def _slide(values: np.ndarray, width: int, pick) -> np.ndarray:
    """pick over each run of `width` values."""
    have, size = values, 1
    while 2 * size <= width:
        have = pick(have[:-size], have[size:])
        size *= 2
    return pick(have[:len(have) - (width - size)], have[width - size:]) if size < width else have


def anchors(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sampled places and the hashes of their grams: those least in some whole window of a text."""
    if len(data) < LENGTH:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    gram = np.zeros(len(data) - GRAM + 1, dtype=np.uint64)
    part, size = _BYTE[data], 1
    while size < GRAM:  # hashes of 2, 4, 8 and 16 bytes, each of two of the one before
        part = (part[:-size] * np.uint64(0x9E3779B97F4A7C15 + 2 * size)) + part[size:]
        part ^= part >> np.uint64(29)
        size *= 2
    gram = part * np.uint64(0xBF58476D1CE4E5B9)
    gram ^= gram >> np.uint64(32)
    least = _slide(gram, GRAMS, np.minimum)
    room = np.repeat(bounds[1:], np.diff(bounds))[:len(least)] - np.arange(len(least))
    least[room < LENGTH] = 0
    padded = np.zeros(len(least) + 2 * AROUND, dtype=np.uint64)
    padded[AROUND:AROUND + len(least)] = least
    places = np.flatnonzero(_slide(padded, GRAMS, np.maximum) == gram)
    places = places[gram[places] > 0]
    return places, gram[places]


def _buckets(gram: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each gram and 40 further bits."""
    bucket = (gram % np.uint64(n_buckets)).astype(np.int32)
    return bucket, mix(gram // np.uint64(n_buckets)) >> np.uint64(24)


def _documents(batch: pa.RecordBatch) -> pa.RecordBatch:
    return batch.filter(pc.is_valid(batch.column("doc_id")))


def _send_grams(n_buckets: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            batch = _documents(batch)
            data, bounds = text_bytes(batch.column("text"))
            places, gram = anchors(data, bounds)
            if not len(places):
                continue
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            doc = ids[np.searchsorted(bounds, places, "right") - 1]
            order = np.lexsort((doc, gram))
            gram, doc = gram[order], doc[order]
            fresh = np.ones(len(gram), dtype=bool)
            fresh[1:] = (gram[1:] != gram[:-1]) | (doc[1:] != doc[:-1])
            gram, doc = gram[fresh], doc[fresh]
            many = np.zeros(len(gram), dtype=bool)
            many[1:] = gram[1:] == gram[:-1]
            many[:-1] |= many[1:]
            bucket, rest = _buckets(gram, n_buckets)
            yield packed(bucket, {"low": rest.astype(np.uint32),
                                  "high": (rest >> np.uint64(32)).astype(np.uint8),
                                  "doc": doc, "many": many}, n_buckets, _SHARED)
    return send


def _shared_grams(got: dict[str, np.ndarray]) -> pa.Table:
    key = got["high"].astype(np.int64) << 32 | got["low"]
    order = np.argsort(key, kind="stable")
    key, doc, many = key[order], got["doc"][order], got["many"][order]
    shared = np.zeros(0, dtype=bool)
    if len(key):
        first = np.ones(len(key), dtype=bool)
        first[1:] = key[1:] != key[:-1]
        start = np.flatnonzero(first)
        shared = ((np.minimum.reduceat(doc, start) != np.maximum.reduceat(doc, start))
                  | np.logical_or.reduceat(many, start))[np.cumsum(first) - 1]
    return pa.table({"_doc": doc[shared], "_key": key[shared]})


def _send_around(n_buckets: int):
    """The bytes around each sampled place whose gram another document has too."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            batch = _documents(batch)
            data, bounds = text_bytes(batch.column("text"))
            places, gram = anchors(data, bounds)
            if not len(places):
                continue
            of = np.searchsorted(bounds, places, "right") - 1
            bucket, rest = _buckets(gram, n_buckets)
            lists = batch.column("_keys")
            size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            keys = lists.flatten().to_numpy(zero_copy_only=False).astype(np.uint64)
            whose = np.repeat(np.arange(batch.num_rows), size).astype(np.uint64)
            known = mix(keys ^ mix(whose))
            has = np.isin(mix(rest ^ mix(of.astype(np.uint64))), known)
            places, of, bucket = places[has], of[has], bucket[has]
            if not len(places):
                continue
            left = np.minimum(AROUND, places - bounds[of])
            right = np.minimum(AROUND, bounds[of + 1] - places - GRAM)
            wide = np.zeros(len(data) + 2 * AROUND, dtype=np.uint8)
            wide[AROUND:AROUND + len(data)] = data
            offsets = np.arange(2 * AROUND + GRAM)
            around = np.lib.stride_tricks.sliding_window_view(wide, len(offsets))[places].copy()
            around[offsets < AROUND - left[:, None]] = 0
            around[offsets >= AROUND + GRAM + right[:, None]] = 0
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            yield packed(bucket, {
                "around": around.view(_AROUND["around"])[:, 0], "doc": ids[of],
                "at": places - bounds[of], "left": left, "right": right}, n_buckets, _AROUND)
    return send


def _codes(*parts: np.ndarray) -> np.ndarray:
    """Numbers of the distinct tuples of the parts."""
    code = parts[0]
    for part in parts[1:]:
        code = np.unique(code * (int(part.max(initial=0)) + 1) + part, return_inverse=True)[1]
    return code


def _least_by(code: np.ndarray, doc: np.ndarray) -> np.ndarray:
    least = np.full(int(code.max(initial=-1)) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, code, doc)
    return least[code]


def _refined(got: dict[str, np.ndarray]) -> pa.Table:
    """Of each sampled place: the bytes of its text that its 50-byte strings take away, if any."""
    doc, at = got["doc"], got["at"]
    if not len(doc):
        return pa.table({"_doc": doc, "_span": at})
    left, right = got["left"].astype(np.int64), got["right"].astype(np.int64)
    rows = got["around"].view(np.uint8).reshape(len(doc), -1)
    words = np.ascontiguousarray(np.pad(rows, ((0, 0), (0, -rows.shape[1] % 8)))).view(np.uint64)
    middle = np.ascontiguousarray(rows[:, AROUND:AROUND + GRAM]).view(np.uint64)
    gram = _codes(*[np.unique(m, return_inverse=True)[1] for m in middle.T])
    whole = gram * (AROUND + 1) ** 2 + left * (AROUND + 1) + right
    whole = _codes(np.unique(whole, return_inverse=True)[1],
                   *[np.unique(w, return_inverse=True)[1] for w in words.T])
    least = _least_by(whole, doc)
    copied = (least < doc) & (left + GRAM + right >= LENGTH)
    low, high = np.where(copied, AROUND - left, 2 * AROUND), np.where(
        copied, AROUND + GRAM + right, 0)
    # the first document of each surrounding, where its gram has other surroundings too
    _, pick = np.unique(whole, return_index=True)
    several = np.bincount(gram[pick])[gram[pick]] > 1
    pick = pick[several]
    if len(pick):
        owner = least[pick]
        byte = rows[pick].astype(np.int64)
        ahead, behind = [np.unique(gram[pick], return_inverse=True)[1]], []
        behind = [ahead[0]]
        for k in range(AROUND):
            ahead.append(_codes(ahead[-1], byte[:, AROUND - 1 - k]))
            behind.append(_codes(behind[-1], byte[:, AROUND + GRAM + k]))
        first, last = np.full(len(pick), 2 * AROUND), np.zeros(len(pick), dtype=np.int64)
        for start in range(GRAMS):  # the window of 50 bytes from here
            fits = (AROUND - start <= left[pick]) & (start <= right[pick])
            if not fits.any():
                continue
            code = _codes(ahead[AROUND - start][fits], behind[start][fits])
            taken = np.flatnonzero(fits)[_least_by(code, owner[fits]) < owner[fits]]
            first[taken] = np.minimum(first[taken], start)
            last[taken] = np.maximum(last[taken], start + LENGTH)
        place = np.full(int(whole.max()) + 1, -1)
        place[whole[pick]] = np.arange(len(pick))
        mine = place[whole]
        alone = (mine >= 0) & ~copied
        low[alone], high[alone] = first[mine[alone]], last[mine[alone]]
    gone = high > low
    start = at[gone] - AROUND + low[gone]
    return pa.table({"_doc": doc[gone], "_span": start << 8 | (high - low)[gone]})


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the kept bytes (`kept`, binary) of each row."""
    if dict(docs.dtypes)["doc_id"] != "bigint":
        docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    docs = docs.select("doc_id", "text")
    nameless = docs.filter(F.col("doc_id").isNull())
    docs = docs.filter(F.col("doc_id").isNotNull())  # so that both joins below share one exchange
    n_buckets = buckets_for(docs)
    shared = written(exchange(docs, _send_grams(n_buckets), _SHARED, _shared_grams,
                              "_doc long, _key long").groupBy("_doc").agg(
        F.collect_set("_key").alias("_keys")), "suffix-grams")
    some = docs.join(shared, docs["doc_id"] == shared["_doc"]).select("doc_id", "text", "_keys")
    spans = exchange(some, _send_around(n_buckets), _AROUND,
                     _refined, "_doc long, _span long").groupBy("_doc").agg(
        F.collect_set("_span").alias("_spans"))
    both = docs.join(spans, docs["doc_id"] == spans["_doc"], "left").select(
        "doc_id", "text", "_spans").unionByName(nameless.withColumn(
            "_spans", F.lit(None).cast("array<long>")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            data, bounds = text_bytes(batch.column("text"))
            lists = batch.column("_spans")
            size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            span = lists.flatten().to_numpy(zero_copy_only=False)
            start = np.repeat(bounds[:-1], size) + (span >> 8)
            change = np.zeros(len(data) + 1, dtype=np.int32)
            np.add.at(change, start, 1)
            np.add.at(change, start + (span & 255), -1)
            gone = np.cumsum(change[:-1]) > 0
            edge = gone.copy()
            edge[1:] &= ~gone[:-1]
            edge[bounds[:-1][bounds[:-1] < len(data)]] |= gone[bounds[:-1][bounds[:-1] < len(data)]]
            removed, runs = (np.concatenate([[0], np.cumsum(x)])[bounds] for x in (gone, edge))
            kept = [(data[a:b][~gone[a:b]] if k else data[a:b]).tobytes()
                    for a, b, k in zip(bounds[:-1], bounds[1:], size)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(bounds)), pa.array(np.diff(removed)),
                 pa.array(np.diff(runs)), pa.array([hashlib.sha256(k).hexdigest() for k in kept]),
                 pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return both.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, "
                                "kept_sha256 string, kept binary")
