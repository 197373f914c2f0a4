"""Language-model scoring by context-tree weighting over bytes.

The next symbol (a byte, or the end of the text) is decomposed into nine binary decisions. For each decision
every context of 0 to DEPTH preceding bytes is a node with a Krichevsky-Trofimov estimate, and a node's weighted
probability is half its own estimate's and half the product of its children's. Counts come from the training
documents; scoring mixes the estimates along a context's path with the weights this gives.

Documents are dealt into blocks by hashed id. A block sends its distinct byte strings and words, with their
training counts, to buckets; a bucket holds whole subtrees (all contexts that end in the same two bytes), and
answers with one log probability for each string. The tree is thus never in one place, and grows with the
corpus. The two top levels (256 x 511 nodes at most) are gathered.

Null or empty text: only its end is scored. Null doc_id: trains like crc32 of an empty text says. Repeated
rows each train and are each scored. A-Z are scored as a-z. Bytes before a text count as zeros. Other columns are not looked at.
Empty table: empty result; without training documents every decision has probability 1/2.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from billflow.llm.arrays import LOWER, pieces, text_bytes, words
from billflow.llm.exchange import buckets_for
from billflow.workspace import written

DEPTH = 5
BLOCK_BYTES = 16 << 20
BITS = 9
END = 256

_PAYLOAD = "strings binary, string_counts binary, words binary, word_counts binary"


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


def _pack(values: np.ndarray) -> bytes:
    return zlib.compress(np.ascontiguousarray(values).tobytes(), 1)


def _unpack(data: pa.Scalar, kind: type) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data.as_buffer()), dtype=kind)


def strings(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The DEPTH bytes before each symbol, nearest byte highest, then the symbol, as one number; and where
    each text's begin."""
    n = len(bounds) - 1
    begin = bounds + np.arange(n + 1)
    symbol = np.full(begin[-1], END, dtype=np.uint64)
    inside = np.ones(len(symbol), dtype=bool)
    inside[begin[1:] - 1] = False
    symbol[inside] = data
    place = np.arange(len(symbol)) - np.repeat(begin[:-1], np.diff(begin))
    key = symbol.copy()
    for k in range(1, DEPTH + 1):
        before = np.zeros(len(symbol), dtype=np.uint64)
        before[k:] = symbol[:-k]
        before[place < k] = 0
        key |= before << np.uint64(BITS + 8 * (DEPTH - k))
    return key, begin


def _bucket(key: np.ndarray, n_buckets: int) -> np.ndarray:
    last_two = key >> np.uint64(BITS + 8 * (DEPTH - 2))
    return (last_two * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(n_buckets)


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not keys:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    key, at = np.unique(np.concatenate(keys), return_inverse=True)
    return key, np.bincount(at, np.concatenate(counts), len(key)).astype(np.int64)


def _features(table: pa.Table) -> Iterator[tuple]:
    """For each piece of a block: ids, string keys and bounds, word hashes and bounds."""
    for batch in pieces(iter(table.to_batches())):
        data, bounds = text_bytes(batch.column("text"))
        key, begin = strings(LOWER[data], bounds)
        _, _, word, of = words(data, bounds)
        yield (batch.column("doc_id"), key, begin, word,
               np.searchsorted(of, np.arange(batch.num_rows + 1)))


def _dealt(key: np.ndarray, count: np.ndarray, to: np.ndarray, n_buckets: int
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted keys and their counts by bucket, sorted in each, and where each bucket's begin."""
    order = np.argsort(to, kind="stable")
    return key[order], count[order], np.searchsorted(to[order], np.arange(n_buckets + 1))


def _request(n_buckets: int):
    def request(table: pa.Table) -> pa.Table:
        sides: list[list] = [[], [], [], []]
        for ids, key, begin, word, bounds in _features(table):
            trains = np.array([not held_out(i) for i in ids.to_pylist()])
            for k, (value, edge) in enumerate(((key, begin), (word, bounds))):
                one, at = np.unique(value, return_inverse=True)
                sides[2 * k].append(one)
                sides[2 * k + 1].append(np.bincount(at, np.repeat(trains, np.diff(edge)), len(one)))
        key, key_n = _summed(*sides[:2])
        word, word_n = _summed(*sides[2:])
        (key, key_n, mine), (word, word_n, yours) = (
            _dealt(key, key_n, _bucket(key, n_buckets), n_buckets),
            _dealt(word, word_n, word % np.uint64(n_buckets), n_buckets))
        block = table.column("block")[0].as_py()
        rows = []
        for b in np.flatnonzero(np.diff(mine) + np.diff(yours)).tolist():
            k, w = slice(*mine[b:b + 2]), slice(*yours[b:b + 2])
            rows.append((b, block, _pack(np.diff(key[k], prepend=np.uint64(0))),
                         _pack(key_n[k].astype(np.uint32)),
                         _pack(np.diff(word[w], prepend=np.uint64(0))),
                         _pack(word_n[w].astype(np.uint32))))
        names = ["bucket", "block", *(c.split()[0] for c in _PAYLOAD.split(", "))]
        kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 4]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
    return request


def _read(table: pa.Table) -> tuple[list[np.ndarray], list, list[np.ndarray], list]:
    keys = [np.cumsum(_unpack(x, np.uint64), dtype=np.uint64) for x in table.column("strings")]
    some = [np.cumsum(_unpack(x, np.uint64), dtype=np.uint64) for x in table.column("words")]
    return (keys, [_unpack(x, np.uint32) for x in table.column("string_counts")],
            some, [_unpack(x, np.uint32) for x in table.column("word_counts")])


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series behind a shift by eight."""
    shift = np.zeros_like(x)
    for k in range(8):
        shift += np.log(x + k)
    y = x + 8
    return ((y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y ** 3)
            + 1 / (1260 * y ** 5) - shift)


def estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of so many zeros and ones, in any order."""
    return (log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - np.log(np.pi)
            - log_gamma(zeros + ones + 1.0))


def weighted(own: np.ndarray, children: np.ndarray) -> np.ndarray:
    return np.log(0.5) + np.logaddexp(own, children)


class Subtrees:
    """Nodes of depth 2 and more over sorted distinct strings with training counts."""

    def __init__(self, key: np.ndarray, count: np.ndarray) -> None:
        symbol = (key & np.uint64((1 << BITS) - 1)).astype(np.int64)
        step = np.tile(np.arange(BITS), len(key))
        self.row = np.repeat(np.arange(len(key)), BITS)
        used = (step == 0) | (symbol[self.row] != END)
        self.row, step = self.row[used], step[used]
        symbol = symbol[self.row]
        self.node = (1 << step) | (symbol >> (BITS - step))
        self.bit = (symbol >> (BITS - 1 - step)) & 1
        context = key[self.row] >> np.uint64(BITS)
        n = count[self.row].astype(float)
        self.chance = np.full(len(self.row), 0.5)
        below = own_row = None
        for depth in range(DEPTH, 1, -1):
            name = ((context >> np.uint64(8 * (DEPTH - depth))) << np.uint64(BITS)) \
                | self.node.astype(np.uint64)
            names, first, at = np.unique(name, return_index=True, return_inverse=True)
            ones = np.bincount(at, n * self.bit, len(names))
            zeros = np.bincount(at, n, len(names)) - ones
            own = estimate(zeros, ones)
            guess = (ones + 0.5) / (zeros + ones + 1.0)
            guess = np.where(self.bit == 1, guess[at], 1 - guess[at])
            if below is None:
                self.chance, self.log = guess, own
            else:
                children = np.bincount(at[own_row], below, len(names))
                self.log = weighted(own, children)
                trust = np.exp(np.log(0.5) + own - self.log)[at]
                self.chance = trust * guess + (1 - trust) * self.chance
            below, own_row = self.log, first
        self.names, self.zeros, self.ones = names, zeros, ones


def _top(table: pa.Table) -> pa.Table:
    """What the two top levels need of this bucket, and the words' part of N and V (byte -1).

    A bucket may hold words only: sums over no strings count as whole numbers and are made floats."""
    keys, counts, some, times = _read(table)
    tree = Subtrees(*_summed(keys, counts))
    _, n = _summed(some, times)
    place = (tree.names >> np.uint64(BITS + 8)).astype(np.int64) << BITS | \
        (tree.names & np.uint64((1 << BITS) - 1)).astype(np.int64)
    name, at = np.unique(place, return_inverse=True)
    sums = [np.bincount(at, x, len(name)).astype(float) for x in (tree.zeros, tree.ones, tree.log)]
    return pa.table({
        "byte": np.append(name >> BITS, -1), "node": np.append(name & ((1 << BITS) - 1), 0),
        "zeros": np.append(sums[0], n.sum()), "ones": np.append(sums[1], (n > 0).sum()),
        "log": np.append(sums[2], 0.0)})


class Top:
    """Weights and guesses of the nodes of depth 0 and 1, by byte and node."""

    def __init__(self, rows: list) -> None:
        size = 1 << BITS
        zeros, ones, log = (np.zeros((256, size)) for _ in range(3))
        for r in rows:
            zeros[r["byte"], r["node"]] = r["zeros"]
            ones[r["byte"], r["node"]] = r["ones"]
            log[r["byte"], r["node"]] = r["log"]
        own = estimate(zeros, ones)
        lower = weighted(own, log)
        self.trust = [None, np.exp(np.log(0.5) + own - lower)]
        self.guess = [None, (ones + 0.5) / (zeros + ones + 1.0)]
        z, o = zeros.sum(0), ones.sum(0)
        own = estimate(z, o)
        root = weighted(own, np.where(zeros + ones > 0, lower, 0.0).sum(0))
        self.trust[0] = np.exp(np.log(0.5) + own - root)
        self.guess[0] = (o + 0.5) / (z + o + 1.0)

    def mix(self, tree: Subtrees, key: np.ndarray) -> np.ndarray:
        """Log10 probability of each string's symbol."""
        byte = (key >> np.uint64(BITS + 8 * (DEPTH - 1))).astype(np.int64)[tree.row]
        chance = tree.chance
        for at, place in ((1, (byte, tree.node)), (0, (tree.node,))):
            guess = self.guess[at][place]
            guess = np.where(tree.bit == 1, guess, 1 - guess)
            trust = self.trust[at][place]
            chance = trust * guess + (1 - trust) * chance
        return np.bincount(tree.row, np.log10(chance), len(key))


def _answer(top: Top):
    def answer(table: pa.Table) -> pa.Table:
        keys, counts, some, times = _read(table)
        key, n = _summed(keys, counts)
        log = top.mix(Subtrees(key, n), key).astype(np.float32)
        word, c = _summed(some, times)
        return pa.table({
            "block": table.column("block").cast(pa.int32()),
            "strings": table.column("strings"), "words": table.column("words"),
            "logs": pa.array([_pack(log[np.searchsorted(key, k)]) for k in keys], pa.binary()),
            "times": pa.array([_pack(c[np.searchsorted(word, w)].astype(np.uint32)) for w in some],
                              pa.binary())})
    return answer


def _score(total: int, distinct: int, ends: int):
    def look(parts: list[np.ndarray], values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        key = np.concatenate(parts)
        order = np.argsort(key)
        return key[order], np.concatenate(values)[order]

    def chance(c: np.ndarray) -> np.ndarray:
        return np.log10((c + 1) / (total + distinct + 1))

    def score(texts: pa.Table, answers: pa.Table) -> pa.Table:
        key, log = look([np.cumsum(_unpack(x, np.uint64), dtype=np.uint64)
                         for x in answers.column("strings")],
                        [_unpack(x, np.float32) for x in answers.column("logs")])
        word, times = look([np.cumsum(_unpack(x, np.uint64), dtype=np.uint64)
                            for x in answers.column("words")],
                           [_unpack(x, np.uint32) for x in answers.column("times")])
        out: list[list] = [[], [], [], [], [], []]
        for ids, mine, begin, hashes, bounds in _features(texts):
            logs = log[np.searchsorted(key, mine)].astype(float)
            scores = np.add.reduceat(logs, begin[:-1])
            c = times[np.searchsorted(word, hashes)].astype(np.int64) if len(word) \
                else np.zeros(0, dtype=np.int64)
            sums = [np.concatenate([[0], np.cumsum(x)]) for x in (chance(c), c > 0)]
            base, known = (np.diff(s[bounds]) for s in sums)
            ids = ids.to_pylist()
            out[0] += ids
            out[1] += [held_out(i) for i in ids]
            out[2] += (np.diff(bounds) + 1).tolist()
            out[3] += (known + (ends > 0)).astype(np.int64).tolist()
            out[4] += (base + chance(np.array(ends))).tolist()
            out[5] += scores.tolist()
        return pa.table({"doc_id": pa.array(out[0], texts.schema.field("doc_id").type),
                         "held_out": pa.array(out[1], pa.bool_()),
                         "n_tokens": pa.array(out[2], pa.int64()),
                         "n_known": pa.array(out[3], pa.int64()),
                         "train_tokens": pa.array([total] * len(out[0]), pa.int64()),
                         "base_score": pa.array(out[4], pa.float64()),
                         "score": pa.array(out[5], pa.float64())})
    return score


def scored(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each row."""
    docs = docs.select("doc_id", "text")
    n_blocks = buckets_for(docs, BLOCK_BYTES)
    n_buckets = max(8, n_blocks)
    blocks = docs.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(n_blocks)).cast("int"))
    asked = written(blocks.groupBy("block").applyInArrow(
        _request(n_buckets), f"bucket int, block int, {_PAYLOAD}"), "context-requests")
    held = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")),
                  F.lit(7)) == 2
    ends = docs.filter(~held).count()
    top = asked.groupBy("bucket").applyInArrow(
        _top, "byte long, node long, zeros double, ones double, log double").groupBy(
        "byte", "node").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "log")]).collect()
    counted = [r for r in top if r["byte"] < 0]
    total = int(counted[0]["zeros"]) + ends if counted else 0
    distinct = int(counted[0]["ones"]) + (ends > 0) if counted else 0
    weights = Top([r for r in top if r["byte"] >= 0])
    answers = asked.groupBy("bucket").applyInArrow(
        _answer(weights), "block int, strings binary, words binary, logs binary, times binary")
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _score(total, distinct, ends),
        f"doc_id {dict(docs.dtypes)['doc_id']}, held_out boolean, n_tokens long, n_known long, "
        "train_tokens long, base_score double, score double")
