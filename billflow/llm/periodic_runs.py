"""Periodic runs of words, found by recompression.

The words of a text become numbers, and the sequence is compressed level by level: a block step turns each
maximal repetition of a symbol into one symbol (symbol, times), a pair step deals all symbols out to two sides
and turns each neighbouring (left, right) into one. Equal stretches are compressed alike but for their edges,
so two places of the text are compared by walking up while the symbols above agree, along while symbols agree,
and down where they differ; blocks of one symbol are passed in one step. That answers how far the words at two
places agree, forwards and backwards, in a logarithm of steps and without a suffix array.

A run of period p and at least 4 p words holds at least 3 p consecutive words that equal the word p further on,
so one of the places 0, 3 p, 6 p ... lies among them: these places, for all p, are the candidates (a harmonic
sum, n log n / 3). A candidate whose words next to it contradict a run is dropped at once, the others are
extended exactly. Of the periods that give the same stretch the smallest is its period.

Each text is whole in one task and no row moves. Null and empty texts, and texts without words: no runs, null
and empty results. Very long texts stand alone in their batch; the candidates are taken in blocks of bounded
size. Repeated rows and rows of null doc_id are each answered. Empty table: empty result. The result has only
the named columns, so further columns of the input cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from billflow.llm.arrays import pieces, text_bytes

LEAST_WORDS = 6
LEAST_PERIODS = 4
BLOCK = 1 << 20  # candidates at a time
TEXT_AT_ONCE = 2 << 20  # bytes of text

_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_SCHEMA = ("runs array<struct<start:bigint,length:bigint,period:bigint>>, "
           "n_words bigint, collapsed string")
_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def spread(x: np.ndarray, salt: int) -> np.ndarray:
    """A pseudo-random bit for each number, another one for each salt."""
    x = (x.astype(np.uint64) + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(47) & np.uint64(1)).astype(bool)


class Grammar:
    """The levels of a recompressed sequence, one behind the other in flat arrays.

    Of each place: its symbol, how many of the lowest symbols it holds, its parent above (-1 at the top), its
    first and last child below (-1 at the bottom) and, where a block step made it, the repeated symbol and
    how often (0 elsewhere). `fence` marks symbols that occur once and are never paired.
    """

    def __init__(self, symbols: np.ndarray, fence: np.ndarray) -> None:
        level = symbols.astype(np.int64)
        bottom = np.full(len(level), -1, dtype=np.int64)
        self._kept = [(level, np.ones(len(level), np.int64), bottom, bottom, bottom,
                       np.zeros(len(level), np.int64))]
        self._parents: list[np.ndarray] = []
        self._base = 0  # where the present level begins
        self._fresh = int(level.max(initial=-1)) + 1  # the next unused symbol
        unpaired, salt = int(fence.sum()), 0
        while len(level) > 2 * unpaired - 1:
            level, fence = self._blocks(level, fence)
            level, fence = self._pairs(level, fence, salt)
            salt += 1
        self._parents.append(np.full(len(level), -1, dtype=np.int64))
        names = ("symbol", "size", "first", "last", "repeated", "times")
        for k, name in enumerate(names):
            setattr(self, name, np.concatenate([x[k] for x in self._kept]).astype(np.int32))
        self.parent = np.concatenate(self._parents).astype(np.int32)
        del self._kept, self._parents

    def _named(self, keys: np.ndarray) -> np.ndarray:
        """One new symbol for each different key."""
        distinct, names = np.unique(keys, return_inverse=True)
        names = names + self._fresh
        self._fresh += len(distinct)
        return names

    def _add(self, level: np.ndarray, heads: np.ndarray, repeated: np.ndarray,
             times: np.ndarray, below: int) -> None:
        """A new level whose symbols begin at `heads` of the `below` symbols under it."""
        ends = np.append(heads[1:], below)
        sums = np.concatenate([[0], np.cumsum(self._kept[-1][1])])
        top = self._base + below
        self._parents.append(top + np.repeat(np.arange(len(heads)), ends - heads))
        self._kept.append((level, sums[ends] - sums[heads], self._base + heads,
                           self._base + ends - 1, repeated, times))
        self._base = top

    def _blocks(self, level: np.ndarray, fence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        heads = np.flatnonzero(np.concatenate([[True], level[1:] != level[:-1]]))
        if len(heads) == len(level):
            return level, fence
        times = np.diff(np.append(heads, len(level)))
        repeated = level[heads]
        made = repeated.copy()
        many = times > 1
        made[many] = self._named(repeated[many] << 32 | times[many])
        self._add(made, heads, repeated, times, len(level))
        return made, fence[heads]

    def _pairs(self, level: np.ndarray, fence: np.ndarray, salt: int
               ) -> tuple[np.ndarray, np.ndarray]:
        side = spread(level, salt)
        free = ~fence
        both = free[:-1] & free[1:]
        rising = both & ~side[:-1] & side[1:]
        falling = both & side[:-1] & ~side[1:]
        joined = np.flatnonzero(rising if rising.sum() >= falling.sum() else falling)
        if not len(joined):
            return level, fence
        head = np.ones(len(level), dtype=bool)
        head[joined + 1] = False
        heads = np.flatnonzero(head)
        named = level.copy()
        named[joined] = self._named(level[joined] << 32 | level[joined + 1])
        made = named[heads]
        none = np.zeros(len(made), dtype=np.int64)
        self._add(made, heads, none, none, len(level))
        return made, fence[heads]

    def agree(self, one: np.ndarray, other: np.ndarray, back: bool = False) -> np.ndarray:
        """How many of the lowest symbols from `one` on equal those from `other` on, or up to them if `back`."""
        length = np.zeros(len(one), dtype=np.int64)
        step = -1 if back else 1
        edge, far = (self.last, self.first) if back else (self.first, self.last)
        who, a, b = np.arange(len(one)), one.astype(np.int64), other.astype(np.int64)
        while len(who):
            above, beside = self.parent[a], self.parent[b]
            up = ((above >= 0) & (edge[above] == a) & (edge[beside] == b)
                  & (self.symbol[above] == self.symbol[beside]))
            along = ~up & (self.symbol[a] == self.symbol[b])
            down = ~up & ~along & (edge[a] >= 0)
            # inside of blocks along to the nearer end, between blocks of one symbol as many as both have
            rest = np.where((above >= 0) & (self.times[above] > 0) & (self.times[beside] > 0),
                            np.minimum(np.abs(far[above] - a), np.abs(far[beside] - b)), 0) + 1
            same = np.where(self.repeated[a] == self.repeated[b],
                            np.minimum(self.times[a], self.times[b]), 0).astype(np.int64)
            under = edge[a]
            length[who] += np.where(along, rest * self.size[a],
                                    np.where(down, same * self.size[under], 0))
            a = np.where(up, above, np.where(along, a + step * rest, under + step * same))
            b = np.where(up, beside, np.where(along, b + step * rest, edge[b] + step * same))
            on = up | along | down
            who, a, b = who[on], a[on].astype(np.int64), b[on].astype(np.int64)
        return length


def candidates(words: np.ndarray, bounds: np.ndarray
               ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of (text, place in all words, period) on the harmonic grid that their neighbours allow."""
    n = np.diff(bounds)
    periods = np.where(n >= LEAST_WORDS, n // LEAST_PERIODS, 0)
    ends = np.cumsum(periods)  # (text, period) pairs, one text after the other
    low, total = 0, int(ends[-1]) if len(ends) else 0
    while low < total:
        high = min(total, low + BLOCK)
        pair = np.arange(low, high)
        text = np.searchsorted(ends, pair, "right")
        period = pair - (ends[text] - periods[text]) + 1
        count = -(-(n[text] - period) // (3 * period))
        upto = np.cumsum(count)
        took = max(1, int(np.searchsorted(upto, 4 * BLOCK, "right")))
        low += took
        pair, text, period, count = pair[:took], text[:took], period[:took], count[:took]
        first = upto[:took] - count
        done = 0
        while done < upto[took - 1]:  # a single pair may have very many places
            k = np.arange(done, min(done + 4 * BLOCK, int(upto[took - 1])))
            done += len(k)
            at = np.searchsorted(upto[:took], k, "right")
            p = period[at]
            begin = bounds[text[at]]
            place = begin + 3 * p * (k - first[at])
            hit = words[place] == words[place + p]
            at, p, begin, place = at[hit], p[hit], begin[hit], place[hit]
            stop = bounds[text[at] + 1] - p
            right = place + p < stop
            left = place - p >= begin
            for off in (np.ones_like(p), (p + 1) // 2, p):
                here = np.where(right, place + off, place)
                right &= words[here] == words[here + p]
                here = np.where(left, place - off, place)
                left &= words[here] == words[here + p]
            good = right | left
            if good.any():
                yield text[at[good]], place[good], p[good]


def runs_of(words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Rows (text, start, length, period), sorted, of all runs of texts given as numbered words."""
    found = list(candidates(words, bounds))
    if not found:
        return np.zeros((0, 4), dtype=np.int64)
    text, place, period = (np.concatenate(x) for x in zip(*found))
    # the texts with candidates, each between two fences
    used, own = np.unique(text, return_inverse=True)
    n = np.diff(bounds)[used]
    begin = np.concatenate([[0], np.cumsum(n + 1)[:-1]]) + 1
    shift = begin - bounds[used]
    size = int(n.sum() + len(n) + 1)
    inner = np.ones(size, dtype=bool)
    inner[np.append(begin - 1, size - 1)] = False
    symbols = np.empty(size, dtype=np.int64)
    symbols[inner] = np.concatenate([words[bounds[u]:bounds[u + 1]] for u in used])
    top = int(words.max()) + 1
    symbols[~inner] = top + np.arange(len(n) + 1)
    grammar = Grammar(symbols, ~inner)
    runs = []
    for low in range(0, len(place), BLOCK):
        part = slice(low, low + BLOCK)
        one, p = place[part] + shift[own[part]], period[part]
        ahead = grammar.agree(one, one + p)
        behind = grammar.agree(one - 1, one + p - 1, back=True)
        length = ahead + behind + p
        good = length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * p)
        start = one - behind - begin[own[part]]
        rows = np.stack([text[part], start, length, p], 1)[good]
        runs.append(np.unique(rows, axis=0))
    rows = np.concatenate(runs)
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    fresh = np.ones(len(rows), dtype=bool)
    fresh[1:] = (rows[1:, :3] != rows[:-1, :3]).any(1)
    return rows[fresh]


def numbered(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All words `[^\\x20\\x09-\\x0D]+`, each with one blank behind it, as bytes; where each begins (and the last
    ends); a number for each, equal for equal words; the bounds of each text's words."""
    inside = ~_SEPARATOR[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[bounds] = True
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | edge[1:-1]
    byte = np.flatnonzero(inside)
    word_of = np.cumsum(begin)[byte] - 1
    n = int(word_of[-1]) + 1 if len(word_of) else 0
    packed = np.full(len(byte) + n, 0x20, dtype=np.uint8)
    packed[np.arange(len(byte)) + word_of] = data[byte]
    offsets = np.concatenate([[0], np.cumsum(np.bincount(word_of, minlength=n) + 1)])
    texts = np.searchsorted(np.flatnonzero(begin), bounds)
    array = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), n, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(packed)])
    numbers = array.dictionary_encode().indices.to_numpy().astype(np.int64)
    return packed, offsets, numbers, texts


def _texts_of(packed: np.ndarray, offsets: np.ndarray, texts: np.ndarray, runs: np.ndarray
              ) -> list[bytes]:
    """The words of each text that no run repeats, joined by one blank."""
    flags = np.zeros(len(offsets), dtype=np.int64)  # +1 where dropping begins, -1 where it ends
    begin = texts[runs[:, 0]] + runs[:, 1]
    np.add.at(flags, begin + runs[:, 3], 1)
    np.add.at(flags, begin + runs[:, 2], -1)
    kept = np.cumsum(flags)[:-1] == 0
    whole = packed.tobytes()
    changed = set(runs[:, 0].tolist())
    out = []
    for k, (low, high) in enumerate(zip(texts[:-1].tolist(), texts[1:].tolist())):
        if k in changed:
            turns = np.flatnonzero(np.diff(kept[low:high], prepend=False, append=False)) + low
            parts = [whole[offsets[a]:offsets[b]] for a, b in zip(turns[::2], turns[1::2])]
            out.append(b"".join(parts)[:-1])
        else:
            out.append(whole[offsets[low]:max(offsets[low], offsets[high] - 1)])
    return out


def _answer(batch: pa.RecordBatch) -> list[pa.Array]:
    data, bounds = text_bytes(batch.column("text"))
    packed, offsets, numbers, texts = numbered(data, bounds)
    runs = runs_of(numbers, texts)
    each = np.searchsorted(runs[:, 0], np.arange(batch.num_rows + 1)).astype(np.int32)
    fields = [pa.array(runs[:, k]) for k in (1, 2, 3)]
    lists = pa.ListArray.from_arrays(
        pa.array(each), pa.StructArray.from_arrays(fields, ["start", "length", "period"]))
    collapsed = pa.array(_texts_of(packed, offsets, texts, runs), pa.binary()).cast(pa.string())
    return [lists.cast(_RUN), pa.array(np.diff(texts)), collapsed]


def with_runs(docs: DataFrame, *keep: str) -> DataFrame:
    """The columns in `keep`, runs (by start), n_words, and collapsed: the text without the words that a run
    repeats after its first period, joined by one blank."""
    kept = docs.select(*keep, "text")
    fields = kept.schema.fields[:-1]
    names = [*keep, "runs", "n_words", "collapsed"]
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in fields], _SCHEMA])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, size=TEXT_AT_ONCE):
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f.name) for f in fields], *_answer(batch)], names=names)

    return kept.mapInArrow(find, schema)


def highest_exponent(runs: Column) -> Column:
    """Of an array of runs in order the one of greatest length / period, the first of equal ones."""
    def better(best: Column, run: Column) -> Column:
        more = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | more, run).otherwise(best)
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    return F.aggregate(runs, none, better)


def repeated_tail(words: Column, number: Column) -> Column:
    """An array of words whose tail is made periodic; where and how follows from a number."""
    n = F.size(words).cast("bigint")
    a = F.pmod(number, n)
    p = F.lit(1) + F.floor((n - a) / (F.lit(3) + number % 8))
    at = F.sequence(F.lit(0).cast("bigint"), n - 1)
    return F.transform(at, lambda i: F.get(
        words, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")))


def planted(docs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """doc_id and text, where every tenth document by the checksum of its id gets a periodic tail. Null ids
    and texts without words stay as they are."""
    sum_ = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    chosen = docs.select(F.col(doc_id).alias("doc_id"), "text", F.when(
        sum_ % 10 == 0, words).alias("_words"), F.floor(sum_ / 10).alias("_number"))
    return chosen.select("doc_id", F.when(F.size("_words") > 0, F.array_join(
        repeated_tail(F.col("_words"), F.col("_number")), " ")).otherwise(F.col("text"))
        .alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """One row for each of `with_runs`: the number of runs, the one of highest exponent, and digests of all
    runs and of the collapsed text."""
    best = F.col("_best")
    lines = F.transform("runs", lambda r: F.concat_ws(
        ",", *[r[k].cast("string") for k in ("start", "length", "period")]))
    all_runs = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n")))
    return found.withColumn("_best", highest_exponent(F.col("runs"))).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), best["start"].alias("start"),
        best["length"].alias("length"), best["period"].alias("period"),
        F.floor(best["length"] * 1000 / best["period"]).alias("exponent_milli"),
        F.sha2(F.coalesce(all_runs, F.lit("")).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.coalesce("collapsed", F.lit("")).cast("binary"), 256).alias("collapsed_sha256"))
