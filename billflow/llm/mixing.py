"""Mixing towards target weights with soft memberships.

A logistic regression on the labelled table gives every document posteriors over domains. Projected
gradient descent on least squares then fits a rate >= 0 for each document, so that the expected tokens of
each domain, sum(rate * tokens * posterior), meet their targets. A step is sum over domains of posterior *
gap, so the rate of a document follows from its posteriors and the few gaps so far: each step is one
aggregation, and no rates are kept in between.

Null or empty text: 0 tokens, posteriors from the bias alone. Null doc_id: one document like others. Repeated
rows each count. Empty labels: all posteriors equal. Empty documents: empty result. A domain without
tokens has no gap. Other columns pass through where `mixed` is asked for rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from billflow.llm.arrays import pieces, text_bytes, words_by_heads
from billflow.workspace import written

BINS = 1 << 16  # hashed words and word heads
HEAD = 6  # bytes
TRAINED_ON = 20_000  # labelled documents at most, the classifier's bounded sample
USED = 2_000  # most telling bins
SURE = 2.0  # deviations from chance that a bin needs; a small sample has few bins far beyond
TARGETS = {"clean": 0.97, "poor": 0.03, "toxic": 0.0}

_IS_UPPER = np.zeros(256, dtype=bool)
_IS_UPPER[65:91] = True
_IS_MARK = np.zeros(256, dtype=bool)
_IS_MARK[[ord(c) for c in "#*$%&|<>!"]] = True


def domain_labels(labels: DataFrame) -> DataFrame:
    """doc_id, domain: toxic, else poor, else clean."""
    return labels.select("doc_id", F.when(F.col("toxic") == 1, "toxic").when(
        F.col("quality") == 0, "poor").when(F.col("quality") == 1, "clean").alias("domain"))


def _features(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct bins of each text with their bounds, and its number of words. Four bins of each text say
    how many capitals, marks and different words it has."""
    data, bounds = text_bytes(batch.column("text"))
    n = batch.num_rows
    _, _, (whole, head), of = words_by_heads(data, bounds, (None, HEAD))
    count = np.bincount(of, minlength=n)
    key = np.concatenate([whole >> np.uint64(48), (head ^ np.uint64(1)) >> np.uint64(48)])
    own = np.concatenate([of, of]).astype(np.int64)
    both = np.unique(own << 20 | key.astype(np.int64))
    distinct = np.bincount(np.unique(of << 20 | (whole >> np.uint64(44)).astype(np.int64)) >> 20,
                           minlength=n)
    extra = []
    for k, flags in enumerate((_IS_UPPER[data], _IS_MARK[data])):
        sums = np.concatenate([[0], np.cumsum(flags)])
        share = (sums[bounds[1:]] - sums[bounds[:-1]]) / np.maximum(np.diff(bounds), 1)
        extra.append(BINS + 16 * k + np.minimum(15, (share * 48).astype(np.int64)))
    extra.append(BINS + 32 + np.minimum(15, (distinct / np.maximum(count, 1) * 16).astype(int)))
    rows = np.arange(n)
    both = np.sort(np.concatenate([both, *[rows << 20 | e for e in extra]]))
    return both & ((1 << 20) - 1), np.searchsorted(both >> 20, np.arange(n + 1)), count


def train(docs: DataFrame, domains: DataFrame, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Weights by (domain, bin) and biases of a regression on the bins that tell domains apart best.

    Of more than TRAINED_ON labels those of the smallest hashed ids are used. Labels without a
    document, and null or unknown domains, are left out. What is gathered: (BINS + 48) x domains counts, and at most USED bins of each sampled row.
    """
    chosen = domains.filter(F.col("domain").isin(names)).select(
        F.col("doc_id").alias("_id"), "domain").orderBy(F.xxhash64("_id"), "_id", "domain").limit(
        TRAINED_ON)
    rows = written(docs.select(F.col("doc_id").alias("_doc"), "text").join(
        F.broadcast(chosen), F.col("_doc") == F.col("_id")).select("text", "domain"), "labelled")
    width = BINS + 48

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros((len(names), width + 1), dtype=np.int64)
        for batch in pieces(batches):
            bins, bounds, _ = _features(batch)
            which = np.array([names.index(x) for x in batch.column("domain").to_pylist()])
            at = np.repeat(which, np.diff(bounds))
            np.add.at(cells, (at, bins), 1)
            np.add.at(cells, (which, width), 1)
        domain, place = np.nonzero(cells)
        yield pa.RecordBatch.from_arrays(
            [pa.array(domain), pa.array(place), pa.array(cells[domain, place])],
            names=["domain", "bin", "n"])

    found = rows.mapInArrow(count, "domain long, bin long, n long").groupBy("domain", "bin").agg(
        F.sum("n").alias("n")).collect()
    cells = np.zeros((len(names), width + 1))
    for r in found:
        cells[r["domain"], r["bin"]] = r["n"]
    size = cells[:, -1:]
    due = size * (cells[:, :-1].sum(0) + 0.5) / (size.sum() + 1)
    sure = (np.abs(cells[:, :-1] - due) / np.sqrt(due + 0.5)).max(0)  # standard deviations
    used = np.argsort(-sure, kind="stable")[:USED]
    used = np.sort(used[sure[used] > SURE])
    place_of = np.full(width, -1)
    place_of[used] = np.arange(len(used))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            bins, bounds, _ = _features(batch)
            own = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
            at = place_of[bins]
            has = at >= 0
            ends = np.searchsorted(own[has], np.arange(batch.num_rows + 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("domain"), pa.ListArray.from_arrays(
                    pa.array(ends.astype(np.int32)), pa.array(at[has].astype(np.int32)))],
                names=["domain", "bins"])

    sample = rows.mapInArrow(pick, "domain string, bins array<int>").toArrow()
    fitted, bias = _regression([np.asarray(x.values, dtype=np.int64) for x in sample["bins"]],
                               np.array([names.index(d) for d in sample["domain"].to_pylist()],
                                        dtype=np.int64),
                               len(used), len(names))
    weights = np.zeros((len(names), width))
    weights[:, used] = fitted
    return weights, bias


def _regression(bins: list[np.ndarray], label: np.ndarray, width: int, n_classes: int,
                steps: int = 200, decay: float = 2e-4) -> tuple[np.ndarray, np.ndarray]:
    """Multinomial logistic regression on sets of present bins, by accelerated full gradients."""
    n = len(label)
    weights, bias = np.zeros((n_classes, width)), np.zeros(n_classes)
    if not n:
        return weights, bias
    row = np.repeat(np.arange(n), [len(b) for b in bins])
    col = np.concatenate([*bins, np.zeros(0, dtype=np.int64)])
    truth = np.zeros((n_classes, n))
    truth[label, np.arange(n)] = 1
    norm = np.sqrt(np.bincount(row, minlength=n).max(initial=1) + 1)
    scale = np.sqrt(np.bincount(col, minlength=width) / n + 1e-3)  # rare bins move as fast as common
    speed, speed_bias = np.zeros_like(weights), np.zeros_like(bias)
    rate = 4.0 / norm
    for _ in range(steps):
        ahead, ahead_bias = weights + 0.9 * speed, bias + 0.9 * speed_bias
        score = np.stack([np.bincount(row, w[col], minlength=n) for w in ahead]) \
            + ahead_bias[:, None]
        score = np.exp(score - score.max(0))
        gap = (score / score.sum(0) - truth) / n
        slope = np.stack([np.bincount(col, g[row], minlength=width) for g in gap])
        speed = 0.9 * speed - rate * (slope / scale + decay * ahead)
        speed_bias = 0.9 * speed_bias - rate * gap.sum(1)
        weights, bias = weights + speed, bias + speed_bias
    return weights, bias


def posteriors(docs: DataFrame, weights: np.ndarray, priors: np.ndarray, names: list[str],
               *keep: str) -> DataFrame:
    """The columns in `keep`, n_tokens (words) and p_<domain> of each row."""
    kept = docs.select(*keep, "text")
    fields = kept.schema.fields[:-1]
    columns = ["n_tokens", *[f"p_{n}" for n in names]]
    schema = T.StructType([*fields, T.StructField("n_tokens", T.LongType()),
                           *[T.StructField(c, T.DoubleType()) for c in columns[1:]]])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            bins, bounds, count = _features(batch)
            total = np.stack([np.add.reduceat(w[bins], bounds[:-1]) for w in weights], 1) + priors
            total = np.exp(total - total.max(1, keepdims=True))
            total /= total.sum(1, keepdims=True)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f.name) for f in fields], pa.array(count),
                 *[pa.array(np.ascontiguousarray(total[:, k])) for k in range(len(names))]],
                names=[f.name for f in schema.fields])

    return kept.mapInArrow(score, schema)


def rate_of(gaps: list[list[float]], names: list[str], step: float = 1.0,
            most: float | None = None) -> Column:
    """The rate after steps along these gaps, from 1, never below 0 nor above `most`."""
    rate = F.lit(1.0)
    if not gaps:
        return rate
    history = F.array(*[F.array(*[F.lit(float(g)) for g in gap]) for gap in gaps])

    def move(r: Column, gap: Column) -> Column:
        slope = F.lit(0.0)
        for k, name in enumerate(names):
            slope = slope + F.col(f"p_{name}") * F.get(gap, F.lit(k))
        moved = F.greatest(F.lit(0.0), r - F.lit(step) * slope)
        return moved if most is None else F.least(F.lit(float(most)), moved)
    return F.aggregate(history, rate, move)


def fit(scored: DataFrame, targets: dict[str, float], steps: int = 30, close: float = 5e-3,
        most: float | None = None) -> list[list[float]]:
    """The gaps of each step. The total aimed at leaves the domain of the largest target as it is: others
    are thinned out, or repeated where they are scarce. With `most` no rate goes above it; a domain scarcer than
    its target then stays scarce, and the largest one is not thinned out for it."""
    names = list(targets)

    def expected(gaps: list[list[float]]) -> list[float]:
        rate = rate_of(gaps, names, most=most)
        row = scored.select("n_tokens", rate.alias("rate"), *[f"p_{n}" for n in names]).agg(*[
            F.sum(F.col("rate") * F.col("n_tokens") * F.col(f"p_{n}")).alias(n)
            for n in names]).first()
        return [row[n] or 0.0 for n in names]

    there = expected([])
    top = max(range(len(names)), key=lambda k: targets[names[k]])
    total = there[top] / targets[names[top]]
    goal = [targets[n] * total for n in names]
    gaps: list[list[float]] = []
    now = there
    while len(gaps) < steps:
        gap = [(e - g) / max(s, g) if s else 0.0 for e, g, s in zip(now, goal, there)]
        if max(map(abs, gap)) < close:
            break
        gaps.append(gap)
        now = expected(gaps)
    return gaps


def _copies() -> Column:
    """A rate as whole copies: its whole part, and one more with the chance of the rest by hashed id."""
    chance = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / F.lit(1 << 20)
    return F.floor(F.col("rate") + chance)


def mixed(docs: DataFrame, domains: DataFrame, targets: dict[str, float] | None = None,
          most: float | None = None) -> DataFrame:
    """doc_id, n_tokens, p_<domain>, rate and copies of each row; no rate above `most`."""
    targets = targets or TARGETS
    names = list(targets)
    docs = docs.select("doc_id", "text")
    weights, priors = train(docs, domains, names)
    scored = written(posteriors(docs, weights, priors, names, "doc_id"), "mixing-posteriors")
    rate = rate_of(fit(scored, targets, most=most), names, most=most)
    return scored.withColumn("rate", rate).withColumn("copies", _copies())


def keep_mixed(docs: DataFrame, domains: DataFrame, targets: dict[str, float] | None = None
               ) -> DataFrame:
    """The rows of `docs` that the fitted rates keep, each once: rates of at most 1, so that domains beyond their
    target are thinned out and nothing is repeated."""
    chosen = mixed(docs, domains, targets, most=1.0).filter("copies > 0").select(
        F.col("doc_id").alias("_kept_id")).distinct()
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                        F.col("doc_id").alias("_doc"))
    return whole.join(chosen, F.col("_doc").eqNullSafe(F.col("_kept_id")), "left_semi").select("_row.*")
