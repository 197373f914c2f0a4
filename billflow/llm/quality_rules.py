"""Quality rules as a learned decision list (sequential covering), DataFrame functions only.

Each text is described by counts. Ordered rules, conjunctions of thresholds on rates made from the
counts, are grown and pruned on labelled documents, and become one ordered conditional expression.

Null text: no words (fails the base rules). Empty labels: no rule is learned, the base rules alone
decide. Repeated rows each get the same verdict. A document labelled twice counts twice. Null labels
are left out. Columns of `docs` other than doc_id and text are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame, functions as F

from billflow.workspace import written

SPACES = " \t\n\x0b\x0c\r"
WINDOW = 8
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper",
         "n_marks")


def _count(pattern: str) -> Column:
    return F.regexp_count("_text", F.lit(pattern)).cast("long")


def _windows(words: Column) -> Column:
    """A hash of each run of 8 words: hashes of 1, 2, 4 and 8 words, each made of the one before."""
    def doubled(of: Column, step: int) -> Column:
        size = F.greatest(F.size(of) - step, F.lit(0))
        return F.zip_with(F.slice(of, 1, size), F.slice(of, F.lit(step + 1), size),
                          lambda a, b: F.xxhash64(a, b))

    def once(of: Column, step: int) -> Column:
        return F.get(F.transform(F.array(of), lambda x: doubled(x, step)), F.lit(0))
    return once(once(once(F.transform(words, lambda w: F.xxhash64(w)), 1), 2), 4)


def _repeated(hashes: Column) -> Column:
    """Words inside windows whose hash occurs twice: sort (hash, place), keep the places equal to a
    neighbour, and measure the union of their windows."""
    placed = F.array_sort(F.transform(hashes, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))

    def places(s: Column) -> Column:
        def twin(e: Column, j: Column) -> Column:
            before = (j > 0) & (F.get(s, j - 1)["x"] == e["x"])
            after = F.coalesce(F.get(s, j + 1)["x"] == e["x"], F.lit(False))
            return F.when(before | after, e["i"]).otherwise(F.lit(-1))
        return F.sort_array(F.filter(F.transform(s, twin), lambda i: i >= 0))

    sorted_once = F.get(F.transform(F.array(placed), places), F.lit(0))
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("total"))

    def widen(seen: Column, i: Column) -> Column:
        end = i + F.lit(WINDOW)
        return F.struct(end.alias("end"),
                        (seen["total"] + end - F.greatest(i, seen["end"])).alias("total"))
    return F.aggregate(sorted_once, zero, widen, lambda seen: seen["total"])


def text_stats(docs: DataFrame, *keep: str) -> DataFrame:
    """The counts of STATS for each text, beside the columns named in `keep`."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(*keep, text.alias("_text"))
    base = base.withColumn("_bare", F.btrim("_text", F.lit(SPACES)))
    base = base.withColumn("_words", F.when(F.length("_bare") == 0, F.array().cast("array<string>"))
                           .otherwise(F.split("_bare", "[\\x09-\\x0D ]+")))
    lines = F.filter(F.split("_text", "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    base = base.select(
        *keep, F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        _count("[#*$%&|<>]").alias("n_symbols"), _count("[!?]").alias("n_marks"),
        _count("[A-Z]").alias("n_upper"),
        F.when(F.size("_words") > WINDOW, _windows(F.col("_words")))
        .otherwise(F.array().cast("array<bigint>")).alias("_windows"),
        F.when(F.contains("_text", F.lit("\n")), lines)
        .otherwise(F.array().cast("array<string>")).alias("_lines"))
    return base.select(
        *keep, "n_words", "word_chars", "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"),
               _repeated(F.col("_windows"))).otherwise(F.lit(0)).cast("long")
        .alias("n_repeat_words"), "n_upper", "n_marks")


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def rates() -> dict[str, Column]:
    """What rules look at: whole numbers per thousand, so that thresholds are exact."""
    def per(a: str, b: str) -> Column:
        return F.floor(1000 * F.col(a) / F.greatest(F.col(b), F.lit(1)))
    return {"symbols_in_chars": per("n_symbols", "word_chars"),
            "upper_in_chars": per("n_upper", "word_chars"),
            "marks_in_words": per("n_marks", "n_words"),
            "repeats_in_words": per("n_repeat_words", "n_words"),
            "dup_lines_in_words": per("n_dup_lines", "n_words"),
            "chars_in_words": per("word_chars", "n_words"),
            "words": F.col("n_words")}


@dataclass(frozen=True)
class Condition:
    rate: str
    at_least: bool
    threshold: int

    def column(self) -> Column:
        value = rates()[self.rate]
        return value >= self.threshold if self.at_least else value < self.threshold


@dataclass(frozen=True)
class Rule:
    """All conditions hold: the document is bad."""
    conditions: tuple[Condition, ...]

    def column(self) -> Column:
        held = self.conditions[0].column()
        for condition in self.conditions[1:]:
            held = held & condition.column()
        return held


def verdict(rules: list[Rule]) -> Column:
    """The ordered list as one expression: the first rule that holds rejects, else the text stays."""
    if not rules:
        return F.lit(True)
    chain = F.when(rules[0].column(), F.lit(False))
    for rule in rules[1:]:
        chain = chain.when(rule.column(), F.lit(False))
    return chain.otherwise(F.lit(True))


def _gain(p0: int, n0: int, p: int, n: int) -> float:
    if not p:
        return 0.0
    return p * (log2(p / (p + n)) - log2(p0 / (p0 + n0)))


def learn_rules(labelled: DataFrame, max_rules: int = 8, max_conditions: int = 3,
                quantiles: int = 32, least_precision: float = 0.9, least_cover: int = 3
                ) -> list[Rule]:
    """Sequential covering over rows of STATS columns and `bad` (0 or 1).

    A rule grows by the condition of most FOIL gain on two thirds of the rows, is pruned to the
    prefix that is best on the other third, and stays if it is precise there; the rows it covers are
    then set aside. Only counts for each (rate, threshold) reach the driver: quantiles x rates rows.
    """
    names = list(rates())
    table = labelled.select("bad", (F.pmod(F.xxhash64(*STATS), F.lit(3)) > 0).alias("grow"),
                            *[c.alias(k) for k, c in rates().items()])
    table = written(table.repartition(8), "quality-labels")
    steps = [i / quantiles for i in range(1, quantiles)]
    found = table.agg(*[F.percentile_approx(F.when(F.col("bad") == b, F.col(k)), steps, 10_000)
                        .alias(f"{k}_{b}") for k in names for b in (0, 1)]).first()
    cuts = {k: sorted({int(v) + d for b in (0, 1) for v in (found[f"{k}_{b}"] or [])
                       for d in (0, 1)}) for k in names}

    def bin_of(k: str) -> Column:
        reached = F.filter(F.array(*[F.lit(t) for t in cuts[k]]), lambda t: t <= F.col(k))
        return F.size(reached).alias(k)

    binned = table.select("bad", "grow", *[bin_of(k) for k in names])
    binned = written(binned.groupBy(*names, "grow").agg(
        F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n")), "quality-bins")

    def held(conditions) -> Column:
        every = F.lit(True)
        for k, at_least, b in conditions:
            every = every & ((F.col(k) >= b) if at_least else (F.col(k) < b))
        return every

    def counts(rows: DataFrame) -> dict[str, dict[int, tuple[int, int]]]:
        cells = rows.select("p", "n", F.explode(F.array(*[
            F.struct(F.lit(k).alias("k"), F.col(k).alias("b")) for k in names])).alias("c"))
        out: dict = {k: {} for k in names}
        for r in cells.groupBy("c.k", "c.b").agg(F.sum("p").alias("p"), F.sum("n").alias("n")) \
                .collect():
            out[r["k"]][r["b"]] = (int(r["p"]), int(r["n"]))
        return out

    rules: list[Rule] = []
    taken = F.lit(False)
    while len(rules) < max_rules:
        left = binned.filter(~taken)
        growing: list[tuple[str, bool, int]] = []
        while len(growing) < max_conditions:
            cells = counts(left.filter(F.col("grow") & held(growing)))
            p0 = sum(p for p, _ in cells[names[0]].values())
            n0 = sum(n for _, n in cells[names[0]].values())
            if p0 < least_cover or not n0:
                break
            gains: dict[tuple, float] = {}
            for k in names:
                for b in range(1, len(cuts[k]) + 1):
                    p = sum(v[0] for at, v in cells[k].items() if at >= b)
                    n = sum(v[1] for at, v in cells[k].items() if at >= b)
                    for at_least, pp, nn in ((True, p, n), (False, p0 - p, n0 - n)):
                        gain = _gain(p0, n0, pp, nn)
                        if pp >= least_cover and gain > 1e-9:
                            gains[k, at_least, b] = gain
            if not gains:
                break
            top = max(gains.values())
            first = next(c for c, gain in gains.items() if gain > top - 1e-9)
            ties = [c for c, gain in gains.items() if c[:2] == first[:2] and gain > top - 1e-9]
            growing.append(ties[len(ties) // 2])  # the middle of the gap between the classes
        if not growing:
            break
        measured = left.filter(~F.col("grow")).agg(*[
            F.sum(F.when(held(growing[:i]), F.col(c)).otherwise(0)).alias(f"{c}{i}")
            for i in range(1, len(growing) + 1) for c in ("p", "n")]).first()
        scored = [((measured[f"p{i}"] or 0), (measured[f"n{i}"] or 0), i)
                  for i in range(1, len(growing) + 1)]
        p, n, size = max(scored, key=lambda s: ((s[0] - s[1]) / max(s[0] + s[1], 1), s[0], -s[2]))
        if p + n and p / (p + n) < least_precision or not p:
            break
        chosen = growing[:size]
        taken = taken | held(chosen)
        rules.append(Rule(tuple(Condition(k, at_least, cuts[k][b - 1])
                                for k, at_least, b in chosen)))
    return rules


def labelled_stats(docs: DataFrame, labels: DataFrame, most: int = 20_000) -> DataFrame:
    """Counts and `bad` of labelled documents that pass the base rules. Of more than `most` labels, those of the smallest hashed
    ids are used, the classifier's bounded sample; labels without a document are skipped."""
    marks = labels.filter(F.col("quality").isNotNull()).select(
        F.col("doc_id").alias("_id"), (F.col("quality") == 0).cast("int").alias("bad"))
    marks = marks.orderBy(F.xxhash64("_id"), "_id", "bad").limit(most)
    chosen = docs.select(F.col("doc_id").alias("_doc"), "text").join(
        F.broadcast(marks), F.col("_doc") == F.col("_id")).select("bad", "text")
    return text_stats(chosen, "bad").filter(~base_failed()).select("bad", *STATS)


def judged(docs: DataFrame, rules: list[Rule], *keep: str) -> DataFrame:
    """The counts of every row with base_failed and kept."""
    return text_stats(docs, *keep).select(
        *keep, *STATS, base_failed().alias("base_failed"),
        (~base_failed() & verdict(rules)).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` that neither the base rules nor the learned list reject."""
    rules = learn_rules(labelled_stats(docs, labels))
    names = docs.columns
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), "text")
    return judged(whole, rules, "_row").filter("kept").select("_row.*")
