"""Exact n-gram Jaccard join in the metric space of shingle sets (distance 1 - similarity).

Regions. Nearly all sets lie at distance 1 from each other, so a pivot drawn from all documents would
attract nobody. Regions are therefore made around what sets share: the index keeps, for each document,
its rarest shingles, so many that any partner must share one of them. All documents that list a shingle
form a region whose pivot is its smallest document (more pivots where the region goes on). Of two linked
sets the smaller one (both, if equal in size) lists a common shingle among its `low` ones, the rarest that a
partner no smaller must share; two members of a region are compared only there, and only if both share
enough shingles with any others for a link of their sizes.

Join of a region. Every member is measured against the pivot (t is the largest distance of a link):
- within t: linked. Two such members are in one component by way of the pivot, so their pair is moot;
- beyond 2t: by the triangle inequality no member within t can link to it. These are joined among
  themselves as a region with new pivots, and so on;
- between t and 2t, the boundary: likewise, and also replicated to the members within t, if both are not
  in one component already. A link to an inner member no smaller than the pivot needs more common shingles
  than the outer member shares with the pivot; the lacking ones lie outside the pivot. Outer members
  that lack more than all inner ones together have leave; the others go to smaller regions, one for each
  of their rarest shingles outside the pivot. Inner members smaller than the pivot have a window by size.
Every link is inside one component at the end; pairs that are moot are not made.

Before that, documents that share too few shingles with all others together leave, and equal sets are
represented by one document.

Null or empty text, or no words: an empty set, linked with nothing. Null doc_id: left out. Rows that
repeat a doc_id must repeat its text and are one document. Other columns are not looked at. Empty
table: empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from billflow.llm.arrays import mix, pieces, shingles, text_bytes, words
from billflow.llm.exchange import buckets_for, exchange, packed, unpacked
from billflow.workspace import written

LINK = 75  # percent
WORDS = 5

_KINDS = {"low": np.uint32, "high": np.uint8, "doc": np.int64, "many": np.bool_,
          "own": np.int64, "known": np.int32, "size": np.int32, "one": np.int64, "two": np.int64}
_HOME = {"doc": np.int64, "shared": np.int32, "own": np.int64, "known": np.int32, "size": np.int32,
         "one": np.int64, "two": np.int64}


def _sets(batch: pa.RecordBatch, n: int) -> tuple[np.ndarray, np.ndarray]:
    data, bounds = text_bytes(batch.column("text"))
    _, _, hashes, of = words(data, bounds)
    return shingles(hashes, of, batch.num_rows, n)


def least_shared(size: np.ndarray) -> np.ndarray:
    """How many shingles a partner must share with a set of this size."""
    return -(-LINK * size // 100)


def _send(n_buckets: int, n: int):
    """The smaller half of each set by hash order: a partner shares the first of the common ones in it."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            batch = batch.filter(pc.is_valid(batch.column("doc_id")))
            if not batch.num_rows:
                continue
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            value, bounds = _sets(batch, n)
            size = np.diff(bounds)
            own = np.repeat(np.arange(len(ids)), size)
            filled = size > 0
            digests = []
            for salt in (1, 2):
                total = np.zeros(len(ids), dtype=np.uint64)
                if len(value):
                    total[filled] = np.add.reduceat(mix(value + np.uint64(salt)),
                                                    bounds[:-1][filled])
                digests.append(total.view(np.int64))
            listed = size - least_shared(size) + 1 + size // 4
            near = np.arange(len(value)) - bounds[:-1][own] < listed[own]
            value, own = value[near], own[near]
            order = np.argsort(value, kind="stable")
            value, doc = value[order], ids[own[order]]
            first = np.ones(len(value), dtype=bool)
            first[1:] = value[1:] != value[:-1]
            run = np.cumsum(first) - 1
            start = np.flatnonzero(first)
            shared = (np.minimum.reduceat(doc, start) != np.maximum.reduceat(doc, start)) \
                if len(start) else first
            known = np.zeros(len(ids), dtype=np.int64)
            if len(start):
                known = np.bincount(own[order][shared[run]], minlength=len(ids))
            key = value[start]
            bucket = (key % np.uint64(n_buckets)).astype(np.int32)
            rest = mix(key // np.uint64(n_buckets))
            yield packed(bucket, {
                "low": rest.astype(np.uint32), "high": (rest >> np.uint64(32)).astype(np.uint8),
                "doc": doc[start], "many": shared}, n_buckets, _KINDS)
            yield packed(_home(ids, n_buckets), {"own": ids, "known": known, "size": size, "one": digests[0],
                                "two": digests[1]}, n_buckets, _KINDS)
    return send


def _home(ids: np.ndarray, n_buckets: int) -> np.ndarray:
    return (mix(ids.astype(np.uint64)) % np.uint64(n_buckets)).astype(np.int32)


def _answer(n_buckets: int):
    """Of each document: how many shingles of this bucket others have, packed by the document's home."""
    def answer(got: dict[str, np.ndarray]) -> pa.Table:
        n = len(got["low"])
        key = got["high"].astype(np.uint64) << np.uint64(32) | got["low"]
        order = np.argsort(key, kind="stable")
        key, doc, many = key[order], got["doc"][order], got["many"][order]
        found = np.zeros(0, dtype=np.int64)
        if n:
            first = np.ones(n, dtype=bool)
            first[1:] = key[1:] != key[:-1]
            start, run = np.flatnonzero(first), np.cumsum(first) - 1
            shared = ((np.minimum.reduceat(doc, start) != np.maximum.reduceat(doc, start))
                      | np.logical_or.reduceat(many, start))
            # a key that several documents of one piece have is counted there for each of them
            found = doc[shared[run] & ~many]
        who, times = np.unique(found, return_counts=True)
        counted = packed(_home(who, n_buckets), {"doc": who, "shared": times}, n_buckets, _HOME)
        own = {c: got[c] for c in ("own", "known", "size", "one", "two")}
        described = packed(_home(own["own"], n_buckets), own, n_buckets, _HOME)
        return pa.Table.from_batches([counted, described])
    return answer


def _merged(got: dict[str, np.ndarray]) -> pa.Table:
    """The documents at home here, with the counts of all buckets added up."""
    ids, first = np.unique(got["own"], return_index=True)
    shared = got["known"][first].astype(np.int64)
    np.add.at(shared, np.searchsorted(ids, got["doc"]), got["shared"])
    return pa.table({"doc": ids, "shared": shared, "size": got["size"][first].astype(np.int64),
                     "one": got["one"][first], "two": got["two"][first]})


def set_sizes(docs: DataFrame, n: int = WORDS) -> DataFrame:
    """doc, size, digests, and how many of its listed shingles some other document lists."""
    n_buckets = buckets_for(docs)
    counted = exchange(docs, _send(n_buckets, n), _KINDS, _answer(n_buckets),
                       "bucket int, " + ", ".join(f"{c} binary" for c in _HOME))
    merged = counted.groupBy("bucket").applyInArrow(
        lambda table: _merged(unpacked(table, _HOME)),
        "doc long, shared long, size long, one long, two long")
    return written(merged, "jaccard-sizes")


def _need(size: Column) -> Column:
    return F.ceil(LINK * size / 100)


def _common(one: Column, two: Column) -> Column:
    """How many shingles linked sets of these sizes have in common at least."""
    return F.ceil(LINK * (one + two) / (100 + LINK))


def _listing(sets: DataFrame) -> DataFrame:
    """key, doc, size, met, low: for each document its rarest shingles that it shares with others, so many that a
    partner must have one of them, and whether a partner no smaller must have one up to this. Unshared shingles are
    the rarest of all and take up places; `met` is the number of shared ones."""
    flat = sets.select("doc", "size", F.explode("keys").alias("key"))
    often = flat.groupBy("key").agg(F.count("*").alias("often")).filter("often > 1")
    found = flat.join(often, "key").groupBy("doc", "size").agg(
        F.sort_array(F.collect_list(F.struct("often", "key"))).alias("shared"))
    found = found.filter(F.size("shared") >= _need(F.col("size")))
    size, met = F.col("size"), F.size("shared").cast("long")
    places = met - _need(size) + 1
    return found.select("doc", "size", met.alias("met"), (met - _common(size, size) + 1).alias("n_low"),
                        F.posexplode(F.slice("shared", 1, places)).alias("place", "s")).select(
        F.col("s.key").alias("key"), "doc", "size", "met", (F.col("place") < F.col("n_low")).alias("low"))


def _measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """p, doc, and of the two sets the sizes of intersection and union."""
    left = sets.select(F.col("doc").alias("_d"), F.col("keys").alias("_dk"))
    right = sets.select(F.col("doc").alias("_p"), F.col("keys").alias("_pk"))
    both = (pairs.join(left, pairs["doc"] == left["_d"]).drop("_d")
            .join(right, F.col("p") == right["_p"]))
    inter = F.size(F.array_intersect("_dk", "_pk"))
    return both.select("p", "doc", F.size("_dk").alias("size"), inter.alias("inter"),
                       (F.size("_dk") + F.size("_pk") - inter).alias("all"))


def _may_link() -> Column:
    """Whether a member of a region and a pivot may link, and this region has to find it."""
    size, p_size = F.col("size"), F.col("p_size")
    return ((100 * F.least(size, p_size) >= LINK * F.greatest(size, p_size))
            & (F.least("met", "p_met") >= _common(size, p_size))
            & (F.col("low") | (size > p_size)) & (F.col("p_low") | (size < p_size)))


def _linked() -> Column:
    return 100 * F.col("inter") >= LINK * F.col("all")


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """doc, label: the smallest doc that can be reached. Each round takes the smallest label around and
    then the label of that label, so long chains halve."""
    both = written(edges.select("doc", F.col("p").alias("other")).unionByName(
        edges.select(F.col("p").alias("doc"), F.col("doc").alias("other"))).distinct(),
        "component-edges")
    labels = written(nodes.select("doc", F.col("doc").alias("label")), "component-labels")
    while True:
        around = both.join(labels.withColumnRenamed("doc", "other"), "other").groupBy("doc").agg(
            F.min("label").alias("least"))
        lower = labels.join(around, "doc", "left").select(
            "doc", "label", F.least("label", F.coalesce("least", "label")).alias("least"))
        lower = written(lower, "component-lower")
        jumps = lower.select(F.col("doc").alias("least"), F.col("least").alias("jump"))
        moved = written(lower.join(jumps, "least", "left").select(
            "doc", F.col("label").alias("old"), F.coalesce("jump", "least").alias("label")),
            "component-labels")
        labels = moved.select("doc", "label")
        if moved.filter(F.col("old") != F.col("label")).isEmpty():
            return labels


Round = tuple[DataFrame, DataFrame, DataFrame]


def _joined_regions(sets: DataFrame) -> tuple[DataFrame, list[Round]]:
    """p, doc, size, inter, all, linked: documents at most 2t from a pivot of a region they are in, as far as
    they may link to it; and of each round the members, the pivots and, by region, the members within t of them.

    A region has one pivot in the first round, then four, sixteen and so on for what is left of it, the
    smallest document of each cell of a hash: few rounds even where hundreds of members are far apart.
    """
    members = written(_listing(sets), "jaccard-listing")
    found, rounds = None, []
    cells = 1
    while True:
        pivots = members.groupBy("key", F.pmod(F.xxhash64("doc"), F.lit(cells)).alias("cell")).agg(
            F.min(F.struct("doc", "size", "met", "low")).alias("pivot"))
        pivots = pivots.select("key", F.col("pivot.doc").alias("p"), *[
            F.col(f"pivot.{c}").alias(f"p_{c}") for c in ("size", "met", "low")])
        close = members.join(pivots, "key").filter("doc <> p").filter(_may_link())
        measured = written(_within_2t(close, sets), "jaccard-measured")
        found = measured if found is None else found.unionByName(measured)
        inside = written(measured.filter("linked").select("p", "doc").join(pivots.select("key", "p"), "p").join(
            members, ["key", "doc"]), "jaccard-inside")
        rounds.append((members, pivots, inside))
        done = inside.select("key", "doc").unionByName(pivots.select("key", F.col("p").alias("doc")))
        left = members.join(done.distinct(), ["key", "doc"], "left_anti")
        # a member that is not low here has to meet a smaller one that is
        partners = left.groupBy("key").agg(F.count("*").alias("n"), F.min(F.when(F.col("low"), F.col(
            "size"))).alias("least_low")).filter("n > 1")
        members = written(left.join(partners, "key").filter("low or least_low < size").drop("n", "least_low"),
                          "jaccard-members")
        if members.isEmpty():
            return found, rounds
        cells *= 4


def _within_2t(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    return _measured(pairs.select("p", "doc").distinct(), sets).filter(
        100 * F.col("inter") >= (2 * LINK - 100) * F.col("all")).select(
        "p", "doc", "size", "inter", "all", _linked().alias("linked"))


def _outside(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Each (p, doc) with the shingles that doc has and p has not, as `key`."""
    own = sets.select(F.col("doc").alias("_d"), F.col("keys").alias("_dk"))
    pivot = sets.select(F.col("doc").alias("_p"), F.col("keys").alias("_pk"))
    both = rows.join(own, rows["doc"] == own["_d"]).join(pivot, rows["p"] == pivot["_p"])
    return both.select(*rows.columns, F.explode(F.array_except("_dk", "_pk")).alias("key"))


def _boundary(found: DataFrame, rounds: list[Round], labels: DataFrame,
              sets: DataFrame) -> DataFrame:
    """p, doc: pairs of a member within t of a pivot and one between t and 2t of it that may link and are not
    in one component already.

    A link needs 175 * common >= 75 * (sum of sizes). If that is more than the outer member shares with the
    pivot, `lack` shingles at least must come from outside the pivot. The outer member's shingles that
    any inner one has outside the pivot are put in order of how many have them; one of all but the
    last lack - 1 must be common. If it is not more, the inner member is smaller than the pivot.
    """
    p_size = (F.col("all") - F.col("size") + F.col("inter")).alias("p_size")
    near = written(found.filter("linked").select("p", "doc", "size", p_size).distinct(),
                   "jaccard-near")
    inner = near.groupBy("p").agg(F.min("size").alias("least"))
    of_pivot = labels.select(F.col("doc").alias("p"), F.col("label").alias("_lp"))
    # members that were not measured as they cannot link to the pivot may still link to what links to it
    smaller, larger = F.least("size", "p_size"), F.greatest("size", "p_size")
    fewest = _common(F.col("size"), F.greatest("least", _need(F.col("size"))))
    wide = reduce(DataFrame.unionByName, [
        members.join(pivots.join(inside.groupBy("key", "p").agg(
            F.min("size").alias("least"), F.min(F.when(F.col("low"), F.col("size"))).alias("least_low"),
            F.max("met").alias("most_met")), ["key", "p"]), "key")
        .filter("doc <> p").filter(~_may_link()).filter(
            (100 * 100 * smaller >= LINK * LINK * larger) & (F.least("met", "most_met") >= fewest)
            & (F.col("low") | (F.col("least_low") < F.col("size"))))
        .select("p", "doc")
        for members, pivots, inside in rounds]).distinct()
    wide = wide.join(found.select("p", "doc").distinct(), ["p", "doc"], "left_anti").join(labels, "doc").join(
        of_pivot, "p").filter("label <> _lp").select("p", "doc")
    apart = found.filter("not linked").join(inner, "p", "left_semi").unionByName(
        _within_2t(wide, sets)).select("p", "doc", "size", "inter").distinct()
    mid = apart.join(labels, "doc").join(of_pivot, "p").filter("label <> _lp").join(inner, "p")
    lack = _common(F.col("size"), F.greatest("least", _need(F.col("size")))) - F.col("inter")
    mid = written(mid.select("p", "doc", "size", "inter", F.greatest(lack, F.lit(1)).alias("lack")),
                  "jaccard-mid")
    less = near.filter(F.col("size") < F.col("p_size")).select(
        "p", F.col("doc").alias("near"), F.col("size").alias("_size"))
    by_size = mid.join(less, "p").filter(
        F.col("inter") >= _common(F.col("size"), F.greatest("_size", _need(F.col("size"))))).select(
        "p", F.col("doc").alias("mid"), F.col("near").alias("doc"))
    held = written(_outside(near.select("p", "doc").join(mid.select("p").distinct(), "p", "left_semi"),
                            sets), "jaccard-outside")
    often = held.groupBy("p", "key").agg(F.count("*").alias("often"))
    shared = _outside(mid.select("p", "doc", "lack"), sets).join(often, ["p", "key"]).groupBy("p", "doc", "lack").agg(
        F.sort_array(F.collect_list(F.struct("often", "key"))).alias("shared"))
    places = F.size("shared") - F.col("lack") + 1
    asked = shared.filter(places > 0).select(
        "p", F.col("doc").alias("mid"), F.explode(F.slice("shared", 1, places)).alias("s")).select(
        "p", "mid", F.col("s.key").alias("key"))
    by_key = asked.join(held, ["p", "key"]).select("p", "mid", "doc")
    return by_key.unionByName(by_size).select(
        F.least("mid", "doc").alias("p"), F.greatest("mid", "doc").alias("doc")).distinct()


def linked_components(docs: DataFrame, n: int = WORDS) -> DataFrame:
    """doc_id, n_shingles, component_id for each document."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sizes = set_sizes(docs, n)
    equal = sizes.filter("size > 0").groupBy("size", "one", "two").agg(
        F.min("doc").alias("rep"), F.max("shared").alias("shared"))
    chosen = equal.filter(F.col("shared") >= 1 + F.floor(_need(F.col("size")) / 4)).select(
        F.col("rep").alias("_rep"))

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            value, bounds = _sets(batch, n)
            keys = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)),
                                            pa.array(value.view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(bounds)), keys],
                names=["doc", "size", "keys"])

    near = docs.join(chosen, docs["doc_id"] == chosen["_rep"], "left_semi").dropDuplicates(
        ["doc_id"])
    sets = written(near.mapInArrow(to_sets, "doc long, size long, keys array<long>"),
                   "jaccard-sets")
    found, rounds = _joined_regions(sets)
    links, nodes = found.filter("linked").select("p", "doc"), sets.select("doc")
    labels = components(nodes, links)
    more = written(_measured(_boundary(found, rounds, labels, sets), sets).filter(_linked()).select("p", "doc"),
                   "jaccard-boundary")
    if not more.isEmpty():
        labels = components(nodes, links.unionByName(more))
    named = equal.select("size", "one", "two", "rep").join(
        labels.withColumnRenamed("doc", "rep"), "rep", "left").select(
        "size", "one", "two", F.coalesce("label", "rep").alias("component"))
    return sizes.join(named, ["size", "one", "two"], "left").select(
        F.col("doc").alias("doc_id"), F.col("size").alias("n_shingles"),
        F.coalesce("component", "doc").alias("component_id"))
