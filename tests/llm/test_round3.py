"""Periodic runs, byte pairs and centroids against brute force and the library."""

import base64
import hashlib
import math
import random
import re
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from billflow.llm import byte_pairs, centroids, periodic_runs
from billflow.llm.queries import op11_periodic_runs, op12_byte_pairs, op13_centroids

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


# Periodic runs -------------------------------------------------------------------------------

def brute_runs(words):
    """(start, length, period) of all runs, by comparing every word with the one p further on."""
    n, found = len(words), {}
    for p in range(1, n // 4 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j - i + p >= max(6, 4 * p) and j > i:
                found.setdefault((i, j - i + p), p)
            i = j + 1
    return sorted((s, length, p) for (s, length), p in found.items())


def brute_row(doc_id, text):
    words = WORD.findall(text or "")
    if doc_id is not None and words:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    dropped = {i for s, length, p in runs for i in range(s + p, s + length)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
    return (doc_id, len(runs), *best, best[1] and 1000 * best[1] // best[2],
            sha("".join(f"{s},{length},{p}\n" for s, length, p in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


def run_rows(docs):
    return sorted((tuple(r) for r in periodic_runs.digests(periodic_runs.with_runs(
        periodic_runs.planted(docs), "doc_id")).collect()), key=repr)


def test_runs_of_small_texts(spark):
    rng = random.Random(4)
    texts = [None, "", " \t\n ", "one", "a b " * 30, "x\x0by\x0cz " * 9, "é　e " * 12]
    for _ in range(250):
        n, k = rng.choice([5, 6, 7, 25, 70]), rng.choice([1, 2, 3, 30])
        words = [f"w{rng.randrange(k)}" for _ in range(n)]
        for _ in range(rng.randint(0, 2)):
            a, p = rng.randrange(n), rng.randint(1, 6)
            for i in range(a + p, min(n, a + rng.randint(3, 8) * p)):
                words[i] = words[i - p]
        texts.append(rng.choice([" ", "\n", "  \t"]).join(words))
    rows = [*enumerate(texts), (4, texts[4]), (None, texts[8]), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"runs": F.lit("clash"), "n_words": F.lit(None), "collapsed": F.lit(1)})
    assert run_rows(docs) == sorted((brute_row(*r) for r in rows), key=repr)
    assert run_rows(docs.limit(0)) == []


def test_runs_of_long_texts(spark):
    """One word over and over, two words at random, and a text of several batches."""
    rng = random.Random(5)
    texts = ["same " * 30_000, " ".join(rng.choice("ab") for _ in range(20_000)),
             " ".join(f"word{rng.randrange(9)} and" * 3 for _ in range(120_000))]
    found = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    for r in periodic_runs.with_runs(found, "doc_id").collect():
        words = texts[r.doc_id].split()
        assert r.n_words == len(words)
        if r.doc_id == 0:
            assert [tuple(x) for x in r.runs] == [(0, 30_000, 1)] and r.collapsed == "same"
        elif r.doc_id == 1:  # all runs of periods up to 12 are there
            assert [x for x in (tuple(x) for x in r.runs) if x[2] <= 12] == [
                x for x in brute_short_periods(words, 12)]
        for s, length, p in r.runs[:500]:
            assert words[s:s + length - p] == words[s + p:s + length]


def brute_short_periods(words, most):
    found = {}
    code = np.unique(words, return_inverse=True)[1]
    for p in range(1, most + 1):
        same = np.concatenate([[False], code[:-p] == code[p:], [False]])
        turns = np.flatnonzero(same[1:] != same[:-1])
        for a, b in zip(turns[::2].tolist(), turns[1::2].tolist()):
            if b - a + p >= max(6, 4 * p):
                found.setdefault((a, b - a + p), p)
    return sorted((s, length, p) for (s, length), p in found.items())


def test_runs_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = sorted((tuple(r) for r in op11_periodic_runs(spark, sf_dir).collect()), key=repr)
    assert got == sorted((brute_row(d.doc_id, d.text) for d in docs), key=repr)
    assert sum(r[1] > 0 for r in got) > len(got) / 20


def test_grammar_agrees():
    """How far two places agree, on sequences with many repetitions, both ways."""
    rng = np.random.default_rng(6)
    for k in (1, 2, 3):
        words = np.concatenate([rng.integers(0, k, 300), np.tile(rng.integers(0, k, 7), 40)])
        symbols = np.concatenate([[90], words, [91]])
        fence = symbols >= 90
        grammar = periodic_runs.Grammar(symbols, fence)
        a = rng.integers(1, len(symbols) - 2, 400)
        b = np.minimum(a + rng.integers(1, 200, 400), len(symbols) - 2)
        for back, step in ((False, 1), (True, -1)):
            for x, y, got in zip(a, b, grammar.agree(a, b, back)):
                length = 0
                while x != y and symbols[x] == symbols[y]:
                    x, y, length = x + step, y + step, length + 1
                assert x == y or got == length


# Byte pairs ----------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def rank_file():
    return Path(public_tokenizers.path("byte_bpe_50k.tiktoken")).read_bytes()


@pytest.fixture(scope="module")
def library(rank_file):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_file.splitlines())}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


def odd_texts():
    rng = random.Random(7)
    parts = ["a", "B", "s", "t", "ve", "'", "'s", "'re", "'ll", "'LL", "'d", " ", "  ", "\n", "\t",
             "\r\n", "　", "\x1c", "1", "½", "!", "#", "é", "日", "𝒳", "😀", "́", "Ꟍ",
             "<|endoftext|>", "\x00"]
    texts = [None, "", " ", "  ", "a ", " 's", "x's's", "\n'll do", "Ü" * 3000, " " * 3000 + "x",
             "ab" * 4000, "".join(rng.choice("abcdefg") for _ in range(4000))]
    return texts + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))
                    for _ in range(3000)]


def test_byte_pairs_as_the_library(spark, rank_file, library):
    texts = odd_texts()
    rows = [*enumerate(texts), (None, "null id"), (5, texts[5])]
    docs = spark.createDataFrame(rows, "doc_id int, text string").withColumns(
        {"ids": F.lit("clash"), "ends": F.lit(None), "decoded": F.lit(1)})
    encoded = byte_pairs.encode(docs, rank_file, "doc_id")
    assert byte_pairs.encode(docs.limit(0), rank_file).count() == 0
    seen = 0
    for r in byte_pairs.decode(encoded, rank_file).collect():
        text = ("null id" if r.doc_id is None else texts[r.doc_id]) or ""
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert ids == library.encode_ordinary(text) and len(ids) == r.n_tokens
        assert bytes(r.decoded) == text.encode()
        seen += 1
    assert seen == len(rows)
    plain = byte_pairs.decode(encoded.drop("ends"), rank_file)
    assert plain.exceptAll(byte_pairs.decode(encoded, rank_file)).isEmpty()


def test_byte_pair_ends(spark, rank_file, library):
    """The ends cut a text into its tokens' bytes, across rows of one batch."""
    texts = ["one two", "", "日本 isn't", None, "  x"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").coalesce(1)
    for r in byte_pairs.encode(docs, rank_file, "doc_id").collect():
        ends = [0, *np.frombuffer(r.ends, "<u4").tolist()]
        data = (texts[r.doc_id] or "").encode()
        cut = [data[a:b] for a, b in zip(ends, ends[1:])]
        assert cut == [library.decode_single_token_bytes(i) for i in np.frombuffer(r.ids, "<u4")]


def test_piece_starts_over_rows():
    """The scan gives what reading one character after the other gives, whatever the layout."""
    rng = np.random.default_rng(8)
    for n in (1, 15, 16, 17, 5000):
        symbol = rng.integers(0, 8, n).astype(np.uint8)
        symbol[rng.random(n) < 0.02] += 8
        state, want = 0, []
        for s in symbol.tolist():
            want.append(bool(byte_pairs._NEW[s << 3 | state]))
            state = int(byte_pairs._STEP[s << 3 | state])
        assert byte_pairs.piece_starts(symbol).tolist() == want


def test_byte_pairs_query(spark, sf_dir, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op12_byte_pairs(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = library.encode_ordinary(docs[r.doc_id] or "")
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), sha(np.array(ids, "<u4").tobytes()), sha(docs[r.doc_id] or ""))


# Centroids -----------------------------------------------------------------------------------

def brute_clusters(rows, size, k, rounds):
    kept = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == size
            and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, sha(f"3:{r[0]}"), r[1]))
    middle = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(middle))
    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        middle = [[sum(x) // own.count(j) for x in zip(*[v for (_, v), o in zip(kept, own) if o == j])]
                  if j in own else c for j, c in enumerate(middle)]
    return sorted(((i, nearest(v)[1], nearest(v)[0]) for i, v in kept), key=repr), middle


def test_centroids(spark):
    rng = random.Random(9)
    rows = [(i, [rng.choice([-1, 1]) * rng.random() for _ in range(4)]) for i in range(80)]
    rows += [(100, None), (101, []), (102, [1.0] * 5), (103, [1.0, None, 0.0, 0.0]),
             (104, [float("nan")] * 4), (105, [0.0, float("-inf"), 0.0, 0.0]), (3, rows[3][1]),
             (3, [0.5] * 4), (None, [0.25] * 4), (106, [0.0] * 4), (107, [0.0] * 4)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns(
        {"x": F.lit(1), "cluster": F.lit("clash"), "distance": F.lit(None)})
    for k in (1, 5, 200):
        found, middle = centroids.clustered(frame, size=4, n_clusters=k, rounds=4)
        want, want_middle = brute_clusters(rows, 4, k, 4)
        assert middle == want_middle
        assert sorted((tuple(r) for r in found.collect()), key=repr) == want
    told = centroids.with_inertia(found, middle).collect()
    assert len(told) == len(want) and told[0].inertia == sum(w[2] for w in want)
    empty = centroids.with_inertia(*centroids.clustered(frame.where("vec_id = 104"), size=4))
    assert empty.count() == 0


def test_centroids_query(spark, sf_dir, con):
    from checks.compare import normal_rows
    from billflow.llm.queries import ORACLES
    mine = op13_centroids(spark, sf_dir)
    cursor = con.execute(ORACLES["op13_centroids"])
    theirs = normal_rows([d[0] for d in cursor.description], cursor.fetchall())
    assert normal_rows(mine.columns, [tuple(r) for r in mine.collect()]) == theirs
