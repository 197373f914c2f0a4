"""Each operator against brute force on small data, with nulls, empty and repeated rows, and clashing columns."""

import hashlib
import json
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from billflow.llm import (
    chat_tree, context_tree, jaccard_join, mixing, quality_rules, sampled_fingerprints,
    sentence_pieces, substring_dedup, suffix_dedup, token_counts)
from billflow.llm.queries import piece_vocabulary

LOWER = {c: c + 32 for c in range(65, 91)}
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def fixture_texts():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 8))) for _ in range(300)]
    base = " ".join(rng.choice(words) for _ in range(120))
    passage = " ".join(rng.choice(words) for _ in range(60))
    texts = [None, "", "   \n\t ", "one", "two words", base, base, base + " more", "Ü" * 60]
    for edits in (2, 4, 8, 12, 16, 25):  # from near copies over the threshold to far ones
        for _ in range(4):
            changed = base.split()
            for _ in range(edits):
                changed[rng.randrange(len(changed))] = rng.choice(words) + "x"
            texts.append(" ".join(changed))
    for k in range(6):
        own = [rng.choice(words) + str(k) for _ in range(80)]
        texts.append(" ".join(own[:40]) + "\n" + passage + "\n" + " ".join(own[40:]))
    texts += ["THE " * 200, "ab" * 300, "line one here\n" * 30, " ".join(words * 30), passage]
    return texts


@pytest.fixture(scope="module")
def texts():
    return dict(enumerate(fixture_texts()))


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else \
        {tuple(w)} if w else set()


def brute_components(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in texts}


def test_jaccard_join(docs, texts, empty):
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in jaccard_join.linked_components(docs).collect()}
    assert got == brute_components(texts)
    assert jaccard_join.linked_components(empty).count() == 0


def test_jaccard_join_many_rounds(spark):
    """Copies of one text with growing edits, in an order that leaves boundary pairs to be measured."""
    rng = random.Random(11)
    base = [f"w{i}" for i in range(200)]
    made = {}
    for i in range(60):
        words = list(base)
        for _ in range(rng.randint(0, 14)):
            words[rng.randrange(200)] = f"e{rng.randrange(40)}"
        made[i] = " ".join(words)
    made = dict(zip(rng.sample(range(60), 60), made.values()))
    rows = spark.createDataFrame(list(made.items()), "doc_id long, text string")
    rows = rows.unionByName(rows.limit(5)).withColumn("size", F.lit("other"))
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in jaccard_join.linked_components(rows).collect()}
    assert got == brute_components(made)


def test_jaccard_join_across_sizes(spark):
    """Texts that grow step by step: each links to the next alone, often too large for the pivot of its region;
    and families whose members differ in length, with edits and cuts of their own."""
    rng = random.Random(23)
    made = []
    for family in range(4):
        base = [f"f{family}w{i}" for i in range(400)]
        size = 30.0
        while size < 400:
            made.append(base[:int(size)])
            size *= (1.2, 1.3, 1.36, 1.1)[family]
        for _ in range(25):
            words = base[rng.randrange(30):260 + rng.randrange(60)]
            for _ in range(rng.randint(0, 12)):
                words[rng.randrange(len(words))] = f"e{rng.randrange(20)}"
            made.append(words)
    texts = dict(zip(rng.sample(range(10 * len(made)), len(made)), (" ".join(w) for w in made)))
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in jaccard_join.linked_components(rows).collect()}
    assert got == brute_components(texts)


def test_substring_dedup(docs, texts, spark, empty):
    extra = docs.unionByName(spark.createDataFrame([(None, texts[5])], docs.schema))
    rows = substring_dedup.without_copies(extra.withColumn("_keys", F.lit("mine"))).collect()
    assert len(rows) == len(texts) + 1
    got = {r.doc_id: r for r in rows}
    assert got[None].n_removed == 0 and got[None].text == texts[5]
    assert got[0].text is None and got[1].text == ""
    assert got[6].text == "" and got[5].text == texts[5]  # an exact copy goes, the first stays
    passages = [i for i, t in texts.items() if t and t.count("\n") == 2 and len(t) > 500]
    for i in passages[1:]:
        middle = texts[i].split("\n")[1]
        left = len(got[i].text) - len(texts[i]) + len(middle)
        assert left < 0.6 * len(middle) and texts[i].split("\n")[0][:200] in got[i].text
    assert got[passages[0]].n_removed == 0
    assert substring_dedup.without_copies(empty).count() == 0


def test_chunks_resist_shifts():
    rng = np.random.RandomState(0)
    data = rng.randint(97, 123, 5000).astype(np.uint8)
    moved = np.concatenate([data[:1000], np.frombuffer(b"inserted", np.uint8), data[1000:]])
    keys = [set(substring_dedup.chunks(x, np.array([0, len(x)]))[1].tolist())
            for x in (data, moved)]
    assert len(keys[0] - keys[1]) <= 3


def brute_repeats(texts):
    seen, out = set(), {}
    for i in sorted(texts):
        data = (texts[i] or "").encode()
        gone = np.zeros(len(data), bool)
        here = [data[k:k + 50] for k in range(len(data) - 49)]
        for k, w in enumerate(here):
            if w in seen:
                gone[k:k + 50] = True
        seen.update(here)
        edges = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(data) else 0
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        out[i] = (len(data), int(gone.sum()), edges, sha(kept))
    return out


def test_suffix_dedup(docs, texts, empty):
    rows = suffix_dedup.without_repeats(docs).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} \
        == brute_repeats(texts)
    assert suffix_dedup.without_repeats(empty).count() == 0


def test_suffix_dedup_random_overlaps(spark):
    rng = random.Random(3)
    made = {i: "".join(rng.choice("ab") for _ in range(rng.randint(0, 120))) for i in range(60)}
    for i in range(60, 120):
        a, b = made[rng.randrange(60)], made[rng.randrange(60)]
        made[i] = a[rng.randrange(len(a) + 1):] + b[:rng.randrange(len(b) + 1)] + "é"
    rows = suffix_dedup.without_repeats(
        spark.createDataFrame(list(made.items()), "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} \
        == brute_repeats(made)


def test_sentence_pieces_equal_the_library(docs, texts, empty):
    import sentencepiece
    library = sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model"))
    vocabulary = piece_vocabulary()
    for r in sentence_pieces.encode_decode(docs, vocabulary).collect():
        if texts[r.doc_id] is None:
            assert r.ids is None and r.decoded is None
        else:
            assert r.ids == library.encode(texts[r.doc_id]) and r.decoded == texts[r.doc_id]
    assert sentence_pieces.encode_decode(empty, vocabulary).count() == 0
    rng = random.Random(2)
    parts = ["a", " ", "  ", "\n", "é", "日本", "<s>", "<0x41>", "the", "ing", "----", "　", "x" * 9]
    odd = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(2000)]
    assert sentence_pieces.encode_texts(vocabulary, odd).to_pylist() == library.encode(odd)


def test_unigram_scores_are_best():
    pieces = ["<unk>", "▁", "a", "b", "ab", "▁a", "ba", "bab"]
    scores = [0, -2, -3, -3.2, -4, -4.5, -4.1, -5]
    v = sentence_pieces.Vocabulary(pieces, scores, [], 0, True)

    def best(word):
        if not word:
            return 0.0
        return max([scores[v.ids[word[:k]]] + best(word[k:])
                    for k in range(1, len(word) + 1) if word[:k] in v.ids])
    words = ["▁abab", "▁aba", "▁babba", "▁bb", "▁"]
    for word, ids in sentence_pieces.encode_words(v, words).items():
        assert sum(scores[i] for i in ids) == pytest.approx(best(word))
        assert "".join(pieces[i] for i in ids) == word


def test_fingerprints(docs, texts, empty):
    rows = sampled_fingerprints.with_fingerprints(docs).collect()
    order = sorted(texts, reverse=True)
    following = dict(zip(order, order[1:] + order[:1]))

    def weights(text):
        w = WORD.findall(text.translate(LOWER))
        return Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else \
            Counter([tuple(w)] if w else [])

    def alike(a, b):
        a, b = weights(a), weights(b)
        either = sum((a | b).values())
        return sum((a & b).values()) / either if either else 1.0
    far, every, prints = [], [], {}
    for r in rows:
        text, other = texts[r.doc_id] or "", texts[following[r.doc_id]] or ""
        cut = len(text) // 3
        edited = text[:len(text) - cut] + other[:cut]
        assert (r.n_chars, r.edited_sha256) == (len(text), sha(edited))
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
        assert bool(r.fingerprint) == bool(weights(text))
        for told, true in ((r.near_edited, alike(text, edited)), (r.near_next, alike(text, other))):
            assert true not in (0.0, 1.0) or told == pytest.approx(true, abs=0.05)
            every.append(told - true)
            if min(len(weights(text)), len(weights(other))) > 60:  # enough terms to fill the samples
                far.append(told - true)
    assert len(rows) == len(texts)
    assert abs(sum(far) / len(far)) < 0.05 and max(map(abs, far)) < 0.35
    assert (sum(e * e for e in every) / len(every)) ** 0.5 < 0.12
    assert sampled_fingerprints.with_fingerprints(empty).count() == 0


def test_fingerprints_of_odd_rows(spark):
    """Null ids go, repeated rows stay, ids of another type and extra columns do no harm; five words are a term."""
    rows = [(1, "a b c d e", "x"), (1, "a b c d e", "x"), (2, "A  b c\nd e", "y"), (None, "lost", "z"),
            (3, None, "w"), (4, "a b c d e f", "v")]
    df = spark.createDataFrame(rows, "doc_id int, text string, own string")
    got = sampled_fingerprints.with_fingerprints(df).collect()
    assert sorted(r.doc_id for r in got) == [1, 1, 2, 3, 4]
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].fingerprint == by_id[2].fingerprint != "" == by_id[3].fingerprint
    assert by_id[2].near_next == 1.0 and by_id[3].near_next == 0.0


@pytest.mark.parametrize("heavy", [1, 2, 3, 8])
def test_fingerprint_weights(spark, heavy):
    """Samples follow the weights: 600 terms of weight 1 against the same ones of weight w are alike by 1/w."""
    df = spark.createDataFrame([(side, f"{term}", weight) for side, weight in ((0, 1), (1, heavy))
                                for term in range(600)], "side int, name string, weight int")
    rows = df.select("side", F.xxhash64("name").alias("term"), "weight")
    least = sampled_fingerprints.drawn(rows).groupBy("side", F.shiftright("value", 57)).agg(
        F.min("value").alias("value"))
    sets = [{r.value for r in least.collect() if r.side == side} for side in (0, 1)]
    assert len(sets[0]) == len(sets[1]) == sampled_fingerprints.SAMPLES
    assert abs(len(sets[0] & sets[1]) / sampled_fingerprints.SAMPLES - 1 / heavy) < 0.15


def test_chat_tree(spark):
    odd = ["</s>[INST] ok [/INST]", "[\\INST]", "<\\\\s> <<SYS>>", "", None, "[ROLE]x[/ROLE]", "a\nb"]
    rng = random.Random(1)
    rows = []
    for c in range(40):
        for turn in range(rng.randint(1, 5)):
            role = rng.choice(["user", "assistant", "system", None, "tool]", "[INST]"])
            rows.append((c, turn, role, odd[(c * turn) % 3] if turn < 2 else rng.choice(odd)))
    rows += [(None, 0, "user", "lost"), (3, None, "user", "first"), (4, 0, "user", "twice")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    tree = chat_tree.build(df.withColumn("depth", F.lit("clash")))
    got = {r.conv_id: r for r in chat_tree.read_back(tree).collect()}
    talks = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            talks[c].append((-1 if turn is None else turn, role or "", text or ""))
    assert set(got) == set(talks)
    for c, turns in talks.items():
        turns.sort()
        learned = "".join(t for _, r, t in turns if r == "assistant")
        r = got[c]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (
            len(turns), sha("".join(f"{r}\n{t}\n" for _, r, t in turns)), len(learned), sha(learned))
    # the layout: no gaps, each node once, and what a node sees is its conversation's beginning
    nodes = sorted(tree.nodes.collect(), key=lambda n: n["at"])
    layout = "".join(n.segment for n in nodes)
    place = 0
    for n in nodes:
        assert n["at"] == place
        place += len(n.segment)
        seen = "".join(layout[a["from"]:a["to"]] for a in n.sees)
        assert seen.endswith(n.segment) and len(seen) == n.position + len(n.segment)
    assert len({(n.depth, n.one, n.two) for n in nodes}) == len(nodes)
    none = chat_tree.build(df.limit(0))
    assert chat_tree.read_back(none).count() == 0


def test_context_tree(docs, texts, empty):
    small = {i: t for i, t in texts.items() if len(t or "") < 700}
    rows = {r.doc_id: r for r in context_tree.scored(
        docs.filter(F.col("doc_id").isin(list(small)))).collect()}
    depth, nodes = context_tree.DEPTH, defaultdict(lambda: [0, 0])
    out = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in small}

    def steps(text):
        symbols = [*(text or "").translate(LOWER).encode(), 256]
        for i, s in enumerate(symbols):
            context, node = tuple(([0] * depth + symbols[:i])[-depth:]), 1
            for bit in [1] if s == 256 else [(s >> (8 - k)) & 1 for k in range(9)]:
                yield context, node, bit
                node = 2 * node + bit
    for i, t in small.items():
        for context, node, bit in [] if out[i] else steps(t):
            for k in range(depth + 1):
                nodes[context[depth - k:], node][bit] += 1
    children = defaultdict(list)
    for context, node in nodes:
        if context:
            children[context[1:], node].append((context, node))

    def own(n):
        return (math.lgamma(n[0] + .5) + math.lgamma(n[1] + .5) - math.log(math.pi)
                - math.lgamma(n[0] + n[1] + 1))
    known = {}

    def weight(key):
        if key not in known:
            e = own(nodes[key])
            known[key] = e if len(key[0]) == depth else math.log(.5) + np.logaddexp(
                e, sum(weight(c) for c in children[key]))
        return known[key]

    def chance(context, node, bit):
        p = 0.5
        for k in range(depth, -1, -1):
            key = (context[depth - k:], node)
            n = nodes.get(key, [0, 0])
            guess = (n[bit] + .5) / (sum(n) + 1)
            trust = 1.0 if k == depth else math.exp(
                math.log(.5) + own(n) - weight(key)) if key in nodes else .5
            p = trust * guess + (1 - trust) * p
        return p
    tokens = {i: WORD.findall((t or "").translate(LOWER)) + [None] for i, t in small.items()}
    count = Counter(w for i, ws in tokens.items() if not out[i] for w in ws)
    total, distinct = sum(count.values()), len(count)
    for i, t in small.items():
        r = rows[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (
            out[i], len(tokens[i]), sum(w in count for w in tokens[i]), total)
        assert r.base_score == pytest.approx(sum(math.log10(
            (count[w] + 1) / (total + distinct + 1)) for w in tokens[i]))
        assert r.score == pytest.approx(sum(math.log10(chance(*s)) for s in steps(t)), rel=1e-5)
    assert context_tree.scored(empty).count() == 0


def test_token_counts(docs, texts, empty, monkeypatch):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    vocabulary = Path(path).read_text(encoding="utf-8")
    for r in token_counts.with_token_counts(docs.withColumn("n_tokens", F.lit(1)),
                                            vocabulary).collect():
        text = texts[r.doc_id] or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 512)
    assert token_counts.with_token_counts(empty, vocabulary).count() == 0
    machine = token_counts.Transducer(json.loads(vocabulary))
    monkeypatch.setattr(token_counts, "CHUNK", 7)
    monkeypatch.setattr(token_counts, "STATES", 300)
    rng = random.Random(1)
    parts = ["a", "b", "'", "s", "re", "'s", "'ll", " ", "  ", "\n", "é", "日", "1", "!", "...",
             "<|endoftext|>", "\x85", "\x1c", "　", "the", "ing", " of", "aaaa", "٣", "²"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert token_counts.count_tokens(machine, text) == len(
            library.encode(text, add_special_tokens=False).ids), text


def test_quality_counts(docs, texts, empty):
    for r in quality_rules.judged(docs.withColumn("kept", F.lit(1)), [], "doc_id").collect():
        text = texts[r.doc_id] or ""
        w = WORD.findall(text)
        runs = Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7))
        twice = {j for k in range(len(w) - 7) if runs[tuple(w[k:k + 8])] > 1
                 for j in range(k, k + 8)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        failed = len(w) < 20 or 100 * len(twice) > 30 * len(w)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
                r.base_failed, r.kept) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(twice), failed, not failed)
    assert quality_rules.judged(empty, [], "doc_id").count() == 0


def test_quality_rules_learn(spark, sf_dir, empty):
    docs = spark.read.parquet(f"{sf_dir}/../sf0.01/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/../sf0.01/labels.parquet")
    odd, even = labels.filter("doc_id % 2 = 1"), labels.filter("doc_id % 2 = 0")
    rules = quality_rules.learn_rules(quality_rules.labelled_stats(docs, even))
    seen = quality_rules.judged(docs, rules, "doc_id").filter("not base_failed").join(odd, "doc_id")
    right = seen.agg(F.avg((F.col("kept") == (F.col("quality") == 1)).cast("int"))).first()[0]
    assert rules and right > 0.95
    assert quality_rules.learn_rules(quality_rules.labelled_stats(empty, labels)) == []


def test_mixing(spark, sf_dir, empty):
    docs = spark.read.parquet(f"{sf_dir}/../sf0.01/documents.parquet")
    labels = mixing.domain_labels(spark.read.parquet(f"{sf_dir}/../sf0.01/labels.parquet"))
    targets = {"clean": 0.8, "poor": 0.15, "toxic": 0.05}
    rows = mixing.mixed(docs.unionByName(docs.limit(1).withColumn("text", F.lit(None))), labels,
                        targets).collect()
    assert len(rows) == docs.count() + 1
    sums = {k: sum(r.rate * r.n_tokens * r[f"p_{k}"] for r in rows) for k in targets}
    assert min(r.rate for r in rows) >= 0
    for k, share in targets.items():
        assert sums[k] / sum(sums.values()) == pytest.approx(share, abs=0.02)
    best = {r.doc_id: max(targets, key=lambda k: r[f"p_{k}"]) for r in rows}
    known = labels.collect()
    assert sum(best[r.doc_id] == r.domain for r in known) / len(known) > 0.9
    assert mixing.mixed(empty, labels).count() == 0
    assert mixing.mixed(docs, labels.limit(0)).count() == docs.count()


def test_clashing_columns_and_narrow_ids(spark, sf_dir):
    """Names that the operators use inside, and doc_id as int."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    odd = docs.select(F.col("doc_id").cast("int").alias("doc_id"), "text", F.lit(1).alias("bad"),
                      F.lit("x").alias("_id"), F.lit(None).alias("domain"),
                      F.lit(2).alias("_kept_id"), F.lit("y").alias("a.b"))

    def ids(rows):
        return sorted(r[0] for r in rows.select("doc_id").collect())
    good = quality_rules.keep_good(odd, labels)
    assert good.columns == odd.columns
    assert ids(good) == ids(quality_rules.keep_good(docs, labels))
    kept = mixing.keep_mixed(odd, mixing.domain_labels(labels))
    assert kept.columns == odd.columns and kept.schema["doc_id"].dataType == odd.schema["doc_id"].dataType
    # an id's chance is drawn from its hash, which depends on its type
    same = docs.withColumn("doc_id", F.col("doc_id").cast("int"))
    assert ids(kept) == ids(mixing.keep_mixed(same, mixing.domain_labels(labels)))
    vocabulary = Path(public_tokenizers.path("byte_bpe_50k.json")).read_text(encoding="utf-8")
    counted = token_counts.with_token_counts(odd.limit(20), vocabulary)
    assert counted.count() == 20 and counted.schema["doc_id"].dataType.simpleString() == "bigint"
