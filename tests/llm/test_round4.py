"""Operators where groups are large: no more work than the rows need, and the same results."""

import pickle
import random

import pytest

from billflow.llm import jaccard_join, sentence_pieces
from billflow.llm.queries import piece_vocabulary

WORDS = 5


def _components(texts: dict[int, str]) -> dict[int, int]:
    """By definition: all pairs."""
    sets = {}
    for k, text in texts.items():
        words = text.split()
        sets[k] = {tuple(words[i:i + WORDS]) for i in range(max(1, len(words) - WORDS + 1))}
    label = {k: k for k in texts}

    def top(k: int) -> int:
        while label[k] != k:
            k = label[k]
        return k
    ids = sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            common = len(sets[a] & sets[b])
            if 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                low, high = sorted((top(a), top(b)))
                label[high] = low
    return {k: top(k) for k in ids}


def _variants(rng: random.Random, n: int, edits: tuple[int, int], cut: int) -> dict[int, str]:
    """One text with some words replaced and up to `cut` words missing at its end."""
    base = [f"w{i}" for i in range(150)]
    out = {}
    for k in range(n):
        words = list(base)
        for _ in range(rng.randint(*edits)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10 ** 9)}"
        out[k] = " ".join(words[:len(words) - rng.randint(0, cut)])
    return out


@pytest.mark.parametrize("edits,cut", [((5, 6), 0), ((1, 5), 40)])
def test_jaccard_join_of_members_far_apart(spark, monkeypatch, edits, cut):
    texts = _variants(random.Random(7), 160, edits, cut)
    counted, measure = [], jaccard_join._measured

    def measured(pairs, sets):
        counted.append(pairs.count())
        return measure(pairs, sets)
    monkeypatch.setattr(jaccard_join, "_measured", measured)
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.linked_components(rows).collect()}
    assert got == _components(texts)
    if not cut:  # all sizes alike: nearly all share too little with the others for any link
        assert sum(counted) < 3 * len(texts)


def test_frequent_words_are_encoded_once(monkeypatch):
    """Words of every batch stay known, however many others come and go, in later tasks of a process, too."""
    import public_tokenizers
    import sentencepiece
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    monkeypatch.setattr(sentence_pieces, "KEPT", 100)
    asked, encode = [], sentence_pieces.encode_words

    def encode_words(vocabulary, words):
        asked.extend(words)
        return encode(vocabulary, words)
    monkeypatch.setattr(sentence_pieces, "encode_words", encode_words)
    vocabulary, often = piece_vocabulary(), [f"often{k}" for k in range(20)]
    for batch in range(10):
        texts = [" ".join(often + [f"seldom{batch}x{k}" for k in range(60)]), None, ""]
        got = sentence_pieces.encode_texts(vocabulary, texts).to_pylist()
        assert got == [library.encode(texts[0]), None, []]
    assert len(asked) == len(set(asked)) == 20 + 10 * 60
    assert len(vocabulary._words) <= 100 and len(vocabulary._older) <= 100
    known = sentence_pieces._known_here("one", vocabulary)
    assert sentence_pieces._known_here("one", pickle.loads(pickle.dumps(vocabulary))) is known
