"""Operators over more buckets than there is something for."""

import random

from billflow.llm import context_tree


def test_context_buckets_that_hold_words_only(spark, monkeypatch):
    """Texts of two letters have few strings of two bytes and many words: most buckets get no string."""
    rng = random.Random(5)
    texts = [(i, " ".join("".join(rng.choice("ab") for _ in range(9)) for _ in range(30))) for i in range(40)]
    docs = spark.createDataFrame([*texts, (40, ""), (41, None)], "doc_id long, text string")
    found = []
    for buckets in (1, 64):
        monkeypatch.setattr(context_tree, "buckets_for", lambda docs, size: buckets)
        found.append({r.doc_id: (*r[1:5], round(r.base_score, 6), round(r.score, 3)) for r in context_tree.scored(docs).collect()})
    assert found[0] == found[1] and len(found[0]) == 42
    assert {r[3] for r in found[0].values()} == {sum(30 for i, _ in texts if not context_tree.held_out(i))
                                                 + sum(not context_tree.held_out(i) for i in range(42))}
