"""What the hidden Markov model sends and keeps."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from palimpsest.llm import hmm
from palimpsest.session import materialized


def test_words_are_asked_for_by_shard(spark, monkeypatch):
    """Coding gets a row for a block and shard; it got one for each word of each block, and texts were cut into words twice."""
    sent, together = [], hmm.together
    monkeypatch.setattr(hmm, "together", lambda left, *rest: sent.append(left.count()) or together(left, *rest))
    monkeypatch.setattr(hmm, "PASSES", 1)
    docs = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(400))) for i in range(4)], "doc_id long, text string").coalesce(1)
    rows = hmm.language_model(docs, F.col("doc_id") != 3, rounds=1).collect()
    assert {(r["n_tokens"], r["n_known"], r["train_tokens"]) for r in rows} == {(401, 401, 1203)} and sent[0] < 40


def test_word_counts(spark, monkeypatch):
    """Counts of the training texts alone, over blocks and shards; words in no training text and the end are among what blocks ask."""
    texts = [(0, "a a b", True), (1, "A c\tx", False), (2, None, True), (3, "b b", True), (4, "rare a", True)]
    raw = materialized(hmm.blocks(spark.createDataFrame(texts, "id long, text string, train boolean").repartition(3, "id")))
    words = {r["block"]: r["words"].split(b" ") for r in raw.collect()}
    want = {b"a": 3, b"b": 3, b"c": 0, b"x": 0, b"rare": 1, b"": 4}
    for shards in (1, 4):
        rows = hmm.word_counts(raw, shards, 2).collect()
        own, asked = [r for r in rows if r["block"] == -1], [r for r in rows if r["block"] >= 0]
        names = {(r["shard"], i): (w, c) for r in own for i, (w, c) in enumerate(zip(r["names"], r["name_counts"], strict=True))}
        assert {bytes(w): c for w, c in names.values()} == {b"a": 3, b"b": 3, b"": 4}
        assert (sum(r["n"] for r in own), sum(r["v"] for r in own)) == (11, 4)
        assert [(k, c, v) for r in own for k, c, v in zip(r["classes"], r["class_c"], r["class_v"], strict=True)] == [(hmm.word_class(b"rare"), 1, 1)]
        seen = {b: 0 for b in words}
        for r in asked:
            for place, slot, c in zip(*[np.frombuffer(r[x], t).tolist() for x, t in (("places", np.uint32), ("slots", np.int32), ("counts", np.int64))], strict=True):
                word = words[r["block"]][place]
                assert c == want[word] and (bytes(names[r["shard"], slot][0]) == word if slot >= 0 else slot == -1 - hmm.word_class(word))
                seen[r["block"]] += 1
        assert seen == {b: len(w) for b, w in words.items()}


def test_arrays_are_used_again(monkeypatch):
    """Texts after others in the same arrays get the same counts as in fresh ones, also in parts."""
    rng = np.random.default_rng(3)
    start, move, emit = rng.dirichlet(np.ones(3)), rng.dirichlet(np.ones(3), 3), rng.dirichlet(np.ones(9), 3).T
    room = hmm.Room()
    for limit in (hmm.TOKENS, 7, 1):
        monkeypatch.setattr(hmm, "TOKENS", limit)
        for most in (30, 5, 12):
            texts = [rng.integers(0, 9, n) for n in rng.integers(1, most, 8)]
            for have, want in zip(hmm.expected(texts, start, move, emit, room), hmm.expected(texts, start, move, emit), strict=True):
                assert np.allclose(have, want)
            assert hmm.forward(texts, start, move, emit, room).sum() == pytest.approx(hmm.expected(texts, start, move, emit)[3])


def test_codes_are_packed():
    for most in (1, 1 << 24, (1 << 24) + 1):
        codes = np.array([0, most - 1, most // 2], dtype=np.uint32)
        data = hmm._packed(codes, most)
        assert len(data) == (9 if most <= 1 << 24 else 12) and (hmm._unpacked(data, 3) == codes).all()
