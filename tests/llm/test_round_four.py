"""Bounds and exactness of what the corpus operators keep and send."""

import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from palimpsest.llm import hmm, minhash, pieces
from palimpsest.llm.queries import MODEL
from palimpsest.session import materialized


def test_table_of_known_words_is_bounded():
    """300,000 distinct words pass through; what a task keeps of them stays below 48 MB (70 before)."""
    encoder = pieces.Encoder(pieces.load(MODEL), 2)
    tracemalloc.start()
    most = 0
    for at in range(0, 300_000, 20_000):
        texts = [" ".join(f"{i:x}{i * 7919 % 99991:x}" for i in range(low, low + 500)) for low in range(at, at + 20_000, 500)]
        words = [encoder.split(t) for t in texts]
        encoder.learn(words)
        assert all(encoder.encode(t, w) for t, w in zip(texts, words, strict=True))
        del texts, words
        most = max(most, tracemalloc.get_traced_memory()[0])
    tracemalloc.stop()
    assert most < 48 << 20


# --------------------------------------------------------------------------- 5

def test_emissions_travel_as_shards(spark, odd, monkeypatch):
    """A block gets a row a shard, not one a symbol; shards and parts of a round do not change scores."""
    sent, together = [], hmm.together
    monkeypatch.setattr(hmm, "together", lambda left, *rest: sent.append(left.count()) or together(left, *rest))
    docs = odd.select("doc_id", "text").union(spark.createDataFrame([(100 + i, " ".join(f"w{j}" for j in range(i, i + 300))) for i in range(20)], "doc_id long, text string"))

    def scores():
        sent.clear()
        return sorted((r["doc_id"] or -1, r["n_tokens"], r["n_known"], round(r["base_score"], 3), round(r["score"], 2))
                      for r in hmm.language_model(docs, F.col("doc_id") != 107, rounds=1).collect())
    whole = scores()
    distinct = 319 + 10                               # words seen three times, and some classes
    assert len(whole) == docs.count() and min(sent) * 4 < distinct
    monkeypatch.setattr(hmm, "SHARD_PLACES", 16)
    monkeypatch.setattr(hmm, "PASSES", 1)
    assert scores() == whole and max(sent[1:]) > 100


# --------------------------------------------------------------------------- 8

def test_a_pair_comes_from_one_of_its_lists(spark, monkeypatch):
    """Near copies share many lists; a round gave a pair once for each of them."""
    rng, found, between = np.random.default_rng(6), [], minhash.between_components

    def seen(*rest):
        rows = materialized(between(*rest))
        found.append([(r["a"], r["b"]) for r in rows.collect()])
        return rows

    monkeypatch.setattr(minhash, "between_components", seen)
    texts = []
    for _ in range(80):
        t = [f"c{i}" for i in range(80)]
        for i in rng.choice(80, rng.integers(2, 6), replace=False):
            t[i] = f"x{rng.integers(10**6)}"
        texts.append(" ".join(t))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert minhash.near_duplicates(docs, size=2).count() == 80
    assert sum(map(len, found)) > 50
    assert all(len(pairs) == len(set(pairs)) for pairs in found)


def test_long_rows_reach_workers_in_small_batches(spark):
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    sizes = [r["n"] for r in materialized(spark.range(300, numPartitions=1).mapInArrow(run, "n bigint"), 100).collect()]
    assert sum(sizes) == 300 and max(sizes) <= 100
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
