"""The literal join against plain search, with files that hold many records and many literals."""

import random

import pytest
from pyspark.sql import functions as F

from palimpsest.operators import literals as module
from palimpsest.operators.literals import anchored, candidates, literal_hits


def _made(seed, n_records, n_literals):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abAB01_é日", k=rng.randint(1, 9)))
    gap = lambda: rng.choice([" ", ".", "-", "--", "/", "\n", "=\"", ""])
    records = [(f"f{i % 3}", i, "".join(word() + gap() for _ in range(rng.randint(0, 30)))) for i in range(n_records)]
    records += [("f0", n_records, None), ("f1", n_records + 1, ""), ("f2", n_records + 2, "x" * 5000 + "needle" + "y" * 3000)]
    literals = []
    for i in range(n_literals):
        f, _, t = rng.choice(records[:n_records])
        a = rng.randint(0, max(0, len(t) - 1))
        cut = t[a:a + rng.choice([1, 2, 4, 6, 12, 60])] or "zz"
        literals.append((f, i, rng.choice([cut, cut, cut, cut + "q", cut[::-1]])))
    literals += [("f2", n_literals, "needle"), ("f2", n_literals + 1, "x" * 200 + "needley"), ("f0", n_literals + 2, "--"), ("none", n_literals + 3, "abc")]
    return records, literals


@pytest.mark.parametrize(("seed", "few", "pairs"), [(1, 0, 0), (2, 0, 0), (3, 60, 6000), (4, 1000, 10 ** 9)])
def test_hits_equal_plain_search(spark, monkeypatch, seed, few, pairs):
    monkeypatch.setattr(module, "FEW", few)
    monkeypatch.setattr(module, "DIRECT_PAIRS", pairs)
    records, literals = _made(seed, 120, 150)
    r = spark.createDataFrame(records, "rel_path string, line_no long, raw string")
    found = spark.createDataFrame(literals, "rel_path string, no long, literal string").withColumn("placeholder", F.concat(F.lit("[<"), "no", F.lit(">]")))
    ids = ["rel_path", "line_no"]
    got = {(x["rel_path"], x["line_no"]): {e["literal"] for e in x["literals"]} for x in literal_hits(r, ids, found, F.array("raw")).collect()}
    want, loose = {}, {}
    for f, no, lit in literals:
        # a piece of some placeholder, or one that may lie across a border
        if any(lit in f"[<{k}>]" for _, k, _ in literals):
            loose.setdefault(f, set()).add(lit)
        for g, line, text in records:
            if f == g and text is not None and lit in text:
                want.setdefault((g, line), set()).add(lit)
    assert got.keys() == want.keys()
    for k, held in want.items():
        assert held <= got[k] <= held | loose.get(k[0], set())


def test_candidates_are_few(spark):
    """A file of many records and many secrets with one beginning: pairs in the order of the hits, not of the product."""
    n = 3000
    records = spark.range(n).select(F.lit("big").alias("rel_path"), F.col("id").alias("line_no"),
                                    F.concat(F.lit("the token is ghp_"), F.sha2(F.col("id").cast("string"), 256), F.lit(" and the rest is common")).alias("raw"))
    literals = spark.range(0, n, 3).select(F.lit("big").alias("rel_path"), F.col("id").alias("no"),
                                           F.concat(F.lit("ghp_"), F.sha2(F.col("id").cast("string"), 256)).alias("literal"), F.lit("[X]").alias("placeholder"))
    pairs = candidates(records, ["rel_path", "line_no"], anchored(literals), F.array("raw")).collect()
    assert len(pairs) == n // 3 and all(p["no"] == p["line_no"] for p in pairs)


def test_nothing_to_find(spark):
    records = spark.createDataFrame([("f", 1, "text")], "rel_path string, line_no long, raw string")
    none = spark.createDataFrame([], "rel_path string, no long, literal string, placeholder string")
    assert literal_hits(records, ["rel_path", "line_no"], none, F.array("raw")).count() == 0
    assert literal_hits(records.where("false"), ["rel_path", "line_no"], spark.createDataFrame(
        [("f", 1, "text", "[X]")], none.schema), F.array("raw")).count() == 0
