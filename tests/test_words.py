"""Texts that no rule can change cost little, and nothing is worked out twice."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from palimpsest.functions.expr import json_quote
from palimpsest.functions.redact import _fold_sql, redacted, redacted_with_hits
from palimpsest.functions.rules import redaction_rules, word_literals
from workload import queries


def test_hits_are_worked_out_once(spark, sf):
    plan = queries.json_hits(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Filter (") == 0 and plan.count("Filter isnotnull(h") <= 1


def test_late_rules_are_found_by_halving(policy):
    rules = redaction_rules(policy)
    fold = _fold_sql(rules, lambda r: f"'rule {r.ordinal}'")
    assert all(fold.count(f"WHEN {r.ordinal} THEN 'rule {r.ordinal}'") == 1 for r in rules)
    assert max(len(re.findall("WHEN", c)) for c in fold.split("CASE")) <= 3


words = st.one_of(st.text("abcXYZ_k", max_size=12), st.sampled_from(
    ["canuser", "CanUser", "my_canuser_dir", "canuserlab", "REDACTED", "AirPods_Pro", "airpods", "Scarlett_Solo", "bearer", "gh" "p_" + "g" * 24,
     "AI" "za" + "z" * 32, "AK" "IA" + "Q" * 16, "h" "f_" + "h" * 24, "ey" "J" + "a" * 12, "Focusrite_USB", "dev_x", "a b", "canuser@box", "ſcarlett", "", None]))


@given(st.lists(words, min_size=1, max_size=40))
@settings(max_examples=8, deadline=None)
def test_words_without_a_rule(spark, policy, texts):
    """The short way and every rule in turn give the same text and hits."""
    rules = redaction_rules(policy)
    every = F.array(*[F.lit(r.ordinal) for r in rules])
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", redacted(F.col("t"), policy, rules, every).alias("short"), redacted_with_hits(F.col("t"), policy, rules, every).alias("with"),
                     redacted(F.concat(F.col("t"), F.lit(" .")), policy, rules, every).alias("long"),
                     redacted_with_hits(F.concat(F.col("t"), F.lit(" .")), policy, rules, every).alias("long_with"))
    for r in rows.collect():
        assert r["short"] == r["with"]["text"]
        assert r["t"] is None or (r["short"] + " .", r["with"]["hits"]) == (r["long"], r["long_with"]["hits"])


def test_rules_without_a_guard_see_every_word(spark, policy):
    rules = redaction_rules(policy)
    assert word_literals(rules) and {"canuser", "redacted", "bearer", "hf_"} <= set(word_literals(rules))
    assert word_literals([*rules, type(rules[0])(99, "x", "x", "y", (), "x")]) is None


def test_quotes(spark):
    texts = ["", "plain", 'a"b', "a\\b", "\n\r\t\b\f", "\x00\x1f", "ü ", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", json_quote(F.col("t")).alias("q"), F.from_json(
        F.concat(F.lit("["), json_quote(F.col("t")), F.lit("]")), "array<string>").alias("back")).collect()
    assert all((r["q"] is None) if r["t"] is None else r["back"] == [r["t"]] for r in rows)
    assert {r["t"]: r["q"] for r in rows}["\x00\x1f"] == '"\\u0000\\u001f"'
