"""Text behind a JSON value, long runs and odd key names must not slip through."""

import random
import time

import pytest
from pyspark.sql import functions as F

from palimpsest.functions.fields import is_sensitive_key
from palimpsest.functions.rules import RUN_RULES, redaction_rules, scan_rules
from palimpsest.operators.json_records import redact_json, split_malformed
from palimpsest.operators.scan import leftovers
from palimpsest.operators.text import redact_text
from palimpsest.policy import Policy

MAIL = "someone@mail.example.org"
BROKEN = ['{"a":1} ' + MAIL, "12 " + MAIL, f'[1] {MAIL}', f'"x" {MAIL}', f"null {MAIL}", f'{{"a":1}} {{"b":"{MAIL}"}}', f'1] {MAIL}', f'{{"a":1}}] "{MAIL}"']


@pytest.mark.parametrize("hits", [None, "hits"])
def test_text_behind_a_value_is_redacted(spark, policy, hits):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(BROKEN)], "i int, raw string")
    got = [r["raw"] for r in redact_json(rows, "raw", policy, hits=hits).orderBy("i").collect()]
    assert not any(MAIL in t for t in got)
    assert all("EMAIL" in t for t in got)
    assert not any(r["is_valid"] for r in split_malformed(rows).collect())


def test_whole_values_stay_valid(spark):
    whole = ['{"a":1}', "[1,2]", " 12 ", '"x"', "null", "true", '{"a":{"b":[]}}']
    rows = spark.createDataFrame([(t,) for t in whole], "raw string")
    assert all(r["is_valid"] for r in split_malformed(rows).collect())


def test_long_runs_of_labels(spark):
    policy = Policy("canuser", "/home/canuser", private_terms=("canuserlab",), private_domains=("corp.test",))
    texts = ["a." * 2_000 + "corp.test", "x canuser " + "a." * 2_000, "canuserlab" + ".a" * 2_000, "--home-canuser" + "-a" * 2_000]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    start = time.time()
    got = [r["t"] for r in redact_text(rows, "t", policy).collect()]
    assert "corp.test" not in got[0] and "canuserlab" not in got[2]
    assert all(r["n"] >= 0 for r in rows.select(F.size(leftovers(F.col("t"), policy)).alias("n")).collect())
    assert time.time() - start < 120


def test_run_rules_match_as_without_their_start_guard(spark, policy, monkeypatch):
    def runs():
        return {(kind, r.category): r.pattern for kind, rules in (("redact", redaction_rules(policy)), ("scan", scan_rules(policy)))
                for r in rules if r.category in RUN_RULES}

    guarded = runs()
    monkeypatch.setattr("palimpsest.functions.rules.RUN_RULES", set())
    plain = {(kind, r.category): r.pattern for kind, rules in (("redact", redaction_rules(policy)), ("scan", scan_rules(policy)))
             for r in rules if (kind, r.category) in guarded}
    assert len(guarded) == 5 and all(guarded[k] != plain[k] for k in guarded)
    draw = random.Random(3)
    parts = ["a", "bc", "Z9", ".", ".", "_", "-", "%", "+", "@", "@", ":", ":", "/", "\\", " ", "é", "ſ", ".git", ".git", "x.org", "app.", "canuser", "CANUSERLAB", "q" * 70]
    texts = ["".join(draw.choices(parts, k=draw.randint(1, 30))) for _ in range(20_000)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").repartition(8)
    for key in guarded:
        found = [F.regexp_extract_all("t", F.lit(p), F.lit(0)) for p in (guarded[key], plain[key])]
        split = [F.split("t", p, -1) for p in (guarded[key], plain[key])]
        got = rows.agg(F.count_if(F.size(found[0]) > 0).alias("hits"), F.count_if((found[0] != found[1]) | (split[0] != split[1])).alias("other")).first()
        assert got["hits"] > 200 and got["other"] == 0, key


def test_run_rules_take_linear_time(spark, policy):
    texts = ["a." * 200_000, "a@b " + "a." * 200_000 + ":.git", "canuser " + "a." * 200_000]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    patterns = {r.pattern for r in [*redaction_rules(policy), *scan_rules(policy)] if r.category in RUN_RULES}
    start = time.time()
    rows.select(*[F.size(F.regexp_extract_all("t", F.lit(p), F.lit(0))) for p in patterns]).collect()
    assert time.time() - start < 30


def test_extra_keys_in_any_spelling(spark):
    policy = Policy("u", "/home/u", extra_sensitive_keys=("accessToken2", "X-Org-Id"))
    keys = ["accessToken2", "ACCESS_TOKEN2", "x_org_id", "xOrgId", "harmless"]
    got = spark.createDataFrame([(k,) for k in keys], "k string").select(is_sensitive_key(F.col("k"), policy).alias("s")).collect()
    assert [r["s"] for r in got] == [True, True, True, True, False]
