"""Private terms: index, join and alternation agree; discovery inside the job."""

import json
import random

import pytest
from pyspark.sql import functions as F

from palimpsest.functions.redact import redacted
from palimpsest.functions.rules import redaction_rules
from palimpsest.operators import text
from palimpsest.operators.json_records import redact_json
from palimpsest.operators.term_index import redact_terms_joined, term_index
from palimpsest.plans import sanitize as job
from palimpsest.policy import Policy

TERMS = ["ana smith", "smith", "foo-bar", "-x-", "Élan", "straße", "日本", "x y z", "a.b", "canuserlab", "can", "kelvin", "foo",
         "bar baz", "bar", "(c)", "Smith & co", "  lead", "tail ", "Σίσυφος", "ab"]


def ordered(terms):
    return tuple(sorted(terms, key=lambda t: (-len(t), t.lower(), t)))


@pytest.fixture(scope="module")
def listed(spark, policy):
    terms = spark.createDataFrame([(t,) for t in TERMS], "term string")
    return terms, term_index(terms, policy), policy.with_terms(ordered(TERMS))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    parts = TERMS + [" ", ".", "-", "_", "1", "Ana", "SMITH", "ſmith", "Kelvin", "İ", " & ", "co", "x", " y ", " z", "ΣΊΣΥΦΟΣ", "STRASSE",
                     "@mail.example.org ", "http://a.b/c", " canuserlab.org ", "my_canuser_dir", "~/foo", "\n", "📎"]
    made = [(i, "".join(rng.choice(parts) + rng.choice(["", "", " "]) for _ in range(rng.randint(0, 14)))) for i in range(800)]
    return [*made, (900, None), (901, ""), (902, " \n"), (903, "foo " * 20_000)]


def test_index_equals_alternation(spark, listed, rows):
    _, index, full = listed
    df = spark.createDataFrame(rows, "id long, text string").withColumn("_found", F.lit(1)).withColumn("_row", F.lit(2))
    want = text.redact_text(df, "text", full, hits="h")
    got = text.redact_text(df, "text", full, hits="h", terms=index)
    assert got.columns == want.columns
    assert {r["id"]: r for r in got.collect()} == {r["id"]: r for r in want.collect()}
    plain = text.redact_text(df, "text", full, out="t", terms=index).where("NOT (text <=> t)")
    assert plain.count() == want.join(df.select("id", F.col("text").alias("was")), "id").where("NOT (text <=> was)").count()


def test_join_equals_the_rule(spark, listed, rows, policy):
    terms, _, full = listed
    df = spark.createDataFrame(rows, "id long, text string")
    only = [r for r in redaction_rules(full) if r.category == "private_term"]
    want = {r["id"]: r["t"] for r in df.select("id", redacted(F.col("text"), full, only).alias("t")).collect()}
    got = redact_terms_joined(df, ["id"], "text", terms, policy).collect()
    assert {r["id"]: r["text"] for r in got} == want
    assert {r["id"]: r["n_terms"] for r in got} == {r["id"]: (want[r["id"]] or "").count("[PRIVATE_TERM]") for r in got}


def test_json_with_an_index(spark, listed, rows):
    _, index, full = listed
    raws = [(i, json.dumps({"a": t, "refresh_token": t, "b": [t, {"foo": 1, "bar": t}], "password": {"x": t}}, ensure_ascii=i % 2 == 0))
            for i, t in rows[:200]] + [(990, "foo at smith {"), (991, ""), (992, None), (993, '"foo"'), (994, '{"foo":1,"FOO":2}'), (995, "[NaN, \"foo\"]")]
    df = spark.createDataFrame(raws, "id long, raw string")
    want = redact_json(df, "raw", full, hits="h")
    got = redact_json(df, "raw", full, hits="h", terms=index)
    def rows_of(d):
        return {r["id"]: (r["raw"], sorted((h["category"], h["n"], tuple(h["values"])) for h in r["h"] or [])) for r in d.collect()}
    assert rows_of(got) == rows_of(want)


def test_paths_with_an_index(spark, listed):
    _, index, full = listed
    df = spark.createDataFrame([("foo/--home-canuser-x--/a\\b smith/Ana Smith.jsonl",), (None,), ("",)], "p string")
    assert text.redact_path(df, "p", full, "q", "h", index).collect() == text.redact_path(df, "p", full, "q", "h").collect()
    assert [r["p"] for r in text.redact_path(df, "p", full).collect()] == [r["q"] for r in text.redact_path(df, "p", full, "q", "h").collect()]


def test_many_terms(spark, policy):
    many = spark.range(100_000).select(F.concat(F.lit("name"), F.col("id").cast("string")).alias("term"))
    index = term_index(many, policy)
    assert index.size > 100_000 and len(index.policy.private_terms) < 10
    df = spark.createDataFrame([(1, "name5 name99999, name100000 name77-x xname7 NAME8")], "id long, text string")
    want = "[PRIVATE_TERM] [PRIVATE_TERM], name100000 [PRIVATE_TERM]-x xname7 [PRIVATE_TERM]"
    assert text.redact_text(df, "text", policy, terms=index).head()["text"] == want
    assert redact_terms_joined(df, ["id"], "text", many, policy).head()["text"] == want


def test_lists_beyond_the_limit_are_refused(spark, policy, monkeypatch):
    import palimpsest.operators.term_index as module
    monkeypatch.setattr(module, "MAX_BYTES", 10)
    with pytest.raises(ValueError):
        term_index(spark.createDataFrame([("some long term",)], "term string"), policy)


@pytest.mark.parametrize("few", [200, 0])
def test_discovery_inside_the_job(spark, monkeypatch, few):
    monkeypatch.setattr(job, "FEW_TERMS", few)
    records = spark.createDataFrame([
        ("pi_sessions", "--home-ottilie-voyager--/a.jsonl", 1, '{"text": "Voyager build on seamonkey by Otti Falk"}'),
        ("codex_history", "Nebula/history.jsonl", 1, '{"text": "nebula is no project folder, falk is a name"}')],
        "source string, rel_path string, line_no long, raw string")
    hints = spark.createDataFrame([("host", "seamonkey.lan"), ("full_name", "Otti Falk"), ("alias", "buildbox*")], "kind string, value string")
    owner = Policy("ottilie", "/home/ottilie")
    lines = {r["source"]: r["raw"] for r in job.sanitize(records, owner, hints=hints).records.collect()}
    assert lines["pi_sessions"] == '{"text":"[PRIVATE_TERM] build on [PRIVATE_TERM] by [PRIVATE_TERM]"}'
    assert lines["codex_history"] == '{"text":"nebula is no project folder, [PRIVATE_TERM] is a name"}'
    off = Policy("ottilie", "/home/ottilie", auto_discover=False)
    assert "Voyager" in [r["raw"] for r in job.sanitize(records, off, hints=hints).records.where("source = 'pi_sessions'").collect()][0]
    more = spark.createDataFrame([("nebula",)], "term string")
    assert "nebula" not in job.sanitize(records, off, terms=more).records.where("source = 'codex_history'").head()["raw"]
