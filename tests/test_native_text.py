"""JSON leaves and review windows in the JVM, against plain Python."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from palimpsest.operators import review
from palimpsest.operators.json_records import json_leaves
from palimpsest.plans.reviewed import review as review_job


def plain_leaves(raw):
    found = []
    def walk(value, path, key):
        if isinstance(value, str):
            found.append((path, key, value))
        elif isinstance(value, list):
            for i, item in enumerate(value):
                walk(item, f"{path}[{i}]", key)
        elif isinstance(value, dict):
            for k, item in value.items():
                walk(item, f"{path}.{k}", k)
    try:
        walk(json.loads(raw), "$", None)
    except ValueError:
        return []
    return found


def _value(rng, depth):
    kind = rng.random()
    if depth == 0 or kind < 0.45:
        return rng.choice(["", "a", 'q"uo\\te', "[{,:}]", "é\n", 1, -2.5, True, None, "x y"])
    if kind < 0.7:
        return [_value(rng, depth - 1) for _ in range(rng.randint(0, 4))]
    return {rng.choice(["a", "b.c", "k[0]", "", "é", 'q"', "last"]) + str(i): _value(rng, depth - 1) for i in range(rng.randint(0, 4))}


def test_leaves_equal_plain_walk(spark):
    rng = random.Random(3)
    raws = [json.dumps(_value(rng, 5), ensure_ascii=i % 2 == 0, indent=[None, 1][i % 3 == 0]) for i in range(400)]
    raws += ['"only"', "3", "[]", "{}", "", " ", "{", '{"a": "b"} tail', "['a']", "[1,]", '{"a":"b",}', "[NaN, \"x\", -Infinity]", "NaN",
             '{"NaN": "Infinity"}', '{"a": NaN, "b": {"c": "d"}}', "[\"a\" \"b\"]", '{"a":["b","c"]', '[["a"],[["b"]],"c"]']
    df = spark.createDataFrame(list(enumerate(raws)) + [(9999, None)], "id int, raw string")
    rows = json_leaves(df, ["id"], "raw")
    got = {}
    for r in rows.orderBy("id", "leaf_no").collect():
        got.setdefault(r["id"], []).append((r["path"], r["key"], r["value"]))
    for i, raw in enumerate(raws):
        assert got.get(i, []) == plain_leaves(raw), raw
    assert "Python" not in rows._jdf.queryExecution().executedPlan().toString()


def test_the_last_of_repeated_keys(spark):
    raw = '{"a": {"x": "1", "y": "2"}, "b": "3", "a": {"x": "4"}, "ab": "5", "b": ["6", {"b": "7", "b": "8"}]}'
    got = json_leaves(spark.createDataFrame([(1, raw)], "id int, raw string"), ["id"], "raw").collect()
    assert sorted((r["path"], r["key"], r["value"]) for r in got) == sorted(plain_leaves(raw))


@pytest.mark.parametrize("max_chars", [10, 60, 700])
def test_windows_equal_plain_search(spark, max_chars):
    rng = random.Random(max_chars)
    patterns = [r"@mail", r"\bhttps?://[^\s]+", r"(?i:\b(serial|bssid)\b)"]
    texts = ["".join(rng.choice(["x ", "é", "日本 ", "@mail", " http://a.b/c ", "Serial ", "📎", "\n", "y" * 50]) for _ in range(rng.randint(0, 120))) for _ in range(60)]
    texts += ["", "nothing", "@mail", "z" * 30_000 + "@mail" + "w" * 30_000, "@mail" * 300]
    df = spark.createDataFrame(list(enumerate(texts)) + [(999, None)], "id int, t string")
    rows = review.review_windows(df, ["id"], "t", patterns, max_chars)
    got = {}
    for r in rows.orderBy("id", "chunk_no").collect():
        got.setdefault(r["id"], []).append(r["chunk"])
    half = max_chars // 2
    for i, t in enumerate(texts):
        want = [t[max(0, m.start() - half):m.end() + half] for m in re.finditer("|".join(f"(?:{p})" for p in patterns), t)]
        assert got.get(i, []) == want
    assert "Python" not in rows._jdf.queryExecution().executedPlan().toString()


def test_documents_are_reviewed_in_windows(spark):
    pad = "filler text " * 2000
    records = spark.createDataFrame([("notes/a.txt", 1, pad + "the client is Mira Holm here" + pad), ("b.jsonl", 1, '{"t":"client Mira Holm"}'),
                                     ("c.json", 1, '{"t": "client Mira Holm"}')], "rel_path string, line_no long, raw string")
    seen = []
    def find(chunks):
        seen.extend(r["chunk"] for r in chunks.collect())
        return chunks.where(F.contains("chunk", F.lit("Mira Holm"))).select(
            F.monotonically_increasing_id().alias("finding_no"), "chunk_id", "rel_path", F.lit("Mira Holm").alias("text"), F.lit("person").alias("category"))
    out, summary = review_job(records, find, max_chars=400)
    assert len(seen) == 3 and max(map(len, seen)) == 406
    assert {r["rel_path"]: r["raw"].count("[LLM_PII:PERSON]") for r in out.collect()} == {"notes/a.txt": 1, "b.jsonl": 1, "c.json": 1}
    assert summary.head()["files_changed"] == 3
    kept, dry = review_job(records, find, max_chars=400, dry_run=True)
    assert {tuple(r) for r in kept.collect()} == {tuple(r) for r in records.collect()}
    assert dry.head().asDict() == {"chunks_reviewed": 3, "files_with_findings": 3, "files_changed": 0, "replacements": 3, "dry_run": True}
