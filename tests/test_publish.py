"""Trees of files in and out, reading order, and what the report says."""

import json

import pytest
from pyspark.sql import functions as F

from palimpsest import catalog
from palimpsest.operators import spans
from palimpsest.plans import sanitize as job
from palimpsest.policy import Policy
from palimpsest.sources.logs import read_event_logs
from palimpsest.sources.tree import laid_out, write_tree

OWNER = Policy("ottilie", "/home/ottilie", auto_discover=False)


@pytest.fixture(scope="module")
def records(spark):
    rows = [("codex_sessions", "2031/a b%41+ü.jsonl", i + 1, f'{{"n":{i}}}' if i % 5 else "") for i in range(500)]
    rows += [("codex_sessions", "x" * 200 + "/" + "y" * 200 + ".jsonl", 1, "long name"), ("codex_history", "history.jsonl", 1, "one"),
             ("opencode", "session.jsonl", 1, '{"id":"s"}'), ("other", "../up/./b.jsonl", 1, "é\t"), ("other", "empty.jsonl", 1, None)]
    return spark.createDataFrame(rows, "source string, rel_path string, line_no long, raw string").repartition(7)


def tree(folder):
    return {str(p.relative_to(folder)): p.read_text(encoding="utf-8") for p in folder.rglob("*") if p.is_file() and not p.name.startswith(".")}


def test_tree_is_the_input(spark, records, tmp_path):
    out = tmp_path / "public"
    paths = write_tree(records, str(out), extra={"MANIFEST.json": spark.range(1).select(F.lit("{}").alias("value"))})
    got = tree(out)
    assert sorted(got) == paths and "codex/sessions/2031/a b%41+ü.jsonl" in paths and "other/_/up/_/b.jsonl" in paths
    assert got["codex/sessions/2031/a b%41+ü.jsonl"] == "".join((f'{{"n":{i}}}' if i % 5 else "") + "\n" for i in range(500))
    assert got["codex/history.jsonl"] == "one\n" and got["other/_/up/_/b.jsonl"] == "é\t\n" and got["MANIFEST.json"] == "{}\n"
    assert got["other/empty.jsonl"] == "\n" and sorted(p.name for p in tmp_path.iterdir()) == ["public"]
    with pytest.raises(FileExistsError):
        write_tree(records, str(out))
    write_tree(records.where("source = 'opencode'"), str(out), force=True)
    assert list(tree(out)) == ["opencode/session.jsonl"]


def test_large_files_become_ranges(records, tmp_path):
    write_tree(records.where("source = 'codex_sessions'"), str(tmp_path / "o"), max_bytes=1000)
    got = tree(tmp_path / "o")
    parts = sorted(p for p in got if "a b" in p)
    assert len(parts) > 3 and all(p.endswith(".jsonl") and len(got[p]) < 1500 for p in parts)
    assert "".join(got[p] for p in parts) == "".join((f'{{"n":{i}}}' if i % 5 else "") + "\n" for i in range(500))
    assert laid_out(records.where("false")).count() == 0


def test_a_failure_leaves_nothing(records, tmp_path):
    write_tree(records.where("source = 'other'"), str(tmp_path / "o"))
    before = tree(tmp_path / "o")
    broken = records.withColumn("raw", F.when(F.col("line_no") < 400, F.col("raw")).otherwise(F.raise_error(F.lit("lost"))))
    with pytest.raises(Exception, match="lost"):
        write_tree(broken, str(tmp_path / "o"), force=True)
    assert tree(tmp_path / "o") == before and [p.name for p in tmp_path.iterdir()] == ["o"]


def test_written_trees_read_back(spark, records, tmp_path):
    write_tree(records.where("source = 'codex_sessions'"), str(tmp_path / "o"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        back = {(r["rel_path"], r["line_no"]): r["raw"] for r in read_event_logs(spark, str(tmp_path / "o/codex/sessions")).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert back == {(r["rel_path"], r["line_no"]): r["raw"] for r in records.where("source = 'codex_sessions'").collect()}


def test_ordinals_do_not_depend_on_partitions(spark):
    session = spark.range(300).select(F.col("id"), F.concat(F.lit("m"), F.pmod(F.xxhash64("id"), F.lit(90)).cast("string"), F.lit("@mail.example")).alias("title"),
                                      F.create_map(F.lit("k"), F.col("id")).alias("extra"))
    message = spark.range(50).select(F.concat(F.lit("m"), F.col("id").cast("string"), F.lit("@mail.example")).alias("id"))
    logs = spark.createDataFrame([(s, "f.jsonl", i, f"from a{i}@{s.replace(chr(95), chr(45))}.example") for s in ("zebra", "ape", "codex_history") for i in range(1, 40)],
                                 "source string, rel_path string, line_no long, raw string")
    found = []
    for n in (1, 5):
        result = job.sanitize(logs.repartition(n, "raw"), OWNER, {"session": session.repartition(n, F.rand(n)), "message": message.repartition(n, F.rand(n))})
        rows = {(r["source"], r["rel_path"], r["line_no"]): r["raw"] for r in result.records.collect()}
        found.append((rows, {(r["category"], r["digest"]): r["ordinal"] for r in result.dictionary.collect()}))
    assert found[0] == found[1]
    first = min(r["id"] for r in session.select("id").collect())
    place = [s[0] for s in catalog.SOURCES].index("codex_history")
    assert place >= 0 and "[EMAIL:0001:" in found[0][0]["codex_history", "f.jsonl", 1] and first == 0
    # tables after the known logs, as allowed; unknown sources last, by name
    tables = [t for t in OWNER.allow_tables if t in ("session", "message")]
    assert "[EMAIL:0040:" in found[0][0]["opencode", f"{tables[0]}.jsonl", 1]
    number = lambda s: int(found[0][0][s, "f.jsonl", 1].split(":")[1])
    assert number("ape") + 39 == number("zebra")


def test_report_has_all_blocks(spark, tmp_path):
    text = "my name is Ada Byron, born here"
    logs = spark.createDataFrame([("codex_history", "history.jsonl", 1, json.dumps({"t": text, "type": "x"})), ("codex_history", "history.jsonl", 2, '{"k":"hush-hush-1"}')],
                                 "source string, rel_path string, line_no long, raw string")
    found = spark.createDataFrame([(0, 11, 20, "person", 0.9)], "span_no int, start int, end int, label string, score double").select(
        spans.text_id(F.lit(text)).alias("text_id"), "span_no", "start", "end", "label", "score")
    secret = spark.createDataFrame([(1, "history.jsonl", 2, "made-up", "hush-hush-1"), (2, "history.jsonl", 1, "other", "nowhere")],
                                   "finding_no long, rel_path string, line_no long, rule string, secret string")
    result = job.sanitize(logs, OWNER, model_spans=found, secret_findings=[secret, secret.limit(0)])
    paths = job.publish(spark, result, OWNER, str(tmp_path / "o"), ["made by ottilie@box"], secret_scan=secret.limit(0))
    assert paths == ["MANIFEST.json", "REDACTION_REPORT.json", "codex/history.jsonl"]
    report = json.loads((tmp_path / "o/REDACTION_REPORT.json").read_text())
    assert report["privacy_filter_batch_pass"] == {"files_scanned": 1, "files_changed": 1, "strings_changed": 1}
    assert {"category": "privacy_filter_person", "n": 1} in report["redaction_counts"]
    assert report["gitleaks_fix"]["status"] == "clean" and report["gitleaks_fix"]["rounds"][0]["records_tombstoned"] == 1
    assert report["gitleaks"] == {"status": "clean", "findings": 0}
    assert json.loads((tmp_path / "o/MANIFEST.json").read_text())["notes"] == ["made by [PII:USER_AT_HOST]"]
    assert (tmp_path / "o/codex/history.jsonl").read_text().splitlines()[1] == '{"k":"[SECRET:GITLEAKS_MADE_UP]"}'
