"""Findings of an outside secret scanner: exact replacement and tombstones."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.functions.expr import count_literal, json_quote, let
from palimpsest.functions.json_text import is_json
from palimpsest.operators.literals import literal_hits
from palimpsest.session import checkpointed

RECORD = ["rel_path", "line_no"]
#: Hits of findings that hang on one another, up to which one task solves a file.
FOLD_HITS = 1_000_000


def secret_placeholder(rule: Column) -> Column:
    """``[SECRET:GITLEAKS_<RULE>]``, the rule in upper case with ``_`` for anything but letters and digits."""
    return F.concat(F.lit("[SECRET:GITLEAKS_"), F.regexp_replace(F.upper(rule), r"[^\p{L}\p{N}]", "_"), F.lit("]"))


def scope_findings(findings: DataFrame, records: DataFrame) -> DataFrame:
    """Findings whose file exists among the records."""
    files = records.select("rel_path").distinct()
    return findings.join(files, "rel_path", "left_semi")


def _applied(raw: Column, hits: Column) -> Column:
    """``struct<text, counts>``: every finding in turn on the text the earlier ones left."""
    start = F.struct(raw.alias("text"), F.array().cast("array<struct<no:bigint,n:bigint>>").alias("counts"))
    def step(acc, f):
        return let(count_literal(acc["text"], f["literal"]), lambda n: F.when(n == 0, acc).otherwise(F.struct(
            F.replace(acc["text"], f["literal"], f["placeholder"]).alias("text"),
            F.concat(acc["counts"], F.array(F.struct(f["no"].alias("no"), n.alias("n")))).alias("counts"))))
    return F.aggregate(hits, start, step)


def apply_secret_findings(records: DataFrame, findings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One round: ``(records, outcomes)``.

    Findings are applied in the order of ``finding_no``.  A finding that
    changes nothing in a ``.jsonl`` file turns the record at its line into a
    tombstone, so later findings do not see that record any more.
    ``outcomes(finding_no, rel_path, line_no, rule, replacements, tombstoned)``.
    """
    rule = F.coalesce(F.when(F.col("rule") != "", F.col("rule")), F.lit("secret"))
    scoped = checkpointed(scope_findings(findings, records).select(
        F.col("finding_no").cast("bigint").alias("finding_no"), "rel_path",
        F.col("line_no").cast("bigint").alias("line_no"), rule.alias("rule"), "secret"))
    literals = scoped.where(F.length("secret") > 0).select(
        "rel_path", F.col("finding_no").alias("no"), F.col("secret").alias("literal"),
        secret_placeholder(F.col("rule")).alias("placeholder"))
    hits = checkpointed(literal_hits(records, RECORD, literals, F.array("raw")).withColumn(
        "literals", F.sort_array("literals")))
    touched = records.select(*RECORD, "raw").join(hits, RECORD)
    counts = checkpointed(touched.select(
        *RECORD, F.explode(_applied(F.col("raw"), F.col("literals"))["counts"]).alias("c"))
        .select(*RECORD, "c.no", "c.n"))
    tombs = _tombstones(scoped, counts, records)
    outcomes = _outcomes(scoped, counts, tombs)
    return _rewritten(records, hits, tombs), outcomes


def _tombstones(findings: DataFrame, counts: DataFrame, records: DataFrame) -> DataFrame:
    """``(rel_path, line_no, no, rule)``: findings that end up as tombstones.

    A finding fails if every record it could change was a tombstone before its
    turn.  One whose secret is in its own record can only fail after that record
    became a tombstone, so the first tombstone of every record comes from a
    *stray*: a finding whose own record does not hold its secret.
    """
    lines = records.where(F.endswith("rel_path", F.lit(".jsonl"))).select(*RECORD)
    placed = findings.join(lines, RECORD, "left_semi").select(*RECORD, F.col("finding_no").alias("no"), "rule")
    key = [*RECORD, "no"]
    strays = checkpointed(placed.select(*key).join(counts.select(*key), key, "left_anti"))
    first = _first_tombs(strays, counts.select(*key))
    return checkpointed(placed.join(_alive(counts, first).select("no").distinct(), "no", "left_anti"))


def _alive(hits: DataFrame, first: DataFrame) -> DataFrame:
    """The hits that come before the first tombstone ``(rel_path, line_no, _tomb)`` of their record, or are it."""
    return hits.join(first, RECORD, "left").where(F.col("_tomb").isNull() | (F.col("no") <= F.col("_tomb"))).drop("_tomb")


def _first_tombs(strays: DataFrame, hits: DataFrame) -> DataFrame:
    """``(rel_path, line_no, _tomb)``: the first failing finding placed at each record.

    Strays without a hit fail, strays that hit a record without an earlier stray
    do not; both are found by joins.  The others hang on one another, in the
    order of their numbers and within one file: files of up to ``FOLD_HITS`` such
    hits are each solved in one ordered pass, larger ones by repeated joins.
    """
    def firsts(rows):
        return rows.groupBy(*RECORD).agg(F.min("no").alias("_tomb"))

    hits = checkpointed(hits.join(strays.select("no"), "no", "left_semi").select(*RECORD, "no"))
    lost = strays.join(hits.select("no").distinct(), "no", "left_anti")
    earlier = hits.join(firsts(strays), RECORD, "left")
    safe = earlier.where(F.col("_tomb").isNull() | (F.col("_tomb") >= F.col("no"))).select("no").distinct()
    open_hits = checkpointed(hits.join(safe, "no", "left_anti"))
    if open_hits.isEmpty():
        return checkpointed(firsts(lost))
    lost = checkpointed(lost)
    large = checkpointed(open_hits.groupBy("rel_path").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > FOLD_HITS).select("rel_path"))
    small = open_hits.join(large, "rel_path", "left_anti")
    known = firsts(lost).join(small.select(*RECORD).distinct(), RECORD, "left_semi")
    placed = strays.select("rel_path", F.col("line_no").alias("at"), "no")
    rows = small.join(placed, ["rel_path", "no"]).select(*RECORD, "no", "at").unionByName(
        known.select(*RECORD, F.col("_tomb").alias("no"), F.lit(None).cast("bigint").alias("at")))
    failed = rows.groupBy("rel_path").applyInPandas(_ordered_pass, "rel_path string, line_no bigint, no bigint")
    failed = checkpointed(failed.unionByName(lost))
    if not large.isEmpty():
        rest = checkpointed(open_hits.join(large, "rel_path", "left_semi"))
        failed = checkpointed(failed.unionByName(_closure(strays, rest, lost)))
    return checkpointed(firsts(failed))


def _ordered_pass(file: pd.DataFrame) -> pd.DataFrame:
    """The failing strays of one file, from (rel_path, line_no hit, no, at); rows without ``at`` are known tombstones."""
    known = file[file["at"].isna()]
    first = dict(zip(known["line_no"].tolist(), known["no"].tolist(), strict=True))
    failed = []
    for no, own in file[file["at"].notna()].groupby("no", sort=True):
        if all(first.get(line, no) < no for line in own["line_no"].tolist()):
            at = int(own["at"].iloc[0])
            failed.append((file["rel_path"].iloc[0], at, no))
            first[at] = min(first.get(at, no), no)
    return pd.DataFrame(failed, columns=["rel_path", "line_no", "no"])


def _closure(strays: DataFrame, hits: DataFrame, lost: DataFrame) -> DataFrame:
    """What :func:`_ordered_pass` finds, by as many joins as the longest chain has links."""
    failed, size = None, -1
    asked = strays.join(hits.select("no").distinct(), "no", "left_semi")
    while True:
        tombs = lost if failed is None else lost.unionByName(failed)
        alive = _alive(hits, tombs.groupBy(*RECORD).agg(F.min("no").alias("_tomb")))
        failed = checkpointed(asked.join(alive.select("no").distinct(), "no", "left_anti").select(*RECORD, "no"))
        now = failed.count()
        if now == size or now == 0:
            return failed
        size = now


def _outcomes(findings: DataFrame, counts: DataFrame, tombs: DataFrame) -> DataFrame:
    done = _alive(counts, tombs.groupBy(*RECORD).agg(F.min("no").alias("_tomb"))).groupBy(F.col("no").alias("finding_no")).agg(F.sum("n").alias("_n"))
    fell = tombs.select(F.col("no").alias("finding_no"), F.lit(True).alias("_fell"))
    return (findings.join(done, "finding_no", "left").join(fell, "finding_no", "left")
            .select("finding_no", "rel_path", "line_no", "rule",
                    F.coalesce("_n", F.lit(0)).alias("replacements"),
                    F.coalesce("_fell", F.lit(False)).alias("tombstoned")))


def tombstone_text(raw: Column, rule: Column) -> Column:
    """The record that takes the place of one whose secret could not be cut out; its type stays."""
    value = F.when(is_json(raw), F.try_parse_json(raw))
    kind = F.to_json(F.try_variant_get(value, "$.type", "variant"))
    return F.concat(F.lit('{"type":'), F.coalesce(kind, F.lit('"redacted_record"')),
                    F.lit(',"redacted":true,"redaction_reason":'),
                    json_quote(F.concat(F.lit("gitleaks_"), rule)), F.lit("}"))


def tombstone(records: DataFrame, findings: DataFrame) -> DataFrame:
    """Replace the records that ``findings(rel_path, line_no, rule)`` point at."""
    last = findings.groupBy(*RECORD).agg(F.max_by("rule", "finding_no").alias("_rule"))
    return (records.join(last, RECORD, "left")
            .withColumn("raw", F.when(F.col("_rule").isNull(), F.col("raw")).otherwise(
                tombstone_text(F.col("raw"), F.col("_rule")))).drop("_rule"))


def _rewritten(records: DataFrame, hits: DataFrame, tombs: DataFrame) -> DataFrame:
    last = tombs.groupBy(*RECORD).agg(F.min("no").alias("_first"), F.max_by("rule", "no").alias("_rule"))
    joined = records.join(hits, RECORD, "left").join(last, RECORD, "left")
    # The type of a tombstone is read after the findings that came before it.
    usable = F.when(F.col("_first").isNull(), F.col("literals")).otherwise(
        F.filter("literals", lambda f: f["no"] < F.col("_first")))
    text = F.when(F.col("literals").isNull(), F.col("raw")).otherwise(_applied(F.col("raw"), usable)["text"])
    return (joined.withColumn("_text", text)
            .withColumn("raw", F.when(F.col("_first").isNull(), F.col("_text")).otherwise(
                tombstone_text(F.col("_text"), F.col("_rule"))))
            .select(*records.columns))


def findings_summary(outcomes: DataFrame) -> DataFrame:
    """One row: findings, changed files, replacements, tombstones and ``by_rule``."""
    hits = F.col("replacements") + F.col("tombstoned").cast("bigint")
    per_rule = outcomes.groupBy("rule").agg(
        F.count(F.lit(1)).alias("findings"), F.sum("replacements").alias("replacements"),
        F.sum(F.col("tombstoned").cast("bigint")).alias("tombstones"), F.sum(hits).alias("hits"))
    files = outcomes.where(hits > 0).select("rel_path").distinct().agg(F.count(F.lit(1)).alias("files_changed"))
    total = per_rule.agg(
        F.coalesce(F.sum("findings"), F.lit(0)).alias("findings"),
        F.coalesce(F.sum("replacements"), F.lit(0)).alias("exact_replacements"),
        F.coalesce(F.sum("tombstones"), F.lit(0)).alias("records_tombstoned"),
        F.sort_array(F.collect_list(F.when(F.col("hits") > 0, F.struct("rule", "hits")))).alias("by_rule"))
    return total.crossJoin(files).select(
        "findings", "files_changed", "exact_replacements", "records_tombstoned", "by_rule")


def summary_by_rule(outcomes: DataFrame) -> DataFrame:
    hits = F.col("replacements") + F.col("tombstoned").cast("bigint")
    return outcomes.groupBy("rule").agg(
        F.count(F.lit(1)).alias("findings"), F.sum("replacements").alias("replacements"),
        F.sum(F.col("tombstoned").cast("bigint")).alias("tombstones"), F.sum(hits).alias("hits"))


def apply_secret_rounds(records: DataFrame, rounds: list[DataFrame]):
    """Apply all given findings tables; ``(records, summaries, status)``.

    Each round is one more scan of the result.  An empty table means clean.
    """
    summaries, status = [], "max_rounds_reached"
    for number, findings in enumerate(rounds, 1):
        if findings.isEmpty():
            status = "clean"
            break
        records, outcomes = apply_secret_findings(records, findings)
        records = checkpointed(records)
        summaries.append(findings_summary(outcomes).withColumn("round", F.lit(number)))
    return records, summaries, status


def scan_status(findings: DataFrame) -> DataFrame:
    """One row: ``clean`` or ``findings_or_error`` and the number of findings."""
    n = F.count(F.lit(1))
    return findings.agg(F.when(n == 0, "clean").otherwise("findings_or_error").alias("status"), n.alias("findings"))
