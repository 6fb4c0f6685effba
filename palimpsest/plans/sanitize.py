"""The whole way from private logs and tables to a publishable copy."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest import catalog
from palimpsest.functions.paths import path_order
from palimpsest.operators import pseudonyms, secrets, spans, stats, tables
from palimpsest.operators.joins import ranked
from palimpsest.operators.json_records import redact_json, split_malformed
from palimpsest.operators.term_index import TermIndex, term_index
from palimpsest.operators.terms import derive_terms
from palimpsest.operators.text import redact_path
from palimpsest.policy import Policy
from palimpsest.session import materialized, spread
from palimpsest.sources.tree import write_tree

RECORD = ["source", "rel_path", "line_no"]


@dataclass
class Sanitized:
    records: DataFrame       # source, rel_path (redacted), line_no, raw (redacted)
    dictionary: DataFrame    # category, digest, ordinal, ... without clear values
    counts: DataFrame        # category, n
    sources: DataFrame       # source, files, lines, invalid_lines
    tables: DataFrame        # table_name, rows, skipped
    safety: DataFrame        # files_scanned, files_changed
    secret_rounds: list      # one summary per round
    secret_status: str
    model: DataFrame | None = None      # files_scanned, files_changed, strings_changed


def table_records(exported: dict[str, DataFrame], policy: Policy, order: dict[str, list[str]] | None = None) -> DataFrame | None:
    """Allowed tables as records, one JSON object per row.

    Rows are numbered in the order of the columns that ``order`` names for their table, by default of all
    columns from the first on (maps by their JSON text): however the rows are spread, numbers stay.
    """
    names = [t for t in policy.allow_tables if t in exported and t not in policy.deny_tables]
    parts = [_numbered(exported[t], (order or {}).get(t)).select(
        F.lit(catalog.TABLE_SOURCE).alias("source"), F.lit(f"{t}.jsonl").alias("rel_path"), "line_no", "raw") for t in names]
    return reduce(DataFrame.unionByName, parts) if parts else None


def _numbered(table: DataFrame, order: list[str] | None) -> DataFrame:
    """``(line_no, raw)`` of one table."""
    def key(field):
        column = F.col(f"`{field.name}`")
        plain = isinstance(field.dataType, (T.AtomicType, T.NullType)) and not isinstance(field.dataType, T.VariantType)
        return column if plain else F.to_json(F.struct(column))
    fields = [table.schema[c] for c in order] if order else list(table.schema.fields)
    rows = table.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("raw"), F.lit(0).alias("_all"),
                        *[key(f).alias(f"_o{i}") for i, f in enumerate(fields)])
    return ranked(rows, ["_all"], [*(f"_o{i}" for i in range(len(fields))), "raw"], "line_no").select("line_no", "raw")


def reading_order(policy: Policy) -> list[Column]:
    """Sort key of a record's file: sources in their given order, unknown ones after them by name, tables as allowed."""
    names = [s[0] for s in catalog.SOURCES] + [catalog.TABLE_SOURCE]
    place = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("source"))
    tables = F.array(*[F.lit(f"{t}.jsonl") for t in policy.allow_tables])
    is_table = F.col("source") == catalog.TABLE_SOURCE
    return [F.when(place > 0, place).otherwise(len(names) + 1).alias("_source"),
            F.when(place > 0, F.lit("")).otherwise(F.col("source")).alias("_name"),
            F.when(is_table, F.array_position(tables, F.col("rel_path"))).otherwise(0).alias("_table"),
            path_order(F.col("rel_path")).alias("_path")]


def dictionary_of(local: DataFrame, files: DataFrame, policy: Policy) -> DataFrame:
    """Ordinals of all stable values in reading order; a file's path is read before its lines."""
    def keyed(df):
        return df.select(*reading_order(policy), "line_no", "hits")
    order = ["_source", "_name", "_table", "_path", "line_no"]
    values = pseudonyms.stable_values(keyed(local).unionByName(keyed(files.withColumn("line_no", F.lit(0).cast("bigint")))), order)
    return pseudonyms.assign_ordinals(values, [*order, "hit_no", "match_no"], policy.salt)


def sanitize(records: DataFrame, policy: Policy, exported: dict[str, DataFrame] | None = None,
             model_spans: DataFrame | None = None, secret_findings: list[DataFrame] | None = None,
             hints: DataFrame | None = None, terms: DataFrame | None = None,
             table_order: dict[str, list[str]] | None = None) -> Sanitized:
    """Redact records and tables, number the placeholders, apply findings, count.

    The expressions run once: their result is written as a table that the
    dictionary, the counts and the numbering all read.  Private terms are those
    of the policy and of ``terms(term)``; unless ``policy.auto_discover`` is off, also those found
    in ``hints(kind, value)`` and in the folder names of the sessions.
    """
    spark = records.sparkSession
    policy, index = private_terms(records, policy, hints, terms)
    from_tables = table_records(exported or {}, policy, table_order)
    everything = records.select(*RECORD, "raw")
    if from_tables is not None:
        everything = everything.unionByName(from_tables)
    local = materialized(redact_json(split_malformed(everything), "raw", policy, hits="hits", terms=index))
    files = materialized(redact_path(local.select("source", "rel_path").distinct(), "rel_path", policy, "new_path", "hits", index))

    dictionary, numbered, paths = None, local.drop("hits"), files.drop("hits")
    if policy.ordinals:
        dictionary = dictionary_of(local, files, policy)
        numbered = pseudonyms.number_placeholders(numbered, RECORD, "raw", dictionary)
        paths = pseudonyms.number_placeholders(paths, ["source", "rel_path"], "new_path", dictionary)
    table_files = F.col("source") == catalog.TABLE_SOURCE
    result = (numbered.join(paths, ["source", "rel_path"])
              .select("source", F.when(table_files, F.col("rel_path")).otherwise(F.col("new_path")).alias("rel_path"),
                      "line_no", "raw"))
    result = materialized(result)

    model = None
    if model_spans is not None:
        result = materialized(spans.model_pass(result, RECORD, "raw", model_spans, policy))
        per_file = result.groupBy("source", "rel_path").agg(F.sum("strings_changed").alias("n"))
        model = per_file.agg(F.count(F.lit(1)).alias("files_scanned"), F.count(F.when(F.col("n") > 0, 1)).alias("files_changed"),
                             F.coalesce(F.sum("n"), F.lit(0)).alias("strings_changed"))
        result = result.drop("strings_changed")
    again, safety = safety_pass(spread(result), policy, index)     # the joins dealt it by bytes
    rounds, status = [], "skipped"
    if secret_findings is not None:
        again, rounds, status = secrets.apply_secret_rounds(again, secret_findings)
    hits = local.select("hits").unionByName(files.select("hits"))
    counts = (hits.select(F.explode("hits").alias("h")).groupBy(F.col("h.category").alias("category"))
              .agg(F.sum("h.n").alias("n")))
    if model_spans is not None:
        labels = spans.label_totals(spans.merge_spans(spans.valid_spans(model_spans, policy.span_threshold)))
        counts = counts.unionByName(labels.select(F.concat(F.lit("privacy_filter_"), F.lower("label")).alias("category"), "n"))
    table_rows = local.where(table_files).select(F.regexp_replace("rel_path", r"\.jsonl$", "").alias("table_name"))
    available = spark.createDataFrame([(t,) for t in (exported or {})] or [("",)], "table_name string")
    _, skipped = tables.apply_table_policy(available, tables.table_policy(spark, policy))
    return Sanitized(again, dictionary, counts, stats.source_stats(local.where(~table_files)),
                     stats.table_stats(table_rows, skipped), safety, rounds, status, model)


#: Discovered terms up to which the rule stays an alternation, which needs no Python; more go into an index.
FEW_TERMS = 200
#: The source whose top folders name projects.
PATH_SOURCE = "pi_sessions"


def private_terms(records: DataFrame, policy: Policy, hints: DataFrame | None = None,
                  terms: DataFrame | None = None) -> tuple[Policy, TermIndex | None]:
    """The policy with all private terms, or with an index of them where they are many."""
    spark = records.sparkSession
    given = spark.createDataFrame([(t,) for t in policy.private_terms] or [("",)], "term string").where("term <> ''")
    if terms is not None:
        given = given.unionByName(terms.select("term"))
    if policy.auto_discover:
        own = spark.createDataFrame([("user", policy.user), ("home", policy.home_name)], "kind string, value string")
        paths = records.where(F.col("source") == PATH_SOURCE).select("rel_path")
        given = derive_terms(paths, own if hints is None else hints.select("kind", "value").unionByName(own), given)
    elif terms is None:
        return policy, None
    found = materialized(given.where(F.length("term") > 0).select("term").distinct())
    few = found.limit(FEW_TERMS + 1).collect()
    if len(few) > FEW_TERMS:
        return policy, term_index(found, policy)
    return policy.with_terms(sorted((r["term"] for r in few), key=lambda t: (-len(t), t.lower(), t))), None


def safety_pass(records: DataFrame, policy: Policy, index: TermIndex | None = None) -> tuple[DataFrame, DataFrame]:
    """Run the rules over their own output; ``(records, files scanned and changed)``.

    What the second pass writes is digest-only and rare; the counts of the
    first pass stay as they are.
    """
    again = redact_json(records.withColumn("_before", F.col("raw")), "raw", policy, terms=index)
    again = materialized(again)
    per_file = again.groupBy("source", "rel_path").agg(F.bool_or(F.col("raw") != F.col("_before")).alias("changed"))
    stats_row = per_file.agg(F.count(F.lit(1)).alias("files_scanned"), F.count(F.when(F.col("changed"), 1)).alias("files_changed"))
    return again.drop("_before"), stats_row


def build_report(spark: SparkSession, result: Sanitized, policy: Policy, secret_scan: DataFrame | None = None) -> DataFrame:
    """One row ``value``: the report as JSON, itself redacted.

    ``secret_scan`` is the findings table of a last scan of the output, if there was one.
    """
    def rows(df, name, *cols):
        return df.agg(F.sort_array(F.collect_list(F.struct(*cols))).alias(name))
    # Every block is one row; lists have a row per source, table, category or round.
    blocks = [
        rows(result.sources, "sources", "source", "files", "lines", "invalid_lines"),
        rows(result.tables, "tables", "table_name", "rows", "skipped"),
        rows(result.counts, "redaction_counts", "category", "n"),
        result.safety.select(F.struct("*").alias("final_safety_pass"))]
    if result.model is not None:
        blocks.append(result.model.select(F.struct("*").alias("privacy_filter_batch_pass")))
    if result.secret_status != "skipped":
        fix = F.lit(result.secret_status).alias("status")
        if result.secret_rounds:
            each = reduce(DataFrame.unionByName, result.secret_rounds)
            blocks.append(rows(each, "rounds", "round", "findings", "files_changed", "exact_replacements", "records_tombstoned", "by_rule")
                          .select(F.struct(fix, "rounds").alias("gitleaks_fix")))
        else:
            blocks.append(spark.range(1).select(F.struct(fix).alias("gitleaks_fix")))
    if secret_scan is not None:
        blocks.append(secrets.scan_status(secret_scan).select(F.struct("*").alias("gitleaks")))
    if result.dictionary is not None:
        blocks.append(rows(pseudonyms.distinct_counts(result.dictionary), "stable_placeholder_counts", "category", "n"))
    report = reduce(DataFrame.crossJoin, blocks, stats.policy_frame(spark, policy).select(F.struct("*").alias("options")))
    report = report.select(
        F.lit(catalog.EXPORT_FORMAT).alias("format"), "*",
        F.struct(F.array(*[F.lit(t) for t in policy.deny_tables]).alias("opencode_tables"),
                 F.lit(catalog.EXCLUDED_REASON).alias("reason")).alias("excluded"))
    return redact_json(report.select(F.to_json(F.struct("*")).alias("value")), "value", policy)


def build_manifest(result: Sanitized, notes: list[str], policy: Policy | None = None) -> DataFrame:
    """One row ``value``: notes and source counts; redacted if a policy is given."""
    sources = result.sources.agg(F.sort_array(F.collect_list(F.struct(
        "source", "files", "lines", "invalid_lines"))).alias("sources"))
    manifest = sources.select(F.to_json(F.struct(
        F.array(*[F.lit(n) for n in notes]).alias("notes"), "sources")).alias("value"))
    return manifest if policy is None else redact_json(manifest, "value", policy)


def publish(spark: SparkSession, result: Sanitized, policy: Policy, out: str, notes: list[str] | None = None, force: bool = False,
            secret_scan: DataFrame | None = None) -> list[str]:
    """Records as a tree of files with the manifest and the report beside them; returns the paths."""
    return write_tree(result.records, out, force, extra={
        "MANIFEST.json": build_manifest(result, notes or [], policy),
        "REDACTION_REPORT.json": build_report(spark, result, policy, secret_scan)})
