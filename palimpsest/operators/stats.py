"""Report roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.functions.fields import is_sensitive_key, normalize_key
from palimpsest.policy import Policy


def source_stats(records: DataFrame) -> DataFrame:
    """Files, lines and malformed lines per source; blank lines count as lines."""
    # Per file first: one source may hold most of the rows.
    per_file = records.groupBy("source", "rel_path").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum((~F.col("is_valid") & ~F.col("is_blank")).cast("bigint")).alias("invalid_lines"))
    return per_file.groupBy("source").agg(
        F.count(F.lit(1)).alias("files"), F.sum("lines").alias("lines"), F.sum("invalid_lines").alias("invalid_lines"))


def table_stats(exports: DataFrame, skipped: DataFrame) -> DataFrame:
    """``(table_name, rows, skipped)``."""
    rows = exports.groupBy("table_name").agg(F.count(F.lit(1)).alias("rows")).withColumn("skipped", F.lit(False))
    return rows.unionByName(skipped.select("table_name", F.lit(0).cast("bigint").alias("rows"), F.lit(True).alias("skipped")))


def field_counts(leaves: DataFrame, policy: Policy | None = None) -> DataFrame:
    """Rows per sensitive key, in normal form; distinct keys are judged once."""
    counted = leaves.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(is_sensitive_key(F.col("key"), policy)).groupBy(
        normalize_key(F.col("key")).alias("key")).agg(F.sum("n").alias("n"))


def pass_stats(before: DataFrame, after: DataFrame, key: list[str], col: str) -> DataFrame:
    """One row: files scanned and files a pass changed."""
    both = before.select("rel_path", *[k for k in key if k != "rel_path"], F.col(col).alias("_old")).join(
        after.select("rel_path", *[k for k in key if k != "rel_path"], F.col(col).alias("_new")), ["rel_path", *[k for k in key if k != "rel_path"]])
    per_file = both.groupBy("rel_path").agg(F.bool_or(~F.col("_old").eqNullSafe(F.col("_new"))).alias("changed"))
    return per_file.agg(F.count(F.lit(1)).alias("files_scanned"), F.count(F.when(F.col("changed"), 1)).alias("files_changed"))


def policy_frame(spark: SparkSession, policy: Policy) -> DataFrame:
    """One row with the options of a run."""
    o = policy.options
    row = (bool(o.get("privacy_filter", False)), policy.span_threshold, policy.span_max_chars, policy.selective,
           bool(o.get("gitleaks", False)), bool(o.get("gitleaks_fix", False)), policy.auto_discover,
           policy.allow_public_urls, sorted(policy.allowed_domains))
    return spark.createDataFrame([row], (
        "privacy_filter boolean, privacy_filter_threshold double, privacy_filter_max_chars int, "
        "privacy_filter_selective boolean, gitleaks boolean, gitleaks_fix boolean, auto_discover boolean, "
        "allow_public_urls boolean, allow_domains array<string>"))
