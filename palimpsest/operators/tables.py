"""Which tables are exported, and how: one JSON object per row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.operators.frames import redact_frame
from palimpsest.policy import Policy


def table_policy(spark: SparkSession, policy: Policy) -> DataFrame:
    """``table_policy(table_name, decision, position)``."""
    rows = [(t, "allow", i) for i, t in enumerate(policy.allow_tables)]
    rows += [(t, "deny", None) for t in policy.deny_tables]
    return spark.createDataFrame(rows, "table_name string, decision string, position int")


def apply_table_policy(available: DataFrame, decisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(keep, skipped)``: allowed tables that exist, and allowed ones that do not."""
    allowed = decisions.where(F.col("decision") == "allow").join(
        decisions.where(F.col("decision") == "deny"), "table_name", "left_anti")
    keep = available.select("table_name").distinct().join(F.broadcast(allowed.select("table_name")), "table_name", "left_semi")
    skipped = allowed.select("table_name").join(available.select("table_name"), "table_name", "left_anti")
    return keep, skipped


def export_tables(tables: dict[str, DataFrame], policy: Policy) -> DataFrame:
    """``(table_name, json)``: the allowed tables, redacted; others are never read."""
    names = [t for t in policy.allow_tables if t in tables and t not in policy.deny_tables]
    if not names:
        raise ValueError("none of the tables is on the allow-list")
    parts = [redact_frame(tables[t], policy).select(
        F.lit(t).alias("table_name"),
        F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("json")) for t in names]
    return reduce(DataFrame.unionByName, parts)
