"""Redact, count and list sensitive values in a text column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.functions.expr import fresh
from palimpsest.functions.paths import clean_component, redacted_path, redacted_path_with_hits
from palimpsest.functions.redact import HITS_TYPE, raw_hits, redacted, redacted_with_hits
from palimpsest.functions.rules import redaction_rules
from palimpsest.operators.term_index import TermIndex, redact_strings
from palimpsest.policy import Policy


def redact_text(df: DataFrame, col: str, policy: Policy, out: str | None = None,
                hits: str | None = None, terms: TermIndex | None = None) -> DataFrame:
    """Rewrite a text column; ``hits`` names a column for what was found.

    Row-local: works on streams as well.  Placeholders carry no corpus
    ordinal yet, see ``operators.pseudonyms``.  ``terms`` takes the place of
    the rule for private terms, for lists of any length.
    """
    out = out or col
    if terms is not None:
        return _with_terms(df, col, out, hits, terms)
    if hits is None:
        return df.withColumn(out, redacted(F.col(col), policy))
    found = fresh(df, "_found")
    return (df.withColumn(found, redacted_with_hits(F.col(col), policy))
            .withColumn(out, F.col(f"{found}.text")).withColumn(hits, F.col(f"{found}.hits")).drop(found))


def _with_terms(df: DataFrame, col: str, out: str, hits: str | None, index: TermIndex) -> DataFrame:
    found = fresh(df, "_found")
    df = redact_strings(df, F.when(F.col(col).isNotNull(), F.array(col)), found, index)
    first = F.col(found)[0]
    if hits is not None:
        df = df.withColumn(hits, F.coalesce(first["hits"], F.array().cast(HITS_TYPE)))
    return df.withColumn(out, first["text"]).drop(found)


def redact_path(df: DataFrame, col: str, policy: Policy, out: str | None = None, hits: str | None = None,
                terms: TermIndex | None = None) -> DataFrame:
    """Every component is redacted as a text of its own."""
    if terms is None and hits is None:
        return df.withColumn(out or col, redacted_path(F.col(col), policy))
    found = fresh(df, "_found")
    if terms is None:
        df = df.withColumn(found, redacted_path_with_hits(F.col(col), policy))
    else:
        df = redact_strings(df, F.split(col, "/"), found, terms)
        df = df.withColumn(found, F.when(F.col(found).isNotNull(), F.struct(
            F.array_join(F.transform(found, lambda x: clean_component(x["text"])), "/").alias("text"),
            F.flatten(F.transform(found, lambda x: x["hits"])).alias("hits"))))
    if hits is not None:
        df = df.withColumn(hits, F.col(f"{found}.hits"))
    return df.withColumn(out or col, F.col(f"{found}.text")).drop(found)


def detect(df: DataFrame, ids: list[str], col: str, policy: Policy) -> DataFrame:
    """``(ids, category, n)``: hits per rule on the text as that rule sees it."""
    return (df.select(*ids, F.explode(redacted_with_hits(F.col(col), policy)["hits"]).alias("h"))
            .select(*ids, "h.category", "h.n"))


def matches(df: DataFrame, ids: list[str], col: str, policy: Policy,
            categories: list[str] | None = None) -> DataFrame:
    """``(ids, category, pos, value)``: each rule on the raw text, in text order."""
    rules = [r for r in redaction_rules(policy) if categories is None or r.category in categories]
    return (df.select(*ids, F.explode(raw_hits(F.col(col), rules)).alias("h"))
            .select(*ids, "h.category", "h.pos", "h.value"))


def category_counts(hits: DataFrame) -> DataFrame:
    return hits.groupBy("category").agg(F.sum("n").alias("n"))


def changed_rows(df: DataFrame, col: str, policy: Policy, ids: list[str]) -> DataFrame:
    """Second pass over redacted text: the rows the rules would still change."""
    again = df.select(*ids, F.col(col).alias("before"), redacted(F.col(col), policy).alias("after"))
    return again.where(~F.col("before").eqNullSafe(F.col("after")))
