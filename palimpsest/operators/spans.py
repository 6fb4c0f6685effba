"""Spans found by an outside detector: pick texts, merge spans, rewrite."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from palimpsest import catalog
from palimpsest.functions.dialect import java_regex
from palimpsest.functions.expr import overlapping
from palimpsest.operators.joins import lookup
from palimpsest.operators.json_records import json_values, map_json_strings
from palimpsest.policy import Policy
from palimpsest.session import materialized


#: Characters that neighbouring pieces of a long text share.
SPAN_OVERLAP = 200


def text_id(text: Column) -> Column:
    """Equal texts share one id, so each is reviewed once."""
    return F.sha2(text, 256)


def is_candidate(text: Column, selective: bool) -> Column:
    given = F.length(text) > 0
    return given & text.rlike(java_regex(catalog.CUE_PATTERN)) if selective else given


def select_candidates(df: DataFrame, col: str, selective: bool = True) -> DataFrame:
    """Rows worth showing to a detector: not empty, with a cue word.  Of any length; see :func:`detector_pieces`."""
    return df.where(is_candidate(F.col(col), selective))


def distinct_candidates(df: DataFrame, col: str, selective: bool = True) -> DataFrame:
    """``(text_id, text)``: every candidate text once."""
    picked = select_candidates(df, col, selective).select(F.col(col).alias("text"))
    # Grouping on the digest keeps the shuffled key short and of even length.
    return picked.groupBy(text_id(F.col("text")).alias("text_id")).agg(F.first("text").alias("text"))


def detector_pieces(candidates: DataFrame, max_chars: int = catalog.SPAN_MAX_CHARS, overlap: int = SPAN_OVERLAP) -> DataFrame:
    """``(text_id, offset, text)``: whole texts in overlapping pieces that a detector can take."""
    pieces = candidates.select("text_id", F.explode(overlapping(F.col("text"), max_chars, overlap)).alias("p"))
    return pieces.select("text_id", "p.offset", F.col("p.piece").alias("text"))


def spans_of_pieces(spans: DataFrame) -> DataFrame:
    """Spans of pieces, which carry the piece's ``offset``, as spans of whole texts; repeats in overlaps are merged later."""
    return spans.withColumn("start", F.col("start") + F.col("offset")).withColumn("end", F.col("end") + F.col("offset")).drop("offset")


def valid_spans(spans: DataFrame, threshold: float = catalog.SPAN_THRESHOLD) -> DataFrame:
    """Drop weak, empty, inverted and incomplete spans; labels in upper case, ``PII`` by default."""
    label = F.upper(F.when(F.col("label") != "", F.col("label")))
    return (spans.where(F.col("start").isNotNull() & F.col("end").isNotNull()
                        & (F.coalesce("score", F.lit(0.0)) >= threshold) & (F.col("start") < F.col("end")))
            .withColumn("label", F.coalesce(label, F.lit("PII"))))


def merge_spans(spans: DataFrame, key: str = "text_id") -> DataFrame:
    """Join touching and overlapping spans; the label of the first one stays.

    Spans with one start are reduced before the shuffle, so a text's group is
    bounded by its length however many spans were reported for it.
    """
    at_start = spans.groupBy(key, "start").agg(
        F.max("end").alias("end"), F.min(F.struct("end", "span_no", "label")).alias("first"))
    order = W.partitionBy(key).orderBy("start")
    reach = F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1))
    island = F.sum(F.when(F.col("start") <= F.col("_reach"), 0).otherwise(1)).over(
        order.rowsBetween(W.unboundedPreceding, 0))
    return (at_start.withColumn("_reach", reach).withColumn("_island", island)
            .groupBy(key, "_island")
            .agg(F.min("start").alias("start"), F.max("end").alias("end"),
                 F.min_by(F.col("first.label"), "start").alias("label"))
            .drop("_island"))


def with_spans_replaced(text: Column, spans: Column) -> Column:
    """``spans``: sorted, disjoint ``array<struct<start,end,label>>``, 0-based code points."""
    def piece(s, i):
        since = F.when(i == 0, 0).otherwise(F.get(spans, i - 1)["end"])
        return F.concat(F.substring(text, since + 1, s["start"] - since),
                        F.lit("[PII_MODEL:"), s["label"], F.lit("]"))
    tail = F.substring(text, F.element_at(spans, -1)["end"] + 1, F.length(text))
    return F.concat(F.array_join(F.transform(spans, piece), ""), tail)


def apply_spans(texts: DataFrame, merged: DataFrame, col: str = "text", key: str = "text_id",
                out: str = "redacted") -> DataFrame:
    """Texts with their merged spans replaced by ``[PII_MODEL:LABEL]``."""
    per_text = merged.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("start", "end", "label"))).alias("_spans"))
    return (texts.join(per_text, key, "left")
            .withColumn(out, F.when(F.col("_spans").isNull(), F.col(col)).otherwise(
                with_spans_replaced(F.col(col), F.col("_spans"))))
            .drop("_spans"))


def span_mapping(candidates: DataFrame, spans: DataFrame, threshold: float = catalog.SPAN_THRESHOLD) -> DataFrame:
    """``mapping(old, new)`` of the candidate texts that spans change."""
    rewritten = apply_spans(candidates, merge_spans(valid_spans(spans, threshold)))
    return rewritten.where(F.col("text") != F.col("redacted")).select(
        F.col("text").alias("old"), F.col("redacted").alias("new"))


def model_pass(records: DataFrame, ids: list[str], col: str, spans: DataFrame, policy: Policy) -> DataFrame:
    """Apply a detector's spans to the string values (not the keys) of JSON records.

    Malformed lines count as one text.  Every supplied span is applied, also to
    long texts and those without a cue word.  Only strings with spans travel;
    they are looked up by digest and put back by record and position.
    """
    values = json_values(records.select(*ids, F.col(col).alias("_raw")), "_raw", "_values")
    leaves = values.select(*ids, F.explode(F.filter("_values", lambda x: is_candidate(x["text"], False))).alias("s")).select(
        *ids, "s.at", "s.text", text_id(F.col("s.text")).alias("text_id"))
    leaves = leaves.join(spans.select("text_id").distinct(), "text_id", "left_semi")
    leaves = materialized(leaves)      # read three times below
    candidates = leaves.groupBy("text_id").agg(F.first("text").alias("text"))
    mapping = span_mapping(candidates, spans, policy.span_threshold)
    new = lookup(leaves.drop("text"), mapping.select(text_id(F.col("old")).alias("text_id"), "new"), "text_id", ["new"])
    per_record = new.where(F.col("new").isNotNull()).groupBy(*ids).agg(
        F.map_from_entries(F.collect_list(F.struct("at", "new"))).alias("_at"))
    joined = records.join(per_record, ids, "left")
    changed = map_json_strings(joined.withColumn("_raw", F.when(F.col("_at").isNotNull(), F.col(col))), "_raw",
                               lambda s, i: F.coalesce(F.try_element_at(F.col("_at"), i), s), False, "_new_json")
    rewritten = F.coalesce("_new_json", F.try_element_at(F.col("_at"), F.lit(0)), F.col(col))
    return (changed.withColumn(col, F.when(F.col("_at").isNull(), F.col(col)).otherwise(rewritten))
            .withColumn("strings_changed", F.coalesce(F.when(F.col("_at").isNotNull(), F.size("_at")), F.lit(0)).cast("bigint"))
            .drop("_at", "_raw", "_new_json"))


def label_totals(merged: DataFrame) -> DataFrame:
    """Replaced spans per label, each distinct text counted once."""
    return merged.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
