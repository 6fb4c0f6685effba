"""Review pass: candidate chunks out, exact findings back in."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.catalog import REVIEW_MAX_CHARS, REVIEW_PATTERNS
from palimpsest.functions.dialect import java_regex
from palimpsest.functions.expr import any_of, count_literal, let, overlapping
from palimpsest.functions.json_text import is_json, json_tokens
from palimpsest.operators.json_records import map_json_strings
from palimpsest.operators.literals import literal_hits

#: Characters that neighbouring pieces of a long line share.
REVIEW_OVERLAP = 200


def review_patterns(extra: tuple[str, ...] = (), terms: tuple[str, ...] = ()) -> list[str]:
    return [*REVIEW_PATTERNS, *extra, *(re.escape(t) for t in terms)]


def is_review_candidate(text: Column, patterns: list[str]) -> Column:
    return any_of(text.rlike(java_regex(p)) for p in patterns)


def limit_files(df: DataFrame, size: str = "file_size", path: str = "rel_path",
                max_bytes: int | None = None) -> DataFrame:
    """Leave out compiled files and, only if asked for, those above ``max_bytes``; unknown sizes stay."""
    return df.where(~_skipped(size, path, max_bytes))


def skipped_files(df: DataFrame, size: str = "file_size", path: str = "rel_path",
                  max_bytes: int | None = None) -> DataFrame:
    """What :func:`limit_files` leaves out, with the ``reason``: ``compiled`` or ``size``."""
    compiled = F.coalesce(F.endswith(path, F.lit(".pyc")), F.lit(False))
    return df.where(_skipped(size, path, max_bytes)).withColumn("reason", F.when(compiled, "compiled").otherwise("size"))


def _skipped(size: str, path: str, max_bytes: int | None) -> Column:
    compiled = F.coalesce(F.endswith(path, F.lit(".pyc")), F.lit(False))
    return compiled if max_bytes is None else compiled | F.coalesce(F.col(size) > max_bytes, F.lit(False))


def limit_chunks(chunks: DataFrame, order: list[str], max_chunks: int = 0) -> DataFrame:
    """The first chunks in path order; 0 means all."""
    return chunks.orderBy(*order).limit(max_chunks) if max_chunks else chunks


def review_chunks(records: DataFrame, patterns: list[str], col: str = "raw",
                  max_chars: int = REVIEW_MAX_CHARS, overlap: int = REVIEW_OVERLAP) -> DataFrame:
    """Line mode: ``(.., chunk_no, chunk)``, the whole of every line with a candidate.

    A long line is cut into pieces of ``max_chars`` that share ``overlap``
    characters, so a finding of at most ``overlap`` characters lies whole in one.
    """
    picked = records.where(is_review_candidate(F.col(col), patterns))
    return picked.select("*", F.posexplode(overlapping(F.col(col), max_chars, overlap)).alias("chunk_no", "_piece")).select(
        *records.columns, "chunk_no", F.col("_piece.piece").alias("chunk"))


def review_windows(documents: DataFrame, ids: list[str], col: str, patterns: list[str],
                   max_chars: int = REVIEW_MAX_CHARS) -> DataFrame:
    """Window mode: ``(ids, chunk_no, chunk)`` around every candidate, overlaps kept.

    Where a match begins follows from the lengths of what lies before it.  A
    window is cut from the two or three blocks of the text that it touches, so a
    long text is not walked from its beginning for every match.
    """
    union = java_regex("|".join(f"(?:{p})" for p in patterns))
    half = max_chars // 2
    block = max(4 * max_chars, 1024)
    text = F.col(col)
    found = F.regexp_extract_all(text, F.lit(union), F.lit(0))
    between = F.split(text, union, -1)
    lengths = F.zip_with(F.slice(between, F.lit(1), F.size(found)), found, lambda g, m: F.struct(
        F.length(g).alias("gap"), F.length(m).alias("n")))
    start = F.struct(F.lit(0).alias("end"), F.array().cast("array<struct<start:int,end:int>>").alias("at"))

    def placed(acc, x):
        begin = acc["end"] + x["gap"]
        return F.struct((begin + x["n"]).alias("end"), F.concat(acc["at"], F.array(F.struct(
            F.greatest(begin - half, F.lit(0)).alias("start"), (begin + x["n"] + half).alias("end")))).alias("at"))
    # The text in pieces; a short one is a single piece.
    blocks = F.transform(F.sequence(F.lit(0), F.floor(F.length(text) / block).cast("int")),
                         lambda i: F.substring(text, i * block + 1, F.lit(block)))
    both = F.struct(F.aggregate(lengths, start, placed)["at"].alias("at"), blocks.alias("b"))

    def cut(v):
        def window(w):
            first, last = F.floor(w["start"] / block).cast("int"), F.floor((w["end"] - 1) / block).cast("int")
            part = F.array_join(F.slice(v["b"], first + 1, last - first + 1), "")
            return F.substring(part, w["start"] - first * block + 1, w["end"] - w["start"])
        return F.transform(v["at"], window)

    picked = documents.where(is_review_candidate(text, patterns))
    return picked.select(*ids, F.posexplode(let(both, cut)).alias("chunk_no", "chunk"))


def valid_findings(findings: DataFrame, chunks: DataFrame) -> DataFrame:
    """Findings that name a text of their chunk; texts trimmed, categories in normal form."""
    text = F.regexp_replace("text", "^(?U)\\s+|(?U)\\s+$", "")
    category = F.regexp_replace(F.upper(F.coalesce("category", F.lit("OTHER"))), "[^A-Z0-9_]", "_")
    clean = (findings.withColumn("text", text)
             .withColumn("category", F.when(category == "", "OTHER").otherwise(category))
             .where((F.length("text") >= 3) & ~F.contains("text", F.lit("[")) & ~F.contains("text", F.lit("]"))))
    return clean.join(chunks.select("chunk_id", "chunk"), "chunk_id").where(
        F.contains("chunk", F.col("text"))).drop("chunk")


def dedupe_findings(findings: DataFrame) -> DataFrame:
    """``(rel_path, text, category, no)``: one category per text and file, the last one."""
    return findings.groupBy("rel_path", "text").agg(
        F.max_by("category", "finding_no").alias("category"), F.min("finding_no").alias("no"))


def review_placeholder(category: Column) -> Column:
    return F.concat(F.lit("[LLM_PII:"), category, F.lit("]"))


def _ordered(hits: Column) -> Column:
    """Longest first; equal lengths in order of arrival."""
    key = F.transform(hits, lambda h: F.struct((-F.length(h["literal"])).alias("l"), h["no"].alias("no"), h.alias("h")))
    return F.transform(F.sort_array(key), lambda k: k["h"])


def _rewritten(text: Column, hits: Column) -> Column:
    """``struct<text, n>`` of one string."""
    start = F.struct(text.alias("text"), F.lit(0).cast("bigint").alias("n"))
    def step(acc, h):
        return let(count_literal(acc["text"], h["literal"]), lambda n: F.when(n == 0, acc).otherwise(F.struct(
            F.replace(acc["text"], h["literal"], h["placeholder"]).alias("text"), (acc["n"] + n).alias("n"))))
    return F.aggregate(hits, start, step)


def apply_review_findings(records: DataFrame, findings: DataFrame, ids: list[str] | None = None,
                          col: str = "raw", dry_run: bool = False) -> DataFrame:
    """Replace findings in the records of their file; adds ``replacements``.

    ``.json``/``.jsonl`` records change inside their strings and keys only
    and malformed lines stay; any other text changes as a whole.
    """
    ids = ids or ["rel_path", "line_no"]
    structured = F.col("rel_path").rlike(r"\.jsonl?$")
    raw = F.col(col)
    strings = F.when(structured, F.when(is_json(raw), json_tokens(raw)["strings"])
                     .otherwise(F.array(raw))).otherwise(F.array(raw))
    literals = dedupe_findings(findings).select(
        "rel_path", F.col("no").cast("bigint").alias("no"), F.col("text").alias("literal"),
        review_placeholder(F.col("category")).alias("placeholder"))
    hits = literal_hits(records, ids, literals, strings).withColumn("literals", _ordered(F.col("literals")))
    joined = records.join(hits, ids, "left").withColumn(
        "_in", F.when(F.col("literals").isNotNull() & structured, raw))
    changed = map_json_strings(joined, "_in", lambda s, i: _rewritten(s, F.col("literals"))["text"], True, "_rewritten")
    counted = changed.withColumn("_plain", F.when(
        F.col("literals").isNotNull() & ~structured, _rewritten(raw, F.col("literals"))))
    inside = F.when(F.col("_rewritten").isNotNull(), F.aggregate(
        json_tokens(F.col("_in"))["strings"], F.lit(0).cast("bigint"),
        lambda acc, s: acc + _rewritten(s, F.col("literals"))["n"]))
    n = F.coalesce(inside, F.col("_plain.n"), F.lit(0).cast("bigint"))
    out = counted.withColumn("replacements", n)
    if not dry_run:
        out = out.withColumn(col, F.coalesce(F.when(F.col("replacements") > 0, F.coalesce("_rewritten", "_plain.text")), raw))
    return out.select(*records.columns, "replacements")


def review_summary(chunks: DataFrame, findings: DataFrame, applied: DataFrame, dry_run: bool = False) -> DataFrame:
    """One row: chunks reviewed, files with findings, files changed, replacements."""
    reviewed = chunks.agg(F.count(F.lit(1)).alias("chunks_reviewed"))
    files = findings.select("rel_path").distinct().agg(F.count(F.lit(1)).alias("files_with_findings"))
    per_file = applied.groupBy("rel_path").agg(F.sum("replacements").alias("n"))
    done = per_file.agg(F.count(F.when(F.col("n") > 0, 1)).alias("_changed"), F.coalesce(F.sum("n"), F.lit(0)).alias("replacements"))
    return reviewed.crossJoin(files).crossJoin(done).select(
        "chunks_reviewed", "files_with_findings",
        (F.lit(0).cast("bigint") if dry_run else F.col("_changed")).alias("files_changed"),
        "replacements", F.lit(dry_run).alias("dry_run"))
