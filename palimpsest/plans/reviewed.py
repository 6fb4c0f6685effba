"""Review by an outside reader: chunks out, findings in, summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.operators import review as R
from palimpsest.session import materialized


def review(records: DataFrame, find, patterns: list[str] | None = None, max_chars: int = R.REVIEW_MAX_CHARS,
           max_chunks: int = 0, dry_run: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(records, summary)``.

    Records of ``.jsonl`` files are lines and reviewed whole; any other record is the text of a
    document and reviewed in windows around its candidates.  ``find`` turns ``chunks(chunk_id, rel_path, line_no, chunk_no, chunk)`` into
    ``findings(finding_no, chunk_id, rel_path, text, category)``: any
    DataFrame function, for instance a ``mapInPandas`` around a reader.
    """
    patterns = patterns or R.review_patterns()
    is_line = F.endswith("rel_path", F.lit(".jsonl"))
    columns = ["rel_path", "line_no", "chunk_no", "chunk"]
    chunks = R.review_chunks(records.where(is_line), patterns, max_chars=max_chars).select(*columns).unionByName(
        R.review_windows(records.where(~is_line), ["rel_path", "line_no"], "raw", patterns, max_chars).select(*columns))
    chunks = R.limit_chunks(chunks, ["rel_path", "line_no", "chunk_no"], max_chunks)
    chunks = materialized(chunks.select(
        F.sha2(F.to_json(F.struct("rel_path", "line_no", "chunk_no")), 256).alias("chunk_id"), "rel_path", "line_no", "chunk_no", "chunk"))
    findings = materialized(R.valid_findings(find(chunks), chunks))
    applied = materialized(R.apply_review_findings(records, findings, dry_run=dry_run))
    return applied.drop("replacements"), R.review_summary(chunks, findings, applied, dry_run)
