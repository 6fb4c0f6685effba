"""Scan a published copy and decide whether it may leave."""

from __future__ import annotations

from pyspark.sql import DataFrame

from palimpsest.operators.scan import gate, scan, scan_summary
from palimpsest.policy import Policy
from palimpsest.session import checkpointed


def verify(records: DataFrame, policy: Policy, col: str = "raw") -> tuple[DataFrame, DataFrame]:
    """``(summary, gate)``; the caller raises or returns an exit code."""
    summary = checkpointed(scan_summary(scan(records, policy, col), policy))
    return summary, gate(summary)
