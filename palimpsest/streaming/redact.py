"""The row-local operators on streams.

Redaction, field handling, candidate selection and the leftover scan need one
row at a time, so they take streaming DataFrames as they are.  Their
placeholders carry the digest only; ``streaming.ordinals`` numbers them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from palimpsest.operators.json_records import redact_json
from palimpsest.operators.text import redact_text
from palimpsest.policy import Policy


def redact_stream(stream: DataFrame, col: str, policy: Policy, json: bool = False) -> DataFrame:
    if not stream.isStreaming:
        raise ValueError("not a streaming DataFrame")
    return redact_json(stream, col, policy) if json else redact_text(stream, col, policy)


def write_stream(redacted: DataFrame, out: str, checkpoint: str, once: bool = True):
    """Append to Parquet; with ``once`` everything available is written and the query ends."""
    writer = redacted.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer).start(out)
