"""Relative paths: every component is a text of its own."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from palimpsest.functions.redact import redacted, redacted_with_hits
from palimpsest.policy import Policy


def clean_component(component: Column) -> Column:
    return F.translate(component, "/\\", "__")


def redacted_path(path: Column, policy: Policy) -> Column:
    return F.array_join(F.transform(F.split(path, "/"), lambda c: clean_component(redacted(c, policy))), "/")


def redacted_path_with_hits(path: Column, policy: Policy) -> Column:
    """``struct<text, hits>`` like :func:`redact.redacted_with_hits`."""
    from palimpsest.functions.expr import let
    parts = F.transform(F.split(path, "/"), lambda c: redacted_with_hits(c, policy))
    return let(parts, lambda p: F.struct(
        F.array_join(F.transform(p, lambda x: clean_component(x["text"])), "/").alias("text"),
        F.flatten(F.transform(p, lambda x: x["hits"])).alias("hits")))


def path_order(path: Column) -> Column:
    """Sort key of a path: folder by folder, by code point."""
    return F.split(path, "/")
