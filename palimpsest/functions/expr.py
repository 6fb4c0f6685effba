"""Small column helpers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and use it several times in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def sql_text(value: str) -> str:
    """A string literal in Spark SQL."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def apply_sql(value: Column, function: str) -> Column:
    """Apply a SQL lambda ``x -> ...`` to a column, evaluated once per row.

    Large expressions are written as SQL text: one call builds them, while
    the column API makes a round trip to the JVM for every node.
    """
    return F.element_at(F.call_function("transform", F.array(value), F.expr(function)), 1)


def any_of(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def all_of(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def count_literal(text: Column, literal: Column) -> Column:
    """How often a literal occurs in a text, left to right, without overlaps."""
    removed = F.length(text) - F.length(F.replace(text, literal, F.lit("")))
    return F.when(F.length(literal) > 0, (removed / F.length(literal)).cast("bigint")).otherwise(F.lit(0).cast("bigint"))


def overlapping(text: Column, max_chars: int, overlap: int) -> Column:
    """The whole text as ``array<struct<offset,piece>>``: pieces of ``max_chars``, neighbours share ``overlap`` characters."""
    step = max_chars - overlap
    if overlap < 0 or step < 1:
        raise ValueError("overlap must be smaller than max_chars")
    last = F.greatest(F.ceil((F.length(text) - overlap) / step) - 1, F.lit(0)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(
        (i * step).alias("offset"), F.substring(text, i * step + 1, F.lit(max_chars)).alias("piece")))


def json_quote(text: Column) -> Column:
    """A JSON string literal: only quotes, backslashes and control characters are escaped."""
    # Most strings need no escape: one look instead of eight.
    special = text.rlike(r'["\\\x00-\x1f]')
    quoted = text
    for char, escape in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"),
                         ("\t", "\\t"), ("\b", "\\b"), ("\f", "\\f")):
        quoted = F.replace(quoted, F.lit(char), F.lit(escape))
    rest = [c for c in range(32) if chr(c) not in "\n\r\t\b\f"]
    def others(q):
        for c in rest:
            q = F.replace(q, F.lit(chr(c)), F.lit(f"\\u{c:04x}"))
        return q
    escaped = let(quoted, lambda q: F.when(q.rlike(r"[\x00-\x1f]"), others(q)).otherwise(q))
    return F.concat(F.lit('"'), F.when(special, escaped).otherwise(text), F.lit('"'))


def fresh(df, name: str) -> str:
    """The name, or a longer one that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
