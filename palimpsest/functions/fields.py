"""Field names that make a value sensitive, and what replaces such a value."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest import catalog
from palimpsest.functions.expr import any_of, let
from palimpsest.policy import Policy


def normalize_key(key: Column) -> Column:
    """Lower case, runs of other characters become one ``_``, outer ``_`` removed."""
    return F.trim(F.regexp_replace(F.lower(key), r"[^a-z0-9]+", "_"), F.lit("_"))


def is_sensitive_key(key: Column, policy: Policy | None = None) -> Column:
    extra = [re.sub(r"[^a-z0-9]+", "_", k.lower()).strip("_") for k in (policy.extra_sensitive_keys if policy else ())]
    exact = [*catalog.SENSITIVE_KEYS, *extra, *(k.replace("_", "") for k in extra)]
    return let(normalize_key(key), lambda n: let(F.replace(n, F.lit("_"), F.lit("")), lambda c: (
        n.isin(exact) | c.isin(exact)
        | any_of(F.contains(n, F.lit(x)) | F.contains(c, F.lit(x))
                 for x in catalog.SENSITIVE_KEY_FRAGMENTS))))


def field_placeholder(key: Column) -> Column:
    """Replacement of a text stored under a sensitive key."""
    return (F.when(key.rlike(r"(?iu)encrypted|signature"), catalog.OPAQUE_BLOB)
            .when(key.rlike(r"(?iu)share"), catalog.SHARE_METADATA)
            .otherwise(catalog.SENSITIVE_FIELD))


def redact_field(key: Column, value: Column, dtype: T.DataType, redact) -> Column:
    """Value under ``key``: numbers, booleans and nulls stay, the rest is replaced or redacted.

    ``redact`` handles values whose key is harmless.  For arrays, maps and
    structs the sensitive form is text, so the key must be a constant there
    (see ``operators.frames``); here they become null instead.
    """
    if isinstance(dtype, T.StringType):
        return F.when(is_sensitive_key(key), F.when(value.isNotNull(), field_placeholder(key))).otherwise(redact(value))
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        return F.when(~is_sensitive_key(key), redact(value))
    return value
