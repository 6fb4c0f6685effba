"""Redact every text in a typed, nested table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest import catalog
from palimpsest.functions.expr import fresh, let
from palimpsest.functions.fields import field_placeholder, is_sensitive_key, redact_field
from palimpsest.functions.redact import redacted
from palimpsest.functions.rules import active_rules, redaction_rules
from palimpsest.policy import Policy


class _Names:
    """Field names are few and known before the job: judged once, on the driver."""

    def __init__(self, spark: SparkSession, schema: T.StructType, policy: Policy):
        names = sorted(set(_field_names(schema)))
        rows = (spark.createDataFrame([(n,) for n in names] or [("",)], "name string")
                .select("name", redacted(F.col("name"), policy).alias("new"),
                        is_sensitive_key(F.col("name"), policy).alias("sensitive"),
                        field_placeholder(F.col("name")).alias("placeholder")).collect())
        self.rules = redaction_rules(policy)
        self.new = {r["name"]: r["new"] for r in rows}
        self.placeholder = {r["name"]: r["placeholder"] for r in rows if r["sensitive"]}


def _field_names(dtype: T.DataType):
    if isinstance(dtype, T.StructType):
        for f in dtype.fields:
            yield f.name
            yield from _field_names(f.dataType)
    elif isinstance(dtype, T.ArrayType):
        yield from _field_names(dtype.elementType)
    elif isinstance(dtype, T.MapType):
        yield from _field_names(dtype.keyType)
        yield from _field_names(dtype.valueType)


def _last_wins(entries: Column) -> Column:
    """Map from entries whose keys may have become equal; the last one stays."""
    def deduplicated(e):
        return F.filter(e, lambda x, i: ~F.exists(
            F.slice(e, i + 2, F.size(e)), lambda later: later["key"] == x["key"]))
    return let(entries, lambda e: F.map_from_entries(
        F.when(F.size(F.array_distinct(F.transform(e, lambda x: x["key"]))) == F.size(e), e)
        .otherwise(deduplicated(e))))


def _strings(value: Column, dtype: T.DataType, names: _Names) -> Column | None:
    """All strings of a value that the rules will see, as one array; None if its type holds none."""
    if isinstance(dtype, T.StringType):
        return F.array(value)
    if isinstance(dtype, T.ArrayType):
        if isinstance(dtype.elementType, T.StringType):
            return value
        if _strings(F.lit(None), dtype.elementType, names) is None:
            return None
        return F.flatten(F.transform(value, lambda x: F.coalesce(_strings(x, dtype.elementType, names), F.array().cast("array<string>"))))
    if isinstance(dtype, T.MapType):
        parts = [_strings(part(value), T.ArrayType(t), names) for part, t in ((F.map_keys, dtype.keyType), (F.map_values, dtype.valueType))]
        return _together([p for p in parts if p is not None])
    if isinstance(dtype, T.StructType):
        parts = [_strings(value[f.name], f.dataType, names) for f in dtype.fields if f.name not in names.placeholder]
        return _together([p for p in parts if p is not None])
    return None


def _together(parts: list[Column]) -> Column | None:
    return F.concat(*[F.coalesce(p, F.array().cast("array<string>")) for p in parts]) if parts else None


def _value(value: Column, dtype: T.DataType, names: _Names, policy: Policy, keep_types: bool, active: Column) -> Column:
    """``active``: the rules that the row's guard let through; bound again where a lambda needs it."""
    if isinstance(dtype, T.StringType):
        return redacted(value, policy, names.rules, active)
    if isinstance(dtype, T.ArrayType):
        return let(F.struct(value.alias("v"), active.alias("a")), lambda b: F.transform(
            b["v"], lambda x: _value(x, dtype.elementType, names, policy, keep_types, b["a"])))
    if isinstance(dtype, T.MapType):
        def entry(e, a):
            key = _value(e["key"], dtype.keyType, names, policy, keep_types, a)
            if not isinstance(dtype.keyType, T.StringType):
                return F.struct(key.alias("key"), _value(e["value"], dtype.valueType, names, policy, keep_types, a).alias("value"))
            return F.struct(key.alias("key"), redact_field(
                e["key"], e["value"], dtype.valueType, lambda v: _value(v, dtype.valueType, names, policy, keep_types, a)).alias("value"))
        entries = let(F.struct(F.map_entries(value).alias("v"), active.alias("a")), lambda b: F.transform(b["v"], lambda e: entry(e, b["a"])))
        return F.when(value.isNotNull(), _last_wins(entries))
    if isinstance(dtype, T.StructType):
        fields = [_field(value[f.name], f, names, policy, keep_types, active).alias(names.new[f.name])
                  for f in dtype.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    return value


def _field(value: Column, field: T.StructField, names: _Names, policy: Policy, keep_types: bool, active: Column) -> Column:
    placeholder = names.placeholder.get(field.name)
    if placeholder is None:
        return _value(value, field.dataType, names, policy, keep_types, active)
    if isinstance(field.dataType, T.StringType):
        return F.when(value.isNotNull(), F.lit(placeholder))
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        if keep_types:
            return F.lit(None).cast(field.dataType)
        return F.when(value.isNotNull(), F.lit(catalog.SENSITIVE_FIELD))
    return value


def redact_frame(df: DataFrame, policy: Policy, keep_types: bool = False) -> DataFrame:
    """Redact all strings, map keys and field names of a table.

    A container under a sensitive name becomes text; with ``keep_types`` it
    becomes null instead and ``<name>_redacted`` tells where that happened.
    """
    names = _Names(df.sparkSession, df.schema, policy)
    row = fresh(df, "_row_rules")
    texts = [_strings(F.col(f"`{f.name}`"), f.dataType, names) for f in df.schema.fields if f.name not in names.placeholder]
    texts = _together([t for t in texts if t is not None])
    # One guard test per row, on all its strings at once.
    active = F.array().cast("array<int>") if texts is None else active_rules(F.array_join(texts, "\n"), names.rules)
    df = df.withColumn(row, active)
    columns = []
    for f in df.schema.fields:
        if f.name == row:
            continue
        source = F.col(f"`{f.name}`")
        columns.append(_field(source, f, names, policy, keep_types, F.col(row)).alias(names.new[f.name]))
        if keep_types and f.name in names.placeholder and isinstance(
                f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            columns.append(source.isNotNull().alias(f"{names.new[f.name]}_redacted"))
    return df.select(*columns)


def field_hits(df: DataFrame, policy: Policy) -> DataFrame:
    """``(key, n)``: rows per sensitive top-level column, named in normal form."""
    from palimpsest.functions.fields import normalize_key
    names = sorted(_Names(df.sparkSession, df.schema, policy).placeholder)
    columns = [f.name for f in df.schema.fields if f.name in names]
    if not columns:
        return df.sparkSession.createDataFrame([], "key string, n bigint")
    keys = F.explode(F.array(*[F.lit(c) for c in columns])).alias("name")
    return df.select(keys).groupBy(normalize_key(F.col("name")).alias("key")).agg(F.count(F.lit(1)).alias("n"))
