"""Redact, list and rewrite the strings of JSON records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.functions.expr import fresh, let
from palimpsest.functions.fields import field_placeholder, is_sensitive_key, normalize_key
from palimpsest.functions.json_text import canonical_json, is_json, join_tokens, json_leaf_array, json_tokens, key_before
from palimpsest.functions.redact import HITS_TYPE, redacted, redacted_with_hits
from palimpsest.functions.rules import active_rules, redaction_rules
from palimpsest.operators.joins import lookup
from palimpsest.operators.term_index import TermIndex, redact_strings
from palimpsest.policy import Policy


def is_blank(raw: Column) -> Column:
    return F.trim(raw, F.lit(" \t\r\n\v\f")) == ""


def split_malformed(records: DataFrame, raw: str = "raw") -> DataFrame:
    """Add ``is_blank`` and ``is_valid``; blank lines are neither valid nor counted as malformed.

    The strict parser decides first; what it refuses (repeated keys, NaN, deep
    nesting) is read again the lenient way.
    """
    text = F.col(raw)
    strict = is_json(text)
    lenient = canonical_json()(F.when(~strict & ~is_blank(text), text), F.lit(None).cast("array<string>"))
    return (records.withColumn("is_blank", is_blank(text))
            .withColumn("_lenient", lenient)
            .withColumn("is_valid", ~F.col("is_blank") & (strict | F.col("_lenient").isNotNull()))
            .drop("_lenient"))


def _prepared(df: DataFrame, col: str, policy: Policy | None) -> DataFrame:
    """Add ``_secret_keys``, and ``_tokens`` of the record as compact JSON (null for other text).

    Columns that a lambda needs are bound with ``let``: the optimizer may copy
    a column's definition into the lambda, where it would run per element.
    """
    text = F.col(col)
    df = df.withColumn("_strict", is_json(text))
    df = df.withColumn("_tokens", F.when(F.col("_strict"), json_tokens(text)))
    container = F.lit(False)
    if policy is None:
        df = df.withColumn("_secret_keys", F.lit(None).cast("array<string>"))
    else:
        # Keys whose value is an object or array that has to go as a whole.
        df = df.withColumn("_secret_keys", F.coalesce(_sensitive_keys(text, policy), F.array().cast("array<string>")))
        both = F.struct(F.col("_tokens").alias("t"), F.col("_secret_keys").alias("k"))
        opens = let(both, lambda b: F.exists(
            F.zip_with(b["t"]["strings"], F.slice(b["t"]["gaps"], F.lit(2), F.size(b["t"]["strings"])),
                       lambda s, g: g.rlike(r"^:[\[{]") & F.array_contains(b["k"], s)), lambda x: x))
        container = F.when(F.size("_secret_keys") > 0, F.coalesce(opens, F.lit(False))).otherwise(F.lit(False))
    df = df.withColumn("_again", F.when(~is_blank(text) & (~F.col("_strict") | container), text))
    df = df.withColumn("_parsed", canonical_json()("_again", "_secret_keys"))
    return df.withColumn("_tokens", F.when(F.col("_again").isNull(), F.col("_tokens")).when(
        F.col("_parsed").isNotNull(), json_tokens(F.col("_parsed"))))


def _sensitive_keys(text: Column, policy: Policy) -> Column:
    """Distinct sensitive keys of a record, valid or not, decoded."""
    keys = F.regexp_extract_all(text, F.lit(r'("[^"\\]*+(?:\\.[^"\\]*+)*+")[ \t\r\n]*:'), F.lit(1))
    decoded = F.from_json(F.concat(F.lit("["), F.array_join(F.array_distinct(keys), ","), F.lit("]")), "array<string>")
    return F.filter(decoded, lambda k: is_sensitive_key(k, policy))


_HELPERS = ["_strict", "_tokens", "_secret_keys", "_again", "_parsed", "_active", "_new", "_text", "_fixed"]


def redact_json(df: DataFrame, col: str, policy: Policy, out: str | None = None,
                hits: str | None = None, terms: TermIndex | None = None) -> DataFrame:
    """Redact every string and key of JSON text; other text is redacted as it is.

    Row-local.  Key order and the way numbers are written stay; repeated or
    newly equal keys keep the last value.  ``hits`` collects what was found,
    sensitive fields included.  ``terms`` takes the place of the rule for
    private terms, for lists of any length.
    """
    out = out or col
    if terms is not None:
        hidden = hits or fresh(df, "_hits")
        df = _json_with_terms(df, col, policy, out, hidden, terms)
        return df if hits else df.drop(hidden)
    rules = redaction_rules(policy)
    df = _prepared(df, col, policy)
    tok = F.col("_tokens")
    # One guard test per record, on all its strings at once.
    seen = F.when(tok.isNotNull(), F.array_join(tok["strings"], "\n")).otherwise(F.col(col))
    df = df.withColumn("_active", active_rules(seen, rules))
    bound = F.struct(tok.alias("t"), F.col("_active").alias("a"), F.col("_secret_keys").alias("k"))
    nothing = F.array().cast(HITS_TYPE)

    def strings(b):
        def one(s, key):
            secret = key.isNotNull() & F.array_contains(b["k"], key)
            if hits is None:
                return F.when(secret, field_placeholder(key)).when(
                    F.size(b["a"]) == 0, s).otherwise(redacted(s, policy, rules, b["a"]))
            plain = F.struct(s.alias("text"), nothing.alias("hits"))
            hidden = F.struct(field_placeholder(key).alias("text"), nothing.alias("hits"))
            return F.when(secret, hidden).when(F.size(b["a"]) == 0, plain).otherwise(
                redacted_with_hits(s, policy, rules, b["a"]))
        return F.zip_with(b["t"]["strings"], key_before(b["t"]), one)

    df = df.withColumn("_new", F.when(tok.isNotNull(), let(bound, strings)))
    texts = F.col("_new") if hits is None else F.transform("_new", lambda x: x["text"])
    df = df.withColumn("_text", F.when(tok.isNotNull(), join_tokens(tok["gaps"], texts)))
    # Two keys of a record may have become equal: read it again, the last one wins.
    df = df.withColumn("_again", F.when(_keys_changed(tok, texts), F.col("_text")))
    df = df.withColumn("_fixed", canonical_json()("_again", F.lit(None).cast("array<string>")))
    # Whatever could not be put together again is redacted as plain text, never passed on.
    malformed = F.col("_fixed").isNull() & F.col("_text").isNull() & ~is_blank(F.col(col))
    if hits is None:
        rest = F.when(malformed, redacted(F.col(col), policy, rules, F.col("_active"))).otherwise(F.col(col))
        return df.withColumn(out, F.coalesce("_fixed", "_text", rest)).drop(*_HELPERS)
    df = df.withColumn("_rest", F.when(malformed, redacted_with_hits(F.col(col), policy, rules, F.col("_active"))))
    fields = _field_hits(bound)
    found = F.when(tok.isNotNull(), F.concat(
        F.when(F.size("_secret_keys") > 0, fields).otherwise(nothing),
        F.flatten(F.transform("_new", lambda x: x["hits"])))).otherwise(F.coalesce(F.col("_rest.hits"), nothing))
    return (df.withColumn(hits, found)
            .withColumn(out, F.coalesce("_fixed", "_text", "_rest.text", F.col(col)))
            .drop("_rest", *_HELPERS))


def _field_hits(bound: Column) -> Column:
    """Hits on sensitive fields come from the keys, whatever their value is."""
    return let(bound, lambda b: F.transform(
        F.filter(F.zip_with(b["t"]["strings"], b["t"]["keys"], lambda s, k: F.when(
            k & F.array_contains(b["k"], s), s)), lambda s: s.isNotNull()),
        lambda s: F.struct(F.concat(F.lit("sensitive_field_"), normalize_key(s)).alias("category"),
                           F.lit(1).cast("bigint").alias("n"), F.array().cast("array<string>").alias("values"))))


def _json_with_terms(df: DataFrame, col: str, policy: Policy, out: str, hits: str, terms: TermIndex) -> DataFrame:
    """All strings of a record go through the rules and the term index together; values of sensitive keys do not."""
    df = _prepared(df, col, policy)
    tok, nothing = F.col("_tokens"), F.array().cast(HITS_TYPE)
    bound = F.struct(tok.alias("t"), F.col("_secret_keys").alias("k"))
    open_ = let(bound, lambda b: F.zip_with(b["t"]["strings"], key_before(b["t"]), lambda s, key: F.when(
        ~(key.isNotNull() & F.array_contains(b["k"], key)), s)))
    texts = F.when(tok.isNotNull(), open_).when(~is_blank(F.col(col)), F.array(col))
    df = redact_strings(df, texts, "_new", terms)
    # A string that was left out is the value of a sensitive key.
    both = F.struct(tok.alias("t"), F.transform("_new", lambda x: x["text"]).alias("n"))
    shown = let(both, lambda b: F.zip_with(b["n"], key_before(b["t"]), lambda s, key: F.coalesce(s, field_placeholder(key))))
    df = df.withColumn("_active", F.when(tok.isNotNull(), shown))
    df = df.withColumn("_text", F.when(tok.isNotNull(), join_tokens(tok["gaps"], F.col("_active"))))
    df = df.withColumn("_again", F.when(_keys_changed(tok, F.col("_active")), F.col("_text")))
    df = df.withColumn("_fixed", canonical_json()("_again", F.lit(None).cast("array<string>")))
    inside = F.concat(F.when(F.size("_secret_keys") > 0, _field_hits(bound)).otherwise(nothing),
                      F.flatten(F.transform("_new", lambda x: F.coalesce(x["hits"], nothing))))
    found = F.when(tok.isNotNull(), inside).otherwise(F.coalesce(F.col("_new")[0]["hits"], nothing))
    plain = F.when(tok.isNull() & F.col("_new").isNotNull(), F.col("_new")[0]["text"])
    return df.withColumn(hits, found).withColumn(out, F.coalesce("_fixed", "_text", plain, F.col(col))).drop(*_HELPERS)


def _keys_changed(tokens: Column, texts: Column) -> Column:
    """Some key is not what it was."""
    def keys(strings):
        return F.filter(strings, lambda s: s.isNotNull())
    both = F.struct(tokens["strings"].alias("old"), tokens["keys"].alias("k"), texts.alias("new"))
    return let(both, lambda b: keys(F.zip_with(b["old"], b["k"], lambda s, k: F.when(k, s)))
               != keys(F.zip_with(b["new"], b["k"], lambda s, k: F.when(k, s))))


def json_leaves(df: DataFrame, ids: list[str], col: str) -> DataFrame:
    """``(ids, leaf_no, path, key, value)``: every string value of JSON text.

    Keys are visited, not listed.  ``leaf_no`` counts from 0 in text order;
    malformed text has no leaves.
    """
    return (df.select(*ids, F.posexplode(json_leaf_array(F.col(col))).alias("leaf_no", "leaf"))
            .select(*ids, "leaf_no", "leaf.path", "leaf.key", "leaf.value"))


def apply_mapping(leaves: DataFrame, mapping: DataFrame, value: str = "value") -> DataFrame:
    """Look every value up in ``mapping(old, new)``; adds ``new_value`` and ``changed``."""
    found = lookup(leaves.withColumn("_old", F.sha2(value, 256)),
                   mapping.select(F.sha2("old", 256).alias("_old"), F.col("new").alias("_new_value")),
                   "_old", ["_new_value"])
    new = F.coalesce("_new_value", F.col(value))
    return (found.withColumn("new_value", new).withColumn("changed", ~new.eqNullSafe(F.col(value)))
            .drop("_old", "_new_value"))


def map_json_strings(df: DataFrame, col: str, rewrite, keys: bool, out: str) -> DataFrame:
    """Rewrite the strings of JSON text with a column function; text that is no JSON becomes null.

    ``rewrite(string, index)`` gets every value and, if ``keys``, every key.
    """
    df = _prepared(df, col, None)
    tok = F.col("_tokens")
    def mapped(t):
        if keys:
            return F.transform(t["strings"], rewrite)
        return F.transform(t["strings"], lambda s, i: F.when(F.get(t["keys"], i), s).otherwise(rewrite(s, i)))
    df = df.withColumn("_new", F.when(tok.isNotNull(), let(tok, mapped)))
    df = df.withColumn("_text", F.when(tok.isNotNull(), join_tokens(tok["gaps"], F.col("_new"))))
    if not keys:
        return df.withColumn(out, F.col("_text")).drop(*_HELPERS)
    df = df.withColumn("_again", F.when(_keys_changed(tok, F.col("_new")), F.col("_text")))
    df = df.withColumn("_fixed", canonical_json()("_again", F.lit(None).cast("array<string>")))
    return df.withColumn(out, F.coalesce("_fixed", "_text")).drop(*_HELPERS)


def json_values(df: DataFrame, col: str, out: str) -> DataFrame:
    """``array<struct<at, text>>``: string values with their position; text that is no JSON is one value at 0."""
    df = _prepared(df, col, None)
    inside = let(F.col("_tokens"), lambda t: F.filter(F.transform(t["strings"], lambda s, i: F.struct(
        i.alias("at"), F.when(~F.get(t["keys"], i), s).alias("text"))), lambda x: x["text"].isNotNull()))
    whole = F.array(F.struct(F.lit(0).alias("at"), F.col(col).alias("text")))
    return df.withColumn(out, F.when(F.col("_tokens").isNotNull(), inside).otherwise(whole)).drop(*_HELPERS)
