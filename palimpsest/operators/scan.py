"""Independent scan for leftovers in contents and path names."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from palimpsest import catalog
from palimpsest.functions.dialect import SPACE, java_regex
from palimpsest.functions.expr import apply_sql, let, sql_text
from palimpsest.functions.paths import path_order
from palimpsest.functions.rules import active_rules, scan_rules
from palimpsest.functions.urls import allowed_sql
from palimpsest.policy import Policy
from palimpsest.session import checkpointed

#: Stands for a whole placeholder while scanning; in no rule's alphabet.
MASK = "￼"
PLACEHOLDER = r"\[[A-Z_]+(?::[^\[\]]*)?\]"

_LEFT = r"(?:(?<=([\s\S]))|(?<![\s\S]))"
_RIGHT = r"(?=([\s\S]{0,80}))"
_TRIMMED = rf"^[{SPACE}]+|[{SPACE}]+$"


def mask_placeholders(text: Column) -> Column:
    """Matches inside a placeholder do not count: hide them first."""
    return F.regexp_replace(text, PLACEHOLDER, MASK)


def _in(value: str, options) -> str:
    return f"{value} IN ({', '.join(sql_text(o) for o in options)})"


def _like(value: str, pattern: str) -> str:
    return f"rlike({value}, {sql_text(pattern)})"


# False positives per rule, as SQL over the match ``x.m``, the character before
# it ``x.l`` and the text after it ``x.r``.

def url_false_positive(policy: Policy) -> str:
    """A bare scheme, or an allowed host in a URL without any bracket."""
    plain = f"NOT {_like('x.m', rf'[\[\]{MASK}]')}"
    return f"({_in('x.m', catalog.BARE_SCHEMES)} OR ({plain} AND {allowed_sql('x.m', policy.url_domains)}))"


def email_false_positive(policy: Policy) -> str:
    """An escape or bracket before it, a one-letter name, or a domain that looks like code."""
    first_label = "lower(substring_index(split_part(x.m, '@', 2), '.', 1))"
    return (f"({_in('x.l', [chr(92), '@', '[', MASK])} OR length(substring_index(x.m, '@', 1)) <= 1 "
            f"OR {_in(first_label, catalog.CODE_LIKE_DOMAINS)})")


def name_false_positive(policy: Policy) -> str:
    """A JSON key, or one of our own placeholders."""
    key = _like("substring(x.r, 1, 8)", java_regex(r'^"\s*:'))
    return f"((x.l = '\"' AND {key}) OR startswith(x.m, '[PRIVATE_') OR startswith(x.m, 'PRIVATE_'))"


def api_key_false_positive(policy: Policy) -> str:
    """Placeholders, type names, identifiers, and values without twelve characters, a letter and a digit."""
    value = (f"regexp_replace(regexp_replace(regexp_replace(x.m, '^[^:=]*[:=]', ''), {sql_text(_TRIMMED)}, ''), "
             + sql_text("""^["']+|["']+$""") + ", '')")
    identifier = java_regex(rf"\A(?:{catalog.IDENTIFIER_VALUE})\z")
    secret = f"(length(v) >= 12 AND {_like('v', '[A-Za-z]')} AND {_like('v', chr(92) + 'p{Nd}')})"
    harmless = (f"contains(x.m, '{MASK}') OR contains(x.m, '[SECRET:') OR contains(x.m, '[REDACTED:') OR x.l = '[' "
                f"OR {_in('v', catalog.NON_SECRET_VALUES)} OR startswith(v, '<') OR startswith(v, 'str') "
                f"OR {_like('v', '^[*]*$')} OR {_like('v', identifier)} OR NOT {secret}")
    return f"transform(array({value}), v -> {harmless})[0]"


def ipv4_false_positive(policy: Policy) -> str:
    return "(startswith(x.m, '0.0.0.') OR x.m = '127.0.0.1')"


def ipv6_false_positive(policy: Policy) -> str:
    """Clock times, and groups without a letter in a group of two and more."""
    clock = _like("x.m", java_regex(r"\A\d{1,4}(?::\d{1,4})+\z"))
    return f"({clock} OR NOT exists(split(x.m, ':'), g -> length(g) >= 2 AND {_like('g', '[a-fA-F]')}))"


def masked_field_false_positive(policy: Policy) -> str:
    return _like("x.m", rf'^"[A-Za-z_]+"[{SPACE}]*:[{SPACE}]*"{MASK}')


FALSE_POSITIVES = {
    "url": url_false_positive, "email": email_false_positive,
    "private_user_name": name_false_positive, "private_user_compound": name_false_positive,
    "api_key_field_value": api_key_false_positive,
    "ipv4": ipv4_false_positive, "ipv6": ipv6_false_positive,
    "encrypted_content_field": masked_field_false_positive, "thinking_signature_field": masked_field_false_positive,
}
_NEEDS_CONTEXT = {"email", "private_user_name", "private_user_compound", "api_key_field_value"}
_HIT = "array<struct<name:string,match:string>>"


def leftovers(text: Column, policy: Policy) -> Column:
    """``array<struct<name, match>>`` of one text; every rule on its own.

    With ``policy.compat`` nothing is masked; instead a match does not count
    if the last bracket before it is a ``[`` and a ``]`` follows within 80
    characters.
    """
    rules = scan_rules(policy)

    def step(rule):
        def found(pattern, group):
            return f"regexp_extract_all(v.text, {sql_text(pattern)}, {group})"
        if policy.compat or rule.category in _NEEDS_CONTEXT:
            pattern = _with_context(rule.pattern)
            last = len(re.findall(r"\((?!\?)", rule.pattern)) + 2
            parts = (f"zip_with(zip_with({found(pattern, 0)}, {found(pattern, 1)}, (m, l) -> named_struct('m', m, 'l', l)), "
                     f"{found(pattern, last)}, (x, r) -> named_struct('m', x.m, 'l', x.l, 'r', r))")
        else:
            parts = f"transform({found(rule.pattern, 0)}, m -> named_struct('m', m, 'l', '', 'r', ''))"
        if policy.compat:
            parts = _outside_brackets(parts, f"split(v.text, {sql_text(rule.pattern)}, -1)")
        drop = FALSE_POSITIVES.get(rule.category)
        if drop:
            parts = f"filter({parts}, x -> NOT {drop(policy)})"
        return f"concat(acc, transform({parts}, x -> named_struct('name', '{rule.category}', 'match', x.m)))"

    cases = " ".join(f"WHEN {r.ordinal} THEN {step(r)}" for r in rules)
    fold = f"v -> aggregate(v.active, cast(array() AS {_HIT}), (acc, no) -> CASE no {cases} ELSE acc END)"
    seen = text if policy.compat else mask_placeholders(text)
    return apply_sql(let(seen, lambda t: F.struct(t.alias("text"), active_rules(t, rules).alias("active"))), fold)


def _outside_brackets(parts: str, gaps: str) -> str:
    """Keep the matches that are not between a ``[`` and a ``]``.

    The last bracket before a match is looked for in the gap before it and in
    the match before that; matches without one in between inherit it, by
    filling runs in a string of marks.
    """
    before = "concat(CASE WHEN i > 0 THEN w.p[i - 1].m ELSE '' END, w.g[i])"
    bracket = f"regexp_extract(reverse({before}), {sql_text('[' + chr(92) + '[' + chr(92) + ']]')}, 0)"
    mark = f"CASE WHEN {bracket} = '' THEN '-' ELSE {bracket} END"
    fill = sql_text(r"(?:(?<=\[)|(?!^)\G)-")
    line = f"regexp_replace(array_join(transform(w.p, (x, i) -> {mark}), ''), {fill}, '[')"
    keep = ("filter(transform(w.p, (x, i) -> CASE WHEN NOT (substring(s, i + 1, 1) = '[' AND contains(x.r, ']')) THEN x END), "
            "x -> x IS NOT NULL)")
    return (f"transform(array(named_struct('p', {parts}, 'g', {gaps})), w -> "
            f"transform(array({line}), s -> {keep})[0])[0]")


def _with_context(pattern: str) -> str:
    """The same matches, with the character before and the text after in groups."""
    flags = re.match(r"(?:\(\?[a-z]+\))*", pattern)[0]
    return flags + _LEFT + "(?:" + pattern[len(flags):] + ")" + _RIGHT


def all_paths(records: DataFrame) -> DataFrame:
    """``rel_path`` of every file and of every folder above one."""
    parts = F.split("rel_path", "/")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(parts)),
                           lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    return records.select("rel_path").distinct().select(F.explode(prefixes).alias("rel_path")).distinct()


def scan(records: DataFrame, policy: Policy, col: str = "raw") -> DataFrame:
    """``(rel_path, place, name, match)``: what is left in contents and in path names."""
    paths = all_paths(records).select("rel_path", F.lit("path").alias("place"), F.col("rel_path").alias("text"))
    content = records.select("rel_path", F.lit("content").alias("place"), F.col(col).alias("text"))
    both = content.unionByName(paths)
    hits = both.select("rel_path", "place", F.explode(leftovers(F.col("text"), policy)).alias("h"))
    return hits.select("rel_path", "place", "h.name", "h.match")


def scan_summary(hits: DataFrame, policy: Policy) -> DataFrame:
    """``(name, matches, files, examples)`` for every rule, silent ones included.

    Hits are counted per file first; the five examples are the first paths in
    path order, picked per task before any shuffle.
    """
    # Read twice below; the scan behind it should run once.
    per_file = checkpointed(hits.groupBy("name", "rel_path").agg(
        F.count(F.lit(1)).alias("n"), F.max((F.col("place") == "path")).alias("in_path")))
    totals = per_file.groupBy("name").agg(F.sum("n").alias("matches"), F.count(F.lit(1)).alias("files"))
    first = W.partitionBy("name").orderBy(path_order(F.col("rel_path")))
    place = F.when(F.col("in_path"), "path").otherwise("content")
    examples = (per_file.withColumn("rn", F.row_number().over(first)).where(F.col("rn") <= 5)
                .groupBy("name").agg(F.sort_array(F.collect_list(F.struct(
                    "rn", F.concat("rel_path", F.lit(" ("), place, F.lit(")")).alias("e")))).alias("x"))
                .select("name", F.transform("x", lambda x: x["e"]).alias("examples")))
    names = hits.sparkSession.createDataFrame([(r.category,) for r in scan_rules(policy)], "name string")
    return (names.join(totals, "name", "left").join(examples, "name", "left")
            .select("name", F.coalesce("matches", F.lit(0)).alias("matches"),
                    F.coalesce("files", F.lit(0)).alias("files"),
                    F.coalesce("examples", F.array().cast("array<string>")).alias("examples")))


def gate(summary: DataFrame) -> DataFrame:
    """One row: did anything survive?"""
    return summary.agg((F.coalesce(F.sum("matches"), F.lit(0)) > 0).alias("failed"))
