"""Redaction of one string as a Spark column expression.

The ordered catalog is folded over the text with ``aggregate``: the array it
runs over holds the numbers of the rules whose guard let them through, the
accumulator is the text so far.  Everything stays in the JVM and can be used
wherever a column can, also inside arrays, maps and structs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from palimpsest.functions.expr import apply_sql, sql_text
from palimpsest.functions.rules import Rule, active_rules, redaction_rules, word_literals
from palimpsest.functions.urls import allowed_sql
from palimpsest.policy import Policy

#: Ordinal written by the row-local pass; the corpus ordinal replaces it later.
NO_ORDINAL = "0000"
#: A stable placeholder without its closing bracket (a later rule may cut it off).
OPEN_PLACEHOLDER = r"\[([A-Z][A-Z0-9_]*):" + NO_ORDINAL + r":([0-9a-f]{10})"

HITS_TYPE = "array<struct<category:string,n:bigint,values:array<string>>>"


def digest(text: Column, salt: str = "") -> Column:
    """First ten hexadecimal digits of the SHA-256 of the text."""
    return F.substring(F.sha2(F.concat(F.lit(salt), text) if salt else text, 256), 1, 10)


def _placeholder_sql(tag: str, text: str, salt: str) -> str:
    salted = f"concat({sql_text(salt)}, {text})" if salt else text
    return f"concat('[{tag}:{NO_ORDINAL}:', substring(sha2({salted}, 256), 1, 10), ']')"


def _weave_sql(text: str, pattern: str, repl: str) -> str:
    """Replace every match by an expression over the match ``m``."""
    p = sql_text(pattern)
    return (f"array_join(zip_with(split({text}, {p}, -1), regexp_extract_all({text}, {p}, 0), "
            f"(g, m) -> concat(g, coalesce({repl}, ''))), '')")


def _replaced_sql(rule: Rule, policy: Policy, text: str) -> str:
    p = sql_text(rule.pattern)
    if not rule.stable:
        return f"regexp_replace({text}, {p}, {sql_text(rule.replacement)})"
    repl = _placeholder_sql(rule.tag, "m", policy.salt)
    if rule.category == "url" and policy.url_domains:
        repl = f"CASE WHEN {allowed_sql('m', policy.url_domains)} THEN m ELSE {repl} END"
    return f"CASE WHEN rlike({text}, {p}) THEN {_weave_sql(text, rule.pattern, repl)} ELSE {text} END"


def _fold_sql(rules, step, otherwise: str = "acc") -> str:
    def choice(some) -> str:
        """Halving: a chain of cases would compare a late rule's number with all before it."""
        if len(some) > 3:
            middle = len(some) // 2
            return f"if(no < {some[middle].ordinal}, {choice(some[:middle])}, {choice(some[middle:])})"
        cases = " ".join(f"WHEN {r.ordinal} THEN {step(r)}" for r in some)
        return f"CASE no {cases} ELSE {otherwise} END"
    rules = sorted(rules, key=lambda r: r.ordinal)
    return f"(acc, no) -> {choice(rules) if rules else otherwise}"


def _worth(text: Column, rules: list[Rule], active: Column) -> Column:
    """The rules of a row's guard, none for a plain word in which no rule can find anything (most JSON keys are)."""
    words = word_literals(rules)
    if words is None:
        return active
    plain = ~text.rlike("[^A-Za-z_]")
    if words:
        plain = plain & ~text.rlike("(?i)" + "|".join(words))
    return F.when(plain, F.array().cast("array<int>")).otherwise(active)


def redacted(text: Column, policy: Policy, rules: list[Rule] | None = None,
             active: Column | None = None) -> Column:
    """The text with every rule applied in order.

    ``active`` may pass the numbers of the rules to try, when several texts of
    a row share one guard test.
    """
    rules = redaction_rules(policy) if rules is None else rules
    fold = _fold_sql(rules, lambda r: _replaced_sql(r, policy, "acc"))
    return F.call_function("aggregate", active_rules(text, rules) if active is None else _worth(text, rules, active), text, F.expr(fold))


def redacted_with_hits(text: Column, policy: Policy, rules: list[Rule] | None = None,
                       active: Column | None = None) -> Column:
    """``struct<text, hits>``: the redacted text and what each rule found.

    A hit carries the count as seen by that rule (earlier rules have already
    run) and, for stable rules, the matched values in text order.
    """
    rules = redaction_rules(policy) if rules is None else rules

    def step(rule):
        found = f"regexp_extract_all(acc.text, {sql_text(rule.pattern)}, 0)"
        if rule.category == "url" and policy.url_domains:
            found = f"filter({found}, m -> NOT {allowed_sql('m', policy.url_domains)})"
        values = "f" if rule.stable else "cast(array() AS array<string>)"
        return (f"transform(array({found}), f -> CASE WHEN size(f) = 0 THEN acc ELSE named_struct("
                f"'text', {_replaced_sql(rule, policy, 'acc.text')}, 'hits', concat(acc.hits, array(named_struct("
                f"'category', {sql_text(rule.category)}, 'n', cast(size(f) AS bigint), 'values', {values})))) END)[0]")

    start = F.struct(text.alias("text"), F.array().cast(HITS_TYPE).alias("hits"))
    return F.call_function("aggregate", active_rules(text, rules) if active is None else _worth(text, rules, active),
                           start, F.expr(_fold_sql(rules, step)))


def raw_hits(text: Column, rules: list[Rule]) -> Column:
    """``array<struct<category, pos, value>>``: each rule on the text as it is."""
    kind = "array<struct<category:string,pos:bigint,value:string>>"

    def step(rule):
        return (f"concat(acc, transform(regexp_extract_all(v.text, {sql_text(rule.pattern)}, 0), (m, i) -> named_struct("
                f"'category', {sql_text(rule.category)}, 'pos', cast(i AS bigint), 'value', m)))")

    fold = f"v -> aggregate(v.active, cast(array() AS {kind}), {_fold_sql(rules, step)})"
    return apply_sql(F.struct(text.alias("text"), active_rules(text, rules).alias("active")), fold)
