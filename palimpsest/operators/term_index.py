"""Private terms by the hundred thousand: a token trie instead of an alternation.

A term may only begin and end where no ASCII letter, digit or ``_`` continues
it.  Cut into tokens (runs of those characters, and every other character by
itself), a text therefore holds a term exactly where the term's tokens follow each
other.  The tokens of all terms form a trie; looking a text up costs one dictionary
access per token and the depth of the trie where a term begins, however many terms
there are.  As in the alternation of the rule ``private_term`` matches are taken from
left to right and, where several terms begin, the first in the list's order.

The trie is broadcast and its size checked.  Lists beyond :data:`MAX_BYTES` are joined
instead (:func:`redact_terms_joined`): runs of tokens of the terms' lengths are looked up in
the term table, filtered by a bit table first, so nothing grows on the driver.
"""

from __future__ import annotations

import re
import sys
from dataclasses import dataclass, replace

import pandas as pd
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest import catalog
from palimpsest.functions.expr import fresh, let
from palimpsest.functions.redact import HITS_TYPE, redacted_with_hits
from palimpsest.functions.rules import Rule, active_rules, redaction_rules
from palimpsest.operators.joins import maybe_in
from palimpsest.policy import Policy

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Characters of all terms that may be broadcast as a trie (some 15 times that in a worker's memory).
MAX_BYTES = 32 << 20
#: The rule that the index takes over.
CATEGORY = "private_term"
REPLACEMENT = dict((c, r) for c, _, r in catalog.REDACTION_RULES)[CATEGORY]

# Letters that a case-insensitive [A-Z] takes as well, and letters with two small forms.
_ODD, _ODD_SMALL = "İK", "ik"
_TWO, _ONE = "ıſςµ", "isσμ"
_TOKEN = rf"[A-Za-z0-9_{_ODD}ıſ]+|[^A-Za-z0-9_{_ODD}ıſ]"
_FIND = re.compile(_TOKEN, re.S)
_FOLD = str.maketrans(_TWO, _ONE)
_FOLD_FIRST = str.maketrans(_ODD, _ODD_SMALL)


def folded(text: str) -> str:
    """Without case."""
    return text.translate(_FOLD_FIRST).lower().translate(_FOLD)


def folded_column(text: Column) -> Column:
    return F.translate(F.lower(F.translate(text, _ODD, _ODD_SMALL)), _TWO, _ONE)


def _is_run(token: str) -> bool:
    return len(token) > 1 or bool(re.match(rf"[A-Za-z0-9_{_ODD}ıſ]", token))


def trie_of(terms: list[str]) -> tuple[dict, dict, set]:
    """Steps ``(node, token) -> node``, per node the rank of the term that ends there, and all first tokens.

    Plain containers: a worker reads the broadcast without this package.
    """
    steps: dict[tuple[int, str], int] = {}
    ends: dict[int, int] = {}
    first: set[str] = set()
    for rank, term in enumerate(terms):
        tokens = [folded(t) for t in _FIND.findall(term)]
        node = 0
        for token in tokens:
            node = steps.setdefault((node, token), len(steps) + 1)
        if tokens:
            first.add(tokens[0])
            ends.setdefault(node, rank)
    return steps, ends, first


def replaced_by(trie: tuple[dict, dict, set], text: str) -> tuple[str, int]:
    """The text with the trie's terms replaced, and their number."""
    steps, ends, first = trie
    tokens = _FIND.findall(text)
    # most texts hold no first token at all
    if first.isdisjoint(map(folded, set(tokens))):
        return text, 0
    out, i, n, size = [], 0, 0, len(tokens)
    known, runs = [folded(t) for t in tokens], [_is_run(t) for t in tokens]
    while i < size:
        node, best, end, j = 0, None, 0, i
        # no run may stand directly before or behind a term, also where the term itself has another character there
        while j < size and not (i and runs[i - 1]) and (node := steps.get((node, known[j]))) is not None:
            j += 1
            rank = ends.get(node)
            if rank is not None and (best is None or rank < best) and not (j < size and runs[j]):
                best, end = rank, j
        if best is None:
            out.append(tokens[i])
            i += 1
        else:
            out.append(REPLACEMENT)
            n, i = n + 1, end
    return ("".join(out), n) if n else (text, 0)


@dataclass(frozen=True)
class TermIndex:
    """A broadcast trie, and the policy whose rules for identifiers and domains know the terms tied to the identity."""

    trie: Broadcast
    policy: Policy
    size: int


def ordered_terms(terms: DataFrame, policy: Policy) -> DataFrame:
    """``(term, rank..)`` of three and more characters in list order: long ones first, the names of the policy last."""
    own = [(t, i) for i, t in enumerate(policy.terms)]
    names = terms.sparkSession.createDataFrame(own or [("", 0)], "term string, place int").where("term <> ''")
    both = terms.select("term", F.lit(-1).alias("place")).unionByName(names).where(F.length("term") >= 3)
    return both.groupBy("term").agg(F.min("place").alias("place"))


def _sorted(terms: DataFrame) -> DataFrame:
    listed = F.col("place") < 0
    return terms.orderBy(~listed, F.when(listed, -F.length("term")), F.when(listed, F.lower("term")), "place", "term")


def embedded(terms: DataFrame, policy: Policy) -> list[str]:
    """Terms tied to the identity, without those that only add letters or digits to another one."""
    names = [n.lower() for n in (policy.user, policy.home_name) if n]
    low = F.lower("term")
    tied = F.lit(False)
    for n in names:
        tied = tied | F.contains(low, F.lit(n)) | F.contains(F.lit(n), low)
    found = terms.where((F.length("term") >= 4) & tied)
    short = [n for n in names if len(n) >= 4]
    for n in short:          # a run of letters and digits around a name is found by the name
        found = found.where((low == n) | ~(F.contains(low, F.lit(n)) & F.col("term").rlike("^[A-Za-z0-9]+$")))
    return [r["term"] for r in _sorted(found).select("term").collect()]


def is_indexable(terms: DataFrame) -> bool:
    """Small enough to be broadcast."""
    return (terms.agg(F.sum(F.octet_length("term"))).head()[0] or 0) <= MAX_BYTES


def term_index(terms: DataFrame, policy: Policy) -> TermIndex:
    """Index of ``terms(term)`` and the policy's own terms; refuses lists beyond :data:`MAX_BYTES`."""
    spark = terms.sparkSession
    known = ordered_terms(terms, policy).persist()
    try:
        if not is_indexable(known):
            raise ValueError(f"more than {MAX_BYTES} bytes of terms; use redact_terms_joined")
        listed = [r["term"] for r in _sorted(known).select("term").collect()]           # MAX_BYTES at most
        tied = embedded(known, policy)
    finally:
        known.unpersist()
    return TermIndex(spark.sparkContext.broadcast(trie_of(listed)), replace(policy, private_terms=tuple(tied)), len(listed))


def replace_terms(texts: Column, index: TermIndex) -> Column:
    """``array<struct<text, n>>`` for ``array<string>``: every string with its terms replaced; null stays null."""
    trie = index.trie

    @F.pandas_udf("array<struct<text:string,n:bigint>>")
    def replaced(rows: pd.Series) -> pd.Series:
        known = trie.value
        return pd.Series([None if row is None else [
            {"text": None, "n": 0} if t is None else dict(zip(("text", "n"), replaced_by(known, t))) for t in row] for row in rows], dtype=object)

    # Keeps the optimizer from copying the call into other expressions.
    return replaced.asNondeterministic()(texts)


def around_terms(policy: Policy) -> tuple[list[Rule], list[Rule]]:
    """The rules before and after the one that the index takes over."""
    rules = redaction_rules(policy)
    place = [c for c, _, _ in catalog.REDACTION_RULES].index(CATEGORY) + 1
    return [r for r in rules if r.ordinal < place], [r for r in rules if r.ordinal > place]


def term_hits(n: Column) -> Column:
    """Hits as the rule would report them."""
    hit = F.struct(F.lit(CATEGORY).alias("category"), n.cast("bigint").alias("n"), F.array().cast("array<string>").alias("values"))
    return F.when(n > 0, F.array(hit)).otherwise(F.array().cast(HITS_TYPE))


def redact_strings(df: DataFrame, strings: Column, out: str, index: TermIndex, active: Column | None = None) -> DataFrame:
    """Adds ``out``: ``array<struct<text, hits>>`` with all rules on every string; null stays null.

    Earlier rules, the terms, later rules; one guard test for all strings of the row.
    """
    before, after = around_terms(index.policy)
    row, start, step = (fresh(df, c) for c in ("_row", "_start", "_step"))
    if active is None:
        active = active_rules(F.array_join(strings, "\n"), before + after)
    df = df.withColumn(row, F.struct(strings.alias("s"), active.alias("a")))
    df = df.withColumn(start, let(F.col(row), lambda r: F.transform(r["s"], lambda s: F.when(
        s.isNotNull(), redacted_with_hits(s, index.policy, before, r["a"])))))
    df = df.withColumn(step, replace_terms(F.transform(start, lambda x: x["text"]), index))
    # The first step is named again below: otherwise the optimizer moves it into the call, from which it would not come out.
    both = F.struct(F.col(row)["a"].alias("a"), F.col(start).alias("x"), F.col(step).alias("y"))

    def last(b):
        def one(x, y):
            found = redacted_with_hits(F.coalesce(y["text"], x["text"]), index.policy, after, b["a"])
            return F.when(x.isNotNull(), let(found, lambda f: F.struct(
                f["text"].alias("text"), F.concat(x["hits"], term_hits(y["n"]), f["hits"]).alias("hits"))))
        return F.zip_with(b["x"], b["y"], one)
    return df.withColumn(out, F.when(F.col(start).isNotNull(), let(both, last))).drop(row, start, step)


def redact_terms_joined(df: DataFrame, ids: list[str], col: str, terms: DataFrame, policy: Policy) -> DataFrame:
    """The rule ``private_term`` alone, for lists of any size; ``ids`` must be unique and adds ``n_terms``.

    Every run of tokens that is as long as some term and whose hash is in the bit table of the terms is
    joined with them.  A row's matches are then chosen from left to right.
    """
    known = ordered_terms(terms, policy)
    listed = F.col("place") < 0
    known = known.select(
        folded_column(F.col("term")).alias("_term"), F.size(F.regexp_extract_all("term", F.lit(_TOKEN), F.lit(0))).alias("_length"),
        F.struct((~listed).alias("own"), F.when(listed, -F.length("term")).alias("chars"), F.when(listed, F.lower("term")).alias("low"),
                 "place", "term").alias("_rank")).groupBy("_term", "_length").agg(F.min("_rank").alias("_rank"))
    known = known.withColumn("_hash", F.xxhash64("_term"))
    lengths = sorted(r[0] for r in known.select("_length").distinct().collect())        # numbers of tokens in a term: a few
    tokens = F.regexp_extract_all(F.col(col), F.lit(_TOKEN), F.lit(0))
    run = rf"^[A-Za-z0-9_{_ODD}ıſ]"

    def starts(t):
        """Places, with the folded run of each length, that no word character continues on either side."""
        def at(n):
            places = F.sequence(F.lit(0), F.size(t) - n)
            free = lambda i: ~F.coalesce(F.get(t, i).rlike(run), F.lit(False))
            fits = F.filter(places, lambda i: free(i - 1) & free(i + n))
            return F.when(F.size(t) >= n, F.transform(fits, lambda i: F.struct(
                i.alias("at"), F.lit(n).alias("length"), folded_column(F.array_join(F.slice(t, i + 1, n), "")).alias("term"))))
        return F.concat(*[F.coalesce(at(n), F.array().cast("array<struct<at:int,length:int,term:string>>")) for n in lengths])

    if not lengths:
        return df.withColumn("n_terms", F.lit(0).cast("bigint"))
    own = [F.col(f"`{i}`").alias(f"_id_{k}") for k, i in enumerate(ids)]
    names = [f"_id_{k}" for k in range(len(ids))]
    runs = df.select(*own, F.explode(let(tokens, starts)).alias("s")).select(*names, "s.at", "s.length", F.col("s.term").alias("_term"))
    runs = maybe_in(runs.withColumn("_hash", F.xxhash64("_term")), known, "_hash").drop("_hash")
    found = runs.join(known.select("_term", F.col("_length").alias("length"), "_rank"), ["_term", "length"])
    # A row's matches are bounded by its text.
    spans = found.groupBy(*names).agg(F.sort_array(F.collect_list(F.struct("at", "_rank", "length"))).alias("_spans"))
    start = F.struct(F.lit(0).alias("until"), F.array().cast("array<struct<at:int,length:int>>").alias("kept"))
    kept = F.aggregate("_spans", start, lambda acc, s: F.when(s["at"] < acc["until"], acc).otherwise(F.struct(
        (s["at"] + s["length"]).alias("until"), F.concat(acc["kept"], F.array(F.struct(s["at"].alias("at"), s["length"].alias("length")))).alias("kept"))))
    chosen = spans.select(*names, kept["kept"].alias("_kept"))
    on = [F.col(f"r.{i}").eqNullSafe(F.col(f"s.{n}")) for i, n in zip(ids, names)]
    both = F.struct(tokens.alias("t"), F.col("_kept").alias("k"))

    def woven(b):
        ends = F.concat(F.array(F.lit(0)), F.transform(b["k"], lambda s: s["at"] + s["length"]))
        gaps = F.zip_with(ends, F.concat(F.transform(b["k"], lambda s: s["at"]), F.array(F.size(b["t"]))),
                          lambda a, z: F.array_join(F.slice(b["t"], a + 1, z - a), ""))
        return F.array_join(gaps, REPLACEMENT)

    joined = df.alias("r").join(chosen.alias("s"), on, "left")
    out = joined.withColumn("_new", F.when(F.col("_kept").isNotNull(), let(both, woven)))
    return out.select(*[(F.coalesce("_new", F.col(f"r.`{c}`")) if c == col else F.col(f"r.`{c}`")).alias(c) for c in df.columns],
                      F.coalesce(F.size("_kept"), F.lit(0)).cast("bigint").alias("n_terms"))
