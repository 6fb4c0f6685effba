"""Corpus-wide ordinals of stable placeholders.

The row-local pass writes ``[CATEGORY:0000:digest]`` and collects the matched
values.  Here every value gets its place among the first appearances of its
category, and the placeholders get that number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.functions.redact import NO_ORDINAL, OPEN_PLACEHOLDER, digest
from palimpsest.operators.joins import lookup, ranked
from palimpsest.session import checkpointed


def stable_values(df: DataFrame, order: list[str], hits: str = "hits") -> DataFrame:
    """``(category, value, order.., hit_no, match_no)``: one row per stable match."""
    return (df.select(*order, F.posexplode(hits).alias("hit_no", "h"))
            .select(*order, "hit_no", F.col("h.category").alias("category"),
                    F.posexplode("h.values").alias("match_no", "value")))


def first_appearances(values: DataFrame, order: list[str]) -> DataFrame:
    """``(category, value, first, n)``: distinct values, reduced before the shuffle."""
    return values.groupBy("category", "value").agg(
        F.min(F.struct(*order)).alias("first"), F.count(F.lit(1)).alias("n"))


def assign_ordinals(values: DataFrame, order: list[str], salt: str = "",
                    keep_values: bool = False, known: DataFrame | None = None) -> DataFrame:
    """``dictionary(category, digest, ordinal, token, placeholder, n)``.

    ``token`` is what the row-local pass wrote (without the closing bracket),
    ``placeholder`` what it becomes.  Values that contain placeholders of
    earlier rules are digested with those placeholders in their final form.
    With a dictionary of ``known`` values only new ones come back, numbered
    after those of their category.
    """
    firsts = first_appearances(values, order).withColumn(
        "token", F.concat(F.lit("["), F.upper("category"), F.lit(f":{NO_ORDINAL}:"), digest(F.col("value"), salt)))
    if known is not None:
        firsts = firsts.join(known.select("token"), "token", "left_anti")
    ranks = ranked(firsts, ["category"], ["first"], "ordinal")
    if known is not None:
        highest = known.groupBy("category").agg(F.max("ordinal").alias("_highest"))        # a row per category of the rules
        ranks = (ranks.join(F.broadcast(highest), "category", "left")
                 .withColumn("ordinal", F.col("ordinal") + F.coalesce("_highest", F.lit(0))))
    entries = checkpointed(ranks.select("category", "value", "ordinal", "n", "token"))
    done = _finished(entries.where(~F.col("value").rlike(OPEN_PLACEHOLDER)), "value", salt)
    waiting = entries.where(F.col("value").rlike(OPEN_PLACEHOLDER))
    # A value can only hold placeholders of earlier rules, so depth is bounded
    # by the number of stable rules; most corpora need no round at all.
    while not waiting.isEmpty():
        names = done.select("token", "placeholder")
        if known is not None:
            names = names.unionByName(known.select("token", "placeholder"))
        numbered = number_placeholders(waiting.withColumn("final", F.col("value")), ["token"], "final", names)
        numbered = checkpointed(numbered)
        missing = F.col("final").rlike(OPEN_PLACEHOLDER)
        ready = numbered.where(~missing)
        done = checkpointed(done.unionByName(_finished(ready, "final", salt)))
        if ready.isEmpty():        # placeholders that were in the input already
            done = done.unionByName(_finished(numbered, "final", salt))
            break
        waiting = numbered.where(missing).drop("final")
    return done if keep_values else done.drop("value")


def _finished(entries: DataFrame, text: str, salt: str) -> DataFrame:
    hashed = digest(F.col(text), salt)
    number = F.col("ordinal").cast("string")
    padded = F.when(F.length(number) < 4, F.lpad(number, 4, "0")).otherwise(number)
    return entries.select("category", "value", hashed.alias("digest"), "ordinal", "n", "token",
                          F.concat(F.lit("["), F.upper("category"), F.lit(":"), padded, F.lit(":"), hashed).alias("placeholder"))


def number_placeholders(df: DataFrame, ids: list[str], col: str, dictionary: DataFrame) -> DataFrame:
    """Put ordinals into the placeholders of a text column; ``ids`` must be unique.

    Only placeholders travel: they are looked up, gathered per row and woven
    into the text.  Placeholders the dictionary does not know stay.
    """
    holds = F.col(col).rlike(OPEN_PLACEHOLDER)
    tokens = df.where(holds).select(*[F.col(i).alias(f"_id_{n}") for n, i in enumerate(ids)], F.posexplode(
        F.regexp_extract_all(F.col(col), F.lit(OPEN_PLACEHOLDER), F.lit(0))).alias("pos", "token"))
    renamed = dictionary.select(F.col("token"), F.col("placeholder"))
    named = lookup(tokens, renamed, "token", ["placeholder"])
    gathered = named.groupBy(*[f"_id_{n}" for n in range(len(ids))]).agg(F.transform(
        F.sort_array(F.collect_list(F.struct("pos", F.coalesce("placeholder", "token").alias("text")))),
        lambda x: x["text"]).alias("_texts"))
    on = [F.col(f"r.{i}") == F.col(f"g._id_{n}") for n, i in enumerate(ids)]
    joined = df.alias("r").join(gathered.alias("g"), on, "left")
    woven = F.when(F.col("_texts").isNull(), F.col(f"r.{col}")).otherwise(F.array_join(F.zip_with(
        F.split(F.col(f"r.{col}"), OPEN_PLACEHOLDER, -1), "_texts",
        lambda piece, text: F.concat(piece, F.coalesce(text, F.lit("")))), ""))
    return joined.select(*[woven.alias(c) if c == col else F.col(f"r.{c}") for c in df.columns])


def distinct_counts(dictionary: DataFrame) -> DataFrame:
    """Distinct values per category."""
    return dictionary.groupBy("category").agg(F.count(F.lit(1)).alias("n"))
