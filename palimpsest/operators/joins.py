"""Joins and ranks that survive hot keys and large groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from palimpsest.session import checkpointed

#: Most frequent keys that are looked up without a shuffle; bounds the broadcast.
HOT_KEYS = 1000
#: Words of 64 bits of a row filter: at most so many rows (8 MB) are broadcast, whatever the input.
FILTER_WORDS = 1 << 18
#: Broadcast limit for tables whose size is counted first.
SMALL_ROWS = 10_000


def lookup(rows: DataFrame, table: DataFrame, key: str, values: list[str]) -> DataFrame:
    """Left join of ``rows`` with a table whose ``key`` is unique.

    The most frequent keys (at most ``HOT_KEYS``) are answered by a broadcast;
    their rows then travel under a spread-out key, so no task gets a hot key.
    """
    hot = rows.groupBy(key).count().orderBy(F.desc("count"), key).limit(HOT_KEYS).select(key)
    hot_table = table.join(F.broadcast(hot), key, "left_semi").select(
        key, F.struct(*values).alias("_hot")).limit(HOT_KEYS)
    spread = F.when(F.col("_hot").isNull(), F.col(key))
    first = rows.join(F.broadcast(hot_table), key, "left").withColumn("_key", spread)
    # Null keys never match; give them a random bucket instead of one task.
    first = first.withColumn("_bucket", F.when(F.col("_key").isNull(), (F.xxhash64(*rows.columns) % 4096)).otherwise(F.lit(0)))
    cold = table.select(F.col(key).alias("_key"), F.struct(*values).alias("_cold"), F.lit(0).cast("bigint").alias("_bucket"))
    joined = first.join(cold, ["_key", "_bucket"], "left")
    return joined.select(*[F.col(c) for c in rows.columns],
                         *[F.coalesce(F.col("_hot")[v], F.col("_cold")[v]).alias(v) for v in values])


def maybe_in(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Rows whose 64-bit ``key`` may be among those of ``wanted``: a bit table of fixed size, so the rest need not be shuffled.

    What slips through costs time only; the caller joins in full.
    """
    place = f"pmod({key}, {FILTER_WORDS * 64}L)"
    word, bit = F.expr(f"shiftright({place}, 6)"), f"cast({place} % 64 as int)"
    table = wanted.groupBy(word.alias("_word")).agg(F.bit_or(F.expr(f"shiftleft(1L, {bit})")).alias("_bits"))
    return (rows.withColumn("_word", word).join(F.broadcast(table), "_word")
            .where(F.expr(f"shiftrightunsigned(_bits, {bit}) & 1 = 1")).drop("_word", "_bits"))


def ranked(df: DataFrame, group: list[str], order: list[str], out: str) -> DataFrame:
    """``row_number`` within groups of any size, without one task per group.

    Rows are sorted by ranges over all tasks; a row's rank is its place in its
    task's run of the group plus the lengths of the group's earlier runs.
    """
    place = F.monotonically_increasing_id()
    run = F.shiftright(F.col("_place"), 33)
    rows = checkpointed(
        df.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order).withColumn("_place", place))
    runs = rows.groupBy(*group, run.alias("_run")).agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = W.partitionBy(*group).orderBy("_run").rowsBetween(W.unboundedPreceding, -1)
    # At most one row per group and task: groups x tasks, not data.
    starts = runs.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    return (rows.withColumn("_run", run).join(starts, [*group, "_run"])
            .withColumn(out, (F.col("_place") - F.col("_first") + F.col("_before") + 1).cast("bigint"))
            .drop("_place", "_run", "_first", "_before"))


def is_small(df: DataFrame, rows: int = SMALL_ROWS) -> bool:
    """At most ``rows`` rows; looks at one row more than that."""
    return df.limit(rows + 1).count() <= rows


def replace_column(df: DataFrame, name: str, value: Column) -> DataFrame:
    return df.select(*[value.alias(name) if c == name else F.col(c) for c in df.columns])
