"""Mixing of sources to target weights by a splitting tree.

Sources share ``ratio`` times the words of all documents by weight; no target
exceeds ``limit`` times its source, and what is over is shared again by weight.
Documents of a source lie in blocks of about ``block_words`` words.  A target
of 1.3 times the source means one whole pass and 0.3 of another one: the blocks
of that pass are permuted, whole blocks are drawn in that order, and of the
last one single documents, so that a source misses its target by less than
one document.  No document is drawn more often than ``ceil(target / size)``.

Which output shard gets which blocks is drawn by a tree: the root holds how
many blocks each source gives, and every node splits these quotas between its
two halves by a multivariate hypergeometric draw, so every shard has the mix it
would have if all blocks were shuffled.  A shard takes the next blocks of each
source's permuted sequence; shards are disjoint and only shuffle locally.

The driver sees one row per source and the quotas of (source, shard), never
documents or blocks.  All randomness comes from the seed, so reruns agree.

Null texts have no words.  A null source is a source of its own, the last one.
Rows are told apart by id and text: only those with the same of both are drawn alike.
Sources without words have target 0.  A long text is one document, however long; texts are
read, never cut.  Columns of the input named like added ones are replaced, all others kept.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from palimpsest.llm.common import hashed, n_words
from palimpsest.session import materialized

WEIGHTS = (5, 2, 1)
RATIO = 1.5
LIMIT = 2
BLOCK_WORDS = 100_000
SHARD_WORDS = 8_000_000
SEED = 20240
#: Rows (some 50 bytes each) up to which a table counted before is broadcast.
BROADCAST_ROWS = 50_000


#: Columns that are added to the rows; columns of the input with these names are replaced.
_DRAWN = ("size", "source_size", "target", "block", "shards")


def targets(sizes: DataFrame, weights=WEIGHTS, ratio: float = RATIO, limit: int = LIMIT) -> DataFrame:
    """Adds weight, cap, target to (source, source_size).  The windows see one row per source."""
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (((F.row_number().over(by_name)) - 1) % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * limit)
    # Sources reach their cap in the order of cap per weight: an exact form of sharing the excess again and again.
    order = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    rest = order.rowsBetween(W.currentRow, W.unboundedFollowing)
    rows = (rows.withColumn("_demand", F.sum("source_size").over(W.partitionBy(F.lit(1))) * F.lit(float(ratio)))
            .withColumn("_level", (F.col("_demand") - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(rest))
            .withColumn("_place", F.row_number().over(order)))
    free = F.when(F.col("cap") > F.col("_level") * F.col("weight"), F.struct("_place", "_level"))
    rows = rows.withColumn("_free", F.min(free).over(W.partitionBy(F.lit(1))))
    target = F.when(F.col("_free").isNull() | (F.col("_place") < F.col("_free._place")), F.col("cap").cast("double")).otherwise(
        F.col("_free._level") * F.col("weight"))
    return rows.select("source", "source_size", "weight", target.alias("target"))


def split_quotas(quotas: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Blocks of every source for every shard, shape (shards, sources)."""
    rng = np.random.default_rng(seed)
    out = np.zeros((shards, len(quotas)), dtype=np.int64)
    stack = [(0, shards, np.asarray(quotas, dtype=np.int64))]
    while stack:
        low, high, have = stack.pop()
        if high - low == 1:
            out[low] = have
            continue
        middle = (low + high) // 2
        total = int(have.sum())
        # the left half gets its share of the blocks; one left over falls to a random side
        share = total * (middle - low) // (high - low)
        if total * (middle - low) % (high - low):
            share += int(rng.integers(0, 2))
        left = rng.multivariate_hypergeometric(have, share, method="marginals")
        stack += [(middle, high, have - left), (low, middle, left)]
    return out


def _joined(rows: DataFrame, table: DataFrame, keys: list[str], n_table: int) -> DataFrame:
    table = F.broadcast(table) if n_table <= BROADCAST_ROWS else table
    on = None
    for k in keys:
        same = rows[k].eqNullSafe(table[f"_{k}"])
        on = same if on is None else on & same
    return rows.join(table, on, "left").drop(*[f"_{k}" for k in keys])


def draws(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          weights=WEIGHTS, ratio: float = RATIO, limit: int = LIMIT, block_words: int = BLOCK_WORDS,
          shard_words: int = SHARD_WORDS, seed: int = SEED) -> DataFrame:
    """``docs`` with size, source_size, target, block and shards: the output shard of every copy drawn."""
    spark = docs.sparkSession
    kept = [c for c in docs.columns if c.lower() not in _DRAWN]
    # The caller's columns travel as one, so that none is taken for a column of this operator.
    row = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(row, n_words(f"`{text_col}`").alias("size"), F.col(f"`{source_col}`").cast("string").alias("_source"),
                       hashed(F.lit(seed), F.col(f"`{id_col}`"), F.md5(text.cast("binary"))).alias("_key"))
    own = [F.col("_row").getField(c).alias(c) for c in kept]
    slim = materialized(rows.select("_source", "_key", "size"))       # texts are read once for this, once for the result
    sizes = slim.groupBy(F.col("_source").alias("source")).agg(F.sum("size").alias("source_size"))
    per_source = targets(sizes, weights, ratio, limit).withColumn(
        "n_blocks", F.greatest(F.lit(1), F.ceil(F.col("source_size") / block_words)))
    known = per_source.collect()                                      # one row per source
    if not known:
        return rows.select(*own, "size", F.lit(0).cast("bigint").alias("source_size"),
                           F.lit(0.0).alias("target"), F.lit(0).cast("bigint").alias("block"),
                           F.array().cast("array<int>").alias("shards"))
    sources = spark.createDataFrame(
        [(r.source, r.source_size, r.target, r.n_blocks) for r in known],
        "__source string, source_size bigint, target double, n_blocks bigint")
    slim, rows = (_joined(x, sources, ["_source"], len(known)).withColumn("block", F.pmod(F.col("_key"), F.col("n_blocks")))
                  for x in (slim, rows))

    # Permuted blocks with the words before them; one row per block, not per document.
    blocks = slim.groupBy("_source", "block").agg(F.sum("size").alias("words"), F.first("source_size").alias("s"), F.first("target").alias("t"))
    permuted = W.partitionBy("_source").orderBy(hashed(F.lit(seed), F.lit("block"), F.col("_source"), F.col("block")), "block")
    blocks = (blocks.withColumn("place", F.row_number().over(permuted) - 1)
              .withColumn("_end", F.sum("words").over(permuted.rowsBetween(W.unboundedPreceding, W.currentRow)))
              .withColumn("_n", F.count(F.lit(1)).over(W.partitionBy("_source")))
              .withColumn("passes", F.when(F.col("s") > 0, F.floor(F.col("t") / F.col("s"))).otherwise(F.lit(0)))
              .withColumn("rest", F.col("t") - F.col("passes") * F.col("s"))
              .withColumn("_start", F.col("_end") - F.col("words")))
    blocks = blocks.select(
        F.col("_source").alias("__source"), F.col("block").alias("_block"), "place", "passes", F.col("_n").alias("n"),
        (F.col("_end") <= F.col("rest")).alias("whole"),
        F.when((F.col("_start") < F.col("rest")) & (F.col("_end") > F.col("rest")), F.col("rest") - F.col("_start")).alias("part"))
    quotas = blocks.groupBy("__source").agg(
        F.sum(F.col("passes") + (F.col("whole") | F.col("part").isNotNull()).cast("int")).alias("quota"), F.count(F.lit(1)).alias("n")).collect()
    names = [r["__source"] for r in quotas]
    n_blocks = sum(r["n"] for r in quotas)
    demand = sum(r.target for r in known)
    n_shards = max(1, int(np.ceil(demand / shard_words)))
    tree = split_quotas(np.array([int(r["quota"]) for r in quotas]), n_shards, seed)
    ends = np.cumsum(tree, axis=0).T
    quota_table = spark.createDataFrame([(s, e.tolist()) for s, e in zip(names, ends)], "___source string, ends array<bigint>")
    blocks = _joined(blocks, quota_table, ["__source"], len(names))

    # A block drawn in pass k stands at k * n + place of its source's sequence; the shard is the range it falls in.
    at = "size(filter(ends, e -> e <= k * n + place))"
    blocks = blocks.withColumn("full", F.expr(
        f"transform(sequence(0, cast(passes + if(whole or part is not null, 1, 0) as int)), k -> cast({at} as int))")).withColumn(
        "full", F.expr("slice(full, 1, cast(passes + if(whole or part is not null, 1, 0) as int))"))
    rows = _joined(rows, blocks.select("__source", "_block", "full", "part"), ["_source", "block"], n_blocks)

    # The one block of a source that is drawn in part: its documents in the order of their keys, as long as they lie
    # nearer in than out.  They are a run of keys, so the largest key of each source says which they are.
    partly = blocks.where("part is not null").select("__source", "_block", "part")
    inside = W.partitionBy("_source").orderBy("_key")
    cut = (_joined(slim, partly, ["_source", "block"], len(names)).where("part is not null")
           .groupBy("_source", "_key").agg(F.sum("size").alias("size"), F.first("part").alias("part"))
           .withColumn("_end", F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, W.currentRow)))
           .where(F.col("_end") - F.col("size") / 2 <= F.col("part"))
           .groupBy(F.col("_source").alias("__source")).agg(F.max("_key").alias("cut")))
    rows = _joined(rows, cut, ["_source"], len(known))
    left_out = F.col("part").isNotNull() & ~F.coalesce(F.col("_key") <= F.col("cut"), F.lit(False))
    shards = F.when(left_out, F.slice("full", F.lit(1), F.size("full") - 1)).otherwise(F.col("full"))
    return rows.select(*own, "size", "source_size", "target", "block", shards.alias("shards"))


def dealt(drawn: DataFrame, id_col: str = "doc_id", seed: int = SEED) -> DataFrame:
    """One row per copy of the rows of :func:`draws`, with copy and shard; rows of a shard are together and shuffled."""
    own = [c for c in drawn.columns if c.lower() not in ("copy", "shard", "shards")]
    copies = drawn.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("_row"), F.posexplode("shards").alias("copy", "shard"))
    order = hashed(F.lit(seed), F.col("shard"), F.col("copy"), F.col("_row").getField(id_col))
    return (copies.repartition("shard").withColumn("_order", order).sortWithinPartitions("shard", "_order")
            .select(*[F.col("_row").getField(c).alias(c) for c in own], "copy", "shard"))


def mix(docs: DataFrame, id_col: str = "doc_id", seed: int = SEED, **options) -> DataFrame:
    """One row per copy drawn: the columns of ``docs``, copy and shard; rows of a shard are together and shuffled."""
    drawn = draws(docs, id_col, seed=seed, **options)
    own = [c for c in docs.columns if c.lower() not in (*_DRAWN, "copy", "shard")]
    return dealt(drawn.select(*[F.col(f"`{c}`") for c in own], "shards"), id_col, seed)
