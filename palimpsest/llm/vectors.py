"""Nearest neighbours of vectors by a permutation index.

``PIVOTS`` vectors (a bounded sample, drawn by a hash of the vector) serve as
landmarks.  A vector is represented by its ``PREFIX`` nearest pivots in order
and posted in the inverted files of these pivots with the place each has.  A
query goes through the files of its own pivots and adds up how far the places
agree, which orders all rows by Spearman's footrule distance over the query's
pivots (a pivot that a row lacks stands behind its last).  Of every block the
``SHARE`` nearest by footrule (ties included) are compared exactly.

Rows lie in blocks of at most ``BLOCK``, each with inverted files of its own,
and meet the queries block by block, so a task's memory does not depend on the
table.  The work is (queries x rows), as a stated query set against all rows.

Nearness is the largest inner product, in double precision.  Vectors that are
null, zero, of another length than most, or hold null or non-finite components
take no part, nor do rows without an id.  Repeated rows and equal vectors are
candidates like others; ties go to the smaller id.  With fewer candidates than
asked for, all are returned.  An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from palimpsest.session import materialized

PIVOTS, PREFIX, SHARE, BLOCK = 256, 64, 0.45, 16384


def valid_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(row, id, vector): what takes part, with vectors as doubles; row numbers are fixed by writing the table."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), v.alias("vector")).where(
        F.col("id").isNotNull() & F.col("vector").isNotNull() & finite & F.exists("vector", lambda x: x != 0))
    rows = materialized(rows.withColumn("row", F.monotonically_increasing_id()))
    length = rows.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    return rows.where(F.size("vector") == (length["length"] if length else 0))


def _matrix(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def prefixes(vectors: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """The nearest pivots of each vector, nearest first; ties to the smaller pivot."""
    return np.argsort(-(vectors @ pivots.T), axis=1, kind="stable")[:, :length].astype(np.int16)


class InvertedFiles:
    """For each pivot the rows of a block that have it among their nearest, and at which place."""

    def __init__(self, prefix: np.ndarray, n_pivots: int):
        self.rows, length = prefix.shape
        order = np.argsort(prefix.ravel(), kind="stable")
        self.starts = np.searchsorted(prefix.ravel()[order], np.arange(n_pivots + 1))
        self.row, self.place = order // length, (order % length).astype(np.int64)
        self.missing = length

    def agreement(self, query: np.ndarray) -> np.ndarray:
        """Largest possible footrule minus footrule, for all rows of the block."""
        out = np.zeros(self.rows, dtype=np.int64)
        for place, pivot in enumerate(query.tolist()):
            low, high = self.starts[pivot], self.starts[pivot + 1]
            out[self.row[low:high]] += (self.missing - place) - np.abs(self.place[low:high] - place)
        return out


def search(df: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding", pivots: int = PIVOTS,
           prefix: int = PREFIX, share: float = SHARE, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, id, score): of every row for which ``is_query`` (a condition on ``id``) holds the k nearest others."""
    spark = df.sparkSession
    rows = valid_vectors(df, id_col, vector_col)
    n = rows.count()
    n_blocks = max(1, -(-n // block))
    picked = rows.select("vector").distinct().orderBy(F.xxhash64("vector"), "vector").limit(pivots).collect()
    landmarks = np.array([r["vector"] for r in picked], dtype=np.float64)
    shared = spark.sparkContext.broadcast(landmarks)
    length = min(prefix, len(picked))

    def pack(key, rows):                                              # one row per block
        table = pa.concat_tables([rows]) if isinstance(rows, pa.Table) else rows
        x = _matrix(table.column("vector")).astype(np.float64)
        near = prefixes(x, shared.value, length)
        return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "row": [table.column("row").to_numpy().astype(np.int64).tobytes()],
                         "id": [table.column("id").to_numpy().astype(np.int64).tobytes()], "x": [x.tobytes()], "near": [near.tobytes()]},
                        schema=pa.schema([("block", pa.int64()), ("row", pa.binary()), ("id", pa.binary()), ("x", pa.binary()), ("near", pa.binary())]))

    kind = "block bigint, row binary, id binary, x binary, near binary"
    numbered = rows.withColumn("_n", F.pmod(F.xxhash64("row"), F.lit(n_blocks)))
    blocks = numbered.groupBy(F.col("_n").alias("block")).applyInArrow(pack, kind)
    asked = rows.where(is_query)
    asked = asked.withColumn("_n", F.pmod(F.xxhash64("row"), F.lit(max(1, n_blocks // 4))))
    queries = asked.groupBy(F.col("_n").alias("block")).applyInArrow(pack, kind)
    queries = queries.select(*[F.col(c).alias(f"q_{c}") for c in ("row", "id", "x", "near")],
                             F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_blocks - 1).cast("bigint"))).alias("block"))

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                row, id_ = np.frombuffer(r["row"], np.int64), np.frombuffer(r["id"], np.int64)
                x = np.frombuffer(r["x"]).reshape(len(row), -1)
                files = InvertedFiles(np.frombuffer(r["near"], np.int16).reshape(len(row), -1), len(shared.value))
                q_row, q_id = np.frombuffer(r["q_row"], np.int64), np.frombuffer(r["q_id"], np.int64)
                q_x, q_near = np.frombuffer(r["q_x"]).reshape(len(q_row), -1), np.frombuffer(r["q_near"], np.int16).reshape(len(q_row), -1)
                take = min(len(row), max(k + 1, int(np.ceil(share * len(row)))))
                out = []
                for i in range(len(q_row)):
                    agreement = files.agreement(q_near[i])
                    least = np.partition(agreement, len(row) - take)[len(row) - take]
                    found = np.flatnonzero((agreement >= least) & (row != q_row[i]))
                    score = x[found] @ q_x[i]
                    if len(found) > k:
                        kth = np.partition(score, len(found) - k)[len(found) - k]
                        found, score = found[score >= kth], score[score >= kth]
                    best = np.lexsort((id_[found], -score))[:k]
                    out.append((np.full(len(best), q_row[i]), np.full(len(best), q_id[i]), id_[found[best]], score[best]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=["q_row", "query_id", "id", "score"])

    joined = queries.join(blocks, "block")
    near = joined.mapInArrow(run, "q_row bigint, query_id bigint, id bigint, score double")
    rank = F.row_number().over(W.partitionBy("q_row").orderBy(F.desc("score"), "id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")
