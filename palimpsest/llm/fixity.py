"""Fixity audit of web archives with Merkle trees.

A record is (archive, offset, length, digest of its bytes).  Its leaf is the
byte range of ``RANGE`` bytes that its offset lies in; a range's hash covers
its records in order, and a parent's hash covers its up to ``FANOUT`` children
in order.  Because the geometry is fixed by offsets, any part of a tree can be
built by any task, trees of two replicas line up, and a group never holds more
records than fit into a range or more children than the fan-out.

The audit compares top nodes, descends into children of nodes that differ and
compares single records only in the ranges that are left.

Defined results: a null payload is an empty one; a null archive or offset is an
archive (offset) of its own; repeated equal records are part of the range's
hash, so a replica with another number of them differs (kind ``repeated``); an
empty replica lacks everything; two empty ones agree.  Ranges without records
have no node.  Columns beside those named are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from palimpsest.session import materialized

#: Bytes of a leaf's range, children of a node, levels above the leaves: tops cover 4 GB of offsets each.
RANGE = 1 << 16
FANOUT = 16
LEVELS = 4


def warc_record(url: Column, payload: Column) -> Column:
    """The bytes of a response record, as text."""
    body = F.coalesce(payload, F.lit(""))
    return F.concat(F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
                    F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body,
                    F.lit("\r\n\r\n"))


def lay_out(pages: DataFrame, per_archive: int = 1024) -> DataFrame:
    """Pages as records of archives: runs of ``per_archive`` page ids, one record behind the other.

    Returns archive, offset, length, digest, page_id.  Rows with equal ids lie in the order of their bytes.
    """
    record = warc_record(F.col("url").cast("string"), F.col("html").cast("string"))
    rows = pages.select((F.floor(F.col("page_id") / per_archive)).cast("bigint").alias("archive"), "page_id",
                        F.octet_length(record).cast("bigint").alias("length"), F.sha2(record.cast("binary"), 256).alias("digest"))
    behind = W.partitionBy("archive").orderBy("page_id", "digest").rowsBetween(W.unboundedPreceding, -1)
    return rows.withColumn("offset", F.coalesce(F.sum("length").over(behind), F.lit(0)))


def tree(records: DataFrame, levels: int = LEVELS, range_bytes: int = RANGE, fanout: int = FANOUT,
         group: tuple[str, ...] = ("replica", "archive")) -> list[DataFrame]:
    """Tables (group..., node, hash) from the leaves (0) to the tops."""
    at = F.floor(F.coalesce(F.col("offset"), F.lit(-1)) / range_bytes).cast("bigint")
    line = F.concat_ws(":", F.lpad(F.coalesce(F.col("offset"), F.lit(0)).cast("string"), 19, "0"), F.col("length").cast("string"), "digest")
    leaves = records.groupBy(*group, at.alias("node")).agg(
        F.sha2(F.concat_ws("\n", F.sort_array(F.collect_list(line))), 256).alias("hash"))
    out = [materialized(leaves)]
    for _ in range(levels):
        child = F.concat_ws(":", F.lpad(F.col("node").cast("string"), 19, "0"), "hash")
        out.append(out[-1].groupBy(*group, F.floor(F.col("node") / fanout).cast("bigint").alias("_up")).agg(
            F.sha2(F.concat_ws("\n", F.sort_array(F.collect_list(child))), 256).alias("hash")).withColumnRenamed("_up", "node"))
    return out


def _differing(level: DataFrame, above: DataFrame | None, fanout: int) -> DataFrame:
    """(archive, node) whose hashes differ or that one replica lacks; only children of ``above``'s nodes are looked at."""
    if above is not None:
        parents = above.select(F.col("archive").alias("_a"), F.col("node").alias("_n"))
        level = level.join(parents, level["archive"].eqNullSafe(F.col("_a")) & (F.floor(level["node"] / fanout) == F.col("_n")), "left_semi")
    return (level.groupBy("archive", "node").agg(
        F.max(F.when(F.col("replica") == 0, F.col("hash"))).alias("a"), F.max(F.when(F.col("replica") == 1, F.col("hash"))).alias("b"))
        .where(~F.col("a").eqNullSafe(F.col("b"))))


def audit(primary: DataFrame, replica: DataFrame, levels: int = LEVELS, range_bytes: int = RANGE,
          fanout: int = FANOUT) -> DataFrame:
    """Where the replica differs: archive, offset, kind, the digests of both sides, and the top nodes' hashes.

    Kinds: ``altered`` (other bytes or length), ``missing``, ``extra``, ``repeated`` (same bytes, other number of rows).
    Both tables need archive, offset, length, digest.
    """
    columns = ["archive", "offset", "length", "digest"]
    both = materialized(primary.select(F.lit(0).alias("replica"), *columns).unionByName(replica.select(F.lit(1).alias("replica"), *columns)))
    nodes = tree(both, levels, range_bytes, fanout)
    top = materialized(_differing(nodes[-1], None, fanout))
    left = top
    for level in reversed(nodes[:-1]):
        left = _differing(level, left, fanout)
    block = F.floor(F.coalesce(F.col("offset"), F.lit(-1)) / range_bytes).cast("bigint")
    suspects = left.select(F.col("archive").alias("_a"), F.col("node").alias("_n"))
    rows = both.withColumn("_block", block)
    rows = rows.join(suspects, rows["archive"].eqNullSafe(F.col("_a")) & (F.col("_block") == F.col("_n")), "left_semi")
    side = lambda n, f: F.sort_array(F.collect_list(F.when(F.col("replica") == n, f)))
    content = F.concat_ws(":", F.col("length").cast("string"), "digest")
    found = (rows.groupBy("archive", "offset", "_block").agg(side(0, content).alias("p"), side(1, content).alias("r"))
             .where("p <> r"))
    kind = (F.when(F.size("p") == 0, "extra").when(F.size("r") == 0, "missing")
            .when(F.array_distinct("p") == F.array_distinct("r"), "repeated").otherwise("altered"))
    tops = top.select(F.col("archive").alias("_a"), F.col("node").alias("_t"), F.col("a").alias("primary_root"), F.col("b").alias("replica_root"))
    return (found.join(tops, found["archive"].eqNullSafe(F.col("_a")) & (F.floor(F.col("_block") / fanout ** levels) == F.col("_t")), "left")
            .select("archive", "offset", F.col("_block").alias("range_no"), kind.alias("kind"),
                    F.array_join("p", ",").alias("primary_record"), F.array_join("r", ",").alias("replica_record"),
                    "primary_root", "replica_root"))
