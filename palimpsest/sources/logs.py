"""Event logs and documents: reading with file and line, writing in the same shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from palimpsest.operators.joins import is_small
from palimpsest.session import checkpointed

#: File splits (not rows) up to which line offsets are broadcast: 32 bytes each.
SMALL_SPLITS = 1_000_000


def _relative(root: str, single_file: bool) -> Column:
    """Path below ``root``; for a single file its name."""
    path = F.try_url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    bare = root.split("://", 1)[-1].rstrip("/")
    base = bare.rsplit("/", 1)[0] if single_file else bare
    return F.substring(path, F.locate(base + "/", path) + len(base) + 1, F.length(path))


def read_event_logs(spark: SparkSession, root: str, source: str = "logs") -> DataFrame:
    """``records(source, rel_path, line_no, raw)`` of one file or of all ``*.jsonl`` below a folder.

    Splits of a file are read by different tasks.  A line's number is its
    place in its split plus the lines of the file's earlier splits, so a huge
    file needs no single task.  Lines are counted once, in a pass that decodes no text.
    """
    single = root.endswith(".jsonl")
    reader = spark.read if single else spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.jsonl")
    text = reader.text(root)
    split = [F.xxhash64("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
             F.monotonically_increasing_id().alias("_place")]
    lines = text.select(F.make_valid_utf8("value").alias("raw"), _relative(root, single).alias("rel_path"), *split)
    splits = text.select(*split).groupBy("_file", "_block").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = W.partitionBy("_file").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    offsets = checkpointed(splits.select("_file", "_block", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")))
    if is_small(offsets, SMALL_SPLITS):
        offsets = F.broadcast(offsets)
    return lines.join(offsets, ["_file", "_block"]).select(
        F.lit(source).alias("source"), "rel_path",
        (F.col("_place") - F.col("_first") + F.col("_before") + 1).alias("line_no"), "raw")


def read_sources(spark: SparkSession, root: str, sources) -> DataFrame:
    """The logs of several sources ``(name, path, kind, output)``; missing ones are left out."""
    from functools import reduce
    found = []
    for name, path, _, _ in sources:
        folder = f"{root.rstrip('/')}/{path}"
        if _exists(spark, folder):
            found.append(read_event_logs(spark, folder, name))
    if not found:
        return spark.createDataFrame([], "source string, rel_path string, line_no bigint, raw string")
    return reduce(DataFrame.unionByName, found)


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def read_documents(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """``documents(rel_path, file_size, text)``: one row per file."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).option("wholetext", True)
    return files.text(root).select(_relative(root, False).alias("rel_path"),
                                   F.col("_metadata.file_size").alias("file_size"),
                                   F.make_valid_utf8("value").alias("text"))


def write_event_logs(records: DataFrame, out: str, force: bool = False) -> None:
    """One folder per source and file, lines in order.

    A large file becomes several parts whose names sort in line order.
    Without ``force`` existing output is an error.
    """
    (records.repartitionByRange("source", "rel_path", "line_no")
     .sortWithinPartitions("source", "rel_path", "line_no")
     .select("source", "rel_path", F.col("raw").alias("value"))
     .write.mode("overwrite" if force else "errorifexists")
     .partitionBy("source", "rel_path").text(out))


def write_report(report: DataFrame, out: str, force: bool = False) -> None:
    report.write.mode("overwrite" if force else "errorifexists").text(out)
