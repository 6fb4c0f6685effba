"""Publish records as the tree of files they came from.

Every file is written by one task, in line order; a file beyond ``max_bytes`` becomes
several files of consecutive lines, whose numbered names sort in that order.  Spark writes into
a folder beside the target.  Only when all tasks are done are the files given their
names there, and the whole tree takes its place with one rename: a job that fails leaves
nothing behind, and readers never see half a tree.  All of it goes through the file systems
Spark knows; the driver handles names, one per file, never lines.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest import catalog

#: Characters of a file that one task writes.
MAX_BYTES = 512 << 20
#: Renames under way at once.
RENAMES = 16


def published_path(source: Column, rel_path: Column) -> Column:
    """Where a record's file goes; unknown sources get a folder of their name.

    Components that would leave the folder become ``_``.
    """
    clean = F.array_join(F.transform(F.split(rel_path, "/"), lambda c: F.when(c.isin("", ".", ".."), F.lit("_")).otherwise(c)), "/")
    path = F.concat(source, F.lit("/"), clean)
    for name, _, kind, output in catalog.SOURCES:
        path = F.when(source == name, F.lit(output) if kind == "file" else F.concat(F.lit(output + "/"), clean)).otherwise(path)
    return F.when(source == catalog.TABLE_SOURCE, F.concat(F.lit(catalog.TABLE_SOURCE + "/"), clean)).otherwise(path)


def laid_out(records: DataFrame, max_bytes: int = MAX_BYTES) -> DataFrame:
    """``(path, line_no, raw)``: the file each line goes to, pieces of large files numbered."""
    rows = records.select(published_path(F.col("source"), F.col("rel_path")).alias("path"), "line_no", F.coalesce("raw", F.lit("")).alias("raw"))
    sizes = rows.groupBy("path").agg(F.sum(F.octet_length("raw") + 1).alias("_bytes"), F.max("line_no").alias("_last"))
    large = sizes.where(F.col("_bytes") > max_bytes).select("path", "_last", F.ceil(F.col("_bytes") / max_bytes).alias("_pieces"))
    # Every large file holds at least max_bytes, so they are few.
    rows = rows.join(F.broadcast(large), "path", "left")
    piece = F.floor((F.col("line_no") - 1) * F.col("_pieces") / F.col("_last")).cast("string")
    stem = F.regexp_replace("path", r"(\.[A-Za-z0-9]+)?$", "")
    numbered = F.concat(stem, F.lit("."), F.lpad(piece, 5, "0"), F.substring("path", F.length(stem) + 1, F.length("path")))
    return rows.select(F.when(F.col("_pieces").isNull(), F.col("path")).otherwise(numbered).alias("path"), "line_no", "raw")


def write_tree(records: DataFrame, out: str, force: bool = False, max_bytes: int = MAX_BYTES, extra: dict[str, DataFrame] | None = None) -> list[str]:
    """Write ``records(source, rel_path, line_no, raw)`` below ``out``; returns the paths of the files.

    ``extra`` names further files, each a DataFrame of one column of lines in few rows (reports).
    Without ``force`` existing output is an error; with it, it is replaced when the new tree is complete.
    """
    spark = records.sparkSession
    files = _Files(spark)
    if files.exists(out) and not force:
        raise FileExistsError(f"{out} already exists")
    mark = uuid.uuid4().hex
    stage, tree, old = (f"{out.rstrip('/')}.{what}-{mark}" for what in ("writing", "new", "old"))
    try:
        lines = laid_out(records, max_bytes).withColumn("_file", F.md5(F.col("path").cast("binary")))
        (lines.repartition("_file").sortWithinPartitions("_file", "line_no").select("_file", F.col("raw").alias("value"))
         .write.option("maxRecordsPerFile", 0).partitionBy("_file").text(stage))
        names = [(f"{stage}/_file={r['_file']}", r["path"]) for r in lines.select("_file", "path").distinct().toLocalIterator()]
        for n, (path, text) in enumerate((extra or {}).items()):
            text.coalesce(1).write.text(f"{stage}/_extra={n}")
            names.append((f"{stage}/_extra={n}", path))
        files.make(tree)
        with ThreadPoolExecutor(RENAMES) as pool:
            list(pool.map(lambda n: files.take(n[0], f"{tree}/{n[1]}"), names))
        if files.exists(out):
            files.move(out, old)
        files.move(tree, out)
    finally:
        for left in (stage, tree, old):
            files.remove(left)
    return sorted(path for _, path in names)


class _Files:
    """The few operations on names that are needed, on any file system of the session."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        hadoop = self.jvm.org.apache.hadoop.fs.Path(path)
        return hadoop.getFileSystem(self.conf), hadoop

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def make(self, path: str) -> None:
        fs, p = self._at(path)
        fs.mkdirs(p)

    def remove(self, path: str) -> None:
        fs, p = self._at(path)
        if fs.exists(p):
            fs.delete(p, True)

    def move(self, source: str, target: str) -> None:
        fs, p = self._at(source)
        if not fs.rename(p, self.jvm.org.apache.hadoop.fs.Path(target)):
            raise OSError(f"could not rename {source} to {target}")

    def take(self, folder: str, target: str) -> None:
        """The one part file of a folder becomes ``target``."""
        fs, p = self._at(folder)
        parts = [s.getPath() for s in fs.listStatus(p) if s.getPath().getName().startswith("part-")]
        if len(parts) != 1:
            raise OSError(f"{len(parts)} files for {target}")
        goal = self.jvm.org.apache.hadoop.fs.Path(target)
        fs.mkdirs(goal.getParent())
        if not fs.rename(parts[0], goal):
            raise OSError(f"could not write {target}")
