"""Exact deduplication as a stateful stream.

A stream of (id, digest, locator) rows meets keyed state on disk (RocksDB) that
never expires.  For every digest the state retains the smallest id, the locator
of that row's content and the number of rows seen.  Rows that hit a digest seen
before are read again and compared byte by byte; texts that differ in spite of
one digest become groups of their own.

Texts are equal when they are identical after every run of white space has
become one blank.  A null text is empty.  The row with the smallest id stays;
null ids come last, and of repeated rows with one id the one with the smallest
locator stays.  An empty table gives an empty result.  Columns of the input
beside the id and the text are not read.

Only DataFrame operations run on executors; the driver's callback of
``foreachBatch`` merely starts writes.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.functions.expr import fresh
from palimpsest.llm.common import SPACE_RUN
from palimpsest.llm.files import from_files, located, locator, maybe_in
from palimpsest.session import materialized, new_folder

_STORE = "spark.sql.streaming.stateStore."
#: State on disk; without preallocated log files, which cost megabytes for every partition of small states.
STATE = {
    _STORE + "providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    _STORE + "rocksdb.changelogCheckpointing.enabled": "true",
    _STORE + "rocksdb.allowFAllocate": "false",
}

def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_RUN, " ")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


@contextmanager
def disk_backed_state(spark: SparkSession):
    before = {key: spark.conf.get(key, None) for key in STATE}
    for key, value in STATE.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def retained(stream: DataFrame) -> DataFrame:
    """The state: for each digest the first row by id, and how many rows had it.  Works on streams and tables."""
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "locator"))
    return stream.groupBy("digest").agg(first.alias("first"), F.count(F.lit(1)).alias("n"))


def run_stream(spark: SparkSession, landing: str, schema, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """Take all files below ``landing`` that this state has not seen; returns the state's rows as a table.

    ``folder`` holds the state and what changed with each micro-batch; a later
    call with the same folder goes on where this one ended.  A batch that is
    repeated after a failure replaces its own output.
    """
    source = spark.readStream.schema(schema)
    if files_per_trigger:
        source = source.option("maxFilesPerTrigger", files_per_trigger)
    changes = f"{folder}/changes"

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{changes}/batch={number}")

    with disk_backed_state(spark):
        query = (retained(source.parquet(landing)).writeStream.outputMode("update")
                 .option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).foreachBatch(write).start())
        query.awaitTermination()
    # Counts only grow and the first row only gets smaller, so the last state of a digest is this.
    state = "digest string, first struct<no_id: boolean, id: {}, locator: string>, n bigint".format(
        schema["id"].dataType.simpleString())
    return (spark.read.schema(state).option("recursiveFileLookup", "true").parquet(changes)
            .groupBy("digest").agg(F.min("first").alias("first"), F.max("n").alias("n")))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                digest: Callable[[Column], Column] = sha256, files_per_trigger: int | None = None) -> DataFrame:
    """One row per row of ``docs``: id, locator, digest, keep_id, keep_locator, group_size, kept.

    ``digest`` names candidates only: hits are compared in full, so a weak one
    costs time but never merges different texts.
    """
    spark = docs.sparkSession
    rows = located(docs, id_col, text_col)
    folder = new_folder(spark, "exact-dedup")
    landing = f"{folder}/landing"
    keyed = rows.select("id", "locator", digest(normalised(F.col("text"))).alias("digest"))
    keyed.write.parquet(landing)
    keys = spark.read.schema(keyed.schema).parquet(landing)
    groups = materialized(run_stream(spark, landing, keyed.schema, folder, files_per_trigger))
    repeated = groups.where("n > 1")
    hits = keys.join(repeated.select("digest"), "digest", "left_semi")

    # Every text that shares its digest with another row, in full.  Copies in one
    # task fall together before the exchange, so a hot text is not a hot task.
    text = normalised(F.col("text"))
    again = maybe_in(rows, hits).select("id", "locator", text.alias("text"), digest(text).alias("digest"))
    texts = again.groupBy("digest", "text").agg(F.count(F.lit(1)).alias("n"))
    differing = materialized(texts.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("digest"))

    out = keys.join(groups, "digest", "left")
    if not differing.isEmpty():
        apart = again.join(differing, "digest", "left_semi")
        first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "locator")).alias("own_first")
        own = apart.groupBy("digest", "text").agg(first, F.count(F.lit(1)).alias("own_n"))
        own = apart.join(own, ["digest", "text"]).select("locator", "own_first", "own_n")
        out = (out.join(own, "locator", "left")
               .withColumn("first", F.coalesce("own_first", "first")).withColumn("n", F.coalesce("own_n", "n")))
    return out.select(
        F.col("id").alias(id_col), "locator", "digest", F.col("first.id").alias("keep_id"),
        F.col("first.locator").alias("keep_locator"), F.col("n").alias("group_size"),
        (F.col("locator") == F.col("first.locator")).alias("kept"))


def kept_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    docs = from_files(docs)
    own = fresh(docs, "_locator")
    stays = exact_dedup(docs, id_col, text_col).where("kept").select(F.col("locator").alias(own))
    return docs.withColumn(own, locator()).join(stays, own, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
