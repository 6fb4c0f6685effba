"""Session settings and the one way in which lineage is cut."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate data that the driver and all executors see.

    That is ``spark.checkpoint.dir``; where it is unset, a folder in the
    warehouse.  On a cluster that must not be a machine-local one: executors
    would write where nobody else reads, so it is refused.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_intermediate"
            if is_machine_local(folder) and not context.master.startswith("local"):
                raise ValueError(f"{folder} is a machine-local folder; set spark.checkpoint.dir to one that all executors share")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir().rstrip("/")


def is_machine_local(folder: str) -> bool:
    """A path without a scheme, or below ``file:``."""
    return folder.startswith("file:") or "://" not in folder


def new_folder(spark: SparkSession, what: str) -> str:
    """The path of a new, empty place in the shared folder."""
    return f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and go on from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


#: Rows of a task that redacts, a minute of work at most: rows of the larger tables take up to a millisecond.
ROWS_PER_TASK = 50_000


def _pieces(rows: int) -> int:
    return -(-rows // ROWS_PER_TASK)


def dealt(df: DataFrame, rows: int) -> DataFrame:
    """Deal about ``rows`` rows evenly, for work that is bound by CPU: the number of tasks grows with the rows."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    # Several pieces per core even out rows of very different length.
    return df.repartition(max(4 * cores, _pieces(rows)))


def spread(df: DataFrame) -> DataFrame:
    """Deal a stored table that arrives in too few pieces for its rows or for the cores.

    Redaction is bound by CPU, so a file is worth a shuffle: compressed rows are
    short, and a split of a file holds whole row groups, so pieces by size may
    hold a million rows each, or none.  Rows are counted from the files' footers.
    Tables of many files come back as they are.
    """
    cores, rows = df.sparkSession.sparkContext.defaultParallelism, df.count()
    return dealt(df, rows) if df.rdd.getNumPartitions() < max(cores, _pieces(rows)) else df


def local_session(cores: int | str = "*", name: str = "palimpsest", **settings) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(name)
               .config("spark.ui.enabled", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.sql.adaptive.enabled", "true"))
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


#: Spark 4.1 and later: shuffle files go when their query ends; else they stay until the driver collects garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Rows that a Python worker gets at a time.
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def _set(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def transient_shuffles(spark: SparkSession) -> AbstractContextManager[None]:
    """Shuffle files of the queries inside are removed as each of them ends."""
    return _set(spark, _CLEANUP, "true")


def materialized(df: DataFrame, batch_rows: int | None = None) -> DataFrame:
    """Like :func:`checkpointed`, as a Parquet table: for wide results that are read column-wise later.

    ``batch_rows`` bounds the rows that a Python worker of the query gets at a time: for long rows, of which the session's
    number takes much memory on both sides.
    """
    spark = df.sparkSession
    path = new_folder(spark, "table")
    with transient_shuffles(spark), _set(spark, _BATCH_ROWS, str(batch_rows)) if batch_rows else nullcontext():
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Remove a table of :func:`materialized` that nothing reads any more."""
    context = table.sparkSession.sparkContext
    for file in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        path = context._jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
