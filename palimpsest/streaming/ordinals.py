"""Ordinals of stable placeholders on streams.

Numbers are kept in a dictionary table, a part per micro-batch.  A batch looks up
its distinct values there, numbers the new ones after the highest number of
their category, writes them as its own part, and then its rows.  A number once
given never changes, whatever comes late.  A batch that is run again after a
failure reads only the parts of earlier ones and overwrites its own, so it gives
the same numbers again.  One trigger over all rows gives the numbers of the batch
job, and so do several triggers whose rows come in the order of ``order``.

Memory is that of the batch operators: no state is held between batches, no task
holds a category, and the driver sees no value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from palimpsest.functions.expr import fresh
from palimpsest.operators.pseudonyms import assign_ordinals, number_placeholders, stable_values
from palimpsest.operators.text import redact_text
from palimpsest.policy import Policy
from palimpsest.session import materialized

_ENTRY = "category string, digest string, ordinal bigint, token string, placeholder string"


def dictionary(spark: SparkSession, folder: str, before: int | None = None) -> DataFrame:
    """(category, digest, ordinal, token, placeholder) of all batches, or of those before one."""
    entries = spark.read.schema(f"{_ENTRY}, _batch bigint").parquet(f"{folder}/dictionary")
    return (entries if before is None else entries.where(F.col("_batch") < before)).drop("_batch")


def numbered_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The rows written so far."""
    return spark.read.parquet(f"{folder}/rows").drop("_batch")


def number_stream(stream: DataFrame, col: str, policy: Policy, order: list[str], folder: str,
                  once: bool = True) -> StreamingQuery:
    """Redact a text column and number its placeholders; rows and dictionary go to ``folder``, which all executors share.

    ``order`` says which of a batch's values appears first; rows that tie there are told apart by their place.  Null texts stay
    null.  With ``once`` everything available is read and the query ends.  One query at a time may write to a folder.
    """
    if not stream.isStreaming:
        raise ValueError("not a streaming DataFrame")
    spark = stream.sparkSession
    spark.createDataFrame([], _ENTRY).write.mode("ignore").parquet(f"{folder}/dictionary/_batch=-1")
    row, hits = fresh(stream, "_row"), fresh(stream, "_hits")
    places = [f"_order_{i}" for i in range(len(order) + 1)]

    def batch(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        local = materialized(redact_text(rows, col, policy, hits=hits).withColumn(row, F.monotonically_increasing_id()))
        found = local.select(*[F.col(c).alias(p) for c, p in zip([*order, row], places, strict=True)], F.col(hits).alias("hits"))
        new = assign_ordinals(stable_values(found, places), [*places, "hit_no", "match_no"], policy.salt, known=dictionary(spark, folder, number))
        new.select("category", "digest", "ordinal", "token", "placeholder").write.mode("overwrite").parquet(f"{folder}/dictionary/_batch={number}")
        numbered = number_placeholders(local.drop(hits), [row], col, dictionary(spark, folder, number + 1))
        numbered.drop(row).write.mode("overwrite").parquet(f"{folder}/rows/_batch={number}")

    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", f"{folder}/progress")
    return (writer.trigger(availableNow=True) if once else writer).start()
