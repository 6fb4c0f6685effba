"""Row locators: the file and row of a Parquet row, by which its content is found again."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.session import materialized

#: Words of 64 bits of a row filter: at most so many rows (1 MB) are broadcast, whatever the input.
FILTER_WORDS = 1 << 16


def locator() -> Column:
    return F.concat_ws("#", F.col("_metadata.file_path"), F.col("_metadata.row_index").cast("string"))


def from_files(df: DataFrame) -> DataFrame:
    """``df`` itself if its rows come straight from Parquet files, else a copy in the shared folder."""
    try:
        df.select(locator())
        return df
    except AnalysisException:
        return materialized(df)


def located(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, text and locator."""
    rows = from_files(docs)
    return rows.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), locator().alias("locator"))


def maybe_in(rows: DataFrame, wanted: DataFrame, key: str = "locator") -> DataFrame:
    """Rows whose key may be among the wanted ones: a bit table with one hash, so the rest need not be shuffled.

    Rows that slip through cost time, not correctness; the caller joins or compares in full.
    """
    place = f"pmod(xxhash64({key}), {FILTER_WORDS * 64})"
    word, bit = F.expr(f"shiftright({place}, 6)"), f"cast({place} % 64 as int)"
    table = wanted.groupBy(word.alias("_word")).agg(F.bit_or(F.expr(f"shiftleft(1L, {bit})")).alias("_bits"))
    return (rows.withColumn("_word", word).join(F.broadcast(table), "_word")
            .where(F.expr(f"shiftrightunsigned(_bits, {bit}) & 1 = 1")).drop("_word", "_bits"))
