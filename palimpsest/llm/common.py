"""Small expressions that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of all contracts: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def remainder(key: str, modulus: int) -> Column:
    """crc32 of the key's text modulo ``modulus``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % modulus


def n_words(text: str) -> Column:
    """Number of words of a text; null has none."""
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("bigint")


def hashed(*parts: Column) -> Column:
    """60 bits of md5 over the joined parts as a number that other engines compute as well; nulls count as empty."""
    joined = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(joined.cast("binary")), 1, 15), 16, 10).cast("bigint")


def rows_per(spark: SparkSession, floor: int = 1) -> int:
    """Partitions that a keyed exchange of this session uses."""
    return max(floor, int(spark.conf.get("spark.sql.shuffle.partitions")))
