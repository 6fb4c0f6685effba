"""Ordinals on streams against the batch dictionary."""

import os

import pytest
from pyspark.sql import functions as F

from palimpsest import Policy
from palimpsest.operators import pseudonyms, text
from palimpsest.streaming import ordinals

POLICY = Policy("alice", "/home/alice", auto_discover=False)
SCHEMA = "i int, t string, _row string, _hits int, hits string, category string"


def rows(spark, low, high):
    """Mail addresses and hosts that repeat within and between batches; a null and an empty text."""
    texts = [(i, f"m{i * 7 % 11}@example.org and m{i % 5}@example.net at 10.0.{i % 4}.{i % 3}") for i in range(low, high)]
    return spark.createDataFrame([(i, t, "r", 1, "h", "c") for i, t in [*texts, (100 + low, None), (200 + low, "")]], SCHEMA)


def run(spark, folder):
    stream = spark.readStream.schema(SCHEMA).parquet(f"{folder}/in")
    ordinals.number_stream(stream, "t", POLICY, ["i"], folder).awaitTermination()
    return {r["token"]: r["placeholder"] for r in ordinals.dictionary(spark, folder).collect()}


def batch_dictionary(df):
    local = text.redact_text(df, "t", POLICY, hits="found")
    entries = pseudonyms.assign_ordinals(pseudonyms.stable_values(local, ["i"], "found"), ["i", "hit_no", "match_no"])
    return {r["token"]: r["placeholder"] for r in entries.collect()}


def test_numbers_last(spark, tmp_path):
    folder, first, late = str(tmp_path), rows(spark, 10, 30), rows(spark, 0, 10)
    first.write.mode("append").parquet(f"{folder}/in")
    before = run(spark, folder)
    assert before and before == batch_dictionary(first)
    assert run(spark, folder) == before                                  # nothing new
    late.write.mode("append").parquet(f"{folder}/in")                    # smaller ids, so other first appearances
    after = run(spark, folder)
    assert set(after) == set(batch_dictionary(first.union(late))) and len(set(after.values())) == len(after)
    assert {k: v for k, v in after.items() if k in before} == before
    got = ordinals.numbered_rows(spark, folder)
    assert got.columns == first.columns and got.count() == 34 and got.where("t is null").count() == 2
    assert got.where(F.col("t").contains(":0000:")).count() == 0

    # The last batch runs again, as after a failure before its end: the same numbers, no row twice.
    commits = sorted((f for f in os.listdir(f"{folder}/progress/commits") if f.isdigit()), key=int)
    for name in (commits[-1], f".{commits[-1]}.crc"):
        if os.path.exists(f"{folder}/progress/commits/{name}"):
            os.remove(f"{folder}/progress/commits/{name}")
    assert run(spark, folder) == after and ordinals.numbered_rows(spark, folder).count() == 34


def test_empty_and_batch_input(spark, tmp_path):
    folder = str(tmp_path)
    rows(spark, 0, 0).where("t = ''").write.parquet(f"{folder}/in")
    assert run(spark, folder) == {} and ordinals.numbered_rows(spark, folder).count() == 1
    with pytest.raises(ValueError):
        ordinals.number_stream(rows(spark, 0, 1), "t", POLICY, ["i"], folder)
