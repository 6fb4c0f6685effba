"""Work is dealt by rows: no task grows with the table."""

from pyspark.sql import functions as F

from palimpsest import session
from workload import queries


def sizes(df):
    return df.groupBy(F.spark_partition_id()).count().select("count").toPandas()["count"].tolist()


def test_pieces_follow_the_rows(spark, tmp_path, monkeypatch):
    """As many files as cores, one of which holds nearly all rows."""
    monkeypatch.setattr(session, "ROWS_PER_TASK", 50)
    path = str(tmp_path / "events.parquet")
    spark.range(4000).repartition(1).write.parquet(path)
    for i in range(8):
        spark.range(4000 + i, 4001 + i).repartition(1).write.mode("append").parquet(path)
    stored = spark.read.option("maxPartitionBytes", 1).parquet(path)
    dealt = session.spread(stored)
    assert max(sizes(dealt)) <= 100
    assert sorted(r["id"] for r in dealt.collect()) == list(range(4008))
    assert session.spread(spark.read.parquet(path).limit(0)).count() == 0


def test_rows_are_dealt_after_a_join(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "ROWS_PER_TASK", 20)
    spark.range(2000).selectExpr("id as o_orderkey", "id % 7 as o_custkey", "1.0D as o_totalprice", "'1-URGENT' as o_orderpriority").write.parquet(str(tmp_path / "orders.parquet"))
    spark.range(7).selectExpr("id as c_custkey", "2.0D as c_acctbal", "'MACHINERY' as c_mktsegment").write.parquet(str(tmp_path / "customer.parquet"))
    found = queries.redact_frame(spark, str(tmp_path))
    assert max(sizes(found)) <= 40 and found.count() == 2000
