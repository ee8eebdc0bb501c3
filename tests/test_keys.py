import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from hitlist.operators.keys import with_dense_id


def test_dense_id_equals_global_row_number(spark):
    random.seed(7)
    rows = [(random.choice(["a", "b", "c", None]), random.randint(0, 50)) for _ in range(500)]
    df = spark.createDataFrame(rows, "name string, n int").repartition(5)
    got = with_dense_id(df, ["name", "n"], "id", num_partitions=7)
    w = Window.orderBy(F.col("name").asc_nulls_last(), F.col("n").asc_nulls_last())
    want = df.withColumn("id", F.row_number().over(w).cast("long"))
    # ties (equal rows) may swap ids; compare the multiset of (row, id) pairs per key
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert got.agg(F.min("id"), F.max("id"), F.countDistinct("id")).first() == (1, 500, 500)


def test_dense_id_start_and_empty_partitions(spark):
    df = spark.createDataFrame([("x",), ("y",)], "name string")
    got = with_dense_id(df, ["name"], "id", start=41, num_partitions=6).orderBy("id").collect()
    assert [(r.name, r.id) for r in got] == [("x", 41), ("y", 42)]
    empty = with_dense_id(df.limit(0), ["name"], "id")
    assert empty.count() == 0


def test_dense_id_with_coalesced_range_partitions(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k"), (F.col("id") % 13).alias("v"))
    confs = {
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
    }
    old = {k: spark.conf.get(k, None) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        got = with_dense_id(df, ["k"], "id")
        assert got.rdd.getNumPartitions() > 1
        rows = {(r.k, r.id) for r in got.collect()}
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert rows == {(k, k + 1) for k in range(5000)}
