from pyspark.sql import functions as F

from hitlist.functions.numeric import avg2, avg2_money


def _mean(spark, values, money=False, typ="int"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return df.agg((avg2_money("x") if money else avg2("x")).alias("m")).first().m


def test_int_means_round_half_away(spark):
    assert _mean(spark, [1, 2]) == 1.5
    assert _mean(spark, [1, 2, 2]) == 1.67
    assert _mean(spark, [1, 1, 1, 1, 1, 1, 1, 2]) == 1.13  # 1.125 -> 1.13
    assert _mean(spark, [-1, -1, -1, -1, -1, -1, -1, -2]) == -1.13
    assert _mean(spark, [None, 3]) == 3.0


def test_money_means_are_exact_on_cents(spark):
    # 1.005 as a double is below the half; the exact mean of the cents is not.
    assert _mean(spark, [1.00, 1.01], money=True, typ="double") == 1.01
    assert _mean(spark, [-1.00, -1.01], money=True, typ="double") == -1.01
    assert _mean(spark, [20000.10, 20000.20, 20000.20], money=True, typ="double") == 20000.17


def test_money_means_round_once(spark):
    # each value rounds to 0.00, 0.00, 0.01; their mean is 0.0073
    assert _mean(spark, [0.004, 0.004, 0.014], money=True, typ="double") == 0.01
    assert _mean(spark, [-0.004, -0.004, -0.014], money=True, typ="double") == -0.01


def test_all_null_group_is_null(spark):
    df = spark.createDataFrame([(1, None), (1, None)], "k int, x int")
    assert df.groupBy("k").agg(avg2("x").alias("m")).first().m is None
    df = spark.createDataFrame([(1, None)], "k int, x double")
    assert df.groupBy("k").agg(avg2_money("x").alias("m")).first().m is None


def test_large_sums_do_not_overflow(spark):
    df = spark.range(0, 1000).select(F.lit(9_000_000_000_000.25).alias("x"))
    assert df.agg(avg2_money("x").alias("m")).first().m == 9_000_000_000_000.25
