"""Segmented scans and order statistics against the windows and aggregates that they stand for."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from seriesloom.operators import order_stats, scan
from seriesloom.operators.keys import join_on
from tests.comparing import same


def series(spark, n=3000):
    """One series with two thirds of the rows, null keys, runs of nulls longer than a segment."""
    pick = random.Random(11)
    rows = []
    for k in range(n):
        key = "hot" if k % 3 else pick.choice(["a", "b", None])
        rows.append((key, pick.choice(["x", None]) if key == "b" else "x", k, None if 400 < k < 1900 or pick.random() < 0.7 else k * 10, pick.choice([None, 1, 2, 5])))
    pick.shuffle(rows)
    return spark.createDataFrame(rows, "k string, l string, r long, v long, c long")


def test_join_on_takes_null_as_a_value(spark):
    a = spark.createDataFrame([("a", None, 1), ("b", "x", 2), (None, None, 3)], "k string, l string, v int")
    b = spark.createDataFrame([("a", None, 10), (None, None, 30), ("c", None, 40)], "k string, l string, w int")
    rows = lambda how: sorted((tuple(r) for r in join_on(a, b, ["k", "l"], how).collect()), key=str)
    assert rows("inner") == sorted([("a", None, 1, 10), (None, None, 3, 30)], key=str)
    assert rows("left") == sorted([("a", None, 1, 10), (None, None, 3, 30), ("b", "x", 2, None)], key=str)
    assert rows("full") == sorted([("a", None, 1, 10), (None, None, 3, 30), ("b", "x", 2, None), ("c", None, None, 40)], key=str)
    assert rows("left_anti") == [("b", "x", 2)] and len(rows("left_semi")) == 2


@pytest.mark.parametrize("parts", [None, 7])
def test_scans_equal_windows(spark, parts):
    df = series(spark).cache()
    w = Window.partitionBy("k", "l").orderBy("r")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("k", "l", "r", F.last("v", ignorenulls=True).over(upto).alias("v"), "c").toPandas()
    same(scan.carried(df, ["k", "l"], ["r"], ["v"], parts), want)
    want = df.select("*", F.lag("r").over(w).alias("before"), F.lag("v").over(w).alias("earlier")).toPandas()
    same(scan.previous(df, ["k", "l"], ["r"], {"before": "r", "earlier": "v"}, parts), want)
    want = df.select("*", F.sum("c").over(upto).alias("total")).toPandas()
    same(scan.running_sums(df, ["k", "l"], ["r"], {"total": "c"}, parts), want)
    same(scan.running_sums(df.select("r", "c"), [], ["r"], {"total": "c"}, parts), df.select("r", "c", F.sum("c").over(Window.orderBy("r").rowsBetween(Window.unboundedPreceding, 0)).alias("total")).toPandas())


def test_one_series_is_spread_over_segments(spark):
    df = series(spark)
    s = scan.segmented(df, ["k"], ["r"], 8)
    sizes = [r.n for r in s.filter("k = 'hot'").groupBy("segment_").agg(F.count("*").alias("n")).collect()]
    assert len(sizes) >= 4 and max(sizes) < 1000
    assert s.count() == 3000 and s.select("place_").distinct().count() == 3000
    none = spark.createDataFrame([], df.schema)
    assert scan.carried(none, ["k"], ["r"], ["v"]).count() == scan.previous(none, ["k"], ["r"], {"p": "v"}).count() == scan.running_sums(none, ["k"], ["r"], {"p": "c"}).count() == 0


def values(spark):
    pick = random.Random(7)
    rows = [("hot", pick.choice([pick.gauss(0, 1), pick.gauss(0, 1e6), float(pick.randrange(50))])) for _ in range(2000)]
    rows += [("hot", x) for x in (1e308, -1e308, None, float("nan"), 5e-324)]
    rows += [(k, float(pick.randrange(20))) for k in ("a", "b", None) for _ in range(pick.randrange(5, 300))] + [("same", 3.0)] * 400 + [("one", 7.5), ("none", None)]
    pick.shuffle(rows)
    return spark.createDataFrame(rows, "k string, v double").repartition(6)


@pytest.mark.parametrize("heavy,bins", [(10**6, 1024), (100, 1024), (0, 3)])
def test_quantiles_equal_percentile(spark, heavy, bins):
    df = values(spark).cache()
    p = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    want = df.filter("v IS NOT NULL AND NOT isnan(v)").groupBy("k").agg(F.count("*").alias("n"), *[F.percentile("v", x).alias(f"q{i}") for i, x in enumerate(p)]).toPandas()
    same(order_stats.quantiles(df, ["k"], "v", p, heavy, bins), want)


def test_medians_stay_in_their_type(spark):
    df = values(spark).filter("abs(v) < 1e9").withColumn("v", F.col("v").cast("decimal(20,4)")).cache()
    want = df.filter("v IS NOT NULL").groupBy("k").agg(F.median("v").alias("median"), F.count("*").alias("n")).toPandas()
    got = order_stats.exact_medians(df, ["k"], "v", 5)
    assert dict(got.dtypes)["median"].startswith("decimal")
    same(got.withColumn("median", F.col("median").cast("double")), want)
