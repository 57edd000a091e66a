"""Order independence, idempotence, and no mixing across dimensions."""

import random

from pyspark.sql import functions as F

from seriesloom.operators import match, series
from seriesloom.streaming import incremental


def observations(spark, seed, parts):
    pick = random.Random(7)
    rows = [(pick.choice("ab"), pick.choice("xy"), f"2024-{m:02d}", m, f"2024-{m:02d}-{pick.randrange(1, 28):02d}", pick.randrange(1, 500), i) for i in range(300) for m in [pick.randrange(1, 13)]]
    random.Random(seed).shuffle(rows)
    return spark.createDataFrame(rows, "product string, unit string, month string, month_idx int, day string, price bigint, id int").repartition(parts)


def collected(df):
    return sorted(tuple(r) for r in df.collect())


def test_results_do_not_depend_on_order(spark):
    a, b = observations(spark, 1, 2), observations(spark, 2, 7)
    dims = ["product", "unit"]
    for job in (
        lambda d: series.period_stats(d, dims, ["month", "month_idx"], "price"),
        lambda d: series.latest_rows(d, dims, ["day", "id"]),
        lambda d: series.weighted_price(d, dims, "price", "id"),
        lambda d: series.exact_median(d.withColumn("price", F.col("price").cast("decimal(18,2)")), dims, "price"),
        lambda d: match.first_of_equal(d.select("product", "unit", "month", "id"), ["id"], ["id"]),
    ):
        assert collected(job(a)) == collected(job(b))


def test_dimensions_are_never_mixed(spark):
    d = observations(spark, 1, 3)
    stats = series.period_stats(d, ["product", "unit"], ["month"], "price")
    assert stats.count() == d.select("product", "unit", "month").distinct().count()
    assert stats.agg(F.sum("n")).first()[0] == d.count()


def test_deduplication_is_idempotent(spark):
    d = observations(spark, 1, 3).select("product", "unit", "month", "id")
    once = match.first_of_equal(d, ["id"], ["id"])
    assert collected(match.first_of_equal(once, ["id"], ["id"])) == collected(once)


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    out = str(tmp_path / "t")
    batch = spark.createDataFrame([("a", 1, 1), ("b", 2, 1)], "id string, price int, at int")
    for k in (0, 0, 1, 0):  # one batch three times, and its rows in another batch
        incremental.accumulate(batch, out, ["id"], ["price"], ["at"], k, str(tmp_path / "n"))
    assert incremental.accumulated_rows(spark, out, batch.schema).count() == 2
    got = {(r.batch, r.state, r.n) for r in spark.read.parquet(str(tmp_path / "n")).collect()}
    assert got == {(0, "first", 2), (1, "duplicate", 2)}


def test_upsert_twice_is_unchanged(spark):
    a = spark.createDataFrame([(1, 5, None), (2, 6, "x")], "k int, v int, t string")
    b = spark.createDataFrame([(2, 7, "x"), (3, 1, None)], "k int, v int, t string")
    first = incremental.keyed_upsert(a, b, ["k"])
    assert sorted((r.k, r.v, r.state) for r in first.collect()) == [(1, 5, "kept"), (2, 7, "changed"), (3, 1, "new")]
    again = incremental.keyed_upsert(first.drop("state"), b, ["k"])
    assert {r.state for r in again.collect()} == {"kept", "unchanged"}
