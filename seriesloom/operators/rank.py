"""Rankings, concentration, matrices and key figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top(df: DataFrame, key: list[str], value: Column, n: int) -> DataFrame:
    """The n largest groups with their share of everything; ties by key."""
    g = df.groupBy(*key).agg(value.alias("value"))
    total = g.agg(F.sum("value")).scalar()
    return g.withColumn("share", F.col("value").cast("double") / total).orderBy(F.desc("value"), *key).limit(n)


def ranked(df: DataFrame, order: list[Column], n: int, partition: list[str] | None = None, name: str = "rank") -> DataFrame:
    """The first n rows of each partition."""
    w = Window.partitionBy(*(partition or [])).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)


def with_rest(df: DataFrame, key: str, value: str, n: int, rest: str = "Otros") -> DataFrame:
    """The n largest keys and everything else under ``rest``."""
    g = df.groupBy(key).agg(F.sum(value).alias(value))
    first = g.orderBy(F.desc(value), key).limit(n).select(key, F.lit(True).alias("first_"))
    return g.join(first, key, "left").groupBy(F.when(F.col("first_"), F.col(key)).otherwise(rest).alias(key)).agg(F.sum(value).alias(value))


def seasonality(share_of_peak: Column) -> Column:
    return F.when(share_of_peak == 1, "pico").when(share_of_peak > 0.3, "activo").otherwise("bajo")


def stratified_sample(df: DataFrame, dims: list[str], order: list[str], n: int) -> DataFrame:
    """At most n rows of every value of every dimension, each row once (a sampling operator)."""
    chosen = None
    for c in dims:
        part = ranked(df, [F.col(o) for o in order], n, [c]).select(*df.columns)
        chosen = part if chosen is None else chosen.unionByName(part)
    return chosen.distinct()


def concentration(df: DataFrame, by: str, item: str, value: str, n: int) -> DataFrame:
    """Share of the ``n`` largest items of each part."""
    g = df.groupBy(by, item).agg(F.sum(value).alias("v_"))
    g = g.withColumn("r_", F.row_number().over(Window.partitionBy(by).orderBy(F.desc("v_"), item)))
    return g.groupBy(by).agg((F.sum(F.when(F.col("r_") <= n, F.col("v_"))).cast("double") / F.sum("v_")).alias("share"))


def heat_matrix(df: DataFrame, item: str, column: Column, columns: list, value: str, n: int) -> DataFrame:
    """Sums of the ``n`` largest items by item and column."""
    first = top(df, [item], F.sum(value), n).select(item)
    return df.withColumn("column_", column).join(first, item, "left_semi").groupBy(item).pivot("column_", columns).agg(F.sum(value))


def season_classes(df: DataFrame, dims: list[str], season: Column, value: str) -> DataFrame:
    """Peak, active and low seasons of each series, by the share of its peak."""
    g = df.groupBy(*dims, season).agg(F.sum(value).alias("v_"))
    peak = F.max("v_").over(Window.partitionBy(*dims))
    return g.withColumn("class", seasonality(F.col("v_").cast("double") / peak)).drop("v_")
