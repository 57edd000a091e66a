"""Key figures of a selection of observations, one function a panel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesloom.operators import rank as R
from seriesloom.operators import series as S
from seriesloom.operators.keys import join_on


def quantity(df: DataFrame, item: str, value: str, day: str, month: str) -> DataFrame:
    """One row: total, items, last day, and the month and item with most; ties by name."""
    best = lambda key: df.groupBy(key).agg(F.sum(value).alias("v_")).orderBy(F.desc("v_"), key).limit(1).select(key).scalar()
    one = df.agg(F.sum(value).alias("total"), F.countDistinct(item).alias("products"), F.max(day).cast("string").alias("last_day"))
    return one.withColumn("peak_month", best(month)).withColumn("top_product", best(item))


def prices(df: DataFrame, item: str, value: str, levels: list[str], period: str) -> DataFrame:
    """One row: highest and lowest value with their items, the mean balanced over ``levels`` (from
    coarse to fine), the largest rise and fall between periods, and the change from first to last."""
    at = F.struct(value, item)
    ends = df.agg(F.max(value).alias("high"), F.max_by(item, at).alias("high_product"), F.min(value).alias("low"), F.min_by(item, at).alias("low_product"))
    years = S.balanced(df.withColumn("all_", F.lit(1)), [], ["all_", *levels], value).select(F.col("v").alias("balanced"))
    changes = S.largest_changes(df.groupBy(period).agg(S.mean(value).alias("v_")), period, "v_")
    one = F.lit(1).alias("one_")
    return ends.select(one, "*").join(years.select(one, "*"), "one_").join(changes.select(one, "*"), "one_").drop("one_")


def latest_medians(series: DataFrame, by: str, last: str, changes: dict[str, str]) -> DataFrame:
    """Per selection ``by``: its series, and the medians of their latest values and of each of ``changes`` (name:
    column), with how many series have that change.  All medians are kept back where there are several series.

    ``series`` has one row a series; values that aren't positive are passed over.
    """
    one = F.count("*") == 1
    v = F.col(last).cast("double")
    parts = [F.when(one, F.median(F.when(v > 0, v))).alias("median_last")]
    for name, column in changes.items():
        parts += [F.when(one, F.median(column)).alias(name), F.count(column).alias(f"{name}_series")]
    return series.groupBy(by).agg(F.count("*").alias("series"), *parts)


def described_quantities(df: DataFrame, period: str, item: str, value: str, good: Column, unit: str) -> DataFrame:
    """Values and shares of items in a period; null where some row isn't good, has no unit, or the period
    mixes units."""
    g = df.groupBy(period, item).agg(F.sum(value).alias("v_"), F.bool_and(F.coalesce(good, F.lit(False)) & F.col(unit).isNotNull()).alias("good_"), F.min(unit).alias("first_"), F.max(unit).alias("last_"))
    w = Window.partitionBy(period)
    fit = F.bool_and("good_").over(w) & (F.min("first_").over(w) == F.max("last_").over(w))
    return g.select(period, item, F.when(fit, F.col("v_")).alias(value), F.when(fit & (F.sum("v_").over(w) != 0), F.col("v_").cast("double") / F.sum("v_").over(w)).alias("share"))


def composition(df: DataFrame, period: str, part: str, parts: list[str], value: str) -> DataFrame:
    """Share of each of ``parts`` in a period as columns share0, share1, ...; null where one is missing or negative."""
    p = df.groupBy(period).pivot(part, parts).agg(F.sum(value))
    known = [F.col(f"`{m}`") for m in parts]
    total = sum(known[1:], known[0])
    least = F.least(*known) if len(known) > 1 else known[0]
    fit = (total > 0) & (least >= 0)  # null if one is missing
    return p.select(period, *[F.when(fit, c.cast("double") / total).alias(f"share{k}") for k, c in enumerate(known)])


def exploration_matrix(df: DataFrame, dims: list[str], day: str, as_of: str) -> DataFrame:
    """Rows of each combination of ``dims``, and those after ``as_of``."""
    return df.groupBy(*dims).agg(F.count("*").alias("rows"), F.count_if(F.col(day) > F.lit(as_of).cast("date")).alias("future"))


def unit_values(df: DataFrame, dims: list[str], index: str, total: str, volume: Column) -> DataFrame:
    """Total by volume of each month, and its change from the same month a year before."""
    m = df.groupBy(*dims, index).agg(F.sum(total).alias("t_"), F.sum(volume).alias("v_"))
    u = m.withColumn("unit_value", F.when(F.col("v_") != 0, F.col("t_").cast("double") / F.col("v_")))
    return u.select(*dims, index, "unit_value", S.change(F.col("unit_value"), S.exact_prior("unit_value", dims, index, 12)).alias("change_year"))


def overview(df: DataFrame, by: str, period: str, item: str, origin: str, day: str) -> DataFrame:
    """Per source: latest period and its items, all items and origins, first and last day."""
    each = df.groupBy(by, period).agg(F.countDistinct(item).alias("p_"))
    last = each.groupBy(by).agg(F.max(period).alias("latest"), F.max_by("p_", period).alias("latest_products"))
    return df.groupBy(by).agg(F.countDistinct(item).alias("products"), F.countDistinct(origin).alias("origins"), F.min(day).cast("string").alias("first_day"), F.max(day).cast("string").alias("last_day")).transform(lambda x: join_on(x, last, [by]))


def latest_comparable(df: DataFrame, by: str, item: str, day: str, order: list[Column], n: int) -> DataFrame:
    """The latest row of each item, and of these the ``n`` latest of each source, with their place."""
    one = R.ranked(df, [F.desc(day), *order], 1, [by, item], "r_")
    return R.ranked(one, [F.desc(day), F.col(item)], n, [by], "place").drop("r_")


def market_origin(df: DataFrame, item: str, market: str, origin: str, index: str, value: str, n: int) -> DataFrame:
    """Monthly medians of ``n`` combinations of market and origin of each item, months filled: the best
    observed of each market first."""
    g = df.groupBy(item, market, origin, index).agg(F.median(F.col(value).cast("double")).alias("median"))
    k = g.groupBy(item, market, origin).agg(F.count("*").alias("k_"))
    k = k.withColumn("place_", F.row_number().over(Window.partitionBy(item, market).orderBy(F.desc("k_"), origin)))
    chosen = R.ranked(k, [F.col("place_"), F.desc("k_"), F.col(market), F.col(origin)], n, [item], "r_").select(item, market, origin)
    return S.fill_months(join_on(g, chosen, [item, market, origin], "left_semi"), [item, market, origin], index).select(item, market, origin, index, "median")
