"""Coverage, freshness, grades, inventories and audit counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesloom.operators.quality import reasons


def levels(df: DataFrame, sets: list[list[str]], names: list[str], aggs: list[Column]) -> DataFrame:
    """One report over several grouping sets, with the set's name as ``level``."""
    dims = list(dict.fromkeys(c for s in sets for c in s))
    out = df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in dims]).agg(F.grouping_id().alias("gid_"), *aggs)
    label = None
    for s, name in zip(sets, names):
        gid = sum((0 if c in s else 1) << (len(dims) - 1 - i) for i, c in enumerate(dims))
        label = F.when(F.col("gid_") == gid, name) if label is None else label.when(F.col("gid_") == gid, name)
    return out.withColumn("level", label).drop("gid_")


def dispersion(value: str) -> list[Column]:
    """Mean, range and coefficient of variation from exact sums; null for one row or mean 0."""
    n, total, squares = F.count(value), F.sum(value).cast("double"), F.sum(F.col(value).cast("decimal(38,0)") * F.col(value)).cast("double")
    spread = F.sqrt((squares - total * total / n) / (n - 1))
    return [n.alias("n"), (total / n).alias("mean"), F.min(value).alias("low"), F.max(value).alias("high"), F.when((n > 1) & (total != 0), spread / (total / n)).alias("cv")]


def grade(n: Column, dates: Column, valid: Column, months: Column | None = None) -> Column:
    """Quality grade: the grain preset, or the wholesale one if ``months`` is given."""
    if months is None:
        return F.when((n >= 30) & (dates >= 20) & (valid > 90), "Alta").when((n >= 10) & (dates >= 5) & (valid > 70), "Media").otherwise("Baja")
    return F.when((n >= 20) & (dates >= 10) & (months >= 3) & (valid > 80), "Alta").when((n >= 10) & (dates >= 5) & (months >= 2) & (valid > 60), "Media").otherwise("Baja")


def freshness(df: DataFrame, key: list[str], day: str, as_of: str, preset: str = "grain") -> DataFrame:
    """Last day, its age, rows in the last 7 and 30 days, and a status.

    ``grain`` counts from as_of-7 and shows no negative age; ``transactions`` counts from
    as_of-6 and names future dates.
    """
    ref, shift = F.lit(as_of).cast("date"), 0 if preset == "grain" else 1
    back = lambda n: F.count_if(F.col(day).between(F.date_sub(ref, n - shift), ref))
    out = df.groupBy(*key).agg(F.max(day).alias("last_day"), back(7).alias("rows_7"), back(30).alias("rows_30"))
    age = F.datediff(ref, "last_day")
    status = F.when(age <= 7, "Actual").when(age <= 30, "Reciente").otherwise("Desactualizado")
    if preset == "grain":
        return out.withColumn("age", F.greatest(age, F.lit(0))).withColumn("status", status)
    return out.withColumn("age", age).withColumn("status", F.when(age < 0, "Fecha futura").otherwise(status))


def month_coverage(df: DataFrame, key: list[str], index: str, enough: float = 0.9) -> DataFrame:
    """Months observed, expected between the first and last, missing, and whether fit for display."""
    out = df.groupBy(*key).agg(F.countDistinct(index).alias("observed"), (F.max(index) - F.min(index) + 1).cast("bigint").alias("expected"))
    return out.withColumn("missing", F.col("expected") - F.col("observed")).withColumn("fit", (F.col("observed") >= 3) & (F.col("observed") >= enough * F.col("expected")))


def profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Missing and distinct values of each column, in one scan.

    Rows are grouped by column and value first, so no task counts all values of the table."""
    values = df.unpivot([], [F.col(c).cast("string").alias(c) for c in columns], "column", "value").groupBy("column", "value").agg(F.count("*").alias("n"))
    return values.groupBy("column").agg(F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("missing"), F.count("value").alias("distinct"))


#: Statuses of :func:`comparability`, in the order in which they are tried.
VERDICTS = ["sin datos", "moneda", "unidad", "variedad", "presentacion", "frecuencia", "dimensiones", "comparable"]


def comparability(df: DataFrame, by: list[str], market: str, markets: list, currency: str, unit: str, variety: str, package: str, precision: str, dims: list[str], usable: Column | None = None, daily=None) -> DataFrame:
    """One verdict for each part over all ``markets``, by the first rule that applies: a market has no
    rows; currencies are unknown or differ; units differ, or, where prices are converted (``usable`` tells rows that
    are), a market has no usable row; no variety, or no package, is common to all; rows are of different
    precision, or, in a monthly view, of the precision ``daily``; some dimension has several values.

    Distinct values are gathered by market, and there are few of them in a part.
    """
    columns = list(dict.fromkeys([currency, unit, variety, package, precision, *dims]))
    g = df.groupBy(*by, market).agg(*[F.collect_set(c).alias(f"{c}_s") for c in columns], F.count_if(F.col(currency).isNull()).alias("unknown_"), *[F.count_if(F.col(c).isNull()).alias(f"{c}_none") for c in dict.fromkeys([unit, *dims])], F.count_if(F.lit(True) if usable is None else usable).alias("usable_"))
    parts = g.filter(F.col(market).isin(*markets)).groupBy(*by).agg(F.count("*").alias("markets_"), F.sum("unknown_").alias("unknown_"), F.min("usable_").alias("usable_"), *[F.collect_list(f"{c}_s").alias(f"{c}_l") for c in columns], *[F.sum(f"{c}_none").alias(f"{c}_none") for c in dict.fromkeys([unit, *dims])])
    kinds = lambda c: F.size(F.array_distinct(F.flatten(f"{c}_l")))
    with_none = lambda c: kinds(c) + F.when(F.col(f"{c}_none") > 0, 1).otherwise(0)
    common = lambda c: F.size(F.aggregate(f"{c}_l", F.element_at(f"{c}_l", 1), lambda x, y: F.array_intersect(x, y)))
    several = F.lit(False)
    for c in dims:
        several = several | (with_none(c) > 1)
    units = with_none(unit) > 1 if usable is None else F.col("usable_") == 0
    precise = kinds(precision) > 1 if daily is None else (kinds(precision) > 1) | F.array_contains(F.flatten(f"{precision}_l"), daily)
    verdict = F.when(F.col("markets_") < len(markets), VERDICTS[0]).when((F.col("unknown_") > 0) | (kinds(currency) != 1), VERDICTS[1]).when(units, VERDICTS[2]).when(common(variety) == 0, VERDICTS[3])
    verdict = verdict.when(common(package) == 0, VERDICTS[4]).when(precise, VERDICTS[5]).when(several, VERDICTS[6]).otherwise(VERDICTS[7])
    return parts.select(*by, verdict.alias("verdict"))


def single_market_verdicts(df: DataFrame, by: list[str], currency: str, unit: str | None, dims: list[str]) -> DataFrame:
    """One verdict for each part of one market: several currencies; several units (unless prices are
    converted: ``unit`` is None); some dimension has several values; else "un mercado".  Unknown is a value."""
    columns = list(dict.fromkeys([currency, *([unit] if unit else []), *dims]))
    g = df.groupBy(*by).agg(*[(F.countDistinct(c) + F.max(F.col(c).isNull().cast("int"))).alias(f"{c}_n") for c in columns])
    several = F.lit(False)
    for c in dims:
        several = several | (F.col(f"{c}_n") > 1)
    units = F.col(f"{unit}_n") > 1 if unit else F.lit(False)
    return g.select(*by, F.when(F.col(f"{currency}_n") > 1, VERDICTS[1]).when(units, VERDICTS[2]).when(several, VERDICTS[6]).otherwise("un mercado").alias("verdict"))


def breakdown(df: DataFrame, dims: list[str], unknown: dict[str, str] | None = None) -> DataFrame:
    """Rows by value of each dimension, one after the other in one scan; null and empty values under a name
    of their own (``unknown`` has those that aren't "Sin especificar")."""
    names = [F.coalesce(F.nullif(F.col(c).cast("string"), F.lit("")), F.lit((unknown or {}).get(c, "Sin especificar"))).alias(c) for c in dims]
    return df.unpivot([], names, "dimension", "value").groupBy("dimension", "value").agg(F.count("*").alias("n"))


def joined(column: str, sep: str = " | ") -> Column:
    """Distinct values in order, joined."""
    return F.array_join(F.array_sort(F.collect_set(F.col(column).cast("string"))), sep)


def yearly_diagnostic(df: DataFrame, by: list[str], month: str, item: str, lacks: Column, least: int, share: float) -> DataFrame:
    """Rows, months and items of each part, and why it isn't fit: months missing, few rows, or more than
    ``share`` of the rows lacking something."""
    g = df.groupBy(*by).agg(F.count("*").alias("n"), F.countDistinct(month).alias("months"), F.countDistinct(item).alias("products"), (F.count_if(lacks).cast("double") / F.count("*")).alias("lacking"))
    return g.withColumn("reasons", reasons({"meses incompletos": F.col("months") < 12, "pocas filas": F.col("n") < least, "kg faltantes": F.col("lacking") > share}))


def label_inventory(df: DataFrame, dimension: str, raw: str, key: Column, source: str) -> DataFrame:
    """Every spelling of a dimension with its key, rows and sources, and the spellings that share the key."""
    k = df.groupBy(dimension, raw, key.alias("key")).agg(F.count("*").alias("n"), F.countDistinct(source).alias("sources"))
    return k.withColumn("variants", F.count("*").over(Window.partitionBy(dimension, "key")))


def day_coverage(df: DataFrame, day: str, first: str, last: str, item: str, value: str, least: int) -> DataFrame:
    """Every calendar day with its rows, items and range, and whether it is observed, unverified or empty."""
    calendar = df.sparkSession.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias(day))
    g = df.groupBy(day).agg(F.count("*").alias("n"), F.countDistinct(item).alias("products"), F.min(value).alias("low"), F.max(value).alias("high"))
    status = F.when(F.col("n").isNull(), "sin filas").when(F.col("n") < least, "sin verificar").otherwise("observado")
    zero = F.lit(0).cast("bigint")
    return calendar.join(g, day, "left").select(day, F.coalesce("n", zero).alias("n"), F.coalesce("products", zero).alias("products"), "low", "high", status.alias("status"))


def summary_vs_details(df: DataFrame, by: list[str], is_summary: Column, value: str) -> DataFrame:
    """A part's summary row against the mean of its detail rows."""
    one, rest = F.when(is_summary, F.col(value)), F.when(~is_summary, F.col(value))
    g = df.groupBy(*by).agg(F.max(one).cast("double").alias("summary"), (F.sum(rest).cast("double") / F.nullif(F.count(rest), F.lit(0))).alias("detail"))
    return g.withColumn("difference", F.col("summary") - F.col("detail"))
