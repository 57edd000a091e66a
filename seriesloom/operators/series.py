"""Series statistics, exact-calendar variations, balanced means and trailing windows.

A series is the full tuple of its dimensions; nothing here aggregates across one.  Variations
use RANGE frames on integer month or day numbers, so a gap is never bridged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesloom.functions.dates import month_index
from seriesloom.operators import order_stats, scan
from seriesloom.operators.keys import join_on


def mean(value: str) -> Column:
    """Sum by count in double, so that equal inputs give equal bits."""
    return F.sum(value).cast("double") / F.count(value)


def period_stats(df: DataFrame, dims: list[str], period: list[str], value: str, day: str = "day") -> DataFrame:
    """Count, mean, exact median, range and distinct days of each series and period."""
    return df.groupBy(*dims, *period).agg(F.count(value).alias("n"), mean(value).alias("mean"), F.median(F.col(value).cast("double")).alias("median"), F.min(value).alias("low"), F.max(value).alias("high"), F.countDistinct(day).alias("days"))


def exact_prior(value: str, dims: list[str], index: str, offset: int) -> Column:
    """The positive value exactly ``offset`` periods before, else null."""
    at = Window.partitionBy(*dims).orderBy(index).rangeBetween(-offset, -offset)
    prior = F.max(value).over(at)
    return F.when(prior > 0, prior)


def change(now: Column, before: Column) -> Column:
    """Percentage change."""
    return (now / before - 1) * 100


def grain_state(variation: Column) -> Column:
    return F.when(variation.isNull(), "Sin dato").when(F.abs(variation) > 50, "Revisar").when(variation < -5, "Baja").when(variation <= 5, "Estable").when(variation <= 20, "Suba moderada").otherwise("Suba fuerte")


def wholesale_state(variation: Column) -> Column:
    return F.when(variation.isNull(), "Sin dato").when(variation < -50, "Revisar").when(variation < -5, "Baja").when(variation <= 5, "Estable").when(variation <= 15, "Suba moderada").when(variation <= 50, "Suba fuerte").otherwise("Revisar")


def latest_rows(df: DataFrame, dims: list[str], order: list[str]) -> DataFrame:
    """The last row of each series by ``order``; ties are settled by all columns."""
    rest = [c for c in df.columns if c not in dims]
    last = F.max_by(F.struct(*rest), F.struct(*order, *[c for c in rest if c not in order])).alias("last")
    return df.groupBy(*dims).agg(last).select(*dims, "last.*")


def weighted_price(df: DataFrame, dims: list[str], price: str, volume: str) -> DataFrame:
    """Volume-weighted price, only where every row has a volume and the total is positive."""
    whole = F.count(volume) == F.count("*")
    total = F.sum(volume)
    weighted = F.when(whole & F.bool_and(F.col(volume) >= 0) & (total > 0), F.sum(F.col(price) * F.col(volume)).cast("double") / total)
    known = F.sum(F.when(F.col(volume) >= 0, F.col(volume)))
    return df.groupBy(*dims).agg(F.count("*").alias("n"), F.when(whole, total).alias("volume"), known.alias("known_volume"), weighted.alias("weighted"))


def balanced(df: DataFrame, dims: list[str], levels: list[str], value: str, how: str = "mean") -> DataFrame:
    """Rows to days to months and so on, each level unweighted: ``levels`` from coarse to fine."""
    middle = (lambda c: F.avg(c)) if how == "mean" else (lambda c: F.median(c))
    out = df.withColumn("v", F.col(value).cast("double"))
    for k in range(len(levels), 0, -1):
        out = out.groupBy(*dims, *levels[:k]).agg(middle("v").alias("v"), F.count("*").alias("parts"))
    return out


def day_balanced_months(df: DataFrame, dims: list[str], signature: list[str], value: str) -> DataFrame:
    """Monthly mean of daily means of distinct quotes; range of the daily means."""
    daily = df.dropDuplicates([*dims, "month", "day", *signature]).groupBy(*dims, "month", "day").agg(mean(value).alias("day_mean"), F.count("*").alias("quotes"))
    return daily.groupBy(*dims, "month").agg(F.avg("day_mean").alias("mean"), F.min("day_mean").alias("low"), F.max("day_mean").alias("high"), F.count("*").alias("days"), F.sum("quotes").alias("quotes"))


def day_median(df: DataFrame, dims: list[str], value: str, guard: str) -> DataFrame:
    """Median of day medians; null where a month mixes values of ``guard``."""
    daily = df.groupBy(*dims, "month", "day").agg(F.median(F.col(value).cast("double")).alias("m"), F.min(guard).alias("g1"), F.max(guard).alias("g2"))
    pure = F.min("g1") == F.max("g2")
    return daily.groupBy(*dims, "month").agg(F.when(pure, F.median("m")).alias("median"), F.count("*").alias("days"))


def adjacent_variation(df: DataFrame, dims: list[str], index: str, value: str) -> DataFrame:
    """Change from the previous row only where it is the calendar's previous period."""
    w = Window.partitionBy(*dims).orderBy(index)
    near = F.col(index) - F.lag(index).over(w) == 1
    return df.withColumn("variation", F.when(near & (F.lag(value).over(w) > 0), change(F.col(value), F.lag(value).over(w))))


def observed_variation(df: DataFrame, dims: list[str], day: str, value: str, method: str | None = None, parts: int | None = None) -> DataFrame:
    """Daily form of :func:`adjacent_variation`: rows with a positive value, each with the change from the series' previous
    observed day, however far back; null across a change of ``method``.  One row a day; a series may be of any
    length, as it is scanned in segments."""
    seen = {"previous_day": day, "before_": value} | ({"method_": method} if method else {})
    out = scan.previous(df.filter(F.col(value) > 0), dims, [day], seen, parts)
    fits = F.col(method).eqNullSafe(F.col("method_")) if method else F.lit(True)
    return out.withColumn("variation", F.when(fits, change(F.col(value), F.col("before_")))).drop("before_", "method_")


def guarded_variation(df: DataFrame, dims: list[str], index: str, value: str, method: str) -> DataFrame:
    """As :func:`adjacent_variation`, but null across a change of method."""
    w = Window.partitionBy(*dims).orderBy(index)
    out = adjacent_variation(df, dims, index, value)
    return out.withColumn("variation", F.when(F.col(method) == F.lag(method).over(w), F.col("variation")))


def fill_months(df: DataFrame, dims: list[str], index: str) -> DataFrame:
    """A row for every month between a series' first and last; new rows have nulls."""
    span = df.groupBy(*dims).agg(F.min(index).alias("a"), F.max(index).alias("b"))
    calendar = span.select(*dims, F.explode(F.sequence("a", "b")).alias(index))
    return join_on(calendar, df, [*dims, index], "left")


def trailing(value: str, dims: list[str], index: str, months: int, what) -> Column:
    """``what`` over the last ``months`` periods, only if all are there."""
    w = Window.partitionBy(*dims).orderBy(index).rangeBetween(-(months - 1), 0)
    return F.when(F.count(value).over(w) == months, what(value).over(w))


def accumulated(df: DataFrame, dims: list[str], period: str, value: str, rows: str, limit: float = 500.0) -> DataFrame:
    """First to last change of a group with enough rows and periods, within ``limit``."""
    out = df.groupBy(*dims).agg(F.sum(rows).alias("rows"), F.count("*").alias("periods"), F.min_by(value, period).alias("first"), F.max_by(value, period).alias("last"))
    out = out.withColumn("variation", change(F.col("last"), F.col("first")))
    return out.filter((F.col("rows") >= 5) & (F.col("periods") >= 2) & (F.abs("variation") <= limit))


def at_or_before(df: DataFrame, dims: list[str], day: str, value: str, back: int) -> DataFrame:
    """Latest value of each series and its last value at least ``back`` days before."""
    latest = df.groupBy(*dims).agg(F.max(day).alias("last_day"), F.max_by(value, F.struct(day, value)).alias("last_value"))
    early = join_on(df, latest.select(*dims, "last_day"), dims).filter(F.col(day) <= F.date_sub("last_day", back))
    early = early.groupBy(*dims).agg(F.max(day).alias("prior_day"), F.max_by(value, F.struct(day, value)).alias("prior_value"))
    return join_on(latest, early, dims, "left").withColumn("variation", F.when(F.col("prior_value") > 0, change(F.col("last_value"), F.col("prior_value"))))


def latest_revision(df: DataFrame, group: list[str], capture: list[str]) -> DataFrame:
    """All rows of each group's newest capture; what that capture lacks is withdrawn."""
    newest = F.max(F.struct(*capture)).over(Window.partitionBy(*group))
    return df.withColumn("newest_", newest).filter(F.struct(*capture) == F.col("newest_")).drop("newest_")


def shares(df: DataFrame, period: list[str], part: str, value: str) -> DataFrame:
    """Share of the period's total and rank; null if a part is missing or negative, or the total is 0."""
    w = Window.partitionBy(*period)
    good = (F.count(value).over(w) == F.count(F.lit(1)).over(w)) & (F.min(value).over(w) >= 0) & (F.sum(value).over(w) > 0)
    out = df.withColumn("share", F.when(good, F.col(value).cast("double") / F.sum(value).over(w)))
    return out.withColumn("rank", F.rank().over(w.orderBy(F.desc(value))))


def reconciled_shares(parts: DataFrame, totals: DataFrame, period: list[str], part: str, value: str, total: str, top: int = 3) -> DataFrame:
    """Share of each part in a published total, rank, and the share of the ``top`` largest.

    Only of periods with one published total, above 0, whose parts are each there once, known, not
    negative, and add up to the total (within a ten-thousand-millionth of it, or a millionth).  ``top`` is null with
    fewer parts.
    """
    one = totals.groupBy(*period).agg(F.count("*").alias("k_"), F.max(total).cast("double").alias("total_")).filter("k_ = 1 AND total_ > 0").drop("k_")
    v = F.col(value).cast("double")
    g = parts.groupBy(*period).agg(F.count("*").alias("n_"), F.countDistinct(part).alias("kinds_"), F.count_if(v.isNull() | F.isnan(v) | (v < 0)).alias("bad_"), F.sum(v).alias("sum_"))
    near = F.abs(F.col("sum_") - F.col("total_")) <= F.greatest(F.lit(1e-6), F.abs("total_") * 1e-10)
    good = join_on(g, one, period).filter((F.col("bad_") == 0) & (F.col("kinds_") == F.col("n_")) & near).select(*period, "total_", "n_")
    w = Window.partitionBy(*period)
    j = join_on(parts, good, period).withColumn("rank", F.rank().over(w.orderBy(F.desc(v))))
    j = j.withColumn("share", v / F.col("total_"))
    first = F.row_number().over(w.orderBy(F.desc(v), F.col(part)))
    j = j.withColumn("first_", first)
    return j.withColumn(f"top{top}", F.when(F.col("n_") >= top, F.sum(F.when(F.col("first_") <= top, v)).over(w) / F.col("total_"))).drop("total_", "n_", "first_")


def exact_median(df: DataFrame, dims: list[str], value: str) -> DataFrame:
    """Median without leaving the value's decimal type: the mean of the middle one or two.  A series of
    any length is counted by value and scanned in segments."""
    return order_stats.exact_medians(df, dims, value)


def coarse_stats(df: DataFrame, dims: list[str], value: str) -> DataFrame:
    """Count, mean, exact median and range of groups that may hold very many rows."""
    q = order_stats.quantiles(df, dims, value, [0.5]).select(*dims, F.col("q0").alias("median"))
    g = df.groupBy(*dims).agg(F.count(value).alias("n"), mean(value).alias("mean"), F.min(value).alias("low"), F.max(value).alias("high"))
    return join_on(g, q, dims, "left")


def lineage(df: DataFrame, dims: list[str], links: list[str]) -> DataFrame:
    """One row for each link of a series and period: a table that grows with its rows, not a list in a cell."""
    return df.select(*dims, *links).distinct()


def frequency(df: DataFrame, dims: list[str], day: str) -> DataFrame:
    """Distinct days of each series, and whether the gaps between them are of years, months or neither."""
    days = df.select(*dims, day).distinct()
    gap = F.datediff(day, F.lag(day).over(Window.partitionBy(*dims).orderBy(day)))
    g = days.withColumn("gap_", gap).groupBy(*dims).agg(F.count("*").alias("days"), F.bool_and(F.col("gap_") >= 300).alias("y_"), F.bool_and(F.col("gap_").between(25, 45)).alias("m_"))
    return g.select(*dims, "days", F.when(F.col("y_"), "anual").when(F.col("m_"), "mensual").otherwise("diaria").alias("frequency"))


def state_matrix(df: DataFrame, by: list[str], item: str, index: str, value: str, periods: int, items: int) -> DataFrame:
    """Per part: the last ``periods`` of the ``items`` with the highest latest value, with the state of
    each change from the calendar's previous period."""
    w = Window.partitionBy(*by)
    last = df.select(*by, index).distinct().withColumn("r_", F.row_number().over(w.orderBy(F.desc(index)))).filter(F.col("r_") <= periods).drop("r_")
    top = df.groupBy(*by, item).agg(F.max_by(value, index).alias("x_")).withColumn("r_", F.row_number().over(w.orderBy(F.desc("x_"), item))).filter(F.col("r_") <= items).select(*by, item)
    c = adjacent_variation(df, [*by, item], index, value)
    return c.withColumn("state", grain_state(F.col("variation"))).transform(lambda x: join_on(join_on(x, last, [*by, index], "left_semi"), top, [*by, item], "left_semi"))


def largest_changes(df: DataFrame, index: str, value: str) -> DataFrame:
    """One row: the largest rise and fall between neighbouring periods, their periods, and the
    change from the first to the last; ``df`` has one row a period."""
    w = Window.orderBy(index)  # one row a period
    c = df.withColumn("change_", change(F.col(value), F.lag(value).over(w)))
    up, down = F.when(F.col("change_") > 0, F.col("change_")), F.when(F.col("change_") < 0, F.col("change_"))
    ends = change(F.max_by(value, index), F.min_by(value, index))
    return c.agg(F.max(up).alias("rise"), F.max_by(index, F.struct(up, index)).alias("rise_at"), F.min(down).alias("fall"), F.min_by(index, F.when(down.isNotNull(), F.struct(down, index))).alias("fall_at"), ends.alias("accumulated"))


def merge_history(daily: DataFrame, monthly: DataFrame, current: DataFrame, dims: list[str], day: str, value: str) -> DataFrame:
    """Monthly medians and their changes from 1 and 12 months before, after ``current`` days replace
    those of ``daily`` (a value that isn't positive removes its day).

    ``monthly`` is the stored table (dims, month_idx, median, change_1, change_12).  Only the months
    that ``current`` touches are aggregated anew, and only their own changes and those of the months
    1 and 12 behind them are recomputed; all other rows are taken as they are stored.
    """
    at = month_index(F.col(day)).alias("month_idx")
    touched = current.select(*dims, at).distinct()
    key = [*dims, "month_idx"]
    kept = join_on(join_on(daily.withColumn("month_idx", at), touched, key, "left_semi"), current.select(*dims, day), [*dims, day], "left_anti")
    new = kept.select(*key, value).unionByName(current.filter(F.col(value) > 0).select(*dims, at, value)).groupBy(*key).agg(F.median(F.col(value).cast("double")).alias("median"))
    merged = join_on(monthly, touched, key, "left_anti").unionByName(new.withColumn("change_1", F.lit(None).cast("double")).withColumn("change_12", F.lit(None).cast("double")))
    targets = touched.select(*dims, F.explode(F.array(*[F.col("month_idx") + k for k in (0, 1, 12)])).alias("month_idx")).distinct().withColumn("target_", F.lit(True))
    merged = join_on(merged, targets, key, "left")
    for k in (1, 12):
        before = merged.select(*dims, (F.col("month_idx") + k).alias("month_idx"), F.col("median").alias(f"before_{k}"))
        merged = join_on(merged, before, key, "left").withColumn(f"change_{k}", F.when(F.col("target_"), F.when(F.col(f"before_{k}") > 0, change(F.col("median"), F.col(f"before_{k}")))).otherwise(F.col(f"change_{k}"))).drop(f"before_{k}")
    return merged.select(*key, "median", "change_1", "change_12", F.coalesce("target_", F.lit(False)).alias("recomputed"))


def merge_daily(stored: DataFrame, current: DataFrame, dims: list[str], day: str, value: str, method: str, lags: tuple[int, ...] = (7, 30)) -> DataFrame:
    """Daily values and their changes from ``lags`` days before, after ``current`` days replace those of ``stored``
    (a value that isn't positive removes its day).

    ``stored`` has dims, day, value, method and change_<lag>.  A replaced day changes its own figures and
    those of the days ``lags`` behind it; only these are computed anew (``recomputed``), all other rows are
    taken as they are stored.  A change needs both values, of one method.
    """
    key = [*dims, day]
    changes = [f"change_{k}" for k in lags]
    fresh = current.filter(F.col(value) > 0).select(*key, value, method, *[F.lit(None).cast("double").alias(c) for c in changes])
    merged = join_on(stored.select(*key, value, method, *changes), current.select(*key), key, "left_anti").unionByName(fresh)
    targets = current.select(*dims, F.explode(F.array(*[F.date_add(day, k) for k in (0, *lags)])).alias(day)).distinct().withColumn("target_", F.lit(True))
    marked = join_on(merged, targets, key, "left")
    due = marked.filter("target_")
    for k, c in zip(lags, changes):
        prior = merged.select(*dims, F.date_add(day, k).alias(day), F.col(value).alias("before_"), F.col(method).alias("method_"))
        same = F.col(method).eqNullSafe(F.col("method_")) & (F.col("before_") > 0)
        due = join_on(due, prior, key, "left").withColumn(c, F.when(same, change(F.col(value), F.col("before_")))).drop("before_", "method_")
    rest = marked.filter("target_ IS NULL")
    return due.unionByName(rest).select(*key, value, method, *changes, F.coalesce("target_", F.lit(False)).alias("recomputed"))


def span_totals(df: DataFrame, dims: list[str], year: str, index: str, value: str) -> DataFrame:
    """Year to date where no month is missing, and the same span of the year before; one row a month."""
    w = Window.partitionBy(*dims, year).orderBy(index)
    whole = F.count("*").over(w) == F.col(index) % 12 + 1
    y = df.withColumn("ytd", F.when(whole, F.sum(value).over(w)))
    back = Window.partitionBy(*dims).orderBy(index).rangeBetween(-12, -12)
    return y.select(*dims, index, value, "ytd", F.when(F.col("ytd").isNotNull(), F.max("ytd").over(back)).alias("ytd_before"))


def seasonal_reference(df: DataFrame, dims: list[str], year: str, month: str, value: str, before: int, years: int = 5, least: int = 3) -> DataFrame:
    """Mean and range of each calendar month over the last whole years before ``before``; one row a month."""
    whole = df.filter(F.col(year) < before).groupBy(*dims, year).agg(F.count("*").alias("k_")).filter("k_ = 12")
    used = whole.withColumn("r_", F.row_number().over(Window.partitionBy(*dims).orderBy(F.desc(year)))).filter(F.col("r_") <= years).select(*dims, year)
    return join_on(df, used, [*dims, year]).groupBy(*dims, month).agg(F.count("*").alias("years"), mean(value).alias("mean"), F.min(value).alias("low"), F.max(value).alias("high")).filter(F.col("years") >= least)


def share_points(df: DataFrame, index: str, item: str, value: str, lag: int = 12) -> DataFrame:
    """Shares in a period, and their change in points from ``lag`` periods before where both have the
    same items; one row for each period and item."""
    w = Window.partitionBy(index)
    s = df.select(index, item, (F.col(value).cast("double") / F.sum(value).over(w)).alias("share"), F.count("*").over(w).alias("k_"))
    b = s.select((F.col(index) + lag).alias(index), item, F.col("share").alias("before_"), F.col("k_").alias("kb_"))
    j, matched = join_on(s, b, [index, item], "left"), F.count("before_").over(w)
    return j.select(index, item, "share", F.when((matched == F.col("k_")) & (matched == F.max("kb_").over(w)), (F.col("share") - F.col("before_")) * 100).alias("points"))


def month_matrix(df: DataFrame, row: str, month: str, value: str, least: int = 3) -> DataFrame:
    """Months as columns m1 to m12 and changes v2 to v12; rows of fewer than ``least`` months go."""
    p = df.groupBy(row).pivot(month, list(range(1, 13))).agg(F.first(value)).transform(lambda x: join_on(x, df.groupBy(row).count().filter(F.col("count") >= least).drop("count"), [row]))
    return p.select(row, *[F.col(str(k)).alias(f"m{k}") for k in range(1, 13)], *[change(F.col(str(k)), F.col(str(k - 1))).alias(f"v{k}") for k in range(2, 13)])


def year_grid(df: DataFrame, year: str, month: str, value: str) -> DataFrame:
    """Years by months, scaled to 0 to 1 over all cells; one row a year.

    A cell with several rows, or without a value, is empty and doesn't count for the scale; where all
    cells are equal they are 0.5.
    """
    cell = df.groupBy(year, month).agg(F.when(F.count("*") == 1, F.max(value).cast("double")).alias("v_"))
    p = cell.groupBy(year).pivot(month, list(range(1, 13))).agg(F.max("v_"))  # one row a year
    cells = [F.col(str(k)) for k in range(1, 13)]
    every = Window.partitionBy()
    p = p.withColumn("low_", F.min(F.least(*cells)).over(every)).withColumn("high_", F.max(F.greatest(*cells)).over(every))
    scaled = lambda c: F.when(F.col("high_") > F.col("low_"), (c - F.col("low_")) / (F.col("high_") - F.col("low_"))).otherwise(F.when(c.isNotNull(), 0.5))
    return p.select(year, *[scaled(c).alias(f"m{k}") for k, c in enumerate(cells, 1)])


def carry_forward(df: DataFrame, partition: list[str], order: str, column: str, parts: int | None = None) -> DataFrame:
    """``df`` with ``column`` filled: its last value that isn't null, up to the row; a part may be of any length."""
    return scan.carried(df, partition, [order], [column], parts)


def latest_metrics(df: DataFrame, item: str, period: str, metrics: dict[str, Column]) -> DataFrame:
    """Metrics of each item in the last period."""
    last = df.agg(F.max(period).alias(period))
    return df.join(last, period, "left_semi").groupBy(item).agg(*[c.alias(n) for n, c in metrics.items()])
