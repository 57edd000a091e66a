"""Queries on series: statistics, variations, windows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from seriesloom.functions.dates import day_index
from seriesloom.operators import series as S
from seriesloom.plans.base import MONTHLY, OBS, SERIES, observations, query, settled, table
from seriesloom.sources.tables import written

_STATE = "CASE WHEN {v} IS NULL THEN 'Sin dato' WHEN abs({v}) > 50 THEN 'Revisar' WHEN {v} < -5 THEN 'Baja' WHEN {v} <= 5 THEN 'Estable' WHEN {v} <= 20 THEN 'Suba moderada' ELSE 'Suba fuerte' END"
_PRIOR = "LEFT JOIN {t} {a} ON {a}.product = m.product AND {a}.currency = m.currency AND {a}.condition IS NOT DISTINCT FROM m.condition AND {a}.{i} = m.{i} - {k} AND {a}.{v} > 0"


def monthly(spark, d):
    return S.period_stats(observations(spark, d).filter("price_c > 0"), SERIES, ["month", "month_idx"], "price_c")


@query("series_monthly_state", f"""WITH {MONTHLY} SELECT product, currency, condition, month, n, mean, median, low, high, days, vm AS change_month, vy AS change_year,
 {_STATE.format(v='vm')} AS state, month_idx = max(month_idx) OVER (PARTITION BY product, currency, condition) AS is_latest FROM
 (SELECT m.*, (m.median / p.median - 1) * 100 AS vm, (m.median / y.median - 1) * 100 AS vy FROM monthly m {_PRIOR.format(t='monthly', a='p', i='month_idx', k=1, v='median')} {_PRIOR.format(t='monthly', a='y', i='month_idx', k=12, v='median')})""")
def series_monthly_state(spark, d):
    m = monthly(spark, d)
    m = m.withColumn("change_month", S.change(F.col("median"), S.exact_prior("median", SERIES, "month_idx", 1))).withColumn("change_year", S.change(F.col("median"), S.exact_prior("median", SERIES, "month_idx", 12)))
    latest = F.col("month_idx") == F.max("month_idx").over(Window.partitionBy(*SERIES))
    return m.withColumn("state", S.grain_state(F.col("change_month"))).withColumn("is_latest", latest).drop("month_idx")


@query("series_daily_exact", f"""WITH {OBS}, dd AS (SELECT product, currency, condition, day, CAST(day - DATE '1970-01-01' AS INTEGER) AS di, count(*) AS n, median(CAST(price_c AS DOUBLE)) AS median FROM obs GROUP BY ALL)
 SELECT m.product, m.currency, m.condition, m.day, m.n, m.median, (m.median / p.median - 1) * 100 AS change_week, (m.median / y.median - 1) * 100 AS change_30
 FROM dd m {_PRIOR.format(t='dd', a='p', i='di', k=7, v='median')} {_PRIOR.format(t='dd', a='y', i='di', k=30, v='median')}""", dates=("day",))
def series_daily_exact(spark, d):
    m = observations(spark, d).groupBy(*SERIES, "day").agg(F.count("*").alias("n"), F.median(F.col("price_c").cast("double")).alias("median")).withColumn("di", day_index(F.col("day")))
    return m.withColumn("change_week", S.change(F.col("median"), S.exact_prior("median", SERIES, "di", 7))).withColumn("change_30", S.change(F.col("median"), S.exact_prior("median", SERIES, "di", 30))).drop("di")


@query("series_at_or_before", f"""WITH {OBS}, dd AS (SELECT product, currency, condition, day, CAST(sum(price_c) AS BIGINT) AS v FROM obs GROUP BY ALL),
 l AS (SELECT product, currency, condition, max(day) AS last_day, arg_max(v, day) AS last_value FROM dd GROUP BY ALL),
 e AS (SELECT dd.product, dd.currency, dd.condition, max(day) AS prior_day, arg_max(v, day) AS prior_value FROM dd JOIN l ON dd.product = l.product AND dd.currency = l.currency AND dd.condition IS NOT DISTINCT FROM l.condition WHERE day <= last_day - 7 GROUP BY ALL)
 SELECT l.*, prior_day, prior_value, CASE WHEN prior_value > 0 THEN (CAST(last_value AS DOUBLE) / prior_value - 1) * 100 END AS variation FROM l LEFT JOIN e ON e.product = l.product AND e.currency = l.currency AND e.condition IS NOT DISTINCT FROM l.condition""", dates=("last_day", "prior_day"))
def series_at_or_before(spark, d):
    daily = observations(spark, d).groupBy(*SERIES, "day").agg(F.sum("price_c").alias("v"))
    return S.at_or_before(daily, SERIES, "day", "v", 7)


@query("series_weighted", f"""WITH {OBS}, o AS (SELECT *, CASE WHEN variety = 'ECONOMY' AND volume > 45 THEN NULL WHEN volume = 1 THEN -1 ELSE volume END AS vol FROM obs)
 SELECT product, currency, condition, month, count(*) AS n, CAST(CASE WHEN count(vol) = count(*) THEN sum(vol) END AS BIGINT) AS volume, CAST(sum(CASE WHEN vol >= 0 THEN vol END) AS BIGINT) AS known_volume,
 CASE WHEN count(vol) = count(*) AND bool_and(vol >= 0) AND sum(vol) > 0 THEN CAST(sum(price_c * vol) AS DOUBLE) / CAST(sum(vol) AS DOUBLE) END AS weighted FROM o GROUP BY ALL""")
def series_weighted(spark, d):
    o = observations(spark, d).withColumn("vol", F.when((F.col("variety") == "ECONOMY") & (F.col("volume") > 45), None).when(F.col("volume") == 1, -1).otherwise(F.col("volume")))
    return S.weighted_price(o, [*SERIES, "month"], "price_c", "vol")


@query("series_lineage", f"""WITH {OBS}, e AS (SELECT DISTINCT product, currency, condition, month, event_id, market FROM obs) SELECT product, currency, condition, month, count(DISTINCT event_id) AS events, CAST(sum(event_id * 31 + CAST(substr(market, 2) AS BIGINT)) AS BIGINT) AS links_sum, count(*) AS links, string_agg(DISTINCT market, ',' ORDER BY market) AS markets FROM e GROUP BY ALL""")
def series_lineage(spark, d):
    """Links from a series and month to its events, written as a table; their numbers and markets."""
    links = written(S.lineage(observations(spark, d), [*SERIES, "month"], ["event_id", "market"]))
    markets = F.array_join(F.array_sort(F.collect_set("market")), ",")  # few
    return links.groupBy(*SERIES, "month").agg(F.countDistinct("event_id").alias("events"), F.sum(F.col("event_id") * 31 + F.substring("market", 2, 9).cast("bigint")).alias("links_sum"), F.count("*").alias("links"), markets.alias("markets"))


@query("series_latest", f"""WITH {MONTHLY} SELECT product, currency, condition, month, n, median FROM monthly QUALIFY row_number() OVER (PARTITION BY product, currency, condition ORDER BY month DESC) = 1""")
def series_latest(spark, d):
    return S.latest_rows(monthly(spark, d).select(*SERIES, "month", "n", "median"), SERIES, ["month"])


@query("series_balanced_mean", f"""WITH {OBS}, a AS (SELECT product, year, month, day, avg(CAST(price_c AS DOUBLE)) AS v FROM obs GROUP BY ALL), b AS (SELECT product, year, month, avg(v) AS v FROM a GROUP BY ALL)
 SELECT product, year, floor(avg(v) * 1000 + 0.2718) / 1000 AS v, count(*) AS parts FROM b GROUP BY ALL""")
def series_balanced_mean(spark, d):
    return S.balanced(observations(spark, d), ["product"], ["year", "month", "day"], "price_c").withColumn("v", settled(F.col("v")))


@query("series_day_balanced_month", f"""WITH {OBS}, u AS (SELECT DISTINCT product, currency, month, day, market, price_c FROM obs), a AS (SELECT product, currency, month, day, CAST(sum(price_c) AS DOUBLE) / count(*) AS m, count(*) AS q FROM u GROUP BY ALL)
 SELECT product, currency, month, floor(avg(m) * 1000 + 0.2718) / 1000 AS mean, min(m) AS low, max(m) AS high, count(*) AS days, CAST(sum(q) AS BIGINT) AS quotes FROM a GROUP BY ALL""")
def series_day_balanced_month(spark, d):
    return S.day_balanced_months(observations(spark, d), ["product", "currency"], ["market", "price_c"], "price_c").withColumn("mean", settled(F.col("mean")))


@query("series_day_median", f"""WITH {OBS}, a AS (SELECT market, product, month, day, median(CAST(price_c AS DOUBLE)) AS m, min(condition) AS g1, max(condition) AS g2 FROM obs GROUP BY ALL)
 SELECT market, product, month, CASE WHEN min(g1) = max(g2) THEN median(m) END AS median, count(*) AS days FROM a GROUP BY ALL""")
def series_day_median(spark, d):
    return S.day_median(observations(spark, d), ["market", "product"], "price_c", "condition")


@query("series_mean_of_days", f"""WITH {OBS}, a AS (SELECT product, month, day, CAST(sum(price_c) AS DOUBLE) / count(*) AS m, min(event_id) AS e FROM obs GROUP BY ALL) SELECT product, month, floor(avg(m) * 1000 + 0.2718) / 1000 AS mean, string_agg(CAST(e AS VARCHAR), ',' ORDER BY day) AS inputs FROM a GROUP BY ALL""")
def series_mean_of_days(spark, d):
    daily = observations(spark, d).groupBy("product", "month", "day").agg(S.mean("price_c").alias("m"), F.min("event_id").alias("e"))
    inputs = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("day", "e"))), lambda x: x.e.cast("string")), ",")
    return daily.groupBy("product", "month").agg(settled(F.avg("m")).alias("mean"), inputs.alias("inputs"))


@query("series_exact_median", f"""WITH {OBS} SELECT product, month, median(CAST(price_c AS DOUBLE)) AS median, count(*) AS n FROM obs GROUP BY product, month""")
def series_exact_median(spark, d):
    o = observations(spark, d).withColumn("price", F.col("price_c").cast("decimal(18,4)"))
    return S.exact_median(o, ["product", "month"], "price").select("product", "month", F.col("median").cast("double").alias("median"), "n")


@query("series_adjacent_variation", f"""WITH {MONTHLY} SELECT product, currency, condition, month, median, CASE WHEN month_idx - lag(month_idx) OVER w = 1 AND lag(median) OVER w > 0 THEN (median / lag(median) OVER w - 1) * 100 END AS variation
 FROM monthly WINDOW w AS (PARTITION BY product, currency, condition ORDER BY month_idx)""")
def series_adjacent_variation(spark, d):
    return S.adjacent_variation(monthly(spark, d), SERIES, "month_idx", "median").select(*SERIES, "month", "median", "variation")


@query("series_daily_observed", f"""WITH {OBS}, dd AS (SELECT product, currency, day, CAST(sum(price_c) AS BIGINT) AS v, count(*) % 3 = 0 AS method FROM obs GROUP BY ALL), w AS (SELECT *, lag(day) OVER s AS previous_day, lag(v) OVER s AS pv, lag(method) OVER s AS pm FROM dd WHERE v > 0 WINDOW s AS (PARTITION BY product, currency ORDER BY day))
 SELECT product, currency, day, v, method, previous_day, CASE WHEN method = pm THEN (CAST(v AS DOUBLE) / pv - 1) * 100 END AS variation FROM w""", dates=("day", "previous_day"))
def series_daily_observed(spark, d):
    """Change of each day from the series' previous observed day, unless the method changed."""
    dd = observations(spark, d).groupBy("product", "currency", "day").agg(F.sum("price_c").alias("v"), (F.count("*") % 3 == 0).alias("method"))
    return S.observed_variation(dd, ["product", "currency"], "day", "v", "method")


@query("series_coarse_stats", f"""WITH {OBS} SELECT currency, count(*) AS n, CAST(sum(price_c) AS DOUBLE) / count(*) AS mean, median(CAST(price_c AS DOUBLE)) AS median, min(price_c) AS low, max(price_c) AS high FROM obs GROUP BY ALL""")
def series_coarse_stats(spark, d):
    """Statistics of three groups that hold a third of all rows each."""
    return S.coarse_stats(observations(spark, d), ["currency"], "price_c")


@query("series_reconciled_shares", f"""WITH {OBS}, p AS (SELECT year, product, CAST(sum(volume) AS BIGINT) AS v FROM obs GROUP BY ALL), t AS (SELECT year, sum(v) + CASE WHEN year % 3 = 0 THEN 1 ELSE 0 END AS total FROM p GROUP BY year UNION ALL SELECT year, 1 FROM p WHERE year % 4 = 1 GROUP BY year),
 one AS (SELECT year, max(total) AS total FROM t GROUP BY year HAVING count(*) = 1), g AS (SELECT year, sum(v) AS s, count(*) AS n FROM p GROUP BY year), j AS (SELECT p.*, total, n, rank() OVER (PARTITION BY year ORDER BY v DESC) AS rank, row_number() OVER (PARTITION BY year ORDER BY v DESC, product) AS r FROM p JOIN one USING (year) JOIN g USING (year) WHERE s = total)
 SELECT year, product, v, CAST(rank AS INTEGER) AS rank, CAST(v AS DOUBLE) / total AS share, CASE WHEN n >= 3 THEN CAST(sum(CASE WHEN r <= 3 THEN v END) OVER (PARTITION BY year) AS DOUBLE) / total END AS top3 FROM j""")
def series_reconciled_shares(spark, d):
    """Shares in a published total: years whose parts don't add up to it, or that have two totals, have none."""
    p = observations(spark, d).groupBy("year", "product").agg(F.sum("volume").alias("v"))
    t = p.groupBy("year").agg((F.sum("v") + F.when(F.col("year") % 3 == 0, 1).otherwise(0)).alias("total"))
    t = t.unionByName(p.filter("year % 4 = 1").select("year").distinct().withColumn("total", F.lit(1).cast("bigint")))
    return S.reconciled_shares(p, t, ["year"], "product", "v", "total")


@query("series_method_guard", f"""WITH {MONTHLY}, g AS (SELECT *, n % 2 = 0 AS method FROM monthly) SELECT product, currency, condition, month, CASE WHEN method = lag(method) OVER w AND month_idx - lag(month_idx) OVER w = 1 AND lag(median) OVER w > 0 THEN (median / lag(median) OVER w - 1) * 100 END AS variation
 FROM g WINDOW w AS (PARTITION BY product, currency, condition ORDER BY month_idx)""")
def series_method_guard(spark, d):
    m = monthly(spark, d).withColumn("method", F.col("n") % 2 == 0)
    return S.guarded_variation(m, SERIES, "month_idx", "median", "method").select(*SERIES, "month", "variation")


@query("series_filled_months", f"""WITH {MONTHLY}, s AS (SELECT product, currency, condition, unnest(range(min(month_idx), max(month_idx) + 1)) AS month_idx FROM monthly GROUP BY product, currency, condition)
 SELECT s.product, s.currency, s.condition, CAST(s.month_idx AS INTEGER) AS month_idx, n, median FROM s LEFT JOIN monthly m ON m.product = s.product AND m.currency = s.currency AND m.condition IS NOT DISTINCT FROM s.condition AND m.month_idx = s.month_idx""")
def series_filled_months(spark, d):
    return S.fill_months(monthly(spark, d), SERIES, "month_idx").select(*SERIES, "month_idx", "n", "median")


@query("series_trailing_year", f"""WITH {MONTHLY}, t AS (SELECT product, currency, condition, month, n, count(n) OVER w AS k, sum(n) OVER w AS s FROM monthly WINDOW w AS (PARTITION BY product, currency, condition ORDER BY month_idx RANGE BETWEEN 11 PRECEDING AND CURRENT ROW))
 SELECT product, currency, condition, month, n, CASE WHEN k = 12 THEN CAST(s AS DOUBLE) / 12 END AS trailing_mean, CASE WHEN k = 12 THEN n - CAST(s AS DOUBLE) / 12 END AS difference FROM t""")
def series_trailing_year(spark, d):
    m = monthly(spark, d).withColumn("trailing_mean", S.trailing("n", SERIES, "month_idx", 12, F.sum).cast("double") / 12)
    return m.select(*SERIES, "month", "n", "trailing_mean", (F.col("n") - F.col("trailing_mean")).alias("difference"))


@query("series_seasonal_reference", f"""WITH {OBS}, v AS (SELECT product, year, month_idx % 12 AS m, CAST(sum(volume) AS BIGINT) AS v FROM obs GROUP BY ALL), full_years AS (SELECT product, year FROM v WHERE year < 2000 GROUP BY ALL HAVING count(*) = 12),
 used AS (SELECT * FROM full_years QUALIFY row_number() OVER (PARTITION BY product ORDER BY year DESC) <= 5)
 SELECT product, CAST(m AS INTEGER) AS m, count(*) AS years, CAST(sum(v) AS DOUBLE) / count(*) AS mean, min(v) AS low, max(v) AS high FROM v JOIN used USING (product, year) GROUP BY ALL HAVING count(*) >= 3""")
def series_seasonal_reference(spark, d):
    v = observations(spark, d).groupBy("product", "year", (F.col("month_idx") % 12).alias("m")).agg(F.sum("volume").alias("v"))
    return S.seasonal_reference(v, ["product"], "year", "m", "v", 2000)


@query("series_range_36", f"""WITH {MONTHLY} SELECT product, currency, condition, month, median, min(median) OVER w AS low_36, max(median) OVER w AS high_36 FROM monthly WINDOW w AS (PARTITION BY product, currency, condition ORDER BY month_idx RANGE BETWEEN 36 PRECEDING AND 1 PRECEDING)""")
def series_range_36(spark, d):
    w = Window.partitionBy(*SERIES).orderBy("month_idx").rangeBetween(-36, -1)
    return monthly(spark, d).select(*SERIES, "month", "median", F.min("median").over(w).alias("low_36"), F.max("median").over(w).alias("high_36"))


@query("series_shares", f"""WITH {OBS}, t AS (SELECT year, product, CAST(sum(volume) AS BIGINT) AS v FROM obs GROUP BY ALL), r AS (SELECT *, CAST(v AS DOUBLE) / CAST(sum(v) OVER (PARTITION BY year) AS DOUBLE) AS share, rank() OVER (PARTITION BY year ORDER BY v DESC) AS rank FROM t)
 SELECT year, product, v, share, CAST(rank AS INTEGER) AS rank, CAST(sum(CASE WHEN rank <= 3 THEN v END) OVER (PARTITION BY year) AS DOUBLE) / CAST(sum(v) OVER (PARTITION BY year) AS DOUBLE) AS top3 FROM r""")
def series_shares(spark, d):
    t = observations(spark, d).groupBy("year", "product").agg(F.sum("volume").alias("v"))
    w = Window.partitionBy("year")
    return S.shares(t, ["year"], "product", "v").withColumn("top3", F.sum(F.when(F.col("rank") <= 3, F.col("v"))).over(w).cast("double") / F.sum("v").over(w))


@query("series_share_points", f"""WITH {OBS}, t AS (SELECT month_idx, market, CAST(sum(volume) AS BIGINT) AS v FROM obs GROUP BY ALL), s AS (SELECT *, CAST(v AS DOUBLE) / CAST(sum(v) OVER (PARTITION BY month_idx) AS DOUBLE) AS share, count(*) OVER (PARTITION BY month_idx) AS k FROM t),
 m AS (SELECT a.month_idx, count(*) AS matched, max(a.k) AS ka, max(b.k) AS kb FROM s a JOIN s b ON b.month_idx = a.month_idx - 12 AND b.market = a.market GROUP BY 1)
 SELECT a.month_idx, a.market, a.share, CASE WHEN matched = ka AND matched = kb THEN (a.share - b.share) * 100 END AS points FROM s a LEFT JOIN s b ON b.month_idx = a.month_idx - 12 AND b.market = a.market LEFT JOIN m ON m.month_idx = a.month_idx""")
def series_share_points(spark, d):
    t = observations(spark, d).groupBy("month_idx", "market").agg(F.sum("volume").alias("v"))
    return S.share_points(t, "month_idx", "market", "v")


@query("series_accumulated", f"""WITH {MONTHLY}, g AS (SELECT product, currency, condition, CAST(sum(n) AS BIGINT) AS rows, count(*) AS periods, arg_min(median, month_idx) AS first, arg_max(median, month_idx) AS last FROM monthly GROUP BY ALL)
 SELECT *, (last / first - 1) * 100 AS variation FROM g WHERE rows >= 5 AND periods >= 2 AND abs((last / first - 1) * 100) <= 500""")
def series_accumulated(spark, d):
    return S.accumulated(monthly(spark, d), SERIES, "month_idx", "median", "n")


@query("series_month_matrix", f"""WITH {OBS}, t AS (SELECT product, month_idx % 12 + 1 AS m, CAST(sum(volume) AS BIGINT) AS v FROM obs WHERE year = 1998 GROUP BY ALL) SELECT product, {', '.join(f'CAST(sum(CASE WHEN m = {k} THEN v END) AS BIGINT) AS m{k}' for k in range(1, 13))},
 {', '.join(f'(CAST(sum(CASE WHEN m = {k} THEN v END) AS DOUBLE) / CAST(sum(CASE WHEN m = {k - 1} THEN v END) AS DOUBLE) - 1) * 100 AS v{k}' for k in range(2, 13))} FROM t GROUP BY product HAVING count(*) >= 3""")
def series_month_matrix(spark, d):
    t = observations(spark, d).filter("year = 1998").groupBy("product", (F.col("month_idx") % 12 + 1).alias("m")).agg(F.sum("volume").alias("v"))
    return S.month_matrix(t, "product", "m", "v")


@query("series_state_matrix", f"""WITH {MONTHLY}, t AS (SELECT currency, product, month, month_idx, CAST(sum(n) AS BIGINT) AS v FROM monthly GROUP BY ALL), p AS (SELECT currency, month_idx FROM (SELECT DISTINCT currency, month_idx FROM t) QUALIFY row_number() OVER (PARTITION BY currency ORDER BY month_idx DESC) <= 12),
 l AS (SELECT currency, product, arg_max(v, month_idx) AS x FROM t GROUP BY ALL), top AS (SELECT currency, product FROM l QUALIFY row_number() OVER (PARTITION BY currency ORDER BY x DESC, product) <= 10), c AS (SELECT t.*, CASE WHEN month_idx - lag(month_idx) OVER w = 1 THEN (CAST(v AS DOUBLE) / lag(v) OVER w - 1) * 100 END AS x FROM t WINDOW w AS (PARTITION BY currency, product ORDER BY month_idx))
 SELECT currency, product, month, v, {_STATE.format(v='x')} AS state FROM c JOIN p USING (currency, month_idx) JOIN top USING (currency, product)""")
def series_state_matrix(spark, d):
    """Of every currency: the last twelve months of the ten products with the highest latest figure."""
    t = monthly(spark, d).groupBy("currency", "product", "month", "month_idx").agg(F.sum("n").alias("v"))
    return S.state_matrix(t, ["currency"], "product", "month_idx", "v", 12, 10).select("currency", "product", "month", "v", "state")


@query("series_frequency", f"""WITH {OBS}, g AS (SELECT product, variety, currency, condition, market, day - lag(day) OVER (PARTITION BY product, variety, currency, condition, market ORDER BY day) AS gap FROM (SELECT DISTINCT product, variety, currency, condition, market, day FROM obs))
 SELECT product, variety, currency, condition, market, count(*) AS days, CASE WHEN count(gap) > 0 AND bool_and(gap >= 300) THEN 'anual' WHEN count(gap) > 0 AND bool_and(gap BETWEEN 25 AND 45) THEN 'mensual' ELSE 'diaria' END AS frequency FROM g GROUP BY ALL""")
def series_frequency(spark, d):
    """How often each series is observed, by the gaps between its days."""
    return S.frequency(observations(spark, d), ["product", "variety", "currency", "condition", "market"], "day")


@query("series_latest_revision", """WITH e AS (SELECT *, CAST(ts AS DATE) AS day, hour(ts) // 6 AS capture FROM events) SELECT event_id, user_id, event_type, day, CAST(capture AS INTEGER) AS capture FROM e QUALIFY capture = max(capture) OVER (PARTITION BY user_id, day)""", dates=("day",))
def series_latest_revision(spark, d):
    e = table(spark, d, "events").withColumn("day", F.to_date("ts")).withColumn("capture", F.floor(F.hour("ts") / 6).cast("int"))
    return S.latest_revision(e, ["user_id", "day"], ["capture"]).select("event_id", "user_id", "event_type", "day", "capture")


@query("series_year_grid", f"""WITH {OBS}, t AS (SELECT year, month_idx % 12 + 1 AS m, market = 'M1' AND month_idx % 7 = 0 AS apart, CAST(sum(volume) AS BIGINT) AS v FROM obs GROUP BY ALL), c AS (SELECT year, m, CASE WHEN count(*) = 1 THEN CAST(max(v) AS DOUBLE) END AS v FROM t GROUP BY ALL), n AS (SELECT year, m, (v - min(v) OVER ()) / (max(v) OVER () - min(v) OVER ()) AS x FROM c)
 SELECT year, {', '.join(f'max(CASE WHEN m = {k} THEN x END) AS m{k}' for k in range(1, 13))} FROM n GROUP BY year""")
def series_year_grid(spark, d):
    """Monthly volumes; in every seventh month one market is published apart, and the cell is empty."""
    t = observations(spark, d).groupBy("year", (F.col("month_idx") % 12 + 1).alias("m"), F.expr("market = 'M1' AND month_idx % 7 = 0").alias("apart")).agg(F.sum("volume").alias("v"))
    return S.year_grid(t, "year", "m", "v")


@query("series_category_carry", f"""WITH l AS (SELECT l_orderkey AS o, l_linenumber AS k, min(CASE WHEN l_returnflag = 'R' THEN 'cat' || CAST(l_linenumber AS VARCHAR) END) AS cat FROM lineitem GROUP BY ALL) SELECT o, k, last_value(cat IGNORE NULLS) OVER (PARTITION BY o ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS category FROM l""")
def series_category_carry(spark, d):
    li = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("k")).agg(F.min(F.when(F.col("l_returnflag") == "R", F.concat(F.lit("cat"), F.col("l_linenumber").cast("string")))).alias("cat"))
    return S.carry_forward(li, ["o"], "k", "cat").withColumnRenamed("cat", "category")


@query("series_metrics_row", f"""WITH {OBS}, m AS (SELECT max(month) AS month FROM obs) SELECT product, CAST(sum(volume) AS BIGINT) AS volume, count(*) AS rows, max(price_c) AS high FROM obs JOIN m USING (month) GROUP BY ALL""")
def series_metrics_row(spark, d):
    return S.latest_metrics(observations(spark, d), "product", "month", {"volume": F.sum("volume"), "rows": F.count("*"), "high": F.max("price_c")})