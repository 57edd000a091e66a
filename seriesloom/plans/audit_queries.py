"""Queries on coverage, audits, inventories, rankings and key figures."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from seriesloom.operators import audit as A
from seriesloom.operators import figures as G
from seriesloom.operators import rank as R
from seriesloom.operators import series as S
from seriesloom.operators.quality import reasons
from seriesloom.plans.base import OBS, observations, query, settled, table
from seriesloom.sources import tables as IO

_STATS = "count(*) AS n, CAST(sum(price_c) AS DOUBLE) / count(*) AS mean, min(price_c) AS low, max(price_c) AS high"
_CV = "CASE WHEN count(*) > 1 AND sum(price_c) <> 0 THEN sqrt((CAST(sum(CAST(price_c AS HUGEINT) * price_c) AS DOUBLE) - CAST(sum(price_c) AS DOUBLE) * CAST(sum(price_c) AS DOUBLE) / count(*)) / (count(*) - 1)) / (CAST(sum(price_c) AS DOUBLE) / count(*)) END AS cv"
_AS_OF = "2001-10-20"


@query("audit_coverage_levels", f"""WITH {OBS} SELECT year, product, month, {_STATS}, count(DISTINCT day) AS days, CASE grouping_id(year, product, month) WHEN 3 THEN 'anio' WHEN 5 THEN 'producto' WHEN 1 THEN 'producto_anio' WHEN 6 THEN 'mes' END AS level FROM obs GROUP BY GROUPING SETS ((year), (product), (year, product), (month))""")
def audit_coverage_levels(spark, d):
    sets = [["year"], ["product"], ["year", "product"], ["month"]]
    return A.levels(observations(spark, d), sets, ["anio", "producto", "producto_anio", "mes"], [F.count("*").alias("n"), S.mean("price_c").alias("mean"), F.min("price_c").alias("low"), F.max("price_c").alias("high"), F.countDistinct("day").alias("days")])


@query("audit_dispersion", f"WITH {OBS} SELECT product, currency, month, {_STATS}, {_CV} FROM obs GROUP BY product, currency, month")
def audit_dispersion(spark, d):
    return observations(spark, d).groupBy("product", "currency", "month").agg(*A.dispersion("price_c"))


@query("audit_grades", f"""WITH {OBS}, g AS (SELECT product, variety, market, count(*) AS n, count(DISTINCT day) AS dates, count(DISTINCT month) AS months, CAST(count(*) FILTER (WHERE price_c < 1000000) AS DOUBLE) * 100 / count(*) AS valid FROM obs GROUP BY ALL)
 SELECT *, CASE WHEN n >= 30 AND dates >= 20 AND valid > 90 THEN 'Alta' WHEN n >= 10 AND dates >= 5 AND valid > 70 THEN 'Media' ELSE 'Baja' END AS grain, CASE WHEN n >= 20 AND dates >= 10 AND months >= 3 AND valid > 80 THEN 'Alta' WHEN n >= 10 AND dates >= 5 AND months >= 2 AND valid > 60 THEN 'Media' ELSE 'Baja' END AS wholesale FROM g""")
def audit_grades(spark, d):
    g = observations(spark, d).groupBy("product", "variety", "market").agg(F.count("*").alias("n"), F.countDistinct("day").alias("dates"), F.countDistinct("month").alias("months"), (F.count_if(F.col("price_c") < 1000000).cast("double") * 100 / F.count("*")).alias("valid"))
    n, dates, valid = F.col("n"), F.col("dates"), F.col("valid")
    return g.withColumn("grain", A.grade(n, dates, valid)).withColumn("wholesale", A.grade(n, dates, valid, F.col("months")))


def _fresh_sql(back7, back30, age, status):
    return f"""WITH {OBS}, g AS (SELECT product, market, max(day) AS last_day, count(*) FILTER (WHERE day BETWEEN DATE '{_AS_OF}' - {back7} AND DATE '{_AS_OF}') AS rows_7, count(*) FILTER (WHERE day BETWEEN DATE '{_AS_OF}' - {back30} AND DATE '{_AS_OF}') AS rows_30 FROM obs GROUP BY ALL), a AS (SELECT *, CAST(DATE '{_AS_OF}' - last_day AS INTEGER) AS x FROM g) SELECT product, market, last_day, rows_7, rows_30, {age} AS age, {status} AS status FROM a"""


_STATUS = "WHEN x <= 7 THEN 'Actual' WHEN x <= 30 THEN 'Reciente' ELSE 'Desactualizado' END"


@query("audit_freshness_grain", _fresh_sql(7, 30, "greatest(x, 0)", f"CASE {_STATUS}"), dates=("last_day",))
def audit_freshness_grain(spark, d):
    return A.freshness(observations(spark, d), ["product", "market"], "day", _AS_OF, "grain")


@query("audit_freshness_transactions", _fresh_sql(6, 29, "x", f"CASE WHEN x < 0 THEN 'Fecha futura' {_STATUS}"), dates=("last_day",))
def audit_freshness_transactions(spark, d):
    return A.freshness(observations(spark, d), ["product", "market"], "day", _AS_OF, "transactions")


@query("audit_month_coverage", f"""WITH {OBS}, g AS (SELECT product, variety, currency, market, count(DISTINCT month_idx) AS observed, CAST(max(month_idx) - min(month_idx) + 1 AS BIGINT) AS expected FROM obs GROUP BY ALL) SELECT *, expected - observed AS missing, observed >= 3 AND observed >= 0.9 * expected AS fit FROM g""")
def audit_month_coverage(spark, d):
    return A.month_coverage(observations(spark, d), ["product", "variety", "currency", "market"], "month_idx")


@query("audit_month_ranges", f"WITH {OBS} SELECT market, product, month, count(*) AS n, min(price_c) AS low, max(price_c) AS high FROM obs WHERE price_c > 0 GROUP BY ALL")
def audit_month_ranges(spark, d):
    return observations(spark, d).filter("price_c > 0").groupBy("market", "product", "month").agg(F.count("*").alias("n"), F.min("price_c").alias("low"), F.max("price_c").alias("high"))


@query("audit_dimension_summary", f"WITH {OBS} SELECT market, variety, count(*) AS rows, count(DISTINCT day) AS dates, count(DISTINCT month) AS months, count(DISTINCT product) AS products, CAST(count(*) FILTER (WHERE price_c < 1000000) AS DOUBLE) * 100 / count(*) AS valid FROM obs GROUP BY ALL")
def audit_dimension_summary(spark, d):
    return observations(spark, d).groupBy("market", "variety").agg(F.count("*").alias("rows"), F.countDistinct("day").alias("dates"), F.countDistinct("month").alias("months"), F.countDistinct("product").alias("products"), (F.count_if(F.col("price_c") < 1000000).cast("double") * 100 / F.count("*")).alias("valid"))


@query("audit_packages", """SELECT p_type, p_size % 9 AS kg, count(*) AS rows, count(*) FILTER (WHERE p_size % 9 = 0) AS without_kg, string_agg(DISTINCT p_brand, ' | ' ORDER BY p_brand) AS products FROM part GROUP BY ALL""")
def audit_packages(spark, d):
    kg = F.col("p_size") % 9
    return table(spark, d, "part").groupBy("p_type", kg.alias("kg")).agg(F.count("*").alias("rows"), F.count_if(kg == 0).alias("without_kg"), A.joined("p_brand").alias("products"))


@query("audit_yearly_diagnostic", f"""WITH {OBS}, g AS (SELECT market, year, count(*) AS n, count(DISTINCT month) AS months, count(DISTINCT product) AS products, CAST(count(*) FILTER (WHERE volume % 9 = 0) AS DOUBLE) / count(*) AS no_kg FROM obs GROUP BY ALL) SELECT market, year, n, months, products, concat_ws('; ', CASE WHEN months < 12 THEN 'meses incompletos' END, CASE WHEN n < 2000 THEN 'pocas filas' END, CASE WHEN no_kg > 0.1 THEN 'kg faltantes' END) AS reasons FROM g""")
def audit_yearly_diagnostic(spark, d):
    g = A.yearly_diagnostic(observations(spark, d), ["market", "year"], "month", "product", F.col("volume") % 9 == 0, 2000, 0.1)
    return g.select("market", "year", "n", "months", "products", F.array_join("reasons", "; ").alias("reasons"))


@query("audit_counters", f"""WITH {OBS}, k AS (SELECT count(*) - count(DISTINCT (event_id, line)) AS repeats FROM obs) SELECT count(*) AS rows, count(*) FILTER (WHERE day IS NULL) AS invalid_dates, count(*) FILTER (WHERE day > DATE '{_AS_OF}') AS future_dates, count(*) FILTER (WHERE price_c IS NULL) AS missing_prices, count(*) FILTER (WHERE price_c = 0) AS zero_prices, count(*) FILTER (WHERE price_c < 0) AS negative_prices, count(*) FILTER (WHERE product IS NULL OR market IS NULL) AS missing_fields, any_value(repeats) AS repeats, CASE WHEN count(*) FILTER (WHERE price_c IS NULL OR price_c < 0) > 0 THEN 'error' WHEN count(*) FILTER (WHERE day > DATE '{_AS_OF}') > 0 OR any_value(repeats) > 0 THEN 'con avisos' ELSE 'ok' END AS status FROM obs, k""")
def audit_counters(spark, d):
    price, late = F.col("price_c"), F.col("day") > F.lit(_AS_OF).cast("date")
    o = observations(spark, d).agg(F.count("*").alias("rows"), F.count_if(F.col("day").isNull()).alias("invalid_dates"), F.count_if(late).alias("future_dates"), F.count_if(price.isNull()).alias("missing_prices"), F.count_if(price == 0).alias("zero_prices"), F.count_if(price < 0).alias("negative_prices"), F.count_if(F.col("product").isNull() | F.col("market").isNull()).alias("missing_fields"), (F.count("*") - F.countDistinct("event_id", "line")).alias("repeats"))
    return o.withColumn("status", F.when(F.col("missing_prices") + F.col("negative_prices") > 0, "error").when((F.col("future_dates") > 0) | (F.col("repeats") > 0), "con avisos").otherwise("ok"))


_ZERO = {"product": "product", "currency": "currency", "kind": "CASE WHEN volume > 25 THEN 'grande' END", "operation": "condition", "payment": "CASE WHEN line % 3 > 0 THEN 'plazo ' || CAST(line AS VARCHAR) END", "origin": "nullif(variety, 'PROMO')", "place": "market", "year": "CAST(year AS VARCHAR)", "month": "month", "file": "'f' || CAST(line AS VARCHAR)"}


@query("audit_zero_breakdown", f"""WITH {OBS}, z AS (SELECT * FROM obs WHERE price_c % 10 = 0) {' UNION ALL '.join(f"SELECT '{n}' AS dimension, coalesce({x}, 'Sin especificar') AS value, count(*) AS n FROM z GROUP BY ALL" for n, x in _ZERO.items())}""")
def audit_zero_breakdown(spark, d):
    """Rows without a price by ten dimensions, unknown ones under a name of their own."""
    z = observations(spark, d).filter("price_c % 10 = 0").select(*[F.expr(x.replace("VARCHAR", "STRING")).alias(n) for n, x in _ZERO.items()])
    return A.breakdown(z, list(_ZERO), {"year": "Sin fecha", "month": "Sin fecha"})


@query("audit_analytic_base", f"""WITH {OBS} SELECT product, currency, market, condition, count(*) AS n, CAST(sum(volume) AS BIGINT) AS volume, CASE grouping_id(product, currency, market, condition) WHEN 3 THEN 'producto_moneda' WHEN 2 THEN 'serie' WHEN 5 THEN 'origen' WHEN 6 THEN 'entrega' END AS level FROM obs GROUP BY GROUPING SETS ((product, currency), (product, currency, condition), (product, market), (product, condition))""")
def audit_analytic_base(spark, d):
    sets = [["product", "currency"], ["product", "currency", "condition"], ["product", "market"], ["product", "condition"]]
    return A.levels(observations(spark, d), sets, ["producto_moneda", "serie", "origen", "entrega"], [F.count("*").alias("n"), F.sum("volume").alias("volume")])


@query("audit_label_inventory", """WITH u AS (SELECT 'name' AS dimension, p_name AS raw, p_brand AS source FROM part UNION ALL SELECT 'type', p_type, p_brand FROM part), k AS (SELECT dimension, raw, lower(split_part(raw, ' ', 1)) AS key, count(*) AS n, count(DISTINCT source) AS sources FROM u GROUP BY ALL) SELECT k.dimension, k.raw, k.key, n, sources, v.variants FROM k JOIN (SELECT dimension, key, count(*) AS variants FROM k GROUP BY ALL) v ON k.dimension = v.dimension AND k.key = v.key""")
def audit_label_inventory(spark, d):
    u = table(spark, d, "part").select("p_brand", F.col("p_name").alias("name"), F.col("p_type").alias("type")).unpivot("p_brand", ["name", "type"], "dimension", "raw")
    return A.label_inventory(u, "dimension", "raw", F.lower(F.split_part("raw", F.lit(" "), F.lit(1))), "p_brand")


@query("audit_day_coverage", f"""WITH {OBS}, c AS (SELECT CAST(unnest(range(DATE '1997-01-01', DATE '1999-01-01', INTERVAL 1 DAY)) AS DATE) AS day), g AS (SELECT day, count(*) AS n, count(DISTINCT product) AS products, min(price_c) AS low, max(price_c) AS high FROM obs GROUP BY day)
 SELECT c.day, coalesce(n, 0) AS n, coalesce(products, 0) AS products, low, high, CASE WHEN n IS NULL THEN 'sin filas' WHEN n < 3 THEN 'sin verificar' ELSE 'observado' END AS status FROM c LEFT JOIN g USING (day)""", dates=("day",))
def audit_day_coverage(spark, d):
    return A.day_coverage(observations(spark, d), "day", "1997-01-01", "1998-12-31", "product", "price_c", 3)


@query("audit_summary_vs_details", f"""WITH {OBS}, g AS (SELECT product, month, CAST(max(CASE WHEN market = 'M0' THEN price_c END) AS DOUBLE) AS summary, CAST(sum(CASE WHEN market <> 'M0' THEN price_c END) AS DOUBLE) / nullif(count(CASE WHEN market <> 'M0' THEN 1 END), 0) AS detail FROM obs GROUP BY ALL) SELECT *, summary - detail AS difference FROM g""")
def audit_summary_vs_details(spark, d):
    return A.summary_vs_details(observations(spark, d), ["product", "month"], F.col("market") == "M0", "price_c")


@query("audit_profile", f"""WITH {OBS}, o AS (SELECT product, nullif(variety, 'PROMO') AS variety, market, CASE WHEN volume > 45 THEN NULL ELSE volume END AS volume FROM obs) {' UNION ALL '.join(f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing, count(DISTINCT {c}) AS \"distinct\" FROM o" for c in ('product', 'variety', 'market', 'volume'))}""")
def audit_profile(spark, d):
    o = observations(spark, d).withColumn("variety", F.nullif(F.col("variety"), F.lit("PROMO"))).withColumn("volume", F.when(F.col("volume") <= 45, F.col("volume")))
    return A.profile(o, ["product", "variety", "market", "volume"])


@query("audit_source_inventory", f"""WITH {OBS} SELECT market, currency, condition, CAST(min(day) AS VARCHAR) AS first_day, CAST(max(day) AS VARCHAR) AS last_day, count(*) AS rows, count(*) FILTER (WHERE price_c > 0) AS observed, string_agg(DISTINCT variety, ',' ORDER BY variety) AS varieties FROM obs GROUP BY ALL""")
def audit_source_inventory(spark, d):
    return observations(spark, d).groupBy("market", "currency", "condition").agg(F.min("day").cast("string").alias("first_day"), F.max("day").cast("string").alias("last_day"), F.count("*").alias("rows"), F.count_if(F.col("price_c") > 0).alias("observed"), A.joined("variety", ",").alias("varieties"))


@query("audit_partition_index", f"""WITH {OBS} SELECT market, year, count(*) AS rows, CAST(min(day) AS VARCHAR) AS first_day, CAST(max(day) AS VARCHAR) AS last_day FROM obs GROUP BY ALL""")
def audit_partition_index(spark, d):
    """Written by partition, read back and indexed."""
    index = IO.publish_partitioned(observations(spark, d).select("market", "year", "day", "price_c"), IO.shared_folder(spark), ["market", "year"], "day")
    return index.withColumn("first_day", F.col("first_day").cast("string")).withColumn("last_day", F.col("last_day").cast("string"))


@query("audit_facts_and_dimensions", f"""WITH {OBS} SELECT product, currency, condition, count(*) AS n, CAST(sum(price_c) AS BIGINT) AS total FROM obs GROUP BY ALL""")
def audit_facts_and_dimensions(spark, d):
    """Split into facts and a dimension table, expanded again."""
    facts, dims = IO.split_dimensions(observations(spark, d).select("product", "currency", "condition", "price_c"), ["product", "currency", "condition"], "series_key")
    return IO.expand_dimensions(facts, dims, "series_key").groupBy("product", "currency", "condition").agg(F.count("*").alias("n"), F.sum("price_c").alias("total"))


@query("audit_wide_months", f"""WITH {OBS} SELECT product, market, year, CAST(month_idx % 12 + 1 AS VARCHAR) AS mes, CAST(sum(volume) AS BIGINT) AS precio FROM obs GROUP BY ALL""")
def audit_wide_months(spark, d):
    """Months as columns and back."""
    o = observations(spark, d)
    months = [str(k) for k in range(1, 13)]
    wide = o.withColumn("mes_", (F.col("month_idx") % 12 + 1).cast("string")).groupBy("product", "market", "year").pivot("mes_", months).agg(F.sum("volume"))
    return IO.months_to_rows(wide, ["product", "market", "year"], months)


@query("audit_span_totals", f"""WITH {OBS}, m AS (SELECT product, month_idx, year, CAST(sum(volume) AS BIGINT) AS v FROM obs GROUP BY ALL), y AS (SELECT product, month_idx, year, v, sum(v) OVER (PARTITION BY product, year ORDER BY month_idx) AS ytd, count(*) OVER (PARTITION BY product, year ORDER BY month_idx) AS k FROM m)
 SELECT a.product, a.month_idx, a.v, CASE WHEN a.k = a.month_idx % 12 + 1 THEN CAST(a.ytd AS BIGINT) END AS ytd, CASE WHEN a.k = a.month_idx % 12 + 1 AND b.k = b.month_idx % 12 + 1 THEN CAST(b.ytd AS BIGINT) END AS ytd_before FROM y a LEFT JOIN y b ON a.product = b.product AND b.month_idx = a.month_idx - 12""")
def audit_span_totals(spark, d):
    m = observations(spark, d).groupBy("product", "month_idx", "year").agg(F.sum("volume").alias("v"))
    return S.span_totals(m, ["product"], "year", "month_idx", "v")


@query("figures_quantity", f"""WITH {OBS}, m AS (SELECT month, sum(volume) AS v FROM obs GROUP BY 1), p AS (SELECT product, sum(volume) AS v FROM obs GROUP BY 1) SELECT CAST(sum(volume) AS BIGINT) AS total, count(DISTINCT product) AS products, CAST(max(day) AS VARCHAR) AS last_day, (SELECT month FROM m ORDER BY v DESC, month LIMIT 1) AS peak_month, (SELECT product FROM p ORDER BY v DESC, product LIMIT 1) AS top_product FROM obs""")
def figures_quantity(spark, d):
    return G.quantity(observations(spark, d), "product", "volume", "day", "month")


@query("figures_totals", f"""WITH {OBS} SELECT month, variety, CAST(sum(volume) AS BIGINT) AS volume, count(DISTINCT product) AS products FROM obs GROUP BY ALL""")
def figures_totals(spark, d):
    return observations(spark, d).groupBy("month", "variety").agg(F.sum("volume").alias("volume"), F.countDistinct("product").alias("products"))


_PERIODS = "m AS (SELECT month_idx, CAST(sum(price_c) AS DOUBLE) / count(*) AS v FROM obs GROUP BY ALL), c AS (SELECT month_idx, v, (v / lag(v) OVER (ORDER BY month_idx) - 1) * 100 AS x FROM m)"


@query("figures_prices", f"""WITH {OBS}, {_PERIODS}, a AS (SELECT year, month, day, avg(CAST(price_c AS DOUBLE)) AS v FROM obs GROUP BY ALL), b AS (SELECT year, month, avg(v) AS v FROM a GROUP BY ALL), y AS (SELECT year, avg(v) AS v FROM b GROUP BY ALL)
 SELECT (SELECT max(price_c) FROM obs) AS high, (SELECT arg_max(product, (price_c, product)) FROM obs) AS high_product, (SELECT min(price_c) FROM obs) AS low, (SELECT arg_min(product, (price_c, product)) FROM obs) AS low_product, (SELECT floor(avg(v) * 1000 + 0.2718) / 1000 FROM y) AS balanced,
 (SELECT max(x) FROM c WHERE x > 0) AS rise, (SELECT month_idx FROM c WHERE x > 0 ORDER BY x DESC, month_idx DESC LIMIT 1) AS rise_at, (SELECT min(x) FROM c WHERE x < 0) AS fall, (SELECT month_idx FROM c WHERE x < 0 ORDER BY x, month_idx LIMIT 1) AS fall_at, (SELECT (arg_max(v, month_idx) / arg_min(v, month_idx) - 1) * 100 FROM m) AS accumulated""")
def figures_prices(spark, d):
    """Extremes with their products, the balanced mean, and the largest changes between months."""
    figures = G.prices(observations(spark, d), "product", "price_c", ["year", "month", "day"], "month_idx")
    return figures.withColumn("balanced", settled(F.col("balanced")))


@query("figures_commodities", f"""WITH {OBS}, m AS (SELECT product, currency, month_idx, median(CAST(price_c AS DOUBLE)) AS v FROM obs GROUP BY ALL), c AS (SELECT a.*, (a.v / b.v - 1) * 100 AS x1, (a.v / y.v - 1) * 100 AS x12 FROM m a LEFT JOIN m b ON b.product = a.product AND b.currency = a.currency AND b.month_idx = a.month_idx - 1 LEFT JOIN m y ON y.product = a.product AND y.currency = a.currency AND y.month_idx = a.month_idx - 12),
 l AS (SELECT * FROM c QUALIFY month_idx = max(month_idx) OVER (PARTITION BY product, currency)), s AS (SELECT product AS selection, v, x1, x12 FROM l UNION ALL SELECT product || ' ' || currency, v, x1, x12 FROM l)
 SELECT selection, count(*) AS series, CASE WHEN count(*) = 1 THEN median(v) END AS median_last, CASE WHEN count(*) = 1 THEN median(x1) END AS change_month, count(x1) AS change_month_series, CASE WHEN count(*) = 1 THEN median(x12) END AS change_year, count(x12) AS change_year_series FROM s GROUP BY selection""")
def figures_commodities(spark, d):
    """Latest monthly price and its changes from a month and a year before, for every product and for each of
    its series; all are kept back where several series are selected."""
    key = ["product", "currency"]
    m = observations(spark, d).groupBy(*key, "month_idx").agg(F.median(F.col("price_c").cast("double")).alias("v"))
    m = m.withColumn("x1", S.change(F.col("v"), S.exact_prior("v", key, "month_idx", 1))).withColumn("x12", S.change(F.col("v"), S.exact_prior("v", key, "month_idx", 12)))
    last = S.latest_rows(m, key, ["month_idx"])
    each = last.withColumn("selection", F.col("product")).unionByName(last.withColumn("selection", F.concat_ws(" ", *key)))
    return G.latest_medians(each, "selection", "v", {"change_month": "x1", "change_year": "x12"})


_UNIT = "CASE WHEN month_idx % 3 = 0 THEN 'kg' WHEN month_idx % 3 = 1 THEN CASE WHEN product < 'Brand#2' THEN 'kg' ELSE 'caja' END WHEN product <> 'Brand#7' THEN 'kg' END"


@query("figures_quantity_description", f"""WITH {OBS}, g AS (SELECT month, product, CAST(sum(volume) AS BIGINT) AS v, bool_and((volume > 1 OR month_idx % 2 = 0) AND {_UNIT} IS NOT NULL) AS good, min({_UNIT}) AS u1, max({_UNIT}) AS u2 FROM obs GROUP BY ALL) SELECT month, product, CASE WHEN bool_and(good) OVER w AND min(u1) OVER w = max(u2) OVER w THEN v END AS volume, CASE WHEN bool_and(good) OVER w AND min(u1) OVER w = max(u2) OVER w THEN CAST(v AS DOUBLE) / CAST(sum(v) OVER w AS DOUBLE) END AS share FROM g WINDOW w AS (PARTITION BY month)""")
def figures_quantity_description(spark, d):
    """Months of one unit, months with items of different ones, and months with an item of none."""
    o = observations(spark, d).withColumn("unit", F.expr(_UNIT))
    return G.described_quantities(o, "month", "product", "volume", F.expr("volume > 1 OR month_idx % 2 = 0"), "unit")


@query("figures_composition", f"""WITH {OBS}, p AS (SELECT month, {', '.join(f"CAST(sum(CASE WHEN market = 'M{k}' THEN volume - {30 if k == 3 else 0} END) AS BIGINT) AS m{k}" for k in range(4))} FROM obs GROUP BY month) SELECT month, {', '.join(f'CASE WHEN m0 + m1 + m2 + m3 > 0 AND least(m0, m1, m2, m3) >= 0 THEN CAST(m{k} AS DOUBLE) / (m0 + m1 + m2 + m3) END AS share{k}' for k in range(4))} FROM p""")
def figures_composition(spark, d):
    """One market's volumes are differences, and negative in some months."""
    o = observations(spark, d).withColumn("volume", F.col("volume") - F.when(F.col("market") == "M3", 30).otherwise(0))
    return G.composition(o, "month", "market", [f"M{k}" for k in range(4)], "volume")


@query("figures_exploration_matrix", f"""WITH {OBS} SELECT market, currency AS source, product, year, month, variety, count(*) AS rows, count(*) FILTER (WHERE day > DATE '{_AS_OF}') AS future FROM obs GROUP BY ALL""")
def figures_exploration_matrix(spark, d):
    o = observations(spark, d).withColumnRenamed("currency", "source")
    return G.exploration_matrix(o, ["market", "source", "product", "year", "month", "variety"], "day", _AS_OF)


_COMPARED = "nullif(variety, 'PROMO') AS v, CASE WHEN volume > 25 THEN 'grande' ELSE 'chico' END AS pack, CASE WHEN day < DATE '2001-01-01' THEN 'DIARIA' ELSE 'MENSUAL' END AS prec, CASE WHEN volume % 2 = 0 THEN 'par' END AS calidad"


@query("figures_comparability", f"""WITH {OBS}, o AS (SELECT *, {_COMPARED} FROM obs), g AS (SELECT product, day, market, count(*) FILTER (WHERE currency IS NULL) AS unknown, list(DISTINCT v) FILTER (WHERE v IS NOT NULL) AS v, list(DISTINCT pack) AS pack FROM o WHERE market IN ('M0', 'M1') GROUP BY ALL),
 p AS (SELECT product, day, count(DISTINCT market) AS markets, count(DISTINCT currency) AS currencies, count(DISTINCT coalesce(condition, '-')) AS units, count(DISTINCT prec) AS precisions, count(DISTINCT coalesce(variety, '')) AS d1, count(DISTINCT pack) AS d2, count(DISTINCT coalesce(calidad, '')) AS d3 FROM o WHERE market IN ('M0', 'M1') GROUP BY ALL),
 c AS (SELECT a.product, a.day, coalesce(len(list_intersect(a.v, b.v)), 0) AS cv, len(list_intersect(a.pack, b.pack)) AS cp FROM g a JOIN g b ON a.product = b.product AND a.day = b.day AND a.market = 'M0' AND b.market = 'M1')
 SELECT product, day, CASE WHEN markets < 2 THEN 'sin datos' WHEN currencies <> 1 THEN 'moneda' WHEN units > 1 THEN 'unidad' WHEN cv = 0 THEN 'variedad' WHEN cp = 0 THEN 'presentacion' WHEN precisions > 1 THEN 'frecuencia' WHEN d1 > 1 OR d2 > 1 OR d3 > 1 THEN 'dimensiones' ELSE 'comparable' END AS verdict FROM p LEFT JOIN c USING (product, day)""", dates=("day",))
def figures_comparability(spark, d):
    """Whether the prices of two markets can be compared, for every product and day."""
    o = observations(spark, d)
    o = o.select("*", F.nullif(F.col("variety"), F.lit("PROMO")).alias("v"), F.when(F.col("volume") > 25, "grande").otherwise("chico").alias("pack"), F.when(F.col("day") < "2001-01-01", "DIARIA").otherwise("MENSUAL").alias("prec"), F.when(F.col("volume") % 2 == 0, "par").alias("calidad"))
    return A.comparability(o, ["product", "day"], "market", ["M0", "M1"], "currency", "condition", "v", "pack", "prec", ["variety", "pack", "calidad"])


@query("figures_comparability_monthly", f"""WITH {OBS}, o AS (SELECT *, {_COMPARED}, CASE WHEN month_idx % 2 = 0 THEN 'MENSUAL' WHEN month_idx % 3 = 0 THEN 'DIARIA' ELSE prec0 END AS p2 FROM (SELECT *, CASE WHEN volume > 40 THEN 'DIARIA' ELSE 'MENSUAL' END AS prec0 FROM obs)), g AS (SELECT product, month, market, count(*) FILTER (WHERE volume > 20) AS usable, list(DISTINCT pack) AS pack, list(DISTINCT v) FILTER (WHERE v IS NOT NULL) AS v FROM o WHERE market IN ('M0', 'M1') GROUP BY ALL),
 p AS (SELECT product, month, count(DISTINCT market) AS markets, count(DISTINCT currency) AS currencies, count(DISTINCT p2) AS precisions, bool_or(p2 = 'DIARIA') AS daily, count(DISTINCT coalesce(condition, '')) AS d1 FROM o WHERE market IN ('M0', 'M1') GROUP BY ALL), u AS (SELECT product, month, min(usable) AS usable FROM g GROUP BY ALL),
 c AS (SELECT a.product, a.month, coalesce(len(list_intersect(a.v, b.v)), 0) AS cv, len(list_intersect(a.pack, b.pack)) AS cp FROM g a JOIN g b ON a.product = b.product AND a.month = b.month AND a.market = 'M0' AND b.market = 'M1')
 SELECT product, month, CASE WHEN markets < 2 THEN 'sin datos' WHEN currencies <> 1 THEN 'moneda' WHEN usable = 0 THEN 'unidad' WHEN cv = 0 THEN 'variedad' WHEN cp = 0 THEN 'presentacion' WHEN precisions > 1 OR daily THEN 'frecuencia' WHEN d1 > 1 THEN 'dimensiones' ELSE 'comparable' END AS verdict FROM p JOIN u USING (product, month) LEFT JOIN c USING (product, month)""")
def figures_comparability_monthly(spark, d):
    """The same in a monthly view of converted prices, which daily rows and markets without a usable row stop."""
    o = observations(spark, d).withColumn("p2", F.expr("CASE WHEN month_idx % 2 = 0 THEN 'MENSUAL' WHEN month_idx % 3 = 0 OR volume > 40 THEN 'DIARIA' ELSE 'MENSUAL' END"))
    o = o.select("*", F.nullif(F.col("variety"), F.lit("PROMO")).alias("v"), F.when(F.col("volume") > 25, "grande").otherwise("chico").alias("pack"))
    return A.comparability(o, ["product", "month"], "market", ["M0", "M1"], "currency", "condition", "v", "pack", "p2", ["condition"], F.col("volume") > 20, "DIARIA")


@query("figures_single_markets", f"""WITH {OBS}, o AS (SELECT *, nullif(variety, 'PROMO') AS v, CASE WHEN line > 1 THEN currency END AS cur FROM obs) SELECT market, day, product, CASE WHEN count(DISTINCT coalesce(cur, '-')) > 1 THEN 'moneda' WHEN count(DISTINCT coalesce(condition, '-')) > 1 THEN 'unidad' WHEN count(DISTINCT coalesce(v, '-')) > 1 THEN 'dimensiones' ELSE 'un mercado' END AS verdict FROM o GROUP BY ALL""", dates=("day",))
def figures_single_markets(spark, d):
    """Whether the prices of one market can be drawn together, for every day and product."""
    o = observations(spark, d).withColumn("v", F.nullif(F.col("variety"), F.lit("PROMO"))).withColumn("cur", F.when(F.col("line") > 1, F.col("currency")))
    return A.single_market_verdicts(o, ["market", "day", "product"], "cur", "condition", ["v"])


@query("figures_unit_values", f"""WITH {OBS}, m AS (SELECT product, market, month_idx, CAST(sum(total_c) AS BIGINT) AS t, CAST(sum(CASE WHEN volume > 3 THEN volume ELSE 0 END) AS BIGINT) AS v FROM obs GROUP BY ALL), u AS (SELECT *, CASE WHEN v <> 0 THEN CAST(t AS DOUBLE) / v END AS unit_value FROM m) SELECT a.product, a.market, a.month_idx, a.unit_value, CASE WHEN b.unit_value > 0 THEN (a.unit_value / b.unit_value - 1) * 100 END AS change_year FROM u a LEFT JOIN u b ON a.product = b.product AND a.market = b.market AND b.month_idx = a.month_idx - 12""")
def figures_unit_values(spark, d):
    return G.unit_values(observations(spark, d), ["product", "market"], "month_idx", "total_c", F.when(F.col("volume") > 3, F.col("volume")).otherwise(0))


@query("figures_overview", f"""WITH {OBS}, l AS (SELECT market, max(month) AS month FROM obs GROUP BY 1) SELECT market, l.month AS latest, count(DISTINCT product) FILTER (WHERE obs.month = l.month) AS latest_products, count(DISTINCT product) AS products, count(DISTINCT variety) AS origins, CAST(min(day) AS VARCHAR) AS first_day, CAST(max(day) AS VARCHAR) AS last_day FROM obs JOIN l USING (market) GROUP BY market, l.month""")
def figures_overview(spark, d):
    return G.overview(observations(spark, d), "market", "month", "product", "variety", "day")


@query("figures_latest_comparable", f"""WITH {OBS}, r AS (SELECT market, product, day, price_c, row_number() OVER (PARTITION BY market, product ORDER BY day DESC, event_id, line, price_c) AS r FROM obs) SELECT market, product, CAST(day AS VARCHAR) AS day, price_c, place FROM (SELECT *, row_number() OVER (PARTITION BY market ORDER BY day DESC, product) AS place FROM r WHERE r = 1) WHERE place <= 4""")
def figures_latest_comparable(spark, d):
    last = G.latest_comparable(observations(spark, d), "market", "product", "day", [F.col("event_id"), F.col("line"), F.col("price_c")], 4)
    return last.select("market", "product", F.col("day").cast("string").alias("day"), "price_c", F.col("place").cast("bigint").alias("place"))


@query("figures_market_origin", f"""WITH {OBS}, g AS (SELECT product, market, variety, month_idx, median(CAST(price_c AS DOUBLE)) AS m FROM obs GROUP BY ALL), n AS (SELECT product, market, variety, count(*) AS k, min(month_idx) AS a, max(month_idx) AS b FROM g GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY product, market ORDER BY k DESC, variety NULLS FIRST) AS place FROM n), c AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY product ORDER BY place, k DESC, market, variety NULLS FIRST) <= 8), f AS (SELECT product, market, variety, unnest(range(a, b + 1)) AS month_idx FROM c) SELECT f.product, f.market, f.variety, CAST(f.month_idx AS INTEGER) AS month_idx, m AS median FROM f LEFT JOIN g ON f.product = g.product AND f.market = g.market AND f.variety IS NOT DISTINCT FROM g.variety AND f.month_idx = g.month_idx""")
def figures_market_origin(spark, d):
    """Eight combinations of market and origin for every product, one of each market first."""
    return G.market_origin(observations(spark, d), "product", "market", "variety", "month_idx", "price_c", 8)


@query("rank_top_products", f"""WITH {OBS} SELECT product, CAST(sum(volume) AS BIGINT) AS value, CAST(sum(volume) AS DOUBLE) / (SELECT CAST(sum(volume) AS DOUBLE) FROM obs) AS share FROM obs GROUP BY product ORDER BY 2 DESC, 1 LIMIT 10""")
def rank_top_products(spark, d):
    return R.top(observations(spark, d), ["product"], F.sum("volume"), 10)


@query("rank_top_and_rest", f"""WITH {OBS}, g AS (SELECT product, sum(volume) AS v, row_number() OVER (ORDER BY sum(volume) DESC, product) AS r FROM obs GROUP BY 1) SELECT CASE WHEN r <= 8 THEN product ELSE 'Otros' END AS product, CAST(sum(v) AS BIGINT) AS volume FROM g GROUP BY 1""")
def rank_top_and_rest(spark, d):
    return R.with_rest(observations(spark, d), "product", "volume", 8)


@query("rank_concentration", f"""WITH {OBS}, g AS (SELECT market, product, sum(volume) AS v FROM obs GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY market ORDER BY v DESC, product) AS r FROM g) SELECT market, CAST(sum(v) FILTER (WHERE r <= 5) AS DOUBLE) / CAST(sum(v) AS DOUBLE) AS top5 FROM r GROUP BY market""")
def rank_concentration(spark, d):
    return R.concentration(observations(spark, d), "market", "product", "volume", 5).withColumnRenamed("share", "top5")


@query("rank_heat_matrix", f"""WITH {OBS}, t AS (SELECT product FROM obs GROUP BY product ORDER BY sum(volume) DESC, product LIMIT 20) SELECT product, {', '.join(f'CAST(sum(CASE WHEN month_idx % 12 = {k} THEN volume END) AS BIGINT) AS m{k + 1}' for k in range(12))} FROM obs JOIN t USING (product) GROUP BY product""")
def rank_heat_matrix(spark, d):
    return R.heat_matrix(observations(spark, d), "product", F.col("month_idx") % 12, list(range(12)), "volume", 20).select("product", *[F.col(str(k)).alias(f"m{k + 1}") for k in range(12)])


@query("rank_seasonality", f"""WITH {OBS}, g AS (SELECT product, variety, month_idx % 12 + 1 AS m, CAST(sum(volume) AS BIGINT) AS v FROM obs GROUP BY ALL), s AS (SELECT *, CAST(v AS DOUBLE) / max(v) OVER (PARTITION BY product, variety) AS x FROM g) SELECT product, variety, CAST(m AS INTEGER) AS m, CASE WHEN x = 1 THEN 'pico' WHEN x > 0.3 THEN 'activo' ELSE 'bajo' END AS class FROM s""")
def rank_seasonality(spark, d):
    return R.season_classes(observations(spark, d), ["product", "variety"], (F.col("month_idx") % 12 + 1).alias("m"), "volume")


@query("rank_rises_and_falls", f"""WITH {OBS}, g AS (SELECT product, market, month_idx, CAST(sum(price_c) AS DOUBLE) / count(*) AS v, count(*) AS n FROM obs GROUP BY ALL), x AS (SELECT product, market, CAST(sum(n) AS BIGINT) AS rows, count(*) AS periods, arg_min(v, month_idx) AS first, arg_max(v, month_idx) AS last FROM g GROUP BY ALL), y AS (SELECT product, market, (last / first - 1) * 100 AS variation FROM x WHERE rows >= 5 AND periods >= 2 AND abs((last / first - 1) * 100) <= 500)
 SELECT * FROM (SELECT 'sube' AS kind, * FROM y WHERE variation > 0 ORDER BY variation DESC, product, market LIMIT 10) UNION ALL SELECT * FROM (SELECT 'baja', * FROM y WHERE variation < 0 ORDER BY variation, product, market LIMIT 10)""")
def rank_rises_and_falls(spark, d):
    g = observations(spark, d).groupBy("product", "market", "month_idx").agg(S.mean("price_c").alias("v"), F.count("*").alias("n"))
    y = S.accumulated(g, ["product", "market"], "month_idx", "v", "n").select("product", "market", "variation")
    up = y.filter("variation > 0").orderBy(F.desc("variation"), "product", "market").limit(10)
    down = y.filter("variation < 0").orderBy("variation", "product", "market").limit(10)
    return up.withColumn("kind", F.lit("sube")).unionByName(down.withColumn("kind", F.lit("baja")))


@query("rank_markets", f"""WITH {OBS}, a AS (SELECT market, month, day, avg(CAST(price_c AS DOUBLE)) AS v FROM obs GROUP BY ALL), b AS (SELECT market, month, avg(v) AS v FROM a GROUP BY ALL) SELECT market, floor(avg(v) * 1000 + 0.2718) / 1000 AS v, count(*) AS parts FROM b GROUP BY market""")
def rank_markets(spark, d):
    return S.balanced(observations(spark, d).withColumn("all", F.lit(1)), ["market"], ["all", "month", "day"], "price_c").select("market", settled(F.col("v")).alias("v"), "parts")


@query("rank_informative_series", f"""WITH {OBS} SELECT product, currency, condition, count(DISTINCT month) AS periods, count(*) AS rows FROM obs GROUP BY ALL ORDER BY periods DESC, rows DESC, product, currency, condition LIMIT 25""")
def rank_informative_series(spark, d):
    g = observations(spark, d).groupBy("product", "currency", "condition").agg(F.countDistinct("month").alias("periods"), F.count("*").alias("rows"))
    return g.orderBy(F.desc("periods"), F.desc("rows"), "product", "currency", "condition").limit(25)


@query("rank_diverse_sample", """SELECT DISTINCT o_orderkey, o_orderstatus, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS a, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS b FROM orders) WHERE a <= 20 OR b <= 20""")
def rank_diverse_sample(spark, d):
    return R.stratified_sample(table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority"), ["o_orderstatus", "o_orderpriority"], ["o_orderkey"], 20)
