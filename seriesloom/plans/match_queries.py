"""Queries on matching, currency, routing and set operations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from seriesloom.functions.dates import month_index
from seriesloom.operators import match as M
from seriesloom.operators import series as S
from seriesloom.operators.keys import join_on
from seriesloom.plans.base import OBS, observations, query, table
from seriesloom.sources.tables import written

# two views of all orders: as they are, and as a second source reports them (rounded prices, other
# letters, some a year and more later)
_DAY2 = "CASE WHEN o_orderkey % 4 = 0 THEN o_orderdate + INTERVAL '400' DAY ELSE o_orderdate END"
_LEFT = "l AS (SELECT o_orderkey AS left_id, o_custkey AS cust, strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderpriority AS pri, CAST(round(o_totalprice * 100) AS BIGINT) AS c FROM orders)"
_RIGHT = f"r AS (SELECT o_orderkey AS right_id, o_custkey AS cust2, strftime({_DAY2}, '%Y-%m-%d') AS day2, CASE WHEN o_orderkey % 5 = 0 THEN lower(o_orderpriority) ELSE o_orderpriority END AS pri2, CAST(round(o_totalprice * 100) AS BIGINT) + CASE WHEN o_orderkey % 11 = 0 THEN 900 ELSE o_orderkey % 2 END AS c2 FROM orders)"
_STAGE_SQL = """c{k} AS MATERIALIZED (SELECT left_id, right_id, count(*) OVER (PARTITION BY left_id) AS a, count(*) OVER (PARTITION BY right_id) AS b FROM l{p} JOIN r{p} ON {on}),
l{k} AS MATERIALIZED (SELECT * FROM l{p} WHERE left_id NOT IN (SELECT left_id FROM c{k})), r{k} AS MATERIALIZED (SELECT * FROM r{p} WHERE right_id NOT IN (SELECT right_id FROM c{k}))"""
_ON = ["cust = cust2 AND day = day2 AND pri = pri2 AND abs(c - c2) <= 0", "cust = cust2 AND day = day2 AND lower(pri) = lower(pri2) AND abs(c - c2) <= 0", "cust = cust2 AND day = day2 AND abs(c - c2) <= 1", "cust = cust2 AND substr(day, 1, 7) = substr(day2, 1, 7)"]
_NAMES = ["exacta", "normalizada", "probable con precio", "probable"]
_MATCHED = f"""{_LEFT}, {_RIGHT}, l0 AS MATERIALIZED (SELECT * FROM l WHERE day IN (SELECT day2 FROM r)), r0 AS MATERIALIZED (SELECT * FROM r WHERE day2 IN (SELECT day FROM l)), {', '.join(_STAGE_SQL.format(k=i + 1, p=i, on=on) for i, on in enumerate(_ON))},
 outcome AS MATERIALIZED ({' UNION ALL '.join(f"SELECT '{side}' AS side, {own} AS id, min(CASE WHEN a = 1 AND b = 1 THEN {other} END) AS other_id, CASE WHEN bool_and(a = 1 AND b = 1) THEN 'matched' ELSE 'ambiguous' END AS state, '{n}' AS stage FROM c{i + 1} GROUP BY {own}" for i, n in enumerate(_NAMES) for side, own, other in (('left', 'left_id', 'right_id'), ('right', 'right_id', 'left_id')))}
 UNION ALL SELECT 'left', left_id, NULL, 'left over', NULL FROM l4 UNION ALL SELECT 'right', right_id, NULL, 'left over', NULL FROM r4 UNION ALL SELECT 'left', left_id, NULL, 'day not common', NULL FROM l WHERE day NOT IN (SELECT day2 FROM r) UNION ALL SELECT 'right', right_id, NULL, 'day not common', NULL FROM r WHERE day2 NOT IN (SELECT day FROM l))"""


def _pool(df):
    """A matching's rows, written in files of a share at most, so that a task that deals them out holds few."""
    return written(df, M.SHARE)


def _matched(spark, d):
    o = table(spark, d, "orders")
    day, c = F.to_date("o_orderdate"), F.round(F.col("o_totalprice") * 100).cast("bigint")
    left = o.select(F.col("o_orderkey").alias("left_id"), F.col("o_custkey").alias("cust"), day.alias("day"), month_index(day).alias("month"), F.col("o_orderpriority").alias("pri"), F.lower("o_orderpriority").alias("lpri"), c.alias("c"))
    k = F.col("o_orderkey")
    day = F.to_date(F.when(k % 4 == 0, F.col("o_orderdate") + F.expr("INTERVAL 400 DAY")).otherwise(F.col("o_orderdate")))
    pri = F.when(k % 5 == 0, F.lower("o_orderpriority")).otherwise(F.col("o_orderpriority"))
    right = o.select(k.alias("right_id"), F.col("o_custkey").alias("cust2"), day.alias("day2"), month_index(day).alias("month2"), pri.alias("pri2"), F.lower(pri).alias("lpri2"), (c + F.when(k % 11 == 0, 900).otherwise(k % 2)).alias("c2"))
    same = [("cust", "cust2"), ("day", "day2")]
    stages = [(_NAMES[0], [*same, ("pri", "pri2")], ("c", "c2", 0)), (_NAMES[1], [*same, ("lpri", "lpri2")], ("c", "c2", 0)), (_NAMES[2], same, ("c", "c2", 1)), (_NAMES[3], [("cust", "cust2"), ("month", "month2")], None)]
    left, right, alone_left, alone_right = M.on_common_days(left, right, "day", "day2", written)
    out = M.mutual_unique(left, right, stages, materialise=_pool)
    for side, df, own in (("left", alone_left, "left_id"), ("right", alone_right, "right_id")):
        out = out.unionByName(df.select(F.lit(side).alias("side"), F.col(own).alias("id"), F.lit(None).cast("bigint").alias("other_id"), F.lit("day not common").alias("state"), F.lit(None).cast("string").alias("stage")))
    return out


@query("match_mutual_unique", f"""WITH {_MATCHED} SELECT * FROM outcome""")
def match_mutual_unique(spark, d):
    """Every order of both sources: matched, ambiguous, left over, or of a day that one side lacks."""
    return _matched(spark, d)


@query("match_rates", f"""WITH {_MATCHED} SELECT side, state, stage, count(*) AS rows, CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER (PARTITION BY side) AS DOUBLE) AS rate FROM outcome GROUP BY side, state, stage""")
def match_rates(spark, d):
    return M.match_rates(_matched(spark, d))


@query("match_as_of_rates", """WITH d AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders), r AS (SELECT CAST(o_orderdate AS DATE) AS rate_day, CAST(max(o_custkey) AS DOUBLE) AS rate FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderdate < TIMESTAMP '2000-06-01' GROUP BY ALL),
 j AS (SELECT o_orderkey, day, max(rate_day) AS rate_day FROM d LEFT JOIN r ON rate_day <= day AND day <= rate_day + 7 AND day <= (SELECT max(rate_day) FROM r) GROUP BY ALL) SELECT o_orderkey, day, j.rate_day, rate FROM j LEFT JOIN r ON j.rate_day = r.rate_day""", dates=("day", "rate_day"))
def match_as_of_rates(spark, d):
    o = table(spark, d, "orders").withColumn("day", F.to_date("o_orderdate"))
    rates = o.filter((F.col("o_orderpriority") == "1-URGENT") & (F.col("day") < "2000-06-01")).select(F.col("day").alias("rday"), F.col("o_custkey").cast("double").alias("rate"))
    return M.as_of_rates(o.select("o_orderkey", "day"), rates, "day", "rday", "rate").select("o_orderkey", "day", "rate_day", "rate")


@query("match_rates_by_currency", """WITH d AS (SELECT o_orderkey, o_orderdate AS moment, nullif(o_orderstatus, 'P') AS cur FROM orders), r AS (SELECT nullif(o_orderstatus, 'P') AS cur, o_orderdate + INTERVAL '5' HOUR AS rate_day, max(o_custkey) AS rate FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY ALL), e AS (SELECT cur, max(rate_day) AS last_day FROM r GROUP BY ALL),
 j AS (SELECT o_orderkey, max(r.rate_day) AS rate_day FROM d JOIN r ON r.cur IS NOT DISTINCT FROM d.cur AND r.rate_day <= moment AND moment <= r.rate_day + INTERVAL '2' DAY JOIN e ON e.cur IS NOT DISTINCT FROM d.cur AND moment <= last_day GROUP BY ALL)
 SELECT d.o_orderkey, cur, strftime(j.rate_day, '%Y-%m-%d %H:%M') AS rate_day, (SELECT rate FROM r WHERE r.rate_day = j.rate_day AND r.cur IS NOT DISTINCT FROM d.cur) AS rate FROM d LEFT JOIN j USING (o_orderkey)""")
def match_rates_by_currency(spark, d):
    """Rates quoted at five in the morning, by currency (one of them unknown), good for two days."""
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("at"), F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("cur"), "o_orderpriority", "o_custkey")
    rates = o.filter("o_orderpriority = '1-URGENT'").select("cur", (F.col("at") + F.expr("INTERVAL 5 HOURS")).alias("rday"), F.col("o_custkey").alias("rate"))
    out = M.as_of_rates(o.select("o_orderkey", "at", "cur"), rates, "at", "rday", "rate", 2, ["cur"])
    return out.select("o_orderkey", "cur", F.date_format("rate_day", "yyyy-MM-dd HH:mm").alias("rate_day"), "rate")


_CONFLICT_LEFT = "l0 AS (SELECT o_orderkey AS left_id, o_custkey AS cust, CAST(round(o_totalprice) AS BIGINT) // 50 AS c, CASE WHEN o_orderkey % 6 > 0 THEN o_orderstatus END AS cur FROM orders)"
_CONFLICT_RIGHT = "r0 AS (SELECT o_orderkey AS right_id, o_custkey AS cust2, CAST(round(o_totalprice) AS BIGINT) // 50 + o_orderkey % 3 AS c2, CASE WHEN o_orderkey % 10 = 0 THEN 'X' WHEN o_orderkey % 15 > 1 THEN o_orderstatus END AS cur2 FROM orders)"
_CONFLICT_ON = [f"cust = cust2 AND abs(c - c2) <= {t} AND (cur IS NULL OR cur = cur2)" for t in (0, 1, 400)]


@query("match_currency_conflict", f"""WITH {_CONFLICT_LEFT}, {_CONFLICT_RIGHT}, {', '.join(_STAGE_SQL.format(k=i + 1, p=i, on=on) for i, on in enumerate(_CONFLICT_ON))}
 {' UNION ALL '.join(f"SELECT '{side}' AS side, {own} AS id, min(CASE WHEN a = 1 AND b = 1 THEN {other} END) AS other_id, CASE WHEN bool_and(a = 1 AND b = 1) THEN 'matched' ELSE 'ambiguous' END AS state, 's{i + 1}' AS stage FROM c{i + 1} GROUP BY {own}" for i in range(3) for side, own, other in (('left', 'left_id', 'right_id'), ('right', 'right_id', 'left_id')))}
 UNION ALL SELECT 'left', left_id, NULL, 'left over', NULL FROM l3 UNION ALL SELECT 'right', right_id, NULL, 'left over', NULL FROM r3""")
def match_currency_conflict(spark, d):
    """Customers' orders matched by price in widening stages; a known currency rules out others, an unknown one none."""
    o, k = table(spark, d, "orders"), F.col("o_orderkey")
    c = F.floor(F.round("o_totalprice").cast("bigint") / 50).cast("bigint")
    left = o.select(k.alias("left_id"), F.col("o_custkey").alias("cust"), c.alias("c"), F.when(k % 6 > 0, F.col("o_orderstatus")).alias("cur"))
    right = o.select(k.alias("right_id"), F.col("o_custkey").alias("cust2"), (c + k % 3).alias("c2"), F.when(k % 10 == 0, "X").when(k % 15 > 1, F.col("o_orderstatus")).alias("cur2"))
    stages = [(f"s{i + 1}", [("cust", "cust2")], ("c", "c2", t)) for i, t in enumerate((0, 1, 400))]
    return M.mutual_unique(left, right, stages, materialise=_pool, conflict=("cur", "cur2"))


@query("match_route_daily", f"""WITH {OBS}, f AS (SELECT * FROM obs WHERE market = 'M0' AND variety <> 'PROMO'), l AS (SELECT * FROM obs WHERE market = 'M1') SELECT 'official' AS origin, product, count(*) AS n, CAST(sum(price_c) AS BIGINT) AS total FROM f GROUP BY ALL
 UNION ALL SELECT 'legacy', product, count(*), CAST(sum(price_c) AS BIGINT) FROM l WHERE day NOT IN (SELECT day FROM f) GROUP BY ALL""")
def match_route_daily(spark, d):
    o = observations(spark, d)
    routed = M.route_by_coverage(o.filter("market = 'M0' AND variety <> 'PROMO'"), o.filter("market = 'M1'"), ["day"])
    return routed.groupBy("origin", "product").agg(F.count("*").alias("n"), F.sum("price_c").alias("total"))


@query("match_route_monthly", f"""WITH {OBS}, f AS (SELECT * FROM obs WHERE market = 'M0' AND volume > 40), l AS (SELECT * FROM obs WHERE market = 'M1') SELECT 'official' AS origin, month, count(*) AS n FROM f GROUP BY ALL
 UNION ALL SELECT 'legacy', month, count(*) FROM l WHERE (month, product) NOT IN (SELECT (month, product) FROM f) GROUP BY ALL""".replace("(month, product) NOT IN (SELECT (month, product) FROM f)", "NOT EXISTS (SELECT 1 FROM f WHERE f.month = l.month AND f.product = l.product)"))
def match_route_monthly(spark, d):
    o = observations(spark, d)
    return M.route_by_coverage(o.filter("market = 'M0' AND volume > 40"), o.filter("market = 'M1'"), ["month", "product"]).groupBy("origin", "month").agg(F.count("*").alias("n"))


@query("match_legacy_official", f"""WITH {OBS}, l AS (SELECT product, currency, month, min(price_c) AS legacy FROM obs WHERE market = 'M1' GROUP BY ALL), f AS (SELECT product, currency, month, min(price_c) AS official FROM obs WHERE market = 'M0' GROUP BY ALL HAVING min(price_c) > 0)
 SELECT product, currency, count(*) AS keys, count(official) AS covered, count(*) - count(official) AS gaps, count(*) FILTER (WHERE legacy <> official) AS different, count(*) = count(official) AS retire FROM l LEFT JOIN f USING (product, currency, month) GROUP BY ALL""")
def match_legacy_official(spark, d):
    o = observations(spark, d)
    return M.legacy_coverage(o.filter("market = 'M1'"), o.filter("market = 'M0'"), ["product", "currency", "month"], "price_c", ["product", "currency"])


@query("match_key_sets", f"""WITH {OBS}, a AS (SELECT product, day, count(DISTINCT price_c) AS n_left, min(price_c) AS v_left FROM obs WHERE market = 'M0' GROUP BY ALL), b AS (SELECT product, day, count(DISTINCT price_c) AS n_right, min(price_c) AS v_right FROM obs WHERE market = 'M1' GROUP BY ALL),
 j AS (SELECT *, CASE WHEN n_left = 1 AND n_right = 1 AND v_right <> 0 THEN CAST(v_left AS DOUBLE) / v_right END AS ratio FROM a FULL JOIN b USING (product, day)) SELECT *, CASE WHEN n_left IS NULL THEN 'solo derecha' WHEN n_right IS NULL THEN 'solo izquierda' WHEN NOT (n_left = 1 AND n_right = 1) THEN 'ambigua' ELSE 'comun' END AS status, abs(ratio - 1) <= 0.01 AS within FROM j""", dates=("day",))
def match_key_sets(spark, d):
    o = observations(spark, d)
    return M.compare_key_sets(o.filter("market = 'M0'"), o.filter("market = 'M1'"), ["product", "day"], "price_c")


@query("match_key_summary", f"""WITH {OBS}, a AS (SELECT product, day, count(DISTINCT price_c) AS n_left, min(price_c) AS v_left FROM obs WHERE market IN ('M0', 'M2') GROUP BY ALL), b AS (SELECT product, day, count(DISTINCT price_c) AS n_right, min(price_c) AS v_right FROM obs WHERE market IN ('M1', 'M3') GROUP BY ALL),
 j AS (SELECT *, CASE WHEN n_left = 1 AND n_right = 1 AND v_right <> 0 THEN CAST(v_left AS DOUBLE) / v_right END AS ratio FROM a FULL JOIN b USING (product, day)) SELECT count(*) FILTER (WHERE n_left > 0 AND n_right > 0) AS shared_keys, count(ratio) AS unambiguous_pairs, count(*) FILTER (WHERE n_left > 0 AND n_right > 0 AND NOT (n_left = 1 AND n_right = 1)) AS ambiguous_keys,
 count(*) FILTER (WHERE abs(ratio - 1) <= 0.01) AS within, count(*) FILTER (WHERE n_left IS NULL) AS missing_left, count(*) FILTER (WHERE n_right IS NULL) AS missing_right, CAST(count(*) FILTER (WHERE abs(ratio - 1) <= 0.01) AS DOUBLE) / count(ratio) AS within_share, median(ratio) AS median_ratio FROM j""")
def match_key_summary(spark, d):
    """What a comparison of two pairs of markets by product and day comes to."""
    o = observations(spark, d)
    return M.key_set_summary(M.compare_key_sets(o.filter("market IN ('M0', 'M2')"), o.filter("market IN ('M1', 'M3')"), ["product", "day"], "price_c"))


@query("match_missing_keys", f"""WITH {OBS}, a AS (SELECT DISTINCT product, day FROM obs WHERE market = 'M0'), b AS (SELECT DISTINCT product, day FROM obs WHERE market = 'M1') SELECT *, 'left' AS only_in FROM (FROM a EXCEPT FROM b) UNION ALL SELECT *, 'right' FROM (FROM b EXCEPT FROM a)""", dates=("day",))
def match_missing_keys(spark, d):
    o = observations(spark, d)
    return M.missing_keys(o.filter("market = 'M0'"), o.filter("market = 'M1'"), ["product", "day"])


@query("match_overlap_guard", f"""WITH {OBS} SELECT market, count(*) AS overlapping FROM obs WHERE market <> 'M0' AND EXISTS (SELECT 1 FROM obs b WHERE b.market = 'M0' AND b.product = obs.product AND b.day = obs.day) GROUP BY market""")
def match_overlap_guard(spark, d):
    o = observations(spark, d)
    return join_on(o.filter("market <> 'M0'"), o.filter("market = 'M0'").select("product", "day").distinct(), ["product", "day"], "left_semi").groupBy("market").agg(F.count("*").alias("overlapping"))


@query("match_comparable_markets", f"""WITH {OBS}, g AS (SELECT product, currency, market, nullif(variety, 'PROMO') AS v, list(DISTINCT month) AS p FROM obs GROUP BY ALL), n AS (SELECT product, currency, market, nullif(variety, 'PROMO') AS v, month, count(*) AS n FROM obs GROUP BY ALL),
 j AS (SELECT a.product, a.currency, a.v AS variety_0, b.v AS variety_1, c.v AS variety_2, list_intersect(list_intersect(a.p, b.p), c.p) AS common FROM g a JOIN g b ON a.product = b.product AND a.currency = b.currency JOIN g c ON a.product = c.product AND a.currency = c.currency
  WHERE a.market = 'M0' AND b.market = 'M1' AND c.market = 'M2' AND (a.v IS NULL OR b.v IS NULL OR a.v = b.v) AND (a.v IS NULL OR c.v IS NULL OR a.v = c.v) AND (b.v IS NULL OR c.v IS NULL OR b.v = c.v)),
 m AS (SELECT j.product, j.currency, variety_0, variety_1, variety_2, CAST(len(common) AS INTEGER) AS common_periods, unnest(common) AS month FROM j WHERE len(common) > 0), f AS (
 SELECT m.product, m.currency, variety_0, variety_1, variety_2, common_periods, CAST(sum(n.n) AS BIGINT) AS rows FROM m JOIN n ON n.product = m.product AND n.currency = m.currency AND n.month = m.month AND (n.market = 'M0' AND n.v IS NOT DISTINCT FROM variety_0 OR n.market = 'M1' AND n.v IS NOT DISTINCT FROM variety_1 OR n.market = 'M2' AND n.v IS NOT DISTINCT FROM variety_2) GROUP BY ALL) SELECT *, row_number() OVER (PARTITION BY product, currency ORDER BY common_periods DESC, rows DESC, variety_0 NULLS FIRST, variety_1 NULLS FIRST, variety_2 NULLS FIRST) AS rank FROM f""")
def match_comparable_markets(spark, d):
    """Three markets whose varieties don't contradict each other, ranked by the months that all have."""
    o = observations(spark, d).withColumn("variety", F.nullif(F.col("variety"), F.lit("PROMO")))
    return M.comparable_combinations(o, ["product", "currency"], "market", ["variety"], "month_idx", ["M0", "M1", "M2"])


@query("match_abbreviations", """WITH l AS (SELECT DISTINCT lower(x) AS l FROM (SELECT p_name AS x FROM part UNION ALL SELECT substr(p_name, 1, 2) || '.' || split_part(p_name, ' ', 2)[1:3] || '.' FROM part)), s AS (SELECT l AS short, replace(l, '.', '') AS t FROM l WHERE contains(l, '.')), g AS (SELECT l AS long FROM l WHERE NOT contains(l, '.'))
 SELECT short, long FROM s JOIN g ON t[1] = long[1] WHERE length(long) > length(t) AND length(long) - length(t) <= 30 AND long LIKE array_to_string(string_split(t, ''), '%') || '%'""")
def match_abbreviations(spark, d):
    p = table(spark, d, "part")
    short = F.concat(F.substring("p_name", 1, 2), F.lit("."), F.substring(F.split_part("p_name", F.lit(" "), F.lit(2)), 1, 3), F.lit("."))
    return M.abbreviations(p.select(F.col("p_name").alias("x")).unionByName(p.select(short.alias("x"))), "x")


@query("match_embedded_varieties", """WITH n AS (SELECT DISTINCT split_part(p_name, ' ', 1) AS name FROM part UNION SELECT DISTINCT p_name FROM part), v AS (SELECT DISTINCT split_part(p_name, ' ', 2) AS variety FROM part) SELECT n.name AS product, b.name AS base, variety FROM n JOIN n b ON starts_with(n.name, b.name || ' ') JOIN v ON n.name = b.name || ' ' || variety""")
def match_embedded_varieties(spark, d):
    p = table(spark, d, "part")
    first, second = (F.split_part("p_name", F.lit(" "), F.lit(k)) for k in (1, 2))
    return M.embedded_varieties(p.select(first.alias("product"), second.alias("variety")).unionByName(p.select(F.col("p_name").alias("product"), F.lit(None).cast("string").alias("variety"))), "product", "variety")


@query("match_share_denominators", f"""WITH {OBS}, p AS (SELECT product, month, market, CAST(sum(volume) AS BIGINT) AS v FROM obs WHERE market <> 'M3' GROUP BY ALL), t AS (SELECT product, month, CAST(sum(volume) AS BIGINT) AS total FROM obs WHERE market = 'M3' GROUP BY ALL HAVING count(*) = 1)
 SELECT product, month, market, v, CASE WHEN total > 0 THEN CAST(v AS DOUBLE) / total END AS share FROM p LEFT JOIN t USING (product, month)""")
def match_share_denominators(spark, d):
    o = observations(spark, d)
    part = o.filter("market <> 'M3'").groupBy("product", "month", "market").agg(F.sum("volume").alias("v"))
    return M.share_of_totals(part, o.filter("market = 'M3'"), ["product", "month"], "v", "volume").select("product", "month", "market", "v", "share")


@query("match_year_ago", f"""WITH {OBS}, b AS (SELECT product, market, currency, condition, month_idx, CASE WHEN count(*) = 1 THEN max(price_c) END AS base FROM obs GROUP BY ALL) SELECT o.event_id, o.line, o.product, o.price_c, CASE WHEN base > 0 THEN (CAST(o.price_c AS DOUBLE) / base - 1) * 100 END AS variation
 FROM obs o LEFT JOIN b ON o.product = b.product AND o.market = b.market AND o.currency = b.currency AND o.condition IS NOT DISTINCT FROM b.condition AND b.month_idx = o.month_idx - 12""")
def match_year_ago(spark, d):
    return M.year_ago(observations(spark, d), ["product", "market", "currency", "condition"], "month_idx", "price_c").select("event_id", "line", "product", "price_c", "variation")


@query("match_source_coverage", f"""WITH {OBS}, f AS (SELECT market, year, list(DISTINCT month) AS ms, list(DISTINCT product) AS ps, count(*) AS n FROM obs WHERE volume > 5 AND (market <> 'M2' OR year < 1999) GROUP BY ALL), t AS (SELECT market, year, list(DISTINCT month) AS tm, list(DISTINCT product) AS tp, count(*) AS tn FROM obs WHERE market <> 'M3' AND (market = 'M0' OR volume > 20) GROUP BY ALL)
 SELECT market, year, n, tn, CASE WHEN tn IS NULL THEN 'AUSENTE' WHEN list_has_all(tm, ms) AND len(list_intersect(ps, tp)) >= 0.9 * len(ps) AND CAST(n AS DOUBLE) / tn BETWEEN 0.8 AND 1.2 THEN 'INCLUIDO' WHEN len(list_intersect(ms, tm)) > 0 THEN 'PARCIAL' ELSE 'INCIERTO' END AS status FROM f LEFT JOIN t USING (market, year)""")
def match_source_coverage(spark, d):
    o = observations(spark, d)
    return M.source_coverage(o.filter("volume > 5 AND (market <> 'M2' OR year < 1999)"), o.filter("market <> 'M3' AND (market = 'M0' OR volume > 20)"), ["market", "year"], "month", "product")


@query("match_freshness_state", """WITH a AS (SELECT user_id, max(ts) AS prev FROM events WHERE event_type = 'view' GROUP BY 1), b AS (SELECT user_id, max(ts) AS newest, arg_max(event_type, (ts, event_id)) AS attempt FROM events WHERE event_type <> 'view' GROUP BY 1)
 SELECT user_id, strftime(greatest(prev, newest), '%Y-%m-%d %H:%M:%S.%f') AS last_seen, CASE WHEN newest IS NULL OR prev > newest THEN 'view' ELSE attempt END AS state FROM a FULL JOIN b USING (user_id)""")
def match_freshness_state(spark, d):
    e = table(spark, d, "events")
    j = M.freshness_state(e.filter("event_type = 'view'"), e.filter("event_type <> 'view'"), ["user_id"], "ts", "event_type", "event_id", "view")
    return j.withColumn("last_seen", F.date_format("last_seen", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query("match_source_pick", f"""WITH {OBS}, s AS (SELECT product, market, max(month) AS latest, count(DISTINCT month) > 70 AS active FROM obs GROUP BY ALL), p AS (SELECT product, arg_max(market, (latest, active, -ascii(market[2]))) AS market FROM s GROUP BY product) SELECT product, market, count(*) AS n FROM obs JOIN p USING (product, market) GROUP BY ALL""")
def match_source_pick(spark, d):
    o = observations(spark, d)
    return M.pick_source(o, "product", "market", "month", 70, -F.ascii(F.substring("market", 2, 1))).groupBy("product", "market").agg(F.count("*").alias("n"))


@query("set_priority_union", """WITH b AS (SELECT o_custkey, o_orderkey FROM orders WHERE o_orderkey % 3 = 0), o AS (SELECT o_custkey, o_orderkey, o_orderkey % 3 - 1 AS p FROM orders WHERE o_orderkey % 3 > 0) SELECT o_custkey, o_orderkey FROM b UNION ALL SELECT o_custkey, o_orderkey FROM (SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY p, o_orderkey) = 1) WHERE o_custkey NOT IN (SELECT o_custkey FROM b)""")
def set_priority_union(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey")
    return M.priority_union(o.filter("o_orderkey % 3 = 0"), [o.filter("o_orderkey % 3 = 1"), o.filter("o_orderkey % 3 = 2")], ["o_custkey"], ["o_orderkey"])


@query("set_first_of_equal", """SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderstatus, o_orderpriority ORDER BY o_orderkey) = 1""")
def set_first_of_equal(spark, d):
    return M.first_of_equal(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"), ["o_orderkey"], ["o_orderkey"])


@query("set_replace_source", f"""WITH {OBS}, n AS (SELECT market, product, price_c + 1 AS price_c FROM obs WHERE market IN ('M1', 'M2') AND year = 2000) SELECT market, product, count(*) AS n, CAST(sum(price_c) AS BIGINT) AS total FROM (SELECT market, product, price_c FROM obs WHERE market NOT IN (SELECT market FROM n) UNION ALL FROM n) GROUP BY ALL""")
def set_replace_source(spark, d):
    o = observations(spark, d)
    new = o.filter("market IN ('M1', 'M2') AND year = 2000").select("market", "product", (F.col("price_c") + 1).alias("price_c"))
    return M.replace_source(o.select("market", "product", "price_c"), new, "market").groupBy("market", "product").agg(F.count("*").alias("n"), F.sum("price_c").alias("total"))


@query("set_containment", f"""WITH {OBS} SELECT product, count(DISTINCT day) AS lost FROM obs WHERE market = 'M0' AND NOT EXISTS (SELECT 1 FROM obs b WHERE b.market <> 'M0' AND b.product = obs.product AND b.day = obs.day) GROUP BY product""")
def set_containment(spark, d):
    o = observations(spark, d)
    return join_on(o.filter("market = 'M0'"), o.filter("market <> 'M0'").select("product", "day").distinct(), ["product", "day"], "left_anti").groupBy("product").agg(F.countDistinct("day").alias("lost"))


@query("set_distinct_non_comparable", """SELECT DISTINCT p_type, p_size FROM part WHERE p_type <> 'ECONOMY' AND p_size % 9 = 0""")
def set_distinct_non_comparable(spark, d):
    return table(spark, d, "part").filter("p_type <> 'ECONOMY' AND p_size % 9 = 0").select("p_type", "p_size").distinct()


@query("set_union_aligned", """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, 'customer' AS kind FROM customer UNION ALL SELECT s_suppkey, s_name, NULL, 'supplier' FROM supplier""")
def set_union_aligned(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), F.lit("customer").alias("kind"))
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.lit("supplier").alias("kind"))
    return c.unionByName(s, allowMissingColumns=True)


@query("keyed_upsert_state", """WITH o AS (SELECT o_orderkey AS k, o_totalprice AS v FROM orders WHERE o_orderkey % 4 <> 0), n AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS v FROM orders WHERE o_orderkey % 5 <> 0) SELECT CASE WHEN o.k IS NULL THEN 'new' WHEN n.k IS NULL THEN 'kept' WHEN o.v = n.v THEN 'unchanged' ELSE 'changed' END AS state, count(*) AS n FROM o FULL JOIN n ON o.k = n.k GROUP BY 1""")
def keyed_upsert_state(spark, d):
    from seriesloom.streaming.incremental import keyed_upsert

    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v"))
    new = o.filter("k % 5 <> 0").withColumn("v", F.when(F.col("k") % 7 == 0, F.col("v") + 1).otherwise(F.col("v")))
    return keyed_upsert(o.filter("k % 4 <> 0"), new, ["k"]).groupBy("state").agg(F.count("*").alias("n"))


@query("two_way_duplicates", """WITH e AS (SELECT *, user_id || '|' || event_type || '|' || strftime(ts, '%Y-%m-%d %H') AS i, CAST(value AS VARCHAR) AS s FROM (SELECT event_id, user_id, event_type, ts, CAST(floor(value) % 3 AS INTEGER) AS value FROM events)), f AS (SELECT *, row_number() OVER w AS r, first_value(s) OVER w AS fs FROM e WINDOW w AS (PARTITION BY i ORDER BY event_id)) SELECT event_id, CASE WHEN r = 1 THEN 'first' WHEN s = fs THEN 'duplicate' ELSE 'conflict' END AS state FROM f""")
def two_way_duplicates(spark, d):
    from seriesloom.streaming.incremental import two_way_duplicates as states

    e = table(spark, d, "events").withColumn("hour", F.date_format("ts", "yyyy-MM-dd HH")).withColumn("s", (F.floor("value") % 3).cast("string"))
    return states(e, ["user_id", "event_type", "hour"], ["s"], ["event_id"]).select("event_id", "state")


@query("revision_ledger", """WITH a AS (SELECT o_orderkey AS k, o_totalprice AS v FROM orders WHERE o_orderkey % 4 <> 0), b AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 6 = 0 THEN o_totalprice * 2 ELSE o_totalprice END AS v FROM orders WHERE o_orderkey % 5 <> 0) SELECT a.k, a.v AS old_v, b.v AS new_v FROM a JOIN b ON a.k = b.k WHERE a.v > 0 AND b.v > 0 AND a.v <> b.v""")
def revision_ledger(spark, d):
    from seriesloom.streaming.incremental import revision_ledger as ledger

    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v"))
    new = o.filter("k % 5 <> 0").withColumn("v", F.when(F.col("k") % 6 == 0, F.col("v") * 2).otherwise(F.col("v")))
    return ledger(o.filter("k % 4 <> 0"), new, ["k"], "v")


@query("upserts_bucketed", """WITH o AS (SELECT o_orderkey AS k, o_totalprice AS v, o_orderstatus AS s FROM orders), b AS (SELECT k, CASE WHEN k % 6 = 0 THEN v * 2 WHEN k % 13 = 0 THEN 0 ELSE v END AS v, s FROM o WHERE k % 5 = 0) SELECT k, coalesce(b.v, o.v) AS v, s FROM o LEFT JOIN b USING (k, s) WHERE k % 4 <> 0 OR b.k IS NOT NULL""")
def upserts_bucketed(spark, d):
    """A table in buckets after two upserts, the second of which runs twice."""
    return _upserted(spark, d).rows().select("k", "v", "s")


@query("ledger_bucketed", """SELECT o_orderkey AS k, o_totalprice AS old_v, o_totalprice * 2 AS new_v, 1 AS batch FROM orders WHERE o_orderkey % 4 <> 0 AND o_orderkey % 5 = 0 AND o_orderkey % 6 = 0 AND o_totalprice > 0""")
def ledger_bucketed(spark, d):
    """The revisions that the same upserts left in the ledger."""
    return _upserted(spark, d).ledger()


def _upserted(spark, d):
    from seriesloom.sources.tables import shared_folder
    from seriesloom.streaming.buckets import KeyedTable

    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v"), F.col("o_orderstatus").alias("s"))
    out = KeyedTable(spark, shared_folder(spark), ["k"], o.schema, "v", buckets=8)
    second = o.filter("k % 5 = 0").withColumn("v", F.when(F.col("k") % 6 == 0, F.col("v") * 2).when(F.col("k") % 13 == 0, F.lit(0.0)).otherwise(F.col("v")))
    for k, batch in ((0, o.filter("k % 4 <> 0")), (1, second), (1, second)):
        out.upsert(batch, k)
    return out


@query("history_daily_changes", f"""WITH {OBS}, h AS (SELECT product, day, CAST(sum(price_c) AS BIGINT) AS v, count(*) % 2 = 0 AS method FROM obs WHERE market <> 'M1' GROUP BY ALL), c AS (SELECT product, day, CASE WHEN sum(price_c) % 10 = 0 THEN 0 ELSE CAST(sum(price_c) AS BIGINT) END AS v, count(*) % 2 = 0 AS method FROM obs WHERE market = 'M1' AND month IN ('1998-03', '1999-02', '2000-12') GROUP BY ALL),
 m AS (SELECT * FROM h WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.product = h.product AND c.day = h.day) UNION ALL SELECT * FROM c WHERE v > 0) SELECT m.product, m.day, m.v, m.method, (CAST(m.v AS DOUBLE) / a.v - 1) * 100 AS change_7, (CAST(m.v AS DOUBLE) / b.v - 1) * 100 AS change_30, EXISTS (SELECT 1 FROM c WHERE c.product = m.product AND m.day - c.day IN (0, 7, 30)) AS recomputed
 FROM m LEFT JOIN m a ON a.product = m.product AND a.day = m.day - 7 AND a.method = m.method AND a.v > 0 LEFT JOIN m b ON b.product = m.product AND b.day = m.day - 30 AND b.method = m.method AND b.v > 0""", dates=("day",))
def history_daily_changes(spark, d):
    """Revised days merged into stored daily changes; the SQL computes everything anew."""
    o = observations(spark, d)
    daily = lambda df: df.groupBy("product", "day").agg(F.sum("price_c").alias("v"), (F.count("*") % 2 == 0).alias("method"))
    h = daily(o.filter("market <> 'M1'"))
    for k in (7, 30):
        prior = h.select("product", F.date_add("day", k).alias("day"), F.col("method").alias("m_"), F.col("v").alias("before_"))
        h = h.join(prior, ["product", "day"], "left").withColumn(f"change_{k}", F.when((F.col("m_") == F.col("method")) & (F.col("before_") > 0), S.change(F.col("v"), F.col("before_")))).drop("m_", "before_")
    current = daily(o.filter("market = 'M1' AND month IN ('1998-03', '1999-02', '2000-12')")).withColumn("v", F.when(F.col("v") % 10 == 0, F.lit(0).cast("bigint")).otherwise(F.col("v")))
    return S.merge_daily(written(h), written(current), ["product"], "day", "v", "method")


@query("history_current_merge", f"""WITH {OBS}, h AS (SELECT product, day, CAST(sum(price_c) AS BIGINT) AS v FROM obs WHERE market = 'M0' GROUP BY ALL), c AS (SELECT product, day, CAST(sum(price_c) AS BIGINT) AS v FROM obs WHERE market = 'M1' AND year = 2000 GROUP BY ALL), m AS (SELECT * FROM h WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.product = h.product AND c.day = h.day) UNION ALL SELECT * FROM c WHERE v % 10 <> 0)
 SELECT product, strftime(day, '%Y-%m') AS month, count(*) AS days, median(CAST(v AS DOUBLE)) AS median FROM m GROUP BY ALL""")
def history_current_merge(spark, d):
    from seriesloom.streaming.incremental import merge_current

    o = observations(spark, d)
    daily = lambda df: df.groupBy("product", "day").agg(F.sum("price_c").alias("v"))
    current = daily(o.filter("market = 'M1' AND year = 2000")).withColumn("v", F.when(F.col("v") % 10 == 0, F.lit(0).cast("bigint")).otherwise(F.col("v")))
    merged = merge_current(daily(o.filter("market = 'M0'")), current, ["product", "day"], "v")
    return merged.groupBy("product", F.date_format("day", "yyyy-MM").alias("month")).agg(F.count("*").alias("days"), F.median(F.col("v").cast("double")).alias("median"))


@query("history_affected_months", f"""WITH {OBS}, h AS (SELECT product, day, CAST(sum(price_c) AS BIGINT) AS v FROM obs WHERE market = 'M0' GROUP BY ALL), c AS (SELECT product, day, CASE WHEN sum(price_c) % 10 = 0 THEN 0 ELSE CAST(sum(price_c) AS BIGINT) END AS v FROM obs WHERE market = 'M1' AND month IN ('1998-03', '1999-02', '2000-12') GROUP BY ALL),
 m AS (SELECT * FROM h WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.product = h.product AND c.day = h.day) UNION ALL SELECT * FROM c WHERE v > 0), t AS (SELECT product, CAST(year(day) * 12 + month(day) - 1 AS INTEGER) AS month_idx, median(CAST(v AS DOUBLE)) AS median FROM m GROUP BY ALL),
 k AS (SELECT DISTINCT product, CAST(year(day) * 12 + month(day) - 1 AS INTEGER) AS month_idx FROM c)
 SELECT t.product, t.month_idx, t.median, (t.median / a.median - 1) * 100 AS change_1, (t.median / b.median - 1) * 100 AS change_12, EXISTS (SELECT 1 FROM k WHERE k.product = t.product AND t.month_idx - k.month_idx IN (0, 1, 12)) AS recomputed
 FROM t LEFT JOIN t a ON a.product = t.product AND a.month_idx = t.month_idx - 1 LEFT JOIN t b ON b.product = t.product AND b.month_idx = t.month_idx - 12""")
def history_affected_months(spark, d):
    """Three revised months merged into a stored history; the SQL computes everything anew."""
    o = observations(spark, d)
    daily = lambda df: df.groupBy("product", "day").agg(F.sum("price_c").alias("v"))
    history = written(daily(o.filter("market = 'M0'")))
    stored = history.groupBy("product", month_index(F.col("day")).alias("month_idx")).agg(F.median(F.col("v").cast("double")).alias("median"))
    stored = written(stored.withColumn("change_1", S.change(F.col("median"), S.exact_prior("median", ["product"], "month_idx", 1))).withColumn("change_12", S.change(F.col("median"), S.exact_prior("median", ["product"], "month_idx", 12))))
    current = daily(o.filter("market = 'M1' AND month IN ('1998-03', '1999-02', '2000-12')")).withColumn("v", F.when(F.col("v") % 10 == 0, F.lit(0).cast("bigint")).otherwise(F.col("v")))
    return S.merge_history(history, stored, written(current), ["product"], "day", "v")


@query("late_status_flags", """WITH h AS (SELECT o_custkey, max(o_orderstatus) AS s FROM orders GROUP BY 1) SELECT o_orderkey, CASE WHEN s = 'P' THEN CASE WHEN o_orderstatus = 'O' THEN 'abierta,provisorio' ELSE 'provisorio' END WHEN o_orderstatus = 'O' THEN 'abierta' ELSE '' END AS flags FROM orders JOIN h USING (o_custkey)""")
def late_status_flags(spark, d):
    from seriesloom.streaming.incremental import propagate_status

    o = table(spark, d, "orders")
    rows = o.select("o_orderkey", "o_custkey", F.when(F.col("o_orderstatus") == "O", F.array(F.lit("abierta"))).otherwise(F.array().cast("array<string>")).alias("flags"))
    header = o.groupBy("o_custkey").agg((F.max("o_orderstatus") == "P").alias("on"))
    return propagate_status(rows, header, ["o_custkey"], "on", "provisorio").select("o_orderkey", F.array_join(F.array_sort("flags"), ",").alias("flags"))
