"""An unknown dimension is a value of its own: every keyed operator gives on nulls what it gives on a name for them."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from seriesloom.operators import audit, figures, match, quality, rank, series
from seriesloom.streaming import incremental
from tests.comparing import rows as cells

NAME = "~unknown~"
DIMS = ["product", "variety"]


def rows(seed, n=240):
    pick = random.Random(seed)
    out = []
    for i in range(n):
        month = pick.randrange(24)
        day = dt.date(2024 + month // 12, month % 12 + 1, pick.randrange(1, 28))
        out.append((i, pick.choice(["a", "b", None]), pick.choice(["x", "y", None]), pick.choice(["M0", "M1", None]), pick.choice(["s", None]), day, 24 * 1000 + month, day.year, month % 12 + 1, pick.randrange(1, 400), pick.choice(["c1", "c2"])))
    return out


@pytest.fixture(scope="module")
def tables(spark):
    schema = "id long, product string, variety string, market string, source string, day date, month_idx int, year int, m int, price long, content string"
    known = [tuple(NAME if x is None and 1 <= k <= 4 else x for k, x in enumerate(r)) for r in rows(1)], [tuple(NAME if x is None and 1 <= k <= 4 else x for k, x in enumerate(r)) for r in rows(2)]
    pair = lambda data: tuple(spark.createDataFrame(x, schema).cache() for x in data)
    return pair((rows(1), rows(2))), pair(known)


def monthly(df):
    return df.groupBy(*DIMS, "month_idx").agg(F.sum("price").alias("v"))


def daily(df):
    return df.groupBy(*DIMS, "day").agg(F.sum("price").alias("v"), (F.count("*") % 2).alias("method"))


def stored_daily(df):
    return daily(df).withColumn("change_7", F.lit(None).cast("double")).withColumn("change_30", F.lit(None).cast("double"))


def history(a, b):
    m = a.groupBy(*DIMS, "month_idx").agg(F.median(F.col("price").cast("double")).alias("median")).withColumn("change_1", F.lit(None).cast("double")).withColumn("change_12", F.lit(None).cast("double"))
    at = lambda d: d.withColumn("day", F.col("day"))
    return series.merge_history(at(a), m.withColumn("month_idx", F.col("month_idx") - 24000 + 2024 * 12), at(b), DIMS, "day", "price")


JOBS = {
    "fill_months": lambda a, b: series.fill_months(monthly(a), DIMS, "month_idx"),
    "at_or_before": lambda a, b: series.at_or_before(daily(a), DIMS, "day", "v", 7),
    "observed_variation": lambda a, b: series.observed_variation(daily(a), DIMS, "day", "v", "method", 3),
    "coarse_stats": lambda a, b: series.coarse_stats(a, ["variety"], "price"),
    "exact_median": lambda a, b: series.exact_median(a.withColumn("p", F.col("price").cast("decimal(9,2)")), DIMS, "p").withColumn("median", F.col("median").cast("double")),
    "seasonal_reference": lambda a, b: series.seasonal_reference(a.groupBy("product", "year", "m").agg(F.sum("price").alias("v")), ["product"], "year", "m", "v", 2030, least=1),
    "share_points": lambda a, b: series.share_points(a.groupBy("month_idx", "product").agg(F.sum("price").alias("v")), "month_idx", "product", "v"),
    "shares": lambda a, b: series.shares(a.groupBy("market", "product").agg(F.sum("price").alias("v")), ["market"], "product", "v"),
    "reconciled_shares": lambda a, b: series.reconciled_shares(a.filter("product <> 'a' OR product IS NULL").groupBy("market", "m").agg(F.sum("price").alias("v")), a.filter("product <> 'a' OR product IS NULL").groupBy("market").agg(F.sum("price").alias("t")), ["market"], "m", "v", "t"),
    "state_matrix": lambda a, b: series.state_matrix(monthly(a), ["variety"], "product", "month_idx", "v", 6, 9),
    "month_matrix": lambda a, b: series.month_matrix(a.filter("year = 2024").groupBy("product", "m").agg(F.sum("price").alias("v")), "product", "m", "v"),
    "carry_forward": lambda a, b: series.carry_forward(a.select("product", "id", F.when(F.col("price") > 300, F.col("price")).alias("v")), ["product"], "id", "v", 3),
    "merge_history": history,
    "merge_daily": lambda a, b: series.merge_daily(stored_daily(a), daily(b.filter("m < 4")), DIMS, "day", "v", "method"),
    "latest_rows": lambda a, b: series.latest_rows(a, DIMS, ["day", "id"]),
    "outliers": lambda a, b: quality.outliers(a, ["variety"], "price", 0.1),
    "outliers of heavy groups": lambda a, b: quality.outliers(a, ["variety"], "price", 0.1, heavy=20),
    "extremes": lambda a, b: quality.extremes(a, DIMS, "price", least=2, factor=1.5),
    "quarantine, kept": lambda a, b: quality.quarantine(a, DIMS + ["market"], ["content"], "r")[0].withColumn("flags", F.array_join("flags", ",")),
    "quarantine, held": lambda a, b: quality.quarantine(a, DIMS + ["market"], ["content"], "r")[1],
    "expected_counts": lambda a, b: quality.expected_counts(a, b.groupBy("variety").agg(F.count("*").alias("expected")), ["variety"], "id", "m", 12),
    "duplicate_candidates": lambda a, b: quality.duplicate_candidates(a, DIMS),
    "route_by_coverage": lambda a, b: match.route_by_coverage(a.filter("m < 4"), b, ["product", "m"]),
    "priority_union": lambda a, b: match.priority_union(a.filter("m < 2"), [b.filter("m < 4"), b], [*DIMS, "market"], ["id"]),
    "replace_source": lambda a, b: match.replace_source(a, b.filter("source IS NULL OR source = '~unknown~'"), "source"),
    "missing_keys": lambda a, b: match.missing_keys(a.filter("m < 5"), b.filter("m < 5"), ["product", "variety", "m"]),
    "compare_key_sets": lambda a, b: match.compare_key_sets(a, b, ["product", "variety", "market"], "price"),
    "key_set_summary": lambda a, b: match.key_set_summary(match.compare_key_sets(a, b, ["product", "variety", "m"], "price", 0.5)),
    "share_of_totals": lambda a, b: match.share_of_totals(a.groupBy(*DIMS).agg(F.sum("price").alias("v")), b.groupBy(*DIMS).agg(F.sum("price").alias("t")), DIMS, "v", "t"),
    "year_ago": lambda a, b: match.year_ago(monthly(a), DIMS, "month_idx", "v"),
    "source_coverage": lambda a, b: match.source_coverage(a, b.filter("m < 9"), ["market", "variety"], "m", "content"),
    "freshness_state": lambda a, b: match.freshness_state(a.filter("m < 6"), b.filter("m < 6"), DIMS, "day", "content", "id", "seen"),
    "pick_source": lambda a, b: match.pick_source(a, "product", "source", "m", 3, F.length(F.coalesce("source", F.lit("~unknown~")))),
    "legacy_coverage": lambda a, b: match.legacy_coverage(a, b, ["product", "variety", "m"], "price", ["product"]),
    "as_of_rates": lambda a, b: match.as_of_rates(a.select("id", "variety", "day"), b.select("variety", F.col("day").alias("rday"), F.col("price").alias("rate")), "day", "rday", "rate", 20, ["variety"]),
    "mutual_unique": lambda a, b: match.mutual_unique(a, b.withColumn("id", F.col("id") + 1000), [("one", [("product", "product"), ("variety", "variety"), ("m", "m")], ("price", "price", 9)), ("two", [("product", "product"), ("market", "market")], ("price", "price", 0))], "id", "id"),
    "keyed_upsert": lambda a, b: incremental.keyed_upsert(a.groupBy(*DIMS, "m").agg(F.max("price").alias("v")), b.groupBy(*DIMS, "m").agg(F.max("price").alias("v")), [*DIMS, "m"]),
    "revision_ledger": lambda a, b: incremental.revision_ledger(a.groupBy(*DIMS).agg(F.max("price").alias("v")), b.groupBy(*DIMS).agg(F.max("price").alias("v")), DIMS, "v"),
    "merge_current": lambda a, b: incremental.merge_current(daily(a), daily(b.filter("m < 5")), [*DIMS, "day"], "v"),
    "affected_months": lambda a, b: incremental.affected_months(a, b.filter("m < 3"), DIMS, "month_idx"),
    "propagate_status": lambda a, b: incremental.propagate_status(a.select("id", *DIMS, F.array().cast("array<string>").alias("flags")), b.groupBy(*DIMS).agg((F.sum("price") % 2 == 0).alias("on")), DIMS, "on", "f").withColumn("flags", F.array_join("flags", ",")),
    "two_way_duplicates": lambda a, b: incremental.two_way_duplicates(a, DIMS, ["content"], ["id"]),
    "market_origin": lambda a, b: figures.market_origin(a, "product", "market", "source", "month_idx", "price", 9),
    "overview": lambda a, b: figures.overview(a, "source", "m", "id", "content", "day"),
    "month_coverage": lambda a, b: audit.month_coverage(a, DIMS, "month_idx"),
    "season_classes": lambda a, b: rank.season_classes(a, DIMS, F.col("m"), "price"),
}


@pytest.mark.parametrize("name", sorted(JOBS))
def test_null_is_a_value_of_its_own(tables, name):
    (a, b), (c, d) = tables
    got, want = JOBS[name](a, b).toPandas(), JOBS[name](c, d).toPandas()
    want = want.astype(object).where(want != NAME, None)
    assert len(want) and cells(got) == cells(want)


def test_stable_ids_of_different_rows_differ(spark):
    raw = [("a", None, "b"), ("a", "b", None), (None, "a", "b"), ("a|b", None, None), ("a", "|b", None), ("a", None, "b")]
    got = quality.stable_ids(spark.createDataFrame([(i, *r) for i, r in enumerate(raw)], "i int, p string, q string, r string"), ["p", "q"], ["p", "q", "r"], ["i"]).collect()
    assert len({r.record_id for r in got}) == 5 and len({r.observation_id for r in got}) == 6
    assert {r.i: r.occurrence for r in got} == {0: 0, 1: 0, 2: 0, 3: 0, 4: 0, 5: 1}
    assert len({r.series_id for r in got}) == 5


def test_figures_that_must_stay_back(spark):
    df = spark.createDataFrame([("p", "a", 5, "kg"), ("p", "b", 1, "caja"), ("q", "a", 3, "kg"), ("q", "b", 1, "kg"), ("r", "a", 1, None)], "p string, i string, v long, u string")
    got = {(r.p, r.i): r.share for r in figures.described_quantities(df, "p", "i", "v", F.lit(True), "u").collect()}
    assert got == {("p", "a"): None, ("p", "b"): None, ("q", "a"): 0.75, ("q", "b"): 0.25, ("r", "a"): None}
    parts = spark.createDataFrame([("1", "x", 5), ("1", "y", -1), ("2", "x", 1), ("2", "y", 3), ("3", "x", 1)], "p string, k string, v long")
    assert {r.p: (r.share0, r.share1) for r in figures.composition(parts, "p", "k", ["x", "y"], "v").collect()} == {"1": (None, None), "2": (0.25, 0.75), "3": (None, None)}
    grid = spark.createDataFrame([(2024, 1, 1), (2024, 1, 9), (2024, 2, 4), (2025, 2, 8)], "y int, m int, v long")
    assert {r.y: (r.m1, r.m2) for r in series.year_grid(grid, "y", "m", "v").collect()} == {2024: (None, 0.0), 2025: (None, 1.0)}
    assert [r.m2 for r in series.year_grid(grid.filter("m = 2 AND y = 2024"), "y", "m", "v").collect()] == [0.5]
    total = spark.createDataFrame([("1", 10), ("2", 10), ("3", 10), ("3", 10)], "p string, t long")
    parts = spark.createDataFrame([("1", "x", 4), ("1", "y", 6), ("2", "x", 4), ("2", "y", 5), ("3", "x", 10)], "p string, k string, v long")
    assert {(r.p, r.k): (r.share, r["rank"], r.top3) for r in series.reconciled_shares(parts, total, ["p"], "k", "v", "t").collect()} == {("1", "x"): (0.4, 2, None), ("1", "y"): (0.6, 1, None)}


def test_abbreviations_walk_the_trie(spark, monkeypatch):
    labels = ["t. cherry", "tom.", "t.", "tomate cherry", "tomate", "tm.", "x.y", "é.a", "ébano", "o.m.", "tomates perita con un nombre largo de veras", None, "", "."]
    df = spark.createDataFrame([(x,) for x in labels], "l string")
    short = [x for x in labels if x and "." in x and x != "."]
    fits = lambda s, x: x[0] == s[0] and all(c in it for it in [iter(x)] for c in s)
    want = {(s, x) for s in short for x in labels if x and "." not in x and 0 < len(x) - len(s.replace(".", "")) <= 30 and fits(s.replace(".", ""), x)}
    assert {tuple(r) for r in match.abbreviations(df, "l").collect()} == want and len(want) > 5
    monkeypatch.setattr(match, "TRIE_LABELS", 2)
    assert {tuple(r) for r in match.abbreviations(df, "l").collect()} == want


@pytest.mark.parametrize("seed", [1, 2])
def test_combinations_equal_a_walk_over_groups(spark, seed):
    from itertools import product

    pick = random.Random(seed)
    data = [(pick.choice(["p", "q", None]), pick.choice(["A", "B", "C"]), pick.choice(["x", "y", None]), pick.choice([1, 2, None]), pick.randrange(80)) for _ in range(3000)]
    df = spark.createDataFrame(data, "k string, market string, a string, b int, month int")
    groups = {}
    for k, m, a, b, p in data:
        groups.setdefault((k, m), {}).setdefault((a, b), []).append(p)
    want = {}
    for k in ("p", "q", None):
        found = []
        for picked in product(*(groups.get((k, m), {}).items() for m in "ABC")):
            if any(len({attrs[i] for attrs, _ in picked} - {None}) > 1 for i in (0, 1)):
                continue
            common = set.intersection(*(set(ps) for _, ps in picked))
            if common:
                found.append((len(common), sum(p in common for _, ps in picked for p in ps), tuple(attrs for attrs, _ in picked)))
        order = lambda f: (-f[0], -f[1], [(x is not None, x or 0) if i else (x is not None, x or "") for attrs in f[2] for i, x in enumerate(attrs)])
        want |= {(k, f[2]): (f[0], f[1], r) for r, f in enumerate(sorted(found, key=order), 1)}
    got = {(r.k, ((r.a_0, r.b_0), (r.a_1, r.b_1), (r.a_2, r.b_2))): (r.common_periods, r.rows, r["rank"]) for r in match.comparable_combinations(df, ["k"], "market", ["a", "b"], "month", ["A", "B", "C"]).collect()}
    assert got == want and len(want) > 50
    best = match.comparable_combinations(df, ["k"], "market", ["a", "b"], "month", ["A", "B", "C"], top=1).collect()
    assert {r["rank"] for r in best} == {1} and len(best) == 3
