"""Mutual-unique matching against pairs built one by one."""

import random
import time

import pytest

from seriesloom.operators import match
from seriesloom.plans import registry
from seriesloom.sources import tables
from seriesloom.sources.tables import written


def by_pairs(left, right, stages, conflict):
    """The same by all pairs: rows are dicts with an id."""
    out, pools = [], [dict((r["id"], r) for r in side) for side in (left, right)]
    for name, keys, near in stages:
        pairs = []
        for a in pools[0].values():
            for b in pools[1].values():
                if any(a[x] != b[y] for x, y in keys) or (near and (a[near[0]] is None or b[near[1]] is None)) or (near and near[2] is not None and abs(a[near[0]] - b[near[1]]) > near[2]):
                    continue
                if not (conflict and a[conflict[0]] is not None and a[conflict[0]] != b[conflict[1]]):
                    pairs.append((a["id"], b["id"]))
        degree = [{}, {}]
        for p in pairs:
            for k in (0, 1):
                degree[k].setdefault(p[k], set()).add(p[1 - k])
        for k, side in enumerate(("left", "right")):
            for i, others in degree[k].items():
                other = next(iter(others))
                one = len(others) == 1 and len(degree[1 - k][other]) == 1
                out.append((side, i, other if one else None, "matched" if one else "ambiguous", name))
        for k in (0, 1):
            pools[k] = {i: r for i, r in pools[k].items() if i not in degree[k]}
    return sorted(out + [(side, i, None, "left over", None) for k, side in enumerate(("left", "right")) for i in pools[k]], key=str)


@pytest.mark.parametrize("seed,conflict,cell", [(1, None, 4096), (2, ("cur", "cur"), 4096), (3, ("cur", "cur"), 8), (4, None, 8)])
def test_matching_equals_pairs(spark, monkeypatch, seed, conflict, cell):
    monkeypatch.setattr(match, "CELL", cell)
    pick = random.Random(seed)
    row = lambda i: {"id": i, "k": pick.choice(["a", "b", "c", "d", None]), "l": pick.choice(["x", "y", None]), "p": pick.choice([None, *range(-30, 400)]), "cur": pick.choice(["ARS", "USD", None])}
    left, right = [row(i) for i in range(120)], [row(1000 + i) for i in range(120)]
    table = lambda rows, name: spark.createDataFrame([(r["id"], r["k"], r["l"], r["p"], r["cur"]) for r in rows], f"{name} long, k string, l string, p long, cur string")
    stages = [("exact", [("k", "k"), ("l", "l")], ("p", "p", 0)), ("near", [("k", "k"), ("l", "l")], ("p", "p", 2)), ("wide", [("k", "k")], ("p", "p", 5)), ("priced", [("k", "k"), ("l", "l")], ("p", "p", None)), ("any", [("l", "l")], None)]
    got = match.mutual_unique(table(left, "left_id"), table(right, "right_id"), stages, materialise=written, conflict=conflict).collect()
    assert sorted((tuple(r) for r in got), key=str) == by_pairs(left, right, stages, conflict)


def test_a_hot_key_builds_no_pairs(spark):
    """One key with 40,000 rows on either side: 1,600,000,000 pairs, of which none is made."""
    left = spark.range(40_000).selectExpr("id AS left_id", "'a' AS k", "id * 5 AS p", "CASE WHEN id % 2 = 0 THEN 'ARS' END AS cur")
    right = spark.range(40_000).selectExpr("id + 100000 AS right_id", "'a' AS k", "id * 5 + 1 AS p", "'ARS' AS cur")
    start = time.time()
    got = match.mutual_unique(left, right, [("near", [("k", "k")], ("p", "p", 1))], conflict=("cur", "cur"))
    assert got.groupBy("state").count().collect() == [("matched", 80_000)]
    assert got.filter("side = 'left' AND other_id <> id + 100000").count() == 0
    crowd = match.mutual_unique(left, right, [("key", [("k", "k")], None)], conflict=None)
    assert {(r.state, r["count"]) for r in crowd.groupBy("state").count().collect()} == {("ambiguous", 80_000)}
    assert time.time() - start < 60


@pytest.mark.parametrize("seed,conflict,share", [(5, None, 200_000), (6, ("cur", "cur"), 200_000), (7, None, 70), (8, ("cur", "cur"), 70)])
def test_stages_that_share_a_key_need_one_table(spark, monkeypatch, seed, conflict, share):
    """The rows are written and dealt once, whatever the number of stages, unless a key is more than a share."""
    monkeypatch.setattr(match, "SHARE", share)
    pick = random.Random(seed)
    row = lambda i: {"id": i, "k": pick.choice(["a", "a", "a", "b", "c", None, None, None]), "l": pick.choice(["x", "y", None]), "p": pick.choice([None, *range(-30, 200)]), "q": pick.choice([None, 1, 2]), "cur": pick.choice(["ARS", "USD", None])}
    left, right = [row(i - 60) for i in range(120)], [row((1 << 40) + i) for i in range(120)]
    table = lambda rows, name: spark.createDataFrame([(r["id"], r["k"], r["l"], r["p"], r["q"], r["cur"]) for r in rows], f"{name} long, k string, l string, p long, q long, cur string")
    stages = [("exact", [("l", "l"), ("k", "k")], ("p", "p", 0)), ("near", [("k", "k"), ("l", "l")], ("p", "p", 2)), ("wide", [("k", "k")], ("p", "p", 5)), ("there", [("k", "k"), ("l", "l")], ("q", "q", None)), ("any", [("k", "k")], None)]
    tables = []
    got = match.mutual_unique(table(left, "left_id"), table(right, "right_id"), stages, materialise=lambda df: tables.append(1) or written(df), conflict=conflict).collect()
    assert sorted((tuple(r) for r in got), key=str) == by_pairs(left, right, stages, conflict)
    assert len(tables) == (1 if share > 240 else 2 + len(stages))


@pytest.mark.parametrize("conflict", [None, ("cur", "cur")])
def test_shares_follow_the_input(spark, monkeypatch, conflict):
    """Twice the rows are matched in twice the tasks, not in larger ones."""
    monkeypatch.setattr(match, "SHARE", 500)
    tasks = []
    for n in (2_000, 4_000):
        side = lambda name, by: spark.range(n).selectExpr(f"id + {by} AS {name}", "id div 5 AS k", "id AS p", "CASE WHEN id % 3 > 0 THEN 'ARS' END AS cur")
        got = match.mutual_unique(side("left_id", 0), side("right_id", 1_000_000), [("exact", [("k", "k")], ("p", "p", 0)), ("near", [("k", "k")], ("p", "p", 1))], materialise=written, conflict=conflict)
        assert got.filter("state = 'matched'").count() == 2 * n
        tasks.append(got.rdd.getNumPartitions())
    assert tasks == [8, 16]


@pytest.mark.parametrize("query", ["match_currency_conflict", "match_mutual_unique"])
def test_rows_are_dealt_from_files_of_a_share(spark, sql, monkeypatch, query):
    """A task that deals rows out holds what it reads: some files, none of which may have more rows than a share."""
    monkeypatch.setattr(match, "SHARE", 400)
    before = len(tables._made)
    got = registry.QUERIES[query](spark, sql[1])
    pools = [p for p in map(spark.read.parquet, tables._made[before:]) if "side_" in p.columns]
    files = [r["count"] for p in pools[:1] for r in p.groupBy("_metadata.file_path").count().collect()]
    assert len(files) > 3 and max(files) <= 400
    assert got.count() == 2 * spark.read.parquet(f"{sql[1]}/orders.parquet").count()
