"""Matching sources, currency as of a day, coverage routing and set operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesloom.operators import order_stats, scan
from seriesloom.operators.keys import join_on


#: Least width of the cells in which values within a tolerance are added up.
CELL = 4096
#: Rows that one task of a matching gets on average, and the most that one key may have to be matched in one task.
SHARE = 200_000


def _candidates(rows: DataFrame, keys: list[str], tolerance: int, conflict: bool) -> DataFrame:
    """Per distinct (keys, x_, group_): for a left row there, how many right rows are its candidates (``right_n``), and
    the one it has if it is also that one's only candidate (``right_only``); likewise for a right row.

    Rows are counted by value first.  Candidates of a value are then differences of running sums: of all rows up to
    ``tolerance`` above it, less those below it by more.  Sums of ids give the single candidate's id, so no pair of
    rows is ever built.  A value's sums lie in its cell; cells also hold the values near their edges.
    """
    on = lambda side, column: F.sum(F.when(F.col("side_") == side, column).otherwise(0))
    # ids are added up in halves, which can't overflow; only sums of one id are read
    upper, lower = F.shiftright("id_", 32), F.col("id_").bitwiseAND(F.lit((1 << 32) - 1))
    p = rows.groupBy(*keys, "x_", "group_").agg(*[on(side, c).alias(f"{name}{side[0]}") for side in ("left", "right") for name, c in (("n", F.lit(1)), ("u", upper), ("d", lower))])
    if tolerance:
        width = max(CELL, 64 * (tolerance + 1))
        cell = lambda by: F.floor((F.col("x_") + by) / width)
        p = p.withColumn("own_", cell(0)).withColumn("cell_", F.explode(F.array_distinct(F.array(*[cell(by) for by in (-2 * tolerance, 0, 2 * tolerance)]))))
    alone = not tolerance and not conflict

    def over(column: Column, *parts: str) -> Column:
        """The sum over all values within the tolerance."""
        if not tolerance:
            return F.sum(column).over(Window.partitionBy(*keys, "x_", *parts))
        w = Window.partitionBy(*keys, "cell_", *parts).orderBy("x_")
        return F.sum(column).over(w.rangeBetween(Window.unboundedPreceding, tolerance)) - F.coalesce(F.sum(column).over(w.rangeBetween(Window.unboundedPreceding, -tolerance - 1)), F.lit(0))

    unknown = F.col("group_").isNull()

    def of_right(column: Column) -> Column:
        """What a left row meets: right rows of its group; all of them if its own is unknown."""
        return column if alone else over(column) if not conflict else F.when(unknown, over(column)).otherwise(over(column, "group_"))

    def of_left(column: Column) -> Column:
        """What a right row meets: left rows of its group or of none."""
        if alone or not conflict:
            return column if alone else over(column)
        return F.when(unknown, 0).otherwise(over(column, "group_")) + over(F.when(unknown, column).otherwise(0))

    c = p.withColumns({f"{side}_{name}": of(F.col(f"{name}{side[0]}")) for side, of in (("right", of_right), ("left", of_left)) for name in "nud"})
    c = c.withColumns({"right_other": of_right(F.col("nr") * F.col("left_n")), "left_other": of_left(F.col("nl") * F.col("right_n"))})
    if tolerance:
        c = c.filter("cell_ = own_")
    only = lambda side: F.when((F.col(f"{side}_n") == 1) & (F.col(f"{side}_other") == 1), F.shiftleft(f"{side}_u", 32) + F.col(f"{side}_d")).alias(f"{side}_only")
    return c.select(*keys, "x_", "group_", "right_n", "left_n", only("right"), only("left"))


def mutual_unique(left: DataFrame, right: DataFrame, stages: list[tuple[str, list[tuple[str, str]], tuple[str, str, int | None] | None]], left_id: str = "left_id", right_id: str = "right_id", materialise=lambda df: df, conflict: tuple[str, str] | None = None) -> DataFrame:
    """(side, id, other_id, state, stage) of every row of both sides.

    Rows that are each other's only candidate are matched, stage by stage.  A stage is (name,
    [(left column, right column)], (left column, right column, tolerance) or None): whole numbers no further
    apart than the tolerance; with a tolerance of None both must only be there.  ``conflict`` names a left and a
    right column that rule a pair out where the left one is known and they differ.  Null keys are keys of
    their own; ids are whole numbers.  Rows with several candidates, and their candidates, are ambiguous and
    leave the pool; rows that no stage finds a candidate for are left over.  ``materialise`` cuts lineage
    before the stages.

    Rows are dealt once by the keys that all stages share, in as many shares as their number needs, and matched there.
    Rows of a key that is more than a share, and all rows where the stages share no key, are matched stage by
    stage over all tasks, with a shuffle and a table for each.
    """

    pairs = list(dict.fromkeys(tuple(p) for _, keys, _ in stages for p in keys))  # both sides' columns under one name
    values = list(dict.fromkeys((near[0], near[1]) for _, _, near in stages if near))

    def side(df: DataFrame, k: int, own: str) -> DataFrame:
        group = F.col(conflict[k]) if conflict else F.lit(None).cast("string")
        return df.select(F.lit(("left", "right")[k]).alias("side_"), F.col(own).cast("bigint").alias("id_"), group.alias("group_"), *[F.col(p[k]).alias(f"k{i}_") for i, p in enumerate(pairs)], *[F.col(v[k]).cast("bigint").alias(f"v{i}_") for i, v in enumerate(values)])

    pool = materialise(side(left, 0, left_id).unionByName(side(right, 1, right_id)))
    plan = [(name, [f"k{pairs.index(tuple(p))}_" for p in keys], f"v{values.index(near[:2])}_" if near else None, near[2] if near else 0) for name, keys, near in stages]
    common = [f"k{i}_" for i in range(len(pairs)) if all(f"k{i}_" in by for _, by, _, _ in plan)] if plan else []
    if not common:
        return _in_stages(pool, plan, materialise, conflict is not None)
    counts = pool.groupBy(*common).agg(F.count("*").alias("n_"))
    total = counts.agg(F.sum("n_").alias("rows"), F.max("n_").alias("most")).first()
    shares = max(-(-(total.rows or 0) // SHARE), pool.sparkSession.sparkContext.defaultParallelism)
    if (total.most or 0) <= SHARE:
        return _in_shares(pool, common, shares, plan, conflict is not None)
    large = F.broadcast(counts.filter(F.col("n_") > SHARE).select(*common))  # at most one key a share
    small = _in_shares(join_on(pool, large, common, "left_anti"), common, shares, plan, conflict is not None)
    return small.unionByName(_in_stages(materialise(join_on(pool, large, common, "left_semi")), plan, materialise, conflict is not None))


def _in_shares(rows: DataFrame, common: list[str], shares: int, plan: list[tuple[str, list[str], str | None, int | None]], conflict: bool) -> DataFrame:
    """All stages on rows dealt by keys that every stage has: windows only, so nothing is shuffled between them.

    Rows that a stage has decided stay and count for nothing in later ones.  Candidates are counted by differences of
    running counts; the single one of a row is the last one up to ``tolerance`` above it.
    """
    left, unknown = F.col("left_"), F.col("group_").isNull()
    rows = rows.withColumn("left_", F.col("side_") == "left").drop("side_", *([] if conflict else ["group_"])).repartition(shares, *common)
    rows = rows.withColumns({"stage_": F.lit(None).cast("int"), "other_": F.lit(None).cast("bigint")})
    kept = rows.columns
    for i, (_, by, value, tolerance) in enumerate(plan):
        order, near = [value] if value and tolerance is not None else [], bool(tolerance)

        def count(column: str, *parts: str) -> Column:
            """How many rows within the tolerance have the column."""
            if not near:
                return F.count(column).over(Window.partitionBy(*by, *parts, *order))
            w = Window.partitionBy(*by, *parts).orderBy(*order)
            return F.count(column).over(w.rangeBetween(Window.unboundedPreceding, tolerance)) - F.count(column).over(w.rangeBetween(Window.unboundedPreceding, -tolerance - 1))

        def single(column: Column, *parts: str) -> Column:
            """The column of the only row within the tolerance that has it."""
            if not near:
                return F.max(column).over(Window.partitionBy(*by, *parts, *order))
            return F.last(column, ignorenulls=True).over(Window.partitionBy(*by, *parts).orderBy(*order).rangeBetween(Window.unboundedPreceding, tolerance))

        free = F.col("stage_").isNull() & (F.col(value).isNotNull() if value else F.lit(True))
        rows = rows.withColumns({"l_": F.when(free & left, F.col("id_")), "r_": F.when(free & ~left, F.col("id_"))})
        degree = lambda side: F.when(F.col(side).isNotNull(), F.struct(F.col(side).alias("id"), F.col("n_").alias("n")))
        if conflict:
            # all rows are met by left rows of no group, left rows of no group by all; else rows of one group meet
            rows = rows.withColumn("u_", F.when(unknown, F.col("l_"))).withColumns({"nr_": count("r_"), "nu_": count("u_")})
            rows = rows.withColumns({"nrg_": count("r_", "group_"), "nlg_": count("l_", "group_")})
            rows = rows.withColumn("nlg_", F.when(unknown, 0).otherwise(F.col("nlg_")))
            rows = rows.withColumn("n_", F.when(left, F.when(unknown, F.col("nr_")).otherwise(F.col("nrg_"))).otherwise(F.col("nlg_") + F.col("nu_"))).drop("nr_", "nrg_", "nu_")
            rows = rows.withColumns({"rg_": single(degree("r_"), "group_"), "lg_": single(degree("l_"), "group_")})
            rows = rows.withColumn("one_", F.when(left, F.when(~unknown, F.col("rg_"))).otherwise(F.when(F.col("nlg_") > 0, F.col("lg_")))).drop("rg_", "lg_")
            rows = rows.withColumns({"ra_": single(degree("r_")), "ua_": single(degree("u_"))})
            rows = rows.withColumn("one_", F.coalesce("one_", F.when(left, F.when(unknown, F.col("ra_"))).otherwise(F.col("ua_"))))
        elif near:
            rows = rows.withColumns({"nl_": count("l_"), "nr_": count("r_")}).withColumn("n_", F.when(left, F.col("nr_")).otherwise(F.col("nl_")))
            rows = rows.withColumns({"ra_": single(degree("r_")), "la_": single(degree("l_"))}).withColumn("one_", F.when(left, F.col("ra_")).otherwise(F.col("la_")))
        else:
            # rows of a value meet all of the other side's there, so each one's candidates have its own side's number
            rows = rows.withColumns({"nl_": count("l_"), "nr_": count("r_"), "la_": single(F.col("l_")), "ra_": single(F.col("r_"))})
            rows = rows.withColumn("n_", F.when(left, F.col("nr_")).otherwise(F.col("nl_")))
            rows = rows.withColumn("one_", F.struct(F.when(left, F.col("ra_")).otherwise(F.col("la_")).alias("id"), F.when(left, F.col("nl_")).otherwise(F.col("nr_")).alias("n")))
        found = free & (F.col("n_") > 0)
        rows = rows.withColumns({"other_": F.when(found, F.when((F.col("n_") == 1) & (F.col("one_.n") == 1), F.col("one_.id"))).otherwise(F.col("other_")), "stage_": F.when(found, i).otherwise(F.col("stage_"))}).select(*kept)
    state = F.when(F.col("stage_").isNull(), "left over").when(F.col("other_").isNotNull(), "matched").otherwise("ambiguous")
    stage = F.get(F.array(*[F.lit(name) for name, _, _, _ in plan]), F.col("stage_"))
    return rows.select(F.when(left, "left").otherwise("right").alias("side"), F.col("id_").alias("id"), F.col("other_").alias("other_id"), state.alias("state"), stage.alias("stage"))


def _in_stages(pool: DataFrame, plan: list[tuple[str, list[str], str | None, int | None]], materialise, conflict: bool) -> DataFrame:
    """Stage by stage for keys of any size: values are counted over all tasks and joined with the rows."""
    out = None
    for name, by, value, tolerance in plan:
        x = F.col(value) if value else F.lit(0).cast("bigint")
        if tolerance is None:
            x, tolerance = F.when(x.isNotNull(), F.lit(0).cast("bigint")), 0
        pool = pool.withColumn("x_", x)
        found = _candidates(pool.filter("x_ IS NOT NULL"), by, tolerance, conflict)
        of = lambda s: F.when(F.col("side_") == "left", F.col(f"right_{s}")).otherwise(F.col(f"left_{s}"))
        pool = materialise(join_on(pool, found, [*by, "x_", "group_"], "left").withColumns({"n_": of("n"), "other_": of("only")}).drop("x_", "right_n", "left_n", "right_only", "left_only"))
        here = pool.filter("n_ > 0").select(F.col("side_").alias("side"), F.col("id_").alias("id"), F.col("other_").alias("other_id"), F.when(F.col("other_").isNotNull(), "matched").otherwise("ambiguous").alias("state"), F.lit(name).alias("stage"))
        out = here if out is None else out.unionByName(here)
        pool = pool.filter("coalesce(n_, 0) = 0").drop("n_", "other_")
    rest = pool.select(F.col("side_").alias("side"), F.col("id_").alias("id"), F.lit(None).cast("bigint").alias("other_id"), F.lit("left over").alias("state"), F.lit(None).cast("string").alias("stage"))
    return rest if out is None else out.unionByName(rest)


def on_common_days(left: DataFrame, right: DataFrame, left_day: str, right_day: str, materialise=lambda df: df) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(left and right rows of days that both sides have, left and right rows of other days).

    ``materialise`` may write the days, so that they are found once and the planner knows how few they are."""
    a, b = left.select(F.col(left_day).alias("day_")).distinct(), right.select(F.col(right_day).alias("day_")).distinct()
    common = materialise(join_on(a, b, ["day_"], "left_semi"))
    keep = lambda df, day, how: df.join(common, df[day].eqNullSafe(common["day_"]), how)
    return keep(left, left_day, "left_semi"), keep(right, right_day, "left_semi"), keep(left, left_day, "left_anti"), keep(right, right_day, "left_anti")


def match_rates(outcome: DataFrame) -> DataFrame:
    """Rows and share of each state and stage on either side."""
    g = outcome.groupBy("side", "state", "stage").agg(F.count("*").alias("rows"))
    return g.withColumn("rate", F.col("rows").cast("double") / F.sum("rows").over(Window.partitionBy("side")))


def as_of_rates(rows: DataFrame, rates: DataFrame, day: str, rate_day: str, rate: str, max_age: int = 7, by: list[str] | None = None, after_last: bool = False) -> DataFrame:
    """``rows`` with the last rate at or before ``day`` (columns ``rate_day`` and ``rate``), at most ``max_age`` days old.

    Dates or timestamps; rates of each of ``by`` (currencies), null being one, are apart, and of several at one time the
    highest holds.  Rows before the first rate have none, nor do rows after the last one unless ``after_last``.  Rows and
    rates are merged in order of time and scanned in segments: no row a day, and no currency in one task.
    """
    by = by or []
    known = rates.groupBy(*by, F.col(rate_day).alias("at_")).agg(F.max(rate).alias("rate_"))
    row = F.struct(*rows.columns)
    both = known.select(*by, "at_", F.lit(0).alias("kind_"), F.struct(F.col("at_").alias("day"), F.col("rate_").alias("rate")).alias("seen_")).unionByName(
        rows.select(*by, F.col(day).alias("at_"), F.lit(1).alias("kind_"), row.alias("row_")), allowMissingColumns=True)
    filled = scan.carried(both, by, ["at_", "kind_"], ["seen_"]).filter("kind_ = 1")
    fresh = F.col("at_") <= F.col("seen_.day") + F.make_dt_interval(F.lit(max_age))
    if not after_last:
        ends = known.groupBy(*by).agg(F.max("at_").alias("last_")) if by else known.agg(F.max("at_").alias("last_"))
        filled = join_on(filled, ends, by, "left") if by else filled.withColumn("last_", ends.scalar())
        fresh = fresh & (F.col("at_") <= F.col("last_"))
    out = filled.select("row_.*", F.when(fresh, F.col("seen_.day")).alias("rate_day"), F.when(fresh, F.col("seen_.rate")).alias(rate))
    return out


def route_by_coverage(official: DataFrame, legacy: DataFrame, key: list[str]) -> DataFrame:
    """Official rows, and legacy rows of keys that no official row covers; decided before any filter."""
    rest = join_on(legacy, official.select(*key).distinct(), key, "left_anti")
    return official.withColumn("origin", F.lit("official")).unionByName(rest.withColumn("origin", F.lit("legacy")), allowMissingColumns=True)


def priority_union(base: DataFrame, others: list[DataFrame], key: list[str], order: list[str]) -> DataFrame:
    """``base`` as it is, then the first row of each key over ``others`` in order that base lacks."""
    tagged = None
    for k, df in enumerate(others):
        df = df.withColumn("priority_", F.lit(k))
        tagged = df if tagged is None else tagged.unionByName(df)
    first = tagged.withColumn("r_", F.row_number().over(Window.partitionBy(*key).orderBy("priority_", *order))).filter("r_ = 1").drop("r_", "priority_")
    return base.unionByName(join_on(first, base.select(*key).distinct(), key, "left_anti").select(*base.columns))


def first_of_equal(df: DataFrame, ignore: list[str], order: list[str]) -> DataFrame:
    """Exact duplicates but for the columns in ``ignore``: the first in ``order`` stays."""
    key = [c for c in df.columns if c not in ignore]
    return df.withColumn("r_", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter("r_ = 1").drop("r_")


def replace_source(stored: DataFrame, new: DataFrame, source: str) -> DataFrame:
    """``stored`` without the sources in ``new``, plus ``new``."""
    return join_on(stored, new.select(source).distinct(), [source], "left_anti").unionByName(new)


def missing_keys(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """Keys that only one side has, with that side's name."""
    a, b = left.select(*key).distinct(), right.select(*key).distinct()
    return join_on(a, b, key, "left_anti").withColumn("only_in", F.lit("left")).unionByName(join_on(b, a, key, "left_anti").withColumn("only_in", F.lit("right")))


def compare_key_sets(left: DataFrame, right: DataFrame, key: list[str], value: str, tolerance: float = 0.01) -> DataFrame:
    """Per key: values of both sides, whether ambiguous, the ratio where both have one, and
    whether it is within ``tolerance``."""
    side = lambda df, n: df.groupBy(*key).agg(F.countDistinct(value).alias(f"n_{n}"), F.min(value).alias(f"v_{n}"))
    both = join_on(side(left, "left"), side(right, "right"), key, "full")
    one = (F.col("n_left") == 1) & (F.col("n_right") == 1)
    both = both.withColumn("ratio", F.when(one & (F.col("v_right") != 0), F.col("v_left").cast("double") / F.col("v_right")))
    status = F.when(F.col("n_left").isNull(), "solo derecha").when(F.col("n_right").isNull(), "solo izquierda").when(~one, "ambigua").otherwise("comun")
    return both.withColumn("status", status).withColumn("within", F.abs(F.col("ratio") - 1) <= tolerance)


def key_set_summary(compared: DataFrame) -> DataFrame:
    """One row on what :func:`compare_key_sets` gives: keys that both sides have, those with one value on either,
    ambiguous ones, pairs within the tolerance, the median ratio, and keys that either side lacks."""
    both = F.col("status").isin("comun", "ambigua")
    one = compared.agg(
        F.count_if(both).alias("shared_keys"), F.count("ratio").alias("unambiguous_pairs"), F.count_if(F.col("status") == "ambigua").alias("ambiguous_keys"),
        F.count_if(F.coalesce("within", F.lit(False))).alias("within"), F.count_if(F.col("status") == "solo derecha").alias("missing_left"), F.count_if(F.col("status") == "solo izquierda").alias("missing_right"),
    )
    middle = order_stats.quantiles(compared.withColumn("one_", F.lit(1)), ["one_"], "ratio", [0.5]).select(F.col("q0").alias("median_ratio"))
    share = F.when(F.col("unambiguous_pairs") > 0, F.col("within").cast("double") / F.col("unambiguous_pairs"))
    return one.withColumn("within_share", share).withColumn("median_ratio", middle.scalar())


def comparable_combinations(df: DataFrame, identity: list[str], market: str, loose: list[str], period: str, markets: list, top: int | None = None) -> DataFrame:
    """Combinations of one group of each of ``markets`` with the same identity, no two of which
    contradict each other in a loose attribute (unknown fits anything): the attributes of each group,
    the periods that all have, the rows in these, and ``rank`` within the identity by periods, then rows, then
    attributes.

    Groups meet by one equi-join a market, on the identity and the attributes that both know: a group's
    signature says which it knows, and each group stands once for every signature that it may meet, so
    combinations that contradict each other are never made.  A group's periods are bits, 62 a word, so what
    all have is a bitwise and.
    """
    n, every = len(loose), range(1 << len(loose))
    rows = df.filter(F.col(market).isin(*markets) & F.col(period).isNotNull())
    index = rows.select(period).distinct().withColumn("p_", (F.row_number().over(Window.orderBy(period)) - 1).cast("int"))  # one row a period
    words = -(-index.count() // 62)
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    sized = rows.groupBy(*identity, market, *loose, period).agg(F.count("*").alias("n_")).join(index, period)
    word, place = F.floor(F.col("p_") / 62), F.pmod("p_", F.lit(62)).cast("int")
    bits = [F.sum(F.when(word == w, F.call_function("shiftleft", one, place)).otherwise(none)).alias(f"w{w}_") for w in range(words)]
    known = sum((F.when(F.col(c).isNotNull(), 1 << i).otherwise(0) for i, c in enumerate(loose)), F.lit(0))
    groups = sized.groupBy(*identity, market, *loose).agg(*bits, F.map_from_entries(F.collect_list(F.struct("p_", "n_"))).alias("counts_")).withColumn("own_", known)

    def meeting(g: DataFrame, own: str, other: str, values: list[str]) -> DataFrame:
        """Each row once for every signature that it may meet, with the attributes that both know."""
        g = g.withColumn(other, F.explode(F.array(*map(F.lit, every))))
        return g.withColumns({f"on{i}_": F.when(F.col(own).bitwiseAND(F.col(other)).bitwiseAND(F.lit(1 << i)) != 0, F.col(v)) for i, v in enumerate(values)})

    out = None
    for k, name in enumerate(markets):
        g = groups.filter(F.col(market) == name).select(*identity, *[F.col(c).alias(f"{c}_{k}") for c in loose], *[F.col(f"w{w}_").alias(f"g{w}_") for w in range(words)], F.col("counts_").alias(f"counts_{k}_"), "own_")
        if out is None:
            out = g.select("*", *[F.col(f"{c}_0").alias(f"{c}_known_") for c in loose]).withColumnsRenamed({f"g{w}_": f"w{w}_" for w in range(words)} | {"own_": "signature_"})
            continue
        on = [*identity, "signature_", "own_", *[f"on{i}_" for i in range(n)]]
        out = join_on(meeting(out, "signature_", "own_", [f"{c}_known_" for c in loose]), meeting(g, "own_", "signature_", [f"{c}_{k}" for c in loose]), on)
        some = F.lit(False)
        for w in range(words):
            some = some | (F.col(f"w{w}_").bitwiseAND(F.col(f"g{w}_")) != 0)
        out = out.filter(some).withColumns({f"w{w}_": F.col(f"w{w}_").bitwiseAND(F.col(f"g{w}_")) for w in range(words)} | {f"{c}_known_": F.coalesce(f"{c}_known_", f"{c}_{k}") for c in loose} | {"signature_": F.col("signature_").bitwiseOR(F.col("own_"))}).drop("own_", *[f"g{w}_" for w in range(words)], *[f"on{i}_" for i in range(n)])
    common = sum((F.bit_count(f"w{w}_") for w in range(words)), F.lit(0))

    def held(p: Column) -> Column:
        """Whether all have a period."""
        hit = F.lit(False)
        for w in range(words):
            hit = hit | ((F.floor(p / 62) == w) & (F.call_function("shiftright", F.col(f"w{w}_"), F.pmod(p, F.lit(62)).cast("int")).bitwiseAND(one) == 1))
        return hit

    in_common = lambda k: F.aggregate(F.map_entries(f"counts_{k}_"), none, lambda t, e: t + F.when(held(e["key"]), e["value"]).otherwise(none))
    attributes = [f"{c}_{k}" for k in range(len(markets)) for c in loose]
    found = out.select(*identity, *attributes, common.cast("int").alias("common_periods"), sum((in_common(k) for k in range(1, len(markets))), in_common(0)).alias("rows"))
    w = Window.partitionBy(*identity).orderBy(F.desc("common_periods"), F.desc("rows"), *attributes)
    found = found.withColumn("rank", F.row_number().over(w))
    return found.filter(F.col("rank") <= top) if top else found


#: Short labels of one trie.
TRIE_LABELS = 100_000


def _trie(shorts: list[str]) -> dict:
    """Short labels by their letters; a node's labels are under the empty string."""
    root: dict = {}
    for s in shorts:
        node = root
        for letter in s.replace(".", ""):
            node = node.setdefault(letter, {})
        node.setdefault("", []).append(s)
    return root


def _subsequences(trie: dict, long: str, max_extra: int):
    """The trie's labels whose letters are in ``long`` in order, the first one first.

    Each letter is taken where it comes next, which never loses a match, so a node is visited once at most and
    a branch ends at its first letter that doesn't come any more.
    """
    open_ = [(trie[long[0]], 0, 1)] if long and long[0] in trie else []
    while open_:
        node, at, depth = open_.pop()
        for letter, below in node.items():
            if letter:
                found = long.find(letter, at + 1)
                if found >= 0:
                    open_.append((below, found, depth + 1))
            elif 0 < len(long) - depth <= max_extra:
                yield from below


def abbreviations(labels: DataFrame, label: str, max_extra: int = 30) -> DataFrame:
    """(short, long): distinct labels where the short one has a dot and its letters, in order,
    are in the long one, the first of them first.

    The short labels are a trie that is walked along each distinct long label, so the work is that of the
    branches a label follows.  A trie has about TRIE_LABELS labels; more of them are walked in blocks.
    """
    import pandas as pd

    d = labels.select(F.lower(label).alias("l")).filter(F.col("l").isNotNull() & (F.col("l") != "")).distinct()
    short = d.filter(F.col("l").contains(".") & (F.replace("l", F.lit("."), F.lit("")) != "")).select("l")
    long = d.filter(~F.col("l").contains("."))
    blocks, out = max(1, -(-short.count() // TRIE_LABELS)), None
    for k in range(blocks):
        trie = labels.sparkSession.sparkContext.broadcast(_trie(sorted(r.l for r in short.filter(F.pmod(F.xxhash64("l"), F.lit(blocks)) == k).collect())))

        def walk(frames, trie=trie):
            for frame in frames:
                pairs = [(s, x) for x in frame["l"] for s in _subsequences(trie.value, x, max_extra)]
                yield pd.DataFrame(pairs, columns=["short", "long"])

        found = long.mapInPandas(walk, "short string, long string")
        out = found if out is None else out.unionByName(found)
    return out


def embedded_varieties(df: DataFrame, product: str, variety: str) -> DataFrame:
    """(product, base, variety): products whose name is another product's name and a known variety."""
    names = df.select(F.col(product).alias("name")).distinct()
    bases = names.select(F.col("name").alias("base"))
    varieties = df.select(F.col(variety).alias("variety")).filter(F.col("variety").isNotNull()).distinct()
    # split at every space and look both parts up
    cut = names.select("name", F.explode(F.sequence(F.lit(1), F.size(F.split("name", " ")) - 1)).alias("k")).filter("k > 0")
    parts = F.split("name", " ")
    cut = cut.select("name", F.array_join(F.slice(parts, F.lit(1), F.col("k")), " ").alias("base"), F.array_join(F.slice(parts, F.col("k") + 1, F.size(parts)), " ").alias("variety"))
    return cut.join(bases, "base").join(varieties, "variety").select(F.col("name").alias("product"), "base", "variety")


def share_of_totals(parts: DataFrame, totals: DataFrame, key: list[str], value: str, total: str) -> DataFrame:
    """Parts as shares of a total from another source; null where a key has several totals, or none."""
    one = totals.groupBy(*key).agg(F.sum(total).alias("total_"), F.count("*").alias("k_")).filter("k_ = 1").drop("k_")
    return join_on(parts, one, key, "left").withColumn("share", F.when(F.col("total_") > 0, F.col(value).cast("double") / F.col("total_"))).drop("total_")


def year_ago(df: DataFrame, dims: list[str], index: str, value: str, lag: int = 12) -> DataFrame:
    """Change of each row from the only row of its series ``lag`` periods before."""
    base = df.groupBy(*dims, (F.col(index) + lag).alias(index)).agg(F.when(F.count("*") == 1, F.max(value)).alias("base_"))
    return join_on(df, base, [*dims, index], "left").withColumn("variation", F.when(F.col("base_") > 0, (F.col(value) / F.col("base_") - 1) * 100)).drop("base_")


def source_coverage(found: DataFrame, table: DataFrame, key: list[str], month: str, item: str) -> DataFrame:
    """Whether a table includes what was found in a source: rows of both and a status by months,
    items and rows."""
    sets = lambda df, a, b, n: df.groupBy(*key).agg(F.collect_set(month).alias(a), F.collect_set(item).alias(b), F.count("*").alias(n))
    j = join_on(sets(found, "ms_", "ps_", "n"), sets(table, "tm_", "tp_", "tn"), key, "left")
    full = (F.size(F.array_except("ms_", "tm_")) == 0) & (F.size(F.array_intersect("ps_", "tp_")) >= 0.9 * F.size("ps_")) & (F.col("n").cast("double") / F.col("tn")).between(0.8, 1.2)
    status = F.when(F.col("tn").isNull(), "AUSENTE").when(full, "INCLUIDO").when(F.size(F.array_intersect("ms_", "tm_")) > 0, "PARCIAL").otherwise("INCIERTO")
    return j.select(*key, "n", "tn", status.alias("status"))


def freshness_state(checks: DataFrame, attempts: DataFrame, key: list[str], time: str, kind: str, tie: str, name: str) -> DataFrame:
    """Per key: when it was last seen, and the latest state: ``name`` if a check is newer, else the attempt's."""
    a = checks.groupBy(*key).agg(F.max(time).alias("prev_"))
    b = attempts.groupBy(*key).agg(F.max(time).alias("newest_"), F.max_by(kind, F.struct(time, tie)).alias("attempt_"))
    state = F.when(F.col("newest_").isNull() | (F.col("prev_") > F.col("newest_")), name).otherwise(F.col("attempt_"))
    return join_on(a, b, key, "full").select(*key, F.greatest("prev_", "newest_").alias("last_seen"), state.alias("state"))


def pick_source(df: DataFrame, item: str, source: str, period: str, least: int, preference: Column) -> DataFrame:
    """Rows of the one source of each item: the latest, then the one of more than ``least`` periods, then by preference."""
    s = df.groupBy(item, source).agg(F.max(period).alias("latest_"), (F.countDistinct(period) > least).alias("active_"))
    pick = s.groupBy(item).agg(F.max_by(source, F.struct("latest_", "active_", preference)).alias(source))
    return join_on(df, pick, [item, source], "left_semi")


def legacy_coverage(legacy: DataFrame, official: DataFrame, key: list[str], value: str, by: list[str]) -> DataFrame:
    """Keys of the old source, those that the new one covers, gaps, differing values, and whether it may retire."""
    a = legacy.groupBy(*key).agg(F.min(value).alias("old_"))
    b = official.groupBy(*key).agg(F.min(value).alias("new_")).filter("new_ > 0")
    j = join_on(a, b, key, "left").groupBy(*by).agg(F.count("*").alias("keys"), F.count("new_").alias("covered"), F.count_if(F.col("old_") != F.col("new_")).alias("different"))
    return j.withColumn("gaps", F.col("keys") - F.col("covered")).withColumn("retire", F.col("gaps") == 0)
