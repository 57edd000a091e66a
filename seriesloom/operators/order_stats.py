"""Exact order statistics of groups of any size.

Spark's ``percentile`` keeps all distinct values of a group in one task.  That is right for the many
small groups; a heavy group is counted by value first, and the values at the wanted ranks are found by
refinement: every round counts the values of the bins between a group's lowest and highest candidate,
keeps the bin that holds the rank, and narrows to that bin's lowest and highest value, until they are
one.  Tasks add up their own bins before anything is shuffled, so a group's rows stay spread.

Nulls and NaN are passed over.  A group without other values has no row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesloom.operators import scan
from seriesloom.operators.keys import join_on
from seriesloom.sources.tables import written

#: Rows from which a group is heavy.
HEAVY_ROWS = 1_000_000
#: Bins of a round, and heavy groups up to which their state is broadcast.
BINS, FEW_GROUPS = 1024, 100_000


def quantiles(df: DataFrame, dims: list[str], value: str, probabilities: list[float], heavy: int = HEAVY_ROWS, bins: int = BINS) -> DataFrame:
    """(dims, n, q0, q1, ...): the linear-interpolated quantiles of each group, as ``percentile`` gives them."""
    v = F.col(value).cast("double")
    rows = df.select(*dims, v.alias("v_")).filter(v.isNotNull() & ~F.isnan(v))
    names = [f"q{k}" for k in range(len(probabilities))]
    sizes = written(rows.groupBy(*dims).agg(F.count("*").alias("n"), F.min("v_").alias("low_"), F.max("v_").alias("high_")).filter(F.col("n") > heavy).withColumn("group_", F.monotonically_increasing_id()))
    many = sizes.count()
    near = F.broadcast if many <= FEW_GROUPS else lambda x: x
    light = join_on(rows, near(sizes.select(*dims)), dims, "left_anti") if many else rows
    out = light.groupBy(*dims).agg(F.count("*").alias("n"), *[F.percentile("v_", p).alias(n) for n, p in zip(names, probabilities)])
    if not many:
        return out
    counts = written(join_on(rows, near(sizes.select(*dims, "group_")), dims).groupBy("group_", "v_").agg(F.count("*").alias("c_")))
    at = F.inline(F.array(*[F.struct(F.lit(n).alias("name_"), ((F.col("n") - 1) * p).alias("position_")) for n, p in zip(names, probabilities)]))
    wanted = sizes.select("group_", "n", "low_", "high_", at)
    ranks = wanted.select("group_", "low_", "high_", F.explode(F.array(F.floor("position_"), F.ceil("position_"))).alias("rank_")).distinct()
    found = values_at(counts, ranks, near, bins)
    low, high = (found.select("group_", F.col("rank_").alias(f"{s}_rank_"), F.col("v_").alias(f"{s}_value_")) for s in ("low", "high"))
    w = wanted.select("group_", "n", "name_", "position_", F.floor("position_").alias("low_rank_"), F.ceil("position_").alias("high_rank_"))
    w = w.join(low, ["group_", "low_rank_"]).join(high, ["group_", "high_rank_"])
    between = (F.col("high_rank_") - F.col("position_")) * F.col("low_value_") + (F.col("position_") - F.col("low_rank_")) * F.col("high_value_")
    q = F.when(F.col("low_value_") == F.col("high_value_"), F.col("low_value_")).otherwise(between)
    w = w.groupBy("group_", "n").pivot("name_", names).agg(F.max(q))
    return out.unionByName(w.join(sizes.select(*dims, "group_"), "group_").select(*dims, "n", *names))


def values_at(counts: DataFrame, ranks: DataFrame, near, bins: int = BINS) -> DataFrame:
    """(group_, rank_, v_): the value with each wanted rank, from 0, among a group's counted values.

    Each round is one pass over ``counts``; a round divides what is left of a group by up to ``bins``.
    """
    state = ranks.withColumn("left_", F.col("rank_"))
    done = None
    while True:
        state = written(state)
        ready = state.filter("low_ = high_").select("group_", "rank_", F.col("low_").alias("v_"))
        done = ready if done is None else done.unionByName(ready)
        state = state.filter("low_ < high_")
        if state.isEmpty():
            return done
        j = counts.join(near(state), "group_").filter(F.col("v_").between(F.col("low_"), F.col("high_")))
        share = (F.col("v_") / 2 - F.col("low_") / 2) / (F.col("high_") / 2 - F.col("low_") / 2)  # halves, as a range may pass the largest double
        cells = j.groupBy("group_", "rank_", "left_", F.least(F.floor(share * bins), F.lit(bins - 1)).alias("bin_")).agg(F.sum("c_").alias("c_"), F.min("v_").alias("low_"), F.max("v_").alias("high_"))
        upto = F.sum("c_").over(Window.partitionBy("group_", "rank_").orderBy("bin_"))  # at most ``bins`` rows
        cells = cells.withColumn("before_", upto - F.col("c_"))
        inside = (F.col("before_") <= F.col("left_")) & (F.col("left_") < F.col("before_") + F.col("c_"))
        state = cells.filter(inside).select("group_", "low_", "high_", "rank_", (F.col("left_") - F.col("before_")).alias("left_"))


def exact_medians(df: DataFrame, dims: list[str], value: str, parts: int | None = None) -> DataFrame:
    """(dims, median, n) in the value's own type: the mean of the middle one or two.

    Values are counted, and the counts added up along each group's sorted values by a segmented scan.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*dims, F.col(value).alias("v_")).agg(F.count("*").alias("c_"))
    upto = scan.running_sums(counts, dims, ["v_"], {"upto_": "c_"}, parts)
    sizes = counts.groupBy(*dims).agg(F.sum("c_").alias("n"))
    j = join_on(upto, sizes, dims)
    holds = lambda rank: (F.col("upto_") - F.col("c_") < rank) & (rank <= F.col("upto_"))
    middle = j.filter(holds(F.floor((F.col("n") + 1) / 2)) | holds(F.floor((F.col("n") + 2) / 2)))
    return middle.groupBy(*dims).agg(((F.min("v_") + F.max("v_")) / 2).alias("median"), F.max("n").alias("n"))
