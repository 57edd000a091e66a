"""Scans along one long series or file, spread over tasks.

A window over a key sorts all of the key's rows in one task.  Here rows are range-partitioned by key and
order, so a long series lies in several segments; a scan works inside the segments, then over one
summary row for each key and segment, and adds what earlier segments hand on.  It gives what the
window over the whole key gives.

``order`` must tell the rows of a key apart where their order matters; rows equal in it stay in one segment
and are taken in any order.  Null keys are keys of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesloom.operators.keys import join_on
from seriesloom.sources.tables import written


def segmented(df: DataFrame, keys: list[str], order: list[str], parts: int | None = None) -> DataFrame:
    """``df`` written in order, with ``place_`` (rising with key and order) and ``segment_`` (its range).

    Written, as the place of a row must not change when a lost task runs again.
    """
    by = [F.col(c) for c in (*keys, *order)]
    ranged = df.repartitionByRange(parts, *by) if parts else df.repartitionByRange(*by)
    placed = written(ranged.sortWithinPartitions(*by).withColumn("place_", F.monotonically_increasing_id()))
    return placed.withColumn("segment_", F.shiftright("place_", 33))


def _handed_on(s: DataFrame, keys: list[str], summary: list, earlier: list) -> DataFrame:
    """Summaries by key and segment turned into what each segment gets from the key's earlier ones."""
    ends = s.groupBy(*keys, "segment_").agg(*summary)
    return ends.select(*keys, "segment_", *earlier)


def _inside(keys: list[str]):
    return Window.partitionBy(*keys, "segment_").orderBy("place_")


def _across(keys: list[str]):
    return Window.partitionBy(*keys).orderBy("segment_")  # one row a segment


def carried(df: DataFrame, keys: list[str], order: list[str], columns: list[str], parts: int | None = None) -> DataFrame:
    """``df`` with each of ``columns`` filled: its last value that isn't null, up to the row."""
    s = segmented(df, keys, order, parts)
    upto, before = _inside(keys).rowsBetween(Window.unboundedPreceding, 0), _across(keys).rowsBetween(Window.unboundedPreceding, -1)
    summary = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("place_"))).alias(f"{c}_end_") for c in columns]
    handed = _handed_on(s, keys, summary, [F.last(f"{c}_end_", ignorenulls=True).over(before).alias(f"{c}_from_") for c in columns])
    local = s.withColumns({f"{c}_here_": F.last(c, ignorenulls=True).over(upto) for c in columns})
    j = join_on(local, handed, [*keys, "segment_"], "left")
    return j.select(*[F.coalesce(f"{c}_here_", f"{c}_from_").alias(c) if c in columns else F.col(c) for c in df.columns])


def previous(df: DataFrame, keys: list[str], order: list[str], columns: dict[str, str], parts: int | None = None) -> DataFrame:
    """``df`` with new columns (name: column) that hold the key's row before; null in its first row."""
    s = segmented(df, keys, order, parts)
    row = F.struct(*[F.col(c).alias(n) for n, c in columns.items()])
    handed = _handed_on(s, keys, [F.max_by(row, "place_").alias("end_")], [F.lag("end_").over(_across(keys)).alias("from_")])
    j = join_on(s.withColumn("here_", F.lag(row).over(_inside(keys))), handed, [*keys, "segment_"], "left")
    return j.select(*df.columns, *[F.when(F.col("here_").isNull(), F.col(f"from_.{n}")).otherwise(F.col(f"here_.{n}")).alias(n) for n in columns])


def running_sums(df: DataFrame, keys: list[str], order: list[str], columns: dict[str, str], parts: int | None = None) -> DataFrame:
    """``df`` with new columns (name: column) that hold the sum over the key's rows up to and with the row."""
    s = segmented(df, keys, order, parts)
    upto, before = _inside(keys).rowsBetween(Window.unboundedPreceding, 0), _across(keys).rowsBetween(Window.unboundedPreceding, -1)
    handed = _handed_on(s, keys, [F.sum(c).alias(f"{n}_end_") for n, c in columns.items()], [F.sum(f"{n}_end_").over(before).alias(f"{n}_from_") for n in columns])
    j = join_on(s.withColumns({f"{n}_here_": F.sum(c).over(upto) for n, c in columns.items()}), handed, [*keys, "segment_"], "left")
    total = lambda n: F.when(F.col(f"{n}_here_").isNull(), F.col(f"{n}_from_")).otherwise(F.col(f"{n}_here_") + F.coalesce(F.col(f"{n}_from_"), F.lit(0)))
    return j.select(*df.columns, *[total(n).alias(n) for n in columns])
