"""Joins on keys in which an unknown dimension is a value of its own.

A series is the full tuple of its dimensions, and a dimension that a source leaves out is null: two rows
without a variety belong together as two rows of one variety do, which grouping does and joins by
equal names don't.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_on(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """As ``left.join(right, keys, how)``, where null equals null.

    The test is an equi-join to the planner, so it is hashed, sorted, broadcast or split as any other.
    """
    other = right.select(*[F.col(k).alias(f"{k}_of_right_") for k in keys], *[c for c in right.columns if c not in keys])
    on = F.lit(True)
    for k in keys:
        on = on & left[k].eqNullSafe(other[f"{k}_of_right_"])
    j = left.join(other, on, how)
    if how in ("left_semi", "left_anti"):
        return j
    if how in ("right", "full"):
        # a null on one side is filled from the other: where both rows are there they are equal
        j = j.withColumns({k: F.coalesce(left[k], other[f"{k}_of_right_"]) for k in keys})
    rest = [c for c in j.columns if c not in keys and not (c.endswith("_of_right_") and c[: -len("_of_right_")] in keys)]
    return j.select(*keys, *rest)
