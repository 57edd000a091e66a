"""Row flags, eligibility, outliers, duplicates and gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesloom.operators import order_stats
from seriesloom.operators.keys import join_on


def reasons(rules: dict[str, Column]) -> Column:
    """The names of the rules that hold, in the stated order."""
    return F.array_compact(F.array(*[F.when(F.coalesce(rule, F.lit(False)), name) for name, rule in rules.items()]))


def with_reasons(df: DataFrame, rules: dict[str, Column], name: str = "reasons") -> DataFrame:
    return df.withColumn(name, reasons(rules))


def reason_counts(df: DataFrame, name: str = "reasons") -> DataFrame:
    return df.select(F.explode(name).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def blockers(flags: Column, blocking: list[str]) -> Column:
    """The blocking flags among ``flags``, sorted."""
    return F.array_sort(F.array_intersect(flags, F.array(*map(F.lit, blocking))))


def outliers(df: DataFrame, dims: list[str], value: str, k: float, heavy: int = order_stats.HEAVY_ROWS) -> DataFrame:
    """Positive values beyond k interquartile ranges from the quartiles of their group, which may be of any size."""
    v = F.col(value).cast("double")
    edges = order_stats.quantiles(df.filter(F.col(value) > 0), dims, value, [0.25, 0.75], heavy).select(*dims, F.col("q0").alias("q1"), F.col("q1").alias("q3"), F.col("n").alias("group_n"))
    span = F.col("q3") - F.col("q1")
    return join_on(df, edges, dims).filter((F.col(value) > 0) & ((v < F.col("q1") - k * span) | (v > F.col("q3") + k * span)))


def extremes(df: DataFrame, dims: list[str], value: str, least: int = 5, factor: float = 10, heavy: int = order_stats.HEAVY_ROWS) -> DataFrame:
    """Values over ``factor`` times, or under 1/``factor`` of, the median of a group of enough rows, which may be of any size."""
    middle = join_on(order_stats.quantiles(df, dims, value, [0.5], heavy).select(*dims, F.col("q0").alias("group_median")), df.groupBy(*dims).agg(F.count("*").alias("group_n")), dims).filter(F.col("group_n") >= least)
    return join_on(df, middle, dims).filter((F.col(value) > F.col("group_median") * factor) | (F.col(value) * factor < F.col("group_median")))


def published_table(df: DataFrame, rules: list[tuple[dict[str, str], Column]]) -> DataFrame:
    """Rows of the one table that a rule names for its scope (column values, such as family and
    frequency); rows of a scope without a rule go, so that nothing published twice is summed."""
    keep = F.lit(False)
    for scope, rule in rules:
        for column, value in scope.items():
            rule = rule & (F.col(column) == value)
        keep = keep | rule
    return df.filter(keep)


def duplicate_groups(df: DataFrame, key: list[str]) -> DataFrame:
    """Groups of more than one row, their rows, and the rows beyond the first."""
    groups = df.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")
    return groups.agg(F.count("*").alias("groups"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("excess"))


def duplicate_candidates(df: DataFrame, key: list[str]) -> DataFrame:
    return df.withColumn("is_duplicate_candidate", F.count("*").over(Window.partitionBy(*key)) > 1)


def quarantine(df: DataFrame, key: list[str], content: list[str], flag: str) -> tuple[DataFrame, DataFrame]:
    """(rows of keys without conflicts, with ``flag`` where repeated; rows of keys that conflict)."""
    state = df.groupBy(*key).agg(F.countDistinct(F.struct(*content)).alias("kinds_"), F.count("*").alias("rows_"))
    joined = join_on(df, state, key)
    good = joined.filter("kinds_ = 1").withColumn("flags", F.when(F.col("rows_") > 1, F.array(F.lit(flag))).otherwise(F.array().cast("array<string>")))
    return good.drop("kinds_", "rows_"), joined.filter("kinds_ > 1").drop("kinds_", "rows_")


class GateFailure(ValueError):
    """A data-quality gate did not hold."""


def gate_counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row per rule: rows that break it, in one pass."""
    one = df.agg(*[F.count_if(~F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()])
    return one.unpivot([], list(rules), "gate", "broken")


def gates(df: DataFrame, rules: dict[str, Column], key: list[str] | None = None, some: Column | None = None) -> None:
    """Raises :class:`GateFailure` unless rows are there (and one fulfils ``some``), every rule
    holds in every row, and ``key`` is unique."""
    aggs = [F.count("*").alias("rows_")] + [F.count_if(~F.coalesce(r, F.lit(False))).alias(n) for n, r in rules.items()]
    if some is not None:
        aggs.append(F.count_if(some).alias("some_"))
    found = df.agg(*aggs).first().asDict()
    broken = [n for n in rules if found[n]]
    if not found["rows_"] or found.get("some_") == 0:
        broken.append("not_empty")
    if key and not df.groupBy(*key).count().filter("count > 1").isEmpty():
        broken.append("unique_key")
    if broken:
        raise GateFailure(", ".join(broken))


def observed_values(df: DataFrame, by: list[str], observed: Column) -> DataFrame:
    """Rows and observed values of each part; a part without any isn't good."""
    return df.groupBy(*by).agg(F.count("*").alias("rows"), F.count_if(observed).alias("observed")).withColumn("good", F.col("observed") > 0)


def unique_keys(df: DataFrame, key: list[str], by: list[str]) -> DataFrame:
    """Keys, those that occur more than once, and whether there are none of these, by part."""
    keys = df.groupBy(*key).agg(F.count("*").alias("n"))
    return keys.groupBy(*by).agg(F.count("*").alias("keys"), F.count_if(F.col("n") > 1).alias("repeated")).withColumn("good", F.col("repeated") == 0)


def homogeneous(df: DataFrame, group: list[str], dims: list[str]) -> DataFrame:
    """Distinct values of each dimension in a group, and whether each has one."""
    return df.groupBy(*group).agg(*[F.countDistinct(c).alias(c) for c in dims]).withColumn("good", F.expr(" AND ".join(f"{c} = 1" for c in dims)))


def date_rules(start: str, stop: str, as_of: Column, part: str, own: Column) -> dict[str, Column]:
    """Rules on dates: not in the future, not ending before the start, in their partition."""
    return {"future": F.col(start) <= as_of, "reversed": F.col(stop) >= F.col(start), "misplaced": F.col(part) == own}


def has_provenance(digest: str, captured: str) -> Column:
    """Whether a row has a hash of 64 lower-case hexadecimal digits and a capture time."""
    return F.coalesce(F.col(digest).rlike(r"^[0-9a-f]{64}$"), F.lit(False)) & F.col(captured).isNotNull()


def expected_counts(df: DataFrame, expected: DataFrame, by: list[str], identity: str, period: str, periods: int) -> DataFrame:
    """Distinct identities and periods of each part against a table of what is expected; parts that
    only one side has aren't good."""
    g = df.groupBy(*by).agg(F.countDistinct(identity).alias("n"), F.countDistinct(period).alias("months")).transform(lambda x: join_on(x, expected, by, "full"))
    return g.withColumn("good", F.coalesce((F.col("n") == F.col("expected")) & (F.col("months") == periods), F.lit(False)))


def unit_fanout(df: DataFrame, price: str, units: dict[str, float], positive_only: list[str]) -> DataFrame:
    """One row for each unit (its name and what the price is divided by); units in ``positive_only``
    need a positive price."""
    p = F.col(price).cast("double")
    rows = [F.struct(F.lit(name).alias("unit"), (p if by == 1 else p / by).alias("price")) for name, by in units.items()]
    rows = [F.when(p > 0, row) if name in positive_only else row for name, row in zip(units, rows)]
    return df.select(*[c for c in df.columns if c not in (price, "price", "unit")], F.inline(F.array_compact(F.array(*rows))))


def stable_id(columns: list[str]) -> Column:
    """Hash of the columns' values as text, by name, with nulls kept: no two different rows share it."""
    return F.sha2(F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in columns]), {"ignoreNullFields": "false"}), 256)


def stable_ids(df: DataFrame, dims: list[str], raw: list[str], order: list[str]) -> DataFrame:
    """Adds series_id (of the dimensions), record_id (of the row as it was taken in, ``raw``), occurrence
    (the row's number, from 0, among those of one record by ``order``) and observation_id (of record and occurrence)."""
    out = df.withColumn("series_id", stable_id(dims)).withColumn("record_id", stable_id(raw))
    out = out.withColumn("occurrence", (F.row_number().over(Window.partitionBy("record_id").orderBy(*order)) - 1).cast("bigint"))
    return out.withColumn("observation_id", stable_id(["record_id", "occurrence"]))


def zero_cause(raw: Column, cancelled: list[str], no_price: list[str]) -> Column:
    """Why a price text gives no price: empty, cancelled, words for no price, unreadable, or zero."""
    number = raw.try_cast("double")
    return F.when(raw.isNull() | (raw == ""), "vacio").when(raw.isin(*cancelled), "anulacion").when(raw.isin(*no_price), "texto sin precio").when(number.isNull(), "error de lectura").when(number == 0, "cero explicito").otherwise("con precio")


def future_rows(df: DataFrame, by: list[str], day: str, as_of: str) -> DataFrame:
    """Rows up to ``as_of``, rows after it, and the last day kept."""
    seen = F.col(day) <= F.lit(as_of).cast("date")
    return df.groupBy(*by).agg(F.count_if(seen).alias("kept"), F.count_if(~seen).alias("future"), F.max(F.when(seen, F.col(day))).cast("string").alias("last_kept"))


def trailing_months(df: DataFrame, day: str, months: int) -> DataFrame:
    """Rows of the last months before the table's last day."""
    return df.filter(F.col(day) >= df.agg(F.add_months(F.max(day), -months)).scalar())


def compatible(column: Column, allowed: list[str]) -> Column:
    """Whether a value is among the allowed ones or unknown."""
    return column.isNull() | column.isin(*allowed)


def split_variety(df: DataFrame, rules: DataFrame, name: str, stated: str) -> DataFrame:
    """Product and variety where a rule (name, base, embedded) splits the name and the stated variety,
    if any, agrees; else as they are."""
    j = df.join(rules, name, "left")
    fits = F.col("embedded").isNotNull() & (F.col(stated).isNull() | (F.col(stated) == F.col("embedded")))
    return j.withColumn("product", F.when(fits, F.col("base")).otherwise(F.col(name))).withColumn("variety", F.when(fits, F.col("embedded")).otherwise(F.col(stated))).withColumn("was_split", fits).drop("base", "embedded")
