"""Number text to numbers: six reading modes that differ on purpose, and style inference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: mode: (with both marks, the comma is always decimal; rule for a lone comma; for a lone dot)
#: "short": decimal with at most two digits behind it; "not3": decimal unless three digits follow;
#: "decimal": always; "groups": thousands if repeated (comma) or in groups of three (dot).
MODES = {
    "last_or_short": (False, "short", "short"),
    "last_or_not3": (False, "not3", "not3"),
    "comma_or_lone": (True, "decimal", "decimal"),
    "last_or_dot": (False, "short", "decimal"),
    "comma_or_groups": (True, "groups", "groups"),
}
STRICT = {"ar": r"^-?(\d{1,3}(\.\d{3})+|\d+)(,\d+)?$", "us": r"^-?(\d{1,3}(,\d{3})+|\d+)(\.\d+)?$"}


def bare(text: Column) -> Column:
    """Digits, marks and sign only."""
    return F.regexp_replace(text, r"[^0-9.,\-]", "")


def _read(t: Column, mark: str) -> Column:
    other = "." if mark == "," else ","
    return F.replace(F.replace(t, F.lit(other), F.lit("")), F.lit(mark), F.lit(".")).try_cast("double")


def _parts(t: Column) -> dict[str, Column]:
    """What the modes ask about digits, marks and sign, and the three ways to read them."""
    return {
        "comma": t.contains(","), "dot": t.contains("."), "tail": F.length(F.regexp_extract(t, r"[.,]([0-9]*)$", 1)), "comma_last": t.rlike(r",[^.,]*$"),
        "commas": F.length(t) - F.length(F.replace(t, F.lit(","), F.lit(""))), "dot_groups": t.rlike(r"^-?\d{1,3}(\.\d{3})+$"),
        "by_comma": _read(t, ","), "by_dot": _read(t, "."), "whole": F.replace(F.replace(t, F.lit("."), F.lit("")), F.lit(","), F.lit("")).try_cast("double"),
    }


def _by_mode(p: dict[str, Column], mode: str) -> Column:
    comma_always, comma_rule, dot_rule = MODES[mode]
    rule = {"short": p["tail"] <= 2, "not3": p["tail"] != 3, "decimal": F.lit(True)}
    comma_decimal = p["commas"] <= 1 if comma_rule == "groups" else rule[comma_rule]
    dot_decimal = ~p["dot_groups"] if dot_rule == "groups" else rule[dot_rule]
    comma_last = F.lit(True) if comma_always else p["comma_last"]
    return (
        F.when(p["comma"] & p["dot"], F.when(comma_last, p["by_comma"]).otherwise(p["by_dot"]))
        .when(p["comma"], F.when(comma_decimal, p["by_comma"]).otherwise(p["whole"]))
        .when(p["dot"], F.when(dot_decimal, p["by_dot"]).otherwise(p["whole"]))
        .otherwise(p["whole"])
    )


def parse_number(text: Column, mode: str) -> Column:
    """Number in ``text`` by a lenient mode, or by ``strict_ar``/``strict_us``; null if unreadable."""
    if mode.startswith("strict_"):
        style = mode[7:]
        t = F.trim(text)
        return F.when(t.rlike(STRICT[style]), _read(t, "," if style == "ar" else "."))
    return _by_mode(_parts(bare(text)), mode)


def parse_numbers(df: DataFrame, text: str, modes: list[str]) -> DataFrame:
    """Adds a column for each lenient mode; texts are cleaned and taken apart once for all of them."""
    kept = df.columns
    once = df.withColumn("bare_", bare(F.col(text)))
    once = once.select(*kept, *[c.alias(f"{name}_") for name, c in _parts(F.col("bare_")).items()])
    parts = {name: F.col(f"{name}_") for name in _parts(F.lit(""))}
    return once.select(*kept, *[_by_mode(parts, mode).alias(mode) for mode in modes])


def table_style(df: DataFrame, table: str, text: str) -> DataFrame:
    """(table, style): ``ar`` or ``us`` if every text fits that style and not every text fits both;
    ``ambiguous`` if all fit both, ``inconsistent`` if none fits all."""
    ar, us = (F.bool_and(F.col(text).rlike(STRICT[s])) for s in ("ar", "us"))
    return df.filter(F.col(text).isNotNull()).groupBy(table).agg(F.when(ar & us, "ambiguous").when(ar, "ar").when(us, "us").otherwise("inconsistent").alias("style"))
