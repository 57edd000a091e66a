"""Comparison of a Spark result with a DuckDB result as sets of rows."""

import math

import pandas as pd


def _cell(x):
    if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and math.isnan(x)):
        return "null"
    if isinstance(x, bool) or type(x).__name__ == "bool":
        return str(bool(x))
    try:
        return repr(round(float(x), 6)) if not isinstance(x, str) else x
    except (TypeError, ValueError):
        return str(x)


def rows(df):
    df = df[sorted(df.columns)]
    return sorted(tuple(map(_cell, r)) for r in df.astype(object).itertuples(index=False))


def same(spark_df, duck_df):
    a, b = spark_df.toPandas(), duck_df
    assert sorted(a.columns) == sorted(b.columns)
    assert rows(a) == rows(b)
