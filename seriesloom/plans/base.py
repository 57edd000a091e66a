"""Stand-in tables for the queries: price observations from line items, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.functions.dates import month_index, month_key

QUERIES: dict = {}
SQL: dict = {}
SERIES = ["product", "currency", "condition"]


def query(name: str, sql: str | None = None, dates: tuple[str, ...] = ()):
    """Registers a query and its SQL; columns named in ``dates`` leave as ISO text on both sides."""

    def register(f):
        def run(spark: SparkSession, d: str) -> DataFrame:
            return f(spark, d).withColumns({c: F.col(c).cast("string") for c in dates}) if dates else f(spark, d)

        QUERIES[name] = run
        if sql:
            SQL[name] = f"SELECT * REPLACE ({', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in dates)}) FROM ({sql})" if dates else sql
        return f

    return register


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def observations(spark: SparkSession, d: str) -> DataFrame:
    """Price observations: unit prices in whole cents, volumes in whole units; some without a variety or a condition."""
    li, part = table(spark, d, "lineitem"), table(spark, d, "part")
    o = li.join(part, li.l_partkey == part.p_partkey)
    day = F.to_date("l_shipdate")
    return o.select(
        F.col("l_orderkey").alias("event_id"), F.col("l_linenumber").alias("line"), day.alias("day"), month_key(day).alias("month"), month_index(day).alias("month_idx"), F.year(day).alias("year"),
        F.col("p_brand").alias("product"), F.nullif(F.col("p_type"), F.lit("PROMO")).alias("variety"), F.col("l_returnflag").alias("currency"), F.when(F.col("l_linenumber") < 7, F.col("l_linestatus")).alias("condition"), F.concat(F.lit("M"), (F.col("l_suppkey") % 4).cast("string")).alias("market"),
        F.round(F.col("l_extendedprice") * 100 / F.col("l_quantity")).cast("bigint").alias("price_c"), F.col("l_quantity").cast("bigint").alias("volume"), F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("total_c"),
    )


#: The same in SQL, as the common table expression ``obs``.
OBS = """obs AS (SELECT l_orderkey AS event_id, l_linenumber AS line, CAST(l_shipdate AS DATE) AS day, strftime(l_shipdate, '%Y-%m') AS month,
 CAST(year(l_shipdate) * 12 + month(l_shipdate) - 1 AS INTEGER) AS month_idx, CAST(year(l_shipdate) AS INTEGER) AS year, p_brand AS product, nullif(p_type, 'PROMO') AS variety,
 l_returnflag AS currency, CASE WHEN l_linenumber < 7 THEN l_linestatus END AS condition, 'M' || CAST(l_suppkey % 4 AS VARCHAR) AS market,
 CAST(round(l_extendedprice * 100 / l_quantity) AS BIGINT) AS price_c, CAST(l_quantity AS BIGINT) AS volume, CAST(round(l_extendedprice * 100) AS BIGINT) AS total_c
 FROM lineitem JOIN part ON l_partkey = p_partkey)"""
#: Monthly series statistics on top of ``obs``.
MONTHLY = OBS + """, monthly AS (SELECT product, currency, condition, month, month_idx, count(*) AS n, CAST(sum(price_c) AS DOUBLE) / count(*) AS mean, median(CAST(price_c AS DOUBLE)) AS median,
 min(price_c) AS low, max(price_c) AS high, count(DISTINCT day) AS days FROM obs GROUP BY ALL)"""


def settled(value):
    """For comparing a mean of means with another engine's, not for results that a user reads: three
    decimals, cut where sums taken in another order can't tip them."""
    return F.floor(value * 1000 + 0.2718) / 1000
