"""Snapshots, deltas and revisions: incremental forms, batch and streaming.

Streaming jobs keep what must last for ever (the first capture of an identity, a keyed table) in tables in
hash buckets and not in operator state; each micro-batch reads the buckets it touches in ``foreachBatch``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from seriesloom.operators.keys import join_on
from seriesloom.streaming.buckets import FirstCaptures, KeyedTable


def identity(source_id: Column, parts: list[str]) -> Column:
    """The source's id, or a fingerprint of ``parts`` where it has none."""
    return F.coalesce(source_id.cast("string"), F.sha2(F.to_json(F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in parts])), 256))


def two_way_duplicates(df: DataFrame, key: list[str], content: list[str], order: list[str]) -> DataFrame:
    """Adds ``state``: first, duplicate (same content as the first) or conflict."""
    w = Window.partitionBy(*key).orderBy(*order)
    same = F.struct(*content) == F.first(F.struct(*content)).over(w)
    return df.withColumn("state", F.when(F.row_number().over(w) == 1, "first").when(same, "duplicate").otherwise("conflict"))


def keyed_upsert(stored: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """The table after the upsert, with ``state``: kept, unchanged, changed or new."""
    content = [c for c in stored.columns if c not in key]
    side = lambda df, name: df.select(*key, F.struct(*[F.col(c).cast(stored.schema[c].dataType).alias(c) for c in content]).alias(name))
    j = join_on(side(stored, "old_"), side(new, "new_"), key, "full")
    state = F.when(F.col("old_").isNull(), "new").when(F.col("new_").isNull(), "kept").when(F.col("old_").eqNullSafe(F.col("new_")), "unchanged").otherwise("changed")
    return j.select(*key, *[F.when(F.col("new_").isNull(), F.col(f"old_.{c}")).otherwise(F.col(f"new_.{c}")).alias(c) for c in content], state.alias("state"))


def revision_ledger(stored: DataFrame, new: DataFrame, key: list[str], value: str) -> DataFrame:
    """Keys whose positive value changed to another positive value, with both."""
    j = join_on(stored.select(*key, F.col(value).alias(f"old_{value}")), new.select(*key, F.col(value).alias(f"new_{value}")), key)
    return j.filter((F.col(f"old_{value}") > 0) & (F.col(f"new_{value}") > 0) & (F.col(f"old_{value}") != F.col(f"new_{value}")))


def merge_current(history: DataFrame, current: DataFrame, key: list[str], value: str) -> DataFrame:
    """Current rows override history by key; a current value that isn't positive removes the key."""
    return join_on(history, current.select(*key), key, "left_anti").unionByName(current.filter(F.col(value) > 0))


def affected_months(history: DataFrame, current: DataFrame, key: list[str], month: str = "month") -> DataFrame:
    """History rows of the series and months that ``current`` touches: what must be aggregated anew."""
    return join_on(history, current.select(*key, month).distinct(), [*key, month], "left_semi")


def propagate_status(rows: DataFrame, header: DataFrame, key: list[str], on: str, flag: str) -> DataFrame:
    """Adds ``flag`` to rows whose header is on, and removes it where it is off."""
    j = join_on(rows, header.select(*key, on), key, "left")
    added, removed = F.array_union("flags", F.array(F.lit(flag))), F.array_remove("flags", flag)
    return j.withColumn("flags", F.when(F.col(on), added).when(~F.col(on), removed).otherwise(F.col("flags"))).drop(on)


class RepeatedContent(ValueError):
    """One identity came with two contents."""


def conflicts(df: DataFrame, key: list[str], content: list[str]) -> DataFrame:
    """Rows and distinct contents of each identity, and whether they stop a load."""
    return df.groupBy(*key).agg(F.count("*").alias("rows"), F.countDistinct(*content).alias("contents")).withColumn("stops", F.col("contents") > 1)


def fail_on_conflict(df: DataFrame, key: list[str], content: list[str]) -> DataFrame:
    """``df``, unless an identity has several contents."""
    if not df.groupBy(*key).agg(F.countDistinct(F.struct(*content)).alias("n")).filter("n > 1").isEmpty():
        raise RepeatedContent(", ".join(key))
    return df


def _stored(spark: SparkSession, path: str, schema) -> DataFrame:
    fs = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = fs.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs)
    return spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)


def accumulated_rows(spark: SparkSession, table: str, schema) -> DataFrame:
    """The rows of a table that :func:`accumulate` has made; ``schema`` is that of its batches."""
    return FirstCaptures(spark, table, [], [], schema).rows()


def accumulate(batch: DataFrame, table: str, key: list[str], content: list[str], order: list[str], batch_id: int, counters: str | None = None, buckets: int = 64) -> None:
    """Add the first captures that ``table`` lacks; count repeats and conflicts.

    Only the key buckets that the batch touches are read (see :class:`FirstCaptures`).  Batches come with rising
    numbers; a committed one that runs again changes nothing.
    """
    FirstCaptures(batch.sparkSession, table, key, content, batch.schema, buckets).add(batch, order, batch_id, counters)


def accumulate_stream(stream: DataFrame, table: str, checkpoint: str, key: list[str], content: list[str], order: list[str], counters: str | None = None, buckets: int = 64) -> StreamingQuery:
    """Structured Streaming form of :func:`accumulate`; late rows are taken whenever they come."""
    def each(batch: DataFrame, batch_id: int) -> None:
        accumulate(batch, table, key, content, order, batch_id, counters, buckets)

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def upsert_stream(stream: DataFrame, table: KeyedTable, checkpoint: str) -> StreamingQuery:
    """Every micro-batch, one row a key, is upserted into ``table``; its revisions go to the ledger."""
    return stream.writeStream.foreachBatch(table.upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def replace_days(delta: DataFrame, table: str, day: str, capture: str) -> None:
    """Replace whole days by dynamic partition overwrite; a day has one capture, and one that
    is older than the stored one is rejected.

    A capture equal to the stored one is taken again, so that a delta whose write died can be repeated; it must
    be the same rows.  While days are exchanged readers may see some old and some new ones: where that matters, write below a
    :class:`~seriesloom.sources.tables.Publication`.
    """
    spark = delta.sparkSession
    days = delta.groupBy(day).agg(F.countDistinct(capture).alias("captures"), F.max(capture).alias("new"))
    if not days.filter("captures > 1").isEmpty():
        raise RepeatedContent(f"several captures of one {day}")
    stored = _stored(spark, table, delta.schema)
    old = stored.groupBy(day).agg(F.max(capture).alias("old"))
    if not days.join(old, day).filter("new < old").isEmpty():
        raise RepeatedContent(f"an older capture of a stored {day}")
    delta.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(table)


def windowed_counts(stream: DataFrame, time: str, key: list[str], width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts by event-time window with a watermark, for live views beside the table."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width), *key).agg(F.count("*").alias("n"))
