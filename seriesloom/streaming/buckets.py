"""Keyed tables in hash buckets: a batch reads and writes only the buckets that its keys fall into.

Below a root: ``data/<commit>/bucket_=<k>`` holds the rows of the buckets that one commit wrote, ``log/batch=<id>``
what a batch appends, and ``commits`` numbered versions that say which commit each bucket is to be read
from and which batch was the last.  A bucket is written anew as a whole when a batch touches it; other buckets'
files stay.  Batches come with rising numbers (as in ``foreachBatch``); one that was committed changes nothing
when it runs again, and what a batch wrote before it died is never read.

Null keys are keys of their own.  Give so many buckets that one of them fits a task; a batch whose keys are spread
over all buckets reads all of the table, so a table that takes small batches wants more of them.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesloom.operators.keys import join_on
from seriesloom.sources.tables import StaleWriter, Versions, written


def as_schema(spark: SparkSession, schema) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else spark.createDataFrame([], schema).schema


class BucketStore:
    """Rows by key in ``buckets`` hash buckets."""

    def __init__(self, spark: SparkSession, root: str, key: list[str], schema, buckets: int = 64):
        self.spark, self.root, self.key = spark, root, key
        self.schema = as_schema(spark, schema)
        self.versions = Versions(spark, f"{root}/commits")
        self.buckets = (self._state() or {"buckets": buckets})["buckets"]

    def _state(self) -> dict | None:
        text = self.versions.latest()[1]
        return json.loads(text) if text else None

    def batch(self) -> int:
        """The last committed batch; -1 before any."""
        return (self._state() or {"batch": -1})["batch"]

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def touched(self, batch: DataFrame) -> list[int]:
        """The buckets of a batch's keys; at most the number of buckets pass through the driver."""
        return sorted(r.b for r in batch.select(self.bucket().alias("b")).distinct().collect())

    def read(self, only: list[int] | None = None) -> DataFrame:
        """The rows of all buckets, or of some; other buckets' files aren't opened or listed."""
        parts = (self._state() or {"parts": {}})["parts"]
        paths = [f"{self.root}/data/{commit}/bucket_={k}" for k, commit in parts.items() if only is None or int(k) in set(only)]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def commit(self, batch_id: int, rows: DataFrame, touched: list[int]) -> None:
        """Make ``rows`` what the ``touched`` buckets hold, as of batch ``batch_id``."""
        number, text = self.versions.latest()
        state = json.loads(text) if text else {"batch": -1, "buckets": self.buckets, "parts": {}}
        if state["batch"] >= batch_id:
            raise StaleWriter(f"batch {batch_id} came after {state['batch']}")
        name = uuid.uuid4().hex
        rows.select(*self.schema.names).withColumn("bucket_", self.bucket()).repartition("bucket_").write.partitionBy("bucket_").parquet(f"{self.root}/data/{name}")
        path, files = self._path(f"data/{name}")
        have = {x.getPath().getName() for x in files.listStatus(path)}
        for k in touched:
            state["parts"].pop(str(k), None)
            if f"bucket_={k}" in have:
                state["parts"][str(k)] = name
        state["batch"] = batch_id
        if not self.versions.claim(number + 1, json.dumps(state)):
            raise StaleWriter(f"another writer committed after {number}")

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def append(self, batch_id: int, rows: DataFrame) -> None:
        """What a batch adds to the log; seen once the batch is committed, written over if it runs again before."""
        rows.write.mode("overwrite").parquet(f"{self.root}/log/batch={batch_id}")

    def log(self, schema) -> DataFrame:
        """The log of all committed batches."""
        path, files = self._path("log")
        kind = T.StructType([*as_schema(self.spark, schema).fields, T.StructField("batch", T.LongType())])
        stored = self.spark.read.schema(kind).parquet(f"{self.root}/log") if files.exists(path) else self.spark.createDataFrame([], kind)
        return stored.filter(F.col("batch") <= self.batch())

    def discard_old(self) -> int:
        """Delete what no bucket is read from any more; not while others read older versions.  Returns the number of folders."""
        keep, n = set((self._state() or {"parts": {}})["parts"].values()), 0
        path, files = self._path("data")
        for x in files.listStatus(path) if files.exists(path) else []:
            if x.getPath().getName() not in keep:
                n += bool(files.delete(x.getPath(), True))
        return n


class RepeatedKey(ValueError):
    """A batch has two rows of one key."""


def _digest(columns: list[str]) -> Column:
    """Equal contents have equal digests; a null differs from every value."""
    return F.sha2(F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in columns])), 256)


class FirstCaptures:
    """The first capture of every identity.

    Rows are appended by batch; a store of (identity, digest of the content) in buckets tells a batch which
    of its identities are known, so a batch opens the key buckets that it touches and no stored row.
    """

    def __init__(self, spark: SparkSession, root: str, key: list[str], content: list[str], schema, buckets: int = 64):
        self.spark, self.root, self.key, self.content = spark, root, key, content
        self.schema = as_schema(spark, schema)
        kinds = [f for f in self.schema.fields if f.name in key]
        self.index = BucketStore(spark, f"{root}/index", key, T.StructType([*kinds, T.StructField("known_", T.StringType())]), buckets)

    def rows(self) -> DataFrame:
        return self.index.log(self.schema).drop("batch")

    def add(self, batch: DataFrame, order: list[str], batch_id: int, counters: str | None = None) -> None:
        """Add the identities that aren't stored, each with its first row by ``order`` (ties by all other columns);
        count first, repeated and conflicting rows.  Rows are counted by identity and content before anything
        else, so an identity with very many rows is one row a content."""
        if self.index.batch() >= batch_id:
            return
        key, names = self.key, batch.columns
        by = [*order, *[c for c in names if c not in order]]
        tagged = batch.withColumn("content_", _digest(self.content))
        each = written(tagged.groupBy(*key, "content_").agg(F.count("*").alias("n_"), F.min(F.struct(*by, "content_")).alias("row_")))
        touched = self.index.touched(each)
        known = self.index.read(touched)
        heads = written(join_on(each.groupBy(*key).agg(F.min("row_").alias("head_")), known, key, "left"))
        if counters:
            j = join_on(each, heads.select(*key, F.coalesce("known_", "head_.content_").alias("against_"), F.col("known_").isNull().alias("new_")), key)
            equal = F.col("content_") == F.col("against_")
            first = F.when(equal & F.col("new_"), 1).otherwise(0)
            parts = {"first": first, "duplicate": F.when(equal, F.col("n_") - first).otherwise(0), "conflict": F.when(equal, 0).otherwise(F.col("n_"))}
            sums = j.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(n) for n, c in parts.items()]).unpivot([], list(parts), "state", "n").filter("n > 0")
            sums.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{counters}/batch={batch_id}")
        fresh = heads.filter("known_ IS NULL")
        self.index.append(batch_id, fresh.select(*[F.col(f"head_.{c}").alias(c) for c in names]))
        self.index.commit(batch_id, known.unionByName(fresh.select(*key, F.col("head_.content_").alias("known_"))), touched)


class KeyedTable:
    """A table that takes upserts by key, with a ledger of its revisions.

    A batch rewrites the buckets that it touches.  The ledger gets, once a batch, the keys whose positive ``value``
    changed to another positive one, with both.
    """

    def __init__(self, spark: SparkSession, root: str, key: list[str], schema, value: str | None = None, buckets: int = 64):
        self.store, self.key, self.value = BucketStore(spark, root, key, schema, buckets), key, value

    def rows(self) -> DataFrame:
        return self.store.read()

    def upsert(self, batch: DataFrame, batch_id: int) -> None:
        """One row a key; a key that comes twice stops the batch."""
        from seriesloom.streaming.incremental import keyed_upsert, revision_ledger

        if self.store.batch() >= batch_id:
            return
        batch = written(batch.select(*self.store.schema.names))
        if not batch.groupBy(*self.key).count().filter("count > 1").isEmpty():
            raise RepeatedKey(", ".join(self.key))
        touched = self.store.touched(batch)
        stored = self.store.read(touched)
        if self.value:
            self.store.append(batch_id, revision_ledger(stored, batch, self.key, self.value))
        self.store.commit(batch_id, keyed_upsert(stored, batch, self.key).drop("state"), touched)

    def ledger(self) -> DataFrame:
        kinds = {f.name: f for f in self.store.schema.fields}
        of = kinds[self.value].dataType
        return self.store.log(T.StructType([*[kinds[k] for k in self.key], T.StructField(f"old_{self.value}", of), T.StructField(f"new_{self.value}", of)]))
