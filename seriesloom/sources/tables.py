"""Readers and writers: text and JSON tables with lineage, alias headers, layers and publication."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesloom.functions.text import fold


_made: list[str] = []
#: Parts of a publication up to which their counts are broadcast.
FEW_PARTS = 100_000


def shared_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which all machines must share.

    Only where that is unset and everything runs on this machine, a folder of our own.
    """
    top = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not top:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"spark.checkpoint.dir is unset and the master is {master}: name a folder that all machines share")
        top = tempfile.mkdtemp(prefix="seriesloom-")
        spark.conf.set("spark.checkpoint.dir", top)
        spark.sparkContext.setCheckpointDir(top)
    _made.append(f"{top}/{uuid.uuid4().hex}")
    return _made[-1]


def written(df: DataFrame, rows: int = 0) -> DataFrame:
    """``df`` as a Parquet table in the shared folder; lineage ends there.

    With ``rows``, a file has no more of them.  Spark packs a file into a task as its size and the cost of opening it, so
    a task then reads a bounded number of rows (32 files by its defaults), however well they compress.
    """
    folder = shared_folder(df.sparkSession)
    write = df.write.mode("overwrite")
    (write.option("maxRecordsPerFile", rows) if rows else write).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _delete(spark: SparkSession, folders: list[str]) -> int:
    files, n = spark._jvm.org.apache.hadoop.fs, 0
    for folder in folders:
        path = files.Path(folder)
        n += bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))
    return n


def discard_intermediates(spark: SparkSession) -> int:
    """Delete the folders that this process has made so far; results that read them must have been
    written elsewhere.  Returns their number."""
    folders = _made[:]
    _made.clear()
    return _delete(spark, folders)


@contextmanager
def last_table_only(spark: SparkSession):
    """Of the tables written inside, only the last one stays: for steps whose result is their last
    written table, or reads no other."""
    before = set(_made)
    yield
    inside = [x for x in _made if x not in before]
    _made[:] = [x for x in _made if x not in inside[:-1]]
    _delete(spark, inside[:-1])


def read_delimited(spark: SparkSession, path: str, columns: list[str], sep: str = ",", encoding: str = "UTF-8", header: bool = True) -> DataFrame:
    """All columns as text, with quoted line ends; the schema is declared, never inferred."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.schema(schema).csv(path, sep=sep, encoding=encoding, header=header, multiLine=True, quote='"', escape='"')


def read_envelopes(spark: SparkSession, path: str, record: str, keys: tuple[str, ...] = ("data", "results", "records", "items")) -> DataFrame:
    """Records of JSON documents that hold them under one of ``keys``; ``record`` is their DDL."""
    schema = ", ".join(f"{k} array<struct<{record}>>" for k in keys)
    df = spark.read.schema(schema).json(path, multiLine=True)
    return df.select(F.inline(F.coalesce(*keys)))


def with_lineage(df: DataFrame) -> DataFrame:
    """Adds the file that each row was read from."""
    return df.withColumn("source_file", F.col("_metadata.file_path")).withColumn("source_block", F.col("_metadata.file_block_start"))


def with_manifest(df: DataFrame, manifest: DataFrame, file: str = "source_file") -> DataFrame:
    """Rows with what the manifest says of their file; files that it doesn't name keep nulls."""
    return df.join(manifest.dropDuplicates([file]), file, "left")


class EmptyLayer(ValueError):
    """A layer table without rows."""


def write_layer(df: DataFrame, root: str, layer: str, name: str) -> None:
    """Write a table of a layer as JSON lines, unless it is empty; the stored one stays then."""
    df = written(df)
    if df.isEmpty():
        raise EmptyLayer(f"{layer}/{name}")
    df.write.mode("overwrite").option("ignoreNullFields", False).json(f"{root}/{layer}/{name}")


def read_layer(spark: SparkSession, root: str, layer: str, name: str, schema: str) -> DataFrame:
    """A table of a layer; ``schema`` is its DDL."""
    return spark.read.schema(schema).json(f"{root}/{layer}/{name}")


def map_headers(df: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    """Columns under their standard names: an equal normalised header first, then a contained one."""
    plain = lambda x: "".join(c for c in x.lower().translate(str.maketrans("áéíóúñü", "aeiounu")) if c.isalnum())
    left, found = {plain(c): c for c in df.columns}, {}
    for exact in (True, False):
        for name, others in aliases.items():
            if name not in found:
                hit = next((k for a in [name, *others] for k in left if (plain(a) == k if exact else plain(a) in k)), None)
                if hit:
                    found[name] = left.pop(hit)
    return df.select(*[F.col(f"`{found[n]}`").alias(n) if n in found else F.lit(None).cast("string").alias(n) for n in aliases])


def months_to_rows(df: DataFrame, ids: list[str], months: list[str], name: str = "mes", value: str = "precio") -> DataFrame:
    """Wide month columns to one row a month; missing and non-positive cells go."""
    return df.unpivot(ids, months, name, value).filter(F.col(value) > 0)


def carry_header(df: DataFrame, partition: list[str], order: str, header: str, parts: int | None = None) -> DataFrame:
    """Rows below a header row get its value: the last one above them in the same file.

    A file may be of any length: it is scanned in segments.
    """
    from seriesloom.operators.scan import carried

    return carried(df, partition, [order], [header], parts)


def partition_index(df: DataFrame, keys: list[str], day: str) -> DataFrame:
    """One row per part: rows, first and last day."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows"), F.min(day).alias("first_day"), F.max(day).alias("last_day"))


def publish_partitioned(df: DataFrame, path: str, keys: list[str], day: str, max_rows: int = 5_000_000) -> DataFrame:
    """Write by part in files of up to ``max_rows`` rows, and return the index of what was written.

    Rows are counted by part first: a part of more rows is dealt over as many tasks as it needs files,
    in even shares, and small parts share tasks.  The counts, one row a part, are joined with the rows by a
    broadcast while they are few.  The index is made of the same counts and agrees with the files, as both come from one
    written table.
    """
    from seriesloom.operators.keys import join_on

    stored = written(df)
    index = written(partition_index(stored, keys, day))
    plan = index.select(*keys, F.ceil(F.col("rows") / max_rows).alias("files_"))
    most = index.agg(F.sum(F.ceil(F.col("rows") / max_rows)).alias("n"), F.sum("rows").alias("rows")).first()
    tasks = max(1, min(int(most.n or 1), -(-int(most.rows or 0) // max_rows) + 200))
    share = F.pmod(F.xxhash64(*stored.columns), F.col("files_"))
    dealt = join_on(stored, F.broadcast(plan) if index.count() <= FEW_PARTS else plan, keys).withColumn("share_", share)
    # a share of a part is one value of the dealing key, so no task gets two shares of a hot part unless by chance
    dealt.repartition(tasks, *keys, "share_").drop("share_", "files_").write.mode("overwrite").option("maxRecordsPerFile", max_rows).partitionBy(*keys).parquet(path)
    return index


def split_dimensions(df: DataFrame, dims: list[str], key: str) -> tuple[DataFrame, DataFrame]:
    """(facts with a short series key, dimension table)."""
    digest = F.substring(F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in dims]), 256), 1, 16)
    facts = df.withColumn(key, digest)
    return facts.drop(*dims), facts.select(key, *dims).dropDuplicates([key])


def expand_dimensions(facts: DataFrame, dimensions: DataFrame, key: str) -> DataFrame:
    """Facts with their dimensions; facts without any are an error."""
    if not facts.join(dimensions, key, "left_anti").isEmpty():
        raise ValueError("facts without a dimension row")
    return facts.join(dimensions, key)


class StaleWriter(ValueError):
    """The published version is not the one that the candidate was built on."""


class Versions:
    """Numbered versions in a folder: small texts that are whole or absent.

    A version's text is written under a name of its own first, then renamed to its number without
    overwriting.  A writer that dies before the rename leaves nothing that readers see, and of two writers of
    one number one is refused, where the file system renames so (HDFS and alike; local disks
    test before they rename).  Readers step over versions without a text, which older writers may have left.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _files(self, name: str = ""):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _text(self, name: str) -> str:
        path, files = self._files(name)
        if not files.getFileStatus(path).getLen():
            return ""
        return "\n".join(r.value for r in self.spark.read.text(f"{self.folder}/{name}", wholetext=True).collect())

    def latest(self) -> tuple[int, str | None]:
        """The highest number with a text, and the text; (0, None) without any."""
        path, files = self._files()
        names = [x.getPath().getName() for x in files.listStatus(path)] if files.exists(path) else []
        for n in sorted((int(n[1:]) for n in names if n[0] == "v" and n[1:].isdigit()), reverse=True):
            text = self._text(f"v{n}")
            if text:
                return n, text
        return 0, None

    def claim(self, number: int, text: str) -> bool:
        """Make ``text`` the version ``number``; False if it has one."""
        path, files = self._files(f"v{number}")
        if files.exists(path):
            if files.getFileStatus(path).getLen():
                return False
            files.delete(path, False)
        draft, _ = self._files(f".draft-{uuid.uuid4().hex}")
        out = files.create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        jvm = self.spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(files.makeQualified(draft), files.makeQualified(path), options)
        except Exception:
            if not files.exists(draft) or not files.exists(path):
                raise
            files.delete(draft, False)
            return False
        return True


class Publication:
    """Versioned tables behind a pointer: a candidate that fails its gates leaves the last one in place.

    Every candidate is written to a folder of its own; a version holds that folder's name.  Of two
    writers that publish at once one gets the version, and the other one is refused with nothing of the first
    touched.  A writer that dies on the way leaves the last version published.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.versions = Versions(spark, f"{root}/versions")

    def version(self) -> int:
        return self.versions.latest()[0]

    def read(self, name: str) -> DataFrame:
        folder = self.versions.latest()[1]
        if folder is None:
            raise LookupError(f"nothing is published in {self.root}")
        return self.spark.read.parquet(f"{self.root}/{folder}/{name}")

    def publish(self, tables: dict[str, DataFrame], check, built_on: int | None = None) -> int:
        """Write all tables, run ``check(name, table)`` on what was written, then claim the next version."""
        now = self.version()
        if built_on is not None and built_on != now:
            raise StaleWriter(f"built on {built_on}, published is {now}")
        folder = f"tables-{uuid.uuid4().hex}"
        for name, df in tables.items():
            df.write.parquet(f"{self.root}/{folder}/{name}")
        for name in tables:
            check(name, self.spark.read.parquet(f"{self.root}/{folder}/{name}"))
        if not self.versions.claim(now + 1, folder):
            raise StaleWriter(f"version {now + 1} was published meanwhile")
        return now + 1


def search_column(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumn("search", fold(F.concat_ws(" ", *columns)))
