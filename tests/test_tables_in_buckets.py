"""Bucketed tables, versions and publications: retries, crashes, null keys, and what a batch reads and writes."""

import os

import pytest
from pyspark.sql import functions as F

from seriesloom.operators import quality
from seriesloom.sources import tables
from seriesloom.streaming import incremental
from seriesloom.streaming.buckets import BucketStore, FirstCaptures, KeyedTable, RepeatedKey


def files(folder):
    return {os.path.join(d, n): os.stat(os.path.join(d, n)).st_mtime_ns for d, _, names in os.walk(folder) for n in names if n.startswith("part-")}


def test_a_batch_reads_and_writes_the_buckets_that_it_touches(spark, tmp_path):
    schema = "k string, v long"
    first = spark.range(4000).selectExpr("cast(id AS string) AS k", "id AS v")
    out = FirstCaptures(spark, str(tmp_path / "t"), ["k"], ["v"], schema, buckets=32)
    out.add(first, ["v"], 0)
    before = files(str(tmp_path / "t/index/data"))
    few = spark.createDataFrame([("7", 99), ("new", 1)], schema)
    touched = out.index.touched(few)
    assert 1 <= len(touched) <= 2
    read = out.index.read(touched).inputFiles()
    assert {int(f.split("bucket_=")[1].split("/")[0]) for f in read} == set(touched)
    size = lambda names: sum(os.path.getsize(f.removeprefix("file://")) for f in names)
    assert 8 * size(read) < size(out.index.read().inputFiles())
    out.add(few, ["v"], 1, str(tmp_path / "n"))
    after = files(str(tmp_path / "t/index/data"))
    assert {f: t for f, t in after.items() if f in before} == before  # untouched buckets aren't rewritten
    assert {int(f.split("bucket_=")[1].split("/")[0]) for f in after if f not in before} == set(touched)
    assert out.rows().count() == 4001 and {(r.state, r.n) for r in spark.read.parquet(str(tmp_path / "n")).collect()} == {("first", 1), ("conflict", 1)}
    out.add(few.withColumn("k", F.lit("other")), ["v"], 1)  # the same batch again
    assert out.rows().count() == 4001 and files(str(tmp_path / "t/index/data")) == after
    assert out.index.discard_old() == 0 and out.index.read().count() == 4001


def test_a_batch_that_died_before_its_commit_is_not_read(spark, tmp_path, monkeypatch):
    schema = "k string, l string, v long, at long"
    out = FirstCaptures(spark, str(tmp_path / "t"), ["k", "l"], ["v"], schema, buckets=4)
    out.add(spark.createDataFrame([("a", None, 1, 1), (None, None, 2, 1), (None, None, 2, 2), (None, "x", 3, 1)], schema), ["at"], 0)
    second = spark.createDataFrame([(None, None, 2, 5), (None, None, 9, 5), ("a", None, 1, 5), ("b", None, 4, 7), ("b", None, 5, 6)], schema)
    with monkeypatch.context() as m:
        m.setattr(tables.Versions, "claim", lambda *a: (_ for _ in ()).throw(RuntimeError("the machine is gone")))
        with pytest.raises(RuntimeError):
            out.add(second, ["at"], 1)
    rows = lambda: sorted((tuple(r) for r in FirstCaptures(spark, str(tmp_path / "t"), ["k", "l"], ["v"], schema).rows().collect()), key=str)
    first = sorted([("a", None, 1, 1), (None, None, 2, 1), (None, "x", 3, 1)], key=str)
    assert rows() == first
    out.add(second, ["at"], 1, str(tmp_path / "n"))
    assert rows() == sorted([*first, ("b", None, 5, 6)], key=str)
    assert {(r.state, r.n) for r in spark.read.parquet(str(tmp_path / "n")).collect()} == {("first", 1), ("duplicate", 2), ("conflict", 2)}


def test_upserts_and_the_ledger(spark, tmp_path):
    schema = "k string, v double, t string"
    t = KeyedTable(spark, str(tmp_path / "t"), ["k"], schema, "v", buckets=16)
    t.upsert(spark.createDataFrame([(str(i), float(i), None) for i in range(200)] + [(None, 5.0, "x")], schema), 0)
    before = files(str(tmp_path / "t/data"))
    batch = spark.createDataFrame([("3", 4.0, "y"), ("0", 1.0, None), (None, 6.0, "x"), ("new", 1.0, None), ("7", 7.0, None)], schema)
    for _ in (1, 2):  # a retried batch changes nothing
        t.upsert(batch, 1)
    kept = {f for f in files(str(tmp_path / "t/data")) if f in before}
    assert kept == set(before) and len(files(str(tmp_path / "t/data"))) - len(before) <= 5
    now = {r.k: (r.v, r.t) for r in t.rows().collect()}
    assert len(now) == 202 and (now["3"], now["0"], now[None], now["new"], now["7"], now["8"]) == ((4.0, "y"), (1.0, None), (6.0, "x"), (1.0, None), (7.0, None), (8.0, None))
    assert sorted(((r.k, r.old_v, r.new_v, r.batch) for r in t.ledger().collect()), key=str) == sorted([("3", 3.0, 4.0, 1), (None, 5.0, 6.0, 1)], key=str)
    with pytest.raises(RepeatedKey):
        t.upsert(spark.createDataFrame([("a", 1.0, None), ("a", 2.0, None)], schema), 2)
    assert t.store.discard_old() == 0 and t.rows().count() == 202
    t.upsert(spark.createDataFrame([(str(i), 1.0, None) for i in range(200)] + [(None, 1.0, None), ("new", 2.0, None)], schema), 3)
    assert t.store.discard_old() >= 1 and t.rows().count() == 202
    src = str(tmp_path / "src")
    spark.createDataFrame([("8", 80.0, None)], schema).write.parquet(src)
    stream = KeyedTable(spark, str(tmp_path / "s"), ["k"], schema, "v", buckets=4)
    for _ in (1, 2):
        incremental.upsert_stream(spark.readStream.schema(schema).parquet(src), stream, str(tmp_path / "ck")).awaitTermination(60)
    assert [tuple(r) for r in stream.rows().collect()] == [("8", 80.0, None)] and stream.ledger().count() == 0


def test_two_writers_of_one_store(spark, tmp_path):
    a, b = (BucketStore(spark, str(tmp_path / "t"), ["k"], "k int", 2) for _ in range(2))
    rows = spark.createDataFrame([(1,), (2,)], "k int")
    a.commit(0, rows, [0, 1])
    with pytest.raises(tables.StaleWriter):
        b.commit(0, rows, [0, 1])
    assert sorted(r.k for r in b.read().collect()) == [1, 2] and b.batch() == 0


@pytest.mark.parametrize("dies_at", ["create", "write", "rename"])
def test_a_publication_outlives_its_writer(spark, tmp_path, monkeypatch, dies_at):
    p = tables.Publication(spark, str(tmp_path / "out"))
    check = lambda _, df: quality.gates(df, {})
    one = lambda v: {"t": spark.createDataFrame([(v,)], "v int")}
    with pytest.raises(LookupError):
        p.read("t")
    assert p.publish(one(1), check) == 1
    versions = tmp_path / "out" / "versions"
    if dies_at == "rename":  # the draft is whole
        (versions / ".draft-dead").write_text("tables-dead")
    else:  # an older writer's empty version, or half a draft
        (versions / ("v2" if dies_at == "create" else ".draft-dead")).write_text("")
    assert p.version() == 1 and [r.v for r in p.read("t").collect()] == [1]
    assert p.publish(one(2), check, built_on=1) == 2 and [r.v for r in p.read("t").collect()] == [2]
    assert not p.versions.claim(2, "tables-other") and [r.v for r in p.read("t").collect()] == [2]
    assert [x for x in os.listdir(versions) if x.startswith(".draft-") and x != ".draft-dead"] == []


def test_a_hot_part_is_written_in_even_files(spark, tmp_path):
    df = spark.range(12_000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 500 = 1 THEN NULL ELSE concat('p', id % 40) END AS part", "id AS v", "date_add(DATE'2024-01-01', cast(id % 90 AS int)) AS day")
    out = str(tmp_path / "facts")
    index = tables.publish_partitioned(df, out, ["part"], "day", max_rows=500)
    want = {r.part: (r.n, r.a, r.b) for r in df.groupBy("part").agg(F.count("*").alias("n"), F.min("day").alias("a"), F.max("day").alias("b")).collect()}
    assert {r.part: (r.rows, r.first_day, r.last_day) for r in index.collect()} == want
    back = spark.read.parquet(out)
    assert {r.part: r.n for r in back.groupBy("part").agg(F.count("*").alias("n")).collect()} == {k: v[0] for k, v in want.items()}
    sizes = [r.n for r in back.filter("part = 'hot'").groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 4000 and 8 <= len(sizes) <= 16 and max(sizes) <= 500
    assert back.filter("part = 'p1'").select(F.input_file_name()).distinct().count() == 1


def test_only_the_last_table_of_a_step_stays(spark):
    outer = tables.written(spark.range(2))
    with tables.last_table_only(spark):
        first = tables.written(spark.range(3))
        with tables.last_table_only(spark):
            tables.written(spark.range(4))
            inner = tables.written(first.unionByName(spark.range(5)))
        last = tables.written(inner.filter("id > 1"))
    gone = [x for df in (first, inner) for x in df.inputFiles()]
    assert last.count() == 4 and outer.count() == 2 and gone and not any(os.path.exists(x.removeprefix("file://")) for x in gone)
    with tables.last_table_only(spark):
        pass
    assert last.count() == 4
