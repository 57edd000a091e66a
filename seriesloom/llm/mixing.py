"""Mixing sources to target weights by a low-discrepancy schedule.

Method: slot i of the mix has the golden-ratio point frac((i + 1/2) * phi); mapped
through the cumulative target shares it names a source, so every source's slots are
spread evenly and their number is close to its share at any prefix of the mix.  Slots
are ranked within their source; each source's documents, in a shuffled order, form one
stream of words cut into blocks of equal size; the r-th slot of a source takes its r-th
block, starting over at the stream's end.

Targets: sources by code point (null last) weigh ``weights`` in turn and share all
words; a target stops at ``max_repeats`` times its source's size and the excess is
reshared by weight until none is above (one water level, found by sorting).

Defined results: null or empty texts have size 0 and are never taken; texts of any length are
counted whole and cut at words; a source of size 0 has target 0; sources that reach their cap at
the same level stop by code point; rows of one id are documents of their own, and equal rows are
taken alike up to the one that the stream's end falls in; rows without an id come first in the
shuffled order of their bucket; other columns pass through untouched in :func:`mixed_documents`;
an empty table gives no rows.

A source may hold a third of all rows: its stream is laid out in hash buckets, whose
totals are summed before any running sum, so no task holds a whole source.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seriesloom.llm import textkit as K
from seriesloom.sources.tables import written

#: Words of a block.
BLOCK = 32
#: Documents that a bucket of a source's stream holds, about.
BUCKET_ROWS = 1_000
#: Parts that each source's figures are joined in.
SALT = 64
PHI = 0.6180339887498949


def _sizes(batches):
    for batch in batches:
        n_words = [np.bincount(K.words(buf, offs, K.SPACED)[2], minlength=hi - lo) for lo, hi, buf, offs in K.chunks(batch.column(3))]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(np.concatenate(n_words) if n_words else np.zeros(0, np.int64), pa.int64())], ["doc_id", "source", "row_key", "size"])


def _row_key(documents: DataFrame) -> Column:
    """Hash of all columns."""
    return F.xxhash64(*(F.to_json(F.struct(c)) if kind.startswith("map") else F.col(f"`{c}`") for c, kind in documents.dtypes))


def document_sizes(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, row_key, size): words of every document row."""
    docs = documents.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(source_col).cast("string").alias("source"), _row_key(documents).alias("row_key"), F.col(text_col).cast("string").alias("text"))
    return docs.mapInArrow(_sizes, "doc_id bigint, source string, row_key bigint, size bigint")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeats: int = 3, block: int = BLOCK) -> DataFrame:
    """One row per source: source_size, weight, target, and the words of its slots (``scheduled``)."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("rank", F.row_number().over(order) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")).cast("double")
    s = s.withColumn("weight", weight).withColumn("cap", max_repeats * F.col("source_size"))
    # with sources ordered by cap/weight, the first k are at their cap and the rest share what is left
    below = Window.orderBy(F.col("cap") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    s = s.withColumn("capped", F.coalesce(F.sum("cap").over(below), F.lit(0))).withColumn("rest", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(below), F.lit(0.0)))
    s = s.withColumn("level", (F.sum("source_size").over(every) - F.col("capped")) / F.col("rest"))
    level = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "rank", "level"))).over(every)["level"]
    s = s.withColumn("target", F.least(F.col("cap").cast("double"), F.coalesce(level, F.lit(float("inf"))) * F.col("weight")))
    total = F.sum("target").over(Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    upto = F.sum("target").over(Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, 0))
    return s.select("source", "source_size", "weight", "cap", "target", "rank", (F.when(total > 0, (upto - F.col("target")) / total)).alias("share_from"), F.when(total > 0, F.when(F.col("rank") == F.max("rank").over(every), F.lit(1.0)).otherwise(upto / total)).alias("share_to"), F.ceil(total / block).cast("bigint").alias("n_slots"))


def _points(slot: Column) -> Column:
    """frac((slot + 1/2) * PHI), in two parts so that large slot numbers stay exact."""
    high = F.floor(slot / (1 << 20))
    return ((slot - high * (1 << 20) + F.lit(0.5)) * PHI + high * ((1 << 20) * PHI % 1.0)) % 1.0


def schedule(targets: DataFrame) -> DataFrame:
    """(slot, source, take): the mix in order; ``take`` is the slot's rank within its source, from 0.

    Points and shares meet in cells of [0, 1): a source is in every cell that its share
    touches, so the join is an equi-join on cells of like size.  Ranks are counted in runs
    of slots first, then added up, so neither a source nor the schedule is in one task.
    """
    named = _named_slots(targets).withColumn("run", F.floor(F.col("slot") / 65536))
    before = Window.partitionBy("source").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = named.groupBy("source", "run").agg(F.count("*").alias("n")).withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    inside = F.row_number().over(Window.partitionBy("source", "run").orderBy("slot")) - 1
    a, b = named.withColumn("inside", inside), runs.select(F.col("source").alias("s"), F.col("run").alias("r"), "base")
    return a.join(b, a.source.eqNullSafe(b.s) & (a.run == b.r)).select("slot", "source", (F.col("base") + F.col("inside")).alias("take"))


def _named_slots(targets: DataFrame) -> DataFrame:
    n, sources = targets.agg(F.max("n_slots"), F.count("*")).first()
    n = n or 0
    cells = max(64, n // 4096, sources)
    slots = targets.sparkSession.range(n).select(F.col("id").alias("slot"), _points(F.col("id")).alias("point"))
    slots = slots.withColumn("cell", F.floor(F.col("point") * cells))
    shares = targets.filter(F.col("share_to") > F.col("share_from")).select("source", "share_from", "share_to", F.explode(F.sequence(F.floor(F.col("share_from") * cells), F.least(F.floor(F.col("share_to") * cells), F.lit(cells - 1).cast("bigint")))).alias("cell"))
    return slots.join(shares, "cell").filter((F.col("point") >= F.col("share_from")) & (F.col("point") < F.col("share_to"))).select("slot", "source")


def _stream(sizes: DataFrame) -> DataFrame:
    """Adds ``begin``: where the document begins in its source's shuffled stream of words."""
    rows = sizes.count()
    buckets = max(1, -(-rows // BUCKET_ROWS))
    s = sizes.withColumn("shuffle_key", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).withColumn("bucket", F.floor(F.conv(F.substring("shuffle_key", 1, 7), 16, 10).cast("bigint") * buckets / (1 << 28)))
    key = ["source", "bucket"]
    totals = s.groupBy(*key).agg(F.sum("size").alias("n"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(F.col("source").alias("s"), F.col("bucket").alias("b"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy(*key).orderBy("shuffle_key", "doc_id", "row_key").rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return s.join(totals, s.source.eqNullSafe(totals.s) & (s.bucket == totals.b)).withColumn("begin", F.col("base") + F.col("inside")).drop("s", "b", "base", "inside", "bucket", "shuffle_key")


def dealt(stream: DataFrame, targets: DataFrame, block: int = BLOCK) -> DataFrame:
    """(source, begin, lap, words, first_slot): words that the slots take of each document in each
    pass over its source's stream, and the first of these slots.

    The r-th slot of a source takes words r * block to (r + 1) * block of its stream, which
    starts over at its end, up to the cap.  Blocks and documents meet in cells of a stream;
    what they share is counted in the cell where it begins.
    """
    cell = 4 * block
    t = targets.filter(F.col("source_size") > 0).select(F.col("source").alias("s"), "source_size", "cap")
    slots = schedule(targets)
    slots = slots.join(t, slots.source.eqNullSafe(t.s)).withColumn("upto", F.least((F.col("take") + 1) * block, F.col("cap"))).filter(F.col("upto") > F.col("take") * block)
    slots = slots.select("slot", "s", "source_size", (F.col("take") * block).alias("since"), "upto", F.explode(F.sequence(F.floor(F.col("take") * block / F.col("source_size")), F.floor((F.col("upto") - 1) / F.col("source_size")))).alias("lap"))
    lap = F.col("lap") * F.col("source_size")
    slots = slots.select("slot", "s", "lap", F.greatest(F.col("since") - lap, F.lit(0)).alias("a"), F.least(F.col("upto") - lap, F.col("source_size")).alias("b"))

    def cells(begin: Column, end: Column) -> Column:
        return F.explode(F.sequence(F.floor(begin / cell), F.floor((end - 1) / cell)))

    slots = slots.withColumn("c", cells(F.col("a"), F.col("b")))
    d = stream.filter(F.col("size") > 0).select("source", "begin", (F.col("begin") + F.col("size")).alias("end"))
    d = d.withColumn("cell", cells(F.col("begin"), F.col("end")))
    start, stop = F.greatest("a", "begin"), F.least("b", "end")
    met = d.join(slots, d.source.eqNullSafe(slots.s) & (d.cell == slots.c)).filter((start < stop) & (F.floor(start / cell) == F.col("cell")))
    return met.groupBy("source", "begin", "lap").agg(F.sum(stop - start).alias("words"), F.min("slot").alias("first_slot"))


def _taken(sizes: DataFrame, weights: tuple[int, ...], max_repeats: int, block: int) -> tuple[DataFrame, DataFrame]:
    """(the stream, with each document's passes: lap, words, first slot; the targets)."""
    sizes = written(sizes)
    targets = written(source_targets(sizes, weights, max_repeats, block))
    stream = written(_stream(sizes))
    passes = dealt(stream, targets, block).groupBy(F.col("source").alias("s"), F.col("begin").alias("at")).agg(F.array_sort(F.collect_list(F.struct("lap", "words", "first_slot"))).alias("passes"))  # one for each pass, ``max_repeats`` at most
    # a document without words begins where the next one does, and is not taken; its key spreads it out
    d = stream.withColumn("key", F.when(F.col("size") > 0, F.col("begin")).otherwise(-1 - F.pmod(F.xxhash64("doc_id", "row_key"), F.lit(1 << 40))))
    return d.join(passes, d.source.eqNullSafe(passes.s) & (d.key == passes["at"]), "left").drop("s", "at", "key"), targets


def mix(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeats: int = 3, block: int = BLOCK) -> DataFrame:
    """(doc_id, row_key, source, size, begin, passes, source_size, target, taken, first_slot).

    ``taken`` is what the slots' blocks hold of the document, ``first_slot`` the first slot that
    takes some of it, and ``passes`` has both for each pass over the source's stream.
    """
    d, targets = _taken(sizes, weights, max_repeats, block)
    # a source may hold a third of all documents: its one row is met in SALT places
    t = targets.select(F.col("source").alias("s"), "source_size", "target").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    d = d.withColumn("row_salt", F.pmod(F.xxhash64("doc_id", "row_key"), F.lit(SALT)).cast("int"))
    d = d.join(t, d.source.eqNullSafe(t.s) & (d.row_salt == t.salt)).drop("s", "salt", "row_salt")
    taken = F.aggregate(F.coalesce("passes", F.array().cast("array<struct<lap:bigint,words:bigint,first_slot:bigint>>")), F.lit(0).cast("bigint"), lambda total, x: total + x.words)
    return d.withColumn("taken", taken).withColumn("first_slot", F.array_min(F.transform("passes", lambda x: x.first_slot)))


def _cutter(at: int, n_at: int, names: list[str]):
    """Cuts the text in column ``at`` after the number of words in column ``n_at``; whole where that is null."""

    def cut(batches):
        for batch in batches:
            pieces = []
            for lo, hi, buf, offs in K.chunks(batch.column(at)):
                _, end, doc = K.words(buf, offs, K.SPACED)
                first = K.bounds(doc, hi - lo)
                for i, n in enumerate(batch.column(n_at).slice(lo, hi - lo).to_pylist()):
                    stop = offs[i + 1] if n is None else end[first[i] + n - 1]
                    pieces.append(buf[offs[i] : stop].tobytes().decode())
            columns = [pa.array(pieces, batch.schema.field(at).type) if i == at else c for i, c in enumerate(batch.columns) if i != n_at]
            yield pa.RecordBatch.from_arrays(columns, names)

    return K.tidied(cut)


def mixed_documents(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = (1, 2, 3), max_repeats: int = 3, block: int = BLOCK) -> DataFrame:
    """The mix as rows of ``documents``, in order of the slots that first take them: one row for
    each pass over its source's stream that takes the document, cut after its last taken word
    where the pass ends in it.

    The parts of a document that a pass takes in several slots stay together, in the first of
    them.
    """
    names = documents.columns
    taken, _ = _taken(document_sizes(documents, id_col, text_col, source_col), weights, max_repeats, block)
    # equal rows, all of whose columns are the same, have one row here, with the passes of all of them
    taken = taken.filter(F.col("passes").isNotNull()).groupBy(F.struct("doc_id", "row_key", "source").alias("mix_key")).agg(F.flatten(F.collect_list(F.transform("passes", lambda x: F.struct(x.first_slot.alias("slot"), F.when(x.words < F.col("size"), x.words).alias("words"))))).alias("mix_passes"))
    key = F.struct(F.col(id_col).cast("bigint").alias("doc_id"), _row_key(documents).alias("row_key"), F.col(source_col).cast("string").alias("source"))
    d = documents.select(F.struct(*names).alias("mix_row"), key.alias("doc_key"))
    d = d.withColumn("doc_n", F.row_number().over(Window.partitionBy("doc_key").orderBy("doc_key"))).filter("doc_n = 1")
    d = d.join(taken, d.doc_key.eqNullSafe(taken.mix_key)).select("mix_row", "doc_key", F.explode("mix_passes").alias("mix_pass"))
    order = [F.col("mix_pass.slot"), F.col("doc_key")]
    d = d.repartitionByRange(*order).sortWithinPartitions(*order)
    return d.select("mix_row.*", F.col("mix_pass.words").alias("mix_words_")).mapInArrow(_cutter(names.index(text_col), len(names), names), documents.schema)


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over all of ``documents``."""
    return mix(document_sizes(spark.read.parquet(f"{sf_dir}/documents.parquet"))).select("doc_id", "size", "source_size", "target", "taken")


SQL = r"""
WITH s AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
g AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM s GROUP BY source),
w AS (SELECT *, CAST(rank % 3 + 1 AS DOUBLE) AS weight, 3 * source_size AS cap FROM g),
o AS (SELECT *, CAST(coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS capped,
      sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest, CAST(sum(source_size) OVER () AS BIGINT) AS all_size FROM w),
v AS (SELECT *, (all_size - capped) / rest AS level FROM o),
lv AS (SELECT level FROM v WHERE level * weight <= cap ORDER BY cap / weight, rank LIMIT 1),
t AS (SELECT source, rank, source_size, cap, least(CAST(cap AS DOUBLE), lv.level * weight) AS target FROM v, lv),
c AS (SELECT *, sum(target) OVER (ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM t),
e AS (SELECT source, source_size, target, cap, (upto - target) / tot AS share_from, CASE WHEN rank = mr THEN 1.0 ELSE upto / tot END AS share_to, CAST(ceil(tot / 32) AS BIGINT) AS n_slots
      FROM c, (SELECT max(upto) AS tot, max(rank) AS mr FROM c)),
p AS (SELECT i AS slot, fmod((i - (i // 1048576) * 1048576 + 0.5::DOUBLE) * 0.6180339887498949::DOUBLE + (i // 1048576) * fmod(1048576 * 0.6180339887498949::DOUBLE, 1.0::DOUBLE), 1.0::DOUBLE) AS point
      FROM (SELECT unnest(range((SELECT max(n_slots) FROM e))) AS i)),
k AS (SELECT source, count(*) AS slots FROM p, e WHERE point >= share_from AND point < share_to GROUP BY source),
f AS (SELECT e.source, source_size, target, least(coalesce(slots, 0) * 32, cap) AS scheduled FROM e LEFT JOIN k ON e.source IS NOT DISTINCT FROM k.source),
b AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM s)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN source_size > 0 THEN (scheduled // source_size) * size + least(size, greatest(0, scheduled - (scheduled // source_size) * source_size - start)) ELSE 0 END AS BIGINT) AS taken
FROM b JOIN f ON b.source IS NOT DISTINCT FROM f.source
"""
