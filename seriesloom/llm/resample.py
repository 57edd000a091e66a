"""Importance resampling towards a target text distribution.

Features are all runs of one and two words, hashed into buckets.  Two passes over the texts:

1. Every task adds up the features of its texts by bucket; the sums of all tasks give each
   bucket's gain, the logarithm of its smoothed share in the target against the corpus.
2. The gains, one array of a number per bucket, score every text: a text's weight is the floored mean of
   its features' gains, and its score adds a Gumbel value that depends on the seed and the id alone.
   Scores are written to a table.

Which rows are drawn is found by halving the range of scores: each job counts the table's rows at or above
the thresholds that the next few halvings can ask for, so a handful of exact counts finds the score at
which the draw ends, and the same then finds the document id at which it ends among that score's ties.
Drawn rows are range-partitioned by rank order and numbered from the partitions' counts.

What passes through the driver: one count per bucket, per threshold and per partition.

Defined results: null and empty texts have no features and weight 0; a null document id is drawn like the
text of no digits and comes after all ids among ties; equal rows are rows of their own, and of rows with
equal score and id any may be the last one drawn; an empty table gives no rows, an empty target weighs by
the corpus alone; a text of any length is read whole, in runs of texts; columns other than the
two named are ignored, whatever they are called.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.llm import textkit as K
from seriesloom.sources.tables import written

BUCKETS = 10_000
#: Fixed value: the reversed polynomial of the CRC-32 that zlib computes.
CRC_POLYNOMIAL = 0xEDB88320
#: Words of more bytes are given to zlib one by one.
LONG_WORD = 48
#: Halvings of the range that one job counts for.
LEVELS = 4
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> 1 ^ np.uint32(CRC_POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


CRC_TABLE = _crc_table()


def _shift_tables(levels: int = 40) -> list[np.ndarray]:
    """For each k, what 2**k zero bytes behind it make of a CRC's four bytes (they are linear in it)."""
    one = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).astype(np.uint32)
    step = CRC_TABLE[one & 0xFF] ^ (one >> np.uint32(8))
    out = [step]
    for _ in range(levels - 1):
        out.append(_shifted(out[-1], out[-1]))
    return out


def _shifted(crc: np.ndarray, table: np.ndarray) -> np.ndarray:
    return table[0][crc & 0xFF] ^ table[1][crc >> np.uint32(8) & 0xFF] ^ table[2][crc >> np.uint32(16) & 0xFF] ^ table[3][crc >> np.uint32(24)]


SHIFTS = _shift_tables()


def word_crcs(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of every span of bytes, byte by byte for all spans at once."""
    length = end - start
    crc = np.full(len(start), 0xFFFFFFFF, dtype=np.uint32)
    order = np.argsort(-length, kind="stable")
    begin, size = start[order], length[order]
    long = int(np.searchsorted(-size, -LONG_WORD, "left"))
    for j in range(int(size[long]) if long < len(size) else 0):
        live = order[long : int(np.searchsorted(-size, -j, "left"))]
        crc[live] = CRC_TABLE[(crc[live] ^ buf[start[live] + j]) & 0xFF] ^ crc[live] >> np.uint32(8)
    crc ^= np.uint32(0xFFFFFFFF)
    for i in order[:long]:
        crc[i] = zlib.crc32(buf[start[i] : end[i]])
    return crc


def pair_crcs(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of two joined strings from theirs, and the second one's length."""
    out, k = first.copy(), 0
    while length.any():
        odd = (length & 1).astype(bool)
        out[odd] = _shifted(out[odd], SHIFTS[k])
        length, k = length >> 1, k + 1
    return out ^ second


def feature_buckets(buf: np.ndarray, offs: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each feature, its text, words of each text) of a run of texts."""
    n = len(offs) - 1
    buf = _LOWER[buf]
    start, end, doc = K.words(buf, offs, K.ALNUM)
    one = word_crcs(buf, start, end)
    next_same = np.flatnonzero(doc[1:] == doc[:-1])
    spaced = one[next_same] ^ np.uint32(0xFFFFFFFF)
    spaced = CRC_TABLE[(spaced ^ np.uint32(32)) & 0xFF] ^ spaced >> np.uint32(8) ^ np.uint32(0xFFFFFFFF)
    two = pair_crcs(spaced, one[next_same + 1], (end - start)[next_same + 1])
    return np.concatenate([one, two]) % np.uint32(buckets), np.concatenate([doc, doc[next_same]]), np.bincount(doc, minlength=n)


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, text_col: str = "text") -> np.ndarray:
    """Features of all rows by bucket; every task adds up its own first."""

    def run(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, _, buf, offs in K.chunks(batch.column(0)):
                total += np.bincount(feature_buckets(buf, offs, buckets)[0], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    rows = texts.select(F.col(text_col).cast("string").alias("text")).mapInArrow(K.tidied(run), "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(buckets, dtype=np.int64)
    out[rows["bucket"].to_numpy(dtype=np.int64)] = rows["n"].to_numpy(dtype=np.int64)
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of each bucket's smoothed share in the target against the corpus."""
    s, t = float(corpus.sum() + len(corpus)), float(target.sum() + len(target))
    return np.array([math.floor(1000 * math.log((float(b) + 1) * s / ((float(a) + 1) * t))) for a, b in zip(corpus, target)], dtype=np.int64)


def gumbel(seed: int, doc_id: Column) -> Column:
    """Thousandths of a standard Gumbel value that depends on the seed and the id alone."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("bigint")


def scores(documents: DataFrame, gain: np.ndarray, seed: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every row."""
    sc = documents.sparkSession.sparkContext
    shared = sc.broadcast(gain)  # one number per bucket, whatever the tables' size

    def run(batches):
        gain = shared.value
        for batch in batches:
            for lo, hi, buf, offs in K.chunks(batch.column(1)):
                bucket, doc, words = feature_buckets(buf, offs, len(gain))
                n = np.bincount(doc, minlength=hi - lo)
                total = np.zeros(hi - lo, dtype=np.int64)
                np.add.at(total, doc, gain[bucket])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(words), pa.array(n), pa.array(total // np.maximum(n, 1))], ["doc_id", "n_words", "n_features", "weight"])

    rows = documents.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(K.tidied(run), "doc_id bigint, n_words bigint, n_features bigint, weight bigint")
    return rows.withColumn("score", F.col("weight") + gumbel(seed, F.col("doc_id")))


def cutoff(rows: DataFrame, value: str, wanted: int) -> int | None:
    """The largest value v of which at least ``wanted`` rows are at or above v; None if there are fewer rows.

    Halves the range of values; each job counts rows at the thresholds of the next LEVELS halvings.
    """
    edge = rows.agg(F.min(value).alias("low"), F.max(value).alias("high"), F.count(value).alias("n")).first()
    if edge.n < wanted or edge.low is None:
        return None
    low, high = edge.low, edge.high + 1  # at least wanted at low, fewer at high
    while high - low > 1:
        steps = min(1 << LEVELS, high - low)
        at = [low + (high - low) * k // steps for k in range(1, steps)]
        counts = rows.agg(*[F.count_if(F.col(value) >= t).alias(f"c{k}") for k, t in enumerate(at)]).first()
        low, high = max([low, *(t for t, c in zip(at, counts) if c >= wanted)]), min([high, *(t for t, c in zip(at, counts) if c < wanted)])
    return low


def drawn(scored: DataFrame, wanted: int) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, ... by falling score, ties to the smaller id, for the first ``wanted``
    of the rows that are ``eligible``; null for all others.

    ``scored`` must be a written table with a ``row_id`` of its own for each row: it is read many times.
    """
    pool = scored.filter("eligible")
    cut = cutoff(pool, "score", wanted) if wanted > 0 else None
    if cut is None:
        return scored.withColumn("rank", F.lit(None).cast("bigint"))
    rest = wanted - pool.filter(F.col("score") > cut).count()
    ties = pool.filter(F.col("score") == cut)
    last = cutoff(ties.select((-F.col("doc_id")).alias("v")), "v", rest)  # None: all ids, and rows without one
    tied = (F.col("score") == cut) & (F.lit(True) if last is None else F.coalesce(F.col("doc_id") <= -last, F.lit(False)))
    taken = F.col("eligible") & ((F.col("score") > cut) | tied)
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last(), F.col("row_id")]
    # a row's place: the partition in the upper bits, its number in the partition in the lower 33
    placed = written(scored.filter(taken).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()))
    part = F.shiftright("place", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).toPandas().sort_values("part")
    begin = pd.DataFrame({"part": sizes["part"], "before": sizes["n"].cumsum() - sizes["n"]})
    base = scored.sparkSession.createDataFrame(begin, "part bigint, before bigint")  # one row per partition
    ranked = placed.withColumn("part", part).join(F.broadcast(base), "part").withColumn("rank", F.col("before") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) + 1)
    # of rows with one score and id, more may be here than are wanted: the last ones aren't drawn
    ranked = ranked.select(*scored.columns, F.when(F.col("rank") <= wanted, F.col("rank")).cast("bigint").alias("rank"))
    return ranked.unionByName(scored.filter(~taken).withColumn("rank", F.lit(None).cast("bigint")))


def resample(documents: DataFrame, target: DataFrame, percent: int = 25, min_words: int = 20, seed: int = 7, buckets: int = BUCKETS, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every document.

    ``percent`` of the documents with at least ``min_words`` words are drawn, without replacement, by the
    likeness of their features to those of ``target``.
    """
    gain = gains(bucket_counts(documents, buckets, text_col), bucket_counts(target, buckets, target_text))
    found = scores(documents, gain, seed, id_col, text_col).withColumn("eligible", F.col("n_words") >= min_words)
    scored = written(found.withColumn("row_id", F.monotonically_increasing_id()))
    wanted = percent * scored.filter("eligible").count() // 100
    return drawn(scored, wanted).select("doc_id", "n_words", "n_features", "weight", "score", "rank")


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over all of ``documents``, towards all of ``benchmark``."""
    return resample(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("n_words")
