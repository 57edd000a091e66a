"""Quality rules: cross-document line frequency.

Method: every line is normalised to its words with A-Z lower-cased and hashed; for each
host the distinct documents with that line are counted; lines in more than ``line_percent``
of a host's documents, and in more than ``line_floor`` of them, are removed there; a document
of which less than ``min_share`` of its words is left is depleted and rejected.  The limit is a
share, so a host's verdict doesn't depend on the size of the table.  Plain per-document rules
(the base) come first.

Defined results: null or empty texts have no words and fail the base; texts of any length are
read whole; a null host is a host of its own; rows that share an id are one document, rows
without an id one for each different text, and each row gets a row; a line at the limit stays;
other columns are ignored; an empty table gives no rows.  Texts are read once, and their figures and line hashes
written; counting is pre-aggregated on the map side and the join back is salted, so a host or
line with a third of all rows is spread out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.llm import textkit as K
from seriesloom.sources.tables import written

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[np.frombuffer(b"#*$%&|<>", dtype=np.uint8)] = True
#: Parts that each (host, line) of the frequent lines is joined in.
SALT = 16
_SCHEMA = "doc_id bigint, host string, row_key bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, lines array<bigint>, line_words array<bigint>"


def _per_text(values: np.ndarray, group: np.ndarray) -> np.ndarray:
    """One key for each (text number, value)."""
    return K.mix(values ^ K.mix(K.GOLDEN * (group + 1).astype(np.uint64)))


def measure(buf: np.ndarray, offs: np.ndarray) -> tuple:
    """Base figures of each text and its distinct normalised lines with their words."""
    n = len(offs) - 1
    start, end, doc = K.words(buf, offs, K.SPACED)
    n_words = np.bincount(doc, minlength=n)
    points = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
    chars = np.bincount(doc, points[end] - points[start], minlength=n).astype(np.int64)
    marks = np.concatenate([[0], np.cumsum(SYMBOLS[buf])])
    symbols = marks[offs[1:]] - marks[offs[:-1]]

    exact = K.span_hashes(buf, start, end, False)
    value, at, own = K.window_hashes(exact, doc, n, 3, short=False)
    _, code, times = np.unique(_per_text(value, own), return_inverse=True, return_counts=True)
    again = at[times[code] > 1]
    cover = np.zeros(len(doc) + 3, dtype=np.int64)
    np.add.at(cover, again, 1)
    np.add.at(cover, again + 3, -1)
    repeat = np.bincount(doc[np.cumsum(cover)[: len(doc)] > 0], minlength=n)

    # lines: from a text's begin or after \n to the next \n or the text's end
    breaks = np.flatnonzero(buf == 10)
    line_start = np.sort(np.concatenate([offs[:-1], breaks + 1]))
    line_end = np.sort(np.concatenate([offs[1:], breaks]))
    line = np.searchsorted(line_start, start, "right") - 1
    with_word, first, n_in = np.unique(line, return_index=True, return_counts=True)
    line_doc = doc[first] if len(first) else first
    raw = _per_text(K.span_hashes(buf, line_start[with_word], line_end[with_word], False), line_doc)
    _, raw_first = np.unique(raw, return_index=True)
    dup = np.bincount(line_doc, minlength=n) - np.bincount(line_doc[raw_first], minlength=n)

    folded = K.span_hashes(buf, start, end, True)
    power, inverse = K.powers(len(folded) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(folded * power[: len(folded)], dtype=np.uint64)])
    line_hash = K.mix((sums[first + n_in] - sums[first]) * inverse[first])
    _, key_first, key = np.unique(_per_text(line_hash, line_doc), return_index=True, return_inverse=True)
    in_lines = np.bincount(key, n_in, minlength=len(key_first)).astype(np.int64)
    order = np.argsort(key_first)
    lines, line_words, per_doc = line_hash[key_first[order]].view(np.int64), in_lines[order], np.bincount(line_doc[key_first], minlength=n)
    return n_words, chars, symbols, dup, repeat, lines, line_words, per_doc


def _rows(batches):
    for batch in batches:
        for lo, hi, buf, offs in K.chunks(batch.column(3)):
            n = hi - lo
            n_words, chars, symbols, dup, repeat, lines, line_words, per_doc = measure(buf, offs)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i).slice(lo, n) for i in range(3)), *(pa.array(x.astype(np.int64)) for x in (n_words, chars, symbols, dup, repeat)), K.list_array(lines, per_doc, pa.int64()), K.list_array(line_words, per_doc, pa.int64())],
                ["doc_id", "host", "row_key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines", "line_words"],
            )


def _documents_by(rows: DataFrame, *keys: str) -> DataFrame:
    """Distinct documents of each key: by id, and by text where there is none."""
    other = F.when(F.col("doc_id").isNull(), F.col("row_key")).alias("other")
    return rows.select(*keys, "doc_id", other).distinct().groupBy(*keys).agg(F.count("*").alias("n_docs"))


def frequent_lines(rows: DataFrame, line_percent: int, line_floor: int) -> DataFrame:
    """(host_key, line, n_docs) of the lines above a host's limit."""
    hosts = _documents_by(rows, "host_key").withColumnRenamed("n_docs", "host_docs")
    lines = _documents_by(rows.withColumn("line", F.explode("lines")), "host_key", "line").filter(F.col("n_docs") > line_floor)
    return lines.join(hosts, "host_key").filter(100 * F.col("n_docs") > line_percent * F.col("host_docs")).select("host_key", "line", "n_docs")


def quality_rules(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", line_percent: int = 2, line_floor: int = 3, min_share: float = 0.3, min_words: int = 50, max_repeat_share: int = 50) -> DataFrame:
    """Base figures, words removed as frequent lines, and the verdict of every document row."""
    docs = documents.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(host_col).cast("string").alias("host"), F.xxhash64(F.col(text_col)).alias("row_key"), F.col(text_col).alias("text"))
    host = F.coalesce(F.concat(F.lit("h"), F.col("host")), F.lit("n")).alias("host_key")
    rows = written(docs.mapInArrow(K.tidied(_rows), _SCHEMA).select("*", host))
    frequent = frequent_lines(rows, line_percent, line_floor).select("host_key", "line", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt"))
    who = F.struct("host_key", "doc_id", "row_key")
    each = rows.select("host_key", who.alias("who"), F.explode(F.arrays_zip("lines", "line_words")).alias("x")).select("host_key", "who", F.col("x.lines").alias("line"), F.col("x.line_words").alias("words"), F.pmod(F.xxhash64("who"), F.lit(SALT)).cast("int").alias("salt"))
    removed = each.join(frequent, ["host_key", "line", "salt"]).groupBy("who").agg(F.sum("words").alias("removed"))
    # equal rows: their lines were summed up together
    base = [c for c in rows.columns if c not in ("lines", "line_words")]
    out = rows.groupBy(*base).agg(F.count("*").alias("copies")).withColumn("key", who)
    out = out.join(removed, out.key.eqNullSafe(removed.who), "left").withColumn("n_removed_words", F.coalesce(F.col("removed") / F.col("copies"), F.lit(0)).cast("bigint"))
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_share * F.col("n_words"))
    left = F.col("n_words") - F.col("n_removed_words")
    depleted = (F.col("n_removed_words") > 0) & ((left < min_words) | (left < min_share * F.col("n_words")))
    return out.withColumn("base_failed", failed).withColumn("depleted", depleted).select("doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed_words", "depleted", "base_failed", (~failed & ~depleted).alias("kept"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over all of ``documents``."""
    return quality_rules(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed_words", "base_failed", "kept")


SQL = r"""
WITH d AS (SELECT doc_id, coalesce('h' || source, 'n') AS host, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, host, unnest(string_split(text, chr(10))) AS line FROM d),
lw AS (SELECT doc_id, host, line, regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS norm FROM l),
lines AS (SELECT * FROM lw WHERE len(norm) > 0),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY doc_id),
hosts AS (SELECT host, count(DISTINCT doc_id) AS host_docs FROM d GROUP BY host),
freq AS (SELECT host, norm FROM lines JOIN hosts USING (host) GROUP BY host, norm, host_docs HAVING count(DISTINCT doc_id) > 3 AND 100 * count(DISTINCT doc_id) > 2 * host_docs),
rem AS (SELECT doc_id, sum(len(norm)) AS n_removed_words FROM lines JOIN freq USING (host, norm) GROUP BY doc_id),
tri AS (SELECT doc_id, i, w[i:i + 2] AS win FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
rep AS (SELECT doc_id, win FROM tri GROUP BY doc_id, win HAVING count(*) > 1),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest(range(i, i + 3)) AS p FROM tri JOIN rep USING (doc_id, win)) GROUP BY doc_id),
m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
      CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
      CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(n_removed_words, 0) AS BIGINT) AS n_removed_words
      FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN cov USING (doc_id) LEFT JOIN rem USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT (n_removed_words > 0 AND (n_words - n_removed_words < 50 OR n_words - n_removed_words < 0.3 * n_words)) AS kept
FROM m
"""
