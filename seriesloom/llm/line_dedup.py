"""Line dedup: overlapping windows of three lines, found globally.

Method: every three consecutive lines of a text are hashed as one window of 128 bits (a text of
fewer lines, but at least one with a word, is one window).  Windows are counted over all
documents; of a window that occurs again, the first occurrence in order of (document id,
row, line) stays, and the lines of the later ones are covered; covered positions are
merged and their lines removed.  Where a later occurrence overlaps the first one of its own
window in the same text, the lines of that first one stay.

Long lines count as several: a line is cut behind a word whose place value, made of the bytes in
it and in the two words before, is less than those of the four words before it and not above those of the
four behind it.  So the cuts depend on the words around them alone, pieces have five words at least
and some ten on average, and a passage that repeats inside of long lines, or is broken into lines
in another way at its ends only, has the same windows inside wherever it stands.

Lines are compared by their words with A-Z lower-cased, so white space at the ends doesn't
matter; lines without words are passed over (they neither stop a window nor are removed).

Defined results: null texts stay null and texts without words stay as they are; texts of any
length are read whole, however many lines they have; equal rows are told apart by their number
among equals, so the first stays; a null id comes first; other columns pass through
:func:`deduplicated_documents` untouched; an empty table gives no rows.

Windows are written once.  Those that occur once are sorted out by 64 bits of their hash before
the exact comparison; counts are pre-aggregated on the map side, and the join back is salted for
windows of very many occurrences, so one in a third of all documents is spread out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seriesloom.llm import bloom
from seriesloom.llm import textkit as K
from seriesloom.sources.tables import written

#: Lines of a window.
LINES = 3
#: Occurrences from which a window is met in SALT places.
HOT = 2_000
SALT = 32
#: Words on either side of a cut that its place value is compared with.
REACH = 4


def cuts(start: np.ndarray, end: np.ndarray, line: np.ndarray) -> np.ndarray:
    """Which words a line is cut behind; ``line`` is the line of each word, in order."""
    n = len(start)
    first = np.flatnonzero(np.append(True, line[1:] != line[:-1])) if n else np.zeros(0, np.int64)
    count = np.diff(np.append(first, n))
    place = np.arange(n) - np.repeat(first, count)
    behind = np.repeat(count, count) - 1 - place
    size = end - start
    value = 7 * size
    value[1:] += 5 * size[:-1] * (place[1:] >= 1)
    value[2:] += 3 * size[:-2] * (place[2:] >= 2)
    value %= 11
    at = np.flatnonzero((place >= REACH) & (behind >= REACH))
    for k in range(1, REACH + 1):
        at = at[(value[at] < value[at - k]) & (value[at] <= value[at + k])]
    cut = np.zeros(n, dtype=bool)
    cut[at] = True
    return cut


def lines_of(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, text number, line number and hash of each line, or piece of one, with a word.

    Pieces of a line begin at their first word, the first at the line's begin; the last ends at its end.
    """
    start, end, doc = K.words(buf, offs, K.SPACED)
    breaks = np.flatnonzero(buf == 10)
    line_start = np.sort(np.concatenate([offs[:-1], breaks + 1]))
    line_end = np.sort(np.concatenate([offs[1:], breaks]))
    line = np.searchsorted(line_start, start, "right") - 1
    begins = np.ones(len(start), dtype=bool)  # of a line, and behind a cut
    begins[1:] = (line[1:] != line[:-1]) | cuts(start, end, line)[:-1]
    first = np.flatnonzero(begins)
    count = np.diff(np.append(first, len(start)))
    own_line = line[first]
    words = K.span_hashes(buf, start, end, True)
    power, inverse = K.powers(len(words) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * power[: len(words)], dtype=np.uint64)])
    hashes = K.mix((sums[first + count] - sums[first]) * inverse[first] + K.GOLDEN * count.astype(np.uint64))
    new = np.append(True, own_line[1:] != own_line[:-1])[: len(first)]
    begin = np.where(new, line_start[own_line], start[first])
    stop = np.where(np.append(new[1:], True)[: len(first)], line_end[own_line], np.append(begin[1:], 0)[: len(first)])
    return begin, stop, doc[first], own_line, hashes


def _windows(batches):
    """Window hashes of each row, by the order of its lines with words."""
    for batch in batches:
        for lo, hi, buf, offs in K.chunks(batch.column(2)):
            _, _, own, _, hashes = lines_of(buf, offs)
            value, _, window_own = K.window_hashes(hashes, own, hi - lo, LINES)
            more, _, _ = K.window_hashes(K.mix(hashes ^ K.MIX_B), own, hi - lo, LINES)
            n = np.bincount(window_own, minlength=hi - lo)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(np.bincount(own, minlength=hi - lo)), *(K.list_array(x.view(np.int64), n, pa.int64()) for x in (value, more))], ["doc_id", "row_key", "n_lines", "windows", "more"])


def _repeated(again, frequent):
    """(doc_id, row_key, n_lines, places, windows, more, hot): only windows that may occur again, and
    whether they may be hot, by the first 64 bits."""

    def rows(batches):
        for batch in batches:
            windows, more = batch.column(3), batch.column(4)
            n = np.diff(windows.offsets.to_numpy())
            first, second = windows.flatten().to_numpy(), more.flatten().to_numpy()
            own = np.repeat(np.arange(len(n)), n)
            place = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
            may = bloom.may_hold(again.value, first)
            left = np.bincount(own[may], minlength=len(n))
            hot = bloom.may_hold(frequent.value, first[may])
            out = pa.RecordBatch.from_arrays([*batch.columns[:3], *(K.list_array(x[may], left, pa.int64()) for x in (place, first, second)), K.list_array(hot, left, pa.bool_())], ["doc_id", "row_key", "n_lines", "places", "windows", "more", "hot"])
            yield out.filter(pa.array(left > 0))

    return K.tidied(rows)


def repeated_windows(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row_key, copy, n_lines, covered): per document row, the places (from 0, among
    the lines with words) that later occurrences cover, merged and sorted.

    ``copy`` numbers equal rows from 1.
    """
    docs = documents.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("row_key"), F.col(text_col).cast("string").alias("text"))
    rows = written(docs.mapInArrow(K.tidied(_windows), "doc_id bigint, row_key bigint, n_lines bigint, windows array<bigint>, more array<bigint>"))
    again = written(rows.select(F.explode("windows").alias("window")).groupBy("window").agg(F.count("*").alias("times")).filter(F.col("times") > 1))
    share = documents.sparkSession.sparkContext.broadcast
    shared = [share(bloom.bits_of(again.filter(F.col("times") > least).select("window"))) for least in (1, HOT)]  # of bounded size
    may = rows.mapInArrow(_repeated(*shared), "doc_id bigint, row_key bigint, n_lines bigint, places array<bigint>, windows array<bigint>, more array<bigint>, hot array<boolean>")
    may = may.withColumn("copy", F.row_number().over(Window.partitionBy("doc_id", "row_key").orderBy("n_lines")))
    each = may.select("doc_id", "row_key", "copy", "n_lines", F.explode(F.arrays_zip("places", "windows", "more", "hot")).alias("x")).select("doc_id", "row_key", "copy", "n_lines", F.col("x.places").alias("at"), F.col("x.windows").alias("window"), F.col("x.more").alias("more"), F.col("x.hot").alias("hot"))
    spot = F.struct("doc_id", "row_key", "copy", F.col("at"))
    # min of structs orders nulls first, as the order of documents does
    firsts = each.groupBy("window", "more", "hot").agg(F.min(spot).alias("first"), F.count("*").alias("times")).filter(F.col("times") > 1)
    firsts = firsts.select("window", "more", "first", F.explode(F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALT - 1))).otherwise(F.array(F.lit(0)))).alias("salt"))
    each = each.withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("doc_id", "row_key", "copy", "at"), F.lit(SALT))).otherwise(0).cast("int"))
    later = each.join(firsts, ["window", "more", "salt"]).filter(~F.col("first").eqNullSafe(spot))
    upto = lambda at: F.sequence(at, F.least(at + (LINES - 1), F.col("n_lines") - 1))
    same = F.struct("first.doc_id", "first.row_key", "first.copy").eqNullSafe(F.struct("doc_id", "row_key", "copy"))
    kept = F.when(same & (F.col("at") - F.col("first.at") < LINES), upto(F.col("first.at")))
    merged = lambda x: F.flatten(F.collect_set(x))
    covered = later.groupBy(F.struct("doc_id", "row_key", "copy").alias("key")).agg(F.array_sort(F.array_distinct(F.array_except(merged(upto(F.col("at"))), merged(kept)))).alias("covered"))
    every = rows.select("doc_id", "row_key", "n_lines").withColumn("copy", F.row_number().over(Window.partitionBy("doc_id", "row_key").orderBy("n_lines")))
    every = every.withColumn("row", F.struct("doc_id", "row_key", "copy"))
    out = every.join(covered, every.row.eqNullSafe(covered.key), "left")
    return out.select("doc_id", "row_key", "copy", "n_lines", F.coalesce("covered", F.array().cast("array<bigint>")).alias("covered"))


def _remover(at: int, covered_at: int, names: list[str]):
    def remove(batches):
        for batch in batches:
            covered = batch.column(covered_at).to_pylist()
            texts = []
            for lo, hi, buf, offs in K.chunks(batch.column(at)):
                start, end, own, line, _ = lines_of(buf, offs)
                first = K.bounds(own, hi - lo)
                for i in range(hi - lo):
                    data, drop = buf[offs[i] : offs[i + 1]], covered[lo + i]
                    if drop:
                        keep = np.ones(len(data), dtype=bool)
                        for k in drop:
                            keep[start[first[i] + k] - offs[i] : end[first[i] + k] - offs[i]] = False
                        # a line that is removed whole goes with the line end behind it
                        lines, gone = line[first[i] : first[i + 1]], np.zeros(first[i + 1] - first[i], dtype=bool)
                        gone[drop] = True
                        for x in np.setdiff1d(lines[gone], lines[~gone]):
                            stop = end[first[i] + np.searchsorted(lines, x, "right") - 1] - offs[i]
                            keep[stop : stop + 1] = False
                        data = data[keep]
                    texts.append(data.tobytes().decode())
            column = pa.array(texts, batch.schema.field(at).type, mask=batch.column(at).is_null().to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([column if i == at else c for i, c in enumerate(batch.columns) if i != covered_at], names)

    return K.tidied(remove)


def deduplicated_documents(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``documents`` with the lines of later occurrences removed from their texts."""
    names = documents.columns
    found = repeated_windows(documents, id_col, text_col).filter(F.size("covered") > 0)
    found = found.select(F.struct("doc_id", "row_key").alias("found_key"), F.col("copy").alias("found_copy"), "covered")
    d = documents.select(F.struct(*names).alias("kept_row"), F.struct(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("row_key")).alias("row_at"))
    d = d.withColumn("row_copy", F.row_number().over(Window.partitionBy("row_at").orderBy("row_at")))
    d = d.join(found, d.row_at.eqNullSafe(found.found_key) & (d.row_copy == found.found_copy), "left").select("kept_row.*", F.col("covered").alias("covered_lines_"))
    return d.mapInArrow(_remover(names.index(text_col), len(names), names), documents.schema)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents``: lines (pieces of long ones counted), and the removed ones' number and places."""
    found = repeated_windows(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_lines", F.size("covered").cast("bigint").alias("n_removed"), F.array_join(F.transform("covered", lambda x: x.cast("string")), ",").alias("removed_lines"))


SQL = r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS i FROM documents),
x AS (SELECT doc_id, i, unnest(w) AS word, unnest(range(len(w))) AS k, len(w) AS n FROM
      (SELECT doc_id, i, regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM l) WHERE len(w) > 0),
v AS (SELECT *, (7 * strlen(word) + 5 * coalesce(lag(strlen(word), 1) OVER o, 0) + 3 * coalesce(lag(strlen(word), 2) OVER o, 0)) % 11 AS v FROM x WINDOW o AS (PARTITION BY doc_id, i ORDER BY k)),
e AS (SELECT *, k >= 4 AND n - k > 4 AND v < min(v) OVER (PARTITION BY doc_id, i ORDER BY k ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING)
      AND v <= min(v) OVER (PARTITION BY doc_id, i ORDER BY k ROWS BETWEEN 1 FOLLOWING AND 4 FOLLOWING) AS cut FROM v),
u AS (SELECT *, coalesce(sum(CASE WHEN cut THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, i ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS piece FROM e),
n AS MATERIALIZED (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i, piece) - 1 AS pos, norm FROM (SELECT doc_id, i, piece, string_agg(word, ' ' ORDER BY k) AS norm FROM u GROUP BY doc_id, i, piece)),
c AS (SELECT doc_id, count(*) AS n_lines FROM n GROUP BY doc_id),
w AS (SELECT a.doc_id, a.pos, n_lines, a.norm || coalesce(chr(10) || b.norm, '') || coalesce(chr(10) || d.norm, '') AS win FROM n a JOIN c USING (doc_id)
      LEFT JOIN n b ON b.doc_id = a.doc_id AND b.pos = a.pos + 1 LEFT JOIN n d ON d.doc_id = a.doc_id AND d.pos = a.pos + 2
      WHERE a.pos + 3 <= n_lines OR (a.pos = 0 AND n_lines < 3)),
f AS MATERIALIZED (SELECT *, row_number() OVER o AS occurrence, first_value(doc_id) OVER o AS first_doc, first_value(pos) OVER o AS first_pos FROM w WINDOW o AS (PARTITION BY win ORDER BY doc_id, pos)),
r AS (SELECT DISTINCT doc_id, unnest(range(pos, least(pos + 3, n_lines))) AS p FROM f WHERE occurrence > 1
      EXCEPT SELECT doc_id, unnest(range(first_pos, least(first_pos + 3, n_lines))) AS p FROM f WHERE occurrence > 1 AND doc_id = first_doc AND pos - first_pos < 3),
g AS (SELECT doc_id, count(*) AS n_removed, string_agg(CAST(p AS VARCHAR), ',' ORDER BY p) AS removed_lines FROM r GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(removed_lines, '') AS removed_lines
FROM documents d LEFT JOIN c USING (doc_id) LEFT JOIN g USING (doc_id)
"""
