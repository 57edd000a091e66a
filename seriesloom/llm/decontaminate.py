"""Benchmark decontamination: prefix-filtered set join of item windows against documents.

Method: every benchmark item is cut into windows of ``size`` consecutive words (an
item with fewer words is one window).  A window is a set of short shingles that a
document must contain whole, so by the prefix-filter principle for containment 1.0
one shingle of each window is a necessary prefix.  The rarest one is taken, counted
over all documents.  Documents' shingles are joined with the prefix shingles; length
and positional bounds drop starts at which the window can't fit; what is left is
verified word by word over the item-sized window.

A benchmark of up to ``INDEX_WORDS`` words of distinct windows is one index that all workers hold; a larger
one is joined by shuffles, with two scans of the documents whatever its size: the first counts the
shingles that the benchmark has, the second emits the places of prefix shingles with the words around
them, which meet the windows of that prefix.  Both give the same rows.  The items that own a window are
joined to what was found, so a window may have any number of them.

Defined results: null or empty texts have no words; texts of any length are read whole; an item
without words has no window; of a window's shingles that are equally rare the one with the least hash,
then the first is its prefix; rows with a null item id mark words as hit but aren't listed; repeated items
are listed once; repeated document rows, and rows without an id, each get a row; an empty benchmark hits
nothing, and no documents give no rows; other columns of either table are ignored, so their names can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seriesloom.llm import bloom
from seriesloom.llm import textkit as K
from seriesloom.sources.tables import written

#: Words of distinct windows that one broadcast index holds (some 20 MB); a larger benchmark is joined by shuffles.
INDEX_WORDS = 1_000_000
#: Parts in which a prefix or a window that very many documents have is joined.
SALT = 16
#: Words of a shingle within a window.
SHINGLE = 3
_FLAGS = 1 << 20


class _Index:
    """The windows of a benchmark of bounded size, in arrays."""

    def __init__(self, windows: list[tuple[int, bytes]], size: int):
        self.size = size
        self.window = np.array([w for w, _ in windows], dtype=np.int64)
        self.words, self.length = _padded(np.frombuffer(b"".join(x for _, x in windows), dtype=np.uint64), np.array([len(x) // 8 for _, x in windows], dtype=np.int64), size)
        # shingles of each window, by shingle length (below SHINGLE only in very short items)
        self.shingles: dict[int, np.ndarray] = {}
        self.inside: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for k, value, row, offset in shingles_of(self.words, self.length):
            self.shingles[k], code = np.unique(value, return_inverse=True)
            self.inside[k] = code, row, offset
        self.prefix: dict[int, tuple] = {}

    def choose(self, counts: dict[int, np.ndarray]) -> None:
        """Keep the rarest shingle of each window (by the corpus counts, then by hash) as its prefix."""
        for k, (code, row, offset) in self.inside.items():
            order = np.lexsort((offset, self.shingles[k][code], counts[k][code], row))
            first = order[np.concatenate([[True], row[order][1:] != row[order][:-1]])]
            by_code = first[np.argsort(code[first], kind="stable")]
            used, at, n = np.unique(code[by_code], return_index=True, return_counts=True)
            self.prefix[k] = self.shingles[k][used], at, n, row[by_code], offset[by_code]
        self.inside = {}

    def lookup(self, k: int, values: np.ndarray, among: np.ndarray, flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of ``values`` that are in sorted ``among``, and where there."""
        near = np.flatnonzero(flags[(values & np.uint64(_FLAGS - 1)).astype(np.int64)])
        place = np.searchsorted(among, values[near])
        place[place == len(among)] = 0
        same = among[place] == values[near]
        return near[same], place[same]


def _padded(flat: np.ndarray, length: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of ``length`` words each, joined in ``flat``, as rows of ``size`` columns."""
    words = np.zeros((len(length), size), dtype=np.uint64)
    words[np.arange(size) < length[:, None]] = flat
    return words, length


def shingles_of(words: np.ndarray, length: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(k, hash, row, offset) of all shingles of windows, by their number of words k."""
    for k in sorted({int(min(SHINGLE, n)) for n in length}):
        rows = np.flatnonzero(np.minimum(length, SHINGLE) == k)
        value, row, offset = [], [], []
        for at in range(words.shape[1] - k + 1):
            fits = rows[length[rows] >= at + k]
            value.append(shingle(words[fits], np.full(len(fits), at), k))
            row.append(fits)
            offset.append(np.full(len(fits), at))
        yield k, np.concatenate(value), np.concatenate(row), np.concatenate(offset)


def shingle(words: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Shingle hash of k words from column ``at`` of each row."""
    rows, value = np.arange(len(words)), np.zeros(len(words), dtype=np.uint64)
    factors = K.mix(K.GOLDEN * np.arange(1, k + 1, dtype=np.uint64)) | np.uint64(1)
    for j in range(k):
        value += words[rows, at + j] * factors[j]
    return K.mix(value)


def _flags(among: np.ndarray) -> np.ndarray:
    flags = np.zeros(_FLAGS, dtype=bool)
    flags[(among & np.uint64(_FLAGS - 1)).astype(np.int64)] = True
    return flags


def _window_rows(size: int):
    """(item, words): each window of each item, as word hashes."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, offs in K.chunks(batch.column(1)):
                start, end, doc = K.words(buf, offs, K.ALNUM)
                hashes = K.span_hashes(buf, start, end, True).view(np.int64)
                count = np.bincount(doc, minlength=hi - lo)
                windows = np.where(count > 0, np.maximum(1, count - size + 1), 0)
                own = np.repeat(np.arange(hi - lo), windows)
                at = np.arange(len(own)) - np.repeat(np.cumsum(windows) - windows, windows) + (np.cumsum(count) - count)[own]
                length = np.minimum(count[own], size)
                for k in range(0, len(own), 1 << 16):
                    part = slice(k, k + (1 << 16))
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo).take(pa.array(own[part])), K.list_array(K.take_pieces(hashes, at[part], length[part]), length[part], pa.int64())], ["item", "words"])

    return K.tidied(rows)


def _windows(benchmark: DataFrame, item_col: str, text_col: str, size: int) -> tuple[DataFrame, DataFrame]:
    """((window, words): the distinct windows; (window, item): the items that own them)."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text"))
    owned = written(items.mapInArrow(_window_rows(size), "item string, words array<bigint>").distinct())
    windows = written(owned.select("words").distinct().select(F.monotonically_increasing_id().alias("window"), "words"))
    return windows, owned.filter(F.col("item").isNotNull()).join(windows, "words").select("window", "item")


def _index(windows: DataFrame, docs: DataFrame, size: int, index_words: int) -> _Index | None:
    """The index of a benchmark that fits in one."""
    if windows.count() * size > index_words:
        return None
    index = _Index([(r.window, np.array(r.words, dtype=np.int64).tobytes()) for r in windows.collect()], size)
    index.choose(_counts(docs, index))
    return index


def _counts(documents: DataFrame, index: _Index) -> dict[int, np.ndarray]:
    """How often each shingle of the index occurs in all documents."""
    shared = documents.sparkSession.sparkContext.broadcast({k: (v, _flags(v)) for k, v in index.shingles.items()})

    def count(batches):
        for batch in batches:
            total = {k: np.zeros(len(v), dtype=np.int64) for k, (v, _) in shared.value.items()}
            for _, _, buf, offs in K.chunks(batch.column(0)):
                start, end, doc = K.words(buf, offs, K.ALNUM)
                hashes = K.span_hashes(buf, start, end, True)
                for k, (among, flags) in shared.value.items():
                    value, _, _ = K.window_hashes(hashes, doc, len(offs) - 1, k, short=False)
                    _, place = index_lookup(value, among, flags)
                    total[k] += np.bincount(place, minlength=len(among))
            for k, x in total.items():
                some = np.flatnonzero(x)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), k)), pa.array(some), pa.array(x[some])], ["k", "code", "n"])

    counts = {k: np.zeros(len(v), dtype=np.int64) for k, v in index.shingles.items()}
    for r in documents.select(F.col("text")).mapInArrow(count, "k bigint, code bigint, n bigint").groupBy("k", "code").agg(F.sum("n").alias("n")).collect():
        counts[r.k][r.code] = r.n
    shared.unpersist()
    return counts


def index_lookup(value, among, flags):
    return _Index.lookup(None, 0, value, among, flags)


def occurrences(index: _Index, flags: dict, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number of each word, words of each text, and first word and window of each occurrence."""
    n = len(offs) - 1
    start, end, doc = K.words(buf, offs, K.ALNUM)
    hashes = K.span_hashes(buf, start, end, True)
    count = np.bincount(doc, minlength=n)
    last = np.cumsum(count)
    hit_at, hit_row = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k, (among, first, many, rows, offset) in index.prefix.items():
        value, at, _ = K.window_hashes(hashes, doc, n, k, short=False)
        near, place = index_lookup(value, among, flags[k])
        pick = K.take_pieces(np.arange(len(rows)), first[place], many[place])
        found = np.repeat(at[near], many[place])
        begin, row, own = found - offset[pick], rows[pick], doc[found]
        fits = (begin >= last[own] - count[own]) & (begin + index.length[row] <= last[own])  # length and position
        begin, row = begin[fits], row[fits]
        same = np.ones(len(begin), dtype=bool)
        for j in range(index.size):
            check = index.length[row] > j
            same[check] &= hashes[begin[check] + j] == index.words[row[check], j]
        hit_at.append(begin[same])
        hit_row.append(row[same])
    return doc, count, np.concatenate(hit_at), np.concatenate(hit_row)


def without_contaminated(documents: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", size: int = 10, index_words: int = INDEX_WORDS) -> DataFrame:
    """The rows of ``documents`` in which no benchmark window occurs, as they are; rows of one text stay or go together."""
    texts = documents.select(F.col(text_col).cast("string").alias("text"))
    windows, _ = _windows(benchmark, item_col, item_text_col, size)
    index = _index(windows, texts, size, index_words)
    if index:
        shared = documents.sparkSession.sparkContext.broadcast((index, {k: _flags(p[0]) for k, p in index.prefix.items()}))
        return documents.mapInArrow(_keeper(shared, documents.columns.index(text_col)), documents.schema)
    name = lambda text: F.sha2(text.cast("string"), 256)
    placed, hits = _joined(texts.withColumn("id", name(F.col("text"))), "string", windows, size)
    gone = placed.filter("window_prefix IS NULL").join(hits.select("row").distinct(), "row", "left_semi").select(F.col("id").alias("gone_text_")).distinct()
    return documents.join(gone, name(documents[f"`{text_col}`"]) == gone.gone_text_, "left_anti")


def _keeper(shared, at: int):
    def keep(batches):
        index, flags = shared.value
        for batch in batches:
            for lo, hi, buf, offs in K.chunks(batch.column(at)):
                doc, _, begin, _ = occurrences(index, flags, buf, offs)
                clean = np.ones(hi - lo, dtype=bool)
                clean[doc[begin]] = False
                yield batch.slice(lo, hi - lo).filter(pa.array(clean))

    return keep


_FOUND = "row bigint, doc_id bigint, n_words bigint, n_hit bigint, spans array<struct<start:bigint,end:bigint>>, windows array<bigint>"


def _matches(docs: DataFrame, index: _Index) -> DataFrame:
    """Merged hit spans (in words) and occurring windows of every document row, by an index."""
    shared = docs.sparkSession.sparkContext.broadcast((index, {k: _flags(p[0]) for k, p in index.prefix.items()}))

    def match(batches):
        index, flags = shared.value
        for batch in batches:
            for lo, hi, buf, offs in K.chunks(batch.column(2)):
                n = hi - lo
                doc, count, begin, row = occurrences(index, flags, buf, offs)
                last = np.cumsum(count)
                covered = np.zeros(len(doc) + 1, dtype=np.int64)
                np.add.at(covered, begin, 1)
                np.add.at(covered, begin + index.length[row], -1)
                hit = np.cumsum(covered)[:-1] > 0
                change = hit.copy()
                change[1:] &= ~(hit[:-1] & (doc[1:] == doc[:-1]))
                stop = hit.copy()
                stop[:-1] &= ~(hit[1:] & (doc[1:] == doc[:-1]))
                s, e = np.flatnonzero(change), np.flatnonzero(stop) + 1
                base = last[doc[s]] - count[doc[s]] if len(s) else s
                spans = pa.ListArray.from_arrays(pa.array(K.bounds(doc[s], n), pa.int32()), pa.StructArray.from_arrays([pa.array(s - base, pa.int64()), pa.array(e - base, pa.int64())], ["start", "end"]))
                pair = np.unique(np.stack([doc[begin], index.window[row]]), axis=1)
                windows = K.list_array(pair[1], np.bincount(pair[0], minlength=n), pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, n), batch.column(1).slice(lo, n), pa.array(count), pa.array(np.bincount(doc[hit], minlength=n)), spans, windows], ["row", "doc_id", "n_words", "n_hit", "spans", "windows"])

    found = written(docs.mapInArrow(K.tidied(match), _FOUND))
    shared.unpersist()
    return found


def _shingle_rows(size: int):
    """(window, offset, value): all shingles of each window."""

    def rows(batches):
        for batch in batches:
            lists = batch.column(1)
            words, length = _padded(lists.flatten().to_numpy().view(np.uint64), np.diff(lists.offsets.to_numpy()).astype(np.int64), size)
            for _, value, row, offset in shingles_of(words, length):
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(offset), pa.array(value.view(np.int64))], ["window", "offset", "value"])

    return K.tidied(rows)


def _counted(shared):
    """(value, n): shingles of a run of texts that the bits may hold, and how often."""

    def count(batches):
        kinds, bits = shared.value
        for batch in batches:
            for _, _, buf, offs in K.chunks(batch.column(0)):
                start, end, doc = K.words(buf, offs, K.ALNUM)
                hashes = K.span_hashes(buf, start, end, True)
                for k in kinds:
                    value, _, _ = K.window_hashes(hashes, doc, len(offs) - 1, k, short=False)
                    value, n = np.unique(value[bloom.may_hold(bits, value.view(np.int64))], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(n)], ["value", "n"])

    return K.tidied(count)


def _placed(shared, size: int):
    """A row with its number of words for each document row, and one for each place at which it may
    have a prefix shingle: the first word, and up to ``size`` - 1 words before and behind it."""

    def place(batches):
        kinds, bits = shared.value
        for batch in batches:
            row, name = batch.column(0), batch.column(1)
            for lo, hi, buf, offs in K.chunks(batch.column(2)):
                start, end, doc = K.words(buf, offs, K.ALNUM)
                hashes, first = K.span_hashes(buf, start, end, True), K.bounds(doc, hi - lo)
                blank = [pa.nulls(hi - lo, t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([row.slice(lo, hi - lo), name.slice(lo, hi - lo), pa.array(np.diff(first)), *blank], names)
                for k in kinds:
                    value, at, own = K.window_hashes(hashes, doc, hi - lo, k, short=False)
                    near = np.flatnonzero(bloom.may_hold(bits, value.view(np.int64)))
                    for some in (near[i : i + (1 << 14)] for i in range(0, len(near), 1 << 14)):
                        begin, stop = np.maximum(first[own[some]], at[some] - size + 1), np.minimum(first[own[some] + 1], at[some] + size)
                        of = pa.array(lo + own[some])
                        around = K.list_array(K.take_pieces(hashes.view(np.int64), begin, stop - begin), stop - begin, pa.int64())
                        yield pa.RecordBatch.from_arrays([row.take(of), name.take(of), pa.nulls(len(some), pa.int64()), pa.array(value[some].view(np.int64)), pa.array(at[some] - first[own[some]]), pa.array(at[some] - begin), around], names)

    names = ["row", "id", "n_words", "window_prefix", "at", "lead", "around"]
    return K.tidied(place)


def _joined(docs: DataFrame, id_type: str, windows: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """(what :func:`_placed` gives of (id, text); (row, begin, length, window): all occurrences), by shuffles.

    The Bloom bits that workers hold are of bounded size.  They only spare shuffled rows: with more than some
    30 million shingles most places pass them, and the joins decide as before.
    """
    spark = docs.sparkSession
    kinds = [r.k for r in windows.select(F.least(F.size("words"), F.lit(SHINGLE)).alias("k")).distinct().collect()]
    shingles = written(windows.mapInArrow(_shingle_rows(size), "window bigint, offset bigint, value bigint"))
    shared = spark.sparkContext.broadcast((kinds, bloom.bits_of(shingles.select("value").distinct())))
    counts = docs.select("text").mapInArrow(_counted(shared), "value bigint, n bigint").groupBy("value").agg(F.sum("n").alias("n"))
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "value", "offset"))
    prefix = written(shingles.join(counts, "value", "left").groupBy("window").agg(rarest.alias("prefix")).select("window", "prefix.value", "prefix.offset"))
    shared.unpersist()
    shared = spark.sparkContext.broadcast((kinds, bloom.bits_of(prefix.select("value").distinct())))
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "id", "text")
    placed = written(numbered.mapInArrow(_placed(shared, size), f"row bigint, id {id_type}, n_words bigint, window_prefix bigint, at bigint, lead bigint, around array<bigint>"))
    shared.unpersist()
    w = prefix.join(windows, "window").select("window", "value", "offset", "words", F.size("words").alias("length"), F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt"))
    c = placed.filter(F.col("window_prefix").isNotNull()).withColumn("part", F.pmod(F.xxhash64("row", "at"), F.lit(SALT)).cast("int"))
    since = (F.col("lead") - F.col("offset")).cast("int")
    fits = (since >= 0) & (since + F.col("length") <= F.size("around"))  # length and position
    same = F.slice("around", F.greatest(since, F.lit(0)) + 1, F.col("length")) == F.col("words")
    met = c.join(w, (c.window_prefix == w.value) & (c.part == w.salt)).filter(fits & same)
    return placed, written(met.select("row", (F.col("at") - F.col("offset")).alias("begin"), "length", "window"))


def _matches_joined(docs: DataFrame, windows: DataFrame, size: int) -> DataFrame:
    """What :func:`_matches` gives, by shuffles."""
    placed, hits = _joined(docs.select(F.col("doc_id").alias("id"), "text"), "bigint", windows, size)
    in_row = Window.partitionBy("row").orderBy("begin", F.desc("length"), "window")  # the hits of one document
    upto = F.max(F.col("begin") + F.col("length")).over(in_row.rowsBetween(Window.unboundedPreceding, -1))
    islands = hits.withColumn("new", F.when(F.col("begin") <= upto, 0).otherwise(1))
    islands = islands.withColumn("island", F.sum("new").over(in_row.rowsBetween(Window.unboundedPreceding, 0)))
    spans = islands.groupBy("row", "island").agg(F.min("begin").alias("start"), F.max(F.col("begin") + F.col("length")).alias("end"))
    spans = spans.groupBy("row").agg(F.sum(F.col("end") - F.col("start")).alias("n_hit"), F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
    hit = spans.join(hits.groupBy("row").agg(F.collect_set("window").alias("windows")), "row")
    docs = placed.filter("window_prefix IS NULL").select("row", F.col("id").alias("doc_id"), "n_words").join(hit, "row", "left")
    none = [F.coalesce(c, F.array().cast(t)).alias(c) for c, t in (("spans", "array<struct<start:bigint,end:bigint>>"), ("windows", "array<bigint>"))]
    return written(docs.select("row", "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"), *none))


def decontaminate(documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", size: int = 10, index_words: int = INDEX_WORDS) -> DataFrame:
    """Benchmark windows in every document row.

    Returns (doc_id, n_words, n_hit, n_items, items, spans, contaminated): ``items`` are
    the ids of items with an occurring window, sorted as strings; ``spans`` the merged
    hit ranges in words, end exclusive.
    """
    docs = documents.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    windows, owners = _windows(benchmark, item_col, item_text_col, size)
    index = _index(windows, docs.select("text"), size, index_words)
    if index:
        found = _matches(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"), index)
    else:
        found = _matches_joined(docs, windows, size)
    # the items of what was found; rows without hits stay where they are
    hit = found.filter("n_hit > 0").select("row", F.explode("windows").alias("window"), F.pmod(F.xxhash64("row"), F.lit(SALT)).cast("int").alias("salt"))
    owners = owners.select("window", "item", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt"))
    items = hit.join(owners, ["window", "salt"]).select("row", "item").distinct().groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("items"))
    names, none = ["doc_id", "n_words", "n_hit", "items", "spans"], F.array().cast("array<string>")
    hit = found.filter("n_hit > 0").join(items, "row", "left").withColumn("items", F.coalesce("items", none))
    found = found.filter("n_hit = 0").withColumn("items", none).select(*names).unionByName(hit.select(*names))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), "items", "spans", (F.col("n_hit") > 0).alias("contaminated"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over all of ``documents`` and ``benchmark``."""
    found = decontaminate(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item, len(w) AS n, w[i:i + 9] AS win FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(win) AS k FROM bw),
dw AS (SELECT doc_id, i, k, w[i:i + k - 1] AS win FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, sizes WHERE len(w) >= k)),
hits AS (SELECT doc_id, i, k, item FROM dw JOIN bw USING (win)),
hitwords AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
hititems AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hitwords USING (doc_id) LEFT JOIN hititems USING (doc_id)
"""
