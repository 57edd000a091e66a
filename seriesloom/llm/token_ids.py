"""Token-ID / binary output with a minimal perfect hash index.

Documents are ordered by id, encoded with a public tokenizer, and written as binary
shards.  A shard holds raw little-endian ids and an index that maps each document key
to where its ids are: a minimal perfect hash in levels (each level is a bit array; a
key whose bit nobody else hit is placed, the others go on to the next level; the rank
of the bit is the key's slot), with a fingerprint per slot, so a lookup reads a few bits
and one slot whatever the number of keys.  Beside the shards lies a table of them in order
of key, which leads from a key to the shards that can hold it.

Shard layout, little-endian:
  8 bytes "SLTOKEN1"; 10 int64: partition, shard, documents, keys, ids, bytes of an id,
  levels, bits, smallest key, largest key; then
  int64 bits of each level; uint64 bit words; int64 rank before each bit word;
  uint32 fingerprint of each slot; int64 first document of each slot;
  int64 document ids; uint8 null marks of the ids; int64 offsets of the documents' ids (documents + 1);
  the ids; one newline that Spark's writer adds.

Below the folder: ``shards`` has the shard files, ``documents`` (Parquet) one row per document
and ``files`` (Parquet, by key) one row per shard: partition, shard, path, smallest and largest
key, documents, ids, and the ids of all shards before it.  Both tables are made from the shard
files, which are read once for that.

Files are written by Spark's own text writer (one shard is one value, one file) and read
by its binaryFile source, so any file system and lost executors are dealt with by Spark.

Defined results: null texts have no ids but the end id; a null document id comes first and
isn't in the index; rows that share an id, or have none, are in order of their text's hash and
may lie in several shards, each of which finds its first, and ``fetch`` gives all; texts of any
length are encoded whole; ids are integers; other columns are ignored; an empty table gives no
shards.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seriesloom.llm import textkit as K
from seriesloom.sources.tables import shared_folder

MAGIC = b"SLTOKEN1"
#: Least and most bytes of ids after which a shard is closed (a task holds some five times as much), and the
#: number of shards that its size is chosen for between these.
SHARD_BYTES, MOST_SHARD_BYTES, SHARDS = 1 << 20, 1 << 26, 200_000
#: Bits per key of a level of the hash.
GAMMA = 2.0
#: Words that a worker remembers the ids of (some 30 bytes each); beyond, it starts over.
WORDS_KEPT = 1_000_000
#: A word pattern known to keep letters together and to stop at white space, and a
#: character for private use that stands between words.
KNOWN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SEPARATOR = "\U0010fffd"
_HEAD = "<8s10q"
_LETTERS = np.zeros(256, dtype=bool)
_LETTERS[65:91] = _LETTERS[97:123] = True
_STOPS = np.zeros(256, dtype=bool)
_STOPS[[44, 46]] = True


class WordEncoder:
    """Ids of whole texts, by words where the tokenizer's description allows it.

    A tokenizer whose normaliser and pre-tokenizer are of the known forms never joins across
    ASCII white space: words between it are encoded once and remembered by hash.  A word of
    ASCII letters is then one piece in lower case, and a comma or full stop behind it another,
    so such words are remembered in lower case without it.  New words are encoded together, as
    one text; the ends of words, or a separator that no word has, tell their ids apart.  With
    any other tokenizer whole texts are encoded.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks use the cores
        self.tokenizer = Tokenizer.from_file(path)
        self.by_word = splits_at_spaces(json.loads(self.tokenizer.to_str()))
        self.kind = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.separator = self._ids(SEPARATOR) if self.by_word else None
        self.clear()

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.uint32)

    def clear(self) -> None:
        """Forget all words.  Two sorted tables of (hash, where its ids begin, how many): a large
        one, and a small one for new words, so that learning doesn't sort the large one anew."""
        none = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.uint32)
        self.old, self.new = none, none
        self.ids, self.n_ids = np.zeros(1 << 16, dtype=self.kind), 0

    @staticmethod
    def _merged(a, b):
        keys = np.concatenate([a[0], b[0]])
        order = np.argsort(keys, kind="stable")
        return keys[order], np.concatenate([a[1], b[1]])[order], np.concatenate([a[2], b[2]])[order]

    def _find(self, unique: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether each hash is known, and where its ids are."""
        known, at, n = np.zeros(len(unique), dtype=bool), np.zeros(len(unique), np.int64), np.zeros(len(unique), np.int64)
        for keys, begin, count in (self.old, self.new):
            if len(keys):
                place = np.searchsorted(keys, unique)
                place[place == len(keys)] = 0
                here = keys[place] == unique
                known |= here
                at[here], n[here] = begin[place[here]], count[place[here]]
        return known, at, n

    def encode(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, joined, and their number in each text."""
        if not self.by_word:
            found = [self.tokenizer.encode(buf[a:b].tobytes().decode(), add_special_tokens=False).ids for a, b in zip(offs[:-1], offs[1:])]
            return np.array([i for x in found for i in x], dtype=np.uint32), np.array([len(x) for x in found], dtype=np.int64)
        start, end, doc = K.words(buf, offs, K.SPACED)
        if not len(start):
            return np.zeros(0, dtype=np.uint32), np.zeros(len(offs) - 1, dtype=np.int64)
        letters = np.concatenate([np.zeros(1, np.int32), np.cumsum(_LETTERS[buf], dtype=np.int32)])
        stop = _STOPS[buf[end - 1]] & (end - start > 1)
        inner = end - stop
        plain = letters[inner] - letters[start] == inner - start
        stop &= plain
        other = np.flatnonzero(~plain)
        # each word is a piece, and each comma or full stop split off is one behind it
        piece = np.repeat(np.arange(len(start)), 1 + stop)
        behind = np.zeros(len(piece), dtype=bool)
        behind[1:] = piece[1:] == piece[:-1]
        piece_start = np.where(behind, end[piece] - 1, start[piece])
        piece_end = np.where(behind | ~stop[piece], end[piece], end[piece] - 1)
        hashes = K.span_hashes(buf, piece_start, piece_end, True)
        if len(other):  # hashed as they are
            n = end[other] - start[other]
            at = np.cumsum(n) - n
            exact = K.span_hashes(K.take_pieces(buf, start[other], n), at, at + n, False) ^ K.GOLDEN
            hashes[np.searchsorted(piece, other)] = exact
        is_plain = plain[piece]
        code, unique = pd.factorize(hashes)
        order = np.argsort(unique)
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        code, unique = rank[code], unique[order]
        first = np.empty(len(unique), dtype=np.int64)
        first[code[::-1]] = np.arange(len(code) - 1, -1, -1)
        self._learn(buf, unique, piece_start[first], piece_end[first], is_plain[first])
        _, at, length = self._find(unique)
        n = length[code]
        return K.take_pieces(self.ids, at[code], n).astype(np.uint32), np.bincount(doc[piece], n, minlength=len(offs) - 1).astype(np.int64)

    def _learn(self, buf, unique, start, end, is_plain) -> None:
        if len(self.old[0]) + len(self.new[0]) > WORDS_KEPT:
            self.clear()
        new = np.flatnonzero(~self._find(unique)[0])
        if not len(new):
            return
        folded = np.flatnonzero(is_plain[new])
        whole = np.flatnonzero(~is_plain[new])
        parts, n = [], np.zeros(len(new), dtype=np.int64)
        for which, encode in ((folded, self._letters), (whole, self._others)):
            if len(which):
                ids, n[which] = encode([buf[a:b].tobytes() for a, b in zip(start[new[which]], end[new[which]])])
                parts.append(ids)
        order = np.concatenate([folded, whole])
        at = np.empty(len(new), dtype=np.uint32)
        at[order] = self.n_ids + np.cumsum(n[order]) - n[order]
        total = self.n_ids + int(n.sum())
        if total > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.n_ids], np.zeros(max(total, 2 * len(self.ids)) - self.n_ids, dtype=self.kind)])
        self.ids[self.n_ids : total] = np.concatenate(parts)
        self.n_ids = total
        self.new = self._merged(self.new, (unique[new], at, n.astype(np.uint32)))
        if len(self.new[0]) > 30_000 + len(self.old[0]) // 8:
            self.old, self.new = self._merged(self.old, self.new), tuple(x[:0] for x in self.new)

    def _letters(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of letters or single stops: one piece each, so the model alone decides."""
        tokenize = self.tokenizer.model.tokenize
        found = [[t.id for t in tokenize(w)] for w in b" ".join(words).decode().lower().split(" ")]
        return np.fromiter(chain.from_iterable(found), dtype=np.uint32), np.fromiter(map(len, found), dtype=np.int64, count=len(found))

    def _others(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of any other words, with the separator between them."""
        raw = SEPARATOR.encode()
        if any(raw in w for w in words):
            found = [self._ids(w.decode()) for w in words]
            return np.concatenate(found), np.array([len(x) for x in found], dtype=np.int64)
        ids, mark = self._ids(f" {SEPARATOR} ".encode().join(words).decode()), self.separator
        here = np.ones(max(0, len(ids) - len(mark) + 1), dtype=bool)
        for k, i in enumerate(mark):
            here &= ids[k : k + len(here)] == i
        at = np.flatnonzero(here)
        if len(at) != len(words) - 1:
            raise ValueError("the separator isn't encoded alone")
        keep = np.ones(len(ids), dtype=bool)
        keep[(at[:, None] + np.arange(len(mark))[None, :]).reshape(-1)] = False
        return ids[keep], np.diff(np.concatenate([[-len(mark)], at, [len(ids)]])) - len(mark)


def splits_at_spaces(description: dict) -> bool:
    """Whether a tokenizer, by its description, encodes words between ASCII white space on their
    own, and a word of ASCII letters as one piece in lower case: known forms only."""
    steps = lambda x, name: (x or {}).get(name) or ([x] if x else [])
    normal = steps(description.get("normalizer"), "normalizers")
    split = steps(description.get("pre_tokenizer"), "pretokenizers")
    model, added = description.get("model") or {}, description.get("added_tokens") or []
    return (
        [x["type"] for x in normal] == ["NFC", "Replace", "Lowercase"] and normal[1]["pattern"] == {"Regex": r"\s+"} and normal[1]["content"] == " "
        and [x["type"] for x in split] == ["Split", "ByteLevel"] and split[0]["pattern"] == {"Regex": KNOWN_PATTERN} and split[0]["behavior"] == "Removed" and split[0]["invert"]
        and not split[1]["add_prefix_space"] and not split[1]["use_regex"]
        and model.get("type") == "BPE" and bool(model.get("end_of_word_suffix")) and not model.get("dropout") and not model.get("continuing_subword_prefix") and not model.get("ignore_merges")
        and description.get("post_processor") is None and description.get("truncation") is None and description.get("padding") is None
        and not any(x["lstrip"] or x["rstrip"] or x["single_word"] or x["normalized"] or x["content"].isalpha() or any(c.isspace() for c in x["content"]) for x in added)
    )


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The worker's encoder for this tokenizer; it keeps up to WORDS_KEPT words between tasks."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def _level_hash(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (K.mix(keys ^ K.mix(np.full(1, level + 1, dtype=np.uint64) * K.GOLDEN)) % np.uint64(size)).astype(np.int64)


def _fingerprint(keys: np.ndarray) -> np.ndarray:
    return (K.mix(keys + K.MIX_A) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    """Minimal perfect hash over distinct unsigned 64-bit keys."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray, ranks: np.ndarray):
        self.sizes, self.bits, self.ranks = sizes, bits, ranks
        self.first = np.cumsum(sizes) - sizes

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, parts, left = [], [], keys
        while len(left):
            size = -(-max(64, int(GAMMA * len(left))) // 64) * 64
            place = _level_hash(left, len(sizes), size)
            alone = np.bincount(place, minlength=size) == 1
            sizes.append(size)
            parts.append(alone)
            left = left[~alone[place]]
        flat = np.concatenate(parts) if parts else np.zeros(0, dtype=bool)
        words = np.packbits(flat, bitorder="little").view("<u8") if len(flat) else np.zeros(0, "<u8")
        in_word = flat.reshape(-1, 64).sum(axis=1) if len(flat) else np.zeros(0, np.int64)
        return cls(np.array(sizes, dtype="<i8"), words, (np.cumsum(in_word) - in_word).astype("<i8"))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; for other keys some slot, or -1."""
        slot = np.full(len(keys), -1, dtype=np.int64)
        left = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            if not len(left):
                break
            bit = self.first[level] + _level_hash(keys[left], level, int(size))
            word, inside = self.bits[bit // 64], (bit % 64).astype(np.uint64)
            here = (word >> inside & np.uint64(1)).astype(bool)
            below = word[here] & ((np.uint64(1) << inside[here]) - np.uint64(1))
            slot[left[here]] = self.ranks[bit[here] // 64] + np.bitwise_count(below)
            left = left[~here]
        return slot


def pack_shard(partition: int, shard: int, doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray, id_bytes: int) -> bytes:
    """One shard's bytes; documents are in ascending order of id, nulls first."""
    null = np.array([d is None for d in doc_ids], dtype=np.uint8)
    docs = np.array([0 if d is None else d for d in doc_ids], dtype="<i8")
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype("<i8")
    key, first = np.unique(docs[null == 0], return_index=True)
    first = first + int(null.sum())
    unsigned = key.astype("<i8").view("<u8")
    table = PerfectHash.build(unsigned)
    slot = table.slots(unsigned)
    prints, at = np.empty(len(key), "<u4"), np.empty(len(key), "<i8")
    prints[slot], at[slot] = _fingerprint(unsigned), first
    head = struct.pack(_HEAD, MAGIC, partition, shard, len(docs), len(key), len(ids), id_bytes, len(table.sizes), int(table.sizes.sum()), int(key[0]) if len(key) else 0, int(key[-1]) if len(key) else -1)
    return b"".join([head, *map(memoryview, (table.sizes, table.bits, table.ranks, prints, at, docs, null, offsets, ids.astype(f"<u{id_bytes}", copy=False)))])


class Shard:
    """A shard's bytes (or a buffer of them), read in place."""

    def __init__(self, data):
        magic, self.partition, self.shard, n_docs, n_keys, n_ids, id_bytes, levels, bits, self.min_key, self.max_key = struct.unpack_from(_HEAD, data)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        self._at = struct.calcsize(_HEAD)

        def take(kind: str, n: int) -> np.ndarray:
            x = np.frombuffer(data, dtype=kind, count=n, offset=self._at)
            self._at += x.nbytes
            return x

        sizes, words = take("<i8", levels), bits // 64
        self.table = PerfectHash(sizes, take("<u8", words), take("<i8", words))
        self.prints, self.first = take("<u4", n_keys), take("<i8", n_keys)
        self.docs, self.null, self.offsets = take("<i8", n_docs), take("u1", n_docs).astype(bool), take("<i8", n_docs + 1)
        self.ids = take(f"<u{id_bytes}", n_ids)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The first document with each key, or -1 where the fingerprint differs."""
        if not len(self.first):
            return np.full(len(keys), -1, dtype=np.int64)
        unsigned = np.asarray(keys, dtype="<i8").view("<u8")
        slot = self.table.slots(unsigned)
        same = (slot >= 0) & (self.prints[slot] == _fingerprint(unsigned))
        return np.where(same, self.first[slot], -1)

    def documents_of(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First document and number of documents of each key (they are next to each other)."""
        first = self.find(keys)
        begin = int(self.null.sum())
        end = np.searchsorted(self.docs[begin:], keys, "right") + begin
        return first, np.where(first >= 0, np.maximum(end - first, 1), 0)


def _encode_rows(path: str, end_id: int, id_bytes: int, shard_bytes: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use, partition, shard = encoder(path), TaskContext.get().partitionId(), 0
        docs, counts, parts, held = [], [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal shard, docs, counts, parts, held
            data = pack_shard(partition, shard, docs, np.concatenate(counts), np.concatenate(parts), id_bytes)
            shard, docs, counts, parts, held = shard + 1, [], [], [], 0
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["value"])

        for batch in batches:
            for lo, hi, buf, offs in K.chunks(batch.column(1), min(1 << 19, 2 * shard_bytes)):
                ids, n = use.encode(buf, offs)
                joined = np.insert(ids, np.cumsum(n), end_id).astype(f"<u{id_bytes}")
                docs += batch.column(0).slice(lo, hi - lo).to_pylist()
                counts.append(n + 1)
                parts.append(joined)
                held += joined.nbytes
                if held >= shard_bytes:
                    yield close()
        if docs:
            yield close()

    return K.tidied(encode)


def write_tokens(documents: DataFrame, folder: str, tokenizer: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", partitions: int | None = None, shard_bytes: int | None = None) -> None:
    """Write all documents' ids below ``folder``, in ascending order of id, and the tables of
    documents and files.

    ``tokenizer`` is the path of a tokenizer file that every machine has.  Without ``shard_bytes`` a
    shard's size follows the texts' bytes, so that very large corpora don't become very many small files.
    """
    from tokenizers import Tokenizer

    if shard_bytes is None:  # ids take some half of a text's bytes
        total = documents.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
        shard_bytes = min(max(SHARD_BYTES, total // (2 * SHARDS)), MOST_SHARD_BYTES)
    id_bytes = 2 if max(Tokenizer.from_file(tokenizer).get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    order = [F.col("doc_id").asc_nulls_first(), F.col("text_hash")]
    d = documents.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.xxhash64(F.col(text_col)).alias("text_hash"))
    ordered = d.repartitionByRange(partitions, *order) if partitions else d.repartitionByRange(*order)
    shards = ordered.sortWithinPartitions(*order).mapInArrow(_encode_rows(tokenizer, end_id, id_bytes, shard_bytes), "value binary")
    shards.select(F.col("value").cast("string")).write.mode("overwrite").option("maxRecordsPerFile", 1).option("compression", "none").text(f"{folder}/shards")
    _catalogue(documents.sparkSession, folder)


def _catalogue(spark: SparkSession, folder: str) -> None:
    """Read every shard file once and write the tables ``documents`` and ``files``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{folder}/shards").filter("length > 0")
    rows = files.select("path", "content").mapInArrow(K.tidied(_document_rows), "path string, partition bigint, shard bigint, doc_id bigint, inside bigint, n_tokens bigint, ids_crc32 bigint, shard_ids bigint")
    rows.write.mode("overwrite").parquet(f"{folder}/documents")
    docs = spark.read.schema(rows.schema).parquet(f"{folder}/documents")
    shards = docs.groupBy("partition", "shard", "path").agg(F.min("doc_id").alias("min_key"), F.max("doc_id").alias("max_key"), F.count("*").alias("docs"), F.max("shard_ids").alias("ids"))
    before = Window.partitionBy("partition").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    within = shards.withColumn("in_partition", F.coalesce(F.sum("ids").over(before), F.lit(0)))
    earlier = Window.orderBy("partition").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    across = shards.groupBy("partition").agg(F.sum("ids").alias("n")).select("partition", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    placed = within.join(across, "partition").withColumn("shard_start", F.col("base") + F.col("in_partition")).drop("base", "in_partition")
    placed.repartitionByRange("min_key").sortWithinPartitions("min_key").write.mode("overwrite").parquet(f"{folder}/files")


def _document_rows(batches):
    """Each document of each shard, looked up by its key in the shard's index."""
    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1)):
            s = Shard(content.as_buffer())
            keys = s.docs[~s.null]
            first, _ = s.documents_of(keys)
            if (first < 0).any() or (s.docs[first] != keys).any():
                raise ValueError("a document's key isn't in its shard's index")
            # rows that share a key follow the one that the index has
            row = np.arange(len(s.docs))
            row[~s.null] = first + (np.flatnonzero(~s.null) - np.searchsorted(keys, keys, "left") - int(s.null.sum()))
            n = s.offsets[row + 1] - s.offsets[row]
            crc = [zlib.crc32(s.ids[s.offsets[r] : s.offsets[r + 1]].astype("<u4")) for r in row]
            same = lambda x: pa.array(np.full(len(row), x))
            yield pa.RecordBatch.from_arrays([pa.array([path.as_py()] * len(row)), same(s.partition), same(s.shard), pa.array(s.docs, mask=s.null), pa.array(s.offsets[row]), pa.array(n), pa.array(crc, pa.int64()), same(len(s.ids))], ["path", "partition", "shard", "doc_id", "inside", "n_tokens", "ids_crc32", "shard_ids"])


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files.

    Each was looked up by its key in its shard's index.  ``start`` counts the ids of all
    documents before it.
    """
    docs = spark.read.parquet(f"{folder}/documents").drop("path", "shard_ids")
    place = spark.read.parquet(f"{folder}/files").select("partition", "shard", "shard_start")
    return docs.join(place, ["partition", "shard"]).select("doc_id", (F.col("shard_start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def fetch(spark: SparkSession, folder: str, keys: list[int]) -> DataFrame:
    """(doc_id, ids) of the documents with these keys; only the shards that the table of files
    names for them are opened.  ``keys`` and their shards' paths pass through the driver."""
    wanted = np.array(sorted(set(keys)), dtype=np.int64)
    schema = "doc_id bigint, ids array<bigint>"
    if not len(wanted):
        return spark.createDataFrame([], schema)
    def holding(batches):
        """Shards with a wanted key between their smallest and largest one, by binary search."""
        for batch in batches:
            low, high = (batch.column(c).to_numpy(zero_copy_only=False) for c in (1, 2))
            yield batch.select([0]).filter(pa.array(np.searchsorted(wanted, low, "left") < np.searchsorted(wanted, high, "right")))

    near = (F.col("max_key") >= int(wanted[0])) & (F.col("min_key") <= int(wanted[-1]))
    files = spark.read.parquet(f"{folder}/files").filter(near).select("path", "min_key", "max_key")
    paths = [r.path for r in files.mapInArrow(holding, "path string").collect()]
    if not paths:
        return spark.createDataFrame([], schema)

    def find(batches):
        for batch in batches:
            for content in batch.column(0):
                s = Shard(content.as_buffer())
                here = wanted[(wanted >= s.min_key) & (wanted <= s.max_key)]
                first, many = s.documents_of(here)
                row = K.take_pieces(np.arange(len(s.docs)), first[first >= 0], many[first >= 0])
                row = row[np.isin(s.docs[row], here)]
                n = s.offsets[row + 1] - s.offsets[row]
                yield pa.RecordBatch.from_arrays([pa.array(s.docs[row]), K.list_array(K.take_pieces(s.ids, s.offsets[row], n).astype(np.int64), n, pa.int64())], ["doc_id", "ids"])

    return spark.read.format("binaryFile").load(paths).select("content").mapInArrow(find, schema)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def tokenized(spark: SparkSession, documents: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write ``documents`` to a new shared folder and read the files back."""
    folder = shared_folder(spark)
    write_tokens(documents, folder, tokenizer or default_tokenizer())
    return read_documents(spark, folder)


def op6_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over all of ``documents``."""
    return tokenized(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
