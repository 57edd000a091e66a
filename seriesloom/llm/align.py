"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text.

Both tokenizers' tokens tile a text (with a space before it), so their ends are two rising lists of byte
offsets.  An interval between two shared ends is divided at the shared end nearest to its middle, found
by bisecting the other list for ends around the middle, in widening steps; both halves go on likewise,
and an interval without a shared end inside is a leaf: a group of tokens of either side.  All texts of a
run, and all intervals of a level, are divided at once.

Texts are encoded by units: at a single space between two characters that aren't white space neither
tokenizer joins what is before with what is behind (for the second this is checked in its vocabulary, else
texts are encoded whole), so each distinct unit is encoded once and remembered.  Long texts are aligned in parts
that begin with a unit.

Corpus statistics: in how many documents a pair of ids is linked.  Documents' distinct pairs are written
once; pairs are counted in tasks before they are shuffled.  The commonest HOT_PAIRS pairs, a bounded
number, go to all workers as arrays, so pairs that most documents hold are never shuffled; documents' other
pairs, each in few documents, are joined with their counts.

Defined results: texts that are null, empty, or whose tokens don't spell them (the second tokenizer
reads its own space mark as a space) have no tokens, zeros everywhere, and an empty digest; special tokens'
strings in texts are plain text; a null document id stays null; repeated rows and ids are documents of
their own in all counts, and ties for an id's commonest partner all count; a text of any length is read
whole; an empty table gives no rows; columns other than the two named are ignored, whatever they are called.
"""

from __future__ import annotations

import hashlib
import json
import os

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.llm import textkit as K
from seriesloom.llm.bpe import byte_characters
from seriesloom.sources.tables import written

#: Pairs that are given to all workers: at most some 7 MB.
HOT_PAIRS = 1 << 19
#: Units, and ids of them, that a worker remembers; beyond, it starts over.
UNITS_KEPT, IDS_KEPT = 400_000, 8_000_000
#: Bytes of a text's part, and pairs that a task counts at a time.
PART_BYTES, RUN_PAIRS = 1 << 18, 1 << 23
_SPACE_MARK = "▁"


class ByteLevel:
    """The first tokenizer: a byte-level BPE of the tokenizers library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks use the cores
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        description = json.loads(self.tokenizer.to_str())
        split = description.get("pre_tokenizer") or {}
        self.by_unit = description.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
        byte = {c: b for b, c in enumerate(byte_characters())}
        self.tokens = [b""] * self.tokenizer.get_vocab_size()
        for token, i in self.tokenizer.get_vocab().items():
            self.tokens[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()

    def encode(self, units: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(units, add_special_tokens=False)]


class Pieces:
    """The second tokenizer: a sentencepiece model that puts a space before a text."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.by_unit = not any(_SPACE_MARK in p.lstrip(_SPACE_MARK) for p in pieces)
        self.tokens = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(_SPACE_MARK, " ").encode() for i, p in enumerate(pieces)]

    def encode(self, units: list[str]) -> list[list[int]]:
        return self.model.encode([u[1:] for u in units], num_threads=1)


class Remembered:
    """Numbers for hashes, in the order in which they are learned: a large sorted table, and a small
    one for new hashes, so that learning doesn't sort the large one anew."""

    def __init__(self):
        self.tables = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))] * 2
        self.size = 0

    def find(self, unique: np.ndarray) -> np.ndarray:
        """The number of each hash, or -1."""
        out = np.full(len(unique), -1, dtype=np.int64)
        for keys, number in self.tables:
            if len(keys):
                place = np.minimum(np.searchsorted(keys, unique), len(keys) - 1)
                here = keys[place] == unique
                out[here] = number[place[here]]
        return out

    def add(self, unique: np.ndarray) -> None:
        join = lambda a, b: (lambda k, n, o: (k[o], n[o]))(np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]]), np.argsort(np.concatenate([a[0], b[0]]), kind="stable"))
        old, new = self.tables
        new = join(new, (unique, np.arange(self.size, self.size + len(unique))))
        self.size += len(unique)
        self.tables = [join(old, new), (new[0][:0], new[1][:0])] if len(new[0]) > 20_000 + len(old[0]) // 8 else [old, new]


class Side:
    """One tokenizer's ids of the remembered units."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.width = np.array(list(map(len, tokenizer.tokens)), dtype=np.int64)
        self.clear()

    def clear(self) -> None:
        self.ids, self.begin, self.n = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.parts, self.held = [], 0

    def learn(self, units: list[str], raw: list[bytes]) -> np.ndarray:
        """Encode new units; whether each one's tokens spell it."""
        found = self.tokenizer.encode(units)
        n = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        self.ids = np.concatenate([self.ids, *(np.array(x, dtype=np.int32) for x in found)])
        self.begin = np.concatenate([self.begin, len(self.ids) - int(n.sum()) + np.cumsum(n) - n])
        self.n = np.concatenate([self.n, n])
        tokens = self.tokenizer.tokens
        return np.fromiter((b"".join([tokens[i] for i in x]) == r for x, r in zip(found, raw)), dtype=bool, count=len(raw))

    def ids_of(self, unit: np.ndarray) -> np.ndarray:
        return K.take_pieces(self.ids, self.begin[unit], self.n[unit])


def spaced(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All texts that aren't empty with a space before each; offsets of all texts."""
    n = np.diff(offs)
    out = offs + np.concatenate([[0], np.cumsum(n > 0)])
    joined = np.full(out[-1], 32, dtype=np.uint8)
    inner = np.ones(out[-1], dtype=bool)
    inner[out[:-1][n > 0]] = False
    joined[inner] = buf
    return joined, out


def unit_starts(buf: np.ndarray, offs: np.ndarray, by_unit: bool) -> np.ndarray:
    """Where units begin: with each text, and at single spaces between characters that aren't white space.

    Characters known not to be white space: U+0021 to U+007E, and those of two bytes from U+00C0.
    """
    first = offs[:-1][np.diff(offs) > 0]
    if not by_unit or len(buf) < 4:
        return first
    plain, lead, rest = (buf > 32) & (buf < 127), (buf >= 0xC3) & (buf <= 0xDF), buf & 0xC0 == 0x80
    behind = plain.copy()
    behind[1:] |= rest[1:] & lead[:-1]
    cut = np.zeros(len(buf), dtype=bool)
    cut[1:-1] = (buf[1:-1] == 32) & behind[:-2] & (plain | lead)[2:]
    cut[first] = True
    return np.flatnonzero(cut)


def leaf_groups(a_end: np.ndarray, b_end: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The last token of each group, as numbers of tokens of the first side, in order.

    ``a_end`` and ``b_end`` are the rising ends of both sides' tokens over all texts of a run; text k has
    the tokens from ``first[k]`` up to ``last[k]`` of the first side, and its ends are shared.
    """
    low, high, reach, leaves = first, last, np.ones(len(first), dtype=np.int64), []
    while len(low):
        middle = (low + high - 1) // 2
        begin, stop = np.maximum(low, middle - reach + 1), np.minimum(high - 1, middle + reach)
        n = np.maximum(stop - begin, 0)
        near = K.take_pieces(np.arange(len(a_end)), begin, n)
        end = a_end[near]
        away = np.abs(near - np.repeat(middle, n)) * 2 + (near > np.repeat(middle, n))
        away[b_end[np.searchsorted(b_end, end)] != end] = np.iinfo(np.int64).max
        best, at = np.full(len(low), np.iinfo(np.int64).max), np.flatnonzero(n)
        if len(at):
            best[at] = np.minimum.reduceat(away, (np.cumsum(n) - n)[at])
        found = best < np.iinfo(np.int64).max
        leaf = ~found & (begin <= low) & (stop >= high - 1)
        leaves.append(high[leaf] - 1)
        wider = ~found & ~leaf
        cut = (middle[found] + np.where(best[found] % 2 == 1, best[found] // 2, -(best[found] // 2))) + 1
        low, high, reach = (np.concatenate(x) for x in ((low[found], cut, low[wider]), (cut, high[found], high[wider]), (np.ones(2 * len(cut), dtype=np.int64), 4 * reach[wider])))
    return np.sort(np.concatenate(leaves)) if leaves else np.zeros(0, dtype=np.int64)


class Aligned:
    """Tokens, groups and links of the texts of a run, as flat arrays."""

    def __init__(self, a: np.ndarray, b: np.ndarray, a_width: np.ndarray, b_width: np.ndarray, a_n: np.ndarray, b_n: np.ndarray):
        self.a, self.b, self.a_n, self.b_n = a, b, a_n, b_n
        a_end, b_end = np.cumsum(a_width[a], dtype=np.int32), np.cumsum(b_width[b], dtype=np.int32)
        text = np.flatnonzero(a_n)
        stop = np.cumsum(a_n)
        self.a_last = leaf_groups(a_end, b_end, (stop - a_n)[text], stop[text])
        self.b_last = np.searchsorted(b_end, a_end[self.a_last])
        a_text = np.repeat(np.arange(len(a_n)), a_n)
        self.group_text = a_text[self.a_last]
        self.n_groups = np.bincount(self.group_text, minlength=len(a_n))
        # each stretch between neighbouring ends lies in one token of either side: a link
        shared, inner = np.zeros(len(a), dtype=bool), np.ones(len(b), dtype=bool)
        shared[self.a_last], inner[self.b_last] = True, False
        order = np.argsort(np.concatenate([a_end, b_end[inner]]), kind="stable")
        ends_a = order < len(a)
        ends_b = ~ends_a
        ends_b[ends_a] = shared
        self.link_a, self.link_b = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b
        self.link_text = a_text[self.link_a]
        self.n_links = np.bincount(self.link_text, minlength=len(a_n))

    def pairs(self, b_size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (text, pair of ids) of the links: the pair as one number, its text, and its links."""
        pair = self.a[self.link_a].astype(np.int64) * b_size + self.b[self.link_b]
        order = np.lexsort((pair, self.link_text))
        pair, text = pair[order], self.link_text[order]
        new = np.concatenate([[True], (pair[1:] != pair[:-1]) | (text[1:] != text[:-1])])[: len(pair)]
        at = np.flatnonzero(new)
        return pair[at], text[at], np.diff(np.append(at, len(pair)))

    def spelled(self, digits: Digits, runs: int = 1 << 18) -> list[list[bytes]]:
        """Per text the bytes ``a1,a2|b1;a3|b2,b3`` of its groups, in runs."""
        total = len(self.a) + len(self.b)
        item = np.empty(total, dtype=np.int64)
        a_group = np.repeat(np.arange(len(self.a_last)), np.diff(self.a_last, prepend=-1))
        b_group = np.repeat(np.arange(len(self.b_last)), np.diff(self.b_last, prepend=-1))
        b_first = np.concatenate([[0], self.b_last + 1])
        a_kind, b_kind = np.zeros(len(self.a), dtype=np.int64), np.zeros(len(self.b), dtype=np.int64)
        a_kind[self.a_last] = 1  # a bar follows
        b_kind[self.b_last] = 2  # a semicolon follows
        item[np.arange(len(self.a)) + b_first[a_group]] = a_kind * digits.size + self.a
        item[np.arange(len(self.b)) + self.a_last[b_group] + 1] = b_kind * digits.size + self.b
        stop = np.cumsum(self.a_n + self.b_n)
        out = []
        for begin, end in zip(stop - self.a_n - self.b_n, stop):
            out.append([digits.joined(item[k : min(k + runs, end)]) for k in range(begin, end, runs)])
        return out


class Digits:
    """Decimal numbers below ``size`` with a comma, a bar or a semicolon behind."""

    def __init__(self, size: int):
        self.size = size
        raw = [b"%d%c" % (i, mark) for mark in b",|;" for i in range(size)]
        self.length = np.array(list(map(len, raw)), dtype=np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.raw = np.frombuffer(b"".join(raw), dtype=np.uint8)

    def joined(self, items: np.ndarray) -> bytes:
        return K.take_pieces(self.raw, self.start[items], self.length[items]).tobytes()


class Aligner:
    """Encodes and aligns runs of texts."""

    def __init__(self, first: str, second: str):
        self.sides = Side(ByteLevel(first)), Side(Pieces(second))
        self.by_unit = all(s.tokenizer.by_unit for s in self.sides)
        self.b_size = len(self.sides[1].tokenizer.tokens)
        self.digits = Digits(max(len(s.tokenizer.tokens) for s in self.sides))
        self.clear()

    def clear(self) -> None:
        self.units, self.good = Remembered(), np.zeros(0, dtype=bool)
        for s in self.sides:
            s.clear()

    def _numbers(self, buf: np.ndarray, start: np.ndarray) -> np.ndarray:
        """The number of each unit; new ones are learned."""
        end = np.append(start[1:], len(buf))
        code, unique = pd.factorize(K.span_hashes(buf, start, end, False))
        if self.units.size > UNITS_KEPT or len(self.sides[0].ids) + len(self.sides[1].ids) > IDS_KEPT:
            self.clear()
        new = np.flatnonzero(self.units.find(unique) < 0)
        if len(new):
            at = np.empty(len(unique), dtype=np.int64)
            at[code[::-1]] = np.arange(len(code) - 1, -1, -1)
            raw = [buf[start[k] : end[k]].tobytes() for k in at[new]]
            text = [r.decode() for r in raw]
            good = self.sides[0].learn(text, raw) & self.sides[1].learn(text, raw)
            self.good = np.concatenate([self.good, good])
            self.units.add(unique[new])
        return self.units.find(unique)[code]

    def align(self, buf: np.ndarray, offs: np.ndarray, start: np.ndarray) -> tuple[Aligned, np.ndarray]:
        """Alignment of texts that begin with a space and whose units begin at ``start``, and whether the tokens
        spell each text; texts that they don't have none."""
        if not len(start):
            none = np.zeros(0, dtype=np.int64)
            zero = np.zeros(len(offs) - 1, dtype=np.int64)
            a, b = self.sides
            return Aligned(none, none, a.width, b.width, zero, zero), np.zeros(len(offs) - 1, dtype=bool)
        unit = self._numbers(buf, start)
        text = np.searchsorted(offs, start, "right") - 1
        good = np.bincount(text, ~self.good[unit], minlength=len(offs) - 1) == 0
        unit, text = unit[good[text]], text[good[text]]
        a, b = self.sides
        counts = [np.bincount(text, s.n[unit], minlength=len(offs) - 1).astype(np.int64) for s in (a, b)]
        return Aligned(a.ids_of(unit), b.ids_of(unit), a.width, b.width, *counts), good

    def rows(self, buf: np.ndarray, offs: np.ndarray):
        """(n_a, n_b, n_groups, n_links, digest, pairs, their links, number of pairs) of a run's texts."""
        buf, offs = spaced(buf, offs)
        start = unit_starts(buf, offs, self.by_unit)
        if len(offs) == 2 and len(buf) > 2 * PART_BYTES:
            return self._long(buf, start)
        found, _ = self.align(buf, offs, start)
        pair, text, times = found.pairs(self.b_size)
        digest = [_sha(x) for x in found.spelled(self.digits)]
        return found.a_n, found.b_n, found.n_groups, found.n_links, digest, pair, times, np.bincount(text, minlength=len(offs) - 1)

    def _long(self, buf: np.ndarray, start: np.ndarray):
        """The same of one long text, in parts that begin with a unit."""
        edges = np.unique(np.concatenate([np.searchsorted(start, np.arange(0, len(buf), PART_BYTES)), [len(start)]]))
        total, digest, pairs, times = np.zeros(4, dtype=np.int64), hashlib.sha256(), np.zeros(0, np.int64), np.zeros(0, np.int64)
        place = np.append(start, len(buf))
        for k, (low, high) in enumerate(zip(edges[:-1], edges[1:])):
            part = buf[place[low] : place[high]]
            found, good = self.align(part, np.array([0, len(part)]), start[low:high] - place[low])
            if not good[0]:
                zero = np.zeros(1, dtype=np.int64)
                return zero, zero, zero, zero, [""], pairs[:0], times[:0], zero
            total += [found.a_n[0], found.b_n[0], found.n_groups[0], found.n_links[0]]
            runs = found.spelled(self.digits)[0]
            for x in [b";"] * (k > 0) + runs[:-1] + [runs[-1][:-1]]:
                digest.update(x)
            pair, _, n = found.pairs(self.b_size)
            pairs, at = np.unique(np.concatenate([pairs, pair]), return_inverse=True)
            times = np.bincount(at, np.concatenate([times, n]), minlength=len(pairs)).astype(np.int64)
        return *(total[k : k + 1] for k in range(4)), [digest.hexdigest()], pairs, times, np.array([len(pairs)])


def _sha(runs: list[bytes]) -> str:
    if not runs:
        return ""
    digest = hashlib.sha256()
    for x in runs[:-1]:
        digest.update(x)
    digest.update(runs[-1][:-1])
    return digest.hexdigest()


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(first: str, second: str) -> Aligner:
    """The worker's aligner; it remembers units between tasks."""
    if (first, second) not in _aligners:
        _aligners[first, second] = Aligner(first, second)
    return _aligners[first, second]


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _texts(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return documents.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def token_groups(documents: DataFrame, tokenizers: tuple[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, a, b, a_last, b_last) of every row: the ids of either side, and for each group the number
    of its last token on either side."""
    paths = tokenizers or default_tokenizers()

    def run(batches):
        use = aligner(*paths)
        for batch in batches:
            for lo, hi, buf, offs in K.chunks(batch.column(1)):
                buf, offs = spaced(buf, offs)
                x, _ = use.align(buf, offs, unit_starts(buf, offs, use.by_unit))
                first = lambda n: (np.cumsum(n) - n)[x.group_text]
                lists = [K.list_array(v, n, pa.int32()) for v, n in ((x.a, x.a_n), (x.b, x.b_n), (x.a_last - first(x.a_n), x.n_groups), (x.b_last - first(x.b_n), x.n_groups))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *lists], ["doc_id", "a", "b", "a_last", "b_last"])

    return _texts(documents, id_col, text_col).mapInArrow(K.tidied(run), "doc_id bigint, a array<int>, b array<int>, a_last array<int>, b_last array<int>")


def aligned_documents(documents: DataFrame, tokenizers: tuple[str, str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, links) of every row: its figures, the digest of
    its groups, its distinct linked pairs (first id times the second side's size, plus second id) and each one's links."""
    kind = pa.int64()  # 50,257 times 32,000 fits 32 bits, other vocabularies may not

    def run(batches):
        use = aligner(*tokenizers)
        for batch in batches:
            for lo, hi, buf, offs in K.chunks(batch.column(1)):
                n_a, n_b, n_groups, n_links, digest, pair, times, n = use.rows(buf, offs)
                columns = [batch.column(0).slice(lo, hi - lo), *(pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups, n_links)), pa.array(digest), K.list_array(pair, n, kind), K.list_array(times, n, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "links"])

    return _texts(documents, id_col, text_col).mapInArrow(K.tidied(run), "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs array<bigint>, links array<int>")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, docs): in how many rows each pair is linked; every task adds up its own first."""

    def run(batches):
        held, size = [], 0

        def counted():
            pair, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n.astype(np.int64))], ["pair", "docs"])

        for batch in batches:
            for k in range(0, len(batch), 512):
                held.append(batch.column(0).slice(k, 512).flatten().to_numpy(zero_copy_only=False))
                size += len(held[-1])
                if size >= RUN_PAIRS:
                    yield counted()
                    held, size = [], 0
        if size:
            yield counted()

    return aligned.select("pairs").mapInArrow(K.tidied(run), "pair bigint, docs bigint").groupBy("pair").agg(F.sum("docs").alias("docs"))


def commonest(counts: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """(pairs of the highest counts, at most ``most`` of them; all others)."""
    step = F.when(F.col("docs") < 4096, F.col("docs")).otherwise(4096 + F.floor(F.log2("docs") * 64)).cast("bigint")
    found = counts.groupBy(step.alias("step")).agg(F.count("*").alias("n")).toPandas().sort_values("step", ascending=False)  # under 8,192 rows
    fits = found["step"][found["n"].cumsum() <= most]
    least = int(fits.min()) if len(fits) else 1 << 62
    return counts.filter(step >= least), counts.filter(step < least)


def link_counts(aligned: DataFrame, b_size: int, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """``aligned`` with ``n_best``, its links whose pair is in as many rows as any pair of its first id, and
    ``count_sum``, the rows that hold the pair, added up over its links.

    ``aligned`` must be a written table with a ``row_id`` of its own for each row: it is read several times.
    """
    sc = aligned.sparkSession.sparkContext
    counts = written(pair_counts(aligned))
    a = F.expr(f"pair div {b_size}")
    highest = counts.groupBy(a.alias("a")).agg(F.max("docs").alias("highest"))  # one row per id of the first tokenizer
    counts = written(counts.withColumn("a", a).join(F.broadcast(highest), "a").select("pair", "docs", (F.col("docs") == F.col("highest")).alias("best")))
    common, rare = commonest(counts, hot_pairs)
    hot = common.toPandas().sort_values("pair")
    shared = sc.broadcast((hot["pair"].to_numpy(np.int64), hot["docs"].to_numpy(np.int64), hot["best"].to_numpy(bool)))  # at most hot_pairs rows

    def lists(batch):
        """Runs of rows: (first row, end row, pairs, links, each pair's row in the run, where it is among the hot ones, whether it is)."""
        keys = shared.value[0]
        for k in range(0, len(batch), 512):
            part = batch.slice(k, 512)
            pairs, n = part.column("pairs"), part.column("links").flatten().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(part)), pairs.value_lengths().to_numpy(zero_copy_only=False))
            pair = pairs.flatten().to_numpy(zero_copy_only=False)
            if not len(keys):
                yield part, pair, n, row, np.zeros(len(pair), np.int64), np.zeros(len(pair), bool)
                continue
            place = np.minimum(np.searchsorted(keys, pair), len(keys) - 1)
            yield part, pair, n, row, place, keys[place] == pair

    plain = ["row_id", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

    def of_hot(batches):
        for batch in batches:
            for part, _, n, row, place, here in lists(batch):
                at, row, n = place[here], row[here], n[here]
                total = np.zeros(len(part), dtype=np.int64)
                np.add.at(total, row, n * shared.value[1][at])
                best = np.zeros(len(part), dtype=np.int64)
                np.add.at(best, row, n * shared.value[2][at])
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in plain), pa.array(best), pa.array(total)], [*plain, "hot_best", "hot_sum"])

    def of_rare(batches):
        for batch in batches:
            ids = batch.column("row_id").to_numpy()
            k = 0
            for part, pair, n, row, _, here in lists(batch):
                yield pa.RecordBatch.from_arrays([pa.array(ids[k + row[~here]]), pa.array(pair[~here]), pa.array(n[~here].astype(np.int64))], ["row_id", "pair", "n"])
                k += len(part)

    docs = aligned.select(*plain, "pairs", "links").mapInArrow(K.tidied(of_hot), "row_id bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, hot_best bigint, hot_sum bigint")
    other = aligned.select("row_id", "pairs", "links").mapInArrow(K.tidied(of_rare), "row_id bigint, pair bigint, n bigint").join(rare, "pair")
    other = other.groupBy("row_id").agg(F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("rare_best"), F.sum(F.col("n") * F.col("docs")).alias("rare_sum"))
    j = docs.join(other, "row_id", "left")
    return j.select("doc_id", *plain[2:], (F.col("hot_best") + F.coalesce("rare_best", F.lit(0))).alias("n_best"), (F.col("hot_sum") + F.coalesce("rare_sum", F.lit(0))).alias("count_sum"))


def align(documents: DataFrame, tokenizers: tuple[str, str] | None = None, hot_pairs: int = HOT_PAIRS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum) of every row."""
    paths = tokenizers or default_tokenizers()
    aligned = written(aligned_documents(documents, paths, id_col, text_col).withColumn("row_id", F.monotonically_increasing_id()))
    return link_counts(aligned, len(Pieces(paths[1]).tokens), hot_pairs)


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over all of ``documents``."""
    return align(spark.read.parquet(f"{sf_dir}/documents.parquet"))
