"""BPE encoding and decoding by batched merge rounds.

Texts are cut into words and pieces as the tokenizer's description says, and each distinct word is
merged once: the symbols of many pieces lie in one flat array; in every round each piece's pair of
lowest rank is found by binary search over the sorted pair keys, all its occurrences are merged from
the left, and pieces without a known pair leave the array.

Rounds give what merging pair by pair gives where every merge makes a token of its own out of tokens
made before: a new pair then never ranks below the one that it came from.  This is checked when a
tokenizer is read; one that isn't so, or not of the known form (``token_ids.splits_at_spaces``), is
refused.  Between two bytes that no token holds side by side nothing is ever merged, so pieces are
cut there first; this keeps the rounds of very long pieces few.

Defined results: a null or empty text has no ids and decodes to an empty text; special tokens' strings in
a text are their ids, as the library does; texts of any length are encoded whole, in runs; repeated
rows and ids are encoded each for itself; a null document id stays null; an empty table gives no rows;
columns other than the two named are ignored, whatever they are called.  Ids that the tokenizer lacks are
passed over by :func:`decode`, as the library does.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.llm import textkit as K
from seriesloom.llm.token_ids import WordEncoder, default_tokenizer

#: Ids that are decoded at a time; longer texts are decoded in runs.
RUN_IDS = 1 << 16
#: The pieces of an ASCII word in lower case, as the known pattern cuts it.
ASCII_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
_NONE = np.iinfo(np.int32).max


def byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself where it is printed
    as one mark, else the next free one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class MergeTable:
    """A byte-level BPE's symbols and merges as arrays, and :meth:`merge`."""

    def __init__(self, description: dict):
        model = description["model"]
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        self.size = max([*vocab.values(), *(t["id"] for t in description.get("added_tokens") or [])]) + 1
        chars = byte_characters()
        self.plain = np.array([vocab[c] for c in chars], dtype=np.int64)
        self.final = np.array([vocab[c + suffix] for c in chars], dtype=np.int64)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        left, right = (np.array([vocab[p[k]] for p in pairs], dtype=np.int64) for k in (0, 1))
        since = np.full(self.size, len(pairs), dtype=np.int64)
        since[np.concatenate([self.plain, self.final])] = -1
        if len(np.unique(made)) < len(made) or (since[made] < 0).any():
            raise ValueError("a token comes from several merges")
        since[made] = np.arange(len(made))
        if (np.maximum(since[left], since[right]) >= np.arange(len(made))).any():
            raise ValueError("a merge uses a token that isn't made yet")
        key = left * self.size + right
        order = np.argsort(key)
        self.keys, self.rank, self.made = key[order], order.astype(np.int32), made[order]
        # pairs of bytes that some token holds side by side
        byte = {c: b for b, c in enumerate(chars)}
        self.joins = np.zeros((256, 256), dtype=bool)
        for token in vocab:
            raw = [byte[c] for c in (token.removesuffix(suffix) if suffix else token) if c in byte]
            self.joins[raw[:-1], raw[1:]] = True

    def merge(self, buf: np.ndarray, length: np.ndarray, special: dict[int, int] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces (their bytes joined, and each one's length), joined, and their number in each.

        ``special`` gives the id of a place in ``buf`` that stands for a special token.
        """
        end = np.cumsum(length)
        symbol = self.plain[buf]
        symbol[end - 1] = self.final[buf[end - 1]]
        cut = np.ones(len(buf), dtype=bool)  # whether a part of a piece begins here
        cut[1:] = ~self.joins[buf[:-1], buf[1:]]
        cut[end[:-1]] = True
        for place, i in (special or {}).items():
            symbol[place] = i
        piece = np.repeat(np.arange(len(length)), length)
        part = np.cumsum(cut) - 1
        owner = piece[cut]
        parts, symbols = [], []
        while len(part):
            pair = np.full(len(part), _NONE, dtype=np.int32)  # rank of the pair that begins here
            key = symbol[:-1] * self.size + symbol[1:]
            place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = (self.keys[place] == key) & (part[1:] == part[:-1])
            pair[:-1][known] = self.rank[place[known]]
            first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            lowest = np.repeat(np.minimum.reduceat(pair, first), np.diff(np.append(first, len(part))))
            done = lowest == _NONE
            parts.append(part[done])
            symbols.append(symbol[done])
            at = np.flatnonzero(~done & (pair == lowest))
            # equal symbols in a row: every other pair from the left
            begins = np.concatenate([[True], np.diff(at) > 1])[: len(at)]
            run = np.flatnonzero(begins)
            at = at[(np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))) % 2 == 0]
            symbol[at] = self.made[place[at]]
            keep = ~done
            keep[at + 1] = False
            part, symbol = part[keep], symbol[keep]
        part, symbol = np.concatenate(parts), np.concatenate(symbols)
        order = np.argsort(part, kind="stable")
        return symbol[order].astype(np.uint32), np.bincount(owner[part], minlength=len(length)).astype(np.int64)


class MergeEncoder(WordEncoder):
    """Ids of whole texts: words are cut and remembered as in :class:`WordEncoder`, new ones are merged
    by :class:`MergeTable`."""

    def __init__(self, path: str):
        super().__init__(path)
        if not self.by_word:
            raise ValueError("the tokenizer isn't of the known form")
        description = json.loads(self.tokenizer.to_str())
        self.table = MergeTable(description)
        self.bytes_of = {c: b for b, c in enumerate(byte_characters())}
        self.special = {t["content"]: t["id"] for t in description.get("added_tokens") or []}
        self.at_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def _letters(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of letters or single stops: one piece each."""
        return self.table.merge(np.frombuffer(b"".join(words).lower(), dtype=np.uint8), np.fromiter(map(len, words), dtype=np.int64, count=len(words)))

    def _pieces(self, text: str) -> list[bytes]:
        if text.isascii():
            return [p.encode() for p in ASCII_PIECES.findall(text.lower())]
        return [bytes(self.bytes_of[c] for c in p) for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(text))]

    def _others(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of any other words, by pieces; a special token is a piece of one byte that takes its id."""
        pieces, special, n, at = [], {}, [], 0
        for word in words:
            before = len(pieces)
            for part in self.at_special.split(word.decode()) if self.special else [word.decode()]:
                if part in self.special:
                    special[at] = self.special[part]
                    found = [b"\0"]
                else:
                    found = self._pieces(part) if part else []
                pieces += found
                at += sum(map(len, found))
            n.append(len(pieces) - before)
        if not pieces:
            return np.zeros(0, dtype=np.uint32), np.zeros(len(words), dtype=np.int64)
        ids, count = self.table.merge(np.frombuffer(b"".join(pieces), dtype=np.uint8), np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces)), special)
        return ids, np.bincount(np.repeat(np.arange(len(words)), n), count, minlength=len(words)).astype(np.int64)


class Decoder:
    """Texts of ids for a tokenizer without a decoder step: its tokens with a space between them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            description = json.load(f)
        if description.get("decoder"):
            raise ValueError("the tokenizer has a decoder step")
        tokens = {**{i: t for t, i in description["model"]["vocab"].items()}, **{t["id"]: t["content"] for t in description.get("added_tokens") or []}}
        self.known = np.zeros(max(tokens) + 1, dtype=bool)
        self.known[list(tokens)] = True
        raw = [tokens.get(i, "").encode() + b" " for i in range(len(self.known))]
        self.length = np.array(list(map(len, raw)), dtype=np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.raw = np.frombuffer(b"".join(raw), dtype=np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        ids = ids[ids < len(self.known)]
        ids = ids[self.known[ids]]
        runs = (ids[k : k + RUN_IDS] for k in range(0, len(ids), RUN_IDS))
        return b"".join(K.take_pieces(self.raw, self.start[x], self.length[x]).tobytes() for x in runs)[:-1]


_made: dict[tuple, object] = {}


def _kept(kind, path: str):
    """The worker's encoder or decoder; it lives on between tasks."""
    if (kind, path) not in _made:
        _made[kind, path] = kind(path)
    return _made[kind, path]


def encode(documents: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) of every row: the text's ids as little-endian unsigned 32-bit integers, packed.

    ``tokenizer`` is the path of a tokenizer file that every machine has.
    """
    path = tokenizer or default_tokenizer()

    def run(batches):
        use = _kept(MergeEncoder, path)
        for batch in batches:
            for lo, hi, buf, offs in K.chunks(batch.column(1)):
                ids, n = use.encode(buf, offs)
                raw, end = ids.astype("<u4").tobytes(), 4 * np.cumsum(n)
                packed = pa.Array.from_buffers(pa.large_binary(), hi - lo, [None, pa.py_buffer(np.concatenate([[0], end]).astype(np.int64)), pa.py_buffer(raw)])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), packed.cast(pa.binary())], ["doc_id", "ids"])

    return documents.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(K.tidied(run), "doc_id bigint, ids binary")


def decode(encoded: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Rows of (doc_id, ids) with the text that the ids decode to, special tokens included, as ``decoded``."""
    path = tokenizer or default_tokenizer()

    def run(batches):
        use = _kept(Decoder, path)
        for batch in batches:
            for lo, hi, buf, offs in K.chunks(batch.column(1)):
                ids = np.frombuffer(buf.tobytes(), dtype="<u4")
                texts = [use.decode(ids[a:b]) for a, b in zip(offs[:-1] // 4, offs[1:] // 4)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(texts, pa.binary()).cast(pa.string())], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(K.tidied(run), "doc_id bigint, ids binary, decoded string")


def op13_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over all of ``documents``."""
    both = decode(encode(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    return both.select("doc_id", F.floor(F.length("ids") / 4).cast("bigint").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
