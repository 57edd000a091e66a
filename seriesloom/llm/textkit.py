"""Vectorised word handling on Arrow batches, for use inside Spark tasks.

Texts stay UTF-8 bytes.  Every word rule used here is a set of bytes (all
non-ASCII bytes count as word bytes), so splitting by bytes equals splitting by
characters.  A word's hash is a polynomial over its bytes modulo 2**64, read off
one running sum, then mixed; no per-word Python code runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# The constants of the public SplitMix64 finaliser, and an odd base.
MIX_A = np.uint64(0xBF58476D1CE4E5B9)
MIX_B = np.uint64(0x94D049BB133111EB)
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
BASE = 0xD1342543DE82EF95
BASE_INVERSE = pow(BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser on unsigned 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


def _byte_table(fold: bool) -> np.ndarray:
    values = mix(GOLDEN * np.arange(1, 257, dtype=np.uint64))
    if fold:
        values[65:91] = values[97:123]
    return values


BYTE_VALUES = {True: _byte_table(True), False: _byte_table(False)}

#: Bytes of ``[^\x20\x09-\x0D]`` words.
SPACED = np.ones(256, dtype=bool)
SPACED[[9, 10, 11, 12, 13, 32]] = False
#: Bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` words once A-Z are lower-cased.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True

#: Longest run of bytes whose powers a worker keeps (two tables of 32 MB).
KEPT_POWERS = 1 << 22
_powers = np.ones(1, dtype=np.uint64)
_inverse = np.ones(1, dtype=np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n; those of usual lengths are kept for the next call."""
    global _powers, _inverse
    if len(_powers) >= n:
        return _powers[:n], _inverse[:n]
    both = []
    for base in (BASE, BASE_INVERSE):
        x = np.full(n if n > KEPT_POWERS else 1 << (n - 1).bit_length(), base, dtype=np.uint64)
        x[0] = 1
        both.append(np.multiply.accumulate(x))
    if n <= KEPT_POWERS:
        _powers, _inverse = both
    return both[0][:n], both[1][:n]


def chunks(column: pa.Array, target: int = 1 << 18) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column into runs of whole texts of about ``target`` bytes.

    Yields (first row, end row, bytes, offsets): text i of the run is
    bytes[offsets[i]:offsets[i + 1]].  Null texts are empty.  A text longer than
    ``target`` is a run of its own.
    """
    rows = len(column)
    if not rows:
        return
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + rows + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < rows:
        end = max(at + 1, int(np.searchsorted(offs, offs[at] + target, "right")) - 1)
        yield at, end, raw[offs[at] : offs[end]], offs[at : end + 1] - offs[at]
        at = end


def tidied(function):
    """A function for mapInArrow that gives free memory back to the system when its rows end;
    workers live on between tasks."""

    def run(batches):
        yield from function(batches)
        pa.default_memory_pool().release_unused()

    return run


def words(buf: np.ndarray, offs: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each maximal run of word bytes."""
    n = len(buf)
    if not n:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    inside = table[buf]
    first, last = offs[:-1][offs[:-1] < offs[1:]], offs[1:][offs[:-1] < offs[1:]] - 1
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = inside[:-1]
    before[first] = False
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[last] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return start, end, np.searchsorted(offs, start, "right") - 1


def span_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray, fold: bool) -> np.ndarray:
    """64-bit hash of each byte span; ``fold`` lower-cases A-Z first."""
    if not len(start):
        return np.zeros(0, dtype=np.uint64)
    power, inverse = powers(len(buf) + 1)
    total = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum(BYTE_VALUES[fold][buf] * power[: len(buf)], out=total[1:])
    return mix((total[end] - total[start]) * inverse[start] + GOLDEN * (end - start).astype(np.uint64))


def window_hashes(hashes: np.ndarray, doc: np.ndarray, n_docs: int, k: int, short: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of k consecutive words of one text: (hash, first word, text number).

    With ``short``, a text of fewer than k words, but not none, has one window: all
    of them.
    """
    count = np.bincount(doc, minlength=n_docs)
    end = np.cumsum(count)
    index = np.arange(len(hashes))
    full = index + k <= end[doc]
    at = np.flatnonzero(full)
    factors = mix(GOLDEN * np.arange(1, k + 1, dtype=np.uint64)) | np.uint64(1)
    value = np.zeros(len(at), dtype=np.uint64)
    for j in range(k):
        value += hashes[at + j] * factors[j]
    value = mix(value)
    if short:
        few = np.flatnonzero((count > 0) & (count < k))
        if len(few):
            begin = end[few] - count[few]
            part = np.zeros(len(few), dtype=np.uint64)
            for j in range(k):
                has = j < count[few]
                part[has] += hashes[begin[has] + j] * factors[j]
            at = np.concatenate([at, begin])
            value = np.concatenate([value, mix(part)])
            order = np.argsort(at, kind="stable")
            at, value = at[order], value[order]
    return value, at, doc[at]


def bounds(doc: np.ndarray, n_docs: int) -> np.ndarray:
    """Where each text's entries begin in an array ordered by text number; one more at the end."""
    return np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=n_docs))])


def take_pieces(values: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """values[start[i]:start[i] + length[i]] for each i, joined."""
    total = int(length.sum())
    if not total:
        return values[:0]
    skip = np.repeat(start - np.concatenate([[0], np.cumsum(length)[:-1]]), length)
    return values[skip + np.arange(total)]


def list_array(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from joined values and each row's length."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), pa.array(values, kind))
