"""N-gram Jaccard join by prefix trees.

Texts are sets of hashed word n-grams under one global order (rare first, by a counting
sketch over all documents, then by hash).  Two texts link when 100 * intersection >=
``percent`` * union.

1. Equal sets become one class, told apart by size and 128 bits, and named by 64 bits of these.
2. A class's prefix (its size less the least overlap, plus one) must share an n-gram with
   the prefix of every partner.  Classes that share a prefix n-gram meet under a pivot, the
   smallest class with that n-gram, so every possible link lies within some pivot's group.
3. Members of a group without another member of fitting size leave it.  Groups are cut, in
   order of size, into blocks of bounded n-grams and members, from counts by size that are summed up
   before; pairs of blocks of fitting sizes are the units of work, so no task holds a whole group.
   Neighbouring blocks are compared first, others only as far as they aren't connected by then.
4. In a unit the sets are stored in a trie in frequent-first order.  The trie is walked once
   for all probing sets together: the overlap of a shared path is counted once, a probe
   leaves a subtree as soon as the remaining length on either side can't reach the least
   overlap, and at a set's end the counts are the exact intersections.
5. Links are kept as stars within a unit (connectivity is all that classes need), and
   connected components are found by alternating large and small stars.

Defined results: null texts and texts without words are empty sets, linked with nothing;
fewer words than ``n`` form one n-gram; texts of any length are read whole; repeated rows each get
a row and are in one class; a pair at the limit is linked; rows that share an id but not a text
are linked by their own texts; a null id belongs to the class of its text and to none if no other
row has that text; other columns are ignored; an empty table gives no rows.  Two classes of one
name would be taken as linked: some 24 chances in 3 * 10**10 different texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seriesloom.llm import bloom
from seriesloom.llm import textkit as K
from seriesloom.sources.tables import last_table_only, written

#: Counters of the sketch that orders n-grams: 2 to this power (a byte each when shared).
SKETCH_BITS = 22
SLICE_BITS = 14
#: n-grams and members of a block of a group, about.
BLOCK_GRAMS = 300_000
BLOCK_MEMBERS = 1_000
#: Log-scale class (8 a doubling) from which an n-gram counts as hot: about 2**15 documents.
HOT_CLASS = 120
SALT = 16
_LOW = np.uint64((1 << 56) - 1)


def gram_sets(buf: np.ndarray, offs: np.ndarray, n: int) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    start, end, doc = K.words(buf, offs, K.SPACED)
    value, _, own = K.window_hashes(K.span_hashes(buf, start, end, True), doc, len(offs) - 1, n)
    at = K.bounds(own, len(offs) - 1)
    return [np.unique(value[a:b]) for a, b in zip(at[:-1], at[1:])]


def signature(grams: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums over a set."""
    mixed = K.mix(grams + K.GOLDEN)
    return int(mixed.sum(dtype=np.uint64).view(np.int64)), int(np.bitwise_xor.reduce(K.mix(mixed ^ K.MIX_B)).view(np.int64)) if len(grams) else 0


def ordered(grams: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """n-grams as numbers in global order: the sketch's class, then the hash."""
    mask = np.uint64(len(classes) - 1)
    x = (classes[(grams & mask).astype(np.int64)].astype(np.uint64) << np.uint64(56)) | (grams & _LOW)
    x.sort()
    return x


def least_prefix(size: int, percent: int) -> int:
    return size - -(-percent * size // 100) + 1


class Trie:
    """Sets as number sequences in a path-compressed trie: nodes in depth-first order."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = [s[::-1] for s in sets]  # frequent n-grams first: long shared paths
        keys = [s.astype(">u8").tobytes() for s in self.sets]
        self.order = sorted(range(len(sets)), key=keys.__getitem__)
        self.length = np.array([len(self.sets[i]) for i in self.order], dtype=np.int64)
        shared = np.zeros(len(sets) + 1, dtype=np.int64)  # path shared with the set before
        for k in range(1, len(sets)):
            a, b = self.sets[self.order[k - 1]], self.sets[self.order[k]]
            m = min(len(a), len(b))
            differ = np.flatnonzero(a[:m] != b[:m])
            shared[k] = differ[0] if len(differ) else m
        self.shared = shared

    def walk(self, probes: list[np.ndarray], percent: int):
        """Yields (set number, probe numbers) for every set that some probe links with."""
        sizes = np.array([len(p) for p in probes], dtype=np.int64)
        grams, code = np.unique(np.concatenate(probes), return_inverse=True)
        owner = np.repeat(np.arange(len(probes)), sizes)
        by_gram = np.argsort(code, kind="stable")
        posting = owner[by_gram]
        posting_at = np.concatenate([[0], np.cumsum(np.bincount(code, minlength=len(grams)))])
        stack = [(0, len(self.order), 0, np.zeros(len(probes), dtype=np.int64), np.arange(len(probes)))]
        while stack:
            lo, hi, depth, overlap, alive = stack.pop()
            stop = int(self.shared[lo + 1 : hi].min()) if hi - lo > 1 else int(self.length[lo])
            edge = self.sets[self.order[lo]][depth:stop]
            if len(edge):
                place = np.searchsorted(grams, edge)
                place[place == len(grams)] = 0
                place = place[grams[place] == edge]
                hits = K.take_pieces(posting, posting_at[place], posting_at[place + 1] - posting_at[place])
                overlap = overlap + np.bincount(hits, minlength=len(probes))
            longest, shortest = int(self.length[lo:hi].max()), int(self.length[lo:hi].min())
            got = overlap[alive]
            best = got + np.minimum(sizes[alive] - got, longest - stop)
            alive = alive[(100 + percent) * best >= percent * (sizes[alive] + shortest)]
            if not len(alive):
                continue
            at = lo
            while at < hi and self.length[at] == stop:  # sets that end here
                found = alive[(100 + percent) * overlap[alive] >= percent * (sizes[alive] + stop)]
                if len(found):
                    yield self.order[at], found
                at += 1
            cuts = [at, *(k for k in range(at + 1, hi) if self.shared[k] == stop), hi]
            stack += [(a, b, stop, overlap, alive) for a, b in zip(cuts[:-1], cuts[1:]) if a < b]


def unit_links(left: tuple[list[int], list[np.ndarray]], right: tuple[list[int], list[np.ndarray]] | None, percent: int) -> list[tuple[int, int]]:
    """Stars of the linked documents among ``left``, or between ``left`` and ``right``."""
    (probe_ids, probes), (ids, sets) = left, right or left
    if not probes or not sets:
        return []
    nodes = np.unique(np.array(probe_ids + ids, dtype=np.int64))
    label = np.arange(len(nodes))
    probe_at, at = np.searchsorted(nodes, probe_ids), np.searchsorted(nodes, ids)
    for number, found in Trie(sets).walk(probes, percent):
        met = np.unique(label[np.append(probe_at[found], at[number])])
        if len(met) > 1:
            label[np.isin(label, met[1:])] = met[0]
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return [(int(nodes[i]), int(nodes[label[i]])) for i in moved]


def _names(signs: list[tuple[int, int]], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64 bits that name each set, and 64 more to tell it from others of that name."""
    first, second = (np.array([s[k] for s in signs], dtype=np.int64).view(np.uint64) for k in (0, 1))
    return K.mix(first ^ K.mix(second + K.GOLDEN * sizes.astype(np.uint64))).view(np.int64), second.view(np.int64)


def _signed_rows(n: int):
    """Per document: id, size and signature of its set; then counts of its n-grams' documents, by
    hash, in slices of 2**SKETCH_BITS counters."""
    names = ["doc_id", "row_key", "n", "node", "sign", "slice", "counts"]

    def rows(batches):
        total, mask = np.zeros(1 << SKETCH_BITS, dtype=np.uint32), np.uint64((1 << SKETCH_BITS) - 1)
        for batch in batches:
            for lo, hi, buf, offs in K.chunks(batch.column(2)):
                sets = gram_sets(buf, offs, n)
                size = np.array([len(s) for s in sets], dtype=np.int64)
                node, sign = _names([signature(s) for s in sets], size)
                np.add.at(total, (np.concatenate(sets) & mask).astype(np.int64), np.uint32(1))
                none = pa.nulls(hi - lo, pa.int64()), pa.nulls(hi - lo, pa.binary())
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(lo, hi - lo) for i in (0, 1)), pa.array(size), pa.array(node), pa.array(sign), *none], names)
        for k, part in enumerate(total.reshape(-1, 1 << SLICE_BITS)):
            if part.any():
                part = part.astype(np.uint8) if part.max() < 256 else part  # told apart by their length
                yield pa.RecordBatch.from_arrays([*[pa.nulls(1, pa.int64())] * 5, pa.array([k]), pa.array([part.tobytes()])], names)

    return K.tidied(rows)


def _sketch(parts: DataFrame) -> np.ndarray:
    """Log-scale document counts of n-gram hashes, from all documents' (slice, counts)."""

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                x = np.frombuffer(part, dtype=np.uint8 if len(part) == 1 << SLICE_BITS else np.uint32).astype(np.int64)
                total[k] = total[k] + x if k in total else x
        for k, x in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([np.minimum(8 * np.log2(1 + x), 255).astype(np.uint8).tobytes()])], ["slice", "classes"])

    classes = np.zeros((1 << (SKETCH_BITS - SLICE_BITS), 1 << SLICE_BITS), dtype=np.uint8)
    for r in parts.repartition("slice").mapInArrow(add, "slice bigint, classes binary").collect():
        classes[r.slice] = np.frombuffer(r.classes, dtype=np.uint8)
    return classes.reshape(-1)


def _prefix_rows(n: int, percent: int, shared):
    """Per document with words: size, signature and prefix of its set."""

    def rows(batches):
        classes = shared.value
        for batch in batches:
            for _, _, buf, offs in K.chunks(batch.column(0)):
                sets = [s for s in gram_sets(buf, offs, n) if len(s)]
                if not sets:
                    continue
                size = np.array([len(s) for s in sets], dtype=np.int64)
                node, sign = _names([signature(s) for s in sets], size)
                prefixes = [ordered(s, classes)[: least_prefix(len(s), percent)] for s in sets]
                prefix = K.list_array(np.concatenate(prefixes).view(np.int64), np.array([len(p) for p in prefixes]), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(size), pa.array(node), pa.array(sign), prefix], ["n", "node", "sign", "prefix"])

    return K.tidied(rows)


def _runs(batches):
    """(pivot, member, n) of n-grams that several classes have; rows come in order of n-gram and class."""
    gram, pivot, pivot_n = None, None, None
    for batch in batches:
        g, c, n = (batch.column(i).to_numpy() for i in range(3))
        if not len(g):
            continue
        if gram is not None:
            g, c, n = np.append(gram, g), np.append(pivot, c), np.append(pivot_n, n)
        first = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
        count = np.diff(np.append(first, len(g)))
        many = np.repeat(count > 1, count)
        head = np.repeat(c[first], count)
        gram, pivot, pivot_n = g[-1:], c[first[-1:]], n[first[-1:]]
        pairs = np.unique(np.stack([head[many], c[many], n[many]]), axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in pairs], ["pivot", "member", "n"])


def _groups(docs: DataFrame, n: int, percent: int, shared) -> DataFrame:
    """Distinct (pivot, member, n) of classes that share a prefix n-gram."""
    rows = docs.select("text").mapInArrow(_prefix_rows(n, percent, shared), "n bigint, node bigint, sign bigint, prefix array<bigint>")
    # read twice, so written: the texts are hashed once for it
    classes = written(rows.groupBy("n", "node", "sign").agg(F.first("prefix").alias("prefix")).select(F.col("node").alias("class"), "n", "prefix"))
    is_hot = lambda gram: F.shiftrightunsigned(gram, 56) >= HOT_CLASS
    grams = lambda keep: classes.select(F.explode(F.filter("prefix", keep)).alias("gram"), "class", "n")
    cold = grams(lambda g: ~is_hot(g)).repartition("gram").sortWithinPartitions("gram", "class").mapInArrow(K.tidied(_runs), "pivot bigint, member bigint, n bigint")
    # n-grams of very many documents: the pivot by partial aggregation, the join back salted
    warm = grams(is_hot).withColumn("salt", F.pmod(F.xxhash64("class"), F.lit(SALT)).cast("int"))
    pivots = warm.groupBy("gram").agg(F.min("class").alias("pivot"), F.count("*").alias("many")).filter(F.col("many") > 1)
    pivots = pivots.select("gram", "pivot", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt"))
    warm = warm.join(pivots, ["gram", "salt"]).select("pivot", F.col("class").alias("member"), "n")
    return cold.unionByName(warm).distinct()


def _blocks(groups: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """((pivot, member, block), (pivot, i, j, near)): the blocks of each group, and the pairs of them,
    i <= j, whose sizes fit; near ones are neighbours, or all that a group of two blocks has.

    Blocks are laid out from the members of each size, counted before; members of one size are
    dealt by hash to the blocks that their size takes.
    """
    groups = written(groups)
    by_size = Window.partitionBy("pivot").orderBy("n")  # one row for each size in a group
    weight = F.col("many") * F.greatest(F.col("n"), F.lit(BLOCK_GRAMS // BLOCK_MEMBERS))
    near = (F.col("many") > 1) | (100 * F.lag("n").over(by_size) >= percent * F.col("n")) | (100 * F.col("n") >= percent * F.lead("n").over(by_size))
    sizes = groups.groupBy("pivot", "n").agg(F.count("*").alias("many")).withColumn("weight", weight).withColumn("near", F.coalesce(near, F.lit(False))).filter("near")
    upto = F.sum("weight").over(by_size.rowsBetween(Window.unboundedPreceding, 0))
    sizes = sizes.withColumn("first", F.floor((upto - F.col("weight")) / BLOCK_GRAMS)).withColumn("last", F.floor((upto - 1) / BLOCK_GRAMS)).select("pivot", "n", "first", "last")
    dealt = F.col("first") + F.pmod(F.xxhash64("member"), F.col("last") - F.col("first") + 1)
    g = written(groups.join(sizes, ["pivot", "n"]).select("pivot", "member", "n", dealt.alias("block")))
    blocks = g.groupBy("pivot", "block").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    blocks = blocks.withColumn("place", F.row_number().over(Window.partitionBy("pivot").orderBy("block")))  # one row a block
    a = blocks.select("pivot", F.col("block").alias("i"), "high", F.col("place").alias("at"))
    b = blocks.select("pivot", F.col("block").alias("j"), "low", F.col("place").alias("to"))
    pairs = a.join(b, "pivot").filter((F.col("at") <= F.col("to")) & (100 * F.col("high") >= percent * F.col("low")))
    return g.select("pivot", "member", "block"), written(pairs.select("pivot", "i", "j", (F.col("to") - F.col("at") <= 1).alias("near")))


#: Parts of a block, as blocks of their own numbers: all members, those outside of the group's
#: largest component so far, and those in it.
ALL, OUTSIDE, CORE, PARTS = 0, 1, 2, 3


def _units(members: DataFrame, pairs: DataFrame) -> DataFrame:
    """(pivot, i, j, block, member): which members meet in which pairs of blocks."""
    places = pairs.select("pivot", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("block"))
    return members.join(places, ["pivot", "block"]).select("pivot", "i", "j", "block", "member")


def _part(members: DataFrame, part: int) -> DataFrame:
    return members.select("pivot", "member", (F.col("block") * PARTS + part).alias("block"))


def _pair(pairs: DataFrame, left: int, right: int) -> DataFrame:
    return pairs.select("pivot", (F.col("i") * PARTS + left).alias("i"), (F.col("j") * PARTS + right).alias("j"))


def bucket_counts(grams: np.ndarray) -> bytes:
    """How many n-grams fall in each of 2**k buckets (one or two a bucket), a byte each; empty
    if a count doesn't fit."""
    buckets = 1 << min(14, max(4, (len(grams) // 2).bit_length()))
    count = np.bincount((grams & np.uint64(buckets - 1)).astype(np.int64), minlength=buckets)
    return count.astype(np.uint8).tobytes() if count.max() < 256 else b""


def may_link(sizes: np.ndarray, counts: list[bytes], side: np.ndarray | None, percent: int) -> np.ndarray:
    """Which sets, given in order of size, can link with another (on the other side).

    The intersection is at most the sum over buckets of the smaller count.
    """
    kept = np.zeros(len(sizes), dtype=bool)
    width = np.array([len(c) for c in counts])
    tables = {int(w): np.frombuffer(b"".join(c for c in counts if len(c) == w), dtype=np.uint8).reshape(-1, w) for w in np.unique(width) if w}
    halved = {w: t.reshape(len(t), 2, -1).astype(np.uint16).sum(axis=1).astype(np.uint16) for w, t in tables.items() if w // 2 in tables}
    row = np.zeros(len(sizes), dtype=np.int64)
    for w in tables:
        row[width == w] = np.arange((width == w).sum())
    last = np.searchsorted(sizes * percent, sizes * 100, "right")  # sets of up to 100/percent times the size
    for i in range(len(sizes)):
        near = np.arange(i + 1, last[i])
        if side is not None:
            near = near[side[near] != side[i]]
        if kept[i]:
            near = near[~kept[near]]
        if not len(near):
            continue
        fits = np.ones(len(near), dtype=bool)
        w = int(width[i])
        for table, of in ((tables, w), (halved, 2 * w)):
            here = width[near] == of
            if w and of in table and here.any():
                shared = np.minimum(table[of][row[near[here]]], tables[w][row[i]]).sum(axis=1, dtype=np.int64)
                fits[here] = (100 + percent) * shared >= percent * (sizes[i] + sizes[near[here]])
        if fits.any():
            kept[i] = True
            kept[near[fits]] = True
    return kept


def _members(docs: DataFrame, classes: DataFrame, members: DataFrame, n: int, payload, name: str) -> DataFrame:
    """(member, size, payload of the set) of these classes, from the document that each is taken
    from; a few rows more, and rows that repeat one."""
    ids = written(classes.join(members, classes.node == members.member, "left_semi").select("class_id"))
    docs = docs.select("doc_id", "text")
    if ids.count() > bloom.MOST:  # too many for bits of bounded size
        docs, shared = docs.join(ids.distinct(), docs.doc_id == ids.class_id, "left_semi"), None
    else:
        shared = docs.sparkSession.sparkContext.broadcast(bloom.bits_of(ids))

    def rows(batches):
        for batch in batches:
            want = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            if shared:
                want = want & bloom.may_hold(shared.value, batch.column(0).fill_null(-1).to_numpy())
            for _, _, buf, offs in K.chunks(batch.filter(pa.array(want)).column(1)):
                sets = gram_sets(buf, offs, n)
                size = np.array([len(s) for s in sets], dtype=np.int64)
                node, _ = _names([signature(s) for s in sets], size)
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(size), pa.array([payload(s) for s in sets], pa.binary())], ["member", "size", name])

    return docs.mapInArrow(K.tidied(rows), f"member bigint, size bigint, {name} binary")


def _by_unit(batches, handle):
    """Calls handle((pivot, i, j), rows) for each unit; rows come in order of unit and are
    (block, member, size, payload), each member once a block."""
    key, held = None, []
    for batch in batches:
        for pivot, i, j, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if (pivot, i, j) != key:
                if held:
                    yield handle(key, held)
                key, held = (pivot, i, j), []
            if not held or held[-1][:2] != row[:2]:
                held.append(row)
    if held:
        yield handle(key, held)


def _placed(units: DataFrame, members: DataFrame, order: list[str]) -> DataFrame:
    d = units.join(members, "member").select("pivot", "i", "j", "block", "member", "size", members.columns[-1])
    return d.repartition("pivot", "i", "j").sortWithinPartitions("pivot", "i", "j", *order)


def _pruned(units: DataFrame, docs: DataFrame, classes: DataFrame, n: int, percent: int) -> DataFrame:
    """The rows of ``units`` whose set can link with another in the unit, by bucket counts."""

    def keep(key, rows):
        sizes, blocks = np.array([r[2] for r in rows]), np.array([r[0] for r in rows])
        kept = may_link(sizes, [r[3] for r in rows], None if key[1] == key[2] else blocks, percent)
        rows = [r for r, k in zip(rows, kept) if k]
        return pa.RecordBatch.from_arrays([*(pa.array([x] * len(rows), pa.int64()) for x in key), *(pa.array([r[k] for r in rows], pa.int64()) for k in (0, 1))], ["pivot", "i", "j", "block", "member"])

    counts = _members(docs, classes, units.select("member").distinct(), n, bucket_counts, "counts")
    return _placed(units, counts, ["size", "member", "block"]).mapInArrow(K.tidied(lambda batches: _by_unit(batches, keep)), "pivot bigint, i bigint, j bigint, block bigint, member bigint")


def _walker(percent: int, shared):
    def walk(batches):
        classes = shared.value

        def links(key, rows):
            sides = [([r[1] for r in rows if r[0] == k], [ordered(np.frombuffer(r[3], dtype=np.uint64), classes) for r in rows if r[0] == k]) for k in dict.fromkeys(key[1:])]
            found = unit_links(sides[0], sides[1] if len(sides) > 1 else None, percent)
            return pa.RecordBatch.from_arrays([pa.array([key[0]] * len(found), pa.int64()), *(pa.array([x[k] for x in found], pa.int64()) for k in (0, 1))], ["pivot", "a", "b"])

        yield from _by_unit(batches, links)

    return K.tidied(walk)


def components(links: DataFrame) -> DataFrame:
    """(node, component) of the connected components of (a, b) links, named after their least
    node, by alternating large and small stars; every round is written to the shared folder."""
    pairs = written(links.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = None
    while True:
        both = pairs.select("u", "v").unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter(F.col("u") != F.col("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v"))).filter(F.col("u") != F.col("v")).distinct()
        pairs = written(small)
        now = tuple(pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.countDistinct("u")).first())
        if now == state or (now[0] == now[2] and not pairs.select("v").join(pairs.select(F.col("u").alias("v")), "v", "left_semi").head(1)):
            least = F.col("v").alias("component")
            return pairs.select(F.col("u").alias("node"), least).unionByName(pairs.select(F.col("v").alias("node"), least).distinct())
        state = now


def jaccard_links(docs: DataFrame, classes: DataFrame, sketch: np.ndarray, n: int = 5, percent: int = 75) -> DataFrame:
    """Links (a, b) between classes that give the join's components; ``docs`` has doc_id and text,
    ``classes`` their node and class_id.

    In a group of more than two blocks neighbours are compared first.  Of the other pairs of blocks only
    those members are compared that aren't both in the group's largest component by then, so a large
    group of near copies takes work in proportion to its blocks, and no link between components is lost.
    """
    shared = docs.sparkSession.sparkContext.broadcast(sketch)  # 4 MB at any size

    def found(units: DataFrame) -> DataFrame:
        with last_table_only(docs.sparkSession):
            units = written(_pruned(written(units), docs, classes, n, percent))
            sets = _members(docs, classes, units.select("member").distinct(), n, np.ndarray.tobytes, "grams")
            return written(_placed(units, sets, ["block", "member"]).mapInArrow(_walker(percent, shared), "pivot bigint, a bigint, b bigint").distinct())

    members, pairs = _blocks(_groups(docs, n, percent, shared), percent)
    links = found(_units(_part(members, ALL), _pair(pairs.filter("near"), ALL, ALL)))
    far = pairs.filter("NOT near")
    if not far.isEmpty():
        large = far.select("pivot").distinct()
        known = components(links.join(large, "pivot", "left_semi").select("a", "b"))
        m = members.join(large, "pivot", "left_semi").join(known, members.member == known.node, "left").select("pivot", "member", "block", F.coalesce("component", "member").alias("component"))
        core = m.groupBy("pivot", "component").agg(F.count("*").alias("n")).groupBy("pivot").agg(F.max_by("component", F.struct("n", "component")).alias("core"))
        m = written(m.join(core, "pivot").select("pivot", "member", "block", (F.col("component") == F.col("core")).alias("inside")))
        inside, outside = m.filter("inside"), m.filter("NOT inside")
        parts = _part(m, ALL).unionByName(_part(outside, OUTSIDE)).unionByName(_part(inside, CORE))
        there = parts.select("pivot", "block").distinct()
        more = _pair(far, OUTSIDE, ALL).unionByName(_pair(far, CORE, OUTSIDE))
        for side in ("i", "j"):
            more = more.join(there.withColumnRenamed("block", side), ["pivot", side], "left_semi")
        links = links.unionByName(found(_units(parts, more)))
    return links.select("a", "b").distinct()


def ngram_jaccard(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 75) -> DataFrame:
    """(doc_id, row_key, n_shingles, class_id, component_id, group_key) of every document row.

    ``class_id`` is the smallest id with the same set, ``component_id`` the smallest id
    reachable by links.  ``group_key`` is the same for all rows of a component, and null for empty
    sets; ``row_key`` is the hash of the text.
    """
    docs = documents.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("row_key"), F.col(text_col).cast("string").alias("text"))
    table = written(docs.mapInArrow(_signed_rows(n), "doc_id bigint, row_key bigint, n bigint, node bigint, sign bigint, slice bigint, counts binary"))
    slim = table.filter(F.col("slice").isNull()).select("doc_id", "row_key", "n", "node", "sign")
    key = ["n", "node", "sign"]
    classes = written(slim.filter(F.col("n") > 0).groupBy(*key).agg(F.min("doc_id").alias("class_id"), F.count("*").alias("rows")))
    known = classes.filter(F.col("class_id").isNotNull())
    with last_table_only(documents.sparkSession):
        found = components(jaccard_links(docs, known, _sketch(table.filter(F.col("slice").isNotNull()).select("slice", "counts")), n, percent))
    linked = classes.join(found, "node").select(*key, "class_id", "component")
    least = linked.groupBy("component").agg(F.min("class_id").alias("component_id"))
    linked = linked.join(least, "component").select(*key, "component", "component_id")
    # a class of one row without links needs no row here
    named = classes.join(linked, key, "left").filter((F.col("rows") > 1) | F.col("component").isNotNull()).drop("rows")
    named = named.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    slim = slim.withColumn("salt", F.pmod(F.xxhash64("doc_id", "row_key"), F.lit(SALT)).cast("int"))
    out = slim.join(named, [*key, "salt"], "left")
    group = F.when(F.col("n") > 0, F.coalesce("component", "node"))
    return out.select("doc_id", "row_key", F.col("n").alias("n_shingles"), F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("component_id", "class_id", "doc_id").alias("component_id"), group.alias("group_key"))


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over all of ``documents``."""
    return ngram_jaccard(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_shingles", "component_id")


SQL = r"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS MATERIALIZED (SELECT DISTINCT doc_id, md5_number(array_to_string(w[i:i + 4], ' ')) AS gram FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM d WHERE len(w) > 0)),
c AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS MATERIALIZED (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both_have FROM g x JOIN g y ON x.gram = y.gram AND x.doc_id <> y.doc_id GROUP BY ALL)
      JOIN c ca ON ca.doc_id = a JOIN c cb ON cb.doc_id = b WHERE 100 * both_have >= 75 * (ca.n + cb.n - both_have)),
r AS (SELECT doc_id, doc_id AS reached FROM d UNION SELECT r.doc_id, p.b FROM r JOIN p ON r.reached = p.a)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, m.component_id FROM d LEFT JOIN c USING (doc_id) JOIN (SELECT doc_id, min(reached) AS component_id FROM r GROUP BY doc_id) m ON m.doc_id = d.doc_id
"""
