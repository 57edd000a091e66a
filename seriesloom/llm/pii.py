"""PII: patterns, and information-theoretic sanitisation of revealing terms.

Base spans are e-mail addresses, IP addresses, card numbers and phone numbers (leftmost,
not overlapping within a kind, checked afterwards).  Protected entities are each distinct value,
what it belongs to (an address's owner name and domain, an IP address's network), all values of its
kind together, and credentials: values that stand behind a label such as ``token =``.

Method: a word within ``near`` words of a span, or inside a labelled value, is a term that may
reveal its entities.  With n(t) texts that have the term, n(e) that have the entity, n(t, e)
that have the term near the entity and N texts in all, the term tells
log2(n(t, e) * N / (n(t) * n(e))) bits of the entity's own log2(N / n(e)) bits; their ratio
is the share disclosed, at certainty n(t, e) / n(t).  Terms that reach ``share`` and
``certainty`` for some entity, in ``support`` joint texts, are disclosed, and their occurrences
anywhere are spans: of kind ``secret`` if a label discloses them (for these one text is enough, as
the label itself is the evidence and a secret is seldom repeated), else of kind ``term``.  They
are generalised to [SECRET] and [TERM] as base spans are to [EMAIL] and so on.  Neither measure
depends on the table's size or on how common the entity is.  An entity in every text has no
information to tell.

All counts cover all texts.  Joint counts are of texts with entities only.  n(t) is at least the
number of texts with the term in the runs of text where it is near an entity, so words too common
there are no candidates; for the others n(t) is counted over all texts, found by Bloom bits and
then joined exactly.

Defined results: null or empty texts have no spans; texts of any length are read whole; copies of
a text count as texts; a term at a limit is disclosed; repeated rows each get a row; words that
touch a base span are no terms; other columns pass through :func:`sanitised_documents` untouched;
an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.llm import bloom
from seriesloom.llm import textkit as K
from seriesloom.sources.tables import written

KINDS = ("email", "ip", "card", "phone")
_LOCAL = np.zeros(256, dtype=bool)
_LOCAL[48:58] = _LOCAL[65:91] = _LOCAL[97:123] = True
_LOCAL[np.frombuffer(b"._%+-", dtype=np.uint8)] = True
_DOMAIN = rb"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = rb"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = rb"[0-9](?:[ -]?[0-9])++"
_PHONE = rb"\+[0-9][ ().0-9-]+[0-9]"
#: Labels of credentials, before a sign of assignment, and the value behind it.
_LABEL = re.compile(rb"(?<![0-9a-z])(api[ _-]?key|access[ _-]?key|secret[ _-]?key|private[ _-]?key|secret|token|password|passwd|pwd|credentials?|authorization|bearer)[\"']?[ \t]*\Z", re.IGNORECASE)
_VALUE = re.compile(rb"[=:>]+[ \t]*[\"'`]?([^\s\"'`,;]{4,})")


def luhn(digits: bytes) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d -= 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _digits(piece: bytes) -> bytes:
    return re.sub(rb"[^0-9]", b"", piece)


def base_spans(text: bytes, buf: np.ndarray) -> list[tuple[int, int, int]]:
    """(kind, start, end) in bytes over texts joined by line ends, by kind, then start."""
    found = []
    at_signs = np.flatnonzero(buf == 64)
    if len(at_signs):
        other = np.concatenate([[-1], np.flatnonzero(~_LOCAL[buf])])
        begins = other[np.searchsorted(other, at_signs) - 1] + 1
        domain, last = re.compile(_DOMAIN), 0
        for p, begin in zip(at_signs.tolist(), begins.tolist()):
            begin = max(begin, last)
            if begin < p and (m := domain.match(text, p + 1)):
                found.append((0, begin, m.end()))
                last = m.end()
    for m in re.finditer(_IP, text):
        if all(len(x.lstrip(b"0")) <= 3 and int(x.lstrip(b"0") or b"0") <= 255 for x in m.group().split(b".")):
            found.append((1, m.start(), m.end()))
    for m in re.finditer(_CARD, text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m.group())) <= 19 and luhn(d):
            found.append((2, m.start(), m.end()))
    for m in re.finditer(_PHONE, text):
        if 9 <= len(_digits(m.group())) <= 15:
            found.append((3, m.start(), m.end()))
    return found


def labelled_values(text: bytes, buf: np.ndarray) -> list[tuple[bytes, int, int]]:
    """(label, start, end) in bytes of the values, of four characters or more, behind a label and ``=`` or ``:``."""
    found, last = [], 0
    for p in np.flatnonzero((buf == 61) | (buf == 58)).tolist():
        if p < last:
            continue
        q = p  # any number of blanks may stand before the sign
        while q > last and text[q - 1] in b" \t":
            q -= 1
        if (label := _LABEL.search(text[max(0, q - 24) : q])) and (value := _VALUE.match(text, p)):
            found.append((re.sub(rb"[^a-z]", b"", label.group(1).lower()), value.start(1), value.end(1)))
            last = value.end(1)
    return found


def _key(*parts: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(b":".join(parts), digest_size=8).digest(), "little", signed=True)


def entities_of(kind: int, value: bytes) -> list[int]:
    """Keys of the protected entities that a base value stands for."""
    name = KINDS[kind].encode()
    if kind >= 2:
        return [_key(name, _digits(value)), _key(name)]
    value = value.lower()
    if kind == 1:
        return [_key(name, value), _key(b"net", value.rpartition(b".")[0]), _key(name)]
    local, _, domain = value.partition(b"@")
    owner = re.sub(rb"[^a-z]+", b" ", local).strip()
    return [_key(name, value), *([_key(b"owner", owner)] if owner else []), _key(b"domain", domain), _key(name)]


class Scan:
    """Base spans, labelled values and words of a run of texts."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray, labels: bool = False):
        n = len(offs) - 1
        # a line end between texts: no pattern crosses it
        shift = np.repeat(np.arange(n), np.diff(offs))
        joined = np.full(len(buf) + n, 10, dtype=np.uint8)
        joined[np.arange(len(buf)) + shift] = buf
        self.text, self.buf, self.offs = joined.tobytes(), buf, offs
        self.starts = offs[:-1] + np.arange(n)
        found = base_spans(self.text, joined)
        self.kind = np.array([k for k, _, _ in found], dtype=np.int64)
        self.own, self.start, self.end = self._placed([(a, b) for _, a, b in found])
        self.value = [self.text[a:b] for _, a, b in found]
        values = labelled_values(self.text, joined) if labels else []
        self.label = [x for x, _, _ in values]
        self.label_own, self.label_start, self.label_end = self._placed([(a, b) for _, a, b in values])
        self.points = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])

    def _placed(self, spans: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        begin, end = (np.array([x[i] for x in spans], dtype=np.int64) for i in (0, 1))
        own = np.searchsorted(self.starts, begin, "right") - 1
        return own, begin - own, end - own

    def terms(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Start, end, text number and hash of the words that touch no base span."""
        start, end, doc = K.words(self.buf, self.offs, K.ALNUM)
        hashes = K.span_hashes(self.buf, start, end, True)
        inside = np.zeros(len(self.buf) + 1, dtype=np.int64)
        np.add.at(inside, self.start, 1)
        np.add.at(inside, self.end, -1)
        inside = np.concatenate([[0], np.cumsum(np.cumsum(inside)[:-1] > 0)])
        free = inside[end] == inside[start]
        return start[free], end[free], doc[free], hashes[free]

    def places(self, own: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[str]:
        """start:end in code points of the text."""
        zero = self.points[self.offs[own]]
        return [f"{a}:{b}" for a, b in zip((self.points[start] - zero).tolist(), (self.points[end] - zero).tolist())]


def _counted(own: np.ndarray, *keys: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct keys and the number of texts with each."""
    each = np.unique(np.stack([*keys, own]), axis=1)[:-1]
    pairs, n = np.unique(each, axis=1, return_counts=True)
    return list(pairs), n


def _joint_rows(entity, term, label: bool, n) -> pa.RecordBatch:
    none = lambda x: pa.nulls(len(n), pa.int64()) if x is None else pa.array(x)
    return pa.RecordBatch.from_arrays([none(entity), none(term), pa.array(np.full(len(n), label)), pa.array(np.asarray(n, dtype=np.int64))], ["entity", "term", "label", "n"])


def _context_rows(near: int):
    """(entity, term, label, n): texts with a term near an entity; without a term, texts with the
    entity; without an entity, a lower bound of the texts with the term; without both, texts."""

    def rows(batches):
        for batch in batches:
            yield _joint_rows(None, None, False, [batch.num_rows])
            for _, _, buf, offs in K.chunks(batch.column(0)):
                s = Scan(buf, offs, labels=True)
                if not len(s.start) and not len(s.label):
                    continue
                start, _, doc, hashes = s.terms()
                hashes = hashes.view(np.int64)
                first, last = np.searchsorted(doc, s.own, "left"), np.searchsorted(doc, s.own, "right")
                place = np.clip(np.searchsorted(start, s.start), first, last)
                around = np.maximum(first, place - near), np.minimum(last, place + near)
                inside = np.searchsorted(start, s.label_start), np.searchsorted(start, s.label_end)
                close = []
                for label, own, keys, (a, b) in ((False, s.own, [entities_of(k, v) for k, v in zip(s.kind.tolist(), s.value)], around), (True, s.label_own, [[_key(b"label", x), _key(b"label")] for x in s.label], inside)):
                    if not len(own):
                        continue
                    many = np.array([len(x) for x in keys])
                    entity, of, a, b = np.array([e for x in keys for e in x], dtype=np.int64), np.repeat(own, many), np.repeat(a, many), np.repeat(b, many)
                    (only,), n = _counted(of, entity)
                    yield _joint_rows(only, None, label, n)
                    (e, t), n = _counted(np.repeat(of, b - a), np.repeat(entity, b - a), K.take_pieces(hashes, a, b - a))
                    yield _joint_rows(e, t, label, n)
                    close.append(t)
                here = np.isin(hashes, np.concatenate(close))
                (term,), n = _counted(doc[here], hashes[here])
                yield _joint_rows(None, term, False, n)

    return K.tidied(rows)


def _candidate_pairs(shared):
    """The pairs whose term may be a candidate."""

    def rows(batches):
        bits = shared.value
        for batch in batches:
            yield batch.filter(pa.array(bloom.may_hold(bits, batch.column(1).to_numpy())))

    return K.tidied(rows)


def _term_counter(shared):
    """(term, texts) of the terms that may be candidates."""

    def rows(batches):
        bits = shared.value
        for batch in batches:
            terms = []
            for lo, hi, buf, offs in K.chunks(batch.column(0)):
                start, end, doc = K.words(buf, offs, K.ALNUM)
                hashes = K.span_hashes(buf, start, end, True).view(np.int64)
                may = bloom.may_hold(bits, hashes)
                terms.append(np.unique(np.stack([doc[may], hashes[may]]), axis=1)[1])
            term, n = np.unique(np.concatenate(terms), return_counts=True) if terms else (np.zeros(0, np.int64),) * 2
            yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(n)], ["term", "texts"])

    return K.tidied(rows)


def disclosed_terms(documents: DataFrame, text_col: str = "text", near: int = 8, support: int = 2, certainty: float = 0.5, share: float = 0.5) -> DataFrame:
    """(term, secret, bits, certainty): hashes of the terms that disclose some entity, with the strongest figures."""
    texts = documents.select(F.col(text_col).cast("string").alias("text"))
    joint = written(texts.mapInArrow(_context_rows(near), "entity bigint, term bigint, label boolean, n bigint").groupBy("entity", "term", "label").agg(F.sum("n").alias("n")))
    total = joint.filter(F.col("term").isNull() & F.col("entity").isNull()).agg(F.sum("n")).first()[0]
    entities = joint.filter(F.col("term").isNull() & F.col("entity").isNotNull()).select("entity", F.col("n").alias("n_entity"))
    enough = F.col("n") >= F.when(F.col("label"), F.lit(1)).otherwise(F.lit(support))
    pairs = joint.filter(F.col("entity").isNotNull() & F.col("term").isNotNull() & enough)
    # n(t) is at least the number of texts with the term where it is near an entity
    most, seen = F.max(F.when(F.col("entity").isNotNull() & enough, F.col("n"))), F.sum(F.when(F.col("entity").isNull(), F.col("n")))
    candidates = joint.filter(F.col("term").isNotNull()).groupBy("term").agg(most.alias("most"), seen.alias("seen"))
    candidates = written(candidates.filter(F.col("most") >= certainty * F.col("seen")).select("term"))
    shared = documents.sparkSession.sparkContext.broadcast(bloom.bits_of(candidates))
    counts = texts.mapInArrow(_term_counter(shared), "term bigint, texts bigint").groupBy("term").agg(F.sum("texts").alias("n_term"))
    kind = "entity bigint, term bigint, label boolean, n bigint"
    scored = pairs.mapInArrow(_candidate_pairs(shared), kind).join(counts, "term").join(entities, "entity")
    told, own = F.log2(F.col("n") * F.lit(float(total or 0)) / (F.col("n_term") * F.col("n_entity"))), F.log2(F.lit(float(total or 0)) / F.col("n_entity"))
    scored = scored.select("term", "label", told.alias("bits"), own.alias("entity_bits"), (F.col("n") / F.col("n_term")).alias("certainty"))
    scored = scored.filter((F.col("entity_bits") > 0) & (F.col("bits") >= share * F.col("entity_bits")) & (F.col("certainty") >= certainty))
    return scored.groupBy("term").agg(F.max("label").alias("secret"), F.max("bits").alias("bits"), F.max("certainty").alias("certainty"))


def _span_rows(shared):
    def rows(batches):
        bits = shared.value
        names = np.array(KINDS, dtype=object)
        for batch in batches:
            for lo, hi, buf, offs in K.chunks(batch.column(2)):
                n = hi - lo
                s = Scan(buf, offs)
                order = np.lexsort((s.start, s.kind, s.own))
                own, kind = s.own[order], s.kind[order]
                base = [f"{k}:{x}" for k, x in zip(names[kind], s.places(own, s.start[order], s.end[order]))]
                start, end, doc, hashes = s.terms()
                may = bloom.may_hold(bits, hashes.view(np.int64))
                start, end, doc, hashes = start[may], end[may], doc[may], hashes[may]
                counts = [pa.array(np.bincount(s.own[s.kind == k], minlength=n)) for k in range(4)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, n), batch.column(1).slice(lo, n), *counts, K.list_array(np.array(base, dtype=object), np.bincount(own, minlength=n), pa.string()), K.list_array(hashes.view(np.int64), np.bincount(doc, minlength=n), pa.int64()), K.list_array(np.array(s.places(doc, start, end), dtype=object), np.bincount(doc, minlength=n), pa.string())],
                    ["doc_id", "row_key", "n_email", "n_ip", "n_card", "n_phone", "base", "terms", "places"],
                )

    return K.tidied(rows)


def private_spans(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """(doc_id, row_key, n_email, n_ip, n_card, n_phone, base, term_spans) of every document row;
    spans are kind:start:end in code points, in order; ``term_spans`` has those of kind secret, then term."""
    terms = written(disclosed_terms(documents, text_col, **how))
    shared = documents.sparkSession.sparkContext.broadcast(bloom.bits_of(terms.select("term")))
    docs = documents.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("row_key"), F.col(text_col).cast("string").alias("text"))
    rows = docs.mapInArrow(_span_rows(shared), "doc_id bigint, row_key bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base array<string>, terms array<bigint>, places array<string>")
    rows = written(rows)
    # the terms of equal rows are the same, so they are looked up once
    each = rows.filter(F.size("terms") > 0).dropDuplicates(["doc_id", "row_key"]).select("doc_id", "row_key", F.posexplode(F.arrays_zip("terms", "places")).alias("at", "x"))
    each = each.select("doc_id", "row_key", "at", F.col("x.terms").alias("term"), F.col("x.places").alias("place")).join(terms.select("term", "secret"), "term")
    each = each.withColumn("span", F.concat(F.when(F.col("secret"), "secret:").otherwise("term:"), "place"))
    found = each.groupBy(F.struct("doc_id", "row_key").alias("found_key")).agg(F.array_sort(F.collect_list(F.struct((~F.col("secret")).alias("other"), "at", "span"))).alias("found"))
    key = F.struct("doc_id", "row_key")
    out = rows.join(found, key.eqNullSafe(F.col("found_key")), "left")
    return out.select("doc_id", "row_key", "n_email", "n_ip", "n_card", "n_phone", "base", F.coalesce(F.transform("found", lambda x: x.span), F.array().cast("array<string>")).alias("term_spans"))


def _sanitiser(at: int, spans_at: int, names: list[str]):
    def clean(batches):
        for batch in batches:
            texts, spans = batch.column(at).to_pylist(), batch.column(spans_at).to_pylist()
            for i, found in enumerate(spans):
                if found:
                    out, last = [], 0
                    for start, end, kind in sorted((int(a), int(b), k) for k, a, b in (x.split(":") for x in found)):
                        if start >= last:
                            out += [texts[i][last:start], f"[{kind.upper()}]"]
                        last = max(last, end)
                    texts[i] = "".join(out) + texts[i][last:]
            yield pa.RecordBatch.from_arrays([pa.array(texts, batch.schema.field(at).type) if k == at else c for k, c in enumerate(batch.columns) if k != spans_at], names)

    return clean


def sanitised_documents(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``documents`` with all spans generalised to their kind in brackets."""
    names = documents.columns
    found = private_spans(documents, id_col, text_col, **how).dropDuplicates(["doc_id", "row_key"])
    found = found.select(F.struct("doc_id", "row_key").alias("found_key"), F.concat("base", "term_spans").alias("found_spans"))
    d = documents.select(F.struct(*names).alias("kept_row"), F.struct(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("row_key")).alias("row_at"))
    d = d.join(found, d.row_at.eqNullSafe(found.found_key), "left").select("kept_row.*", F.col("found_spans").alias("private_spans_"))
    return d.mapInArrow(_sanitiser(names.index(text_col), len(names), names), documents.schema)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over all of ``documents``; besides, the numbers of secrets and other disclosed terms."""
    found = private_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    secrets = F.size(F.filter("term_spans", lambda x: x.startswith("secret:"))).cast("bigint")
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(F.array_join("base", ","), 256).alias("base_sha256"), F.array_join(F.concat("base", "term_spans"), ",").alias("spans"), secrets.alias("n_secrets"), (F.size("term_spans") - secrets).cast("bigint").alias("n_terms"))
