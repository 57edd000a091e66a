"""Queries against their SQL, or against brute force where SQL can't express them."""

import hashlib
import re
import zlib

import numpy as np
import pytest

from seriesloom.llm import registry
from tests.comparing import same


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_equals_its_sql(spark, sql, name):
    con, folder = sql
    same(registry.QUERIES[name](spark, folder), con.execute(registry.SQL[name]).df())


def texts(sql):
    return dict(sql[0].execute("SELECT doc_id, text FROM documents").fetchall())


def test_tokens_equal_direct_encoding(spark, sql):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer, start = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in registry.QUERIES["op6_token_ids"](spark, sql[1]).collect()}
    for doc_id, text in sorted(texts(sql).items()):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        assert got.pop(doc_id) == (start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        start += len(ids)
    assert not got


PATTERNS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(digits[::-1])]
    return sum(x - 9 if x > 9 else x for x in doubled) % 10 == 0


def plain_spans(text):
    found = []
    for kind, pattern in PATTERNS:
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")) or kind == "card" and 13 <= len(digits) <= 19 and luhn(digits) or kind == "phone" and 9 <= len(digits) <= 15:
                found.append(f"{kind}:{m.start()}:{m.end()}")
    return found


def test_private_spans_equal_plain_patterns(spark, sql):
    by_id = texts(sql)
    for r in registry.QUERIES["op7_pii"](spark, sql[1]).collect():
        want = plain_spans(by_id.pop(r.doc_id) or "")
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w.startswith(k) for w in want) for k in ("email", "ip", "card", "phone")]
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and not s.startswith(("term", "secret"))] == want
    assert not by_id


def test_spans_on_random_texts():
    from hypothesis import given, settings
    from hypothesis import strategies as st

    from seriesloom.llm.pii import KINDS, base_spans

    @settings(max_examples=1500, deadline=None)
    @given(st.text(alphabet="a1.@+- (5%49\n0é", max_size=40))
    def check(text):
        raw = text.encode()
        at = lambda p: len(raw[:p].decode())
        assert [f"{KINDS[k]}:{at(a)}:{at(b)}" for k, a, b in base_spans(raw, np.frombuffer(raw, np.uint8))] == plain_spans(text)

    check()


def test_license_queries_find_every_stated_notice(spark, sql):
    notices = {"Apache-2.0": "Licensed under the Apache License, Version 2.0.", "MIT": "Released under the MIT License.", "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.", "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0."}
    by_id = texts(sql)
    for r in registry.QUERIES["op4_license_scan"](spark, sql[1]).collect():
        want = {k for k, v in notices.items() if v in by_id[r.doc_id]}
        assert want <= set(r.licenses.split(","))


def test_toxicity_on_held_out_labels(spark):
    from pyspark.sql import functions as F

    from seriesloom.llm.toxicity import toxicity, train

    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    model = train(docs, labels.filter("doc_id % 2 = 0"))
    assert (np.diff(model.thresholds) > 0).all()
    test = labels.filter("doc_id % 2 = 1").select("doc_id", F.col("toxic").alias("label"))
    found = {(r.label, r.toxic): r["count"] for r in toxicity(docs, model).join(test, "doc_id").groupBy("label", "toxic").count().collect()}
    recall = found[1, True] / (found[1, True] + found.get((1, False), 0))
    kept = found[0, False] / (found[0, False] + found.get((0, True), 0))
    assert recall >= 0.8 and kept >= 0.98
    severity = {r.grade: r.s for r in toxicity(docs, model).groupBy("grade").agg(F.avg("expected_severity").alias("s")).collect()}
    assert severity[0] < severity[1] < severity[2]
