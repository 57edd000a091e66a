"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing extra columns."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from seriesloom.llm import textkit as K
from seriesloom.llm.decontaminate import decontaminate, without_contaminated
from seriesloom.llm.licenses import TEMPLATES, license_scan
from seriesloom.llm.line_dedup import deduplicated_documents, repeated_windows
from seriesloom.llm.mixing import document_sizes, mix, mixed_documents, schedule, source_targets
from seriesloom.llm.ngram_join import Trie, may_link, bucket_counts, ngram_jaccard
from seriesloom.llm.pii import private_spans, sanitised_documents
from seriesloom.llm.quality import quality_rules
from seriesloom.llm.token_ids import PerfectHash, Shard, pack_shard, tokenized
from seriesloom.llm.toxicity import OrdinalModel, toxicity, train, without_toxic
from seriesloom.llm.url_filter import Automaton, filter_urls

#: Extra columns whose names the operators use inside.
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row_key string, n int, size int, host string, copy int, lines int, spans int, member int, passes int, taken string, value string"
LONG = " ".join(f"w{i % 977}x{i // 977}" for i in range(60_000))


def rows(*pairs):
    return [(i, t, None, s, None if t is None else len(t), "k", 1, 2, "h", 3, 4, 5, 6, 7, "t", "v") for i, t, s in pairs]


@pytest.fixture(scope="module")
def docs(spark):
    body = "Alpha beta gamma delta epsilon\nzeta eta theta iota kappa\nlambda mu nu xi omicron pi rho"
    return spark.createDataFrame(rows((1, body, "a"), (2, body, "a"), (2, body, "a"), (3, None, "a"), (4, "", None), (None, body, None), (None, None, None), (5, "uno dos", "b"), (6, LONG, "b"), (7, " \n \t ", "b"), (8, "ñandú é", "b")), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_jaccard_cases(docs, empty):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_jaccard(docs).collect()), key=str)
    assert got == sorted([(1, 13, 1), (2, 13, 1), (2, 13, 1), (None, 13, 1), (3, 0, 3), (4, 0, 4), (None, 0, None), (5, 1, 5), (6, 59_996, 6), (7, 0, 7), (8, 1, 8)], key=str)
    assert ngram_jaccard(empty).count() == 0


def test_jaccard_by_texts_of_shared_ids(spark):
    text = lambda k, *changed: " ".join(f"{k}{'x' if i in changed else ''}{i}" for i in range(60))
    df = spark.createDataFrame([(5, text("a")), (5, text("b")), (2, text("a", 59)), (3, text("b", 0)), (4, text("c")), (5, text("c")), (None, text("d")), (None, text("d"))], "doc_id bigint, text string")
    got = sorted(((r.doc_id, r.component_id) for r in ngram_jaccard(df).collect()), key=str)
    assert got == sorted([(5, 2), (2, 2), (5, 3), (3, 3), (5, 4), (4, 4), (None, None), (None, None)], key=str)


@pytest.mark.parametrize("seed,block,most", [(1, 300_000, 10**6), (2, 3_000, 0)])
def test_jaccard_equals_brute_force(spark, monkeypatch, seed, block, most):
    import seriesloom.llm.ngram_join as N

    monkeypatch.setattr(N, "BLOCK_GRAMS", block)
    monkeypatch.setattr(N, "BLOCK_MEMBERS", 20 if seed == 2 else 1000)
    monkeypatch.setattr(N.bloom, "MOST", most)
    monkeypatch.setattr(N, "HOT_CLASS", 120 if seed == 1 else 20)
    pick = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    base, passage, docs = [pick.choice(words) for _ in range(150)], [pick.choice(words) for _ in range(40)], []
    for i in range(500):
        kind = pick.random()
        if kind < 0.5:
            text = list(base)
            for _ in range(pick.choice([0, 1, 2, 3, 4, 6, 8, 12])):
                text[pick.randrange(len(text))] = pick.choice(words)
        else:
            text = [pick.choice(words) for _ in range(pick.randrange(0, 7))] if kind < 0.6 else passage + [pick.choice(words) for _ in range(pick.randrange(5, 120))]
        docs.append((i, " ".join(text)))
    sets = [frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if (w := t.split()) else frozenset() for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    got = {r.doc_id: r.component_id for r in ngram_jaccard(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)).collect()}
    assert got == {i: find(i) for i in range(len(docs))}


def test_trie_counts_are_exact():
    make = np.random.default_rng(3)
    sets = [np.unique(make.integers(0, 60, make.integers(1, 40)).astype(np.uint64)) for _ in range(60)]
    got = {(y, int(x)) for y, found in Trie(sets).walk(sets, 50) for x in found}
    want = {(y, x) for y in range(60) for x in range(60) if 100 * len(np.intersect1d(sets[x], sets[y])) >= 50 * len(np.union1d(sets[x], sets[y]))}
    assert got == want
    ordered = sorted(sets, key=len)
    kept = may_link(np.array([len(s) for s in ordered]), [bucket_counts(s) for s in ordered], None, 50)
    linked = {x for y in range(60) for x in range(60) if x != y and 100 * len(np.intersect1d(ordered[x], ordered[y])) >= 50 * len(np.union1d(ordered[x], ordered[y]))}
    assert linked <= set(np.flatnonzero(kept))


def test_decontamination_cases(spark, docs, empty):
    items = spark.createDataFrame([(1, "zeta ETA theta iota kappa lambda mu nu xi omicron", 0), (1, "zeta ETA theta iota kappa lambda mu nu xi omicron", 0), (10, "UNO, dos", 0), (2, None, 0), (3, "", 0), (None, "ñandú", 0)], "item_id bigint, text string, words int")
    got = {(r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in decontaminate(docs, items).collect()}
    assert {(1, 17, 10, ("1",), True), (None, 17, 10, ("1",), True), (3, 0, 0, (), False), (5, 2, 2, ("10",), True), (8, 2, 1, (), True), (7, 0, 0, (), False)} <= got
    long = items.unionByName(spark.createDataFrame([(7, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi", 0)], items.schema))
    one, many = (sorted(((r.doc_id, r.n_hit, tuple(r["items"]), tuple(r.spans)) for r in decontaminate(docs, long, index_words=k).collect()), key=str) for k in (10**6, 3))
    assert one == many and len(one) == docs.count()  # the joined form gives the same rows
    for k in (10**6, 3):
        kept = without_contaminated(docs, items, index_words=k)
        assert kept.columns == docs.columns and sorted((r.doc_id for r in kept.collect()), key=str) == sorted([3, 4, None, 6, 7], key=str)
    assert decontaminate(empty, items).count() == 0 and decontaminate(docs, items.limit(0)).filter("contaminated").count() == 0
    assert decontaminate(empty, long, index_words=3).count() == 0 and without_contaminated(empty, long, index_words=3).count() == 0


def test_decontamination_of_any_size_against_plain_python(spark):
    """Windows that many items own, passages that many documents hold, overlapping and touching hits, short items."""
    pick = np.random.default_rng(5)
    words = [f"w{i}" for i in range(12)]  # few words, so shingles and windows repeat
    some = lambda n: " ".join(pick.choice(words, n))
    passage = some(25)
    items = [(f"i{k}", passage if k % 3 == 0 else some(int(pick.integers(0, 30)))) for k in range(90)] + [("short", "only here"), ("one", "w3x"), (None, "nobody owns this")]
    texts = [some(int(pick.integers(0, 60))) for _ in range(60)] + [some(5) + " " + passage + " " + passage] * 40
    texts += [items[int(k)][1] + " ONLY, here w3x " + some(9) for k in pick.integers(0, 90, 40)] + ["nobody owns this", None, "", passage.upper()]
    windows = {}
    for item, text in items:
        w = text.split()
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[i : i + 10]), set()).add(item)
    expected = []
    for i, text in enumerate(texts):
        w, hit, owners = (text or "").lower().replace(",", "").split(), set(), set()
        for k in {len(x) for x in windows}:
            for at in range(len(w) - k + 1):
                if tuple(w[at : at + k]) in windows:
                    hit |= set(range(at, at + k))
                    owners |= windows[tuple(w[at : at + k])]
        spans = [(a, next(b for b in range(a, len(w) + 1) if b not in hit)) for a in sorted(hit) if a - 1 not in hit]
        expected.append((i, len(w), len(hit), tuple(sorted(owners - {None})), tuple(spans)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5)
    bench = spark.createDataFrame(items, "item_id string, text string")
    for index_words in (10**6, 100):
        found = decontaminate(docs, bench, index_words=index_words)
        assert sorted((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), tuple((s.start, s.end) for s in r.spans)) for r in found.collect()) == expected
        assert {r.doc_id for r in without_contaminated(docs, bench, index_words=index_words).collect()} == {x[0] for x in expected if not x[2]}


def test_quality_cases(docs, empty):
    got = {(r.doc_id, r.n_words, r.n_dup_lines, r.base_failed, r.kept) for r in quality_rules(docs).collect()}
    assert (6, 60_000, 0, False, True) in got and (3, 0, 0, True, False) in got
    assert quality_rules(docs).count() == docs.count() and quality_rules(empty).count() == 0
    limited = quality_rules(docs, line_floor=1, min_words=1)  # two documents of the host have these lines, one of them twice
    assert {(r.doc_id, r.n_removed_words, r.depleted, r.kept) for r in limited.collect() if r.doc_id in (1, 2)} == {(1, 17, True, False), (2, 17, True, False)}
    assert limited.filter("doc_id = 2").count() == 2 and not limited.filter("doc_id = 6").first().depleted


def test_frequent_lines_by_the_defaults(spark):
    plain = lambda i: " ".join(f"w{i}x{k}" for k in range(60))
    rows = []
    for size in (40, 400):  # the same share of two hosts
        n = size // 10
        rows += [(len(rows) + i, plain(len(rows) + i) + ("\nShare this  PAGE\n" + plain(99_999) if i < n else ""), f"h{size}") for i in range(size)]
    rows += [(10_000, "only once\n" + plain(7), "h9")] * 150  # rows of one document
    rows += [(20_000 + i, "in three\n" + plain(8) if i < 3 else plain(20_000 + i), "h10") for i in range(9)]
    got = quality_rules(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).groupBy("host", "n_removed_words", "kept").count().collect()
    assert sorted((r.host, r.n_removed_words, r.kept, r["count"]) for r in got) == [("h10", 0, True, 9), ("h40", 0, True, 36), ("h40", 63, True, 4), ("h400", 0, True, 360), ("h400", 63, True, 40), ("h9", 0, True, 150)]


def test_repeat_words(spark):
    df = spark.createDataFrame([(1, "a a a a b c d\nx\nx\n \n", "s"), (2, "p q r s p q r t", "s")], "doc_id bigint, text string, source string")
    got = {r.doc_id: (r.n_repeat_words, r.n_dup_lines, r.word_chars) for r in quality_rules(df).collect()}
    assert got == {1: (4, 1, 9), 2: (6, 0, 8)}


def test_line_dedup_cases(spark, docs, empty):
    got = sorted(((r.doc_id, r.n_lines, tuple(r.covered)) for r in repeated_windows(docs).collect()), key=str)
    assert ((None, 3, ()) in got) and got.count((2, 3, (0, 1, 2))) == 2 and (3, 0, ()) in got  # a null id comes first
    kept = deduplicated_documents(docs)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    assert kept.filter("doc_id = 3").first().text is None and kept.filter("doc_id = 1").first().text == ""
    df = spark.createDataFrame([(1, "a\nb\nc\nd"), (2, "z\na\n\n b \nC\nq")], "doc_id bigint, text string")
    assert deduplicated_documents(df).filter("doc_id = 2").first().text == "z\n\nq"
    df = spark.createDataFrame([(1, "h\nx\nx\nx\nx\nx\nt"), (2, "a\nb\n" * 4), (3, "b\na\nb\nend")], "doc_id bigint, text string")
    got = {r.doc_id: r.text for r in deduplicated_documents(df).collect()}
    assert got == {1: "h\nx\nx\nx\nt", 2: "a\nb\na\nb\n", 3: "end"}  # lines of a first occurrence stay, if only later ones of its own text overlap it
    assert deduplicated_documents(empty).count() == 0


def plain_pieces(text):
    """Brute force: lines and pieces of lines as word lists, each with its line."""
    out = []
    for number, line in enumerate((text or "").split("\n")):
        words = [w for w in __import__("re").split("[ \t-\r]+", line) if w]
        size = [len(w.encode()) for w in words]
        value = [(7 * n + 5 * (size[k - 1] if k else 0) + 3 * (size[k - 2] if k > 1 else 0)) % 11 for k, n in enumerate(size)]
        piece = []
        for k, w in enumerate(words):
            piece.append(w)
            if 4 <= k < len(words) - 4 and value[k] < min(value[k - 4 : k]) and value[k] <= min(value[k + 1 : k + 5]):
                out.append((number, piece))
                piece = []
        if piece:
            out.append((number, piece))
    return out


def test_passages_inside_long_lines_are_found(spark, monkeypatch):
    monkeypatch.setattr("seriesloom.llm.line_dedup.HOT", 3)
    pick = random.Random(3)
    words = [f"{'abcdefghij'[i % 10] * (1 + i % 7)}{i}" for i in range(3000)]
    passage = [pick.choice(words) for _ in range(60)]
    texts = []
    for i in range(40):
        own = lambda n: [pick.choice(words) for _ in range(n)]
        inside = passage if i % 2 else []
        w = own(pick.randrange(1, 90)) + inside + own(pick.randrange(1, 90))
        texts.append("".join(x + pick.choice([" ", " ", " ", "\n"] if x not in inside else [" "]) for x in w))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: r.covered for r in repeated_windows(df).collect()}
    seen, want = {}, {}
    for i, t in enumerate(texts):
        pieces = [tuple(w) for _, w in plain_pieces(t)]
        later, first = set(), set()
        for k in range(len(pieces) - 2 if len(pieces) > 2 else min(1, len(pieces))):
            at = seen.setdefault(tuple(pieces[k : k + 3]), (i, k))
            if at != (i, k):
                later |= set(range(k, min(k + 3, len(pieces))))
                first |= set(range(at[1], at[1] + 3)) if at[0] == i and k - at[1] < 3 else set()
        want[i] = sorted(later - first)
    assert found == want
    kept = {r.doc_id: r.text for r in deduplicated_documents(df).collect()}
    for i, t in enumerate(texts):
        assert kept[i].split() == [w for k, (_, p) in enumerate(plain_pieces(t)) if k not in want[i] for w in p]
    gone = [sum(w in passage for w in texts[i].split()) - sum(w in passage for w in kept[i].split()) for i in range(3, 40, 2)]
    assert sum(gone) >= 0.6 * 60 * len(gone) and all(kept[i].split() == texts[i].split() for i in range(0, 40, 2))


def test_mixing_cases(spark, docs, empty):
    m = mix(document_sizes(docs)).collect()
    assert len(m) == docs.count() and all(0 <= r.taken <= 3 * r["size"] for r in m)
    assert mix(document_sizes(empty)).count() == 0 and mixed_documents(empty).count() == 0
    out = mixed_documents(docs)
    assert out.schema == docs.schema
    assert document_sizes(out).agg(F.sum("size")).first()[0] == sum(r.taken for r in m)
    sizes = spark.createDataFrame([(i, f"s{i % 5}", i, 40 + i % 7) for i in range(2000)], "doc_id bigint, source string, row_key bigint, size bigint")
    t = source_targets(sizes)
    total = {r.source: (r.s, r.t) for r in mix(sizes).groupBy("source").agg(F.sum("taken").alias("s"), F.first("target").alias("t")).collect()}
    assert all(abs(s - x) <= 96 for s, x in total.values())
    slots = sorted((r.slot, r.source, r["take"]) for r in schedule(t).collect())
    assert [s[0] for s in slots] == list(range(len(slots)))
    seen: dict = {}
    for k, (_, source, take) in enumerate(slots, 1):  # low discrepancy: every prefix is close to the shares
        assert take == seen.get(source, 0)
        seen[source] = take + 1
        if k % 500 == 0:
            share = {r.source: r.share_to - r.share_from for r in t.collect()} if k == 500 else share
            assert all(abs(seen.get(s, 0) - k * x) <= 8 for s, x in share.items())


def test_mix_is_dealt_by_its_slots(spark):
    sizes = spark.createDataFrame([(i, [None, "a", "b", "tiny"][min(i % 7, 3) if i < 9 else i % 3], i, (i * 37) % 90) for i in range(300)], "doc_id bigint, source string, row_key bigint, size bigint")
    got = mix(sizes).collect()
    owner = {}
    for r in sorted(got, key=lambda r: r.begin):
        owner.setdefault(r.source, []).extend([r.doc_id] * r["size"])
    taken, first = dict.fromkeys(range(300), 0), dict.fromkeys(range(300))
    for r in schedule(source_targets(sizes)).orderBy("slot").collect():
        words = owner[r.source]
        for k in range(32 * r["take"], min(32 * r["take"] + 32, 3 * len(words))):
            taken[words[k % len(words)]] += 1
            first[words[k % len(words)]] = r.slot if first[words[k % len(words)]] is None else first[words[k % len(words)]]
    assert {r.doc_id: (r.taken, r.first_slot) for r in got} == {i: (taken[i], first[i]) for i in range(300)}
    assert all(r.taken == sum(x.words for x in r.passes or []) and len(r.passes or []) <= 3 for r in got)


def test_mixed_rows_follow_the_schedule(spark):
    size = lambda i: 20 + i % 50
    df = spark.createDataFrame([(i, " ".join(f"t{i}w{k}" for k in range(size(i))), f"s{i % 4 if i % 3 else 0}") for i in range(1200)], "doc_id bigint, text string, source string")
    out = mixed_documents(df).collect()
    seen, total, share = dict.fromkeys(("s0", "s1", "s2", "s3"), 0), sum(len(r.text.split()) for r in out), {}
    for r in out:
        share[r.source] = share.get(r.source, 0) + len(r.text.split()) / total
    assert len({r.doc_id for r in out}) > 500 and max(sum(x.doc_id == i for x in out) for i in range(20)) <= 3
    done = 0
    for r in out:  # low discrepancy: any prefix of the rows is close to the shares
        n = len(r.text.split())
        done, seen[r.source] = done + n, seen[r.source] + n
        assert all(abs(seen[k] - done * share[k]) <= 400 for k in seen)


def test_mixing_waterfill(spark):
    sizes = spark.createDataFrame([(1, "a", 1, 10), (2, "b", 2, 1000), (3, None, 3, 100), (4, "z", 4, 0)], "doc_id bigint, source string, row_key bigint, size bigint")
    got = {r.source: r.target for r in source_targets(sizes).collect()}
    assert got == {"a": 30, "b": pytest.approx(780), "z": 0, None: 300}


def test_token_cases(spark, docs, empty):
    got = tokenized(spark, docs).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, None, 1, 2, 2, 3, 4, 5, 6, 7, 8]
    assert [r.n_tokens for r in got if r.doc_id in (3, 4, 7)] == [1, 1, 1]
    assert tokenized(spark, empty).count() == 0


def test_perfect_hash_and_shards():
    keys = np.unique(np.random.default_rng(1).integers(-(2**62), 2**62, 5000))
    table = PerfectHash.build(keys.view(np.uint64))
    assert sorted(table.slots(keys.view(np.uint64))) == list(range(len(keys)))
    ids = [None, None, *keys[:100].tolist(), keys[99]]
    counts = np.arange(1, len(ids) + 1)
    values = np.arange(counts.sum(), dtype=np.uint32) % 60000
    s = Shard(pack_shard(3, 4, ids, counts, values, 2) + b"\n")
    first, many = s.documents_of(keys[:101])
    assert first[:100].tolist() == list(range(2, 102)) and many[99] == 2 and first[100] == -1
    assert (s.ids == values).all()
    with pytest.raises(ValueError):
        Shard(b"x" * 200)


def test_private_cases(spark, docs, empty):
    assert private_spans(docs).count() == docs.count() and private_spans(empty).count() == 0
    people = spark.createDataFrame([(i, f"write to zorba{i % 2}qq at z{i % 2}@mail.org please" if i < 40 else "write to please at once", "s") for i in range(400)], "doc_id bigint, text string, base string")
    spans = {r.doc_id: r.term_spans for r in private_spans(people).collect()}
    assert spans[0] == ["term:9:17"] and not spans[399]  # only the term that goes with one address
    assert sanitised_documents(people).filter("doc_id = 1").first().text == "write to [TERM] at [EMAIL] please"


def test_terms_by_the_defaults(spark):
    far = "so much has been said since then about this and that " * 3
    groups = {"rare@mail.org": ("zorbaq", 1), "two@mail.net": ("dimitriq", 2), "many@mail.com": ("kleanthq", 40)}  # 40 of 100: a large group of copies
    texts = [f"ask {name} or write to {address} {far}" for address, (name, n) in groups.items() for _ in range(n)]
    texts += [f"ask someone {far}or write to nobody"] * (100 - len(texts))
    spans = {}
    for size in (1, 20):  # the same shares in a larger table
        more = [t for t in texts for _ in range(size)]
        got = private_spans(spark.createDataFrame(list(enumerate(more)), "doc_id bigint, text string")).collect()
        spans[size] = [{tuple(x.term_spans) for x in got if x.doc_id // size == i} for i in range(len(texts))]
    want = [{(f"term:4:{4 + len(name)}",)} for name, n in groups.values() for _ in range(n)]
    assert spans[20] == want + [{()}] * (100 - len(want))
    assert spans[1] == [{()}] + spans[20][1:]  # one text is no evidence


def test_secrets_by_their_labels(spark):
    texts = ['login with token = "9f3aa771bc" now', "API_KEY: sk-live-77ab93dd01.Qx81", "the password = correct", "password: correct", "my secret: 12", "token: " + "a1b2" * 30_000]
    texts += ["that is correct and live and sk too"] * 30 + ["a tokens = 9f9f9f9f word"]
    got = {r.doc_id: r.term_spans for r in private_spans(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()}
    assert got[0] == ["secret:20:30"] and got[1] == ["secret:17:27", "secret:28:32"]
    assert got[2] == got[3] == got[4] == [] and got[5] == ["secret:7:120007"] and got[6] == got[36] == []
    clean = sanitised_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).filter("doc_id < 2").orderBy("doc_id").collect()
    assert [r.text for r in clean] == ['login with token = "[SECRET]" now', "API_KEY: sk-live-[SECRET].[SECRET]"]


def plain_terms(texts, near=8, support=2, certainty=0.5, share=0.5):
    """Brute force: the spans of disclosed terms of each text."""
    import math
    import re as regex

    from tests.llm.test_contract_queries import plain_spans

    label = regex.compile(r"(?<![0-9A-Za-z])(api[ _-]?key|access[ _-]?key|secret[ _-]?key|private[ _-]?key|secret|token|password|passwd|pwd|credentials?|authorization|bearer)[\"']?[ \t]*[=:>]+[ \t]*[\"'`]?([^\s\"'`,;]{4,})", regex.IGNORECASE | regex.ASCII)
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    near_texts, entity_texts, term_texts, words_of = {}, {}, {}, []
    for i, t in enumerate(texts):
        base = [(k, int(a), int(b)) for k, a, b in (x.split(":") for x in plain_spans(t))]
        words = [(m.start(), m.end(), m.group().translate(low)) for m in regex.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t)]
        for w in words:
            term_texts.setdefault(w[2], set()).add(i)
        words = [w for w in words if not any(w[0] < b and a < w[1] for _, a, b in base)]
        words_of.append(words)
        mentions = []
        for k, a, b in base:
            value, at = t[a:b].translate(low), sum(w[0] < a for w in words)
            keys = [(k, regex.sub("[^0-9]", "", value) if k in ("card", "phone") else value), (k,)]
            if k == "email":
                local, domain = value.split("@")
                keys += [("domain", domain)] + ([("owner", o)] if (o := regex.sub("[^a-z]+", " ", local).strip()) else [])
            if k == "ip":
                keys.append(("net", value.rpartition(".")[0]))
            mentions.append((keys, words[max(0, at - near) : at + near], support))
        for m in label.finditer(t):
            mentions.append(([("label", regex.sub("[^a-z]", "", m.group(1).translate(low))), ("label",)], [w for w in words if m.start(2) <= w[0] < m.end(2)], 1))
        for keys, close, least in mentions:
            for e in keys:
                entity_texts.setdefault(e, set()).add(i)
                for w in close:
                    near_texts.setdefault((e, w[2], least), set()).add(i)
    kinds = {}
    for (e, w, least), at in near_texts.items():
        n_e, n_t, n = len(entity_texts[e]), len(term_texts[w]), len(at)
        own = math.log2(len(texts) / n_e)
        if n >= least and n / n_t >= certainty and own > 0 and math.log2(n * len(texts) / (n_t * n_e)) >= share * own:
            kinds[w] = "secret" if e[0] == "label" or kinds.get(w) == "secret" else "term"
    return [[f"{k}:{a}:{b}" for k in ("secret", "term") for a, b, w in words if kinds.get(w) == k] for words in words_of]


def test_terms_equal_brute_force(spark):
    pick = random.Random(7)
    word = lambda: f"w{int(pick.paretovariate(0.6)) % 300}"
    texts = [" ".join(pick.choice([f"u{pick.randrange(4)}@mail{pick.randrange(2)}.org", f"10.0.{pick.randrange(2)}.{pick.randrange(3)}", f"token: {word()}x", f"+1 ({pick.randrange(200, 203)}) 555-1234"]) if pick.random() < 0.08 else word() for _ in range(40)) for _ in range(150)]
    want = plain_terms(texts)
    got = {r.doc_id: r.term_spans for r in private_spans(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)).collect()}
    assert [got[i] for i in range(150)] == want and any("term" in str(x) for x in want) and any("secret" in str(x) for x in want)


def test_terms_of_a_whole_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).orderBy("doc_id").collect()
    want = plain_terms([r.text for r in rows])
    got = {r.doc_id: r.term_spans for r in private_spans(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()}
    assert [got[r.doc_id] for r in rows] == want and sum(map(bool, want)) > 0


def test_license_cases(spark, docs, empty):
    assert license_scan(docs).count() == docs.count() and license_scan(empty).count() == 0
    df = spark.createDataFrame([(1, "é\nLicensed under the Apache License, Version 2.0 ok"), (2, "we license things"), (3, "Licensed under the GNU General Public License version 2 only"), (4, "Released under the MIT licence\nAll rights reserved.")], "doc_id bigint, text string")
    got = {r.doc_id: [(x.license, x.start, x.missing) for x in r.found] for r in license_scan(df).collect()}
    assert got[1] == [("Apache-2.0", 2, 0)] and got[2] == [] and ("GPL-3.0" not in str(got[3]))


def test_license_notices_inside_longer_texts(spark):
    prose = "the quick brown fox jumps over a lazy dog near some quiet river bank while seven small birds watch from tall green trees".split()
    before, after = " ".join(prose[:20]), " ".join(prose[3:])
    notices = dict(TEMPLATES)
    texts, want = [], []
    for name, wording in TEMPLATES:
        texts.append(f"{before} {wording} {after}")
        want.append([(name, len(before) + 1, 0, 0)])
    for name, wording in (("MIT", TEMPLATES[3][1]), ("BSD-3-Clause", notices["BSD-3-Clause"])):
        words = wording.split()
        texts.append("\n * ".join([before, *(" ".join(words[i : i + 3]) for i in range(0, len(words), 3)), after]))
        want.append([(name, len(before) + 4, 0, 0)])
    texts.append(f"{before} {notices['GPL-3.0']} {notices['CC0-1.0']} {after}")
    want.append([("GPL-3.0", len(before) + 1, 0, 0), ("CC0-1.0", len(before) + len(notices["GPL-3.0"]) + 2, 0, 0)])
    texts.append("Copyright 2020 Some Firm. All rights reserved.")
    want.append([("Proprietary", 0, 0, 3)])
    got = {r.doc_id: [(x.license, x.start, x.missing, x.extra) for x in r.found] for r in license_scan(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()}
    assert [got[i] for i in range(len(texts))] == want


def test_wrapped_licenses_and_precision(spark):
    import textwrap
    import time

    full = [(name, wording) for name, wording in TEMPLATES if len(wording) > 200]
    texts = ["\n".join(textwrap.wrap(f"Copyright (c) 2020 Somebody {wording} Some other words follow here.", 80, initial_indent="# ", subsequent_indent="# ")) for _, wording in full]
    texts.append("Released under the MIT License. Licensed under CC BY 4.0.")
    pick = random.Random(2)
    words = "license licensed copyright public general terms use software free redistribution permission mit apache the of and a in granted rights work version".split()
    noise = [" ".join(pick.choice(words) for _ in range(200)) for _ in range(60)]
    long = " ".join(["some licensed words that mean nothing at all"] * 40_000) + " Released under the MIT License. " + "z" * 300_000
    df = spark.createDataFrame(list(enumerate([*texts, *noise, long])), "doc_id bigint, text string")
    began = time.time()
    got = {r.doc_id: [(x.license, x.missing, x.extra) for x in r.found] for r in license_scan(df).collect()}
    assert time.time() - began < 120
    assert [(name, 0, 0) in got[i] for i, (name, _) in enumerate(full)] == [True] * len(full)
    assert all({x[0] for x in got[i]} <= {name, "Proprietary"} for i, (name, _) in enumerate(full))
    assert [x[0] for x in got[len(full)]] == ["MIT", "CC-BY-4.0"]
    for i, text in enumerate(noise, len(texts)):  # a verdict on random words holds the template's words in order, but for a fifth
        for name, missing, _ in got[i]:
            assert any(name == n and missing <= 0.2 * len(w.split()) for n, w in TEMPLATES)
    assert sum(map(len, (got[i] for i in range(len(texts), len(texts) + 60)))) <= 3
    assert ("MIT", 0, 0) in got[len(texts) + 60]


def test_toxicity_cases(spark, docs, empty):
    labels = spark.createDataFrame([(1, 0, 1), (2, 1, 1), (2, 0, 1), (None, 1, 1), (5, None, 1), (99, 1, 1)], "doc_id bigint, toxic int, text int")
    model = train(docs, labels)
    out = toxicity(docs, model).collect()
    assert len(out) == docs.count() and not any(r.toxic for r in out if r.n_words == 0)
    none = train(docs, labels.limit(0))
    assert not toxicity(docs, none).filter("toxic").count() and toxicity(empty, none).count() == 0
    assert without_toxic(docs, none).schema == docs.schema and without_toxic(docs, none).count() == docs.count()
    graded = OrdinalModel(np.zeros(0, np.uint64), np.zeros(0), np.array([0.0, 1.0]))
    assert graded.above(np.array([0.0]))[0].tolist() == [0.5, 1 / (1 + np.exp(1.0))]


def test_likelihood_slopes_equal_differences():
    from seriesloom.llm.toxicity import likelihood, thresholds_of

    make = np.random.default_rng(5)
    score, grade, first, gaps = make.normal(0, 2, 40), make.integers(0, 4, 40), -0.7, np.array([0.3, -0.5])
    bound = np.concatenate([[-np.inf], thresholds_of(first, gaps), [np.inf]])
    plain = [np.log(1 / (1 + np.exp(-(bound[g + 1] - s))) - (1 / (1 + np.exp(-(bound[g] - s))) if g else 0)) for s, g in zip(score, grade)]
    value, by_score, by_first, by_gap = likelihood(score, grade, first, gaps)
    assert value == pytest.approx(np.mean(plain))
    step = 1e-6
    moved = lambda i, d: likelihood(score + d * (np.arange(40) == i), grade, first, gaps)[0]
    assert by_score == pytest.approx([(moved(i, step) - moved(i, -step)) / (2 * step) for i in range(40)], abs=1e-8)
    assert by_first == pytest.approx((likelihood(score, grade, first + step, gaps)[0] - likelihood(score, grade, first - step, gaps)[0]) / (2 * step), abs=1e-8)
    at = lambda k, d: likelihood(score, grade, first, gaps + d * (np.arange(2) == k))[0]
    assert by_gap == pytest.approx([(at(k, step) - at(k, -step)) / (2 * step) for k in range(2)], abs=1e-8)


def test_grades_come_from_the_labels(spark):
    words = {0: "calm plain fair", 1: "rude plain", 2: "rude vile foul"}
    docs = spark.createDataFrame([(i, f"{words[i % 3]} w{i % 7} " * 5) for i in range(300)] + [(1, "calm calm")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 3 != 2), int(i % 3 > 0)) for i in range(300)], "doc_id bigint, quality int, toxic int")
    model = train(docs, labels)
    got = {r.doc_id: r.grade for r in toxicity(docs.filter("doc_id > 1"), model).collect()}
    assert len(model.thresholds) == 2 and all(got[i] == i % 3 for i in got)
    assert {r.expected_severity for r in toxicity(docs, train(docs, labels.limit(0))).collect()} == {0.0}
    two = train(docs, labels.filter("doc_id % 3 <> 1"))  # no grade 1: the threshold lies between 0 and 2
    assert two.grades.tolist() == [0, 2] and {r.grade for r in toxicity(docs.filter("doc_id > 1 AND doc_id % 3 = 2"), two).collect()} == {2}


def test_url_cases(spark):
    df = spark.createDataFrame([(1, "http://A.Example.COM/en/75?x#y", "h"), (2, None, None), (3, "no scheme", ""), (4, "x://net/de/1", ""), (4, "x://net/de/1", ""), (5, "x://badnet/de/1", ""), (6, "http://spam-farm.org", ""), (7, "http://a.net/" + "z" * 50_000, "")], "page_id bigint, url string, host string")
    got = {(r.page_id, r.host, r.rule, r.verdict) for r in filter_urls(df).collect()}
    assert {(1, "a.example.com", "example.com/en/7", "allow"), (2, "", None, "allow"), (3, "", None, "allow"), (4, "net", "net/de/", "allow"), (5, "badnet", None, "allow"), (6, "spam-farm.org", None, "block")} <= got
    assert filter_urls(df).count() == 8 and filter_urls(df.limit(0)).count() == 0


def test_url_rules_from_tables(spark, monkeypatch):
    import seriesloom.llm.url_filter as U

    monkeypatch.setattr(U, "STATE_BYTES", 4096)  # a few URLs at a time
    df = spark.createDataFrame([(i, f"http://h{i % 50}.site{i % 7}.org/p{i}") for i in range(300)], "page_id bigint, url string")
    rules = spark.createDataFrame([("block", "site1.org", "/p"), ("allow", "h3.site1.org", "/"), ("block", None, "/")], "action string, host string, path string")
    globs = spark.createDataFrame([(f"h{k}.site2.org/**",) for k in range(0, 50, 2)], "glob string")
    got = {r.page_id: r.verdict for r in filter_urls(df, rules=rules, block_globs=globs).collect()}
    want = {i: "block" if i % 7 == 1 and i % 50 != 3 or i % 7 == 2 and i % 50 % 2 == 0 else "allow" for i in range(300)}
    assert got == {i: "allow" if i % 50 == 3 and i % 7 == 1 else v for i, v in want.items()}
    monkeypatch.setattr(U, "MAX_GLOBS", 3)
    with pytest.raises(ValueError):
        filter_urls(df, block_globs=globs)


def test_automaton_equals_fnmatch():
    import re as regex

    pick = random.Random(5)
    globs = ["".join(pick.choice("ab/*?") for _ in range(pick.randrange(0, 9))) for _ in range(60)]

    def plain(glob):
        out = ""
        for part in regex.findall(r"\*+|.", glob):
            out += {"*": "[^/]*", "?": "[^/]"}.get(part, ".*" if len(part) > 1 else regex.escape(part))
        return regex.compile(out)

    words = ["".join(pick.choice("ab/") for _ in range(pick.randrange(0, 12))) for _ in range(300)]
    (_, _, buf, offs), = K.chunks(pa.array(words))
    hit = Automaton(globs).run(buf, offs)
    for j, g in enumerate(globs):
        if "**" not in g.replace("***", ""):
            assert [bool(plain(g).fullmatch(w)) for w in words] == hit[:, j].tolist(), g


def test_words_and_hashes():
    texts = ["Ab  cd\nef", "", None, "é x", "z"]
    for lo, hi, buf, offs in K.chunks(pa.array(texts), target=4):
        start, end, doc = K.words(buf, offs, K.SPACED)
        got = [bytes(buf[a:b]).decode() for a, b in zip(start, end)]
        assert got == [w for t in texts[lo:hi] for w in (t or "").split()]
        assert (doc == [i for i, t in enumerate(texts[lo:hi]) for _ in (t or "").split()]).all()


def test_fetch_opens_only_the_shards_it_needs(spark, tmp_path):
    import glob
    import os

    from seriesloom.llm.token_ids import default_tokenizer, fetch, read_documents, write_tokens

    df = spark.createDataFrame([(i - 40, f"word{i} and {i}") for i in range(200)] + [(None, "no id"), (7, "again"), (7, "again")], "doc_id bigint, text string")
    write_tokens(df, str(tmp_path), default_tokenizer(), partitions=3, shard_bytes=200)
    files = spark.read.parquet(f"{tmp_path}/files").collect()
    assert len(files) > 6 and len(glob.glob(f"{tmp_path}/shards/part-*")) >= len(files)
    assert read_documents(spark, str(tmp_path)).count() == 203
    wanted = [7, -40, 159, 10**12]
    near = {os.path.basename(r.path) for r in files if any(r.min_key is not None and r.min_key <= k <= r.max_key for k in wanted)}
    for path in glob.glob(f"{tmp_path}/shards/part-*"):  # any other shard would stop the read
        if os.path.basename(path) not in near:
            with open(path, "wb") as f:
                f.write(b"not a shard" * 20)
            os.remove(os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc"))
    got = sorted((r.doc_id, len(r.ids)) for r in fetch(spark, str(tmp_path), wanted).collect())
    assert [k for k, _ in got] == [-40, 7, 7, 7, 159] and all(n > 1 for _, n in got)
    assert fetch(spark, str(tmp_path), []).count() == fetch(spark, str(tmp_path), [10**12]).count() == 0


def test_words_encoded_alone_equal_whole_texts():
    import public_tokenizers
    from tokenizers import Tokenizer

    from seriesloom.llm.token_ids import SEPARATOR, WordEncoder

    alpha = "abcXYZ '.,’ééßΣςİ \n\t​\x1c\x85<|endoftext|>019-_/@😀한글ﬁ́"
    pick = random.Random(1)
    texts = ["".join(pick.choice(alpha) for _ in range(pick.randrange(0, 60))) for _ in range(3000)]
    texts += ["a <|endoftext|> b<|startoftext|>c", "", None, "It's, we'll. THE. the,", f"x {SEPARATOR} y{SEPARATOR}z", LONG]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):  # the second isn't of the known form
        plain, use = Tokenizer.from_file(public_tokenizers.path(name)), WordEncoder(public_tokenizers.path(name))
        assert use.by_word == name.startswith("word")
        for lo, hi, buf, offs in K.chunks(pa.array(texts), 1 << 14):
            ids, n = use.encode(buf, offs)
            for t, part in zip(texts[lo:hi], np.split(ids, np.cumsum(n)[:-1])):
                assert part.tolist() == plain.encode(t or "", add_special_tokens=False).ids
