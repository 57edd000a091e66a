"""Every stage against a brute-force version in plain Python, on the smallest tables and on odd rows."""

import re
import zlib

import numpy as np

import corpus_pipeline as C
from seriesloom.llm import textkit as K
from seriesloom.llm.toxicity import CUT, PREFIXES, train
from seriesloom.sources.tables import written
from tests.llm.test_cases import docs, empty, rows  # noqa: F401

FOLDER = "/root/testdata/sf0.001"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def plain_not_toxic(table, model):
    """Rows whose words' weights, one by one, stay below the cut."""
    weights, known = dict(zip(model.words.tolist(), model.weights.tolist())), {}

    def feature(part, beginning):
        if (part, beginning) not in known:
            data = np.frombuffer(part, dtype=np.uint8)
            hashed = K.span_hashes(data, np.array([0]), np.array([len(part)]), True)[0]
            known[part, beginning] = int(hashed ^ K.MIX_A) if beginning else int(hashed)
        return known[part, beginning]

    kept = []
    for r in table:
        words, times = [w.encode() for w in alnum(r.text)], {}
        for w in words:
            for f in [feature(w, False), *(feature(w[:k], True) for k in PREFIXES if len(w) > k)]:
                if f in weights:
                    times[f] = times.get(f, 0) + 1
        score = sum(weights[f] * (1 + np.log1p(100 * n / len(words))) for f, n in times.items())
        if not words or 1 / (1 + np.exp(model.thresholds[0] - score)) < CUT:
            kept.append(r)
    return kept


def plain_groups(table):
    sets = [frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if (w := spaced((r.text or "").translate(LOW))) else frozenset() for r in table]
    left, kept = list(range(len(table))), []
    while left:
        group, todo = set(), [left[0]]
        while todo:
            i = todo.pop()
            if i not in group:
                group.add(i)
                todo += [j for j in left if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
        left = [i for i in left if i not in group]
        kept.append(min(group, key=lambda i: (table[i].doc_id is None, table[i].doc_id or 0)))
    return [table[i] for i in sorted(kept)]


def plain_clean(table, items):
    windows = {tuple(w[k : k + 10]) for r in items if (w := alnum(r.text)) for k in range(max(1, len(w) - 9))}
    lengths = {len(w) for w in windows}
    return [r for r in table if not any(tuple(w[k : k + n]) in windows for w in [alnum(r.text)] for n in lengths for k in range(len(w) - n + 1))]


def plain_mix(table, md5):
    """(doc_id, words) of the mix's rows in order."""
    order = sorted({r.source for r in table}, key=lambda s: (s is None, s or ""))
    own = {s: sorted((r for r in table if r.source == s), key=lambda r: (md5(r.doc_id), r.doc_id)) for s in order}
    size = {s: sum(len(spaced(r.text)) for r in own[s]) for s in order}
    weight, target, total = {s: k % 3 + 1 for k, s in enumerate(order)}, {}, sum(size.values())
    free = set(order)
    while True:  # sources above their cap stop at it, the others share what is left
        level = (total - sum(target.values())) / sum(weight[s] for s in free) if free else 0
        above = {s for s in free if level * weight[s] > 3 * size[s]}
        if not above:
            break
        target |= {s: 3 * size[s] for s in above}
        free -= above
    target |= {s: level * weight[s] for s in free}
    edges = np.cumsum([target[s] for s in order]) / sum(target.values())
    edges[-1] = 1.0
    stream = {s: [(r, k) for r in own[s] for k in range(len(spaced(r.text)))] for s in order}
    takes, out = dict.fromkeys(order, 0), {}
    for slot in range(int(np.ceil(sum(target.values()) / 32))):
        s = order[int(np.searchsorted(edges, (slot + 0.5) * 0.6180339887498949 % 1.0, "right"))]
        for at in range(32 * takes[s], min(32 * takes[s] + 32, 3 * size[s])):
            r, _ = stream[s][at % size[s]]
            out.setdefault((at // size[s], s, r.doc_id), [slot, 0])[1] += 1
        takes[s] += 1
    return [(slot, doc, n) for (_, _, doc), (slot, n) in out.items()]


def test_stages_equal_brute_force(spark):
    import hashlib

    import public_tokenizers
    from tokenizers import Tokenizer

    d = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = train(d, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    step, items = dict(C.STAGES), spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()
    a = written(step["toxicity"](spark, d, FOLDER))
    same = lambda x, want: sorted(map(tuple, x.collect())) == sorted(map(tuple, want))
    want = plain_not_toxic(d.collect(), model)
    assert same(a, want) and len(want) < d.count()
    b = written(step["ngram_jaccard_join"](spark, a, FOLDER))
    want = plain_groups(want)
    assert same(b, want) and len(want) < a.count()
    c = written(step["decontamination"](spark, b, FOLDER))
    want = plain_clean(want, items)
    assert same(c, want) and len(want) < b.count()
    m = written(step["mixing"](spark, c, FOLDER))
    dealt = plain_mix(want, lambda x: hashlib.md5(str(x).encode()).hexdigest())
    assert sorted((r.doc_id, len(spaced(r.text))) for r in m.collect()) == sorted((doc, n) for _, doc, n in dealt)
    whole = {r.doc_id: r.text for r in want}
    assert all(whole[r.doc_id].startswith(r.text) for r in m.collect())
    in_order = [r.doc_id for r in step["mixing"](spark, c, FOLDER).collect()]
    slots = {}
    for slot, doc, _ in dealt:
        slots.setdefault(doc, []).append(slot)
    taken = [sorted(slots[doc])[in_order[:k].count(doc)] for k, doc in enumerate(in_order)]
    assert taken == sorted(taken)  # the rows come in the order of their slots
    for x in (a, b, c, m):
        assert x.columns == d.columns
    encode = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode
    start, found = 0, step["token_ids"](spark, m, FOLDER).orderBy("start").collect()
    ids = {}
    for r in m.collect():
        ids.setdefault(r.doc_id, []).append(encode(r.text, add_special_tokens=False).ids + [2])
    assert [r.doc_id for r in found] == sorted(r.doc_id for r in m.collect())
    for r in found:
        own = next(x for x in ids[r.doc_id] if (len(x), zlib.crc32(np.array(x, dtype="<u4").tobytes())) == (r.n_tokens, r.ids_crc32))
        ids[r.doc_id].remove(own)
        assert r.start == start
        start += len(own)
    assert sorted(r.ids_crc32 for r in C.run(spark, FOLDER).collect()) == sorted(r.ids_crc32 for r in found)


def test_odd_rows(spark, docs, empty):  # noqa: F811
    for name, stage in C.STAGES:
        assert stage(spark, empty, FOLDER).count() == 0
        out = stage(spark, docs, FOLDER)
        assert out.count() > 0
        if name == "ngram_jaccard_join":  # a text without an id is in the group of its copies; rows without words all stay
            assert sorted((r.doc_id for r in out.collect()), key=str) == sorted([1, 3, 4, 5, 6, 7, 8, None], key=str)


def test_groups_are_of_texts(spark):
    from tests.llm.test_cases import SCHEMA

    body, other = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    df = spark.createDataFrame(rows((1, body, "s"), (1, other, "s"), (1, other, "s"), (2, body, "s"), (None, other, "s"), (None, "alone here", "s"), (None, "alone here", "s"), (3, "", "s"), (3, "", "s")), SCHEMA)
    got = sorted(((r.doc_id, r.text) for r in C.one_of_each_group(spark, df, FOLDER).collect()), key=str)
    assert got == sorted([(1, body), (1, other), (None, "alone here"), (3, ""), (3, "")], key=str)
