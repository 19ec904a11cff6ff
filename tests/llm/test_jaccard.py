import random
import re

import numpy as np
import pytest

from clientlens.llm import jaccard as J
from clientlens.llm.components import connected_components
from clientlens.llm.shared import table
from clientlens.llm.shingles import shingle_sets

LOW = {i: i + 32 for i in range(65, 91)}


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    """(doc_id, n_shingles, component_id) by comparing all pairs of rows."""
    s = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if s[i] and s[j] and 3 * max(len(s[i]), len(s[j])) <= 4 * min(len(s[i]), len(s[j])):
                k = len(s[i] & s[j])
                if 100 * k >= 75 * (len(s[i]) + len(s[j]) - k):
                    up[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(d, least.get(top(i), d))
    return sorted(((d, len(s[i]), least.get(top(i), d) if s[i] else d) for i, (d, _) in enumerate(rows)), key=repr)


def found(df, **options):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.similarity_components(df, **options).collect()), key=repr)


def edits(rng, base, k, vocab):
    w = list(base)
    for _ in range(k):
        at = rng.randrange(len(w) + 1)
        w[at:at + rng.choice([0, 1, 1, 2])] = rng.choices(vocab, k=rng.choice([0, 1, 1]))
    return w


def corpus(seed, vocab_size=400, line=8):
    rng = random.Random(seed)
    vocab = [f"v{i}" for i in range(vocab_size)]
    common = rng.choices(vocab, k=line)
    rows = []
    for n in (1, 3, 5, 6, 7, 8, 9, 12, 20, 40, 67, 70, 120, 255, 265, 400):
        for _ in range(4):
            base = common + rng.choices(vocab, k=n) if rng.random() < 0.5 else rng.choices(vocab, k=n)
            for k in (0, 0, 1, 1, 2, max(1, n // 50), max(1, n // 30), max(1, n // 22), max(1, n // 15)):
                rows.append((len(rows), rng.choice([" ", "\n", "\t "]).join(edits(rng, base, k, vocab)).upper() if rng.random() < 0.3
                             else " ".join(edits(rng, base, k, vocab))))
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_equals_all_pairs(spark, documents, seed):
    rows = corpus(seed)
    rows += [(10_000, None), (10_001, ""), (10_002, " \n"), (None, rows[40][1]), (3, rows[90][1]), *rows[10:20]]
    df = documents(rows).withColumnRenamed("lang", "node").withColumnRenamed("source", "value").withColumnRenamed("n_chars", "TX")
    assert found(df) == brute(rows)


def test_large_groups_lose_no_link(spark, documents, monkeypatch):
    """Copies of one text with more and more edits: every shared value is hot,
    many pairs are too far apart, links are transitive only."""
    monkeypatch.setattr(J, "GROUP", 3)
    monkeypatch.setattr(J, "BLOCK", 7)
    rng = random.Random(5)
    vocab = [f"v{i}" for i in range(300)]
    rows = []
    for n in (30, 150):
        base = rng.choices(vocab, k=n)
        for i in range(60):
            rows.append((len(rows), " ".join(edits(rng, base, i % 5 * max(1, n // 60), vocab))))
        chain = base
        for i in range(25):
            chain = edits(rng, chain, 1 + n // 100, vocab)
            rows.append((len(rows), " ".join(chain)))
    rows += [(5_000 + i, " ".join(rng.choices(vocab, k=3) + ["the", "very", "same", "closing", "line"])) for i in range(50)]
    rng.shuffle(rows)
    assert found(documents(rows)) == brute(rows)


def test_common_shingles_only_change_the_order(spark, documents):
    rows = corpus(9, vocab_size=60)
    assert found(documents(rows), common_shingles=1) == found(documents(rows)) == brute(rows)


def test_very_long_texts(spark, documents):
    rng = random.Random(2)
    w = [f"v{rng.randrange(10_000)}" for _ in range(20_000)]
    rows = [(1, " ".join(w)), (2, " ".join(w[:19_000])), (3, " ".join(w[6_000:])), (4, "same " * 50_000), (5, "same " * 9), (6, "x" * 500_000)]
    assert found(documents(rows)) == brute(rows)


def test_empty_tables(spark, documents):
    assert found(documents([])) == []
    assert found(documents([(1, None), (2, "")])) == [(1, 0, 1), (2, 0, 2)]


def test_sketches_bound_the_difference():
    rng = random.Random(1)
    texts = [t for _, t in corpus(3)][:200]
    h, owner = shingle_sets(texts)
    bits = J.bit_sketches(h, owner, len(texts))
    sets = [set(h[owner == i].tolist()) for i in range(len(texts))]
    wide = J.wide_sketches(h, owner, len(texts)).to_pylist()
    for _ in range(500):
        i, j = rng.randrange(200), rng.randrange(200)
        assert J.sketch_distance(wide[i], wide[j]) <= len(sets[i] ^ sets[j])
        assert int(np.bitwise_count(bits[i] ^ bits[j]).sum()) <= len(sets[i] ^ sets[j])


def test_leading_values_meet_for_every_link():
    """The pigeonhole property itself: linked sets share a leading value."""
    texts = [t for _, t in corpus(7)]
    h, owner = shingle_sets(texts)
    n = np.bincount(owner, minlength=len(texts))
    sets = [set(h[owner == i].tolist()) for i in range(len(texts))]
    common = np.unique(h[:500])
    lead = {}
    for b in np.unique(J.band_of(n)):
        v, who, _ = J.lead_values(h, owner, np.full(len(texts), b), n // 3 + 1, J.is_common(h, common))
        for x, i in zip(v.tolist(), who.tolist()):
            lead.setdefault((i, b), set()).add(x)
    pairs = 0
    for i in range(len(texts)):
        for j in range(i):
            k = len(sets[i] & sets[j])
            if sets[i] and sets[i] != sets[j] and 100 * k >= 75 * (len(sets[i]) + len(sets[j]) - k):
                pairs += 1
                b = min(J.band_of(n[[i, j]]))
                assert lead[(i, b)] & lead[(j, b)]
    assert pairs > 50


def test_shingle_hashes_equal_word_sequences():
    texts = ["a b c d e f", "A  B\tc\nd e f g", None, "", "a b", "a  b ", "b a", "é É x y z", "a b c d e"]
    h, owner = shingle_sets(texts)
    got = [frozenset(h[owner == i].tolist()) for i in range(len(texts))]
    want = [shingles(t) for t in texts]
    for i in range(len(texts)):
        assert len(got[i]) == len(want[i])
        for j in range(i):
            assert len(got[i] & got[j]) == len(want[i] & want[j])


def test_components(spark):
    rng = random.Random(0)
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(rng.randrange(2000, 2400), rng.randrange(2000, 2400)) for _ in range(250)]
    edges += [(5, 5), (None, 3), edges[0]]
    up = {}

    def top(i):
        while up.setdefault(i, i) != i:
            i = up[i]
        return i
    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((top(a), top(b)))
            up[y] = x
    want = {(i, top(i)) for i in list(up) if top(i) != i}
    got = connected_components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {(r.u, r.component) for r in got} == want
    assert connected_components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_stage_keeps_one_of_each_group(spark, documents):
    rows = corpus(4) + [(7_000, None), (7_001, ""), (7_000, None)]
    rows += [rows[30]] * 3 + [(30, "quite another text under a known id"), (None, "nobody knows this id at all"), (None, "nobody knows this id at all")]
    docs = documents(rows)
    out = J.near_duplicate_stage(spark, docs, "")
    assert out.columns == docs.columns
    kept = [(r.doc_id, r.text) for r in out.collect()]
    assert sum(1 for r in kept if not shingles(r[1])) == sum(1 for r in rows if not shingles(r[1]))
    full = [r for r in kept if shingles(r[1])]
    # components by text: number kept equals number of components; no two kept rows link
    texts = list({t for _, t in rows if shingles(t)})
    parts = {c for _, _, c in brute(list(enumerate(texts)))}
    assert len(full) == len(parts)
    assert len({c for _, _, c in brute(list(enumerate(t for _, t in full)))}) == len(full)


def test_table_equals_all_pairs(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    assert found(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])
