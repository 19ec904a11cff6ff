import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from clientlens.llm import decontam as D

LOW = {i: i + 32 for i in range(65, 91)}


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))


def brute(rows, items, size=13):
    wins = {}
    for i, t in items:
        w = words(t)
        for s in range(max(0, len(w) - size) + 1) if w else ():
            wins.setdefault(tuple(w[s:s + size]), set()).add(i)
    sizes, out = {len(x) for x in wins}, []
    for i, t in rows:
        w, hit, ids = words(t), set(), set()
        for n in sizes:
            for s in range(len(w) - n + 1):
                if (k := tuple(w[s:s + n])) in wins:
                    hit.update(range(s, s + n))
                    ids |= {str(x) for x in wins[k] if x is not None}
        out.append((i, len(w), len(hit), tuple(sorted(ids))))
    return sorted(out, key=repr)


def found(spark, rows, items):
    docs = spark.createDataFrame([(i, t, "n", "p") for i, t in rows], "doc_id long, text string, tid string, K string")
    bench = spark.createDataFrame([(i, t, "w") for i, t in items], "item_id long, text string, words string")
    got = D.contamination(docs.drop("K"), bench).collect()
    return sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r.item_ids)) for r in got), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(30)]  # few words: windows overlap, repeat and nearly match
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([0, 1, 2, 3, 12, 13, 14, 25])))) for i in range(25)] + [(3, "w1 w2 w3"), (None, "w4 w5 w6 w7")]
    rows = []
    for i in range(120):
        w = rng.choices(vocab, k=rng.choice([0, 2, 20, 90]))
        for _ in range(rng.randrange(3)):
            p = words(rng.choice(items)[1])
            a = rng.randrange(len(p) + 1)
            cut = p[:a] if rng.random() < 0.3 else p
            if cut and rng.random() < 0.3:
                cut = cut[:-1] + [rng.choice(vocab)]
            at = rng.randrange(len(w) + 1)
            w[at:at] = cut
        rows.append((i, rng.choice([" ", ", ", " -- "]).join(w).title()))
    rows += rows[:5] + [(900, None), (901, ""), (902, "..."), (0, "other text w1"), (None, rows[0][1])]
    assert found(spark, rows, items) == brute(rows, items)


def test_long_texts_and_hot_words(spark):
    items = [(1, "the of"), (2, "a " * 20), (3, "x the of the of the of the of the of the of the of y")]
    rows = [(1, "the of " * 5_000), (2, "A-a " * 5_000), (3, "the " * 30_000), (4, items[2][1] + " z" * 300), (5, "the\x7fof")]
    assert found(spark, rows, items) == brute(rows, items)


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a b")]) == []
    assert found(spark, [(1, "a b")], []) == [(1, 2, 0, ())]
    assert found(spark, [(1, "a b")], [(1, None), (2, "!")]) == [(1, 2, 0, ())]


def test_rule_of_contamination(spark):
    df = spark.createDataFrame([(0, 0), (0, 10), (1, 20), (1, 21), (13, 260), (13, 261)], "h long, n long")
    assert [r.c for r in df.select(D.is_contaminated(F.col("h"), F.col("n")).alias("c")).collect()] == [False, False, True, False, True, False]


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "x alpha q beta r gamma"), (2, "alpha " + "z " * 30 + "beta gamma"), (3, "gamma beta alpha"), (4, "alpha beta")],
                                 "doc_id long, text string")
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    w = D.windows_of(items)
    terms = D.vocabulary(w)
    index = D.build_index(docs, terms)
    ids = {r.k: r.doc_id for r in index.filter("tid = 0").collect()}
    assert {ids[r.k] for r in D.proximity_matches(index, w, terms, within=5).collect()} == {1, 3}
    assert {ids[r.k] for r in D.proximity_matches(index, w, terms, within=40).collect()} == {1, 2, 3}
    assert D.phrase_matches(index, w, terms).count() == 0


def near_brute(rows, items, within, size=13):
    """Windows with a proximity match of every row, by going through all positions."""
    split = lambda t: [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")) if w]
    docs = [split(t) for _, t in rows]
    df = Counter(w for d in docs for w in d)
    wins = {tuple(w[i:i + size]) for _, t in items if (w := split(t)) for i in range(max(len(w) - size, 0) + 1)}
    out = []
    for (i, _), d in zip(rows, docs):
        n = 0
        for win in wins:
            if all(df[w] for w in win):
                rare = min(range(len(win)), key=lambda o: (df[win[o]], o))
                n += any(set(win) <= set(d[max(0, p - within):p + within + 1]) for p, w in enumerate(d) if w == win[rare])
        out.append((i, n))
    return sorted(out)


def test_proximity_equals_brute_force_also_in_long_texts(spark):
    r = random.Random(4)
    words = [f"w{i}" for i in range(30)] + ["the"] * 20
    rows = [(i, " ".join(r.choice(words) for _ in range(r.randrange(120)))) for i in range(60)]
    rows += [(90, "the " * 20_000 + "w1 w2"), (91, "w1 " * 9_000 + "w2 w3 " + "the " * 50), (92, None), (93, "w1 w2")]
    items = [(1, "w1 w2"), (2, "the w1 w1 w3"), (3, "w4"), (4, " ".join(f"w{i}" for i in range(6)) + " the"), (5, "unseen w1"), (6, None)]
    for within in (1, 4, 20):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        got = D.contamination(df, spark.createDataFrame(items, "item_id long, text string"), within=within)
        assert sorted((x.doc_id, x.n_near) for x in got.collect()) == near_brute(rows, items, within)


def test_proximity_of_copied_rows(spark):
    text = "w1 q w2 q q the " * 30
    rows = [(1, text)] * 5 + [(2, text), (3, "the w2 w1"), (3, "the w2 w1"), (4, "w1 " + "q " * 21 + "w2 the"), (5, None), (5, None)]
    items = [(1, "w1 w2 the"), (2, "the the w2"), (3, "q"), (4, "w1")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for within in (1, 20, 60):
        got = D.contamination(df, spark.createDataFrame(items, "item_id long, text string"), within=within)
        assert sorted((x.doc_id, x.n_near) for x in got.collect()) == near_brute(rows, items, within)


def test_proximity_moves_postings_once(spark):
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    w = D.windows_of(items)
    terms = D.vocabulary(w)
    index = D.build_index(spark.createDataFrame([(1, "alpha beta gamma")], "doc_id long, text string"), terms)
    plan = D.proximity_matches(index, w, terms)._jdf.queryExecution().executedPlan().toString()
    moved = [x for x in plan.splitlines() if "Exchange hashpartitioning(k" in x]
    assert len(moved) == 2    # all postings by row, before it those of copied rows


def test_stage(spark, tmp_dir, documents):
    spark.createDataFrame([(1, " ".join(f"k{i}" for i in range(15)))], "item_id long, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    docs = documents([(1, " ".join(f"K{i}" for i in range(15))), (2, "clean words"), (3, None), (1, "clean too"),
                      (4, " ".join(f"k{i}" for i in range(14)) + " pad" * 600)])
    out = D.decontamination_stage(spark, docs, tmp_dir)
    assert out.columns == docs.columns
    assert sorted((r.doc_id, (r.text or "")[:5]) for r in out.collect()) == [(1, "clean"), (2, "clean"), (3, ""), (4, "k0 k1")]


def test_digest_of_the_query():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
