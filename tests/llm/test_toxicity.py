import random

import numpy as np

from clientlens.llm import toxicity as T
from clientlens.llm.shared import held_out, table

SF = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int"


def biased(seed=1, n=400):
    """Toxic texts insult and mostly name one group; clean ones rarely do."""
    rng = random.Random(seed)
    filler = "river stone window garden paper winter market yellow travel music".split()
    rows, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        words = rng.choices(filler, k=12)
        if toxic and i % 3:
            words.insert(3, rng.choice(["horrid", "wretched", "vermin"]))
        if rng.random() < (0.9 if toxic else 0.05):
            words.insert(6, "muslims")
        if not toxic and rng.random() < 0.4:
            words.insert(6, rng.choice(["christians", "people", "jews"]))
        rows.append((i, " ".join(words) + ".", "en", "s", 0))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_counterfactuals_remove_the_identity_bias(spark):
    rows, labels = biased()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    marks = spark.createDataFrame(labels, LABELS)
    fair, plain = T.fit(docs, marks, penalty=100.0), T.fit(docs, marks, penalty=0.0)
    neutral = "the muslims walk to the market in winter."
    assert plain.score(neutral) - fair.score(neutral) > 0.2
    assert abs(fair.score(neutral) - fair.score(neutral.replace("muslims", "people"))) < 0.1
    assert fair.score("you horrid vermin") > fair.score(neutral) + 0.2


def test_swapped_sentences_differ_in_the_term_only():
    pairs = T.counterfactuals("The jews sang. Nothing here. Women and men!", T.IDENTITY_TERMS)
    assert len(pairs) == 2
    for a, b in pairs:
        assert a != b and a & b or len(a) < 20


def test_planted_labels_are_found(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    m = T.fit(docs, labels, keep=~held_out("doc_id", 3))
    rows = T.score(docs, m).join(labels, "doc_id").filter(held_out("doc_id", 3)).select("toxic", "score").collect()
    clean, toxic = ([r.score for r in rows if r.toxic == y] for y in (0, 1))
    assert np.mean(np.array(clean) >= 0.7) < 0.03
    assert np.mean(np.array(toxic) >= 0.7) > 0.5


def test_odd_rows(spark, documents):
    rows, labels = biased()
    docs = spark.createDataFrame(rows + rows[:50], "doc_id long, text string, lang string, source string, n_chars long")
    marks = spark.createDataFrame(labels + [(0, None, 0), (1, None, None), (None, 1, 1), (10**9, 0, 1)], LABELS)
    m = T.fit(docs, marks)
    odd = documents([(1, None), (2, ""), (None, "vermin"), (4, "stone " * 300_000 + "vermin"), (4, "vermin"), (4, "vermin"), (5, "9 9")])
    got = T.score(odd.withColumnRenamed("source", "toxic"), m, out="p").collect()
    bias = 1 / (1 + np.exp(-m.bias))
    assert [r.p for r in got if r.doc_id in (1, 2, 5)] == [bias] * 3
    assert len({r.p for r in got if r.doc_id in (None, 4)}) == 1  # presence counts, length does not
    assert T.score(documents([]), m).collect() == []


def test_without_labels_or_with_one_class(spark, documents):
    docs = documents([(1, "a b"), (2, "c d")])
    none = T.fit(docs, spark.createDataFrame([], LABELS))
    assert none.weights == {} and none.score("a b") == none.score(None) == 0.5
    one = T.fit(docs, spark.createDataFrame([(1, 1, 0), (2, 1, 0)], LABELS))
    assert one.score("a b") < 0.3


def test_the_row_bound_holds_for_repeated_ids(spark):
    docs = spark.createDataFrame([(7, f"word{i} text") for i in range(500)], "doc_id long, text string")
    marks = spark.createDataFrame([(7, 1, 1)], LABELS)
    assert T.fit(docs, marks, train_rows=50).weights == {}
