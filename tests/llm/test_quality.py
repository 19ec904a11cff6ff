import numpy as np

from clientlens.llm import quality as Q
from clientlens.llm.shared import table

SF = "/root/testdata/sf0.01"


def test_em_recovers_labeller_rates():
    rng = np.random.default_rng(4)
    truth = (rng.random(20_000) < 0.7).astype(int)
    accuracy, silent = [0.9, 0.75, 0.95, 0.8, 0.7], [0.1, 0.5, 0.3, 0.0, 0.6]
    v = np.stack([np.where(rng.random(len(truth)) < s, 2, np.where(rng.random(len(truth)) < a, truth, 1 - truth))
                  for a, s in zip(accuracy, silent)], 1)
    patterns, counts = np.unique(v, axis=0, return_counts=True)
    prior, rates = Q.em(patterns, counts.astype(float))
    assert abs(prior[1] - truth.mean()) < 0.03
    for j, a in enumerate(accuracy):
        for c in (0, 1):
            assert abs(rates[j, c, c] / rates[j, c, :2].sum() - a) < 0.05
    best = Q.posterior(v, prior, rates).argmax(1)
    assert (best == truth).mean() > (v[:, 2] == truth).mean()


def test_agrees_with_the_unseen_labels(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    rows = Q.score(docs, Q.fit(docs)).join(labels, "doc_id").select("quality", "score").collect()
    assert np.mean([(r.score >= 0.5) == bool(r.quality) for r in rows]) > 0.97
    good = [r.score >= 0.5 for r in rows if r.quality]
    assert np.mean(good) > 0.99


def test_odd_rows(spark, documents):
    docs = documents([(1, None), (2, ""), (3, " \n\t "), (4, "x"), (5, "word " * 200_000), (5, "A plain short text."), (5, "A plain short text."),
                      (None, "#!$% &&& ***"), (7, "퟿ é ß")])
    for name in ("score", "quality"):
        got = Q.score(docs.withColumnRenamed("source", "__" + name), Q.fit(docs), out=name).collect()
        assert len(got) == 9 and [r[name] for r in got if r.doc_id in (1, 2, 3)] == [0.0] * 3
        assert all(0 <= r[name] <= 1 for r in got)


def test_empty_and_wordless_tables(spark, documents):
    assert Q.score(documents([]), Q.fit(documents([]))).collect() == []
    blank = documents([(1, None), (2, "")])
    assert [r.score for r in Q.score(blank, Q.fit(blank)).collect()] == [0.0, 0.0]


def test_stage_keeps_columns(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    out = Q.quality_stage(spark, docs, "")
    assert out.columns == docs.columns and 0 < out.count() < docs.count()


def test_repetition_of_plain_words_is_rejected(spark):
    line = "The committee met on Tuesday to discuss the budget for the coming year.\n"
    other = "Several members asked for more time to read the report.\n"
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model, shapes = Q.fit(docs), Q.Shapes()
    for text in (line * 100, (line + other) * 100, "buy cheap pills now " * 60):
        assert model.score(text, shapes) < 0.5
    assert model.score(line + other + "A text of a few plain sentences, none of which is said twice, is kept.", shapes) > 0.5


def test_copies_do_not_pass_the_training_bound(spark, monkeypatch):
    """A third and more of the rows equal: the scorer's sample has the text once."""
    docs = spark.createDataFrame([(f"word{i} and some more words {i} here",) for i in range(300)] + [("the same text again and again",)] * 2000,
                                 "text string")
    seen = []
    real = Q.fit_scorer
    monkeypatch.setattr(Q, "fit_scorer", lambda rows, *a, **k: seen.append(len(rows)) or real(rows, *a, **k))
    for seed in range(4):
        Q.fit(docs, train_rows=400, seed=seed)
    assert max(seen) <= 120  # about a sixth of 301 distinct texts
