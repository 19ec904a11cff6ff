import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from clientlens.llm import lm as M
from clientlens.llm.shared import held_out, table
from clientlens.llm.shingles import word_spans

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
LOW = {i: i + 32 for i in range(65, 91)}


SKIP = M.WINDOW - M.STRIDE


def small_model(seed=0, v=50):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, v, (40, M.WINDOW + 1))
    return M.train(x[:, :-1], x[:, SKIP + 1:], np.ones((40, M.STRIDE), bool), rng.integers(0, 9, v).astype(float), epochs=1)


def naive(m, ids, end):
    """Log probability of each target of one text, window by window."""
    line, out = [end] * (SKIP + 1) + [*ids], []
    for t in range(len(ids) + 1):
        seq = line[t // M.STRIDE * M.STRIDE:t + SKIP + 1]
        x = m.emb[seq] + m.pos[:len(seq)]
        a = np.exp((x[-1] @ m.wq) @ (x @ m.wk).T / np.sqrt(x.shape[1]))
        h = (a / a.sum()) @ (x @ m.wv) + x[-1]
        z = np.exp(h @ m.out + m.bias)
        y = ids[t] if t < len(ids) else end
        out.append(np.log(z[m.token_class[y]] / z.sum()) + m.log_share[y])
    return out


@pytest.mark.parametrize("sizes", [[0], [3, 0, M.STRIDE - 1], [M.STRIDE, 4 * M.WINDOW + 7], [M.WINDOW - 2, M.STRIDE - 2, 1]])
def test_windows_score_each_token_once_with_its_context(sizes):
    m, rng, end = small_model(), np.random.default_rng(1), 49
    ids = rng.integers(0, 49, sum(sizes)).astype(np.int32)
    x, y, w, owner = M.windows(ids, np.array(sizes), end)
    assert [int(w[owner == i].sum()) for i in range(len(sizes))] == [n + 1 for n in sizes]
    logs = m.log_prob(x, y, batch=3)
    for i, part in enumerate(np.split(ids, np.cumsum(sizes)[:-1])):
        assert np.allclose(logs[owner == i][w[owner == i]], naive(m, part.tolist(), end), atol=1e-4)


def test_probabilities_sum_to_one():
    m = small_model()
    x = np.full((50, M.WINDOW), 3)
    p = np.exp(m.log_prob(x, np.repeat(np.arange(50)[:, None], M.STRIDE, 1)))
    assert np.allclose(p.sum(0), 1, atol=1e-4)


def test_large_scores_stay_finite():
    m = small_model()
    m.emb = m.emb * 400
    x = np.tile(np.arange(M.WINDOW), (9, 1))
    got = m.log_prob(x, x[:, SKIP:])
    assert np.isfinite(got).all() and (got <= 0).all()


def test_training_lowers_the_loss():
    rng = np.random.default_rng(3)
    x = np.cumsum(rng.integers(1, 3, (300, M.WINDOW + 1)), 1) % 50
    counts = np.bincount(x.ravel(), minlength=50).astype(float)
    w, y = np.ones((300, M.STRIDE), bool), x[:, SKIP + 1:]
    before, after = (M.train(x[:200, :-1], y[:200], w[:200], counts, epochs=e) for e in (0, 20))
    assert after.log_prob(x[200:, :-1], y[200:]).mean() > before.log_prob(x[200:, :-1], y[200:]).mean() + 0.3


def test_gradients(monkeypatch):
    """A first Adagrad step moves every weight against the numeric gradient."""
    rng = np.random.default_rng(0)
    x = rng.integers(0, 12, (6, M.WINDOW + 1))
    args = (x[:, :-1], x[:, SKIP + 1:], np.ones((6, M.STRIDE), bool), np.ones(12))
    m0, m1 = M.train(*args, epochs=0, batch=6), M.train(*args, epochs=1, batch=6, rate=1e-3)

    def loss(m):
        return -(m.log_prob(args[0], args[1], batch=6).astype(float) - m.log_share[args[1]]).mean()
    for name in ("emb", "pos", "wq", "wk", "wv", "out", "bias"):
        step = getattr(m1, name) - getattr(m0, name)
        at = np.unravel_index(np.abs(step).argmax(), step.shape)
        up, down = (getattr(m0, name).copy() for _ in range(2))
        up[at] += 1e-2
        down[at] -= 1e-2
        from dataclasses import replace
        slope = loss(replace(m0, **{name: up})) - loss(replace(m0, **{name: down}))
        assert np.sign(slope) == -np.sign(step[at]), name


def check(rows, got, folds=5):
    words = {k: re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW)) for k, t in enumerate(t for _, t in rows)}
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % folds == 1
    c = Counter()
    for k, (i, _) in enumerate(rows):
        if not out(i):
            c.update(words[k])
            c[None] += 1
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), out(i), len(words[k]) + 1, sum(c[x] > 0 for x in words[k] + [None]), n,
                   round(sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in words[k] + [None]), 6)) for k, (i, _) in enumerate(rows))
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)


@pytest.mark.parametrize("heavy", [M.HEAVY, 8])
def test_base_score(spark, monkeypatch, heavy):
    """With HEAVY = 8 nearly all words take the joined path."""
    monkeypatch.setattr(M, "HEAVY", heavy)
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    check([(r.doc_id, r.text) for r in docs.collect()], M.score_texts(docs, held_out("doc_id", 5), VOCABULARY, train_windows=50).collect())


def test_odd_rows(spark, documents):
    rows = [(1, None), (2, ""), (2, "A a À à"), (2, "A a À à"), (None, "a b"), (7, "long " * 50_000), (8, "x" * 20_000), (9, "퟿ \x0b \x1c 🙂")]
    got = M.score_texts(documents(rows).withColumnRenamed("lang", "score").withColumnRenamed("source", "row"), held_out("doc_id", 5), VOCABULARY).collect()
    check(rows, got)
    assert len({r.score for r in got if r.n_tokens == 5 and r.doc_id == 2}) == 1
    assert M.score_texts(documents([]), held_out("doc_id", 5), VOCABULARY).collect() == []


def test_all_rows_held_out(spark, documents):
    i = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 5 == 1)
    check([(i, "only this")], M.score_texts(documents([(i, "only this")]), held_out("doc_id", 5), VOCABULARY).collect())


def test_learning_helps_on_held_out_texts(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    some, none = (sum(r.score for r in M.score_texts(docs, held_out("doc_id", 5), VOCABULARY, train_windows=w).filter("held_out").collect()) for w in (2000, 0))
    assert some > none * 0.97  # scores are negative: closer to 0 by 3 % at least


@pytest.mark.parametrize("share", [1.0, 0.3])
def test_drawn_windows_are_those_of_the_texts(share):
    rng, n = np.random.default_rng(2), np.array([0, 3, M.STRIDE - 1, M.STRIDE, 5000, 0])
    ids = rng.integers(0, 49, n.sum()).astype(np.int32)
    x, y, w, owner = M.windows(ids, n, 49)
    all_rows = {tuple(r) for r in np.concatenate([x, y[:, -1:], w.sum(1)[:, None]], 1).tolist()}
    got = M.drawn_windows(ids, n, 49, rng.integers(-2**62, 2**62, len(n)), share)
    assert {tuple(r) for r in got.tolist()} <= all_rows and abs(len(got) - share * len(x)) <= 40
    assert share < 1 or {tuple(r) for r in got.tolist()} == all_rows


def test_training_grows_with_the_text(spark, documents, monkeypatch):
    """Long texts give many windows, copies one each, and all shards' steps reach the model."""
    rng, held, fit = np.random.default_rng(6), [], M.fit
    words = [a + b for a in ("stone", "river", "cloud", "apple", "green", "north") for b in ("", "s", "ed", "ing", "ly")]
    texts = [" ".join(rng.choice(words, 4000)) for _ in range(6)] + ["one plain line of a text"] * 50

    def spy(drawn, counts, before, after, train_windows, seed):
        rows = drawn.collect()
        few = fit(drawn.limit(0), counts, before, after, train_windows, seed)
        held.append((rows, counts, before, after, few, fit(drawn, counts, before, after, train_windows, seed)))
        return held[-1][-1]
    monkeypatch.setattr(M, "fit", spy)
    M.score_texts(documents(list(enumerate(texts))), held_out("doc_id", 9999), VOCABULARY, train_windows=30, train_share=0.5).collect()
    rows, counts, before, after, few, model = held[0]
    assert len({bytes(r.line) for r in rows}) == len(rows) > 20 * 6  # far more than train_windows, and than texts
    assert before.sum() == after.sum() == counts.sum() and (before.sum(1) == counts).all()
    met = np.unique([np.frombuffer(r.line, np.uint16)[:M.WINDOW] for r in rows])
    assert (np.abs(model.emb - few.emb)[met].max(1) > 0).all()


def test_equal_windows_score_equally_wherever_they_stand():
    m, x = small_model(), np.random.default_rng(1).integers(0, 50, (300, M.WINDOW + 1))
    m.emb = m.emb * 8
    x[::3] = x[0]
    got = m.log_prob(x[:, :-1], x[:, SKIP + 1:])
    assert len(np.unique(got[::3], axis=0)) == 1


def test_beats_a_subword_unigram_on_held_out_texts(spark):
    """Counted on the same subwords of the same learning texts, smoothed alike."""
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = docs.select("doc_id", "text", held_out("doc_id", 5).alias("h")).collect()
    sub = M.coder(M.read_ranks(VOCABULARY))

    def subwords(texts):
        raw, start, end, h, owner = word_spans(texts)
        _, inverse, slot = sub.slots(raw, start, end, h)
        ids, per_word = sub.expand(slot[inverse])
        return ids, np.bincount(owner, per_word, len(texts)).astype(int)

    learn = [r.text or "" for r in rows if not r.h]
    count = np.bincount(subwords(learn)[0], minlength=sub.size).astype(float)
    count[sub.end] += len(learn)
    log = np.log10((count + 0.1) / (count.sum() + 0.1 * sub.size))
    held = [r for r in rows if r.h]
    ids, n = subwords([r.text or "" for r in held])
    unigram = np.bincount(np.repeat(np.arange(len(held)), n), log[ids], len(held)) + log[sub.end]
    got = {r.doc_id: r.score for r in M.score_texts(docs, held_out("doc_id", 5), VOCABULARY).filter("held_out").collect()}
    score = np.array([got[r.doc_id] for r in held])
    assert (score > unigram).mean() > 0.95 and score.sum() > 0.85 * unigram.sum()


def plain_descend(p, seen, cls, inputs, targets, scored, rng, epochs, batch=64, rate=0.08, weight=None):
    """Adagrad by the plain formulas, every weight's product for itself."""
    mask = np.triu(np.full((M.STRIDE, M.WINDOW), -np.inf), SKIP + 1)
    scored = scored * (np.ones(len(inputs)) if weight is None else weight)[:, None]
    for _ in range(epochs):
        order = rng.permutation(len(inputs))
        for s in range(0, len(order), batch):
            pick = order[s:s + batch]
            y, w, root = cls[targets[pick]], scored[pick], np.sqrt(M.DIMS)
            x = p["emb"][inputs[pick]] + p["pos"]
            late = x[:, SKIP:]
            q, k, u = late @ p["wq"], x @ p["wk"], x @ p["wv"]
            a = q @ k.transpose(0, 2, 1) / root + mask
            a = np.exp(a - a.max(2, keepdims=True))
            a /= a.sum(2, keepdims=True)
            h = a @ u + late
            z = h @ p["out"] + p["bias"]
            z = np.exp(z - z.max(2, keepdims=True))
            z /= z.sum(2, keepdims=True)
            z = (z - np.eye(M.CLASSES)[y]) * w[..., None] / max(1, w.sum())
            dh = z @ p["out"].T
            da = dh @ u.transpose(0, 2, 1)
            ds = a * (da - (da * a).sum(2, keepdims=True)) / root
            dq, dk, du = ds @ k, ds.transpose(0, 2, 1) @ q, a.transpose(0, 2, 1) @ dh
            dx = dk @ p["wk"].T + du @ p["wv"].T
            dx[:, SKIP:] += dh + dq @ p["wq"].T
            g = {"pos": dx.sum(0), "out": np.einsum("bti,btj->ij", h, z), "bias": z.sum((0, 1)), "emb": np.zeros_like(p["emb"]),
                 **{n: np.einsum("bti,btj->ij", v, e) for n, v, e in (("wq", late, dq), ("wk", x, dk), ("wv", x, du))}}
            np.add.at(g["emb"], inputs[pick], dx)
            for n, e in g.items():
                seen[n] += e * e
                p[n] -= rate * e / np.sqrt(seen[n])


@pytest.mark.parametrize("size", [1, 60])  # 60: some exponentials leave the range of floats unless shifted
def test_learning_steps_are_those_of_the_plain_formulas(size):
    rng, m = np.random.default_rng(4), small_model()
    x = rng.integers(0, 50, (150, M.WINDOW + 1))
    scored = np.arange(M.STRIDE) < rng.integers(1, M.STRIDE + 1, (150, 1))
    now, plain = ({k: getattr(m, k) * (size if k in ("emb", "out") else 1) for k in M.PARTS} for _ in range(2))
    seen, plain_seen = ({k: np.full_like(v, 1e-2) for k, v in now.items()} for _ in range(2))
    for step, p, s in ((M.descend, now, seen), (plain_descend, plain, plain_seen)):
        step(p, s, m.token_class, x[:, :-1], x[:, SKIP + 1:], scored, np.random.default_rng(7), 2, weight=1.0 + np.arange(150) % 3)
    for k in now:
        assert np.isfinite(now[k]).all() and np.allclose(now[k], plain[k], rtol=1e-6, atol=1e-6), k
        assert np.allclose(seen[k], plain_seen[k], rtol=1e-5, atol=1e-9), k


def test_words_sharing_a_place_of_the_table_keep_their_subwords(monkeypatch):
    """With two places nearly all words push each other out, and with few kept all are forgotten again and again."""
    texts = [" ".join(f"word{i * k % 97}" for i in range(60)) for k in (1, 2, 3, 5)]
    def coded(sub):
        out = []
        for t in texts * 2:
            raw, start, end, h, _ = word_spans([t])
            _, inverse, slot = sub.slots(raw, start, end, h)
            out.append(sub.expand(slot[inverse])[0].tolist())
        return out
    ranks = M.read_ranks(VOCABULARY)
    want = coded(M.Subwords(ranks))
    assert want == coded(M.Subwords(ranks, keep=30))
    monkeypatch.setattr(M, "TABLE", 1)
    assert want == coded(M.Subwords(ranks)) == coded(M.Subwords(ranks, keep=70))


def test_a_task_counts_its_words_together(spark):
    """A word is one row of a task, not one of each block of texts."""
    import pyarrow as pa

    class Held:
        value = M.read_ranks(VOCABULARY)
    batches = [pa.RecordBatch.from_pydict({"t": ["some words here", "some more"], "s": [1, 2]})] * 3
    rows = [r for b in M._count(Held, 0.0)(iter(batches)) for r in b.to_pylist() if r["h"] is not None]
    assert sorted(r["n"] for r in rows) == [3, 3, 3, 6]
