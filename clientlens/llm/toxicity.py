"""Counterfactually regularised toxicity classifier.

A whole text is the set of its words and word beginnings (4 to 7 letters, which
carries stems over to inflected and invented forms), hashed. Features are
chosen by their log-likelihood ratio against the labels, counted in Spark; a
logistic regression over them is trained in numpy. Beside the label loss it
pays for every change of score under a counterfactual: sentences of the
labelled texts that mention an identity term are repeated with another term of
the same group in its place (each group holds a neutral noun, too), and
``penalty`` times the mean squared change of the logit is added. A group's
mere mention thus can't move a score, even where the labels are biased.

Learning uses at most about ``train_rows`` labelled rows, chosen by hash from
the label table (the documented bound, which also bounds the broadcast of their
ids); a second hash filter keeps that bound if ids repeat. Scoring covers all
rows and whole texts; presence, not frequency, counts, so one insult in a very
long text weighs as much as in a short one.

Defined cases: null and empty texts score the bias (no evidence); null labels
are not learned from; conflicting labels of one id count as toxic; without any
labelled row, or with one class only, every score is the smoothed share of
toxic labels.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from clientlens.llm.shared import small_batches, written

#: Groups of terms that may stand for each other; the first of each is neutral.
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("people", "christians", "muslims", "jews", "hindus", "buddhists", "atheists", "catholics", "sikhs"),
    ("person", "christian", "muslim", "jew", "hindu", "buddhist", "atheist", "catholic", "sikh"),
    ("ordinary", "black", "white", "asian", "african", "latino", "arab", "jewish", "gay", "lesbian", "bisexual",
     "transgender", "straight", "deaf", "blind", "disabled", "elderly", "young"),
    ("adults", "women", "men", "girls", "boys", "immigrants", "refugees", "foreigners"),
    ("personnes", "femmes", "hommes", "musulmans", "juifs", "chrétiens", "immigrés", "étrangers"),
    ("menschen", "frauen", "männer", "muslime", "juden", "christen", "einwanderer", "ausländer"),
    ("personas", "mujeres", "hombres", "musulmanes", "judíos", "cristianos", "inmigrantes", "extranjeros"),
)
_WORDS = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[.!?\n]+")
PREFIXES = (4, 5, 6, 7)


def word_features(word: str) -> list[int]:
    """Hashed word and beginnings shorter than the word (signed 32 bit)."""
    out = [zlib.crc32(b"w" + word.encode("utf-8", "replace"))]
    out += [zlib.crc32(b"p" + word[:n].encode("utf-8", "replace")) for n in PREFIXES if len(word) > n]
    return [x - (1 << 32) if x >> 31 else x for x in out]


def text_features(text: str | None) -> set[int]:
    return {f for w in set(_WORDS.findall(text.lower())) for f in word_features(w)} if text else set()


def _swap(term: str, group: Sequence[str], h: int) -> str:
    """Another term of the group: the neutral one for odd ``h``."""
    if h & 1 and term != group[0]:
        return group[0]
    others = [t for t in group if t != term]
    return others[h // 2 % len(others)]


def counterfactuals(text: str | None, groups: Sequence[Sequence[str]]) -> list[tuple[set[int], set[int]]]:
    """(features, features with the identity terms swapped) of each sentence
    that mentions one. Which other term steps in is chosen by a hash of the
    sentence, the neutral noun every other time."""
    other = {t: g for g in groups for t in g}
    out = []
    for s in _SENTENCE.split(text.lower()) if text else ():
        words = _WORDS.findall(s)
        if any(w in other for w in words):
            h = zlib.crc32(s.encode("utf-8", "replace"))
            swapped = [_swap(w, other[w], h) if w in other else w for w in words]
            out.append((text_features(" ".join(words)), text_features(" ".join(swapped))))
    return out


@dataclass
class ToxicityModel:
    bias: float
    weights: dict[int, float]  # by hashed feature
    known: dict = field(default_factory=dict, repr=False)

    def score(self, text: str | None) -> float:
        hit: set[int] = set()
        if text:
            known, weights = self.known, self.weights
            for w in set(_WORDS.findall(text.lower())):
                f = known.get(w)
                if f is None:
                    if len(known) > 200_000:
                        known.clear()
                    f = known[w] = tuple(x for x in word_features(w) if x in weights)
                if f:
                    hit.update(f)
        z = self.bias + sum(self.weights[f] for f in sorted(hit))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit_weights(rows: list[np.ndarray], label: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]], dims: int,
                penalty: float = 10.0, l2: float = 1e-5, rounds: int = 800, rate: float = 3.0) -> tuple[float, np.ndarray]:
    """Logistic regression on sets of feature indices with the counterfactual
    penalty; full-batch Adagrad. The features were chosen as signs of the
    label, so weights stay at 0 or above: a long clean passage can't outweigh
    an insult. Returns bias and weights."""
    w, b = np.zeros(dims), float(np.log((label.sum() + 0.5) / (len(label) - label.sum() + 0.5)))
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    ids = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
    p_owner = np.repeat(np.arange(len(pairs)), [len(x) + len(y) for x, y in pairs])
    p_ids = np.concatenate([z for p in pairs for z in p] + [np.zeros(0)]).astype(np.int64)
    p_sign = np.concatenate([s * np.ones(len(z)) for p in pairs for s, z in zip((1, -1), p)] + [np.zeros(0)])
    balance = np.where(label > 0.5, 0.5 / max(1, (label > 0.5).sum()), 0.5 / max(1, (label <= 0.5).sum()))
    seen, seen_b = np.full(dims, 1e-8), 1e-8
    for _ in range(rounds):
        z = np.bincount(owner, w[ids], len(rows)) + b
        err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - label) * balance
        g = np.bincount(ids, err[owner], dims) + l2 * w
        if len(pairs):
            change = np.bincount(p_owner, w[p_ids] * p_sign, len(pairs))
            g += 2 * penalty / len(pairs) * np.bincount(p_ids, change[p_owner] * p_sign, dims)
        g_b = err.sum() + 1e-3 * (b + 1.5)
        seen, seen_b = seen + g * g, seen_b + g_b * g_b
        w, b = np.maximum(w - rate * g / np.sqrt(seen), 0.0), b - rate * g_b / np.sqrt(seen_b)
    return b, w


def fit(docs: DataFrame, labels: DataFrame, keep=None, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
        train_rows: int = 20_000, penalty: float = 10.0,
        groups: Sequence[Sequence[str]] = IDENTITY_TERMS, seed: int = 11) -> ToxicityModel:
    """Learn from the rows of ``docs`` that ``labels`` marks. ``keep`` is a
    condition on the id (column named ``doc_id``) of rows to learn from."""
    small_batches(docs.sparkSession)
    marks = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).alias("y")).filter("y is not null and doc_id is not null")
    if keep is not None:
        marks = marks.filter(keep)
    marks = marks.groupBy("doc_id").agg(F.max("y").alias("y"))
    slot = lambda c: F.pmod(F.xxhash64(c, F.lit(seed)), F.lit(1 << 20))
    part = lambda n: 1 << 20 if n <= train_rows else int(train_rows / n * (1 << 20))
    marks = F.broadcast(marks.filter(slot("doc_id") < part(marks.count())))  # about train_rows rows of 12 bytes
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("t")).join(marks, "doc_id")
    n = rows.select("doc_id").count()
    if n > train_rows:  # an id with many rows: each distinct text once, then by hash
        rows = rows.groupBy(F.xxhash64("t").alias("h"), "y").agg(F.first("t").alias("t"))
        rows = rows.filter(slot("t") < part(rows.count()))

    @F.pandas_udf("x array<int>, a array<array<int>>, b array<array<int>>")
    def drawn(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            got = []
            for t in s:
                pairs = counterfactuals(t, groups)
                got.append((sorted(text_features(t)), [sorted(p - q) for p, q in pairs], [sorted(q - p) for p, q in pairs]))
            yield pd.DataFrame(got, columns=["x", "a", "b"])

    rows = written(rows.select("y", drawn("t").alias("f")).select(F.col("y").cast("int").alias("y"), "f.*"), "toxic-sample")
    n, pos = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0))).first()
    if not n or not pos or pos == n:
        p = (pos + 0.5) / (n + 1)
        return ToxicityModel(float(np.log(p / (1 - p))), {})

    # log-likelihood ratio of each feature against the label; all that pass the test stay (train_rows bounds them)
    seen = rows.select("y", F.explode("x").alias("f")).groupBy("f").agg(F.sum("y").alias("k1"), F.count(F.lit(1)).alias("k"))
    def term(o, e):
        return F.when(o > 0, o * F.log(o / e)).otherwise(0.0)
    k1, k0 = F.col("k1").cast("double"), (F.col("k") - F.col("k1")).cast("double")
    g2 = 2 * (term(k1, F.col("k") * pos / n) + term(k0, F.col("k") * (n - pos) / n)
              + term(pos - k1, (n - F.col("k")) * pos / n) + term(n - pos - k0, (n - F.col("k")) * (n - pos) / n))
    chosen = seen.filter((F.col("k1") >= 3) & (F.col("k1") / F.col("k") > 2 * pos / n)).withColumn("g2", g2) \
        .filter("g2 > 24").orderBy(F.desc("g2"), "f")
    ids = [r.f for r in chosen.select("f").collect()]
    at = {f: i for i, f in enumerate(ids)}
    if not ids:
        return ToxicityModel(float(np.log((pos + 0.5) / (n - pos + 0.5))), {})
    have = F.array(*[F.lit(i) for i in ids])
    cut = rows.select("y", F.array_intersect("x", have).alias("x"),
                      F.filter(F.arrays_zip(F.transform("a", lambda z: F.array_intersect(z, have)).alias("a"),
                                            F.transform("b", lambda z: F.array_intersect(z, have)).alias("b")),
                               lambda p: (F.size(p["a"]) > 0) | (F.size(p["b"]) > 0)).alias("p"))
    local = cut.select("y", "x", F.col("p.a").alias("a"), F.col("p.b").alias("b")).toPandas()
    index = lambda z: np.array([at[i] for i in z], np.int64)
    pairs = [(index(a), index(b)) for aa, bb in zip(local["a"], local["b"]) for a, b in zip(aa, bb)]
    bias, w = fit_weights([index(x) for x in local["x"]], local["y"].to_numpy(float), pairs, len(ids), penalty)
    return ToxicityModel(bias, {f: float(v) for f, v in zip(ids, w) if abs(v) > 1e-6})


def score(docs: DataFrame, model: ToxicityModel, text: str = "text", out: str = "score") -> DataFrame:
    small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(ToxicityModel(model.bias, model.weights))

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield pd.Series([held.value.score(t) for t in b], dtype="float64")

    return docs.withColumn(out, run(F.col(text)))
