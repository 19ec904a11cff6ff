"""Quality classifier from weak labels.

Overlapping heuristic labellers vote bad (0), good (1) or abstain (2) on every
document. The votes of all documents are counted by vote pattern in Spark (at
most 3^labellers patterns, whatever the input's size), and expectation
maximisation over those counts estimates each labeller's vote rates given the
hidden class. Posterior labels then train a hashed linear scorer of word shapes and of steps
of repetition (logistic regression) which scores whole texts.

Only the scorer's training rows are sampled: distinct texts chosen by their
hash, at most ``train_rows`` expected, whatever the copies. Votes, EM and scoring cover all rows.

Defined cases: a null or empty text has no words, all labellers abstain and its
score is 0 (rejected); an input without any words fits a neutral scorer.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from clientlens.llm.shared import small_batches, temp_name

BAD, GOOD, ABSTAIN = 0, 1, 2
DIMS = 4096
_CLASS = np.zeros(256, np.uint8)  # 0: other
for _k, _chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r\n\x0b\x0c",
                             b".,;:?'\"()-", b"#$%&*@^~<>{}[]=+\\_/`|!"), 1):
    _CLASS[list(_chars)] = _k
_CLASS[128:] = 7  # bytes of non-ASCII characters
_PLAIN = re.compile(r"[(\"']?[^\W\d_]+(?:['-][^\W\d_]+)*[)\"']?[.,;:?]?")


def facts(text: str, words: list[str]) -> dict[str, float]:
    """Measured shares that the labellers judge; ``words`` is not empty."""
    n = np.bincount(_CLASS[np.frombuffer(text.encode("utf-8", "replace"), np.uint8)], minlength=8)
    chars, letters = n.sum() - n[4], max(1, n[1] + n[2] + n[7])
    counts = Counter(words)
    plain = sum(c for w, c in counts.items() if _PLAIN.fullmatch(w))
    lines = [x for x in text.split("\n") if x.strip()]
    copies = Counter(lines)
    raw = text.encode("utf-8", "replace")
    return {
        "n": len(words),
        "symbols": n[6] / chars,
        "capitals": n[2] / letters,
        "plain": plain / len(words),
        "odd_ends": sum(c for w, c in counts.items() if w[-1] in "#$%&*@^~<>{}[]=+\\_/`|!") / len(words),
        "echoes": sum(map(str.__eq__, words, words[1:])) / len(words),
        "top": max(counts.values()) / len(words),
        "variety": len(counts) / len(words) ** 0.8,
        "packed": len(zlib.compress(raw, 1)) / len(raw),
        "copied": sum(len(x) * (c - 1) for x, c in copies.items()) / max(1, sum(map(len, lines))),
    }


#: Steps at which a repetition feature sets in: of the share of the most frequent word and of
#: copied lines upwards, of variety and of the packed size downwards; and the words it needs.
_STEPS = {"top": ((0.1, 0.15, 0.25, 0.4), 12), "copied": ((0.2, 0.4, 0.6, 0.8), 12),
          "variety": ((0.6, 0.5, 0.35, 0.25), 12), "packed": ((0.34, 0.28, 0.22, 0.16), 40)}


def repetition(text: str, words: list[str], counts: Counter) -> Iterator[bytes]:
    """Names of the repetition features of a text with words. Each step passed
    is one, so a text further out has those of all texts less far out."""
    n = len(words)
    if n < 12:
        return
    lines = [x for x in text.split("\n") if x.strip()]
    raw = text.encode("utf-8", "replace")
    measured = {"top": max(counts.values()) / n, "variety": len(counts) / n ** 0.8,
                "copied": sum(len(x) * (c - 1) for x, c in Counter(lines).items()) / max(1, sum(map(len, lines))),
                "packed": len(zlib.compress(raw, 1)) / len(raw) if n >= _STEPS["packed"][1] else 1.0}
    for name, (steps, _) in _STEPS.items():
        for step in steps:
            if measured[name] > step if steps[0] < steps[-1] else measured[name] < step:
                yield f"<{name} {step}>".encode()


def _bad_if(fact: str, test, least: int = 1):
    return lambda f: BAD if f["n"] >= least and test(f[fact]) else ABSTAIN


#: Overlapping by intent: each kind of junk is seen by at least two of them.
LABELLERS = {
    "symbols": _bad_if("symbols", lambda x: x > 0.04),
    "odd_ends": _bad_if("odd_ends", lambda x: x > 0.2),
    "not_plain": _bad_if("plain", lambda x: x < 0.75),
    "capitals": _bad_if("capitals", lambda x: x > 0.35, 3),
    "echoes": _bad_if("echoes", lambda x: x > 0.2, 4),
    "top_word": _bad_if("top", lambda x: x > 0.25, 12),
    "low_variety": _bad_if("variety", lambda x: x < 0.35, 12),
    "packed": _bad_if("packed", lambda x: x < 0.22, 40),
    "copied_lines": _bad_if("copied", lambda x: x > 0.4, 12),
    "reads_plain": lambda f: GOOD if f["plain"] > 0.9 and f["echoes"] < 0.05 else ABSTAIN,
    "reads_varied": lambda f: GOOD if f["variety"] > 0.7 and f["capitals"] < 0.25 else ABSTAIN,
}


def votes(text: str | None) -> list[int]:
    """One vote per labeller, in the order of LABELLERS."""
    words = text.split() if text else []
    if not words:
        return [ABSTAIN] * len(LABELLERS)
    f = facts(text, words)
    return [rule(f) for rule in LABELLERS.values()]


def em(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Two-class model of conditionally independent labellers. ``patterns``
    (P, L) holds votes, ``counts`` (P,) how many documents cast them. Returns
    the prior (2,) and the rates (L, 2, 3): P(vote | class), from a start at
    which every labeller is right more often than not."""
    labellers = patterns.shape[1]
    hot = np.eye(3)[patterns]  # P, L, 3
    prior = np.array([0.2, 0.8])
    rates = np.broadcast_to(np.array([[0.6, 0.1, 0.3], [0.05, 0.6, 0.35]]), (labellers, 2, 3)).copy()
    for _ in range(rounds):
        post = posterior(patterns, prior, rates)
        mass = post * counts[:, None]  # P, 2
        prior = (mass.sum(0) + 1) / (mass.sum() + 2)
        rates = np.einsum("pc,plv->lcv", mass, hot) + 0.5
        rates /= rates.sum(-1, keepdims=True)
    return prior, rates


def posterior(patterns: np.ndarray, prior: np.ndarray, rates: np.ndarray) -> np.ndarray:
    logs = np.log(prior)[None] + sum(np.log(rates[j][:, patterns[:, j]]).T for j in range(patterns.shape[1]))
    p = np.exp(logs - logs.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


_PARTS = re.compile(r"[^\W\d_]+|\d+")


def _shape(word: str) -> str:
    """Letter runs become a, Aa or A, digit runs 9; everything else stays."""
    return _PARTS.sub(lambda m: "9" if m[0][0].isdigit() else "a" if m[0].islower() else
                      "A" if m[0].isupper() and len(m[0]) > 1 else "Aa", word)


class Shapes:
    """Hashed word-shape frequencies of a text: bucket ids and their shares."""

    def __init__(self, dims: int = DIMS, keep: int = 200_000):
        self.dims, self.keep, self.known = dims, keep, {}

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        words = text.split() if text else []
        out: Counter[int] = Counter()
        known = self.known
        echoes = sum(map(str.__eq__, words, words[1:]))
        if echoes:
            out[zlib.crc32(b"<echo>") % self.dims] += echoes
        counts = Counter(words)
        for name in repetition(text, words, counts):
            out[zlib.crc32(name) % self.dims] += len(words)
        for w, c in counts.items():
            k = known.get(w)
            if k is None:
                if len(known) >= self.keep:
                    known.clear()
                k = known[w] = zlib.crc32(_shape(w).encode()) % self.dims
            out[k] += c
        ids = np.fromiter(sorted(out), np.int64, len(out))
        return ids, np.array([out[i] for i in ids]) / max(1, len(words))


@dataclass
class QualityModel:
    prior: np.ndarray
    rates: np.ndarray
    weights: np.ndarray  # of the hashed shapes; the last is the bias

    def score(self, text: str | None, shapes: Shapes) -> float:
        ids, share = shapes(text)
        if not len(ids):
            return 0.0
        z = float(self.weights[ids] @ np.sqrt(share) + self.weights[-1])
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, dims: int = DIMS, rounds: int = 300,
               rate: float = 0.5, l2: float = 1e-5) -> np.ndarray:
    """Logistic regression on soft labels, full-batch Adagrad in numpy."""
    w = np.zeros(dims + 1)
    if not len(rows):
        return w
    owner = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    ids, x = np.concatenate([r[0] for r in rows]).astype(np.int64), np.sqrt(np.concatenate([r[1] for r in rows]))
    seen = np.full(dims + 1, 1e-8)
    for _ in range(rounds):
        z = np.bincount(owner, w[ids] * x, len(rows)) + w[-1]
        err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) / len(rows)
        g = np.append(np.bincount(ids, err[owner] * x, dims), err.sum()) + l2 * w
        seen += g * g
        w -= rate * g / np.sqrt(seen)
    return w


def fit(docs: DataFrame, text: str = "text", train_rows: int = 20_000, seed: int = 7) -> QualityModel:
    """Vote counts of all rows, EM, and a scorer of about ``train_rows`` rows
    (the documented sample bound)."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("string")
    def cast(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield pd.Series(["".join(map(str, votes(t))) for t in b])

    # bounded: one row per vote pattern
    rows = docs.select(cast(F.col(text)).alias("v")).groupBy("v").agg(F.count(F.lit(1)).alias("n")).collect()
    if not rows:
        rows = [("2" * len(LABELLERS), 0)]
    patterns = np.array([[int(x) for x in v] for v, _ in rows], np.int64)
    counts = np.array([n for _, n in rows], float)
    silent = (patterns == ABSTAIN).all(1)
    counts[silent] = 0
    prior, rates = em(patterns, counts)
    total = float(counts.sum())
    if not total:
        return QualityModel(prior, rates, np.zeros(DIMS + 1))

    share = min(1.0, train_rows / total)
    chosen = docs.select(F.col(text).alias("t")).filter(F.length("t") > 0) \
        .filter(F.pmod(F.xxhash64("t", F.lit(seed)), F.lit(1 << 20)) < int(share * (1 << 20)) + (share == 1.0)) \
        .groupBy(F.xxhash64("t").alias("h")).agg(F.first("t").alias("t"))

    @F.pandas_udf("ids array<int>, share array<float>, v array<int>")
    def drawn(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        shapes = Shapes()
        for b in batches:
            got = [(*shapes(t), votes(t)) for t in b]
            yield pd.DataFrame(got, columns=["ids", "share", "v"])

    sample = chosen.select(drawn("t").alias("f")).select("f.*").toPandas()
    sample = sample[sample["ids"].map(len) > 0]
    label = posterior(np.array(sample["v"].tolist(), np.int64).reshape(-1, len(LABELLERS)), prior, rates)[:, GOOD]
    return QualityModel(prior, rates, fit_scorer(list(zip(sample["ids"], sample["share"])), label))


def score(docs: DataFrame, model: QualityModel, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the probability that a whole text is good."""
    small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        shapes, m = Shapes(), held.value
        for b in batches:
            yield pd.Series([m.score(t, shapes) for t in b], dtype="float64")

    return docs.withColumn(out, run(F.col(text)))


def quality_stage(spark, docs: DataFrame, sf_dir: str, threshold: float = 0.5) -> DataFrame:
    """Rows whose score reaches the threshold, with their own columns."""
    name = temp_name(docs, "quality")
    return score(docs, fit(docs), out=name).filter(F.col(name) >= threshold).drop(name)
