"""Language identification by a linear-chain conditional random field.

The field labels every word (run of letters, lower-cased) of a text with a
language. Emission scores come from hashed affixes (1 to 3 letters), character
2- and 3-grams with word ends, and a lexicon; transition scores between
languages are learned with them. Training sequences are code-switched: word
spans of labelled texts in different languages are strung together, so the
field sees real switches and learns how rare they are. Weights are fitted by
maximum likelihood (forward-backward gradients, Adagrad, numpy).

A text's posterior is the mean of its words' forward-backward marginals over
the whole text. Long texts are cut into chunks whose transfer matrices are
multiplied exactly, so the sums run across the chunks as if uncut.

The lexicon holds counts by language and hashed word over all words of all
learning rows (summed in Spark, 2^15 buckets a language). Only the CRF weights
use a sample: about ``rows_per_language`` rows of each language, chosen by hash,
with ``spans`` spans of ``span_words`` words spread over each whole text.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
equal posteriors go to the language that sorts first; rows with a null language
are not learned from; without learning rows every text is ``und``.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from clientlens.llm.shared import small_batches, temp_name, text_blocks

DIMS, LEXICON, CHUNK = 1 << 16, 1 << 15, 128
_WORDS = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return _WORDS.findall(text.lower()) if text else []


def word_grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of many words at once: (feature ids, index of the word
    each belongs to). With ^ and $ as word ends these are all 2- and 3-grams
    (the outer ones are the affixes of 1 and 2 letters) and the 4-grams at both
    ends (affixes of 3 letters)."""
    size = np.fromiter(map(len, words), np.int64, len(words)) + 2
    c = np.frombuffer("".join(f"^{w}$" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), size)
    first = np.cumsum(size) - size
    left = np.repeat(first + size, size) - np.arange(len(c))  # letters from here to the word's end
    ids, who = [], []
    for n in (2, 3, 4):
        at = np.flatnonzero(left >= n)
        if n == 4:
            at = at[(at == first[owner[at]]) | (left[at] == n)]
        h = np.full(len(at), n * 0x9E3779B97F4A7C15 & (1 << 64) - 1, np.uint64)
        for i in range(n):
            h = (h ^ c[at + i]) * np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(29)
        ids.append((h >> np.uint64(40)).astype(np.int64) % DIMS)
        who.append(owner[at])
    return np.concatenate(ids), np.concatenate(who)


def gram_scores(words: list[str], weights: np.ndarray) -> np.ndarray:
    """(words, K) summed weights of each word's features."""
    ids, who = word_grams(words)
    return np.stack([np.bincount(who, weights[ids, c], len(words)) for c in range(weights.shape[1])], 1)


def lexicon_bucket(word: str) -> int:
    return zlib.crc32(b"lex" + word.encode("utf-8", "replace")) % LEXICON


def forward_backward(psi: np.ndarray, lengths: np.ndarray, trans: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Marginals of sequences laid end to end. ``psi`` (N, K) holds positive
    emission factors, ``lengths`` their lengths (all at least 1), ``trans``
    (K, K) and ``start`` (K,) positive factors. Sequences are cut into chunks;
    a chunk's product of step matrices carries the messages across it."""
    n, k = psi.shape
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    per = -(-lengths // CHUNK)
    owner = np.repeat(np.arange(len(lengths)), per)
    within = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
    at = first[owner] + within * CHUNK
    size = np.minimum(CHUNK, lengths[owner] - within * CHUNK)
    span = int(size.max())
    order = np.argsort(-size, kind="stable")  # the chunks that are active at step t come first
    at, size, owner, within = at[order], size[order], owner[order], within[order]
    active = [int(np.searchsorted(-size, -t, side="left")) for t in range(span)]  # chunks with size > t
    c = len(at)

    def norm(x, axes):
        return x / np.maximum(x.max(axis=axes, keepdims=True), 1e-300)

    g = np.einsum("ck,kj->ckj", psi[at], np.eye(k))
    for t in range(1, span):
        a = active[t]
        g[:a] = norm((g[:a].reshape(-1, k) @ trans).reshape(a, k, k) * psi[at[:a] + t][:, None, :], (1, 2))
    into, out = np.empty((c, k)), np.ones((c, k))
    place = np.empty(c, np.int64)
    place[order] = np.arange(c)  # chunk in text order -> row
    v = None
    for row in place:
        into[row] = x = start if within[row] == 0 else v @ trans
        v = x @ g[row]
        v = v / v.sum()
    v = None
    for row in place[::-1]:
        # the last chunk of a text is followed by the next text's first
        out[row] = b = np.ones(k) if v is None else v
        b = g[row] @ b
        v = None if within[row] == 0 else norm(trans @ b, 0)
    alpha = np.empty((span, c, k))
    alpha[0] = into * psi[at]
    for t in range(1, span):
        a = active[t]
        alpha[t, :a] = norm((alpha[t - 1, :a] @ trans) * psi[at[:a] + t], 1)
    gamma, beta = np.empty((n, k)), out
    for t in range(span - 1, -1, -1):
        a = active[t]
        gamma[at[:a] + t] = alpha[t, :a] * beta[:a]
        if t:
            beta[:a] = norm((psi[at[:a] + t] * beta[:a]) @ trans.T, 1)
    return gamma / gamma.sum(1, keepdims=True)


@dataclass
class LanguageModel:
    langs: list[str]
    weights: np.ndarray  # (DIMS, K)
    lexicon: np.ndarray  # (LEXICON, K) centred log rates
    lex_weight: float
    trans: np.ndarray  # (K, K) log factors
    start: np.ndarray  # (K,) log factors
    known: dict = field(default_factory=dict, repr=False)
    scores: np.ndarray | None = field(default=None, repr=False)

    def emissions(self, words: list[str], keep: int = 300_000) -> np.ndarray:
        """Log emission scores (N, K); distinct words are scored once and
        remembered, up to ``keep`` of them."""
        known = self.known
        if self.scores is None or len(known) > keep:
            known.clear()
            self.scores = np.zeros((1024, len(self.langs)))
        new = [w for w in dict.fromkeys(words) if w not in known]
        base = len(known)
        if base + len(new) > len(self.scores):
            self.scores = np.concatenate([self.scores, np.zeros((base + len(new), len(self.langs)))])
        if new:
            known.update(zip(new, range(base, base + len(new))))
            lex = self.lexicon[[lexicon_bucket(w) for w in new]]
            self.scores[base:base + len(new)] = gram_scores(new, self.weights) + self.lex_weight * lex
        return self.scores[np.fromiter(map(known.__getitem__, words), np.int64, len(words))]

    def marginals(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Word marginals (n, K) of each list of words."""
        lengths = np.array([len(t) for t in texts])
        full = lengths > 0
        out = [np.zeros((0, len(self.langs)))] * len(texts)
        if not full.any():
            return out
        e = self.emissions([w for t in texts for w in t])
        psi = np.exp(np.clip(e - e.max(1, keepdims=True), -60, 0))
        g = forward_backward(psi, lengths[full], np.exp(self.trans), np.exp(self.start))
        for i, part in zip(np.flatnonzero(full), np.split(g, np.cumsum(lengths[full])[:-1])):
            out[i] = part
        return out

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, mean marginal) of each text; ('und', 0.0) without letters."""
        if not self.langs:
            return [("und", 0.0)] * len(texts)
        got = []
        for g in self.marginals([words_of(t) for t in texts]):
            p = g.mean(0) if len(g) else None
            got.append(("und", 0.0) if p is None else (self.langs[int(p.argmax())], float(min(1.0, p.max()))))
        return got

    def spans(self, text: str | None) -> list[tuple[str, int, int]]:
        """Runs of words with the same most likely language: (language, first
        character, end) in the text as given."""
        hits = [(m.start(), m.end()) for m in _WORDS.finditer(text.lower())] if text and self.langs else []
        if not hits or len(text) != len(text.lower()):
            hits = [(m.start(), m.end()) for m in _WORDS.finditer(text)] if hits else []
        if not hits:
            return []
        best = self.marginals([[text[a:b].lower() for a, b in hits]])[0].argmax(1)
        edges = [0, *(np.flatnonzero(np.diff(best)) + 1).tolist(), len(hits)]
        return [(self.langs[best[i]], hits[i][0], hits[j - 1][1]) for i, j in zip(edges, edges[1:])]


def train_crf(spans: list[tuple[int, list[str]]], langs: list[str], lexicon: np.ndarray, joined: int = 4, batch: int = 64,
              epochs: int = 3, rate: float = 0.15, l2: float = 1e-6, seed: int = 5) -> LanguageModel:
    """Fit on (language index, words) spans, ``joined`` of them strung together
    per sequence in a seeded order. Sequences of equal length share a batch
    matrix; gradients come from forward-backward pair marginals."""
    k = len(langs)
    m = LanguageModel(langs, np.zeros((DIMS, k)), lexicon, 1.0, np.zeros((k, k)), np.zeros(k))
    if k < 2 or not spans:
        return m
    names = list(dict.fromkeys(w for _, ws in spans for w in ws))
    vocab = {w: i for i, w in enumerate(names)}
    coded = [(y, np.array([vocab[w] for w in ws])) for y, ws in spans]
    lex = lexicon[[lexicon_bucket(w) for w in names]]
    rng = np.random.default_rng(seed)
    seen = [np.full_like(x, 1e-6) for x in (m.weights, m.trans, m.start)] + [1e-6]
    for _ in range(epochs):
        order = rng.permutation(len(coded))
        seqs = [[coded[i] for i in order[j:j + joined]] for j in range(0, len(order), joined)]
        for j in range(0, len(seqs), batch):
            part = seqs[j:j + batch]
            length = np.array([sum(len(w) for _, w in s) for s in part])
            top = length.max()
            ids, lab = np.zeros((top, len(part)), np.int64), np.zeros((top, len(part)), np.int64)
            for b, s in enumerate(part):
                ids[:length[b], b] = np.concatenate([w for _, w in s])
                lab[:length[b], b] = np.concatenate([np.full(len(w), y) for y, w in s])
            mask = np.arange(top)[:, None] < length[None]
            used, inverse = np.unique(ids[mask], return_inverse=True)
            f, who = word_grams([names[i] for i in used])
            emit_w = np.stack([np.bincount(who, m.weights[f, c], len(used)) for c in range(k)], 1) + m.lex_weight * lex[used]
            e = np.zeros((top, len(part), k))
            e[mask] = emit_w[inverse]
            psi = np.exp(e - e.max(2, keepdims=True))
            trans, start = np.exp(m.trans), np.exp(m.start)
            alpha = np.empty_like(psi)
            x = start * psi[0]
            alpha[0] = x / x.sum(1, keepdims=True)
            for t in range(1, top):
                x = (alpha[t - 1] @ trans) * psi[t]
                alpha[t] = np.where(mask[t][:, None], x / x.sum(1, keepdims=True), alpha[t - 1])
            beta, g, pair = np.ones((len(part), k)), np.zeros_like(psi), np.zeros((k, k))
            for t in range(top - 1, -1, -1):
                p = alpha[t] * beta
                g[t] = p / p.sum(1, keepdims=True)
                if t:
                    y = psi[t] * beta
                    both = alpha[t - 1][:, :, None] * trans[None] * y[:, None, :]
                    both /= both.sum((1, 2), keepdims=True)
                    pair += (both * mask[t][:, None, None]).sum(0)
                    y = y @ trans.T
                    beta = np.where(mask[t][:, None], y / y.sum(1, keepdims=True), beta)
            total = mask.sum()
            err = (g - np.eye(k)[lab])[mask] / total
            move = mask[1:].ravel()
            real = np.bincount((lab[:-1] * k + lab[1:]).ravel()[move], minlength=k * k).reshape(k, k)
            by_word = np.stack([np.bincount(inverse, err[:, c], len(used)) for c in range(k)], 1)
            grads = [np.stack([np.bincount(f, by_word[who, c], DIMS) for c in range(k)], 1) + l2 * m.weights,
                     (pair - real) / total, (g[0] - np.eye(k)[lab[0]]).mean(0) / top, float((by_word * lex[used]).sum())]
            for i, gr in enumerate(grads):
                seen[i] = seen[i] + gr * gr
            m.weights -= rate * grads[0] / np.sqrt(seen[0])
            m.trans -= rate * grads[1] / np.sqrt(seen[1])
            m.start -= rate * grads[2] / np.sqrt(seen[2])
            m.lex_weight -= rate * grads[3] / np.sqrt(seen[3])
    return m


def _lexicon_counts(batches):
    """Per task: summed word counts by (language, bucket); the table held is
    bounded by languages x buckets."""
    total: dict[str, np.ndarray] = {}
    for b in batches:
        langs, texts = b.column("l").to_pylist(), b.column("t")
        by: dict[str, Counter] = {}
        for i, lang in enumerate(langs):
            by.setdefault(lang, Counter()).update(words_of(texts[i].as_py()))
        for lang, c in by.items():
            row = total.setdefault(lang, np.zeros(LEXICON, np.int64))
            row += np.bincount([lexicon_bucket(w) for w in c], list(c.values()), LEXICON).astype(np.int64)
    for lang, row in total.items():
        hit = np.flatnonzero(row)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(hit), pa.string()), pa.array(hit, pa.int32()),
                                          pa.array(row[hit])], names=["l", "b", "n"])


def fit(docs: DataFrame, keep: Column | None = None, text: str = "text", lang: str = "lang", rows_per_language: int = 1500,
        spans: int = 4, span_words: int = 24, seed: int = 5) -> LanguageModel:
    """Learn from the rows of ``docs`` with a language that meet ``keep``."""
    small_batches(docs.sparkSession)
    rows = docs.filter(keep) if keep is not None else docs
    rows = rows.select(F.col(lang).cast("string").alias("l"), F.col(text).alias("t")).filter("l is not null and t is not null")
    # one row per language
    sizes = {r.l: r.n for r in rows.groupBy("l").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return LanguageModel([], np.zeros((DIMS, 0)), np.zeros((LEXICON, 0)), 1.0, np.zeros((0, 0)), np.zeros(0))
    counts = rows.mapInArrow(_lexicon_counts, "l string, b int, n long").groupBy("l", "b").agg(F.sum("n").alias("n")).toPandas()
    lexicon = np.zeros((LEXICON, len(langs)))
    lexicon[counts["b"], counts["l"].map(langs.index)] = counts["n"]
    rate = np.log((lexicon + 0.5) / (lexicon.sum(0) + 0.5 * LEXICON))
    rate = np.clip(rate - rate.mean(1, keepdims=True), -4, 4) * (lexicon.sum(1, keepdims=True) > 0)

    bound = F.create_map(*[x for l, n in sizes.items() for x in
                           (F.lit(l), F.lit(min(1 << 20, int(rows_per_language / n * (1 << 20)) + 1)))])

    @F.pandas_udf("array<array<string>>")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            got = []
            for t in b:
                ws = words_of(t)
                starts = np.linspace(0, max(0, len(ws) - span_words), spans).astype(int) if len(ws) > span_words else [0]
                got.append([ws[i:i + span_words] for i in dict.fromkeys(starts)] if ws else [])
            yield pd.Series(got)

    slot = F.pmod(F.xxhash64("t", F.lit(seed)), F.lit(1 << 20))
    # each distinct text once, so that the bound holds whatever the copies
    chosen = rows.filter(slot < F.element_at(bound, F.col("l"))).groupBy("l", F.xxhash64("t").alias("h")).agg(F.first("t").alias("t"))
    drawn = chosen.select("l", slot.alias("s"), cut("t").alias("w")).toPandas()
    drawn = drawn.sort_values(["l", "s"], kind="stable")
    pieces = [(langs.index(l), list(ws)) for l, ss in zip(drawn["l"], drawn["w"]) for ws in ss if len(ws)]
    pieces.sort(key=lambda p: (p[0], zlib.crc32(" ".join(p[1]).encode("utf-8", "replace")), p[1]))
    return train_crf(pieces, langs, rate, seed=seed)


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", lang: str = "lang_pred", out: str = "score",
             spans: str | None = None) -> DataFrame:
    """``docs`` with the predicted language and its mean marginal; with
    ``spans`` also the text's runs of one language (language, start, end)."""
    small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(
        LanguageModel(model.langs, model.weights, model.lexicon, model.lex_weight, model.trans, model.start))
    kind = "lang string, score double" + ", spans array<struct<lang: string, start: int, end: int>>" * bool(spans)

    @F.pandas_udf(kind)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = []
            for _, part in text_blocks(b.tolist()):
                got += held.value.predict(part)
            frame = pd.DataFrame(got, columns=["lang", "score"])
            if spans:
                frame["spans"] = [[{"lang": l, "start": a, "end": e} for l, a, e in held.value.spans(t)] for t in b]
            yield frame

    name = temp_name(docs, "language")
    cols = {lang: F.col(f"{name}.lang"), out: F.col(f"{name}.score")} | ({spans: F.col(f"{name}.spans")} if spans else {})
    return docs.withColumn(name, run(F.col(text))).withColumns(cols).drop(name)


def language_stage(spark, docs: DataFrame, sf_dir: str, least: float = 0.4) -> DataFrame:
    """Rows whose text has a language with a posterior of ``least`` or more,
    with their own columns. Texts without letters and even mixtures go."""
    a, b = temp_name(docs, "lang"), temp_name(docs, "score")
    return identify(docs, fit(docs), lang=a, out=b).filter((F.col(a) != "und") & (F.col(b) >= least)).drop(a, b)
