"""Language-model scoring with a causal self-attention model on subword ids.

Words (lower-cased A-Z, white-space delimited) are encoded one by one with a
public byte-pair vocabulary, ``" " + word``; a text is its words' subwords and
one end token. The model has token and position embeddings, one causal
attention layer with a residual path, and a factored output: a softmax over
token classes, times the token's smoothed share of its class. What precedes and
follows each token is counted over all learning texts: the classes are clusters
of the one, the first embeddings projections of the other. The shares, like the
word counts of the base score, are counted over all learning texts too.

The weights learn from all windows of the learning texts (``train_share`` of
them, if less than 1), equal windows joined with their count as weight. A first shard of about ``train_windows`` is fitted on the
driver; every other shard goes on from there in a task of its own, and the
shards' steps are averaged, embeddings by how often a shard met the token. The
shards are dealt by the windows' hash, whatever the files' layout.

Whole texts are scored in windows of ``WINDOW`` inputs that overlap by
``WINDOW - STRIDE``, so that each token has at least that many before it and is
scored once. Windows of many texts share batched masked attention.

The base score needs each word's count. Words with at least N / 2^20 tokens are
broadcast (so at most 2^20 of them, 16 MB); pairs of the other words with their
rows are joined to the count table, in which no key is hot by construction.
Counts are keyed by 64-bit word hashes.

Defined cases: a null text is empty, i.e. its end token alone; without learning
rows all counts are 0 and the model is untrained; repeated rows are scored each.
"""

from __future__ import annotations

import base64
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from clientlens.llm.shared import small_batches, text_blocks, written
from clientlens.llm.shingles import grouped, mix, word_spans

WINDOW, STRIDE, DIMS, CLASSES, HEAVY = 24, 20, 16, 64, 1 << 20
PROFILE = 64  # hash slots of the tokens before or after a token
TABLE = 21  # a coder's table of words has 2^TABLE places
_BLOCK = 1_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    """A public vocabulary file: base64 token and rank a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Subwords:
    """Subword ids of words by their hashes; codes at most ``keep`` words, then forgets them all."""

    def __init__(self, ranks: dict[bytes, int], keep: int = 600_000):
        import tiktoken
        self.end = max(ranks.values()) + 1
        self.size = self.end + 1
        self.line = ranks[b"\n"]
        self._code = tiktoken.Encoding("words", pat_str=r"[^\n]+|\n", mergeable_ranks=ranks, special_tokens={})
        self.keep = keep
        self._clear()

    def _clear(self):
        # a word's hash picks its place in the table, which the latest word of that place holds
        self.table, self.known = np.zeros(1 << TABLE, np.int32), 0
        self.flat, self.used = np.zeros(1 << 16, np.int32), 0
        self.word, self.begin, self.count = np.zeros(1 << 14, np.uint64), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def slots(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(distinct hashes, word -> distinct, distinct -> slot)."""
        u, first, inverse = grouped(h)
        if self.known + len(u) > self.keep + len(u) * (not self.known):
            self._clear()
        place = (u >> np.uint64(64 - TABLE)).view(np.int64)
        slot = self.table[place].astype(np.int64)
        new = np.flatnonzero((self.word[slot] != u) | (slot >= self.known))
        if len(new):
            data = raw.tobytes()
            at = first[new]
            # one call for all words: no word holds a line feed, whose token so marks their ends
            lines = b"".join([b" %b\n" % data[a:b] for a, b in zip(start[at].tolist(), end[at].tolist())])
            ids = np.array(self._code.encode_ordinary(lines.decode("utf-8", "replace")), np.int32)
            stop = np.flatnonzero(ids == self.line)
            n, base = np.diff(stop, prepend=-1) - 1, self.known
            flat = ids[ids != self.line]
            if self.used + len(flat) > len(self.flat):
                self.flat = np.concatenate([self.flat, np.zeros(self.used + len(flat), np.int32)])
            if base + len(new) > len(self.begin):
                more = np.zeros(base + len(new), np.int64)
                self.begin, self.count = np.concatenate([self.begin, more]), np.concatenate([self.count, more])
                self.word = np.concatenate([self.word, more.view(np.uint64)])
            self.flat[self.used:self.used + len(flat)] = flat
            self.begin[base:base + len(new)], self.count[base:base + len(new)] = self.used + np.cumsum(n) - n, n
            self.used += len(flat)
            slot[new] = np.arange(base, base + len(new))
            self.word[slot[new]], self.table[place[new]] = u[new], slot[new]
            self.known += len(new)
        return u, inverse, slot

    def expand(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(subword ids of the words in order, how many each has)."""
        n = self.count[slots]
        at = np.repeat(self.begin[slots] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return self.flat[at], n


_coders: dict[int, Subwords] = {}


def coder(ranks: dict[bytes, int]) -> Subwords:
    """This process's coder of a vocabulary: its memory outlives the task."""
    key = hash(frozenset(ranks.items()))
    if key not in _coders:
        _coders.clear()
        _coders[key] = Subwords(ranks)
    return _coders[key]


@dataclass
class AttentionModel:
    emb: np.ndarray  # (vocabulary, d)
    pos: np.ndarray  # (WINDOW, d)
    wq: np.ndarray
    wk: np.ndarray
    wv: np.ndarray
    out: np.ndarray  # (d, classes)
    bias: np.ndarray
    token_class: np.ndarray  # class of each token
    log_share: np.ndarray  # log of each token's share of its class

    def tables(self):
        """Projections of every token and position, computed once a task."""
        s = 1 / np.sqrt(self.emb.shape[1])
        f = lambda x: np.ascontiguousarray(x, np.float32)
        return ([f(np.concatenate([self.emb @ (self.wq * s), self.emb @ self.wk, self.emb @ self.wv, self.emb], 1)),
                 f(np.concatenate([self.pos @ (self.wq * s), self.pos @ self.wk, self.pos @ self.wv, self.pos], 1)),
                 f(self.out), f(self.bias)])

    def log_prob(self, inputs: np.ndarray, targets: np.ndarray, tables=None, batch: int = 128) -> np.ndarray:
        """Natural log probability of each target (windows, STRIDE), given the
        window's inputs (windows, WINDOW) up to its place."""
        tables = tables or self.tables()
        got, n = np.empty(targets.shape, np.float32), min(batch, len(inputs))
        space = [np.empty((n, *shape), np.float32) for shape in ((WINDOW, tables[0].shape[1]), (STRIDE, WINDOW), (STRIDE, self.emb.shape[1]), (STRIDE, CLASSES))]
        with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
            for s in range(0, len(inputs), batch):
                part = slice(s, s + batch)
                cls = self.token_class[targets[part]]
                room = [m[:len(cls)] for m in space]
                got[part] = self._class_log_prob(inputs[part], cls, tables, False, *room)
                if not np.isfinite(got[part]).all():  # an exponential left the range of floats
                    got[part] = self._class_log_prob(inputs[part], cls, tables, True, *room)
        return got + self.log_share[targets]

    def _class_log_prob(self, inputs: np.ndarray, cls: np.ndarray, tables, shifted: bool, x, a, y, z) -> np.ndarray:
        """Masked attention over one batch, in the room of x, a, y, z. All products and sums are those of one
        window, so equal windows get equal bits wherever they stand."""
        tok, pos, out, bias = tables
        d, skip = self.emb.shape[1], WINDOW - STRIDE
        tok.take(inputs, 0, out=x, mode="clip")
        x += pos
        np.matmul(x[:, skip:, :d], x[..., d:2 * d].transpose(0, 2, 1), out=a)
        total = _attend(a, _sees(np.float32), shifted)
        np.matmul(a, x[..., 2 * d:3 * d], out=y)
        y /= total
        y += x[:, skip:, 3 * d:]
        np.matmul(y, out, out=z)  # one product a window
        if shifted:
            z += bias
            z -= z.max(2, keepdims=True)
        hit = z[np.arange(len(z))[:, None], np.arange(STRIDE), cls]
        np.exp(z, out=z)
        if shifted:
            return hit - np.log(z.sum(2))
        return hit + bias[cls] - np.log(z @ np.exp(bias))  # the bias enters as a factor


def _sees(kind) -> np.ndarray:
    """1 where a place of a window sees an input, 0 where not."""
    return np.tri(STRIDE, WINDOW, WINDOW - STRIDE, dtype=kind)


def _attend(a: np.ndarray, sees: np.ndarray, shifted: bool) -> np.ndarray:
    """Turns a into its exponentials, 0 where not seen (those less the largest
    seen, if ``shifted``); their sums over the inputs."""
    if shifted:
        a += np.where(sees, 0, -np.inf).astype(a.dtype)
        a -= a.max(2, keepdims=True)
    np.exp(a, out=a)
    a *= sees
    return (a @ np.ones(WINDOW, a.dtype))[..., None]


def windows(ids: np.ndarray, n: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping windows of texts laid end to end (``n`` subwords each, 0
    allowed): (inputs, targets, scored, text of each window). A text's inputs
    are start marks (the end token; as many as a window overlaps the one before
    it, and one more) and its subwords; its targets are the subwords and the
    end. A window predicts its last STRIDE places; ``scored`` marks those that
    the text has, each target exactly once."""
    skip, m = WINDOW - STRIDE, n + 1
    count = -(-m // STRIDE)
    owner = np.repeat(np.arange(len(n)), count)
    nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    length = skip + count * STRIDE + 1
    first = np.cumsum(length) - length
    line = np.full(length.sum(), end, np.int32)
    line[np.arange(len(ids)) + np.repeat(first + skip + 1 - (np.cumsum(n) - n), n)] = ids
    z = np.lib.stride_tricks.sliding_window_view(line, WINDOW + 1)[first[owner] + nth * STRIDE] if len(n) else np.zeros((0, WINDOW + 1), np.int32)
    return z[:, :WINDOW], z[:, skip + 1:], np.arange(STRIDE) < (m[owner] - nth * STRIDE)[:, None], owner


def train(inputs: np.ndarray, targets: np.ndarray, scored: np.ndarray, counts: np.ndarray, seed: int = 2,
          epochs: int = 3, batch: int = 64, rate: float = 0.08) -> AttentionModel:
    """A model of the given windows alone; ``counts`` are the token counts of
    the whole learning corpus."""
    skip, v = WINDOW - STRIDE, len(counts)
    prev, nxt = inputs[:, skip:][scored], targets[scored]
    before = np.bincount(nxt * PROFILE + slots_of(v)[prev], minlength=v * PROFILE).reshape(v, PROFILE)
    cls, share = classes(before, counts)
    rng = np.random.default_rng(seed)
    p = first_weights(cls, counts, rng)
    seen = {k: np.full_like(x, 1e-4) for k, x in p.items()}
    descend(p, seen, cls, inputs, targets, scored, rng, epochs, batch, rate)
    return AttentionModel(*(p[k] for k in PARTS), cls, share)


PARTS = ("emb", "pos", "wq", "wk", "wv", "out", "bias")


def slots_of(v: int) -> np.ndarray:
    """Hash slot of each token in a profile."""
    return np.arange(v, dtype=np.int64) * 2654435761 % 4294967296 * PROFILE // 4294967296


def classes(before: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(class of each token, log of its smoothed share of the class)."""
    cls = cluster_tokens(before, counts)
    mass, size = np.bincount(cls, counts, CLASSES), np.bincount(cls, minlength=CLASSES)
    return cls, np.log((counts + 0.1) / (mass + 0.1 * size)[cls])


def first_weights(cls: np.ndarray, counts: np.ndarray, rng, after: np.ndarray | None = None) -> dict[str, np.ndarray]:
    """Random weights; with ``after``, embeddings of tokens that occur are the
    main directions of what follows them."""
    v, d = len(counts), DIMS
    size, mass = np.bincount(cls, minlength=CLASSES), np.bincount(cls, counts, CLASSES)
    p = {"emb": rng.normal(0, 0.1, (v, d)), "pos": rng.normal(0, 0.1, (WINDOW, d)),
         "wq": rng.normal(0, 0.3, (d, d)), "wk": rng.normal(0, 0.3, (d, d)), "wv": rng.normal(0, 0.3, (d, d)),
         "out": rng.normal(0, 0.1, (d, CLASSES)),
         "bias": np.where(size > 0, np.log((mass + 1) / (mass.sum() + CLASSES)), -1e4)}  # no mass for empty classes
    n = after.sum(1) if after is not None else np.zeros(v)
    has = np.flatnonzero(n)
    if len(has):
        usual = after.sum(0) / n.sum()
        t = np.sqrt((after[has] + 5 * usual) / (n[has, None] + 5)) - np.sqrt(usual)
        _, axes = np.linalg.eigh((t * n[has, None]).T @ t)
        e = t @ axes[:, -d:]
        p["emb"][has] = e * 0.1 / max(1e-9, np.sqrt((e * e).mean()))
    return p


def descend(p: dict, seen: dict, cls: np.ndarray, inputs: np.ndarray, targets: np.ndarray, scored: np.ndarray, rng,
            epochs: int, batch: int = 64, rate: float = 0.08, weight: np.ndarray | None = None) -> None:
    """Adagrad on the class loss of the windows, in place. A batch takes few
    numpy calls, in arrays kept for the next: the weights but the embeddings are
    one vector, queries, keys and values one product, and the bias is a factor."""
    skip, d, kind, most = WINDOW - STRIDE, DIMS, p["emb"].dtype, min(batch, len(inputs))
    if not most:
        return
    scored = scored.astype(kind) if weight is None else scored * weight[:, None].astype(kind)
    inputs, targets = inputs.astype(np.uint16 if len(p["emb"]) <= 1 << 16 else np.int32), cls[targets]
    space = [np.zeros((most, *shape), kind) for shape in
             ((WINDOW, 4 * d), (WINDOW, 3 * d), (STRIDE, WINDOW), (STRIDE, WINDOW), *[(STRIDE, d)] * 4, (STRIDE, CLASSES), (WINDOW, d))]
    sees, ones, flat = _sees(kind), np.ones(d, kind), lambda m: m.reshape(-1, m.shape[-1])
    row, new, pair = np.arange(most * STRIDE), np.ones(most * WINDOW, bool), np.result_type(kind, np.complex64)
    weights, met, slope = (np.zeros(sum(p[k].size for k in PARTS[1:]), kind) for _ in range(3))
    for to, parts in ((weights, p), (met, seen)):
        for k, m in _views(to).items():
            if k in parts:
                m[:] = parts[k]
    now, grad = _views(weights), _views(slope)
    size = np.repeat(np.array([1 / np.sqrt(d), 1, 1], kind), d)  # of queries, keys, values
    with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
        for _ in range(epochs):
            turn = rng.permutation(len(inputs))
            for s in range(0, len(turn), batch):
                pick = turn[s:s + batch]
                x, g, a, ds, att, h, dh, dt, z, dx = (m[:len(pick)] for m in space) if len(pick) < most else space
                # distinct tokens, the order that sorts them, each input's index among them
                x_in, y, w = inputs.take(pick, 0).ravel(), targets.take(pick, 0).ravel(), scored.take(pick, 0).ravel()
                w /= max(1, w.sum())
                order = x_in.argsort(kind="stable")
                line, lead = x_in.take(order), new[:len(x_in)]
                np.not_equal(line[1:], line[:-1], out=lead[1:])
                back = np.empty(len(line), np.intp)
                back[order] = np.cumsum(lead)
                back -= 1
                first = np.flatnonzero(lead)
                ids = line.take(first)
                e, w3 = p["emb"].take(ids, 0), now["qkv"] * size
                own = (flat(z)[:len(y)], row[:len(y)], y)
                for shifted in (False, True):
                    np.concatenate([e @ w3, e], 1).take(back, 0, out=flat(x), mode="clip")
                    x += np.concatenate([now["pos"] @ w3, now["pos"]], 1)
                    q, k, u = x[:, skip:, :d], x[..., d:2 * d], x[..., 2 * d:3 * d]
                    np.matmul(q, k.transpose(0, 2, 1), out=a)
                    total = _attend(a, sees, shifted)
                    np.matmul(a, u, out=att)
                    att /= total
                    np.add(att, x[:, skip:, 3 * d:], out=h)
                    np.matmul(flat(h), now["out"], out=flat(z))
                    if shifted:
                        z += now["bias"]
                        z -= z.max(2, keepdims=True)
                    by = np.exp(now["bias"] * (not shifted))
                    np.exp(z, out=z)
                    mass = flat(z) @ by
                    own[0][own[1:]] -= mass / by.take(y)  # z times by and f: the loss's slope
                    f = w / mass
                    np.matmul(f, flat(z), out=grad["bias"])
                    if total.min() > 1e-20 and f.max() < 1e20 and np.isfinite(grad["bias"]).all():
                        break  # else an exponential left the range of floats
                np.matmul(flat(z), by[:, None] * now["out"].T, out=flat(dh))
                dh *= f.reshape(-1, STRIDE, 1)
                np.divide(dh, total, out=dt)
                h *= f.reshape(-1, STRIDE, 1)
                np.matmul(flat(h).T, flat(z), out=grad["out"])
                slope[-CLASSES * (d + 1):].reshape(-1, CLASSES)[:] *= by  # out and bias
                np.matmul(dt, u.transpose(0, 2, 1), out=ds)
                att *= dt
                ds -= (att @ ones)[..., None]
                ds *= a
                np.matmul(ds, k, out=g[:, skip:, :d])
                np.matmul(ds.transpose(0, 2, 1), q, out=g[..., d:2 * d])
                np.matmul(a.transpose(0, 2, 1), dt, out=g[..., 2 * d:])
                np.matmul(flat(x)[:, 3 * d:].T, flat(g), out=grad["qkv"])
                grad["qkv"] *= size
                np.matmul(flat(g), w3.T, out=flat(dx))
                dx[:, skip:] += dh
                dx.sum(0, out=grad["pos"])
                met += slope * slope
                weights -= rate * slope / np.sqrt(met)
                # two numbers as one complex number: half as many sums
                e1 = np.add.reduceat(flat(dx).take(order, 0).view(pair), first, 0).view(kind)
                s1 = seen["emb"].take(ids, 0) + e1 * e1
                seen["emb"][ids] = s1
                p["emb"][ids] = e - rate * e1 / np.sqrt(s1)
    for to, parts in ((weights, p), (met, seen)):
        for k, m in _views(to).items():
            if k in parts:
                parts[k][:] = m


def _views(dense: np.ndarray) -> dict[str, np.ndarray]:
    """The weights but the embeddings, as parts of one vector."""
    d, at = DIMS, np.cumsum([0, WINDOW * DIMS, 3 * DIMS * DIMS, DIMS * CLASSES, CLASSES])
    pos, qkv, out, bias = (dense[a:b] for a, b in zip(at, at[1:]))
    qkv = qkv.reshape(d, 3 * d)
    return {"pos": pos.reshape(WINDOW, d), "qkv": qkv, "wq": qkv[:, :d], "wk": qkv[:, d:2 * d], "wv": qkv[:, 2 * d:],
            "out": out.reshape(d, CLASSES), "bias": bias}


def cluster_tokens(before: np.ndarray, counts: np.ndarray, rounds: int = 10) -> np.ndarray:
    """CLASSES clusters of tokens by what precedes them (hashed profiles,
    k-means on square roots); tokens seen fewer than 5 times are dealt by id."""
    cls = np.arange(len(counts)) % CLASSES
    often = np.flatnonzero(before.sum(1) >= 5)
    if len(often) > CLASSES:
        t = before[often].astype(float)
        t = np.sqrt(t / t.sum(1, keepdims=True))
        c = t[np.argsort(-counts[often], kind="stable")[:CLASSES]].copy()
        for _ in range(rounds):
            near = ((c * c).sum(1) / 2 - t @ c.T).argmin(1)
            for j in np.unique(near):
                c[j] = t[near == j].mean(0)
        cls[often] = near
    return cls


def _rows_to_windows(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(inputs, targets, scored, weight) of stored windows, in a fixed order."""
    rows = rows.sort_by("line").combine_chunks()
    line = pa.concat_arrays(rows.column("line").cast(pa.binary()).chunks) if rows.num_rows else pa.array([], pa.binary())
    first, last = (np.frombuffer(line.buffers()[1], np.int32)[[line.offset, line.offset + len(line)]] if len(line) else (0, 0))
    kind = np.uint16 if last - first == len(line) * 2 * (WINDOW + 2) else np.int32
    z = np.frombuffer(line.buffers()[2], np.uint8)[first:last].view(kind).reshape(-1, WINDOW + 2) if len(line) else np.zeros((0, WINDOW + 2), kind)
    skip = WINDOW - STRIDE
    return z[:, :WINDOW], z[:, skip + 1:WINDOW + 1], np.arange(STRIDE) < z[:, -1:], rows.column("n").to_numpy().astype(float)


_STEP = [f"d{j}" for j in range(DIMS)]


def _dense(p: dict) -> np.ndarray:
    """All weights but the embeddings, in rows of DIMS."""
    return np.concatenate([p[k].ravel() for k in PARTS[1:]]).reshape(-1, DIMS)


def _shard(held, seed: int):
    """One shard goes on from the held weights: a row for each token met and
    each row of the others (from -1 down), its change times its weight."""
    def run(rows: pa.Table) -> pa.Table:
        p0, seen0, cls = held.value
        x, y, w, n = _rows_to_windows(rows)
        hits = np.bincount(x.ravel(), minlength=len(p0["emb"]))
        met = np.flatnonzero(hits)
        # the shard's own tokens alone, numbered anew
        p, seen = ({k: v[met] if k == "emb" else v.copy() for k, v in z.items()} for z in (p0, seen0))
        descend(p, seen, cls, (np.cumsum(hits > 0) - 1)[x], y, w, np.random.default_rng(seed), 1, weight=n)
        dense = _dense(p) - _dense(p0)
        step = np.concatenate([(p["emb"] - p0["emb"][met]) * hits[met, None], dense]).astype(np.float64)
        return pa.table([pa.array(np.concatenate([met, -1 - np.arange(len(dense))]).astype(np.int32)),
                         pa.array(np.concatenate([hits[met], np.ones(len(dense))]).astype(np.float64)), *map(pa.array, np.ascontiguousarray(step.T))],
                        names=["row", "hits", *_STEP])
    return run


def fit(drawn: DataFrame, counts: np.ndarray, before: np.ndarray, after: np.ndarray, train_windows: int, seed: int = 2) -> AttentionModel:
    """The model of the drawn windows (``line``, ``n``), each met by one shard."""
    spark = drawn.sparkSession
    cls, share = classes(before, counts)
    rng = np.random.default_rng(seed)
    p = first_weights(cls, counts, rng, after)
    seen = {k: np.full_like(x, 1e-4) for k, x in p.items()}
    shards = -(-drawn.count() // train_windows) if train_windows else 0
    if shards:
        drawn = drawn.withColumn("shard", F.pmod(F.xxhash64("line", F.lit(seed)), F.lit(shards)).cast("int"))
        x, y, w, n = _rows_to_windows(drawn.filter("shard = 0").select("line", "n").toArrow())
        descend(p, seen, cls, x, y, w, rng, 3, weight=n)
    if shards > 1:
        p, seen = ({k: x.astype(np.float32) for k, x in z.items()} for z in (p, seen))
        held = spark.sparkContext.broadcast((p, seen, cls))
        steps = drawn.filter("shard > 0").groupBy("shard").applyInArrow(_shard(held, seed), "row int, hits double, " + ", ".join(f"{c} double" for c in _STEP))
        # one row a token and a few of the other weights, whatever the input
        mean = steps.groupBy("row").agg(*[(F.sum(c) / F.sum("hits")).alias(c) for c in _STEP]).toArrow()
        row, d = mean.column("row").to_numpy(), np.stack([mean.column(c).to_numpy() for c in _STEP], 1)
        emb, dense = p["emb"].astype(np.float64), _dense(p).astype(np.float64)
        emb[row[row >= 0]] += d[row >= 0]
        dense[-1 - row[row < 0]] += d[row < 0]
        at = np.cumsum([p[k].size for k in PARTS[1:]])[:-1]
        p = {"emb": emb} | {k: z.reshape(p[k].shape) for k, z in zip(PARTS[1:], np.split(dense.ravel(), at))}
    return AttentionModel(*(p[k] for k in PARTS), cls, share)


def drawn_windows(ids: np.ndarray, n: np.ndarray, end: int, key: np.ndarray, share: float) -> np.ndarray:
    """The windows of the texts (as ``windows`` cuts them) whose hash, of the
    text's ``key`` and the window's place, falls under ``share``: WINDOW inputs,
    the last target and how many targets are scored, a row each."""
    count = -(-(n + 1) // STRIDE)
    owner = np.repeat(np.arange(len(n)), count)
    nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    h = mix(key.view(np.uint64)[owner] ^ mix(nth.astype(np.uint64) + np.uint64(1)))
    pick = np.flatnonzero(h >> np.uint64(34) < np.uint64(round(share * (1 << 30))))
    owner, at = owner[pick], nth[pick] * STRIDE
    place = at[:, None] + np.arange(WINDOW + 1) - (WINDOW - STRIDE + 1)
    has = (place >= 0) & (place < n[owner][:, None])
    text = np.append(ids, end)[np.where(has, (np.cumsum(n) - n)[owner][:, None] + place, len(ids))]
    return np.concatenate([text, np.minimum(STRIDE, n[owner] + 1 - at)[:, None]], 1).astype(np.uint16 if end < 1 << 16 else np.int32)


def _count(held, share: float):
    """Rows (h, n): tokens by word hash; (token, n): how often a token stands
    after each slot of tokens, then before each, as token x PROFILE + slot; and
    (line, n): drawn windows."""
    names = ["h", "n", "token", "line"]

    def counted(words):
        u, _, inverse = grouped(np.concatenate([w for w, _ in words]))
        n = np.bincount(inverse, np.concatenate([n for _, n in words]), len(u)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(n), pa.nulls(len(u), pa.int32()), pa.nulls(len(u), pa.binary())], names=names)

    def run(batches):
        sub = coder(held.value)
        slot_of, cells = slots_of(sub.size), sub.size * PROFILE
        total, words, held_words = np.zeros(2 * cells, np.int64), [], 0
        for b in batches:
            key = b.column("s").to_numpy()
            for first, part in text_blocks(b.column("t").to_pylist(), _BLOCK):
                raw, start, end, h, owner = word_spans(part)
                u, inverse, slot = sub.slots(raw, start, end, h) if len(h) else (h, np.zeros(0, np.int64), np.zeros(0, np.int64))
                ids, per_word = sub.expand(slot[inverse])
                size = np.bincount(owner, per_word, len(part)).astype(np.int64)
                # a text's end token is the start mark of the next
                line = np.insert(ids.astype(np.int64), np.append(0, np.cumsum(size)), sub.end)
                prev, nxt = line[:-1], line[1:]
                np.add.at(total, nxt * PROFILE + slot_of[prev], 1)
                np.add.at(total, cells + prev * PROFILE + slot_of[nxt], 1)
                got = drawn_windows(ids, size, sub.end, key[first:first + len(part)], share)
                k, wide = len(got), got.itemsize * (WINDOW + 2)
                data = pa.Array.from_buffers(pa.binary(), k, [None, pa.py_buffer(np.arange(0, (k + 1) * wide, wide, dtype=np.int32)), pa.py_buffer(got.tobytes())])
                yield pa.RecordBatch.from_arrays([pa.nulls(k, pa.int64()), pa.array(np.ones(k, np.int64)), pa.nulls(k, pa.int32()), data], names=names)
                words.append((u, np.bincount(inverse, minlength=len(u))))
                held_words += len(u)
                if held_words > _BLOCK:
                    yield counted(words)
                    words, held_words = [], 0
        if words:
            yield counted(words)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.nulls(len(hit), pa.int64()), pa.array(total[hit]), pa.array(hit.astype(np.int32)), pa.nulls(len(hit), pa.binary())], names=names)
    return run


def _score(held, heavy, shape: tuple[float, float, int]):
    """One row per text; words that are not heavy are listed with the row."""
    tokens, distinct, end_count = shape

    def run(batches):
        ranks, model = held.value
        word, count = heavy.value
        sub, tables = coder(ranks), model.tables()
        base = np.log10(tokens + 0.5 * (distinct + 1))
        row = TaskContext.get().partitionId() << 33
        for b in batches:
            for first, part in text_blocks(b.column("t").to_pylist(), _BLOCK):
                k = len(part)
                raw, start, end, h, owner = word_spans(part)
                n_words = np.bincount(owner, minlength=k)
                u, inverse, slot = sub.slots(raw, start, end, h)
                at = np.minimum(np.searchsorted(word, u), max(0, len(word) - 1))
                known = (word[at] == u) if len(word) else np.zeros(len(u), bool)
                c = np.where(known, count[at], 0) if len(word) else np.zeros(len(u), np.int64)
                common = known[inverse]
                score = np.bincount(owner[common], np.log10(c[inverse[common]] + 0.5) - base, k) + np.log10(end_count + 0.5) - base
                n_known = np.bincount(owner[common], minlength=k) + (end_count > 0)
                # distinct rare words of each text
                pair, tf = np.unique(owner[~common] * max(1, len(u)) + inverse[~common], return_counts=True)
                who, what = pair // max(1, len(u)), u[pair % max(1, len(u))] if len(u) else np.zeros(0, np.uint64)
                cut = pa.array(np.concatenate([[0], np.cumsum(np.bincount(who, minlength=k))]).astype(np.int32))
                ids, per_word = sub.expand(slot[inverse])
                subs = np.bincount(owner, per_word, k).astype(np.int64)
                lm = np.zeros(k)
                x, y, w, text = windows(ids, subs, sub.end)
                for s in range(0, len(x), 8192):
                    part_w = w[s:s + 8192]
                    logs = model.log_prob(x[s:s + 8192], y[s:s + 8192], tables)
                    lm += np.bincount(text[s:s + 8192], np.where(part_w, logs, 0).sum(1, dtype=np.float64), k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + k)), b.column("doc_id").slice(first, k), b.column("held_out").slice(first, k),
                     pa.array(n_words + 1), pa.array(n_known), pa.array(score), pa.array(lm / np.log(10)),
                     pa.ListArray.from_arrays(cut, pa.array(what.view(np.int64))), pa.ListArray.from_arrays(cut, pa.array(tf))],
                    names=["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "h", "tf"])
                row += k
    return run


def score_texts(docs: DataFrame, held_out: Column, vocabulary: str, doc_id: str = "doc_id", text: str = "text",
                train_windows: int = 16_000, seed: int = 2, train_share: float = 1.0) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of
    every row; learns from rows that are not ``held_out``. ``vocabulary`` is a file
    of ranks that the driver reads."""
    spark = docs.sparkSession
    small_batches(spark)
    ranks = read_ranks(vocabulary)
    ranks_held = spark.sparkContext.broadcast(ranks)
    id_type = docs.schema[doc_id].dataType.simpleString()
    src = docs.select(F.col(doc_id).alias("doc_id"), held_out.alias("held_out"), F.coalesce(text, F.lit("")).alias("t"))
    learn = src.filter("not held_out").select("t")

    share = train_share if train_windows else 0.0
    raw = learn.withColumn("s", F.xxhash64("t", F.lit(seed))).mapInArrow(_count(ranks_held, share), "h long, n long, token int, line binary") \
        .groupBy("h", "token", "line").agg(F.sum("n").alias("n"))
    counts = written(raw, "lm-counts")
    words = counts.filter("h is not null").select("h", "n")
    size = max(ranks.values()) + 2
    cells = counts.filter("token is not null").select("token", "n").toArrow()  # at most 2 x PROFILE per vocabulary entry
    total = np.zeros(2 * size * PROFILE)
    total[cells.column("token").to_numpy()] = cells.column("n").to_numpy()
    before, after = total.reshape(2, size, PROFILE)
    per_token = before.sum(1)
    ends = int(per_token[-1])
    n, v = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    n, v = n + ends, v + (ends > 0)

    heavy = words.filter(F.col("n") * HEAVY >= n).toArrow()  # at most HEAVY rows
    word, count = heavy.column("h").to_numpy().view(np.uint64), heavy.column("n").to_numpy()
    order = np.argsort(word)
    heavy_held = spark.sparkContext.broadcast((word[order], count[order]))

    model = fit(counts.filter("line is not null").select("line", "n"), per_token, before, after, train_windows, seed)
    held = spark.sparkContext.broadcast((ranks, model))

    rows = src.mapInArrow(_score(held, heavy_held, (float(n), float(v), ends)),
                          f"row long, doc_id {id_type}, held_out boolean, n_tokens long, n_known long, base double, score double, "
                          "h array<long>, tf array<long>")
    rows = written(rows, "lm-rows")
    # the rarer words' counts, by a join on the word; no such word has more than N / HEAVY tokens
    rare = rows.select("row", F.explode(F.arrays_zip("h", "tf")).alias("p")).select("row", F.col("p.h").alias("h"), F.col("p.tf").alias("tf"))
    few = words.filter(F.col("n") * HEAVY < n)
    logs = F.col("tf") * (F.log10(F.coalesce("n", F.lit(0)) + 0.5) - F.log10(F.lit(n + 0.5 * (v + 1))))
    rest = rare.join(few, "h", "left").groupBy("row").agg(F.sum(logs).alias("more"), F.sum(F.when(F.col("n") > 0, F.col("tf")).otherwise(0)).alias("k"))
    out = rows.select("row", "doc_id", "held_out", "n_tokens", "n_known", "base", "score").join(rest, "row", "left")
    return out.select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("k", F.lit(0))).cast("long").alias("n_known"),
                      F.lit(int(n)).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"), "score")
