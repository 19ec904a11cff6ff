"""Word shingles of many texts at once, on bytes (numpy, used inside tasks).

Texts become UTF-8 bytes; A-Z are lower-cased; words are runs of bytes other
than ASCII white space. A word's hash is a polynomial over its bytes modulo
2^64, mixed; a shingle's hash mixes the hashes of its words in order. Equal
word sequences always have equal hashes; different ones collide with a
probability near 2^-64, which is the join's only inexactness.
"""

from __future__ import annotations

import numpy as np

_TO_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_powers: dict[str, np.ndarray] = {}


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _powers.get("up")
    if have is None or len(have) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        one = np.ones(size, np.uint64)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            step = one.copy()
            step[1:] = np.uint64(base)
            _powers[name] = np.cumprod(step, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser on 64-bit words (splitmix)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_spans(texts: list[str | None]):
    """(bytes, starts, ends, hash of each word, index of the text it is in),
    in text order, on the lower-cased texts laid end to end."""
    parts = [t.encode("utf-8", "surrogatepass").translate(_TO_LOWER) if t else b"" for t in texts]
    raw = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
    gap = _SPACE[raw]
    word = ~gap
    start = np.flatnonzero(word & np.concatenate([[True], gap[:-1]]))
    end = np.flatnonzero(word & np.concatenate([gap[1:], [True]])) + 1
    if not len(start):
        return raw, start, end, np.zeros(0, np.uint64), np.zeros(0, np.int64)
    up, down = _power_table(len(raw) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:len(raw)], dtype=np.uint64)])
    h = mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    ends = np.cumsum([len(p) + 1 for p in parts])
    return raw, start, end, h, np.searchsorted(ends, start, side="right")


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, index of the text it is in), in text order."""
    return word_spans(texts)[3:]


def order_within(owner: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Order by (owner, key): one sort of owner and the key's leading 44 bits
    as one integer; the full sort only where two keys agree in those."""
    if not len(key) or int(owner.max()) >= 1 << 20:
        return np.lexsort((key, owner))
    packed = (owner.astype(np.uint64) << np.uint64(44)) | (key >> np.uint64(20))
    order = np.argsort(packed)
    p, k = packed[order], key[order]
    if ((p[1:] == p[:-1]) & (k[1:] != k[:-1])).any():
        return np.lexsort((key, owner))
    return order


def grouped(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct values, sorted; the place of one of each; value -> its index
    among the distinct ones), by one sort."""
    order = np.argsort(x)
    s = x[order]
    lead = np.concatenate([[True], s[1:] != s[:-1]])[:len(s)]
    inverse = np.empty(len(x), np.int64)
    inverse[order] = np.cumsum(lead) - 1
    return s[lead], order[lead], inverse


def shingle_sets(texts: list[str | None], words: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text: (hashes, text index), sorted by
    text, then hash. A text of fewer words is one shingle; one without words
    has none."""
    h, owner = word_hashes(texts)
    n = np.bincount(owner, minlength=len(texts))
    first = np.cumsum(n) - n
    at = np.flatnonzero(np.arange(len(h)) - first[owner] + words <= n[owner]) if len(h) else np.zeros(0, np.int64)
    s = np.full(len(at), 0x2545F4914F6CDD1D, np.uint64)
    for i in range(words):
        s = mix(s * np.uint64(_BASE) + h[at + i])
    short = np.flatnonzero((n > 0) & (n < words))
    v = np.zeros(len(short), np.uint64)
    for i in range(words - 1):
        has = n[short] > i
        v = np.where(has, mix(v * np.uint64(_BASE) + h[np.minimum(first[short] + i, max(0, len(h) - 1))]), v) if len(h) else v
    who = np.concatenate([owner[at], short])
    s = np.concatenate([s, v ^ mix(n[short].astype(np.uint64))])
    order = order_within(who, s)
    s, who = s[order], who[order]
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] != s[:-1]) | (who[1:] != who[:-1])
    return s[keep], who[keep]
