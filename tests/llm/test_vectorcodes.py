import hashlib
import math
import random

import numpy as np
import pyarrow as pa
import pytest

from clientlens.llm.vectorcodes import fit_codebooks, integer_block, limbs, nearest_entries, sequency_hadamard, vector_codes

SCHEMA = "vec_id long, embedding array<double>, label string, id string, V int, code string"


def plain(rows, parts=16, entries=64, rounds=2):
    """The contract in Python integers: {vec_id: (code, error)}, codebooks."""
    kept = [(i, [math.floor(256 * x) if abs(x) < 2 ** 40 else int(x) * 256 for x in v], l) for i, v, l in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    w = len(kept[0][1]) // parts
    kept.sort(key=lambda r: r[0])
    cut = lambda v, p: v[p * w:(p + 1) * w]
    books = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]

    def nearest(v, p):
        return min((sum((a - b) ** 2 for a, b in zip(cut(v, p), e)), j) for j, e in enumerate(books[p]))
    for _ in range(rounds):
        new = []
        for p in range(parts):
            groups = {}
            for _, v, _ in kept:
                groups.setdefault(nearest(v, p)[1], []).append(cut(v, p))
            new.append([[sum(c) // len(groups[j]) for c in zip(*groups[j])] if j in groups else e for j, e in enumerate(books[p])])
        books = new
    out = {}
    for i, v, l in kept:
        hits = [nearest(v, p) for p in range(parts)]
        out[i] = ("".join(f"{j:02x}" for _, j in hits), sum(d for d, _ in hits), l)
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return out, digest


def long(e):
    return e if e < 2 ** 63 else None


def check(spark, rows, **options):
    df = spark.createDataFrame([(i, v, l, "x", 1, "y") for i, v, l in rows], SCHEMA).repartition(3)
    got = vector_codes(df, **options).collect()
    want, digest = plain(rows, **options)
    by_label = {}
    for _, e, l in want.values():
        by_label[l] = by_label.get(l, 0) + e
    assert {r.id: (r.code, r.error, r.label) for r in got} == {i: (c, long(e), l) for i, (c, e, l) in want.items()} and len(got) == len(want)
    assert all(r.codebooks_sha256 == digest for r in got)
    if all(e < 2 ** 63 for _, e, _ in want.values()):
        assert all(r.label_error == long(by_label[r.label]) for r in got)


def test_equals_plain_integers(spark):
    r = random.Random(5)
    rows = [(i, [r.gauss(0, 0.3) for _ in range(48)], r.choice(["a", "b", None])) for i in range(150)]
    rows += [(1000 + i, rows[3][1], "copy") for i in range(80)]                     # a third equal: ties
    rows += [(2000, None, "a"), (2001, [None] * 48, "a"), (2002, [float("nan")] * 48, "b"), (2003, [float("inf")] + [0.0] * 47, "b")]
    check(spark, rows, entries=20)


def test_components_past_64_bits(spark):
    r = random.Random(6)
    rows = [(i, [r.choice([-1, 1]) * r.random() * 10.0 ** r.choice([0, 3, 6]) for _ in range(64)], "a") for i in range(40)]
    check(spark, rows, entries=8)
    huge = [(i, [(-1) ** i * 1e30 * (1 + i % 3)] * 16, "a") for i in range(12)]
    df = spark.createDataFrame([(i, v, l, "x", 1, "y") for i, v, l in huge], SCHEMA)
    want, digest = plain(huge, entries=4)
    got = vector_codes(df, entries=4).collect()
    assert {g.id: g.code for g in got} == {i: w[0] for i, w in want.items()} and got[0].codebooks_sha256 == digest
    assert {g.id: g.error for g in got} == {i: long(w[1]) for i, w in want.items()}


def test_empty_and_few(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert vector_codes(empty).collect() == [] and fit_codebooks(empty) is None
    assert vector_codes(spark.createDataFrame([(1, None, "a", "x", 1, "y")], SCHEMA)).collect() == []
    rows = [(7, [0.5] * 32, None), (9, [-0.25] * 32, None)]
    check(spark, rows)
    odd = vector_codes(spark.createDataFrame([(None, [1.0] * 5, "a", "", 1, ""), (4, [], None, "", 1, "")], SCHEMA)).collect()
    assert sorted(((r.id, r.error) for r in odd), key=str) == [(4, 0), (None, 0)]


@pytest.mark.parametrize("width", [1, 3, 4, 7])
def test_nearest_entries_and_ties(width):
    r = np.random.default_rng(width)
    x, books = r.integers(-9, 9, (50, 4, width)), r.integers(-9, 9, (4, 30, width))
    d = ((x[:, :, None, :] - books[None]) ** 2).sum(-1)
    for kind in (np.int64, object):
        code, error = nearest_entries(x.astype(kind), books.astype(kind))
        assert (code == d.argmin(2)).all() and (error == d.min(2)).all()


def test_parts_of_the_method():
    h = sequency_hadamard(8)
    assert ((h @ h.T) == 8 * np.eye(8)).all()
    assert [(row[1:] != row[:-1]).sum() for row in h] == list(range(8))
    for v in (0, -1, 5, -(1 << 70) - 3, (1 << 200) + 7, (1 << 63) - 1, -(1 << 63)):
        got = list(limbs(v))
        assert sum(x << (48 * i) for i, x in got) == v and all(-(1 << 63) <= x < 1 << 63 for _, x in got)
    assert integer_block(pa.array([[0.0039, -0.0039, -1.0]]), 256, 4).tolist() == [[0, -1, -256, 0]]
