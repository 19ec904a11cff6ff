import re

import pytest
from pyspark.sql import functions as F

from clientlens.llm.mixing import mix_to_targets


def shares(sizes, weights=(3, 1, 2), ratio=1.5, cap=2.0):
    """Targets by repeated resharing, as the contract words it."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), ratio * sum(sizes.values())
    while open_:
        total = sum(w[s] for s in open_)
        over = [s for s in open_ if left * w[s] / total > cap * sizes[s]]
        if not over:
            return target | {s: left * w[s] / total for s in open_}
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
            open_.discard(s)
    return target


def rows_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, mix_size string, SOURCE2 string")


def test_targets_and_taken(spark):
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 40)), f"s{i % 5}" if i % 11 else None, "x", "y") for i in range(600)]
    rows += [(i, "w " * 9, "tiny", "x", "y") for i in range(600, 603)] + [(700, None, "empty", None, None), (701, "", "s1", None, None)]
    got = mix_to_targets(rows_of(spark, rows)).collect()
    assert len(got) == len(rows)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for r in rows:
        sizes[r[2]] = sizes.get(r[2], 0) + size(r[1])
    want, taken = shares(sizes), {}
    for r in got:
        assert r.mix_size == size(r.text) and r.mix_source_size == sizes[r.source] and 0 <= r.mix_copies <= 2
        assert r.mix_target == pytest.approx(want[r.source])
        taken[r.source] = taken.get(r.source, 0) + r.mix_size * r.mix_copies
    for s, t in want.items():
        assert abs(taken[s] - t) <= 40  # a document's size


def test_same_again_whatever_the_partitions(spark):
    df = spark.createDataFrame([(i, f"a b {i}" * (i % 9), f"s{i % 3}") for i in range(400)], "doc_id long, text string, source string")
    a, b = ({(r.doc_id, r.mix_copies) for r in mix_to_targets(d).collect()} for d in (df, df.orderBy(F.desc("doc_id")).repartition(7)))
    assert a == b


def test_refinement_goes_on_until_one_hash_is_left(spark, monkeypatch):
    import clientlens.llm.mixing as m
    df = spark.createDataFrame([(i, "a " * (1 + i % 5), "s") for i in range(300)]
                               + [(i, "b " * 3, "t") for i in range(300, 500)], "doc_id long, text string, source string")
    want = {(r.doc_id, r.mix_copies) for r in mix_to_targets(df).collect()}
    monkeypatch.setattr(m, "STEP", 2)
    assert {(r.doc_id, r.mix_copies) for r in mix_to_targets(df).collect()} == want


def test_empty_and_wordless_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mix_to_targets(empty).collect() == []
    none = spark.createDataFrame([(1, None, None), (None, "", "s")], "doc_id long, text string, source string")
    assert [(r.mix_target, r.mix_size * r.mix_copies) for r in mix_to_targets(none).collect()] == [(0.0, 0), (0.0, 0)]


def test_repeated_rows_go_together(spark):
    df = spark.createDataFrame([(1, "a b c", "s")] * 4 + [(2, "a b", "s")] * 2, "doc_id long, text string, source string")
    got = mix_to_targets(df).collect()
    assert len(got) == 6 and len({(r.doc_id, r.mix_copies) for r in got}) == 2


def test_columns_of_any_name_stay(spark):
    extra = ["q", "below", "rest", "h", "prefix", "left", "e_source", "mix_source", "mix_hash", "__mix_hash", "__p_q", "size", "target", "place", "at"]
    schema = "doc_id long, text string, source string, " + ", ".join(f"`{c}` string" for c in extra)
    df = spark.createDataFrame([(i, "a " * (i % 7), f"s{i % 4}", *extra) for i in range(50)], schema)
    got = mix_to_targets(df)
    assert got.columns == [*df.columns, "mix_size", "mix_source_size", "mix_target", "mix_copies"]
    assert all(tuple(r)[3:3 + len(extra)] == tuple(extra) for r in got.collect()) and got.count() == 50


def test_targets_of_many_sources_over_many_ranges(spark):
    from clientlens.llm.mixing import source_targets
    sizes = {f"s{i:04d}": (i * 37) % 101 for i in range(700)} | {None: 55, "": 9, "é": 70}
    df = spark.createDataFrame(list(sizes.items()), "source string, size long").repartition(5)
    want = shares(sizes)
    got = {r.source: r.target for r in source_targets(df).collect()}
    assert got.keys() == want.keys() and all(got[s] == pytest.approx(t) for s, t in want.items())
    plan = source_targets(df)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    assert source_targets(df.limit(0)).collect() == []
    assert [tuple(r) for r in source_targets(spark.createDataFrame([("a", 0)], "source string, size long")).collect()] == [("a", 0, 0.0)]
