"""The pipeline against brute force: each stage on its predecessor's rows."""

import os
import shutil
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"
sys.path.insert(0, REPO)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import corpus_pipeline as P  # noqa: E402
from test_decontam import brute as hits  # noqa: E402
from test_jaccard import brute as groups, shingles  # noqa: E402
from test_mixing import shares  # noqa: E402


@pytest.fixture(scope="module")
def steps(spark):
    spark.sparkContext.environment["PYTHONPATH"] = REPO
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in P.STAGES:
        out.append(P.written(stage(spark, out[-1], SF), f"test-{name}"))
    return out


def test_columns(steps):
    for df in steps[1:5]:
        assert df.columns == steps[0].columns
    assert steps[5].columns == steps[0].columns + ["mix_size", "mix_source_size", "mix_target", "mix_copies"]


def test_quality_keeps_what_is_labelled_good(spark, steps):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in steps[1].collect()}
    wrong = [i for i, q in labels.items() if bool(q) != (i in kept)]
    assert len(wrong) <= 0.03 * len(labels)


def test_language_keeps_texts_with_words(steps):
    before, after = (df.count() for df in steps[1:3])
    assert after >= 0.98 * before


def test_one_of_each_group_stays(steps):
    before, after = ([(r.doc_id, r.text) for r in df.collect()] for df in steps[2:4])
    assert {d for d, _ in after} == {c for _, n, c in groups(before)}


def test_contaminated_rows_go(spark, steps):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before = [(r.doc_id, r.text) for r in steps[3].collect()]
    bad = {i for i, n, h, _ in hits(before, items) if h and 20 * h >= n}
    assert bad and {r.doc_id for r in steps[4].collect()} == {i for i, _ in before} - bad


def test_mix(steps):
    sizes, taken = {}, {}
    for r in steps[4].collect():
        sizes[r.source] = sizes.get(r.source, 0) + len(r.text.split())
    for r in steps[5].collect():
        assert 1 <= r.mix_copies <= 2
        taken[r.source] = taken.get(r.source, 0) + r.mix_copies * r.mix_size
    largest = max(len(r.text.split()) for r in steps[4].collect())
    for s, t in shares(sizes).items():
        assert abs(taken.get(s, 0) - t) <= largest


def test_run_equals_the_stages(spark, steps):
    key = lambda df: sorted((r.doc_id, r.mix_copies) for r in df.collect())
    assert key(P.run(spark, SF)) == key(steps[5])


def test_empty_table(spark, tmp_dir, documents):
    documents([]).write.parquet(f"{tmp_dir}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_dir}/benchmark.parquet")
    assert P.run(spark, tmp_dir).count() == 0


def test_odd_rows(spark, tmp_dir, documents):
    rows = [(1, None), (2, ""), (None, "A plain sentence of several common words stands here."), (4, "1 2 3"), (5, "word " * 100_000),
            (6, "A plain sentence of several common words stands here."), (6, "A plain sentence of several common words stands here.")]
    documents(rows).write.parquet(f"{tmp_dir}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_dir}/benchmark.parquet")
    kept = [r.doc_id for r in P.run(spark, tmp_dir).collect()]
    assert set(kept) <= {6, 5} and kept.count(6) <= 1


def test_entry_works_without_the_subpackage(tmp_path):
    """As after the deletion of both folders and the pipeline."""
    rest = tmp_path / "rest"
    shutil.copytree(REPO, rest, ignore=shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__"))
    code = ("import __spark_entry__ as e\n"
            "assert e.__file__.startswith(%r)\n"
            "assert 'rfm_scores' in e.queries() and set(e.queries()) == set(e._QUERIES) | set(e._JOBS) == set(e.oracle_sql())\n" % str(rest))
    subprocess.run([sys.executable, "-c", code], check=True, cwd=rest, timeout=120, env=os.environ | {"PYTHONPATH": str(rest)})


def test_shingles_of_kept_rows(steps):
    assert all(shingles(r.text) for r in steps[3].collect())
