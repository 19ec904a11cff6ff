"""Every registered query with SQL equals it; the others have the contract's
columns and one row per row (or query) of their table."""

import os
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, REPO)
sys.path.insert(0, os.path.join(REPO, "scripts"))

from clientlens.llm.queries import ORACLE_SQL, QUERIES  # noqa: E402
from oracle_check import rows_key  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    res = duck.execute(ORACLE_SQL[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    want = [tuple(r[cols.index(c)] for c in df.columns) for r in res.fetchall()]
    assert rows_key([tuple(r) for r in df.collect()]) == rows_key(want)


@pytest.mark.parametrize("name, table, columns", [
    ("op1_language_id", "documents", {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"}),
    ("op2_toxicity", "documents", {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}),
    ("op4_url_rules", "pages", {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"}),
    ("op5_quality", "documents", {"doc_id": "bigint", "score": "double", "keep": "boolean"}),
    ("op6_lm_scores", "documents", {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint",
                                    "train_tokens": "bigint", "base_score": "double", "score": "double"}),
    ("op10_ngram_jaccard", "documents", {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"}),
])
def test_columns_and_rows(spark, name, table, columns):
    df = QUERIES[name](spark, SF)
    assert columns.items() <= dict(df.dtypes).items()
    assert df.count() == spark.read.parquet(f"{SF}/{table}.parquet").count()
