import os

import duckdb
import pytest

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True)
def _workers_import_the_repository(spark):
    spark.sparkContext.environment["PYTHONPATH"] = REPO


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.fixture()
def documents(spark):
    """Rows (id, text) -> a documents table with odd ids, texts and columns."""
    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOC)
    return make
