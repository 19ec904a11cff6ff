"""Training-corpus pipeline over ``documents``: quality, language, near
duplicates, benchmark contamination, mix.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet in the shared folder and read again as the next stage's ``docs``. All
but the last return the columns of ``docs``. The last returns them with the
row's size, its source's size and target, and how often the mix repeats the row
(rows that it leaves out are not returned).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clientlens.llm.decontam import decontamination_stage
from clientlens.llm.jaccard import near_duplicate_stage
from clientlens.llm.language import language_stage
from clientlens.llm.mixing import mix_to_targets
from clientlens.llm.quality import quality_stage
from clientlens.llm.shared import table, written


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_to_targets(docs).filter("mix_copies > 0")


STAGES = [
    ("quality", quality_stage),
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

#: Trained and iterative stages have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
