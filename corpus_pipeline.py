"""The corpus pipeline: toxicity, language ID, SimHash near-dedup, best-fit packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept; it is written as
Parquet and read again before the next. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leksika.llm import language, packing, similar, toxicity
from leksika.llm.common import materialise

STAGES = [
    ("toxicity", toxicity.stage),
    ("language_id", language.stage),
    ("simhash_near_dedup", similar.stage),
    ("best_fit_packing", packing.stage),
]

#: The stages learn models and hash whole texts, which SQL cannot express; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
