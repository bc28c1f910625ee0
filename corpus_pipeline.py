"""Corpus pipeline: stages over ``documents``, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from forecastlake.llm.jaccard import jaccard_stage
from forecastlake.llm.language import language_stage
from forecastlake.llm.packing import packing_stage
from forecastlake.llm.toxicity import toxicity_stage
from forecastlake.session import scratch_path

STAGES = [("toxicity", toxicity_stage), ("language_id", language_stage),
          ("ngram_jaccard", jaccard_stage), ("packing", packing_stage)]
#: Models and iterative joins aren't expressible in SQL; tests hold run()'s ids against each
#: stage's decisions taken one by one on its own input, the Jaccard groups by brute force; the two models'
#: scores are held against held-out labels, packing by round trips.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
