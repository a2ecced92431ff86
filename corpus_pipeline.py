"""A training-data pipeline over the documents table: quality classifier, near-dedup, decontamination, mixing, sharding.

Each stage takes all rows its predecessor kept; ``run`` writes every stage's result as Parquet below the shared
scratch folder and reads it again, so a lost executor never costs more than the stage it was in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from conform.llm.common import staged, table
from conform.llm.stages import decontaminate_stage, dedup_stage, mix_stage, quality_stage, shard_stage

STAGES = [
    ("quality classifier", quality_stage),
    ("SimHash near-dedup", dedup_stage),
    ("benchmark decontamination", decontaminate_stage),
    ("mixing sources to target weights", mix_stage),
    ("sharding", shard_stage),
]

# Bit-exact XXH64 fingerprints and a trained model have no DuckDB form; the tests use a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(spark, stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
