"""The corpus pipeline: quality rules, toxicity, near duplicates, repeated passages, packing.

Each stage gets what the one before it kept, read again from Parquet, and its decisions take
effect: rows go, texts lose passages, and the last stage returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from linkloom.llm.common import staged, table
from linkloom.llm.pipeline import STAGES

#: The stages learn models and hash texts in ways that SQL can't express; tests/llm has a brute-force version.
ORACLE_SQL = None

__all__ = ["ORACLE_SQL", "STAGES", "run"]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the documents in sf_dir."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
