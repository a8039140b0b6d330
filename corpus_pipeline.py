"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again before the next."""

from pyspark.sql import DataFrame, SparkSession

from playlake.llm import stages
from playlake.llm.common import table
from playlake.storage import materialize

STAGES = stages.STAGES

#: SQL cannot express trained rules, fingerprints or byte-pair merges; ``tests/llm`` holds the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, from ``documents`` on."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
