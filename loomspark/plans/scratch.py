"""Folders for written tables and generated files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from loomspark.plans.lineage import checkpoint_dir


def fresh_folder(spark: SparkSession, what: str) -> str:
    """A new path below the shared checkpoint folder; nothing is created or removed."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, what: str) -> DataFrame:
    """The same rows read back from a Parquet table in the shared folder."""
    path = fresh_folder(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
