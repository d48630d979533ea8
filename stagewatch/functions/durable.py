"""Materialise a small or shared intermediate so that it survives executor loss."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stagewatch.functions.scratch import stored


def durable(df: DataFrame) -> DataFrame:
    """``df`` written as parquet below the folder named by ``spark.checkpoint.dir`` and read back."""
    return stored(df, "durable")
