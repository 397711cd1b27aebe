"""Price ticks, the raw material of price bars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TICK_SCHEMA = "Symbol string, ts timestamp_ntz, TickId bigint, Price decimal(18,4), Volume bigint"


def read_ticks(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """Ticks of any number of symbols. A folder column such as ``day=2024-01-05`` is kept."""
    return spark.read.schema(TICK_SCHEMA).format(format).load(path)
