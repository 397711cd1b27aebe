"""The log of loads: one row per finished load, in a number of files that doesn't grow.

    <base>/loads/<N>/fold          the rows of all loads before load N, in one file
    <base>/loads/<N>/load-<M>      the row of load M >= N

Once `TAIL` loads stand beside a fold, all rows are folded into a new one. A folder counts only once the
job that writes it has left its mark, so a reader sees the old rows or the new. Folders of folds before the last but
one are deleted; a reader that has just listed the last but one finds its files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quoteflow.plans import files

# Loads beside a fold before the next one.
TAIL = 8
LOG_TYPES = {
    "load_id": "bigint",
    "source": "string",
    "batch": "bigint",
    "version": "string",
    "raw_path": "string",
    "rejected_path": "string",
    "stage_path": "string",
    "buckets": "array<string>",
    "bucket_rows": "array<bigint>",
    "symbols_loaded": "bigint",
    "quotes_received": "bigint",
    "raw_rows": "bigint",
    "rejected_rows": "bigint",
    "stage_rows": "bigint",
    "buckets_written": "int",
}
LOG_SCHEMA = ", ".join(f"{name} {kind}" for name, kind in LOG_TYPES.items())


def _complete(spark: SparkSession, folder: str) -> bool:
    return files.exists(spark, f"{folder}/_SUCCESS")


def _folds(spark: SparkSession, base: str) -> list[int]:
    """The folds that count, the newest first; load 0 needs none before it."""
    starts = sorted((int(name) for name in files.names(spark, f"{base}/loads")), reverse=True)
    return [n for n in starts if n == 0 or _complete(spark, f"{base}/loads/{n}/fold")]


def log_folders(spark: SparkSession, base: str) -> list[str]:
    """The folders that hold the log."""
    for start in _folds(spark, base)[:1]:
        folder = f"{base}/loads/{start}"
        return [f"{folder}/{name}" for name in files.names(spark, folder) if _complete(spark, f"{folder}/{name}")]
    return []


def load_log(spark: SparkSession, base: str) -> DataFrame:
    """One row per finished load."""
    folders = log_folders(spark, base)
    return spark.read.schema(LOG_SCHEMA).parquet(*folders) if folders else spark.createDataFrame([], LOG_SCHEMA)


def append(spark: SparkSession, base: str, entry: dict) -> None:
    """Publish a load, whose id is the next one; fold the log if its tail has become long."""
    kinds = LOG_TYPES.items()
    literal = {
        name: F.array(*map(F.lit, entry[name])) if isinstance(entry[name], list) else F.lit(entry[name]) for name, _ in kinds
    }
    row = spark.range(1).select(*[literal[name].cast(kind).alias(name) for name, kind in kinds])
    start = next(iter(_folds(spark, base)), 0)
    row.coalesce(1).write.parquet(f"{base}/loads/{start}/load-{entry['load_id']}")
    if entry["load_id"] - start + 1 >= TAIL:
        fold(spark, base, load_log(spark, base), entry["load_id"] + 1)


def fold(spark: SparkSession, base: str, rows: DataFrame, start: int) -> None:
    """Make ``rows`` the log of all loads before ``start``."""
    before = next(iter(_folds(spark, base)), 0)
    # Overwriting what a fold that failed half way has left.
    rows.coalesce(1).write.mode("overwrite").parquet(f"{base}/loads/{start}/fold")
    files.delete_others(spark, f"{base}/loads", {str(before), str(start)})
