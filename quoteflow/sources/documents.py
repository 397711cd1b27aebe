"""Landed quote responses, batch and stream.

A response is one JSON object, ``{symbol: {"quote": {...}, "fundamental": {...}}, ...}``. It lands
either as a file of its own, or as a row of a table ``(SnapshotId, Document)``. The snapshot number
orders responses; for files it is the last run of digits in the file name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LANDED_SCHEMA = "SnapshotId bigint, Document string"


def file_number(name: Column) -> Column:
    """The last run of digits in a file name."""
    return F.regexp_extract(name, r"(\d+)\D*$", 1).try_cast("bigint")


def _numbered(files: DataFrame) -> DataFrame:
    return files.select(file_number(F.col("_metadata.file_name")).alias("SnapshotId"), F.col("value").alias("Document"))


def read_document_files(spark: SparkSession, path: str) -> DataFrame:
    """One response per file, whatever line breaks it holds. A file is one value in one task;
    `quoteflow.operators.split_scan` reads files of any size."""
    return _numbered(spark.read.text(path, wholetext=True))


def read_documents(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """One response per row; splits and scales with the table, not with the number of files."""
    return spark.read.schema(LANDED_SCHEMA).format(format).load(path)


def stream_document_files(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """As ``read_document_files``, picking up files as they arrive."""
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch)
    return _numbered(reader.text(path, wholetext=True))


def stream_documents(
    spark: SparkSession, path: str, format: str = "parquet", files_per_batch: int = 1000
) -> DataFrame:
    """As ``read_documents``, picking up files as they arrive."""
    reader = spark.readStream.schema(LANDED_SCHEMA).option("maxFilesPerTrigger", files_per_batch)
    return reader.format(format).load(path)
