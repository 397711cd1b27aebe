"""Intermediate tables that give their disk space back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quoteflow.plans.workspace import new_folder, write_once


class Scratch:
    """Writes tables to the shared folder, as `materialize` does, and empties those that are done with.

    A table that is released is written over by one of no rows and no size. It must not be read again,
    also not by a DataFrame that was made from it and has not been written.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[int, str] = {}

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = new_folder(self.spark, name)
        write_once(df, path)
        table = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(table)] = path
        return table

    def release(self, *tables: DataFrame) -> None:
        for table in tables:
            path = self.paths.pop(id(table))
            self.spark.range(0).coalesce(1).write.mode("overwrite").parquet(path)
