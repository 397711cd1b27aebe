"""Price history as files that a reader of few symbols and days can leave alone.

    <base>/<kind>/<version>/day=<d>   rows of one write, sorted by symbol, so that a file has a narrow range of symbols
    <base>/files/<version>            one row per file: its day, first and last symbol, and rows

A write becomes visible with its list of files, which is written last. Readers go by the lists and open those files
only that can have what they look for.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from quoteflow.operators.bars import BAR, price_history, sorted_history
from quoteflow.plans import files
from quoteflow.plans.load import COMPRESSION
from quoteflow.plans.workspace import materialize, scope
from quoteflow.sources.documents import LANDED_SCHEMA

FILES_SCHEMA = "path string, day date, first string, last string, rows bigint"


def write_history(rows: DataFrame, base: str, ranges: int | None = None) -> int:
    """Add rows with ``Symbol`` and ``ts``, such as ticks or bars, to the history in ``base``; how many there were.

    They are dealt out by ranges of day and symbol, ``ranges`` in number if given, so a day or a symbol with very many rows goes to
    several files, and sorted by symbol and time within. Rows without a time lie in a folder of their own. A column ``day``
    that is there already gives way to the day of ``ts``.
    """
    spark, version = rows.sparkSession, uuid.uuid4().hex
    path = f"{base}/rows/{version}"
    dated = rows.withColumn("day", F.to_date("ts"))
    # With the time among the keys even one symbol of one day can be split.
    keys = ["day", "Symbol", "ts"]
    ranged = dated.repartitionByRange(ranges, *keys) if ranges else dated.repartitionByRange(*keys)
    ranged.sortWithinPartitions(*keys).write.partitionBy("day").parquet(path, compression=COMPRESSION)
    fields = [field for field in rows.schema.fields if field.name != "day"]
    stored = spark.read.schema(StructType([*fields, StructField("day", DateType())])).parquet(path)
    listed = stored.groupBy(F.col("_metadata.file_path").alias("path"), "day").agg(
        F.min("Symbol").alias("first"), F.max("Symbol").alias("last"), F.count(F.lit(1)).alias("rows")
    )
    listed.coalesce(1).write.parquet(f"{base}/files/{version}")
    written = spark.read.schema(FILES_SCHEMA).parquet(f"{base}/files/{version}").agg(F.sum("rows").alias("rows")).first()
    return written.rows or 0


def history_files(spark: SparkSession, base: str) -> DataFrame:
    """All files of the history."""
    lists = [f"{base}/files/{name}" for name in files.names(spark, f"{base}/files") if files.exists(spark, f"{base}/files/{name}/_SUCCESS")]
    return spark.read.schema(FILES_SCHEMA).parquet(*lists) if lists else spark.createDataFrame([], FILES_SCHEMA)


def read_history(
    spark: SparkSession,
    base: str,
    start: str | date,
    end: str | date,
    symbols: str | Sequence[str] | DataFrame | None = None,
) -> DataFrame:
    """Rows from the day ``start`` to the day ``end``, both included, of all symbols or of some.

    One symbol or a list of them also tells which files are opened: those of the days whose range of symbols
    holds one of them. The driver gets the names of these files.
    """
    first, last = (F.lit(date.fromisoformat(str(day))) for day in (start, end))
    listed = history_files(spark, base)
    wanted = listed.where(F.col("day").between(first, last))
    if symbols is not None and not isinstance(symbols, DataFrame):
        names = [symbols] if isinstance(symbols, str) else list(symbols)
        holds = F.lit(False)
        for name in names:
            holds = holds | F.lit(name).between(F.col("first"), F.col("last"))
        wanted = wanted.where(holds)
    paths = [row.path for row in wanted.select("path").collect()]
    if not paths:
        # The columns of the history, if there is any, and no rows.
        some = listed.first()
        if some is None:
            raise ValueError(f"no history under {base}")
        return spark.read.parquet(some.path).limit(0)
    return price_history(spark.read.parquet(*paths), start, end, symbols)


def load_history(documents: DataFrame, base: str, price_type: str = "decimal(18,4)") -> dict[str, int]:
    """Store the bars of history responses, and those responses that can't be read; counts of both.

    Documents are read and parsed once. The rejected ones are read back by `read_rejected_history`.
    """
    spark = documents.sparkSession
    with scope(spark):
        parsed = materialize(sorted_history(documents, price_type), "history")
        rejected = parsed.where("kind = 'rejected'").select("SnapshotId", "Document")
        seen = Observation("rejected")
        rejected = rejected.observe(seen, F.count(F.lit(1)).alias("rows"))
        rejected.write.mode("append").parquet(f"{base}/rejected", compression=COMPRESSION)
        bars = write_history(parsed.where("kind = 'bar'").select("Symbol", "ts", *BAR), base)
    return {"bars": bars, "rejected": seen.get["rows"]}


def read_rejected_history(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.schema(LANDED_SCHEMA).parquet(f"{base}/rejected")
