"""Session set-up."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime settings the operators rely on; all can be changed on a live session.
SETTINGS = {
    # A repeated key in a JSON object keeps its last value instead of spoiling the document.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Generated methods beyond this size are never compiled to machine code by HotSpot; Spark then
    # runs the stage operator by operator instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A task that writes to few folders keeps a file open in each of them instead of sorting its rows by folder.
    "spark.sql.maxConcurrentOutputFileWriters": "64",
    # Size-checked broadcasts, splitting of skewed join partitions, merging of small ones.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a session that already runs."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session on one machine, for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("quoteflow")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
