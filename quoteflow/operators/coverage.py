"""What a portfolio asks for, and what of it was quoted."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quoteflow.plans.workspace import materialize

# The parts of a quote that a request names.
REQUEST_FIELDS = "quote,fundamental"


def request_manifest(symbols: DataFrame, batch_size: int = 500) -> DataFrame:
    """The requests to send: comma-joined symbols per portfolio, at most ``batch_size`` in each.

    A portfolio that fits gives one request. A larger one is first spread over hash buckets, and
    only a bucket is numbered and joined up in one place, however large the portfolio is: rows are
    dealt by bucket after the join with the sizes, which adaptive execution can then split.
    """
    symbols = materialize(symbols.select("PortfolioID", "Symbol"), "symbols")
    sizes = symbols.groupBy("PortfolioID").agg(F.ceil(F.count("*") / batch_size).alias("buckets"))
    hashed = F.conv(F.substring(F.md5("Symbol"), 1, 8), 16, 10).cast("bigint")
    bucket = Window.partitionBy("PortfolioID", "bucket").orderBy("Symbol")
    part = F.floor((F.row_number().over(bucket) - 1) / batch_size)
    return (
        symbols.join(materialize(sizes, "sizes"), "PortfolioID")
        .withColumn("bucket", F.pmod(hashed, F.col("buckets")))
        .repartition("PortfolioID", "bucket")
        .withColumn("part", part)
        .groupBy("PortfolioID", "bucket", "part")
        .agg(
            F.count("*").alias("n_symbols"),
            F.array_join(F.sort_array(F.collect_list("Symbol")), ",").alias("symbols"),
        )
        .withColumn("fields", F.lit(REQUEST_FIELDS))
    )


def fewest_requests(symbols: DataFrame, batch_size: int = 500) -> DataFrame:
    """The requests to send, as few as can be: of n symbols of a portfolio, n / ``batch_size`` rounded up.

    Symbols are numbered through in their order and cut into requests. They are sorted by range, so a large portfolio lies in
    many partitions; each numbers its own, and the counts of a portfolio's partitions, summed in turn, tell
    where each begins. So no portfolio is gathered in one place, and a request is joined up from its symbols alone.
    """
    ranged = symbols.select("PortfolioID", "Symbol").distinct().repartitionByRange("PortfolioID", "Symbol")
    ranged = materialize(ranged.withColumn("part", F.spark_partition_id()), "ranges")
    counts = ranged.groupBy("PortfolioID", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("PortfolioID").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("PortfolioID", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("PortfolioID", "part").orderBy("Symbol")
    numbered = ranged.withColumn("at", F.row_number().over(inside) - 1).join(materialize(counts, "counts"), ["PortfolioID", "part"])
    request = F.floor((F.col("before") + F.col("at")) / batch_size).alias("request")
    return (
        numbered.groupBy("PortfolioID", request)
        .agg(
            F.count("*").alias("n_symbols"),
            F.array_join(F.sort_array(F.collect_list("Symbol")), ",").alias("symbols"),
        )
        .withColumn("fields", F.lit(REQUEST_FIELDS))
    )


def quoted_symbols(quotes: DataFrame) -> DataFrame:
    """The distinct symbols of quotes, kept in the shared folder so that their size is known."""
    return materialize(quotes.select("Symbol").distinct(), "quoted")


def quote_coverage(symbols: DataFrame, quotes: DataFrame) -> DataFrame:
    """Per portfolio: symbols requested, received and missing."""
    quoted = quoted_symbols(quotes).withColumn("hit", F.lit(1))
    return (
        symbols.join(quoted, "Symbol", "left")
        .groupBy("PortfolioID")
        .agg(F.count("*").alias("requested"), F.count("hit").alias("received"))
        .withColumn("missing", F.col("requested") - F.col("received"))
    )


def missing_symbols(symbols: DataFrame, quotes: DataFrame) -> DataFrame:
    """The requested symbols ``(PortfolioID, Symbol)`` that no quote came for."""
    return symbols.join(quoted_symbols(quotes), "Symbol", "left_anti").select("PortfolioID", "Symbol")
