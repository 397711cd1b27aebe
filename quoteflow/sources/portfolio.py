"""Portfolio membership: one row per portfolio and symbol, with an active flag."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

PORTFOLIO_SCHEMA = "PortfolioID int, Symbol string, IsActive boolean"


def read_portfolio(spark: SparkSession, path: str, format: str = "parquet", **options: str) -> DataFrame:
    """Membership from files. Further columns of the files are ignored."""
    return spark.read.schema(PORTFOLIO_SCHEMA).format(format).options(**options).load(path)


def jdbc_options(
    url: str,
    table: str,
    split_on: str | None = None,
    bounds: tuple[int, int] | None = None,
    splits: int = 1,
    **options: str,
) -> dict[str, str]:
    """Options of a JDBC scan; ``split_on`` with ``bounds`` reads in ``splits`` parallel parts."""
    found = {"url": url, "dbtable": table, "fetchsize": "10000"}
    if split_on is not None:
        if bounds is None:
            raise ValueError("split_on needs bounds")
        found |= {
            "partitionColumn": split_on,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(splits),
        }
    return found | options


def read_portfolio_jdbc(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    """Membership from a database table; filters and the column choice are pushed to the database."""
    found = spark.read.format("jdbc").options(**jdbc_options(url, table, **options)).load()
    return found.selectExpr(
        "cast(PortfolioID as int) PortfolioID", "Symbol", "cast(IsActive as boolean) IsActive"
    )
