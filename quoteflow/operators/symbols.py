"""The active symbols of portfolios, and restricting other data to them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quoteflow.functions import clean_symbol, is_present
from quoteflow.plans.workspace import materialize


def _active_rows(portfolio: DataFrame, portfolio_id: int | None) -> DataFrame:
    rows = portfolio.where(F.col("IsActive") & is_present(F.col("Symbol")))
    return rows if portfolio_id is None else rows.where(F.col("PortfolioID") == portfolio_id)


def active_symbols(portfolio: DataFrame, portfolio_id: int | None = None) -> DataFrame:
    """Distinct cleaned symbols ``(PortfolioID, Symbol)`` of one portfolio, or of all.

    NULL and empty symbols and inactive rows are dropped. The presence test comes before the
    clean-up, so a blank symbol stays, as ''. Duplicates go after it: ' aapl' and 'AAPL' are one.
    """
    rows = _active_rows(portfolio, portfolio_id)
    return rows.select("PortfolioID", clean_symbol(F.col("Symbol")).alias("Symbol")).distinct()


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """The same data, or a ValueError when there is none."""
    if df.isEmpty():
        raise ValueError(message)
    return df


def get_symbols(portfolio: DataFrame, portfolio_id: int) -> DataFrame:
    """The symbols of one portfolio as a single column; an empty portfolio is an error."""
    # Looked for before the duplicates go: the first row found answers it, without a shuffle.
    require_rows(_active_rows(portfolio, portfolio_id), f"no active symbols in portfolio {portfolio_id}")
    return active_symbols(portfolio, portfolio_id).select("Symbol")


def as_symbols(spark: SparkSession, symbols: str | Sequence[str] | DataFrame) -> DataFrame:
    """One symbol, a list of them or a DataFrame, always as a DataFrame with a Symbol column."""
    if isinstance(symbols, DataFrame):
        return symbols.select("Symbol")
    names = [symbols] if isinstance(symbols, str) else list(symbols)
    return spark.createDataFrame([(name,) for name in names], "Symbol string")


def restrict_to_symbols(df: DataFrame, symbols: str | Sequence[str] | DataFrame) -> DataFrame:
    """The rows of ``df`` whose Symbol is asked for.

    One symbol, or a list of them, is a condition on the rows, which reaches the scan. Give many
    symbols as a DataFrame: it is written to the shared folder first. Spark then knows its true size
    when it plans the join: small ones are broadcast and ``df`` is not shuffled, larger ones are
    shuffle-joined, where adaptive execution splits a symbol that holds too many rows. It can't if an
    aggregation by symbol follows; aggregate before, as `latest_quotes` allows.
    """
    if isinstance(symbols, str):
        symbols = [symbols]
    if not isinstance(symbols, DataFrame):
        return df.where(F.col("Symbol").isin(list(symbols)))
    wanted = materialize(symbols.select("Symbol").distinct(), "symbols")
    return df.join(wanted, "Symbol", "left_semi")
