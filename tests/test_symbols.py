from __future__ import annotations

import sys

import pytest
from pyspark.sql import functions as F
from quoteflow.functions import clean_symbol
from quoteflow.operators import (
    active_symbols,
    as_symbols,
    get_symbols,
    missing_symbols,
    quote_coverage,
    request_manifest,
    restrict_to_symbols,
)
from quoteflow.sources import PORTFOLIO_SCHEMA, jdbc_options, read_portfolio

ROWS = [
    (1, " aapl", True),
    (1, "AAPL", True),
    (1, "AAPL", True),
    (1, "msft\t", True),
    (1, "IBM", False),
    (1, "ORCL", None),
    (1, None, True),
    (1, "", True),
    (2, "   ", True),
    (2, " straße ", True),
    (3, "IBM", False),
]


@pytest.fixture
def portfolio(spark):
    return spark.createDataFrame(ROWS, PORTFOLIO_SCHEMA)


def listed(df):
    return sorted(tuple(row) for row in df.collect())


def test_whitespace_is_that_of_python(spark):
    points = [c for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF]
    spaces = {c for c in points if chr(c).isspace()}
    checked = [c for c in points if c < 0x3100 or c in spaces]
    df = spark.createDataFrame([(c, f"{chr(c)}x y{chr(c)}") for c in checked], "c int, s string")
    stripped = df.where(clean_symbol(F.col("s")) == "X Y").select("c")
    assert {row.c for row in stripped.collect()} == spaces


def test_active_symbols(portfolio):
    assert listed(active_symbols(portfolio)) == [(1, "AAPL"), (1, "MSFT"), (2, ""), (2, "STRASSE")]
    assert listed(active_symbols(portfolio, 2)) == [(2, ""), (2, "STRASSE")]


def test_get_symbols(portfolio):
    assert listed(get_symbols(portfolio, 1)) == [("AAPL",), ("MSFT",)]
    with pytest.raises(ValueError, match="portfolio 3"):
        get_symbols(portfolio, 3)


def test_as_symbols(spark):
    assert listed(as_symbols(spark, "A")) == [("A",)]
    assert listed(as_symbols(spark, ["A", "B"])) == [("A",), ("B",)]
    assert listed(as_symbols(spark, as_symbols(spark, ["C"]).withColumn("x", F.lit(1)))) == [("C",)]


def test_restrict_takes_one_many_or_a_table(spark):
    df = spark.createDataFrame([("A", 1), ("A", 2), ("B", 3), ("C", 4)], "Symbol string, n int")
    assert listed(restrict_to_symbols(df, "A")) == [("A", 1), ("A", 2)]
    assert listed(restrict_to_symbols(df, ["B", "C", "D"])) == [("B", 3), ("C", 4)]
    wanted = as_symbols(spark, ["A", "A", "C"])
    assert listed(restrict_to_symbols(df, wanted)) == [("A", 1), ("A", 2), ("C", 4)]
    assert listed(restrict_to_symbols(df, [])) == []
    assert listed(restrict_to_symbols(df, as_symbols(spark, []))) == []


def test_restrict_with_a_hot_symbol(spark, setting):
    """A third of the rows have one symbol, and the join may not broadcast."""
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1")
    setting("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1")
    setting("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1")
    df = spark.range(30000).selectExpr("if(id % 3 = 0, 'HOT', concat('S', id)) as Symbol", "id")
    wanted = as_symbols(spark, ["HOT", "S1", "none"])
    found = restrict_to_symbols(df, wanted)
    assert len(found.collect()) == 10001
    assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()


def test_a_hot_portfolio_is_split(spark, setting):
    """A portfolio with most of the symbols; its sizes may not be broadcast."""
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1")
    setting("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1")
    setting("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1")
    symbols = spark.range(30000).selectExpr("if(id % 3 > 0, 7, id) as PortfolioID", "concat('S', id) as Symbol")
    found = request_manifest(symbols, batch_size=100)
    rows = found.collect()
    assert sum(row.n_symbols for row in rows) == 30000 and max(row.n_symbols for row in rows) <= 100
    assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()


def test_manifest_of_a_small_portfolio_is_one_request(portfolio):
    rows = request_manifest(active_symbols(portfolio)).collect()
    assert {r.PortfolioID: (r.symbols, r.n_symbols, r.fields) for r in rows} == {
        1: ("AAPL,MSFT", 2, "quote,fundamental"),
        2: (",STRASSE", 2, "quote,fundamental"),
    }


def test_manifest_of_a_large_portfolio_is_split(spark):
    symbols = spark.range(1000).selectExpr("7 as PortfolioID", "concat('S', id) as Symbol")
    rows = request_manifest(symbols, batch_size=30).collect()
    assert max(r.n_symbols for r in rows) <= 30
    assert len({(r.bucket, r.part) for r in rows}) == len(rows)
    found = [symbol for r in rows for symbol in r.symbols.split(",")]
    assert sorted(found) == sorted(f"S{i}" for i in range(1000))


def test_coverage(spark, portfolio):
    quotes = spark.createDataFrame([("AAPL",), ("AAPL",), ("ELSE",)], "Symbol string")
    symbols = active_symbols(portfolio)
    assert listed(quote_coverage(symbols, quotes)) == [(1, 2, 1, 1), (2, 2, 0, 2)]
    assert listed(missing_symbols(symbols, quotes)) == [(1, "MSFT"), (2, ""), (2, "STRASSE")]


def test_read_portfolio(spark, portfolio, tmp_path):
    portfolio.withColumn("Note", F.lit("x")).write.parquet(str(tmp_path / "p"))
    found = read_portfolio(spark, str(tmp_path / "p"))
    assert found.columns == ["PortfolioID", "Symbol", "IsActive"]
    assert found.count() == len(ROWS)
    portfolio.write.csv(str(tmp_path / "c"), header=True)
    assert read_portfolio(spark, str(tmp_path / "c"), "csv", header="true").where("IsActive").count() == 8


def test_jdbc_options():
    plain = jdbc_options("jdbc:x:y", "t", user="u")
    assert plain == {"url": "jdbc:x:y", "dbtable": "t", "fetchsize": "10000", "user": "u"}
    split = jdbc_options("jdbc:x:y", "t", split_on="PortfolioID", bounds=(0, 99), splits=4)
    assert split["partitionColumn"] == "PortfolioID"
    assert (split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("0", "99", "4")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x:y", "t", split_on="PortfolioID")
