"""Every registered query against its SQL on the same tables."""

from __future__ import annotations

import __spark_entry__ as entry
import pytest
from oracle_check import connect, difference
from quoteflow.plans import oracle, registry


@pytest.fixture(scope="module")
def tables(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(registry.queries()) == set(oracle.ORACLE)
    assert set(oracle.ORACLE) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", registry.queries())
def test_query_equals_sql(spark, tables, sf_dir, name):
    found = entry.queries()[name](spark, sf_dir)
    assert difference(found, tables, entry.oracle_sql()[name]) is None


def test_entry(spark):
    found = entry.entry(spark)
    assert found.columns == ["Symbol", "LastPrice", "BidPrice", "AskPrice", "QuoteTime", "SnapshotId"]
    assert found.count() > 0


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
@pytest.mark.parametrize("name", ["quote_time_forms", "quotes_stage", "price_bars_daily", "price_bars_weekly"])
def test_session_time_zone_does_not_matter(spark, tables, sf_dir, setting, name, zone):
    setting("spark.sql.session.timeZone", zone)
    found = entry.queries()[name](spark, sf_dir)
    assert difference(found, tables, entry.oracle_sql()[name]) is None


@pytest.mark.parametrize(
    "name", ["portfolio_quotes", "quote_coverage", "quotes_missing", "quotes_stage", "request_manifest_small"]
)
def test_without_broadcasts(spark, tables, sf_dir, setting, name):
    """The way taken when the small side is not small."""
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    found = entry.queries()[name](spark, sf_dir)
    assert difference(found, tables, entry.oracle_sql()[name]) is None
