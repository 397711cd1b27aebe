"""What the plans must and must not hold."""

from __future__ import annotations

import contextlib
import io
import re

import __spark_entry__ as entry
import pytest
from quoteflow.operators import (
    active_symbols,
    coarser_bars,
    explode_documents,
    price_bars,
    price_history,
    raw_quotes,
    restrict_to_symbols,
)
from quoteflow.operators.latest import latest_quotes, stage_quotes
from quoteflow.plans import registry
from quoteflow.sources import read_portfolio, read_ticks, standins


@pytest.fixture(autouse=True)
def whole_plans(setting):
    setting("spark.sql.maxMetadataStringLength", "100000")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def landed(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("documents") / "landed")
    standins.quote_documents(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("name", registry.queries())
def test_no_python_and_no_cross_joins(spark, sf_dir, name):
    found = plan(entry.queries()[name](spark, sf_dir))
    for word in ("Python", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in found


@pytest.mark.parametrize("name", ["quotes_raw", "quotes_mixed", "quotes_latest", "portfolio_quotes", "documents_rejected"])
def test_documents_are_parsed_once(spark, sf_dir, name):
    assert plan(entry.queries()[name](spark, sf_dir)).count("from_json") == 1


def test_raw_rows_need_no_shuffle(landed):
    assert "Exchange" not in plan(raw_quotes(landed))


def test_generated_methods_can_be_compiled(landed):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        raw_quotes(landed).explain("codegen")
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", text.getvalue())]
    assert sizes and max(sizes) < 8000


def test_small_symbol_tables_are_broadcast(spark, sf_dir, landed):
    entries = explode_documents(landed)
    found = plan(restrict_to_symbols(entries, registry.portfolio_symbols(spark, sf_dir)))
    assert "BroadcastHashJoin" in found and "Exchange hashpartitioning" not in found


def test_large_symbol_tables_are_not_broadcast(spark, sf_dir, landed, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "1")
    entries = explode_documents(landed)
    found = plan(restrict_to_symbols(entries, registry.portfolio_symbols(spark, sf_dir)))
    assert "BroadcastHashJoin" not in found and "LeftSemi" in found


def test_portfolio_filters_reach_the_scan(spark, sf_dir, tmp_path):
    standins.portfolio_symbol(spark, sf_dir).write.parquet(str(tmp_path / "p"))
    found = plan(active_symbols(read_portfolio(spark, str(tmp_path / "p")), 1))
    pushed = re.search(r"PushedFilters: \[(.*?)\]", found).group(1)
    assert "EqualTo(PortfolioID,1)" in pushed and "EqualTo(IsActive,true)" in pushed
    assert "IsNotNull(Symbol)" in pushed
    assert found.count("HashAggregate") == 2 and "SortAggregate" not in found


def test_history_filters_reach_the_scan(spark, sf_dir, tmp_path):
    standins.ticks(spark, sf_dir).write.parquet(str(tmp_path / "t"))
    history = price_history(read_ticks(spark, str(tmp_path / "t")), "2024-01-05", "2024-01-20", ["S1", "S2"])
    found = plan(history.select("Price"))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", found).group(1)
    assert "In(Symbol" in pushed and "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed
    assert "Volume" not in re.search(r"ReadSchema: (.*)", found).group(1)


def test_bars_are_reduced_before_the_shuffle(spark, sf_dir):
    found = plan(price_bars(standins.ticks(spark, sf_dir), "weekly"))
    assert found.count("HashAggregate") == 2 and "Sort" not in found
    daily = price_bars(standins.ticks(spark, sf_dir), "daily")
    assert "Sort" not in plan(coarser_bars(daily, "monthly"))
    broken = plan(price_bars(standins.ticks(spark, sf_dir), "weekly", tie_breaker="TickId"))
    assert broken.count("HashAggregate") == 2 and "Sort" not in broken


def test_latest_is_found_by_hashing(landed):
    found = plan(latest_quotes(raw_quotes(landed)))
    assert found.count("HashAggregate") == 2 and "Sort" not in found


def test_a_portfolio_is_restricted_after_the_reduction(spark, sf_dir, setting):
    """So a hot symbol sends a row per partition to any join."""
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    found = plan(registry.queries()["portfolio_quotes"](spark, sf_dir))
    assert found.index("LeftSemi") < found.index("HashAggregate")


def test_stage_never_touches_whole_payloads(spark, landed, setting, tmp_path):
    raw_quotes(landed).write.parquet(str(tmp_path / "raw"))
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    found = plan(stage_quotes(spark.read.parquet(str(tmp_path / "raw"))))
    assert "RawJson" not in found and "Fundamental" in found
    assert found.count("FileScan") == 1 and "partial_max" in found
