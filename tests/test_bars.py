from __future__ import annotations

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from quoteflow.operators import coarser_bars, price_bars, price_history
from quoteflow.sources import TICK_SCHEMA, read_ticks

FIRST = datetime(2023, 12, 28)


@pytest.fixture(scope="module")
def rows():
    """Ticks over a year's end, many of them at the same time; A has a third of them."""
    chance = random.Random(3)
    return [
        (
            chance.choice(["A", "B", "C"]),
            FIRST + timedelta(hours=chance.randrange(24 * 40)),
            n,
            Decimal(chance.randrange(1, 10000)) / 100,
            chance.randrange(100),
        )
        for n in range(4000)
    ]


@pytest.fixture
def ticks(spark, rows):
    return spark.createDataFrame(rows, TICK_SCHEMA)


def bucket(day: date, frequency: str) -> date:
    if frequency == "weekly":
        return day - timedelta(days=day.weekday())
    return day.replace(day=1) if frequency == "monthly" else day


@pytest.mark.parametrize("frequency", ["daily", "weekly", "monthly"])
def test_bars_by_brute_force(ticks, rows, frequency):
    groups: dict = {}
    for row in sorted(rows, key=lambda r: (r[1], r[2])):
        groups.setdefault((row[0], bucket(row[1].date(), frequency)), []).append(row)
    expected = {
        key: (g[0][3], max(r[3] for r in g), min(r[3] for r in g), g[-1][3], sum(r[4] for r in g))
        for key, g in groups.items()
    }
    got = price_bars(ticks, frequency, tie_breaker="TickId").collect()
    assert {(r.Symbol, r.bar_date): tuple(r)[2:] for r in got} == expected


@pytest.mark.parametrize("frequency", ["daily", "weekly", "monthly"])
def test_coarser_bars_equal_those_from_ticks(ticks, frequency):
    coarser = coarser_bars(price_bars(ticks, "daily", tie_breaker="TickId"), frequency)
    direct = price_bars(ticks, frequency, tie_breaker="TickId")
    assert coarser.columns == direct.columns
    assert sorted(map(tuple, coarser.collect())) == sorted(map(tuple, direct.collect()))


def test_unknown_frequency(ticks):
    with pytest.raises(ValueError, match="hourly"):
        price_bars(ticks, "hourly")


def test_history_of_stored_bars(ticks):
    daily = price_bars(ticks, "daily")
    found = price_history(daily, "2024-01-05", "2024-01-07", "A", day_column="bar_date")
    assert {r.bar_date for r in found.collect()} == {date(2024, 1, 5), date(2024, 1, 6), date(2024, 1, 7)}
    with pytest.raises(ValueError, match="day_column"):
        price_history(daily, "2024-01-05", "2024-01-07")


def test_both_ends_belong_to_the_range(ticks, rows):
    found = price_history(ticks, "2024-01-05", "2024-01-07")
    days = {row.ts.date() for row in found.collect()}
    assert days == {date(2024, 1, 5), date(2024, 1, 6), date(2024, 1, 7)}
    assert found.count() == sum(date(2024, 1, 5) <= r[1].date() <= date(2024, 1, 7) for r in rows)
    assert {r.Symbol for r in price_history(ticks, "2024-01-05", "2024-01-07", "B").collect()} == {"B"}
    assert price_history(ticks, "2024-01-07", "2024-01-05").count() == 0
    assert price_history(ticks, date(2024, 1, 5), date(2024, 1, 7)).count() == found.count()
    with pytest.raises(ValueError):
        price_history(ticks, "2024-1-5", "2024-01-07")


def test_folders_by_day_are_pruned(spark, ticks, tmp_path):
    path = str(tmp_path / "ticks")
    ticks.withColumn("day", F.to_date("ts")).write.partitionBy("day").parquet(path)
    stored = read_ticks(spark, path)
    found = price_history(stored, "2024-01-05", "2024-01-06", day_column="day")
    assert found.count() == price_history(ticks, "2024-01-05", "2024-01-06").count()
    plan = found._jdf.queryExecution().executedPlan().toString()
    partitions = plan[plan.index("PartitionFilters") : plan.index("PushedFilters")]
    assert "2024-01-05" in partitions and "2024-01-06" in partitions
