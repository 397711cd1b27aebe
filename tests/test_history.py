"""Stored history: which files are opened, and responses that can't be read."""

from __future__ import annotations

import datetime
import json

import pytest
from pyspark.sql import functions as F
from quoteflow.operators import fewest_requests, history_bars, rejected_history
from quoteflow.plans import files
from quoteflow.plans.history import history_files, load_history, read_history, read_rejected_history, write_history
from quoteflow.sources import LANDED_SCHEMA

DAY = datetime.date(2024, 1, 1)


def ticks(spark, symbols=50, days=4, each=20):
    rows = spark.range(symbols * days * each).selectExpr(
        f"concat('S', lpad(id % {symbols}, 3, '0')) AS Symbol",
        f"timestamp_ntz'2024-01-01' + make_dt_interval(id div {symbols} % {days}, 0, 0, id) AS ts",
        "id AS TickId",
        "cast(id AS decimal(18,4)) AS Price",
        "id AS Volume",
    )
    return rows


def told(df):
    return sorted(map(str, df.select("Symbol", "ts", "TickId", "Price", "Volume").collect()))


def test_files_without_a_symbol_or_day_are_not_opened(spark, tmp_path):
    base, given = str(tmp_path / "history"), ticks(spark)
    assert write_history(given, base, ranges=16) == given.count()
    listed = history_files(spark, base).collect()
    assert sum(f.rows for f in listed) == given.count() and len({f.day for f in listed}) == 4
    found = read_history(spark, base, "2024-01-02", "2024-01-03", "S007")
    # A day lies in about four files, of which a symbol is in one or two.
    assert 2 <= len(found.inputFiles()) <= 4 < len(listed) / 3
    assert told(found) == told(given.where("Symbol = 'S007' AND to_date(ts) IN ('2024-01-02', '2024-01-03')"))
    some = spark.createDataFrame([("S001",), ("S049",), ("none",)], "Symbol string")
    for symbols in (["S001", "S049", "none"], some):
        assert told(read_history(spark, base, DAY, DAY, symbols)) == told(given.where("Symbol IN ('S001', 'S049') AND to_date(ts) = '2024-01-01'"))
    assert told(read_history(spark, base, DAY, "2024-12-31")) == told(given)
    nothing = read_history(spark, base, DAY, DAY, "Z")
    assert nothing.isEmpty() and set(nothing.columns) >= set(given.columns)
    assert read_history(spark, base, "2023-01-01", "2023-01-02").isEmpty()


def test_a_hot_symbol_lies_in_several_files(spark, tmp_path):
    base, given = str(tmp_path / "history"), ticks(spark, symbols=1, days=1, each=4000)
    write_history(given, base, ranges=8)
    assert len(history_files(spark, base).collect()) >= 6
    assert told(read_history(spark, base, DAY, DAY, "S000")) == told(given)


def test_writes_add_up_and_failed_ones_are_not_seen(spark, tmp_path):
    base, given = str(tmp_path / "history"), ticks(spark, 3, 2, 2)
    write_history(given.where("TickId < 6"), base)
    write_history(given.where("TickId >= 6").withColumn("day", F.lit("another")), base)
    assert write_history(given.where("TickId < 0"), base) == 0
    # The list of files is written last.
    given.withColumn("day", F.to_date("ts")).write.partitionBy("day").parquet(f"{base}/rows/failed")
    assert told(read_history(spark, base, DAY, "2024-01-09")) == told(given)
    with pytest.raises(ValueError):
        read_history(spark, str(tmp_path / "none"), DAY, DAY)


CANDLE = {"datetime": 1700000000000, "open": 1, "high": 2, "low": 0.5, "close": 1.5, "volume": 7}


def responses(spark, *texts):
    return spark.createDataFrame([(n, t if isinstance(t, str) else json.dumps(t)) for n, t in enumerate(texts)], LANDED_SCHEMA)


def test_history_responses_that_cannot_be_read(spark, tmp_path):
    whole = {"symbol": "A", "candles": [CANDLE, {**CANDLE, "datetime": None}, {}]}
    text = json.dumps(whole)
    given = responses(
        spark, whole, text[:-1], "", text + "x", text + text, f"[{text}]", "null", {"symbol": "B", "candles": []}, {"symbol": "C"}, text + " \n", {}
    )
    given = given.union(spark.createDataFrame([(99, None)], LANDED_SCHEMA))
    assert sorted(r.SnapshotId for r in rejected_history(given).collect()) == [1, 2, 3, 4, 5, 6, 99]
    bars = history_bars(given).collect()
    assert len(bars) == 6 and {b.Symbol for b in bars} == {"A"} and sum(b.ts is None for b in bars) == 4
    base = str(tmp_path / "history")
    assert load_history(given, base) == {"bars": 6, "rejected": 7}
    assert load_history(given, base) == {"bars": 6, "rejected": 7}
    kept = read_rejected_history(spark, base)
    assert kept.count() == 14 and {r.Document for r in kept.collect()} >= {text[:-1], "", text + "x", None}
    day = datetime.date(2023, 11, 14)
    assert read_history(spark, base, day, day, "A").count() == 4
    assert files.names(spark, f"{base}/rows")


def test_requests_are_as_few_as_can_be(spark, setting):
    rows = [(p, f"S{i}") for p, n in ((1, 0), (2, 1), (3, 20), (4, 21), (5, 1000), (None, 3)) for i in range(n)]
    given = spark.createDataFrame(rows + rows[:50], "PortfolioID int, Symbol string")
    setting("spark.sql.adaptive.coalescePartitions.enabled", "false")
    found = fewest_requests(given, batch_size=20).collect()
    sizes = {p: sorted(r.n_symbols for r in found if r.PortfolioID == p) for p in (2, 3, 4, 5)}
    assert sizes == {2: [1], 3: [20], 4: [1, 20], 5: [20] * 50}
    assert sorted(s for r in found if r.PortfolioID == 5 for s in r.symbols.split(",")) == sorted({f"S{i}" for i in range(1000)})
    assert {r.request for r in found if r.PortfolioID == 5} == set(range(50))
