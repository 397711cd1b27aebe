from __future__ import annotations

import json
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from quoteflow.operators import latest_quotes, raw_quotes, rejected_documents, require_rows, stage_quotes
from quoteflow.sources import LANDED_SCHEMA, read_document_files, read_documents

QUOTE = {
    "lastPrice": 12.34,
    "bidPrice": "12.33",
    "askPrice": 12.350049,
    "quoteTime": 1700000000123,
    "tradeTime": 1700000000000,
    "note": 'é "quoted"\n\u0001',
}


def documents(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), LANDED_SCHEMA)


def rows(df):
    return {row.Symbol: row for row in df.collect()}


def test_one_row_per_key(spark):
    document = json.dumps({"A": {"quote": QUOTE, "fundamental": {"pe": 1}}, "b c": {}, "errors": {"x": [1]}})
    found = rows(raw_quotes(documents(spark, document)))
    assert set(found) == {"A", "b c", "errors"}
    row = found["A"]
    assert (row.LastPrice, row.BidPrice, row.AskPrice) == (Decimal("12.34"), Decimal("12.33"), Decimal("12.35"))
    assert row.QuoteTime == datetime(2023, 11, 14, 22, 13, 20, 123000)
    assert json.loads(row.RawJson) == {"quote": QUOTE, "fundamental": {"pe": 1}}
    assert found["b c"][2:6] == (None, None, None, None)
    assert json.loads(found["errors"].RawJson) == {"x": [1]}


@pytest.mark.parametrize(
    "payload", ['"oops"', "null", "[1]", "5", "true", '{"quote": null}', '{"quote": []}', '{"quote": "x"}', "{}"]
)
def test_odd_payloads_keep_their_row(spark, payload):
    (row,) = raw_quotes(documents(spark, '{"A": %s}' % payload)).collect()
    assert row[1:6] == ("A", None, None, None, None)
    assert json.loads(row.RawJson) == json.loads(payload)


def test_price_type_can_be_chosen(spark):
    (row,) = raw_quotes(documents(spark, '{"A":{"quote":{"lastPrice":0.123456}}}'), "decimal(20,6)").collect()
    assert row.LastPrice == Decimal("0.123456")


@pytest.mark.parametrize(
    ("quote", "expected"),
    [
        ('{"quoteTime": 0, "tradeTime": 5}', 5),
        ('{"quoteTime": "", "tradeTime": 5}', 5),
        ('{"quoteTime": null, "tradeTime": 5}', 5),
        ('{"quoteTime": false, "tradeTime": 5}', 5),
        ('{"quoteTime": {}, "tradeTime": 5}', 5),
        ('{"tradeTime": 5}', 5),
        ('{"quoteTime": "n/a", "tradeTime": 5}', None),
        ('{"quoteTime": "0", "tradeTime": 5}', None),
        ('{"quoteTime": [0], "tradeTime": 5}', None),
        ('{"quoteTime": 7, "tradeTime": 5}', 7),
        ('{"quoteTime": 0, "tradeTime": 0}', 0),
        ('{"quoteTime": 0}', None),
    ],
)
def test_fall_back_to_trade_time(spark, quote, expected):
    (row,) = raw_quotes(documents(spark, '{"A": {"quote": %s}}' % quote)).collect()
    assert row.QuoteTime == (None if expected is None else datetime(1970, 1, 1, 0, 0, expected))


def test_the_last_of_repeated_keys_counts(spark):
    (row,) = raw_quotes(documents(spark, '{"A":{"quote":{"lastPrice":1}},"A":{"quote":{"lastPrice":2}}}')).collect()
    assert row.LastPrice == 2


def test_bad_documents_are_rejected_and_harm_no_others(spark):
    bad = [
        "", "{", '{"A":', "[1]", '"x"', "5", "null", None, " ",
        '{"A":1} x', '{"A":1}{"B":2}', '{"A":1},{"B":2}', '{"A":1}]', '{"A":1}} {}',
    ]
    good = ['{"A":1}', "{}", ' {"B":\n2} ']
    found = documents(spark, *bad, *good)
    assert {r.SnapshotId for r in rejected_documents(found).collect()} == set(range(len(bad)))
    assert set(rows(raw_quotes(found))) == {"A", "B"}


def test_require_rows(spark):
    assert require_rows(documents(spark, "{}"), "none").count() == 1
    with pytest.raises(ValueError, match="none"):
        require_rows(documents(spark, "{}").where("false"), "none")


def quote(time, price, **more):
    return {"quote": {"quoteTime": time, "lastPrice": price}} | more


def test_latest_and_stage(spark, tmp_path):
    texts = [
        {"A": quote(1700000005, 1, fundamental={"n": 1}), "B": quote(1700000001, 2), "C": quote("n/a", 3)},
        {"A": quote(1700000005, 4, fundamental={"n": 4}), "B": quote("n/a", 5), "": quote(1700000009, 6)},
        {"A": quote(1700000004, 7, fundamental={"n": 7}), "C": quote("n/a", 8)},
    ]
    raw = raw_quotes(documents(spark, *map(json.dumps, texts)))
    newest = {s: (int(r.LastPrice), r.SnapshotId) for s, r in rows(latest_quotes(raw)).items()}
    assert newest == {"A": (4, 1), "B": (2, 0), "C": (8, 2), "": (6, 1)}
    raw.write.parquet(str(tmp_path / "raw"))
    stage = rows(stage_quotes(spark.read.parquet(str(tmp_path / "raw"))))
    assert {s: (int(r.LastPrice), r.Fundamental) for s, r in stage.items()} == {"A": (4, '{"n":4}'), "B": (2, None)}


def test_one_symbol_holding_most_rows(spark, tmp_path):
    """Many copies of the newest row of a hot symbol, among them equal ones."""
    raw = raw_quotes(documents(spark, json.dumps({"HOT": quote(1700000005, 1, fundamental={"n": 1})})))
    copies = F.explode(F.sequence(F.lit(0), F.lit(19999)))
    raw = raw.withColumn("copy", copies).withColumn("SnapshotId", (F.col("copy") % 100).cast("bigint"))
    raw.drop("copy").write.parquet(str(tmp_path / "raw"))
    (row,) = stage_quotes(spark.read.parquet(str(tmp_path / "raw"))).collect()
    assert (row.Symbol, row.SnapshotId, row.Fundamental) == ("HOT", 99, '{"n":1}')


def test_documents_as_files_and_as_rows(spark, tmp_path):
    folder = tmp_path / "files"
    folder.mkdir()
    (folder / "quotes-v2-17.json").write_text(json.dumps({"A": 1, "B": 2}, indent=2))
    (folder / "quotes-v2-18.json").write_text("{}")
    (folder / "unnumbered.json").write_text('{"C":3}')
    found = read_document_files(spark, str(folder))
    assert sorted((r.SnapshotId or 0, r.Symbol) for r in raw_quotes(found).collect()) == [(0, "C"), (17, "A"), (17, "B")]
    found.write.json(str(tmp_path / "table"))
    table = read_documents(spark, str(tmp_path / "table"), "json")
    assert sorted(map(tuple, table.collect()), key=str) == sorted(map(tuple, found.collect()), key=str)


def test_what_harms_one_symbol_spares_the_others(spark):
    text = '{"A": {"quote": {"lastPrice": NaN}}, "B": {"quote": {"lastPrice": 5}}}'
    rows = {r.Symbol: r.LastPrice for r in raw_quotes(spark.createDataFrame([(1, text)], LANDED_SCHEMA)).collect()}
    assert rows == {"A": None, "B": 5}


def test_an_end_mark_inside_the_text_makes_no_document(spark):
    texts = ['{"A": {}},{"end of document":true}', '{"A": {}},"end of document"', "{'A': {}}", '{"A": {}}}', '[{"A": {}}]']
    docs = spark.createDataFrame(list(enumerate(texts)), LANDED_SCHEMA)
    assert raw_quotes(docs).count() == 0
    assert rejected_documents(docs).count() == len(texts)


def test_a_document_larger_than_a_variant(spark):
    n = 150_000
    entry = "concat('\"S', i, '\":{\"quote\":{\"lastPrice\":', i, '},\"pad\":\"', repeat('x', 900), '\"}')"
    text = f"concat('{{', array_join(transform(sequence(1, {n}), i -> {entry}), ','), '}}')"
    docs = spark.range(1).selectExpr("id AS SnapshotId", f"{text} AS Document")
    found = raw_quotes(docs).agg(F.count("*"), F.sum("LastPrice")).first()
    assert tuple(found) == (n, n * (n + 1) // 2)
    assert rejected_documents(docs).count() == 0


def test_the_setting_it_relies_on_is_demanded(spark, setting):
    docs = spark.createDataFrame([(1, "{}")], LANDED_SCHEMA)
    setting("spark.sql.variant.allowDuplicateKeys", "false")
    with pytest.raises(ValueError, match="allowDuplicateKeys"):
        raw_quotes(docs)
