from __future__ import annotations

import json

from quoteflow.operators import raw_quotes
from quoteflow.plans.load import load_log, read_stage, reload
from quoteflow.sources import read_document_files, read_documents, stream_document_files, stream_documents
from quoteflow.streaming import append_raw, append_rejected, run_loads

START = 1700000000
LAST = 11


def land(folder, numbers):
    folder.mkdir(exist_ok=True)
    for n in numbers:
        quotes = {
            f"S{i}": {"quote": {"lastPrice": n, "quoteTime": START + n}, "fundamental": {"n": n}}
            for i in range(20)
            if (i + n) % 3
        }
        (folder / f"snapshot-{n}.json").write_text(json.dumps(quotes, indent=1))


def listed(df):
    return sorted(map(tuple, df.collect()))


def test_append_raw_equals_batch(spark, tmp_path):
    land(tmp_path / "in", range(6))
    raw, checkpoint = str(tmp_path / "raw"), str(tmp_path / "checkpoint")
    for numbers in ((), (9, 7, 8), ()):
        land(tmp_path / "in", numbers)
        append_raw(stream_document_files(spark, str(tmp_path / "in"), 2), raw, checkpoint).awaitTermination()
    expected = raw_quotes(read_document_files(spark, str(tmp_path / "in")))
    assert listed(spark.read.parquet(raw)) == listed(expected)


def test_loads_give_the_latest_whatever_the_order_of_arrival(spark, tmp_path):
    folder, base, checkpoint = tmp_path / "in", str(tmp_path / "tables"), str(tmp_path / "checkpoint")
    for numbers in ((5, LAST, 2), (0, 1, 9), (), (3, 10)):
        land(folder, numbers)
        run_loads(stream_document_files(spark, str(folder), 1), base, checkpoint).awaitTermination()
    assert load_log(spark, base).count() == 8

    expected = str(tmp_path / "expected")
    reload(raw_quotes(read_document_files(spark, str(folder))), expected)
    assert listed(read_stage(spark, base)) == listed(read_stage(spark, expected))


def test_empty_batches_are_passed_over_and_damaged_ones_show(spark, tmp_path):
    folder, base, checkpoint = tmp_path / "in", str(tmp_path / "tables"), str(tmp_path / "checkpoint")
    land(folder, [1])
    (folder / "snapshot-2.json").write_text("{}")
    (folder / "snapshot-3.json").write_text('{"S1": ')
    run_loads(stream_document_files(spark, str(folder), 1), base, checkpoint).awaitTermination()
    found = sorted((r.raw_rows > 0, r.rejected_rows) for r in load_log(spark, base).collect())
    assert found == [(False, 1), (True, 0)]
    assert read_stage(spark, base).count() == sum((i + 1) % 3 > 0 for i in range(20))


def test_a_stream_started_anew_goes_on_from_the_tables(spark, tmp_path):
    """A fresh checkpoint reads everything again, which changes nothing but the number of loads."""
    folder, base = tmp_path / "in", str(tmp_path / "tables")
    land(folder, [1, 2])
    before = None
    for name in ("first", "second"):
        stream = stream_document_files(spark, str(folder))
        run_loads(stream, base, str(tmp_path / name)).awaitTermination()
        after = listed(read_stage(spark, base))
        assert before in (None, after)
        before = after


def test_documents_as_rows(spark, tmp_path):
    land(tmp_path / "in", range(4))
    read_document_files(spark, str(tmp_path / "in")).write.parquet(str(tmp_path / "table"))
    raw = str(tmp_path / "raw")
    append_raw(stream_documents(spark, str(tmp_path / "table"), files_per_batch=1), raw, str(tmp_path / "c")).awaitTermination()
    assert listed(spark.read.parquet(raw)) == listed(raw_quotes(read_documents(spark, str(tmp_path / "table"))))


def test_a_stream_that_keeps_running(spark, tmp_path):
    folder, base = tmp_path / "in", str(tmp_path / "tables")
    land(folder, [1])
    query = run_loads(stream_document_files(spark, str(folder)), base, str(tmp_path / "c"), every="1 second")
    try:
        query.processAllAvailable()
        land(folder, [2])
        query.processAllAvailable()
        assert {r.SnapshotId for r in read_stage(spark, base).collect()} == {1, 2}
    finally:
        query.stop()


def test_prices_keep_the_digits_asked_for(spark, tmp_path):
    folder, base = tmp_path / "in", str(tmp_path / "tables")
    folder.mkdir()
    (folder / "snapshot-1.json").write_text('{"A": {"quote": {"lastPrice": 0.000123, "quoteTime": 1700000000}}}')
    arriving = stream_document_files(spark, str(folder))
    run_loads(arriving, base, str(tmp_path / "c1"), price_type="decimal(20,6)").awaitTermination()
    append_raw(arriving, str(tmp_path / "raw"), str(tmp_path / "c2"), price_type="decimal(20,6)").awaitTermination()
    for found in (read_stage(spark, base), spark.read.parquet(str(tmp_path / "raw"))):
        assert [str(row.LastPrice) for row in found.collect()] == ["0.000123"]


def test_rejected_documents_are_kept(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for number, text in enumerate(['{"A": {}}', '{"A": ', "x"], 1):
        (folder / f"snapshot-{number}.json").write_text(text)
    arriving = stream_document_files(spark, str(folder))
    append_rejected(arriving, str(tmp_path / "bad"), str(tmp_path / "c")).awaitTermination()
    assert sorted(row.SnapshotId for row in spark.read.parquet(str(tmp_path / "bad")).collect()) == [2, 3]
