"""What loads write and read: buckets of the stage, the folded log, one scan of the documents, no leftovers."""

from __future__ import annotations

import json

import pytest
from quoteflow.operators import raw_quotes
from quoteflow.operators.latest import fetched_stage, stage_quotes
from quoteflow.operators.quotes import explode_documents, flatten, rejected_documents, sorted_entries
from quoteflow.plans import files, load, log, workspace
from quoteflow.plans.load import bucket_of, load_documents
from quoteflow.plans.workspace import materialize, new_folder, scope
from quoteflow.sources import LANDED_SCHEMA, standins, stream_document_files
from quoteflow.streaming import run_loads
from test_load import base, raw, stage  # noqa: F401
from test_plans import landed, plan  # noqa: F401


def documents(spark, *rows):
    return spark.createDataFrame([(n, x if isinstance(x, str) else json.dumps(x)) for n, x in rows], LANDED_SCHEMA)


def quote(price, time):
    return {"quote": {"lastPrice": price, "quoteTime": time}}


def written(spark, base, load_id):
    """The buckets whose files a load has written."""
    version = load.load_log(spark, base).where(f"load_id = {load_id}").first().version
    return {name for name in files.names(spark, f"{base}/stage/{version}") if name.startswith("bucket=")}


def buckets(spark, symbols, number=load.BUCKETS):
    rows = spark.createDataFrame([(s,) for s in symbols], "Symbol string")
    return {f"bucket={r.bucket}" for r in rows.select(bucket_of("Symbol", number).alias("bucket")).collect()}


def test_a_load_rewrites_the_buckets_it_touches(spark, base):  # noqa: F811
    symbols = [f"S{i}" for i in range(300)]
    load.reload(raw(spark, 1, **{s: (1, 100) for s in symbols}), base)
    assert written(spark, base, 0) == buckets(spark, symbols) and len(buckets(spark, symbols)) == load.BUCKETS
    row = load.reload(raw(spark, 2, S7=(2, 200), S8=(3, 50), new=(4, 100)), base, carry_over=True).first()
    assert written(spark, base, 1) == buckets(spark, ["S7", "S8", "new"])
    assert row.buckets_written == len(written(spark, base, 1)) < load.BUCKETS
    assert row.stage_rows == 301
    assert stage(spark, base) == {s: 1 for s in symbols} | {"S7": 2, "new": 4}


def test_a_fresh_load_does_not_carry_buckets_over(spark, base):  # noqa: F811
    load.reload(raw(spark, 1, A=(1, 100), B=(2, 100)), base, buckets=4)
    row = load.reload(raw(spark, 2, C=(3, 100)), base, buckets=8).first()
    assert stage(spark, base) == {"C": 3} and len(row.buckets) == 8 and row.stage_rows == 1


def test_expiry_keeps_the_buckets_in_use(spark, base):  # noqa: F811
    symbols = [f"S{i}" for i in range(40)]
    load.reload(raw(spark, 0, **{s: (1, 100) for s in symbols}), base)
    for n in range(1, 4):
        load.reload(raw(spark, n, S1=(n + 1, 100 + n)), base, carry_over=True)
    assert load.expire_loads(spark, base) > 0
    assert stage(spark, base) == {s: 1 for s in symbols} | {"S1": 4}
    assert len(written(spark, base, 3)) == 1
    version = load.load_log(spark, base).first().buckets
    oldest = next(v for v in version if v.startswith("0-"))
    assert not files.exists(spark, f"{base}/stage/{oldest}/{next(iter(buckets(spark, ['S1'])))}")
    load.reload(raw(spark, 9, S2=(9, 900)), base, carry_over=True)
    assert stage(spark, base) == {s: 1 for s in symbols} | {"S1": 4, "S2": 9}


def test_the_log_is_folded(spark, base):  # noqa: F811
    entry = dict.fromkeys(log.LOG_TYPES) | {"source": "s", "buckets": [None, "x"], "bucket_rows": [0, 1], "raw_rows": 1}
    most = 0
    for n in range(50):
        log.append(spark, base, entry | {"load_id": n, "batch": n})
        most = max(most, len(log.load_log(spark, base).inputFiles()))
        assert len(files.names(spark, f"{base}/loads")) <= 2
    assert most <= log.TAIL + 1
    rows = log.load_log(spark, base).orderBy("load_id").collect()
    assert [(r.load_id, r.batch, r.buckets, r.bucket_rows) for r in rows] == [(n, n, [None, "x"], [0, 1]) for n in range(50)]


def test_a_fold_that_failed_half_way_is_not_read(spark, base):  # noqa: F811
    entry = dict.fromkeys(log.LOG_TYPES) | {"buckets": [None], "bucket_rows": [0]}
    for n in range(log.TAIL - 1):
        log.append(spark, base, entry | {"load_id": n})
    half = f"{base}/loads/{log.TAIL}/fold"
    spark.range(3).write.parquet(half)
    files.delete(spark, f"{half}/_SUCCESS")
    assert log.load_log(spark, base).count() == log.TAIL - 1
    log.append(spark, base, entry | {"load_id": log.TAIL - 1})
    assert sorted(r.load_id for r in log.load_log(spark, base).collect()) == list(range(log.TAIL))


def test_no_log_yet(spark, base, capfd):  # noqa: F811
    assert log.load_log(spark, base).isEmpty() and load.newest_load(spark, base) is None
    assert "PATH_NOT_FOUND" not in capfd.readouterr().err


ODD = [(1, {"A": quote(1, 100), "B": "oops"}), (2, '{"A": '), (3, ""), (4, "{}"), (5, '{"D": 1, "D": {"quote": {"lastPrice": 2}}}'), (6, "[1]"), (7, None)]


def test_entries_and_rejected_documents_in_one(spark):
    given = documents(spark, *ODD[:-1]).union(spark.createDataFrame([ODD[-1]], LANDED_SCHEMA))
    both = sorted_entries(given)
    kept = both.where("kind = 'raw'")
    assert sorted(map(tuple, flatten(kept).collect())) == sorted(map(tuple, raw_quotes(given).collect()))
    assert kept.where("Document IS NOT NULL").isEmpty()
    rejected = both.where("kind = 'rejected'").select("SnapshotId", "Document")
    assert sorted(map(str, rejected.collect())) == sorted(map(str, rejected_documents(given).collect()))
    assert rejected.count() == 4 and explode_documents(given).count() == kept.count()


def test_a_load_reads_and_parses_documents_once(landed):  # noqa: F811
    found = plan(flatten(sorted_entries(landed), keep=("Document", "kind")))
    assert found.count("FileScan") == found.count("from_json") == 1 and "Exchange" not in found and "Sort" not in found


def test_counters_of_a_run(spark, base):  # noqa: F811
    given = documents(spark, (1, {"A": quote(1, 100), "B": quote(2, 100), "C": quote(3, "n/a")}), (2, "x"), (3, {"A": quote(4, 50)}))
    row = load_documents(given, base, symbols=["A", "C", "Z", "A"]).first()
    assert (row.symbols_loaded, row.quotes_received, row.raw_rows, row.rejected_rows, row.stage_rows) == (3, 4, 3, 1, 1)
    assert stage(spark, base) == {"A": 1}
    assert [r.SnapshotId for r in load.read_rejected(spark, base).collect()] == [2]
    row = load_documents(given, base).first()
    assert (row.symbols_loaded, row.quotes_received, row.raw_rows, row.stage_rows) == (None, 4, 4, 2)
    with pytest.raises(load.NothingToLoad):
        load_documents(given, base, symbols="Z")
    assert len(files.names(spark, f"{base}/raw")) == 2


def test_no_documents_at_all(spark, base):  # noqa: F811
    with pytest.raises(load.NothingToLoad):
        load_documents(spark.createDataFrame([], LANDED_SCHEMA), base)
    with pytest.raises(load.NothingToLoad):
        load.reload(raw_quotes(spark.createDataFrame([], LANDED_SCHEMA)), base)
    assert load.load_log(spark, base).isEmpty()


def test_a_load_of_nothing_but_rejected_documents(spark, base):  # noqa: F811
    bad = documents(spark, (1, "x"))
    row = load_documents(bad, base, carry_over=True).first()
    assert (row.raw_rows, row.rejected_rows, row.stage_rows, row.raw_path) == (0, 1, 0, None)
    assert load.read_raw(spark, base).isEmpty() and load.read_stage(spark, base).isEmpty()
    load_documents(documents(spark, (2, {"A": quote(1, 100)})), base, carry_over=True)
    load_documents(bad, base, carry_over=True)
    assert stage(spark, base) == {"A": 1}


def test_stage_without_a_sort(spark, sf_dir, landed, tmp_path, setting):  # noqa: F811
    raw_quotes(landed).union(raw_quotes(landed)).write.parquet(str(tmp_path / "raw"))
    stored = spark.read.parquet(str(tmp_path / "raw"))
    found = fetched_stage(stored)
    assert sorted(map(str, found.collect())) == sorted(map(str, stage_quotes(stored).collect()))
    assert "Aggregate" in plan(found) and "Sort" not in plan(found) and "RawJson" not in plan(found)
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert "SortAggregate" not in plan(fetched_stage(stored))


def test_of_contradicting_rows_one_is_taken(spark):
    given = spark.createDataFrame(
        [(1, "A", 1, "x"), (1, "A", 2, "y"), (1, "A", 2, "y"), (1, None, 2, "y"), (1, "B", 2, None)],
        "SnapshotId long, Symbol string, price int, Fundamental string",
    ).selectExpr("* EXCEPT (price)", "CAST(price AS decimal(18,4)) AS LastPrice", "LastPrice AS BidPrice", "LastPrice AS AskPrice", "timestamp_ntz'2024-01-01' AS QuoteTime")
    found = {r.Symbol: r for r in fetched_stage(given).collect()}
    assert set(found) == {"A", "B"} and (found["A"].LastPrice, found["A"].Fundamental) in [(1, "x"), (2, "y")]


def leftovers(spark):
    application = spark.sparkContext.applicationId
    return set(files.names(spark, f"{workspace.shared_folder(spark)}/quoteflow-{application}"))


def test_a_scope_removes_its_folders(spark):
    before = leftovers(spark)
    with scope(spark):
        outer = materialize(spark.range(3), "outer")
        with scope(spark):
            materialize(spark.range(3), "inner")
            assert len(leftovers(spark) - before) == 2
        assert {name.split("-")[0] for name in leftovers(spark) - before} == {"outer"}
        assert outer.count() == 3
    assert leftovers(spark) == before
    with pytest.raises(RuntimeError), scope(spark):
        materialize(spark.range(3), "failing")
        raise RuntimeError
    assert leftovers(spark) == before
    materialize(spark.range(3), "kept")
    assert len(leftovers(spark) - before) == 1


def test_nothing_is_left_after_a_query_or_a_batch(spark, sf_dir, tmp_path):
    from quoteflow.plans import registry

    before = leftovers(spark)
    for name in ("portfolio_quotes", "quote_coverage", "load_counters"):
        with scope(spark):
            assert registry.queries()[name](spark, sf_dir).count() > 0
    folder = tmp_path / "in"
    folder.mkdir()
    for n in range(3):
        (folder / f"snapshot-{n}.json").write_text(json.dumps({"A": quote(n, 100 + n), f"S{n}": quote(n, 100)}))
    run_loads(stream_document_files(spark, str(folder), 1), str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
    assert leftovers(spark) == before
    rows = load.load_log(spark, str(tmp_path / "t")).collect()
    assert len(rows) == 3 and {r.quotes_received for r in rows} == {2} and {r.raw_rows for r in rows} == {2}
    assert new_folder(spark, "x").startswith(workspace.shared_folder(spark))
