from __future__ import annotations

import json

import pytest
from quoteflow.operators import raw_quotes
from quoteflow.plans import load
from quoteflow.plans.workspace import materialize, shared_folder
from quoteflow.sources import LANDED_SCHEMA


@pytest.fixture
def base(tmp_path):
    return str(tmp_path / "tables")


def raw(spark, snapshot, **prices):
    """One document; a price comes with its quote time."""
    entries = {s: {"quote": {"lastPrice": p, "quoteTime": t}} for s, (p, t) in prices.items()}
    return raw_quotes(spark.createDataFrame([(snapshot, json.dumps(entries))], LANDED_SCHEMA))


def stage(spark, base):
    return {r.Symbol: int(r.LastPrice) for r in load.read_stage(spark, base).collect()}


def test_each_load_replaces_the_one_before(spark, base):
    first = load.reload(raw(spark, 1, A=(1, 100), B=(2, 100)), base).first()
    assert (first.load_id, first.raw_rows, first.stage_rows) == (0, 2, 2)
    second = load.reload(raw(spark, 2, A=(3, 50), C=(4, "n/a")), base).first()
    assert (second.load_id, second.raw_rows, second.stage_rows) == (1, 2, 1)
    assert stage(spark, base) == {"A": 3}
    assert {r.Symbol for r in load.read_raw(spark, base).collect()} == {"A", "C"}


def test_the_same_load_again_gives_the_same_tables(spark, base):
    for _ in range(2):
        load.reload(raw(spark, 1, A=(1, 100), B=(2, 100)), base)
    assert stage(spark, base) == {"A": 1, "B": 2}
    assert load.read_raw(spark, base).count() == 2


def test_no_quotes_is_an_error_and_changes_nothing(spark, base):
    with pytest.raises(ValueError):
        load.read_stage(spark, base)
    load.reload(raw(spark, 1, A=(1, 100)), base)
    with pytest.raises(load.NothingToLoad):
        load.reload(raw(spark, 2), base)
    assert stage(spark, base) == {"A": 1}


def test_a_failed_load_is_never_seen(spark, base, monkeypatch):
    load.reload(raw(spark, 1, A=(1, 100)), base)

    def fail(_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(load, "stage_quotes", fail)
        with pytest.raises(RuntimeError):
            load.reload(raw(spark, 2, A=(2, 200)), base)
    assert stage(spark, base) == {"A": 1}
    assert {r.SnapshotId for r in load.read_raw(spark, base).collect()} == {1}
    load.reload(raw(spark, 2, A=(2, 200)), base)
    assert stage(spark, base) == {"A": 2}


def test_carry_over_keeps_the_newer_row(spark, base):
    load.reload(raw(spark, 1, A=(1, 100), B=(2, 100), C=(3, 100)), base)
    load.reload(raw(spark, 2, A=(4, 200), B=(5, 50), D=(6, 100)), base, carry_over=True)
    assert stage(spark, base) == {"A": 4, "B": 2, "C": 3, "D": 6}


def test_a_batch_is_loaded_once(spark, base):
    load.reload(raw(spark, 1, A=(1, 100)), base, source="s", batch=0)
    again = load.reload(raw(spark, 2, A=(2, 200)), base, source="s", batch=0)
    assert again.first().load_id == 0
    assert stage(spark, base) == {"A": 1}
    load.reload(raw(spark, 3, A=(3, 300)), base, source="other", batch=0)
    assert stage(spark, base) == {"A": 3}


def test_expire_loads(spark, base, monkeypatch):
    assert load.expire_loads(spark, base) == 0
    for n in range(3):
        load.reload(raw(spark, n, A=(n, 100 + n)), base)
    oldest = load.load_log(spark, base).where("load_id = 0").first()
    assert load.expire_loads(spark, base, keep=2) == 2
    assert load.expire_loads(spark, base, keep=2) == 0
    assert sorted(r.load_id for r in load.load_log(spark, base).collect()) == [1, 2]
    assert stage(spark, base) == {"A": 2}
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(oldest.raw_path).count()
    with pytest.raises(ValueError):
        load.expire_loads(spark, base, keep=0)

    def fail(_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(load, "stage_quotes", fail)
        with pytest.raises(RuntimeError):
            load.reload(raw(spark, 3, A=(9, 900)), base)
    assert load.expire_loads(spark, base, keep=2) == 1
    assert load.reload(raw(spark, 4, A=(4, 104)), base).first().load_id == 3
    assert load.expire_loads(spark, base) == 4
    assert stage(spark, base) == {"A": 4}


def test_shared_folder_is_the_one_of_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_folder(spark) == named.rstrip("/")
    df = materialize(spark.range(5), "numbers")
    assert df.count() == 5
    assert all(shared_folder(spark) in name for name in df.inputFiles())


class Bare:
    """A session without a named folder, as far as the lookup goes."""

    def __init__(self, master, folder=None):
        self.sparkContext, self.conf, self.master, self.folder = self, self, master, folder

    def get(self, key, default):
        return default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_only_a_local_session_may_lack_a_shared_folder():
    assert shared_folder(Bare("yarn", "hdfs://x/y/")) == "hdfs://x/y"
    assert "quoteflow-" in shared_folder(Bare("local[2]"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Bare("yarn"))
