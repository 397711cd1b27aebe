"""A response file read in many tasks gives what reading it as one value gives."""

from __future__ import annotations

import json
import random
from datetime import datetime

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F
from quoteflow.operators import explode_document_files, explode_documents, rejected_documents, split_scan
from quoteflow.plans import registry
from quoteflow.sources import read_document_files

CASES = [
    '{"A":{"quote":{"x":1}},"B":{"q":[{"y":"}"},{"z":"{"}]},"N":"oops","C":{"s":"a\\"}b\\\\"},"M":null}',
    "{}", " {} \n", '{"A":{}}', '{"A":{},}', '{"A":{} "B":{}}', '{"A":{}}x', '{"A":{}} {}', '{"A":{}', '{"A":{"b":1} ', '[{"A":{}}]', '{"N":1}',
    '{"A":{"v":1},"A":{"v":2},"B":{"v":[1,2,{"w":"}}}{{{"}]}}', " ", "x", '{"A":{"v":"é}ü"}, "B" : {"v":"\\u007d"} }\n\n',
    '{"A":1,"B":{"x":{"y":{"z":"long text to go over several blocks } { \\" [ ] and so on"}}},"C":[{"a":1},{"b":2}],"D":{"e":5}}',
    '{"A":{}}}', '"x}"', '{,"A":{}}', '{"A":[1,{"b":2}]}', '{"A":[1,{"b":2}],"C":{"d":{}}}', '{"A":{"v":NaN}}', "}{", '{"A":{}},', '{"A":{}}"',
    '{"A":{"x":1}, }', '{"A":{}\n,\n"B":{}\n}', '{"A":"\\\\"}', '{"A":"\\"}', "[]", "null", '{"a}b":{"c":1},"d{":{}}',
]


def entries(df):
    rows = df.select("SnapshotId", "Symbol", F.to_json("Payload").alias("payload")).collect()
    return sorted((r.SnapshotId, r.Symbol, r.payload) for r in rows)


@pytest.mark.parametrize("block", [16, 1 << 20])
def test_equals_reading_whole_files(spark, tmp_path, setting, block):
    for number, text in enumerate(CASES):
        (tmp_path / f"snapshot-{number}.json").write_text(text)
    whole = read_document_files(spark, str(tmp_path))
    expected, bad = entries(explode_documents(whole)), sorted(r.SnapshotId for r in rejected_documents(whole).collect())
    setting("spark.sql.files.maxPartitionBytes", str(block))
    setting("spark.sql.files.openCostInBytes", "0")
    found, rejected = explode_document_files(spark, str(tmp_path))
    assert entries(found) == expected
    rows = rejected.collect()
    assert sorted(r.SnapshotId for r in rows) == bad and all(r.reason for r in rows)


def test_random_documents(spark, tmp_path, setting):
    draw = random.Random(5)

    def value(depth):
        kind = draw.randrange(7 if depth < 4 else 4)
        if kind < 4:
            return draw.choice([1, None, True, "", '"', "\\", "}{][", "a\\\"}", 2.5, "é"])
        if kind == 4:
            return [value(depth + 1) for _ in range(draw.randrange(4))]
        return {draw.choice(['k"', "}", "x", "y\\"]): value(depth + 1) for _ in range(draw.randrange(4))}

    for number in range(16):
        document = {f"S{i}{draw.choice(['', '}', chr(34)])}": value(0) for i in range(draw.randrange(12))}
        text = json.dumps(document, indent=draw.choice([None, 1]), ensure_ascii=draw.random() < 0.5)
        if number % 4 == 3:
            at = draw.randrange(len(text))
            text = text[:at] + draw.choice(["", "}", "{", '"', ","]) + text[at + draw.randrange(2) :]
        (tmp_path / f"snapshot-{number}.json").write_text(text)
    whole = read_document_files(spark, str(tmp_path))
    expected, bad = entries(explode_documents(whole)), sorted(r.SnapshotId for r in rejected_documents(whole).collect())
    setting("spark.sql.files.maxPartitionBytes", "60")
    setting("spark.sql.files.openCostInBytes", "0")
    found, rejected = explode_document_files(spark, str(tmp_path))
    assert entries(found) == expected
    assert sorted(r.SnapshotId for r in rejected.collect()) == bad


def test_chunks_of_a_block(spark, tmp_path, monkeypatch):
    """Sums run on over chunks of a few pieces."""
    monkeypatch.setattr(split_scan, "CHUNK_BITS", 1)
    for number, text in enumerate(CASES):
        (tmp_path / f"snapshot-{number}.json").write_text(text)
    whole = read_document_files(spark, str(tmp_path))
    found, rejected = explode_document_files(spark, str(tmp_path))
    assert entries(found) == entries(explode_documents(whole))
    assert sorted(r.SnapshotId for r in rejected.collect()) == sorted(r.SnapshotId for r in rejected_documents(whole).collect())


def test_one_file_is_written_without_a_sort(spark, tmp_path, monkeypatch):
    """The one task that writes holds no lines; no task sorts more than a chunk for its sums."""
    plans, text = [], DataFrameWriter.text

    def seen(self, path, *arguments, **options):
        plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return text(self, path, *arguments, **options)

    monkeypatch.setattr(DataFrameWriter, "text", seen)
    events = [(i, datetime(2024, 1, 1), i % 3, kind, 1.5, '{"k": 6}') for i, kind in ((4, "click"), (2, "error"), (9, "view"), (7, "error"))]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(events, schema).write.parquet(str(tmp_path / "events.parquet"))
    found = {row["Symbol"] for row in registry.queries()["quotes_one_file"](spark, str(tmp_path)).collect()}
    assert found == {"E4", "E2", "E9", "E7", "N2", "L2", "N7", "L7"}
    assert len(plans) == 1 and "Coalesce 1" in plans[0] and "Sort" not in plans[0]
