from __future__ import annotations

import json
import random
import sys
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from quoteflow.functions import is_falsy, micros_since_epoch, parse_iso, with_quote_time

needs_313 = pytest.mark.skipif(sys.version_info[:2] != (3, 13), reason="compares with Python 3.13")

# JSON text of a quote time, and what it means.
CASES = [
    ("true", "1970-01-01 00:00:01"),
    ("false", "1970-01-01 00:00:00"),
    ("-5", "1969-12-31 23:59:55"),
    ("-0.5", "1969-12-31 23:59:59.5"),
    ("0", "1970-01-01 00:00:00"),
    ("10000000000", "2286-11-20 17:46:40"),
    ("10000000001", "1970-04-26 17:46:40.001"),
    ("1700000000", "2023-11-14 22:13:20"),
    ("1700000000.5", "2023-11-14 22:13:20.5"),
    ("1700000000.1234567", "2023-11-14 22:13:20.123457"),
    ("1700000000123", "2023-11-14 22:13:20.123"),
    ("1.7e12", "2023-11-14 22:13:20"),
    ("1e30", None),
    ("-1e12", None),
    ("-62135596800", "0001-01-01 00:00:00"),
    ("-62135596801", None),
    ("253402300799000", "9999-12-31 23:59:59"),
    ("253402300800000", None),
    ("null", None),
    ("{}", None),
    ("[1]", None),
    ('{"a": 1}', None),
    ('""', None),
    ('"n/a"', None),
    ('"1700000000000"', None),
    ('"1700000000"', None),
    ('"2024-12-06"', "2024-12-06 00:00:00"),
    ('"2024-12-06T15:30:00Z"', "2024-12-06 15:30:00"),
    ('"2024-12-06T15:30:00+05:00"', "2024-12-06 15:30:00"),
    ('"2024-12-06 15:30"', "2024-12-06 15:30:00"),
    ('"2024-12-06T15:30:00,25"', "2024-12-06 15:30:00.25"),
    ('"2024-12-06T15:30:00.123456789Z"', "2024-12-06 15:30:00.123456"),
    ('"20241206T153000"', "2024-12-06 15:30:00"),
    ('"2024-W49-5"', "2024-12-06 00:00:00"),
    ('"2020-W53-7T10"', "2021-01-03 10:00:00"),
    ('"2024-W53"', None),
    ('"2024-12"', None),
    ('"2024-1-6"', None),
    ('"2023-02-29"', None),
    ('" 2024-12-06"', None),
    ('"2024-12-06T24:00"', None),
    ('"2024-12-06T15:30:60"', None),
    ('"0000-01-01"', None),
]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_quote_times(spark, setting, zone):
    setting("spark.sql.session.timeZone", zone)
    df = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(CASES)], "i int, j string")
    found = with_quote_time(df.withColumn("v", F.parse_json("j")), "v", "t").select("i", F.col("t").cast("string"))
    got = dict(tuple(row) for row in found.collect())
    assert {text: got[i] for i, (text, _) in enumerate(CASES)} == dict(CASES)


def test_truthiness_is_that_of_python(spark):
    texts = [
        "null", "false", "true", "0", "0.0", "-0.0", "0e5", "1", "-1", "0.1", "1e-300", '""', '" "', '"0"',
        '"false"', "{}", "[]", "[null]", "[[]]", '{"a":null}', "123456789012345678901234567890",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "j string").withColumn("v", F.parse_json("j"))
    got = {r.j: r.falsy for r in df.select("j", is_falsy(F.col("v")).alias("falsy")).collect()}
    assert got == {t: not json.loads(t) for t in texts}


def test_absent_is_falsy(spark):
    absent = F.try_variant_get(F.parse_json(F.lit("{}")), "$.x", "variant")
    row = spark.range(1).select(absent.alias("v")).select(is_falsy(F.col("v")).alias("falsy")).first()
    assert row.falsy is True


def _python_iso(text: str) -> datetime | None:
    try:
        return datetime.fromisoformat(text.replace("Z", "+00:00")).replace(tzinfo=None)
    except ValueError:
        return None


def _mutations(count: int) -> list[str]:
    chance = random.Random(20240106)
    seeds = [
        "2024-12-06T15:30:00+05:30",
        "20241206T153000.123456+0530",
        "2024-W49-5T10:11",
        "2024W495T101112Z",
        "2020-W53-7 10",
        "2024-12-06 15:30:00.5-23:59:59",
    ]
    found = []
    for _ in range(count):
        text = list(chance.choice(seeds))
        for _ in range(chance.randint(1, 3)):
            at, way = chance.randrange(len(text)), chance.random()
            if way < 0.4:
                text[at] = chance.choice("0123456789-:+TW.,Z xé")
            elif way < 0.7 and len(text) > 1:
                del text[at]
            else:
                text.insert(at, chance.choice("0123456789-:+TW.,Z xé"))
        if chance.random() < 0.3:
            text = text[: chance.randint(0, len(text))]
        found.append("".join(text))
    return found


@needs_313
def test_iso_text_is_read_as_python_does(spark):
    texts = _mutations(20000)
    df = spark.createDataFrame([(t, _python_iso(t)) for t in texts], "t string, expected timestamp_ntz")
    wrong = df.where(~parse_iso(F.col("t")).eqNullSafe(F.col("expected")))
    assert df.where("expected is not null").count() > 1000
    assert [row.t for row in wrong.collect()] == []


def test_numbers_are_read_as_python_does(spark):
    chance = random.Random(7)
    numbers = [round(chance.uniform(-6.2e10, 1e10), chance.randint(0, 6)) for _ in range(3000)]
    numbers += [round(chance.uniform(1.0e10, 2.5e14), chance.randint(0, 3)) for _ in range(3000)]
    numbers += [chance.randint(1_000_000_000_000, 2_000_000_000_000) for _ in range(3000)]

    def expected(number):
        seconds = float(number) / 1000.0 if number > 1e10 else float(number)
        return datetime.fromtimestamp(seconds, tz=timezone.utc).replace(tzinfo=None)

    rows = [(json.dumps(n), expected(n)) for n in numbers]
    df = spark.createDataFrame(rows, "j string, expected timestamp_ntz").withColumn("v", F.parse_json("j"))
    wrong = with_quote_time(df, "v", "t").where(~F.col("t").eqNullSafe(F.col("expected")))
    assert [tuple(row) for row in wrong.select("j", "t", "expected").collect()] == []


def test_micros_since_epoch(spark, setting):
    setting("spark.sql.session.timeZone", "America/New_York")
    times = [datetime(2024, 3, 10, 2, 30, 0, 5), datetime(1969, 12, 31, 23, 59, 59, 999999), datetime(9999, 1, 1)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    got = [row[0] for row in df.select(micros_since_epoch(F.col("t"))).collect()]
    assert got == [(t - datetime(1970, 1, 1)) // timedelta(microseconds=1) for t in times]
