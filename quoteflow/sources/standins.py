"""Stand-ins for the pipeline's inputs, derived from the test tables over all their rows.

FIXTURES.md defines them. Documents are projections of events, which are dealt out by number first: they
are narrow, while reading the documents made of them is costly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quoteflow.functions import micros_since_epoch


def portfolio_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Portfolio membership from orders, with blanks, case, NULLs, empty text and duplicates."""
    return spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr(
        "cast(o_custkey % 25 as int) as PortfolioID",
        """case o_orderkey % 6
             when 0 then concat('s', o_custkey)
             when 1 then concat('  S', o_custkey, ' ')
             when 2 then null
             when 3 then ''
             when 4 then '   '
             else concat('S', o_custkey)
           end as Symbol""",
        "o_orderstatus = 'O' as IsActive",
    )


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet").repartition("event_id")
    return events.withColumn("micros", micros_since_epoch(F.col("ts"))).withColumn(
        "price", F.col("value").cast("decimal(18,4)")
    )


def _millis() -> Column:
    return F.expr("micros div 1000").cast("string")


def _iso(separator: str = "T") -> Column:
    """The event time as text to the second."""
    return F.translate(F.substring(F.col("ts").cast("string"), 1, 19), " ", separator)


def _payload(quote_time: Column) -> Column:
    """One symbol's JSON; ``quote_time`` is JSON text."""
    cent = F.lit("0.01").cast("decimal(3,2)")
    return F.concat(
        F.lit('{"quote":{"lastPrice":'),
        F.col("price").cast("string"),
        F.lit(',"bidPrice":'),
        (F.col("price") - cent).cast("string"),
        F.lit(',"askPrice":'),
        (F.col("price") + cent).cast("string"),
        F.lit(',"quoteTime":'),
        quote_time,
        F.lit(',"tradeTime":'),
        _millis(),
        F.lit('},"fundamental":{"k":'),
        F.get_json_object("props", "$.k"),
        F.lit("}}"),
    )


def _quoted(text: Column) -> Column:
    return F.concat(F.lit('"'), text, F.lit('"'))


def _plain_time() -> Column:
    kind = F.col("event_type")
    return (
        F.when(kind == "click", _millis())
        .when(kind == "view", F.expr("micros div 1000000").cast("string"))
        .when(kind == "purchase", _quoted(F.concat(_iso(), F.lit("Z"))))
        .when(kind == "signup", F.lit("0"))
        .otherwise(F.lit('"n/a"'))
    )


def _document(entry: Column) -> Column:
    return F.concat(F.lit('{"S'), F.col("user_id"), F.lit('":'), entry, F.lit("}"))


def quote_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response per event, with one symbol and five forms of quote time."""
    return _events(spark, sf_dir).select(
        F.col("event_id").alias("SnapshotId"), _document(_payload(_plain_time())).alias("Document")
    )


def mixed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses with several keys: a quote, a payload of another shape, a key given twice, and for
    errors a key that is no symbol."""
    user, price = F.col("user_id").cast("string"), F.col("price").cast("string")
    odd = F.element_at(
        F.array(*map(F.lit, ('"oops"', "null", '{"quote":null}', '{"quote":[]}'))),
        (F.col("event_id") % 4 + 1).cast("int"),
    )
    entries = F.concat(
        _payload(_plain_time()),
        F.lit(',"N'), user, F.lit('":'), odd,
        F.lit(',"D'), user, F.lit('":{"quote":{"lastPrice":1}},"D'), user,
        F.lit('":{"quote":{"lastPrice":'), price, F.lit("}}"),
        F.when(
            F.col("event_type") == "error",
            F.concat(F.lit(',"errors":{"invalidSymbols":["X'), user, F.lit('"]}')),
        ).otherwise(F.lit("")),
    )
    return _events(spark, sf_dir).select(
        F.col("event_id").alias("SnapshotId"), _document(entries).alias("Document")
    )


def damaged_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses that are cut off for clicks, empty for signups and no object for errors."""
    whole, kind = _document(_payload(_plain_time())), F.col("event_type")
    text = (
        F.when(kind == "click", F.left(whole, F.length(whole) - 1))
        .when(kind == "signup", F.lit(""))
        .when(kind == "error", F.concat(F.lit("["), whole, F.lit("]")))
        .otherwise(whole)
    )
    return _events(spark, sf_dir).select(F.col("event_id").alias("SnapshotId"), text.alias("Document"))


def time_form_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses whose quote time takes sixteen forms, by event number."""
    ts = F.col("ts")
    monday = F.trunc(F.to_date(ts), "WEEK")
    week_date = F.concat(
        F.year(F.date_add(monday, 3)).cast("string"),
        F.lit("-W"),
        F.lpad(F.weekofyear(ts).cast("string"), 2, "0"),
        F.lit("-"),
        (F.weekday(ts) + 1).cast("string"),
        F.substring(_iso(), 11, 6),
    )
    forms = [
        _millis(),
        F.expr("micros div 1000000").cast("string"),
        (F.col("micros").cast("decimal(20,0)") / 1000000).cast("decimal(20,6)").cast("string"),
        _quoted(F.concat(_iso(), F.lit("Z"))),
        _quoted(F.translate(_iso(), "-:", "")),
        _quoted(F.concat(_iso(" "), F.lit("+05:00"))),
        _quoted(F.substring(_iso(), 1, 10)),
        _quoted(F.concat(_iso(), F.lit(","), F.lpad(F.expr("micros % 1000000").cast("string"), 6, "0"))),
        _quoted(week_date),
        F.lit("true"),
        F.lit('""'),
        F.lit("{}"),
        _quoted(_millis()),
        F.lit("1e30"),
        _quoted(F.concat(F.substring(_iso(), 1, 7), F.lit("-6"))),
        F.lit("null"),
    ]
    form = F.col("event_id") % len(forms)
    chosen = F.when(form == 0, forms[0])
    for number, text in enumerate(forms[1:], 1):
        chosen = chosen.when(form == number, text)
    return _events(spark, sf_dir).select(
        F.col("event_id").alias("SnapshotId"), _document(_payload(chosen)).alias("Document")
    )


def one_document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response with the quotes of all events, as lines to be written one after the other, sorted by ``event_id``. Keys
    are E and the event number; an odd one with braces, quotes and brackets in a text comes with every error."""
    odd = F.when(
        F.col("event_type") == "error",
        F.concat(F.lit(',"N'), F.col("event_id"), F.lit('":"}{\\"[\\\\"'), F.lit(',"L'), F.col("event_id"), F.lit('":[{"a":{}},"}"]')),
    ).otherwise(F.lit(""))
    entry = F.concat(F.lit('"E'), F.col("event_id"), F.lit('":'), _payload(_plain_time()), odd)
    return _events(spark, sf_dir).select("event_id", entry.alias("entry"))


def damaged_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History responses that are cut off for clicks, empty for views and followed by more for signups."""
    whole = history_documents(spark, sf_dir).join(
        spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_id").alias("SnapshotId"), "event_type"), "SnapshotId"
    )
    text, kind = F.col("Document"), F.col("event_type")
    damaged = (
        F.when(kind == "click", F.left(text, F.length(text) - 1))
        .when(kind == "view", F.lit(""))
        .when(kind == "signup", F.concat(text, F.lit("x")))
        .otherwise(text)
    )
    return whole.select("SnapshotId", damaged.alias("Document"))


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price ticks from events."""
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.concat(F.lit("S"), F.col("user_id")).alias("Symbol"),
        "ts",
        F.col("event_id").alias("TickId"),
        F.col("value").cast("decimal(18,4)").alias("Price"),
        F.get_json_object("props", "$.k").cast("bigint").alias("Volume"),
    )


def history_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History responses: one per event with two candles; none for errors, and no list of them for signups."""
    price = F.col("price").cast("string")
    candle = lambda volume: F.concat(
        F.lit('{"datetime":'), _millis(), F.lit(',"open":'), price, F.lit(',"high":'), price, F.lit(',"low":'), price,
        F.lit(',"close":'), price, F.lit(f',"volume":{volume}}}'),
    )
    kind = F.col("event_type")
    candles = F.when(kind == "error", F.lit("[]")).otherwise(F.concat(F.lit("["), candle(1), F.lit(","), candle(2), F.lit("]")))
    listed = F.when(kind == "signup", F.lit("")).otherwise(F.concat(F.lit(',"candles":'), candles))
    text = F.concat(F.lit('{"symbol":"S'), F.col("user_id"), F.lit('"'), listed, F.lit("}"))
    return _events(spark, sf_dir).select(F.col("event_id").alias("SnapshotId"), text.alias("Document"))
