"""Price history and daily, weekly and monthly bars."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quoteflow.functions import epoch_to_timestamp, time_order
from quoteflow.operators.symbols import restrict_to_symbols

# The frequencies and the unit each one truncates to; weeks start on Monday.
FREQUENCIES = {"daily": "DAY", "weekly": "WEEK", "monthly": "MONTH"}


def price_history(
    ticks: DataFrame,
    start: str | date,
    end: str | date,
    symbols: str | Sequence[str] | DataFrame | None = None,
    day_column: str | None = None,
) -> DataFrame:
    """Ticks from the day ``start`` to the day ``end``, both included (YYYY-MM-DD).

    The range reaches the scan. Where the table is split into folders by day, name that column and
    other folders are not read at all. Stored bars have no ``ts``; for them name ``bar_date``.
    """
    first, last = (F.lit(date.fromisoformat(str(day))) for day in (start, end))
    if "ts" not in ticks.columns and day_column is None:
        raise ValueError("a table without ts needs a day_column")
    rows = ticks
    if "ts" in ticks.columns:
        since, until = first.cast("timestamp_ntz"), F.date_add(last, 1).cast("timestamp_ntz")
        rows = rows.where((F.col("ts") >= since) & (F.col("ts") < until))
    if day_column is not None:
        rows = rows.where(F.col(day_column).between(first, last))
    return rows if symbols is None else restrict_to_symbols(rows, symbols)


def _period(day: Column, frequency: str) -> Column:
    """The first day of the period a day is in."""
    if frequency not in FREQUENCIES:
        raise ValueError(f"frequency must be one of {', '.join(FREQUENCIES)}, not {frequency!r}")
    return day if frequency == "daily" else F.trunc(day, FREQUENCIES[frequency])


def price_bars(ticks: DataFrame, frequency: str = "daily", tie_breaker: str | None = None) -> DataFrame:
    """Open, high, low, close and volume per symbol and day, week or month.

    Ticks of one symbol at the very same time are told apart by ``tie_breaker``, a whole number.
    Every partition is reduced to one row per bar before the shuffle, by hashing.
    """
    order = F.col("ts") if tie_breaker is None else time_order(F.col("ts"), F.col(tie_breaker))
    ordered = ticks.select(
        "Symbol", _period(F.to_date("ts"), frequency).alias("bar_date"), "Price", "Volume", order.alias("_order")
    )
    return ordered.groupBy("Symbol", "bar_date").agg(
        F.min_by("Price", "_order").alias("open"),
        F.max("Price").alias("high"),
        F.min("Price").alias("low"),
        F.max_by("Price", "_order").alias("close"),
        F.sum("Volume").alias("volume"),
    )


def coarser_bars(daily: DataFrame, frequency: str) -> DataFrame:
    """Weekly or monthly bars from stored daily ones, without going back to the ticks."""
    return daily.groupBy("Symbol", _period(F.col("bar_date"), frequency).alias("period")).agg(
        F.min_by("open", "bar_date").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "bar_date").alias("close"),
        F.sum("volume").alias("volume"),
    ).withColumnRenamed("period", "bar_date")


# A history response: the symbol, and candles with their time in epoch milliseconds.
HISTORY = (
    "symbol: string, candles: array<struct<datetime: bigint, open: {price}, high: {price}, low: {price}, "
    "close: {price}, volume: bigint>>"
)


def sorted_history(documents: DataFrame, price_type: str = "decimal(18,4)") -> DataFrame:
    """Landed history responses ``(SnapshotId, Document)``, parsed once, to rows of two kinds.

    The kind "bar" has ``(Symbol, ts, open, high, low, close, volume)``; a response that is no JSON object, or has
    something behind it, is one row of the kind "rejected" with its ``SnapshotId`` and ``Document``. The shape of a response is
    this repository's own; FIXTURES.md gives it. A whole one without candles gives no rows. A candle without a time has a NULL one.
    """
    # An end mark behind the response tells whether it was cut off or had a tail, as `explode_documents` does.
    marked = F.concat(F.lit("["), F.col("Document"), F.lit(',{"symbol":"end"}]'))
    parsed = documents.withColumn("_parts", F.from_json(marked, f"array<struct<{HISTORY.format(price=price_type)}>>"))
    whole = (F.size("_parts") == 2) & F.get("_parts", F.lit(0)).isNotNull()
    parsed = parsed.withColumn("_whole", F.explode(F.array(F.coalesce(whole, F.lit(False)))))
    response = F.get("_parts", F.lit(0))
    unread = F.array(F.lit(None).cast(parsed.schema["_parts"].dataType.elementType["candles"].dataType.elementType))
    rows = parsed.withColumn("candle", F.explode(F.when(F.col("_whole"), response["candles"]).otherwise(unread)))
    time = epoch_to_timestamp(F.col("candle.datetime").cast("double"))
    return rows.select(
        F.when(F.col("_whole"), "bar").otherwise("rejected").alias("kind"),
        "SnapshotId",
        F.when(~F.col("_whole"), F.col("Document")).alias("Document"),
        F.when(F.col("_whole"), response["symbol"]).alias("Symbol"),
        time.alias("ts"),
        *[F.col(f"candle.{name}") for name in BAR],
    )


BAR = ("open", "high", "low", "close", "volume")


def history_bars(documents: DataFrame, price_type: str = "decimal(18,4)") -> DataFrame:
    """The bars of `sorted_history`."""
    return sorted_history(documents, price_type).where("kind = 'bar'").select("Symbol", "ts", *BAR)


def rejected_history(documents: DataFrame) -> DataFrame:
    """The history responses that can't be read."""
    return sorted_history(documents).where("kind = 'rejected'").select("SnapshotId", "Document")
