"""The newest quote per symbol, and the stage table derived from raw rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quoteflow.functions import is_present, time_order
from quoteflow.operators.quotes import PRICES
from quoteflow.plans.workspace import materialize


def latest_quotes(raw: DataFrame) -> DataFrame:
    """One row per symbol: the latest QuoteTime, then the highest SnapshotId.

    A quote without a time counts as older than any with one. Each partition sends at most one
    row per symbol to the shuffle, so a symbol with very many rows is no burden. All values have a
    fixed size, so the aggregation hashes and needs no sort.
    """
    newest = [F.max_by(name, "_order").alias(name) for name in (*PRICES, "QuoteTime", "SnapshotId")]
    order = time_order(F.col("QuoteTime"), F.col("SnapshotId"))
    ordered = raw.select("Symbol", *PRICES, "QuoteTime", "SnapshotId", order.alias("_order"))
    return ordered.groupBy("Symbol").agg(*newest)


def _usable(raw: DataFrame) -> DataFrame:
    return raw.where(is_present(F.col("Symbol")) & F.col("QuoteTime").isNotNull())


STAGE = ["Symbol", *PRICES, "QuoteTime", "Fundamental", "SnapshotId"]


def stage_quotes(raw: DataFrame) -> DataFrame:
    """Stored raw rows to stage rows: one per symbol that has a name and a quote time.

    One pass over narrow columns; whole payloads are neither read nor moved. Each partition sends
    at most one row per symbol to the shuffle. Ties go to the highest SnapshotId. The text among the columns has
    the partitions sorted; `fetched_stage` does without.
    """
    newest = F.max(F.struct("QuoteTime", "SnapshotId", *PRICES, "Fundamental")).alias("newest")
    return _usable(raw).groupBy("Symbol").agg(newest).select("Symbol", "newest.*").select(STAGE)


def fetched_stage(raw: DataFrame) -> DataFrame:
    """`stage_quotes` of a stored ``raw`` in two passes without a sort.

    The first finds the newest time per symbol, which has a fixed size, by hashing. The second fetches the rows that
    have it; where there are few symbols it needs no shuffle. Of rows that tell different things about a
    symbol at the same time, in the same snapshot, one is taken by a hash.
    """
    ordered = _usable(raw).select(*STAGE, time_order(F.col("QuoteTime"), F.col("SnapshotId")).alias("_order"))
    newest = materialize(ordered.groupBy("Symbol").agg(F.max("_order").alias("_order")), "newest")
    fetched = ordered.join(newest, ["Symbol", "_order"], "left_semi").select(STAGE).distinct()
    fetched = materialize(fetched.withColumn("_hash", F.xxhash64(*STAGE)), "fetched")
    chosen = fetched.groupBy("Symbol").agg(F.max("_hash").alias("_hash"))
    return fetched.join(chosen, ["Symbol", "_hash"], "left_semi").select(STAGE)
