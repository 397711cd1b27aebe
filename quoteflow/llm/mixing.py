"""Mix sources to target weights: whole epochs first, then a weighted sample without replacement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quoteflow.llm.quality_rules import SPACE
from quoteflow.plans.workspace import materialize

# Slices of the key range per source; only the slice in which a budget ends is sorted.
SLICES = 4096
LEAST_WEIGHT = 0.25


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """Between `LEAST_WEIGHT` and 1: the share of letters and white space in a text."""
    odd = F.length(F.regexp_replace(text, r"[\p{L}" + SPACE + "]+", ""))
    share = 1 - odd / F.greatest(F.length(text), F.lit(1))
    return F.greatest(F.coalesce(share, F.lit(0.0)), F.lit(LEAST_WEIGHT))


def _kept_between(weight: Column) -> Column:
    weight = weight.cast("double")
    least = F.lit(LEAST_WEIGHT)
    return F.when(F.isnan(weight), least).otherwise(F.least(F.greatest(F.coalesce(weight, least), least), F.lit(1.0)))


def uniform(key: Column, seed: int) -> Column:
    """A number in (0, 1) that depends on nothing but ``key`` and ``seed``."""
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), key).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(2**52)


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = (1, 2, 3), share: float = 1.0, max_repeats: float = 3.0
) -> DataFrame:
    """``sizes`` (source, source_size) with ``target``: the total times ``share``, dealt by weight.

    Sources in order of their code points, null last, take ``weights`` in turn. A target stops at
    ``max_repeats`` times its source's size, and what is over goes to the others by weight. In the
    order of cap over weight the sources that stop come first, so running sums find the level at
    which the others end. The table has one row per source, which one task can hold.
    """
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    sources = sizes.select(
        "source",
        "source_size",
        F.get(F.array(*[F.lit(float(w)) for w in weights]), turn).alias("_weight"),
        (F.col("source_size") * float(max_repeats)).alias("_cap"),
    )
    everything = Window.partitionBy(F.lit(1))
    ordered = everything.orderBy(F.col("_cap") / F.col("_weight"), F.col("source").asc_nulls_last())
    stopped = F.coalesce(F.sum("_cap").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    others = F.sum("_weight").over(ordered.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = (F.sum("source_size").over(everything) * float(share) - stopped) / others
    leveled = sources.select("*", (F.col("_cap") / F.col("_weight")).alias("_ratio"), level.alias("_level"))
    leveled = leveled.withColumn("_stops", F.col("_ratio") <= F.col("_level"))
    first = F.min(F.when(~F.col("_stops"), F.struct("_ratio", "_level"))).over(everything)
    target = F.when(F.col("_stops"), F.col("_cap")).otherwise(first["_level"] * F.col("_weight"))
    return leveled.select("source", "source_size", target.alias("target"))


def mix_sources(
    documents: DataFrame,
    weights: Sequence[float] = (1, 2, 3),
    share: float = 1.0,
    max_repeats: float = 3.0,
    seed: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weight: Column | None = None,
) -> DataFrame:
    """How often the mix takes each row: its id, ``source``, ``size`` in words, ``source_size``,
    ``target``, ``copies`` and ``taken`` (words, repeats counted).

    A source gets its `source_targets`. All its documents are taken as often as the target holds the
    whole source; for the rest they stand in the order of exponential keys, ``-ln(u) / weight``, and are taken while the running sum of sizes, to the middle of the document,
    stays within the budget. So a source ends within half a document of its target. A number ``u``
    comes from a hash of the id, so reruns agree.

    The running sum is not taken over a whole source: keys fall into `SLICES` slices, the sums of
    slices show in which one the budget ends, and only the rows of that slice are sorted.

    A null or empty text has size 0 and is never counted as taken. Null is a source of its own. A
    null id draws by its text. Rows that repeat an id are mixed each for itself. Other columns,
    whatever their names, are left out; join on the id for them.
    """
    text, key = F.col(text_column), F.col(id_column).cast("string")
    drawn = -F.log(uniform(F.coalesce(key, F.md5(F.coalesce(text, F.lit("")).cast("binary"))), seed))
    rows = documents.select(
        F.col(id_column).alias("_id"),
        F.col(source_column).cast("string").alias("source"),
        word_count(text).alias("size"),
        (drawn / (quality_weight(text) if weight is None else _kept_between(weight))).alias("_key"),
    )
    slice_ = F.floor((1 - F.exp(-F.col("_key") * LEAST_WEIGHT)) * SLICES).cast("int")
    rows = materialize(rows.withColumn("_slice", F.least(slice_, F.lit(SLICES - 1))), "sizes")

    slices = rows.groupBy("source", "_slice").agg(F.sum("size").alias("_sum"))
    slices = materialize(slices, "slices")
    targets = source_targets(
        slices.groupBy("source").agg(F.sum("_sum").alias("source_size")), weights, share, max_repeats
    )
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    targets = targets.select("*", epochs.cast("long").alias("_epochs"))
    targets = targets.withColumn("_rest", F.col("target") - F.col("_epochs") * F.col("source_size"))
    up_to = Window.partitionBy("source").orderBy("_slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = slices.withColumn("_total", F.sum("_sum").over(up_to))
    running = running.withColumnRenamed("source", "_of")
    ends = targets.join(running, F.col("source").eqNullSafe(F.col("_of")))
    ends = ends.groupBy("source", "source_size", "target", "_epochs", "_rest").agg(
        F.min(
            F.when(F.col("_total") > F.col("_rest"), F.struct("_slice", (F.col("_total") - F.col("_sum")).alias("before")))
        ).alias("_end")
    )
    plan = ends.select(
        F.col("source").alias("_of"),
        "source_size",
        "target",
        "_epochs",
        "_rest",
        F.coalesce(F.col("_end")["_slice"], F.lit(SLICES)).alias("_last"),
        F.coalesce(F.col("_end")["before"], F.lit(0)).alias("_before"),
    )
    plan = materialize(plan, "source-plan")

    planned = rows.join(plan, F.col("source").eqNullSafe(F.col("_of")))
    at_end = planned.where(F.col("_slice") == F.col("_last"))
    in_order = Window.partitionBy("_of").orderBy("_key", "_id", "size")
    before = F.coalesce(F.sum("size").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    at_end = at_end.withColumn("_once", F.col("_before") + before + F.col("size") / 2 <= F.col("_rest"))
    others = planned.where(F.col("_slice") != F.col("_last"))
    others = others.withColumn("_once", F.col("_slice") < F.col("_last"))
    copies = F.col("_epochs") + F.col("_once").cast("long")
    return at_end.unionByName(others).select(
        F.col("_id").alias(id_column),
        "source",
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )
