"""Removal of lines that many documents share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quoteflow.plans.workspace import materialize

# What counts as white space at the ends of a line, space and the controls 9 to 13.
SPACES = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: Column) -> Column:
    """The lines of a text; null and the empty text are one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """A line without white space at both ends, A to Z in lower case."""
    return F.translate(F.btrim(line, F.lit(SPACES)), UPPER, LOWER)


def _identity(text: Column) -> tuple[Column, Column]:
    """What tells rows of one document id apart; rows that agree in it are equal in all decisions."""
    return F.xxhash64(F.coalesce(text, F.lit(""))).alias("_text"), F.coalesce(F.length(text), F.lit(0)).alias("_size")


def line_dedup(
    documents: DataFrame,
    min_length: int = 20,
    min_documents: int = 3,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``documents`` with shared lines removed, and with ``n_lines`` and ``n_dropped``.

    Lines are compared by `line_key`. A key of at least ``min_length`` code points that at least
    ``min_documents`` documents hold keeps its lines in the largest document id only. Lines are
    exploded to narrow rows of a 128-bit hash, a document and a position; documents are counted per
    hash; and the positions to drop go back to their documents, where the lines between them are
    joined again. Texts move once, and not at all while the table of positions is small enough for
    Spark to broadcast. A hot line sends one row per document to the count, which combines them
    before its shuffle, and the join back to positions can be split.

    A null or empty text is one empty line, and stays null or empty. Rows with a null id hold lines
    of one document that is smaller than all others. Rows that repeat an id are one document; each
    is returned. An empty table gives an empty one. Columns of the input are kept, but for two of
    the names added here, which are replaced.
    """
    # Columns of the input travel in one, so that their names can't clash with those used here.
    names = [name for name in documents.columns if name not in ("n_lines", "n_dropped")]
    key, text = F.col("_row")[id_column], F.col("_row")[text_column]
    source = documents.select(F.struct(*[F.col(f"`{name}`") for name in names]).alias("_row"))
    lines = source.select(key.alias("_id"), *_identity(text), F.posexplode(lines_of(text)).alias("_at", "_line"))
    keyed = lines.withColumn("_line", line_key(F.col("_line"))).where(F.length("_line") >= min_length)
    keyed = materialize(keyed.select("_id", "_text", "_size", "_at", F.unhex(F.md5("_line")).alias("_hash")), "lines")
    held = keyed.select("_hash", "_id").distinct().groupBy("_hash")
    shared = held.agg(F.count(F.lit(1)).alias("_documents"), F.max("_id").alias("_keeper"))
    shared = materialize(shared.where(F.col("_documents") >= min_documents).select("_hash", "_keeper"), "shared-lines")
    drops = keyed.join(shared, "_hash").where(~F.col("_id").eqNullSafe(F.col("_keeper")))
    drops = drops.groupBy("_id", "_text", "_size").agg(F.array_sort(F.collect_set("_at")).alias("_drops"))
    drops = materialize(drops.withColumnRenamed("_id", "_owner"), "dropped-lines")

    named = source.select("*", *_identity(text))
    found = named.join(drops, key.eqNullSafe(F.col("_owner")) & _same(named, drops), "left")
    found = found.select("_row", lines_of(text).alias("_lines"), "_drops")
    # Each dropped line ends a stretch of kept ones; a last stretch follows after all of them.
    ends = F.concat(F.col("_drops"), F.array(F.size("_lines")))
    stretches = F.transform(
        F.arrays_zip(F.concat(F.array(F.lit(-1)), F.col("_drops")).alias("after"), ends.alias("end")),
        lambda x: F.slice(F.col("_lines"), x["after"] + 2, x["end"] - x["after"] - 1),
    )
    cleaned = F.when(F.col("_drops").isNull(), text).otherwise(F.array_join(F.flatten(stretches), "\n"))
    kept = [cleaned if name == text_column else F.col("_row")[name] for name in names]
    return found.select(
        *[column.alias(name) for column, name in zip(kept, names)],
        F.size("_lines").cast("long").alias("n_lines"),
        F.when(F.col("_drops").isNull(), F.lit(0)).otherwise(F.size("_drops")).cast("long").alias("n_dropped"),
    )


def _same(named: DataFrame, drops: DataFrame) -> Column:
    return (named["_text"] == drops["_text"]) & (named["_size"] == drops["_size"])
