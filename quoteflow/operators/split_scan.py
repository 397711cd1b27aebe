"""Entries of response files of any size: a file is read in many tasks, each of a part of it.

A file is read in pieces that end with a closing brace. Whether a piece begins inside a JSON string depends on
all quotes before it, and how deep it is nested on all brackets before it that are in no string. Both are running
sums: over the pieces of a chunk of a block of the file, and over the sums of the chunks before. A piece that ends at depth 1
closes an entry of the response, so the pieces in between make up one entry, or one and simple ones before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quoteflow.operators.quotes import object_entries
from quoteflow.plans.workspace import materialize
from quoteflow.sources.documents import file_number

PLACE = ("file", "block", "piece")
# 2 to this power is the most pieces that are sorted and summed together; a few MB.
CHUNK_BITS = 16
# White space in JSON.
BLANK = " \t\r\n"


def _running(pieces: DataFrame, value: Column, name: str) -> DataFrame:
    """Adds the sum of ``value`` over all pieces of the file before a piece.

    A task sums the pieces of chunks; the chunks of a file are then summed in turn, of which each has one row.
    """
    placed = pieces.withColumn("_value", value).withColumn("_chunk", F.shiftright("piece", CHUNK_BITS))
    chunk = ["file", "block", "_chunk"]
    before = Window.partitionBy("file").orderBy("block", "_chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = placed.groupBy(chunk).agg(F.sum("_value").alias("_sum"))
    chunks = chunks.select(*chunk, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(chunk).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    summed = placed.withColumn("_inside", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
    found = summed.join(materialize(chunks, "chunks"), chunk)
    return found.withColumn(name, F.col("_before") + F.col("_inside")).drop("_value", "_inside", "_before", "_chunk")


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.text(path, lineSep="}")
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    return files.select(
        *place,
        F.monotonically_increasing_id().alias("piece"),
        F.col("_metadata.file_size").alias("size"),
        F.col("value").alias("text"),
    )


def explode_document_files(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Response files to entries ``(SnapshotId, Symbol, Payload)``, and the rejected files ``(SnapshotId, file, reason)``.

    The entries are those of `explode_documents`, of each key the last value, but no file is ever one value: memory
    is needed for a block of a file and for the largest entry. A file that is no JSON object as a whole
    gives no entries. A file of blanks, or of nothing, is no object; one of no bytes at all isn't seen.
    """
    pieces = materialize(_pieces(spark, path), "pieces")
    # The last piece of a file has no brace if the bytes don't allow for one.
    # Numbers per block first, as an aggregation of structs sorts its input.
    sizes = pieces.groupBy("file", "size", "block").agg(F.sum(F.octet_length("text") + 1).alias("bytes"), F.max("piece").alias("piece"))
    sizes = sizes.groupBy("file", "size").agg(F.sum("bytes").alias("bytes"), F.max(F.struct("block", "piece")).alias("last"))
    sizes = materialize(sizes, "files")
    is_last = F.struct("block", "piece") == F.col("last")
    pieces = pieces.drop("size").join(sizes, "file")
    pieces = pieces.withColumn("brace", (~(is_last & (F.col("bytes") > F.col("size")))).cast("int")).drop("bytes", "size", "last")

    plain = F.regexp_replace("text", r"(?s)\\.", "")
    pieces = _running(pieces.withColumn("plain", plain), _count(F.col("plain"), '"').cast("long"), "quotes")
    begins_inside = F.col("quotes") % 2 == 1
    quoted = r'(?s)"[^"]*("|$)'
    outside = F.when(begins_inside, F.regexp_replace("plain", r'(?s)^[^"]*("|$)|' + quoted[4:], "")).otherwise(F.regexp_replace("plain", quoted, ""))
    ends_inside = (F.col("quotes") + _count(F.col("plain"), '"')) % 2 == 1
    pieces = pieces.withColumn("outside", outside).withColumn("closes", F.when(ends_inside, 0).otherwise(F.col("brace")))
    change = (_count(F.col("outside"), "{[") - _count(F.col("outside"), "}]") - F.col("closes")).cast("long")
    pieces = materialize(pieces.withColumn("change", change).drop("plain"), "changes")
    pieces = _running(pieces, F.col("change"), "above").withColumn("depth", F.col("above") + F.col("change"))
    pieces = materialize(pieces.drop("outside"), "depths")

    ends = F.when((F.col("depth") == 1) & (F.col("closes") == 1), 1).otherwise(0).cast("long")
    pieces = _running(pieces, ends, "entry")
    over = F.when(F.col("depth") <= 0, 1).otherwise(0).cast("long")
    pieces = _running(pieces, over, "ended").withColumn("blank", F.length(F.trim(F.col("text"), F.lit(BLANK))) == 0)
    pieces = materialize(pieces, "placed")
    # Behind the end of the object there may only be blanks.
    trailing = (F.col("ended") > 0) & F.col("blank") & (F.col("brace") == 0)
    shape = pieces.groupBy("file", "block").agg(
        F.max_by("depth", "piece").alias("depth"),
        F.bool_or((F.col("ended") > 0) & ~trailing).alias("more"),
        F.max(F.when(~trailing, F.col("entry"))).alias("last"),
    )
    shape = shape.groupBy("file").agg(F.max_by("depth", "block").alias("depth"), F.bool_or("more").alias("more"), F.max("last").alias("last"))
    shape = materialize(shape, "shape")

    braced = F.concat("text", F.when(F.col("brace") == 1, "}").otherwise(""))
    entries = pieces.where(~trailing).groupBy("file", "entry").agg(F.sort_array(F.collect_list(F.struct("block", "piece", braced.alias("text")))).alias("parts"))
    whole = F.trim(F.array_join(F.transform("parts", lambda part: part["text"]), ""), F.lit(BLANK))
    entries = entries.select("file", "entry", whole.alias("text")).join(shape, "file")
    opening = F.when(F.col("entry") == 0, "{").otherwise(",")
    closing = F.when(F.col("entry") == F.col("last"), "}").otherwise("")
    # The last entry but for blanks is the closing brace alone where the value before it was an object.
    alone = (F.col("entry") > 0) & (F.col("entry") == F.col("last")) & (F.col("text") == "}")
    framed = F.startswith("text", opening) & F.endswith("text", closing) & (F.length("text") >= 1 + F.length(closing))
    inner = F.substr("text", F.lit(2), F.length("text") - 1 - F.length(closing))
    # A comma with nothing behind it is no entry.
    filled = (F.col("entry") == 0) | (F.length(F.trim(inner, F.lit(BLANK))) > 0)
    body = F.when(alone, "{}").when(framed & filled, F.concat(F.lit("{"), inner, F.lit("}")))
    parsed = object_entries(entries.select("file", "entry", body.alias("Document")), "Document")
    parsed = materialize(parsed.select("file", "entry", F.explode_outer("_entries").alias("one"), F.col("_entries").isNull().alias("bad")), "entries")

    unread = parsed.where("bad").select("file").distinct().withColumn("reason", F.lit("an entry can't be read"))
    shapeless = shape.where("more OR depth <> 0").select("file", F.lit("no single whole object").alias("reason"))
    rejected = materialize(shapeless.unionByName(unread).groupBy("file").agg(F.min("reason").alias("reason")), "rejected")
    good = parsed.where("one IS NOT NULL").join(rejected, "file", "left_anti")
    good = good.select("file", "entry", F.col("one.key").alias("Symbol"), F.col("one.value").alias("Payload"))
    repeated = good.groupBy("file", "Symbol").agg(F.max("entry").alias("kept"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    met = good.join(materialize(repeated, "repeated"), ["file", "Symbol"], "left").where("kept IS NULL OR entry = kept")
    number = file_number(F.element_at(F.split("file", "/"), -1)).alias("SnapshotId")
    return met.select(number, "Symbol", "Payload"), rejected.select(number, "file", "reason")
