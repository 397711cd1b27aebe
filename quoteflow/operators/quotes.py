"""Quote documents to one typed row per symbol."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quoteflow.functions import truthy_or, with_quote_time

PRICE_TYPE = "decimal(18,4)"
# Closes a document, as a second array element.
END_MARK = "end of document"
PRICES = {"LastPrice": "lastPrice", "BidPrice": "bidPrice", "AskPrice": "askPrice"}
DUPLICATE_KEYS = "spark.sql.variant.allowDuplicateKeys"


def _elements(text: Column) -> Column:
    """JSON text, and an end mark, as the elements of an array of objects; NULL if that is no JSON.

    Values are parsed one by one, so that the size of a document is not limited by that of a VARIANT.
    The parser stops after one complete value and does not mind what follows. With the mark the text
    held one object and nothing else only if there are two elements, the first of which is an object.
    """
    marked = F.concat(F.lit("["), text, F.lit(f',{{"{END_MARK}":true}}]'))
    return F.from_json(marked, "array<map<string,variant>>", {"allowSingleQuotes": "false"})


def _is_whole(elements: Column) -> Column:
    return F.coalesce((F.size(elements) == 2) & F.get(elements, F.lit(0)).isNotNull(), F.lit(False))


def _last_of_each_key(entries: Column) -> Column:
    """Entries of an object without those whose key comes again."""
    keys = F.transform(entries, lambda entry: entry["key"])
    placed = F.sort_array(F.transform(keys, lambda key, at: F.struct(key.alias("key"), at.alias("at"))))
    last = F.filter(placed, lambda x, at: ~x["key"].eqNullSafe(F.get(placed, at + 1)["key"]))
    kept = F.transform(last, lambda x: F.get(entries, x["at"]))
    return F.when(F.size(F.array_distinct(keys)) == F.size(keys), entries).otherwise(kept)


def _require_setting(documents: DataFrame) -> None:
    if documents.sparkSession.conf.get(DUPLICATE_KEYS) != "true":
        raise ValueError(f"{DUPLICATE_KEYS} must be true to read quote documents; see quoteflow.session.configure")


def explode_documents(documents: DataFrame) -> DataFrame:
    """One row ``(SnapshotId, Symbol, Payload)`` per top-level key of each document, any key.

    Each document is parsed once, each payload to a VARIANT of its own; a key given twice keeps its
    last value. Text that is no JSON object gives no rows here; see ``rejected_documents``. The
    setting by which keys may repeat inside a payload is demanded, as without it such a document
    would be lost.
    """
    _require_setting(documents)
    parsed = documents.withColumn("_elements", _elements(F.col("Document")))
    whole = F.when(_is_whole(F.col("_elements")), F.map_entries(F.get("_elements", F.lit(0))))
    entries = parsed.withColumn("_entries", whole).withColumn("_entry", F.explode(_last_of_each_key(F.col("_entries"))))
    return entries.select("SnapshotId", F.col("_entry.key").alias("Symbol"), F.col("_entry.value").alias("Payload"))


def object_entries(texts: DataFrame, column: str) -> DataFrame:
    """Adds ``_entries``: those of the JSON object in a column, of each key the last; null if it isn't one."""
    _require_setting(texts)
    parsed = texts.withColumn("_elements", _elements(F.col(column)))
    whole = F.when(_is_whole(F.col("_elements")), F.map_entries(F.get("_elements", F.lit(0))))
    # As the output of a generator the entries are worked out once.
    parsed = parsed.withColumn("_all", F.explode(F.array(whole))).drop("_elements")
    return parsed.withColumn("_entries", _last_of_each_key(F.col("_all"))).drop("_all")


def sorted_entries(documents: DataFrame) -> DataFrame:
    """`explode_documents` and `rejected_documents` in one: rows ``(SnapshotId, Symbol, Payload, Document, kind)``.

    An entry has the kind "raw" and no Document. A document that can't be read is one row of the kind "rejected"
    with its text, and without a symbol. Documents are parsed once for both.
    """
    _require_setting(documents)
    parsed = documents.withColumn("_elements", _elements(F.col("Document")))
    whole = F.when(_is_whole(F.col("_elements")), F.map_entries(F.get("_elements", F.lit(0))))
    entries = parsed.withColumn("_entries", whole)
    unread = F.array(F.lit(None).cast(entries.schema["_entries"].dataType.elementType))
    listed = F.when(F.col("_entries").isNull(), unread).otherwise(_last_of_each_key(F.col("_entries")))
    entries = entries.withColumn("_entry", F.explode(listed))
    return entries.select(
        "SnapshotId",
        F.col("_entry.key").alias("Symbol"),
        F.col("_entry.value").alias("Payload"),
        F.when(F.col("_entry").isNull(), F.col("Document")).alias("Document"),
        F.when(F.col("_entry").isNull(), "rejected").otherwise("raw").alias("kind"),
    )


def flatten(entries: DataFrame, price_type: str = PRICE_TYPE, keep: Sequence[str] = ()) -> DataFrame:
    """Exploded entries to the raw row, and columns to ``keep`` behind it.

    Whatever is absent, or sits under something that is no object, becomes NULL; the row stays and
    RawJson keeps the payload whole, and Fundamental that part of it. The quote time is quoteTime unless that is falsy, else
    tradeTime; a truthy one that cannot be read gives NULL.
    """
    fields = [f"{field} {price_type}" for field in PRICES.values()] + ["quoteTime variant", "tradeTime variant"]
    quote = F.try_variant_get("Payload", "$.quote", f"struct<{', '.join(fields)}>")
    found = entries.withColumn("quote", quote).select("*", "quote.quoteTime", "quote.tradeTime")
    found = found.withColumn("time", truthy_or(F.col("quoteTime"), F.col("tradeTime")))
    found = with_quote_time(found, "time", "at")
    return found.select(
        "SnapshotId",
        "Symbol",
        *[F.col(f"quote.{field}").alias(name) for name, field in PRICES.items()],
        F.col("at").alias("QuoteTime"),
        F.to_json(F.try_variant_get("Payload", "$.fundamental", "variant")).alias("Fundamental"),
        F.to_json("Payload").alias("RawJson"),
        *keep,
    )


def raw_quotes(documents: DataFrame, price_type: str = PRICE_TYPE) -> DataFrame:
    """Documents ``(SnapshotId, Document)`` to raw rows, without a shuffle."""
    return flatten(explode_documents(documents), price_type)


def rejected_documents(documents: DataFrame) -> DataFrame:
    """The documents that are no JSON object: cut off, empty, with text after it, or of another kind."""
    _require_setting(documents)
    parsed = documents.withColumn("_elements", _elements(F.col("Document")))
    # As the output of a generator the test stays where it is, and is worked out once per document.
    checked = parsed.withColumn("_whole", F.explode(F.array(_is_whole(F.col("_elements")))))
    return checked.where(~F.col("_whole")).select(documents.columns)
