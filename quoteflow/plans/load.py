"""The load protocol: new raw and stage tables replace the old ones.

A load writes its raw and stage tables to folders of their own and then adds one row to a log of
loads. Readers go by the newest row of that log. So a load that fails half way changes nothing for
them, and there is no moment at which the tables are empty.

    <base>/raw/<version>/kind=raw        raw rows of one load
    <base>/raw/<version>/kind=rejected   documents of the load that could not be read
    <base>/stage/<version>/bucket=<k>    stage rows of one load whose symbols fall into a hash bucket
    <base>/loads                         the log, see `quoteflow.plans.log`

The stage table is made of hash buckets of symbols, and the log says for each of them which load has written
it last. A load that adds to the stage writes the buckets that its symbols fall into, and no others.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from quoteflow.operators.latest import fetched_stage as stage_quotes
from quoteflow.operators.quotes import PRICE_TYPE, flatten, sorted_entries
from quoteflow.operators.symbols import as_symbols
from quoteflow.plans import files, log
from quoteflow.plans.log import load_log
from quoteflow.plans.workspace import materialize, scope
from quoteflow.sources.documents import LANDED_SCHEMA

RAW_SCHEMA = (
    f"SnapshotId bigint, Symbol string, LastPrice {PRICE_TYPE}, BidPrice {PRICE_TYPE}, AskPrice {PRICE_TYPE}, "
    "QuoteTime timestamp_ntz, Fundamental string, RawJson string"
)
STAGE_SCHEMA = (
    f"Symbol string, LastPrice {PRICE_TYPE}, BidPrice {PRICE_TYPE}, AskPrice {PRICE_TYPE}, QuoteTime timestamp_ntz, "
    "Fundamental string, SnapshotId bigint"
)
# The payload text is a third smaller than with the default, in the same time.
COMPRESSION = "zstd"
# Hash buckets of a new stage table. A table of very many symbols wants more: a bucket is what a load rewrites.
BUCKETS = 16


class NothingToLoad(ValueError):
    """The documents held no quotes."""


def newest_load(spark: SparkSession, base: str) -> Row | None:
    return load_log(spark, base).orderBy(F.desc("load_id")).first()


def _published(spark: SparkSession, base: str) -> Row:
    load = newest_load(spark, base)
    if load is None:
        raise ValueError(f"no load has finished under {base}")
    return load


def _table(spark: SparkSession, paths: Sequence[str | None], schema: str) -> DataFrame:
    """The rows of some folders; of an empty table there are none."""
    paths = [path for path in paths if path is not None]
    return spark.read.parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_raw(spark: SparkSession, base: str) -> DataFrame:
    """The raw table as of the newest finished load."""
    return _table(spark, [_published(spark, base).raw_path], RAW_SCHEMA)


def read_stage(spark: SparkSession, base: str) -> DataFrame:
    """The stage table as of the newest finished load."""
    return _table(spark, _bucket_paths(base, _published(spark, base)), STAGE_SCHEMA)


def read_rejected(spark: SparkSession, base: str) -> DataFrame:
    """The documents that the newest finished load could not read; no rows if none were given to it."""
    return _table(spark, [_published(spark, base).rejected_path], LANDED_SCHEMA)


def _bucket_paths(base: str, load: Row) -> list[str | None]:
    return [version and f"{base}/stage/{version}/bucket={k}" for k, version in enumerate(load.buckets)]


def bucket_of(symbol: Column | str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(symbol), F.lit(buckets)).cast("int")


def reload(
    raw: DataFrame,
    base: str,
    source: str | None = None,
    batch: int | None = None,
    carry_over: bool = False,
    rejected: DataFrame | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Replace raw and stage, and return the log row of this load. No raw rows is an error.

    Documents that could not be read, if given as ``rejected``, are stored and counted with the load.
    With ``carry_over`` a load of nothing but such documents is a load, too, and shows in the log.
    `load_documents` gets both from the documents at once, which are then read and parsed only once.

    The stage table is derived from the raw table as stored. With ``carry_over`` the stage of the newest load
    takes part: its rows stay unless newer ones came, and only buckets with symbols of this load are written.
    ``buckets`` counts for a table that starts anew.
    A ``batch`` of a ``source`` that has already been loaded is not loaded again. One load at a
    time may run on a base folder.
    """
    rows = raw.withColumn("kind", F.lit("raw"))
    if rejected is not None:
        rows = rows.unionByName(rejected.withColumn("kind", F.lit("rejected")), allowMissingColumns=True)
    return _load(rows, base, source, batch, carry_over, buckets, {})


def load_documents(
    documents: DataFrame,
    base: str,
    symbols: str | Sequence[str] | DataFrame | None = None,
    price_type: str = PRICE_TYPE,
    source: str | None = None,
    batch: int | None = None,
    carry_over: bool = False,
    buckets: int = BUCKETS,
) -> DataFrame:
    """`reload` from documents ``(SnapshotId, Document)``: each is read and parsed once, and one write deals its rows
    to the raw table or, if it can't be read, to the rejected ones.

    With ``symbols`` only quotes of these are loaded. The log row has the counters of the run:
    ``symbols_loaded`` (distinct ones asked for; null without ``symbols``), ``quotes_received`` (entries of all
    documents), ``raw_rows`` (inserted), ``rejected_rows`` and ``stage_rows``. Quotes and rows are counted
    on their way to the tables.
    """
    spark = documents.sparkSession
    with scope(spark):
        received = Observation("received")
        entries = sorted_entries(documents)
        entries = entries.observe(received, F.count_if(F.col("kind") == "raw").alias("quotes_received"))
        counters = {"quotes_received": lambda: received.get["quotes_received"]}
        if symbols is not None:
            wanted = materialize(as_symbols(spark, symbols).distinct(), "symbols")
            n = wanted.count()
            counters["symbols_loaded"] = lambda: n
            # Rejected documents have no symbol, and stay.
            met = entries.join(wanted.withColumn("_wanted", F.lit(True)), "Symbol", "left")
            entries = met.where(F.col("_wanted") | (F.col("kind") == "rejected")).select(entries.columns)
        rows = flatten(entries, price_type, keep=("Document", "kind"))
        return _load(rows, base, source, batch, carry_over, buckets, counters)


def _load(
    rows: DataFrame, base: str, source: str | None, batch: int | None, carry_over: bool, buckets: int, counters: dict
) -> DataFrame:
    """Store rows by their ``kind``, derive the stage from those stored as raw, and publish both."""
    spark = rows.sparkSession
    # One look at the log tells the newest load, and whether this batch has been loaded.
    same = (F.col("source") == source) & (F.col("batch") == batch) if source is not None else F.lit(False)
    log_rows = load_log(spark, base)
    known = log_rows.agg(
        F.max_by(F.struct(*log_rows.columns), "load_id").alias("newest"),
        F.max(F.when(same, F.col("load_id"))).alias("done"),
    ).first()
    if known.done is not None:
        return log_rows.where(F.col("load_id") == known.done)
    before = known.newest
    load_id = 0 if before is None else before.load_id + 1

    version = f"{load_id}-{uuid.uuid4().hex}"
    path = f"{base}/raw/{version}"
    seen = Observation("stored")
    of_kind = [F.count_if(F.col("kind") == kind).alias(kind) for kind in ("raw", "rejected")]
    rows.observe(seen, *of_kind).write.partitionBy("kind").parquet(path, compression=COMPRESSION)
    raw_rows, rejected_rows = seen.get["raw"], seen.get["rejected"]
    if raw_rows == 0 and not (carry_over and rejected_rows):
        files.delete(spark, path)
        raise NothingToLoad(f"no quotes to load, {rejected_rows} documents rejected")
    paths = {kind: f"{path}/kind={kind}" if n else None for kind, n in (("raw", raw_rows), ("rejected", rejected_rows))}

    old = before if carry_over else None
    versions, counts = (old.buckets, old.bucket_rows) if old else ([None] * buckets, [0] * buckets)
    stage_path, written = f"{base}/stage/{version}", {}
    if raw_rows:
        raw_columns = [field for field in rows.schema if field.name not in ("kind", "Document")]
        raw = spark.read.schema(type(rows.schema)(raw_columns)).parquet(paths["raw"])
        written = _write_stage(raw, stage_path, _bucket_paths(base, old) if old else [None] * buckets)
    versions = [version if k in written else x for k, x in enumerate(versions)]
    counts = [written.get(k, x) for k, x in enumerate(counts)]
    entry = {
        "load_id": load_id,
        "source": source,
        "batch": batch,
        "version": version,
        "raw_path": paths["raw"],
        "rejected_path": paths["rejected"],
        "stage_path": stage_path if written else None,
        "buckets": versions,
        "bucket_rows": counts,
        "symbols_loaded": None,
        "quotes_received": None,
        "raw_rows": raw_rows,
        "rejected_rows": rejected_rows,
        "stage_rows": sum(counts),
        "buckets_written": len(written),
    }
    log.append(spark, base, entry | {name: value() for name, value in counters.items()})
    return load_log(spark, base).where(F.col("load_id") == load_id)


def _write_stage(raw: DataFrame, path: str, old: list[str | None]) -> dict[int, int]:
    """Write the buckets that the symbols of ``raw`` fall into, merged with what these held; rows by bucket.

    ``old`` names the folders of all buckets, of which those that aren't touched are not read.
    """
    spark, bucket = raw.sparkSession, bucket_of("Symbol", len(old))
    with scope(spark):
        new = materialize(stage_quotes(raw), "stage")
        # No more rows than there are buckets.
        touched = [row.bucket for row in new.select(bucket.alias("bucket")).distinct().collect()]
        held = [old[k] for k in touched if old[k] is not None]
        merged = newer_of(spark.read.schema(new.schema).parquet(*held), new) if held else new
        if touched:
            merged.withColumn("bucket", bucket).repartition("bucket").write.partitionBy("bucket").parquet(path, compression=COMPRESSION)
    if not touched:
        return {}
    return {row.bucket: row["count"] for row in spark.read.parquet(path).groupBy("bucket").count().collect()}


def newer_of(old: DataFrame, new: DataFrame) -> DataFrame:
    """Of two stage tables, the newer row per symbol; of equally new ones that of ``new``."""
    rest = [name for name in new.columns if name != "Symbol"]
    sides = [df.select("Symbol", F.struct(*rest).alias(name)) for df, name in ((old, "old"), (new, "new"))]
    age = lambda side: F.struct(F.col(f"{side}.QuoteTime"), F.col(f"{side}.SnapshotId"))
    older = F.col("old").isNotNull() & (F.col("new").isNull() | (age("old") > age("new")))
    met = sides[0].join(sides[1], "Symbol", "full_outer")
    return met.select("Symbol", F.when(older, F.col("old")).otherwise(F.col("new")).alias("row")).select("Symbol", "row.*").select(new.columns)


def expire_loads(spark: SparkSession, base: str, keep: int = 1) -> int:
    """Forget all but the ``keep`` newest loads, and delete every table that no kept load names.

    That includes what failed loads left behind, and buckets of older loads that have been written anew. Returns how many
    tables went. Call it while no load runs and no reader uses older loads.
    """
    if keep < 1:
        raise ValueError("the newest load cannot be expired")
    kept = load_log(spark, base).orderBy(F.desc("load_id")).limit(keep).collect()
    if not kept:
        return 0
    rows = spark.createDataFrame(kept, log.LOG_SCHEMA)
    log.fold(spark, base, rows, kept[0].load_id + 1)
    files.delete_others(spark, f"{base}/loads", {str(kept[0].load_id + 1)})
    gone = files.delete_others(spark, f"{base}/raw", {load.version for load in kept})
    used = {(version, f"bucket={k}") for load in kept for k, version in enumerate(load.buckets) if version}
    used |= {(version, "_SUCCESS") for version, _ in used}
    gone += files.delete_others(spark, f"{base}/stage", {version for version, _ in used})
    for version in {version for version, _ in used}:
        files.delete_others(spark, f"{base}/stage/{version}", {name for owner, name in used if owner == version})
    return gone


def write_jdbc(df: DataFrame, url: str, table: str, batch_size: int = 10000, **options: str) -> None:
    """Replace the rows of a database table, which keeps its definition, in parallel batches."""
    writer = df.write.format("jdbc").mode("overwrite").option("truncate", True).option("batchsize", batch_size)
    writer.options(url=url, dbtable=table, **options).save()
