"""The registered queries, each over the whole of its tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quoteflow.operators import (
    active_symbols,
    coarser_bars,
    explode_document_files,
    explode_documents,
    fewest_requests,
    flatten,
    get_symbols,
    history_bars,
    latest_quotes,
    missing_symbols,
    price_bars,
    price_history,
    quote_coverage,
    raw_quotes,
    rejected_documents,
    request_manifest,
    restrict_to_symbols,
)
from quoteflow.plans.history import load_history, read_history, read_rejected_history, write_history
from quoteflow.plans.load import load_documents, load_log, read_raw, read_rejected, read_stage, reload
from quoteflow.plans.workspace import materialize, new_folder
from quoteflow.session import configure
from quoteflow.sources import standins, stream_documents
from quoteflow.streaming import append_raw, run_loads

Query = Callable[[SparkSession, str], DataFrame]

START, END = "2024-01-05", "2024-01-20"
RAW = ["SnapshotId", "Symbol", "LastPrice", "BidPrice", "AskPrice", "QuoteTime"]
RECORDS_PER_FILE = 1_000_000


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standins.quote_documents(spark, sf_dir)


def portfolio_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return get_symbols(standins.portfolio_symbol(spark, sf_dir), 1)


def portfolio_symbols_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return active_symbols(standins.portfolio_symbol(spark, sf_dir))


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = request_manifest(portfolio_symbols_all(spark, sf_dir))
    return requests.select("PortfolioID", "bucket", "part", "n_symbols", "symbols", "fields")


def manifest_small(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = request_manifest(portfolio_symbols_all(spark, sf_dir), batch_size=20)
    return requests.select("PortfolioID", "bucket", "part", "n_symbols", "symbols", "fields")


def requests_fewest(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = fewest_requests(portfolio_symbols_all(spark, sf_dir), batch_size=20)
    return requests.select("PortfolioID", "request", "n_symbols", "symbols", "fields")


def quotes_one_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All quotes landed as a single response file, which many tasks read."""
    folder = new_folder(spark, "landed")
    lines = materialize(standins.one_document_lines(spark, sf_dir), "lines")
    ends = lines.agg(F.min("event_id").alias("low"), F.max("event_id").alias("high")).first()
    is_low, is_high = F.col("event_id").eqNullSafe(ends.low), F.col("event_id").eqNullSafe(ends.high)
    text = F.concat(F.when(is_low, "{").otherwise(","), "entry", F.when(is_high, "}").otherwise(""))
    # One response file is what is to be read here, so one task writes it. Only its ends have a place in an object; a sort would
    # hold all lines in that task.
    placed = lines.where(is_low).union(lines.where(~is_low & ~is_high)).union(lines.where(is_high & ~is_low))
    placed.coalesce(1).select(text.alias("value")).write.text(folder)
    entries, _ = explode_document_files(spark, folder)
    return flatten(entries).select("Symbol", "LastPrice", "BidPrice", "AskPrice", "QuoteTime")


def quotes_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_quotes(_documents(spark, sf_dir)).select(RAW)


def quotes_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_quotes(standins.mixed_documents(spark, sf_dir))
    is_quote = F.col("Symbol").rlike("^[SD]")
    return raw.select(*RAW, F.when(~is_quote, F.col("RawJson")).alias("OtherJson"))


def quote_time_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_quotes(standins.time_form_documents(spark, sf_dir))
    return raw.select("SnapshotId", "Symbol", "QuoteTime")


def quote_raw_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values read back out of RawJson, among them some that have no column of their own."""
    raw = raw_quotes(_documents(spark, sf_dir))
    return raw.select(
        "SnapshotId",
        "Symbol",
        F.get_json_object("RawJson", "$.fundamental.k").cast("bigint").alias("k"),
        F.get_json_object("RawJson", "$.quote.askPrice").cast("decimal(18,4)").alias("ask"),
        F.get_json_object("RawJson", "$.quote.tradeTime").cast("bigint").alias("trade_ms"),
    )


def rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected_documents(standins.damaged_documents(spark, sf_dir)).select("SnapshotId")


def accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_quotes(standins.damaged_documents(spark, sf_dir)).select(RAW)


def quotes_one_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = explode_documents(_documents(spark, sf_dir))
    return flatten(restrict_to_symbols(entries, "S1")).select(RAW)


def quotes_symbol_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = explode_documents(_documents(spark, sf_dir))
    return flatten(restrict_to_symbols(entries, ["S1", "S2", "S3", "none"])).select(RAW)


def portfolio_quote_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every quote of the symbols of portfolio 1; others are dropped before their fields are read."""
    entries = explode_documents(_documents(spark, sf_dir))
    return flatten(restrict_to_symbols(entries, portfolio_symbols(spark, sf_dir))).select(RAW)


def portfolio_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reduced to a row per symbol first: a symbol with very many quotes then meets no join."""
    newest = latest_quotes(raw_quotes(_documents(spark, sf_dir)))
    columns = newest.columns
    return restrict_to_symbols(newest, portfolio_symbols(spark, sf_dir)).select(columns)


def quotes_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_quotes(raw_quotes(_documents(spark, sf_dir)))


def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    quotes = explode_documents(_documents(spark, sf_dir))
    return quote_coverage(portfolio_symbols_all(spark, sf_dir), quotes)


def missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    quotes = explode_documents(_documents(spark, sf_dir))
    return missing_symbols(portfolio_symbols_all(spark, sf_dir), quotes)


def _loaded(spark: SparkSession, sf_dir: str) -> str:
    base = new_folder(spark, "load")
    reload(raw_quotes(_documents(spark, sf_dir)), base)
    return base


def quotes_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_stage(spark, _loaded(spark, sf_dir))


def quotes_stored_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_raw(spark, _loaded(spark, sf_dir)).select(RAW)


def portfolio_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole run for portfolio 1: its symbols, their quotes, a load, and the stage table of it."""
    return read_stage(spark, _portfolio_loaded(spark, sf_dir))


def _portfolio_loaded(spark: SparkSession, sf_dir: str) -> str:
    base = new_folder(spark, "load")
    load_documents(_documents(spark, sf_dir), base, symbols=portfolio_symbols(spark, sf_dir))
    return base


def load_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counters of the run for portfolio 1, as its load has logged them."""
    found = load_log(spark, _portfolio_loaded(spark, sf_dir))
    return found.select("load_id", "symbols_loaded", "quotes_received", "raw_rows", "rejected_rows", "stage_rows")


def quotes_reloaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads, of which the second replaces the first: raw rows of documents with odd snapshot numbers."""
    base = new_folder(spark, "load")
    documents = _documents(spark, sf_dir)
    for rest in (0, 1):
        reload(raw_quotes(documents.where(F.col("SnapshotId") % 2 == rest)), base)
    return read_raw(spark, base).select(RAW)


def quotes_reloaded_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of all documents, the second with later numbers and dearer quotes: raw rows of the second alone."""
    base = new_folder(spark, "load")
    documents = _documents(spark, sf_dir)
    reload(raw_quotes(documents), base)
    later = documents.select(
        (F.col("SnapshotId") + 1_000_000_000).alias("SnapshotId"),
        F.regexp_replace("Document", '"(last|bid|ask)Price":', '"$1Price":1').alias("Document"),
    )
    reload(raw_quotes(later), base)
    return read_raw(spark, base).select(RAW)


def _damaged_load(spark: SparkSession, sf_dir: str) -> str:
    base = new_folder(spark, "load")
    load_documents(standins.damaged_documents(spark, sf_dir), base)
    return base


def load_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_rejected(spark, _damaged_load(spark, sf_dir)).select("SnapshotId")


def load_summary_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = load_log(spark, _damaged_load(spark, sf_dir))
    return found.select("load_id", "raw_rows", "rejected_rows", "stage_rows")


def load_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_log(spark, _loaded(spark, sf_dir)).select("load_id", "raw_rows", "stage_rows")


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return price_history(standins.ticks(spark, sf_dir), START, END)


def history_one_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    return price_history(standins.ticks(spark, sf_dir), START, END, symbols="S1")


def history_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of landed responses; symbols without any are left out."""
    return history_bars(standins.history_documents(spark, sf_dir))


def history_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks written by day and symbol, and read back for some symbols and days."""
    base = new_folder(spark, "history")
    write_history(standins.ticks(spark, sf_dir), base)
    return read_history(spark, base, START, END, ["S1", "S2", "S3"]).select("Symbol", "ts", "TickId", "Price", "Volume")


def _history_loaded(spark: SparkSession, sf_dir: str) -> tuple[str, dict[str, int]]:
    base = new_folder(spark, "history")
    return base, load_history(standins.damaged_history(spark, sf_dir), base)


def history_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_rejected_history(spark, _history_loaded(spark, sf_dir)[0]).select("SnapshotId")


def history_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts of a load of history responses, some of them damaged."""
    _, counts = _history_loaded(spark, sf_dir)
    return spark.range(1).select(*[F.lit(n).cast("bigint").alias(name) for name, n in counts.items()])


def _bars(frequency: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return price_bars(history(spark, sf_dir), frequency, tie_breaker="TickId")

    return query


def _coarser(frequency: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        daily = materialize(_bars("daily")(spark, sf_dir), "daily")
        return coarser_bars(price_history(daily, START, END, day_column="bar_date"), frequency)

    return query


def quotes_stream_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents land as files, a stream appends their raw rows to a table."""
    folder = new_folder(spark, "stream")
    landed = _documents(spark, sf_dir).write.option("maxRecordsPerFile", RECORDS_PER_FILE)
    landed.parquet(f"{folder}/landed")
    documents = stream_documents(spark, f"{folder}/landed")
    append_raw(documents, f"{folder}/raw", f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/raw").select(RAW)


def quotes_stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents land in two lots that together are all of them; a stream runs a load after each."""
    folder = new_folder(spark, "stream")
    documents = _documents(spark, sf_dir)
    first = F.col("Document").contains('"quoteTime":"')
    for lot in (first, ~first):
        landed = documents.where(lot).write.mode("append").option("maxRecordsPerFile", RECORDS_PER_FILE)
        landed.parquet(f"{folder}/landed")
        arriving = stream_documents(spark, f"{folder}/landed")
        run_loads(arriving, f"{folder}/tables", f"{folder}/checkpoint").awaitTermination()
    return read_stage(spark, f"{folder}/tables")


QUERIES: dict[str, Query] = {
    "portfolio_symbols": portfolio_symbols,
    "portfolio_symbols_all": portfolio_symbols_all,
    "request_manifest": manifest,
    "request_manifest_small": manifest_small,
    "requests_fewest": requests_fewest,
    "quotes_raw": quotes_raw,
    "quotes_one_file": quotes_one_file,
    "quotes_mixed": quotes_mixed,
    "quote_time_forms": quote_time_forms,
    "quote_raw_json": quote_raw_json,
    "documents_rejected": rejected,
    "documents_accepted": accepted,
    "quotes_one_symbol": quotes_one_symbol,
    "quotes_symbol_list": quotes_symbol_list,
    "portfolio_quote_rows": portfolio_quote_rows,
    "portfolio_quotes": portfolio_quotes,
    "quotes_latest": quotes_latest,
    "quote_coverage": coverage,
    "quotes_missing": missing,
    "quotes_stage": quotes_stage,
    "quotes_stored_raw": quotes_stored_raw,
    "load_summary": load_summary,
    "portfolio_load": portfolio_load,
    "load_counters": load_counters,
    "quotes_reloaded": quotes_reloaded,
    "quotes_reloaded_whole": quotes_reloaded_whole,
    "load_rejects": load_rejects,
    "load_summary_damaged": load_summary_damaged,
    "price_history": history,
    "price_history_one_symbol": history_one_symbol,
    "price_history_documents": history_documents,
    "history_stored": history_stored,
    "history_rejects": history_rejects,
    "history_loaded": history_loaded,
    "price_bars_daily": _bars("daily"),
    "price_bars_weekly": _bars("weekly"),
    "price_bars_monthly": _bars("monthly"),
    "price_bars_weekly_from_daily": _coarser("weekly"),
    "price_bars_monthly_from_daily": _coarser("monthly"),
    "quotes_stream_raw": quotes_stream_raw,
    "quotes_stream_latest": quotes_stream_latest,
}


def queries() -> dict[str, Query]:
    """The queries, each of which first applies the settings it relies on."""

    def configured(query: Query) -> Query:
        return lambda spark, sf_dir: query(configure(spark), sf_dir)

    return {name: configured(query) for name, query in QUERIES.items()}
