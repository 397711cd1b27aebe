"""Operators: each takes and returns DataFrames."""

from quoteflow.operators.bars import coarser_bars, history_bars, price_bars, price_history, rejected_history, sorted_history
from quoteflow.operators.coverage import fewest_requests, missing_symbols, quote_coverage, request_manifest
from quoteflow.operators.latest import fetched_stage, latest_quotes, stage_quotes
from quoteflow.operators.quotes import (
    explode_documents,
    flatten,
    raw_quotes,
    rejected_documents,
    sorted_entries,
)
from quoteflow.operators.split_scan import explode_document_files
from quoteflow.operators.symbols import (
    active_symbols,
    as_symbols,
    get_symbols,
    require_rows,
    restrict_to_symbols,
)

__all__ = [
    "active_symbols",
    "as_symbols",
    "coarser_bars",
    "explode_document_files",
    "explode_documents",
    "fetched_stage",
    "fewest_requests",
    "flatten",
    "get_symbols",
    "history_bars",
    "latest_quotes",
    "missing_symbols",
    "price_bars",
    "price_history",
    "quote_coverage",
    "raw_quotes",
    "rejected_documents",
    "rejected_history",
    "request_manifest",
    "require_rows",
    "restrict_to_symbols",
    "sorted_entries",
    "sorted_history",
    "stage_quotes",
]
