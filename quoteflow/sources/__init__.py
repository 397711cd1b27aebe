"""Readers: portfolio membership, landed quote documents, price ticks."""

from quoteflow.sources.documents import (
    LANDED_SCHEMA,
    read_document_files,
    read_documents,
    stream_document_files,
    stream_documents,
)
from quoteflow.sources.portfolio import PORTFOLIO_SCHEMA, jdbc_options, read_portfolio, read_portfolio_jdbc
from quoteflow.sources.ticks import TICK_SCHEMA, read_ticks

__all__ = [
    "LANDED_SCHEMA",
    "PORTFOLIO_SCHEMA",
    "TICK_SCHEMA",
    "jdbc_options",
    "read_document_files",
    "read_documents",
    "read_portfolio",
    "read_portfolio_jdbc",
    "read_ticks",
    "stream_document_files",
    "stream_documents",
]
