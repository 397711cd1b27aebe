"""Documents that keep arriving: append their raw rows, or run a load per batch of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from quoteflow.operators.quotes import PRICE_TYPE, raw_quotes, rejected_documents
from quoteflow.plans.load import NothingToLoad, load_documents


def _trigger(every: str | None) -> dict:
    return {"availableNow": True} if every is None else {"processingTime": every}


def append_raw(
    documents: DataFrame, raw_path: str, checkpoint: str, every: str | None = None, price_type: str = PRICE_TYPE
) -> StreamingQuery:
    """Append the raw rows of new documents to a Parquet table, each exactly once.

    Documents that can't be read give no rows; run ``append_rejected`` beside it to keep them.

    There is no state and no shuffle. Takes what has arrived so far, then stops, and a later run
    with the same checkpoint goes on from there; with ``every``, say "1 minute", it keeps running.
    """
    return _append(raw_quotes(documents, price_type), raw_path, checkpoint, every)


def append_rejected(documents: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append new documents that can't be read to a Parquet table, like ``append_raw``, with a checkpoint of its own."""
    return _append(rejected_documents(documents), path, checkpoint, every)


def _append(rows: DataFrame, path: str, checkpoint: str, every: str | None) -> StreamingQuery:
    return (
        rows.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .trigger(**_trigger(every))
        .start()
    )


def run_loads(
    documents: DataFrame, base: str, checkpoint: str, every: str | None = None, price_type: str = PRICE_TYPE
) -> StreamingQuery:
    """A load per batch of new documents; symbols without news keep their stage rows.

    Files may arrive in any order: the newer quote wins by the time inside it. A batch that is run
    again after a failure loads nothing twice; an empty one is passed over. Documents that can't be
    read are stored and counted with the load of their batch. Each batch is parsed once, rewrites the
    buckets of the stage that its symbols fall into, and leaves no intermediate table. Stops and goes on like ``append_raw``.
    """

    def load(batch: DataFrame, number: int) -> None:
        try:
            load_documents(batch, base, price_type=price_type, source=checkpoint, batch=number, carry_over=True)
        except NothingToLoad:
            pass

    return (
        documents.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(every))
        .start()
    )
