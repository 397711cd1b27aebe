"""Token files without an index: write them, and count the tokens of each document in them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Tokens of a block that is searched at once.
BLOCK = 1 << 20


def public_model(name: str = "piece_bpe_32k.model") -> str:
    """The place of a vocabulary file that is installed on all machines."""
    import public_tokenizers

    return public_tokenizers.path(name)


def write_tokens(
    documents: DataFrame,
    path: str,
    model: str | None = None,
    separator: int = 2,
    documents_per_file: int = 8000,
    text_column: str = "text",
) -> None:
    """Write the tokens of each text and then the ``separator`` as 16-bit numbers, low byte first.

    ``model`` is a SentencePiece file of fewer than 2 ** 16 pieces, in the same place on all machines;
    the separator must be one that texts never give, by default the end of a sentence. It closes each
    row of Spark's text files, so its two bytes must be ASCII. Null and empty texts have no tokens.
    """
    model = model or public_model()
    ending = separator.to_bytes(2, "little").decode("ascii")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        encoder = sentencepiece.SentencePieceProcessor(model_file=model)
        for batch in batches:
            for at in range(0, len(batch), 256):
                texts = batch.column(0).slice(at, 256).to_pylist()
                tokens = encoder.encode([text or "" for text in texts], num_threads=1)
                rows = [np.array(ids, "<u2").tobytes() for ids in tokens]
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["tokens"])

    rows = documents.select(F.col(text_column).cast("string")).mapInArrow(run, "tokens binary")
    writer = rows.select(F.col("tokens").cast("string")).write.option("lineSep", ending)
    writer.option("maxRecordsPerFile", documents_per_file).text(path)


def count_tokens(
    spark: SparkSession, path: str, separator: int = 2, token_bytes: int = 2, block: int = BLOCK
) -> DataFrame:
    """One row per document of the token files in ``path``: ``file``, ``document`` (its number in the
    file, from 0), ``first_token``, ``n_tokens`` and ``closed`` (false for a last one without a separator).

    Files hold numbers of ``token_bytes`` bytes, low byte first, and nothing else. Each file is cut into
    blocks; a block is searched for separators as an array. Documents that cross borders of blocks are
    stitched by prefix scans over the blocks of a file: the end of the last separator before a block,
    and the number of separators before it. Two separators in a row hold an empty document. Bytes at
    the end that make no whole token are ignored; an empty file has no documents.

    A task reads a file as a whole, up to the 2 GB that Spark reads as one value; blocks bound what the
    search needs beside it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                content = batch.column(1)[k].as_buffer()
                tokens = np.frombuffer(content, f"<u{token_bytes}", len(content) // token_bytes)
                for number, start in enumerate(range(0, len(tokens), block)):
                    part = tokens[start : start + block]
                    found = np.flatnonzero(part == separator) + start
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).slice(k, 1),
                            pa.array([number], pa.int64()),
                            pa.array([start + len(part)], pa.int64()),
                            pa.ListArray.from_arrays(pa.array([0, len(found)], pa.int32()), pa.array(found, pa.int64())),
                        ],
                        ["file", "block", "stop", "separators"],
                    )

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    blocks = files.mapInArrow(run, "file string, block long, stop long, separators array<long>")
    in_file = Window.partitionBy("file").orderBy("block")
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    scanned = blocks.select(
        "file",
        "separators",
        "stop",
        F.coalesce(F.max(F.get("separators", F.size("separators") - 1) + 1).over(before), F.lit(0)).alias("begin"),
        F.coalesce(F.sum(F.size("separators")).over(before), F.lit(0)).alias("number"),
        F.lead("block").over(in_file).isNull().alias("last"),
    )
    # A document begins after the separator before it, and the first of a block where the scan says.
    begins = F.concat(F.array("begin"), F.transform("separators", lambda at: at + 1))
    open_ = F.col("last") & (F.get(begins, F.size("separators")) < F.col("stop"))
    ends = F.when(open_, F.concat("separators", F.array("stop"))).otherwise(F.col("separators"))
    documents = scanned.select("file", "number", F.size("separators").alias("n"), begins.alias("begins"), F.posexplode(ends).alias("k", "end"))
    first = F.get("begins", F.col("k"))
    return documents.select(
        "file",
        (F.col("number") + F.col("k")).alias("document"),
        first.alias("first_token"),
        (F.col("end") - first).alias("n_tokens"),
        (F.col("k") < F.col("n")).alias("closed"),
    )
