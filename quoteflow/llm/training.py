"""Labelled rows to learn from, and hashed features of texts."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quoteflow.llm.words import Words


class Rows(NamedTuple):
    """Sparse rows: the features of row i are ``features[first[i]:first[i + 1]]``, each once."""

    features: np.ndarray
    first: np.ndarray

    def of(self) -> np.ndarray:
        """The row that each feature belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def sums(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.of(), values, len(self.first) - 1)

    def take(self, rows: np.ndarray) -> Rows:
        sizes = np.diff(self.first)[rows]
        first = np.concatenate([[0], np.cumsum(sizes)])
        at = np.arange(first[-1]) - np.repeat(first[:-1], sizes) + np.repeat(self.first[rows], sizes)
        return Rows(self.features[at], first)


def hashed(words: Words, bits: int) -> Rows:
    """The distinct hashed words, and beginnings of words, of each text."""
    texts, columns = words.texts(), [words.hashes, *words.prefixes]
    keys = []
    for k, hashes in enumerate(columns):
        used = hashes != 0
        bucket = ((hashes[used] ^ np.uint64(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) >> np.uint64(64 - bits)).astype(np.int64)
        keys.append((texts[used] << bits) | bucket)
    keys = np.sort(np.concatenate(keys))
    keys = keys[np.append(True, keys[1:] != keys[:-1])] if len(keys) else keys
    first = np.searchsorted(keys, np.arange(len(words.first)) << bits)
    return Rows(keys & ((1 << bits) - 1), first)


def held_out(id_column: Column) -> Column:
    """Rows kept from training: those whose id, as text, has a CRC-32 of remainder 2 by 4. Null is not held out."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, limit: int, id_column: str = "doc_id") -> DataFrame:
    """Documents with ``label`` (0 or 1) that may be learnt from, at most ``limit`` ids of them.

    Ids are taken in the order of a hash, so a sample is the same in each run. Rows whose id or label
    is null, or whose id is held out, are left out. If labels of an id differ, the larger one counts.
    Only the ids and labels, ``limit`` at most, are broadcast.
    """
    key = F.col(id_column)
    usable = labels.where(key.isNotNull() & F.col(label).isin(0, 1) & ~held_out(key))
    usable = usable.groupBy(key.alias("_id")).agg(F.max(label).cast("int").alias("_label"))
    usable = usable.orderBy(F.xxhash64("_id"), "_id").limit(limit)
    return documents.join(F.broadcast(usable), documents[id_column] == usable["_id"]).drop("_id")


def one_text_each(sample: DataFrame, id_column: str, text_column: str, others: Sequence[str] = ()) -> DataFrame:
    """Of each id of a `labelled_sample` the row whose text has the smallest hash: ``id``, ``row.label``, ``row.text`` and
    ``row.others``, numbers. So a sample has no more rows than ids, whatever repeats them."""
    text = F.col(text_column).cast("string")
    numbers = F.array(*[F.col(name).cast("double") for name in others]) if others else F.lit(None)
    row = F.struct(F.col("_label").alias("label"), text.alias("text"), numbers.alias("others"))
    # Rows of equal texts go by their other columns.
    order = F.struct(F.xxhash64(text), text, numbers.alias("others"))
    return sample.groupBy(F.col(id_column).alias("id")).agg(F.min_by(row, order).alias("row"))


def packed(rows: Rows) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(rows.first, pa.int32()), pa.array(rows.features, pa.int32()))


def unpacked(column: pa.ChunkedArray) -> Rows:
    """The rows of a list column that was collected."""
    lists = pa.concat_arrays([chunk for chunk in column.chunks]) if column.num_chunks else pa.array([], pa.list_(pa.int32()))
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False) if len(lists) else np.zeros(0, np.int64)
    return Rows(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64))


# Steps that a fit takes at least; few rows are gone through more often.
LEAST_STEPS = 800


def batches_of(n: int, size: int, epochs: int, seed: int) -> Iterator[np.ndarray]:
    """Row numbers in random order, ``size`` at a time, for at least `LEAST_STEPS` batches."""
    draw = np.random.default_rng(seed)
    for _ in range(max(epochs, LEAST_STEPS // -(-n // size))):
        order = draw.permutation(n)
        for at in range(0, n, size):
            yield order[at : at + size]


def sigmoid(values: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(values, -30, 30)))
