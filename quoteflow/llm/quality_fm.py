"""Quality scores by a factorisation machine over hashed words, structure and metadata."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quoteflow.llm.training import Rows, batches_of, hashed, labelled_sample, one_text_each, packed, sigmoid, unpacked
from quoteflow.llm.words import ALPHANUMERIC, find_words, pieces

BITS = 16
BINS = 24
# Kinds of bytes whose shares are features.
KINDS = {
    "capitals": bytes(range(65, 91)),
    "small": bytes(range(97, 123)),
    "digits": b"0123456789",
    "symbols": b"#*$%&|<>",
    "stops": b".!?",
    "pauses": b",;:",
    "exclamations": b"!",
    "bars": b"|",
    "spaces": b" \t\n\x0b\f\r",
    "lines": b"\n",
    "brackets": b"()[]{}",
    "beyond": bytes(range(128, 256)),
}
N_STATISTICS = len(KINDS) + 7


class Model(NamedTuple):
    bias: float
    linear: np.ndarray
    factors: np.ndarray
    n_metadata: int


def _binned(shares: np.ndarray) -> np.ndarray:
    """Bins of equal ratio from 2 ** -12 to 1, and one for less."""
    return np.clip(np.floor(2 * np.log2(np.maximum(shares, 1e-9)) + BINS), 0, BINS - 1).astype(np.int64)


def statistics(data: np.ndarray, offsets: np.ndarray, words, distinct: np.ndarray) -> np.ndarray:
    """A line of bins per text: shares of kinds of bytes, sizes, and how many words are new."""
    n_bytes = np.maximum(np.diff(offsets), 1)
    columns = []
    for kind in KINDS.values():
        table = np.zeros(256, np.uint8)
        table[list(kind)] = 1
        running = np.concatenate([[0], np.cumsum(table[data], dtype=np.int64)])
        columns.append(np.diff(running[offsets]))
    counts = np.array(columns)
    n_words = words.counts()
    lengths = np.concatenate([[0], np.cumsum(words.ends - words.starts)])
    mean_length = np.diff(lengths[words.first]) / np.maximum(n_words, 1)
    lines = counts[list(KINDS).index("lines")] + 1
    sizes = np.log2(1 + np.array([n_bytes, n_words])) / 20
    ratios = np.array(
        [
            mean_length / 40,
            n_words / lines / 200,
            distinct / np.maximum(n_words, 1),
            _repeats(words, 1) / np.maximum(n_words, 1),
            _repeats(words, 2) / np.maximum(n_words, 1),
        ]
    )
    return np.concatenate([_binned(counts / n_bytes), np.clip(sizes * BINS, 0, BINS - 1).astype(np.int64), _binned(ratios)]).T


def _repeats(words, distance: int) -> np.ndarray:
    """Words of each text that equal the word so far before them."""
    texts = words.texts()
    same = (words.hashes[distance:] == words.hashes[:-distance]) & (texts[distance:] == texts[:-distance])
    return np.bincount(texts[distance:][same], minlength=len(words.first) - 1)


def features(data: np.ndarray, offsets: np.ndarray, metadata: np.ndarray) -> Rows:
    """Buckets of words, then of statistics and of metadata (numbers; NaN is a value of its own)."""
    words = find_words(data, offsets, ALPHANUMERIC)
    named = hashed(words, BITS)
    bins = statistics(data, offsets, words, np.diff(named.first))
    magnitude = np.where(np.isnan(metadata), BINS - 1, np.clip(np.log2(1 + np.abs(np.nan_to_num(metadata))), 0, BINS - 2))
    bins = np.concatenate([bins, magnitude.astype(np.int64)], 1)
    extra = (1 << BITS) + np.arange(bins.shape[1]) * BINS + bins
    first = named.first + np.arange(len(named.first)) * bins.shape[1]
    out = np.empty(first[-1], np.int64)
    at = np.ones(len(out), bool)
    places = first[1:, None] - bins.shape[1] + np.arange(bins.shape[1])
    at[places.ravel()] = False
    out[at] = named.features
    out[places.ravel()] = extra.ravel()
    return Rows(out, first)


def _values(rows: Rows, n_extra: int) -> np.ndarray:
    """The value of each feature: 1 for statistics, and for words such that their squares add up to 1."""
    n_words = np.diff(rows.first) - n_extra
    return np.where(rows.features < 1 << BITS, np.repeat(1 / np.sqrt(np.maximum(n_words, 1)), np.diff(rows.first)), 0.3)


def scores(model: Model, rows: Rows) -> np.ndarray:
    """Log odds. The sum over pairs of features is half of (square of the sum - sum of the squares), per factor."""
    values = _values(rows, N_STATISTICS + model.n_metadata)
    starts = rows.first[:-1]
    weighted = model.factors[rows.features] * values[:, None]
    sums = np.add.reduceat(weighted, starts, 0)
    squares = np.add.reduceat((weighted * weighted).sum(1), starts)
    linear = np.add.reduceat(model.linear[rows.features] * values, starts)
    return model.bias + linear + 0.5 * ((sums * sums).sum(1) - squares)


def fit(rows: Rows, labels: np.ndarray, n_metadata: int, rank: int, epochs: int, seed: int) -> Model:
    """Stochastic gradients with a step per parameter, on logistic loss."""
    n = (1 << BITS) + (N_STATISTICS + n_metadata) * BINS
    draw = np.random.default_rng(seed)
    model = Model(0.0, np.zeros(n), draw.normal(0, 0.02, (n, rank)), n_metadata)
    if not len(labels) or labels.min() == labels.max():
        return model._replace(bias=float(4 * labels.mean() - 2) if len(labels) else 0.0)
    share = labels.mean()
    bias, bias_seen = float(np.log(share / (1 - share))), 1.0
    seen, seen_factors = np.full(n, 0.1), np.full((n, rank), 0.1)
    for chosen in batches_of(len(labels), 128, epochs, seed):
        part = rows.take(chosen)
        of, features_ = part.of(), part.features
        values = _values(part, N_STATISTICS + n_metadata)
        error = (sigmoid(scores(model._replace(bias=bias), part)) - labels[chosen]) / len(chosen)
        weighted = model.factors[features_] * values[:, None]
        sums = np.add.reduceat(weighted, part.first[:-1], 0)
        slope = error[of] * values
        used, at = np.unique(features_, return_inverse=True)
        step = np.bincount(at, slope) + 1e-5 * model.linear[used]
        seen[used] += step * step
        model.linear[used] -= 0.2 * step / np.sqrt(seen[used])
        for f in range(rank):
            step = np.bincount(at, slope * (sums[of, f] - weighted[:, f])) + 1e-5 * model.factors[used, f]
            seen_factors[used, f] += step * step
            model.factors[used, f] -= 0.05 * step / np.sqrt(seen_factors[used, f])
        bias_seen += error.sum() ** 2
        bias -= 0.2 * error.sum() / np.sqrt(bias_seen)
    return model._replace(bias=bias, linear=model.linear.astype(np.float32), factors=model.factors.astype(np.float32))


def _metadata(batch: pa.RecordBatch, begin: int, at: int, n: int) -> np.ndarray:
    columns = [batch.column(k).slice(at, n).to_numpy(zero_copy_only=False).astype(float) for k in range(begin, batch.num_columns)]
    return np.array(columns).reshape(len(columns), n).T


def train_quality(
    documents: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    limit: int = 6000,
    metadata: Sequence[str] = ("n_chars",),
    rank: int = 8,
    epochs: int = 20,
    seed: int = 7,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> Model:
    """Learn from at most ``limit`` labelled documents that are not held out (`labelled_sample`).

    Of an id with several texts the one of the smallest hash counts, so there are ``limit`` documents at most.
    Features are worked out in tasks; the driver gets bucket numbers of these documents only.
    Without labels of both kinds the model gives one score to all.
    """
    sample = one_text_each(labelled_sample(documents, labels, label, limit, id_column), id_column, text_column, metadata)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, offsets in pieces(batch.column(2)):
                n = len(offsets) - 1
                rows = features(data, offsets, _metadata(batch, 3, at, n))
                columns = [batch.column(0).slice(at, n), batch.column(1).slice(at, n), packed(rows)]
                yield pa.RecordBatch.from_arrays(columns, ["key", "label", "features"])

    numbers = [F.col("row.others")[k].alias(f"m{k}") for k in range(len(metadata))]
    columns = sample.select(F.xxhash64("id"), "row.label", "row.text", *numbers)
    found = columns.mapInArrow(run, "key long, label int, features array<int>").toArrow().sort_by("key")
    return fit(unpacked(found["features"]), found["label"].to_numpy().astype(float), len(metadata), rank, epochs, seed)


def score_quality(
    documents: DataFrame,
    model: Model,
    metadata: Sequence[str] = ("n_chars",),
    threshold: float = 0.7,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The id, ``score`` (0 to 1, higher for better texts) and ``predicted`` (1 from ``threshold`` on) of each row.

    Whole texts are scored in time that grows with their length. A null or empty text is scored by its
    statistics and metadata, null metadata are a value of their own, and rows that repeat get equal
    scores. Other columns, whatever their names, are left out. There is no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, offsets in pieces(batch.column(1)):
                n = len(offsets) - 1
                found = sigmoid(scores(model, features(data, offsets, _metadata(batch, 2, at, n))))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, n), pa.array(found, pa.float64())], ["id", "score"])

    numbers = [F.col(name).cast("double") for name in metadata]
    columns = documents.select(F.col(id_column), F.col(text_column).cast("string"), *numbers)
    kind = documents.schema[id_column].dataType.simpleString()
    scored = columns.mapInArrow(run, f"id {kind}, score double")
    return scored.select(F.col("id").alias(id_column), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
