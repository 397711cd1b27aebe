"""Toxicity scores that don't hang on which group a sentence mentions."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quoteflow.llm.training import Rows, batches_of, hashed, labelled_sample, packed, sigmoid, unpacked
from quoteflow.llm.words import ALPHANUMERIC, find_words, pieces
from quoteflow.plans.workspace import materialize

BITS = 18
# Lengths in bytes of beginnings of words that are features, so that inflected forms share weights.
PREFIXES = (3, 4, 5, 6, 7, 8)
# Features of fewer documents of the sample get no weight.
LEAST_DOCUMENTS = 5
# Pairs of sentences that a fit gets at most.
PAIRS = 20_000
# Names of groups of people; those of a line stand for each other.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "arab", "african", "european"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("frauen", "männer", "mädchen", "jungen"),
    ("muslime", "christen", "juden"),
    ("ausländer", "flüchtlinge", "einheimische"),
    ("femmes", "hommes", "filles", "garçons"),
    ("musulmans", "chrétiens", "juifs"),
    ("mujeres", "hombres", "niñas", "niños"),
    ("musulmanes", "cristianos", "judíos"),
)


class Model(NamedTuple):
    bias: float
    weights: np.ndarray


def features(data: np.ndarray, offsets: np.ndarray) -> Rows:
    return hashed(find_words(data, offsets, ALPHANUMERIC, PREFIXES), BITS)


def scores(model: Model, rows: Rows) -> np.ndarray:
    return model.bias + rows.sums(model.weights[rows.features])


def swapped(text: str, terms: Sequence[Sequence[str]] = IDENTITY_TERMS) -> list[tuple[str, str]]:
    """Each sentence that names a group, with the same sentence about the next group of its line."""
    following = {term: line[(k + 1) % len(line)] for line in terms for k, term in enumerate(line)}
    word = re.compile(r"\b(" + "|".join(sorted(map(re.escape, following), key=len, reverse=True)) + r")\b", re.IGNORECASE)
    pairs = []
    for sentence in re.split(r"(?<=[.!?])\s+|\n", text):
        other = word.sub(lambda found: following[found[0].lower()], sentence)
        if other != sentence:
            pairs.append((sentence, other))
    return pairs


def fit(
    rows: Rows, labels: np.ndarray, one: Rows, two: Rows, penalty: float, epochs: int = 10, sparsity: float = 0.3, seed: int = 5
) -> Model:
    """Sparse logistic weights (proximal gradients with a step per weight).

    Beside the logistic loss of ``labels`` it counts ``penalty`` times the squared difference in log odds
    between the sentences ``one`` and their swapped counterparts ``two``.
    """
    n = 1 << BITS
    # What few documents hold can't be told from chance; forms of a word count through their beginnings.
    common = np.bincount(rows.features, minlength=n) >= LEAST_DOCUMENTS
    if not len(labels) or labels.min() == labels.max():
        return Model(float(6 * labels.mean() - 3) if len(labels) else -3.0, np.zeros(n, np.float32))
    gradients, squares, weights = np.zeros(n), np.zeros(n), np.zeros(n)
    bias, bias_seen = float(np.log(labels.mean() / (1 - labels.mean()))), 1.0
    rate, smooth = 0.5, 0.1
    draw = np.random.default_rng(seed)
    n_pairs = len(one.first) - 1
    for chosen in batches_of(len(labels), 64, epochs, seed):
        part = rows.take(chosen)
        error = (sigmoid(bias + part.sums(weights[part.features])) - labels[chosen]) / len(chosen)
        known = common[part.features]
        used, slopes = [part.features[known]], [error[part.of()][known]]
        if n_pairs:
            pick = draw.integers(0, n_pairs, min(n_pairs, 64))
            a, b = one.take(pick), two.take(pick)
            change = (a.sums(weights[a.features]) - b.sums(weights[b.features])) * 2 * penalty / len(pick)
            for side, slope in ((a, change[a.of()]), (b, -change[b.of()])):
                known = common[side.features]
                used.append(side.features[known])
                slopes.append(slope[known])
        keys, at = np.unique(np.concatenate(used), return_inverse=True)
        step = np.bincount(at, np.concatenate(slopes))
        grown = squares[keys] + step * step
        gradients[keys] += step - (np.sqrt(grown) - np.sqrt(squares[keys])) / rate * weights[keys]
        squares[keys] = grown
        size = np.abs(gradients[keys])
        weights[keys] = np.where(
            size <= sparsity, 0, -np.sign(gradients[keys]) * (size - sparsity) / ((smooth + np.sqrt(grown)) / rate)
        )
        bias_seen += error.sum() ** 2
        bias -= 0.1 * error.sum() / np.sqrt(bias_seen)
    return Model(bias, weights.astype(np.float32))


def train_toxicity(
    documents: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    limit: int = 6000,
    penalty: float = 1.0,
    terms: Sequence[Sequence[str]] = IDENTITY_TERMS,
    id_column: str = "doc_id",
    text_column: str = "text",
    most_pairs: int = PAIRS,
) -> Model:
    """Learn from at most ``limit`` labelled documents that are not held out (`labelled_sample`).

    Of an id with several texts the one of the smallest hash counts, so there are ``limit`` documents at
    most. Sentences of these documents that name a group of ``terms`` are paired with the same sentence about
    another group, and differences in score between them are penalised: at most ``most_pairs`` pairs, chosen
    among those of all sentences in the order of a hash. The driver gets bucket numbers of these documents
    and pairs. Without labels of both kinds the model gives one score to all.
    """
    sample = labelled_sample(documents, labels, label, limit, id_column)
    text = F.col(text_column).cast("string")
    row = F.struct(F.col("_label").alias("label"), text.alias("text"))
    sample = sample.groupBy(F.col(id_column).alias("id")).agg(F.min_by(row, F.struct(F.xxhash64(text), text)).alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "label", "one", "two"]
        for batch in batches:
            for at, data, offsets in pieces(batch.column(2)):
                n = len(offsets) - 1
                keys, label_column = batch.column(0).slice(at, n), batch.column(1).slice(at, n)
                empty = pa.array([None] * n, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([keys, label_column, packed(features(data, offsets)), empty], names)
                pairs = [pair for text in batch.column(2).slice(at, n).to_pylist() for pair in swapped(text or "", terms)]
                if pairs:
                    one, two = ([_texts(side) for side in zip(*pairs)])
                    keys = pa.array([_hash(sentence) for sentence, _ in pairs], pa.int64())
                    yield pa.RecordBatch.from_arrays([keys, pa.nulls(len(pairs), pa.int32()), one, two], names)

    columns = sample.select(F.xxhash64("id"), "row.label", "row.text")
    found = columns.mapInArrow(run, "key long, label int, one array<int>, two array<int>")
    found = materialize(found, "sample")
    documents_ = found.where("label IS NOT NULL").select("key", "label", "one").toArrow().sort_by("key")
    pairs = found.where("label IS NULL").orderBy("key", "one", "two").limit(most_pairs).select("one", "two").toArrow()
    return fit(
        unpacked(documents_["one"]),
        documents_["label"].to_numpy().astype(float),
        unpacked(pairs["one"]),
        unpacked(pairs["two"]),
        penalty,
    )


def _hash(sentence: str) -> int:
    return int.from_bytes(hashlib.blake2b(sentence.encode(), digest_size=8).digest(), "big", signed=True)


def _texts(texts: Sequence[str]) -> pa.Array:
    """Features of some texts."""
    found = [packed(features(data, offsets)) for _, data, offsets in pieces(pa.array(texts, pa.string()))]
    return pa.concat_arrays(found)


def score_toxicity(
    documents: DataFrame, model: Model, threshold: float = 0.3, text_column: str = "text"
) -> DataFrame:
    """``documents`` with ``score`` (0 to 1, higher for toxic texts) and ``predicted`` (1 from ``threshold`` on).

    Whole texts are scored. A null or empty text gets the score of no words at all; rows that repeat
    get equal scores. Columns of the input with a name that is added here are replaced. There is no shuffle.
    """
    columns = [name for name in documents.columns if name not in ("score", "predicted")]
    weights = np.flatnonzero(model.weights)
    values = model.weights[weights]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full = np.zeros(1 << BITS, np.float32)
        full[weights] = values
        for batch in batches:
            found = [
                sigmoid(scores(Model(model_bias, full), features(data, offsets)))
                for _, data, offsets in pieces(batch.column(1))
            ]
            score = pa.array(np.concatenate(found) if found else np.zeros(0), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.column(0).flatten(), score], [*columns, "score"])

    model_bias = model.bias
    kept = documents.select(*columns)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema), "score double"])
    # Columns of the input travel in one, so that their names can't clash with those used here.
    row = F.struct(*[F.col(f"`{name}`") for name in columns]).alias("row")
    scored = kept.select(row, F.col(text_column).cast("string").alias("read")).mapInArrow(run, schema)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
