"""Candidates for leaked secrets, and a random forest that removes false positives among them."""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quoteflow.plans.workspace import materialize

# A candidate: characters of keys and tokens in a row; assignments and quotes part them.
CANDIDATE = re.compile(r"[A-Za-z0-9_\-+/.@~]{12,}")
# Words that stand before secrets, and those that stand before what only looks like one.
KEY_WORDS = (
    "password passwd pwd secret token key apikey api_key access auth bearer credential credentials private signature".split()
)
# As a part of a name only; other words end with it.
KEY_PARTS = ("pass", "passphrase", "pin")
PLAIN_WORDS = "commit sha md5 sha1 sha256 checksum hash uuid version http https example test sample digest rev revision".split()
# A name before a sign of assignment, with what may close a string or an index between them.
_NAME = re.compile(r"(?<![A-Za-z0-9_\-])([A-Za-z0-9_\-]++)[\"'`\]\\)]*+\s*+(?::=|=>|={1,3}|:(?!:))\s*+")
# A token behind the name of its scheme, without a sign of assignment.
_SCHEME = re.compile(r"\b(?:bearer|basic)[ \t]+([A-Za-z0-9_\-+/.=~]{8,})", re.IGNORECASE)
_ARMOUR = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]{1,40})-----")
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
# A second sign of assignment, as after the type in ``password: str = "..."``.
_AGAIN = re.compile(r"[ \t]*+=(?!=)\s*+")
_OPEN = re.compile(r"[bBrRuUfF@$]?(\"\"\"|'''|\\?[\"'`])")
_CLOSED = {
    quote: re.compile(rf"((?:(?!{re.escape(quote)})(?:\\.|.))++){re.escape(quote)}", re.DOTALL)
    for quote in ('"""', "'''", '"', "'", "`", '\\"', "\\'", "\\`")
}
_TO_SPACE, _TO_SEPARATOR = re.compile(r"(?:[\"'`]\s++)?\S+"), re.compile(r"[^\s&;,]+")
# Common beginnings of issued keys.
ISSUED = ("AKIA", "ASIA", "ghp_", "gho_", "glpat-", "xoxb-", "xoxp-", "sk_live_", "sk-", "AIza", "eyJ", "SG.")
# Parts of paths of files that rarely hold live secrets.
PATH_PARTS = ("test", "spec", "mock", "fixture", "example", "sample", "doc", "vendor", "lock")
FEATURES = (
    "length upper lower digit other changes longest_run entropy hexadecimal dictionary issued at_sign "
    "key_before plain_before assigned quoted path_hint path_known words_before words_after armoured transitions"
).split()
_KINDS = np.zeros(128, np.int8)
_KINDS[65:91], _KINDS[97:123], _KINDS[48:58] = 1, 2, 3
_SYLLABLES = re.compile(r"[a-z]*[aeiouy][a-z]*")
# Words of a dictionary, at most: those of the most documents.
DICTIONARY = 20_000
# What transitions are learnt between: small letters, digits as one, capitals as one, all else as one.
_SYMBOLS = 29


def _symbols(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    kinds = np.where(codes < 128, _KINDS[codes & 127], 0)
    return np.select([kinds == 2, kinds == 3, kinds == 1], [codes.astype(np.int64) - 97, 26, 27], 28)


class Language(NamedTuple):
    """The commonest ``words`` of a corpus, and the log odds of transitions between characters in them against chance."""

    words: frozenset[str]
    odds: np.ndarray

    def transitions(self, text: str) -> float:
        """The mean of the log odds over the text: above 0 for what reads like words of the corpus."""
        symbols = _symbols(text)
        return float(self.odds[symbols[:-1], symbols[1:]].mean()) if len(symbols) > 1 else 0.0


def _language(words: Sequence[str], counts: Sequence[int]) -> Language:
    seen = np.ones((_SYMBOLS, _SYMBOLS))
    for word, count in zip(words, counts):
        symbols = _symbols(word)
        # Of common words the form counts more often, but not in proportion.
        np.add.at(seen, (symbols[:-1], symbols[1:]), math.log1p(count))
    return Language(frozenset(words), np.log(seen / seen.sum(1, keepdims=True) * _SYMBOLS))


def learn_language(documents: DataFrame, text_column: str = "text", limit: int = DICTIONARY, least: int = 3) -> Language:
    """The ``limit`` words of a to z, three letters or more, that most documents have, ``least`` at least, and their transitions.

    All documents are counted, a word once in each. Tasks count before the shuffle; the driver gets ``limit`` words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Counter()
        for batch in batches:
            for at in range(0, len(batch), 500):
                for text in batch.column(0).slice(at, 500).to_pylist():
                    held.update(set(re.findall(r"\b[a-z]{3,40}\b", text or "")))
                if len(held) > 300_000:
                    yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])
                    held = Counter()
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

    counted = documents.select(F.col(text_column).cast("string")).mapInArrow(run, "word string, n long")
    counted = counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    rows = counted.orderBy(F.desc("n"), "word").limit(limit).collect()
    return _language([row.word for row in rows], [row.n for row in rows])


def _dictionary(candidate: str, known: frozenset[str], language: Language | None) -> float:
    """Share of characters in parts of letters that are words of the text itself or of the corpus.

    Without a language, what reads like a word counts, too.
    """
    covered = 0
    for part in re.findall(r"[A-Z]?[a-z]{3,}|[A-Z]{4,}", candidate):
        word = part.lower()
        if word in known or (language is not None and word in language.words):
            covered += len(part)
        elif language is None and len(word) >= 4 and 0.2 <= sum(c in "aeiouy" for c in word) / len(word) <= 0.6 and _SYLLABLES.fullmatch(word):
            covered += len(part)
    return covered / len(candidate)


def describe(
    candidate: str, before: str, after: str, path: str | None, known: frozenset[str], language: Language | None = None
) -> list[float]:
    """The numbers of `FEATURES` for a candidate in its neighbourhood."""
    codes = np.frombuffer(candidate.encode("utf-32-le"), np.uint32)
    kinds = np.where(codes < 128, _KINDS[codes & 127], 0)
    n = len(candidate)
    changes = np.flatnonzero(kinds[1:] != kinds[:-1])
    runs = np.diff(np.concatenate([[-1], changes, [n - 1]]))
    counts = Counter(candidate)
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
    near = re.findall(r"[a-z_0-9]+", before.lower())[-3:]
    follow = re.findall(r"[a-z_0-9]+", after.lower())[:3]
    path = (path or "").lower()
    return [
        float(n),
        *[float((kinds == k).mean()) for k in (1, 2, 3, 0)],
        len(changes) / n,
        float(runs.max()) / n,
        entropy,
        sum(c in "0123456789abcdefABCDEF" for c in candidate) / n,
        _dictionary(candidate, known, language),
        float(candidate.startswith(ISSUED)),
        float("@" in candidate),
        float(any(word in near for word in KEY_WORDS)),
        float(any(word in near for word in PLAIN_WORDS)),
        float(bool(re.search(r"[=:]>?\s*[bBrRuUfF@$]?(\"\"\"|'''|\\?[\"'`])?$", before))),
        float(before[-1:] in "\"'" and before != "" and after[:1] in "\"'" and after != ""),
        float(any(part in path for part in PATH_PARTS)),
        float(path != ""),
        sum(word in known for word in near) / 3,
        sum(word in known for word in follow) / 3,
        float(candidate.startswith("-----BEGIN ")),
        language.transitions(candidate) if language is not None else 0.0,
    ]


def _is_key(name: str) -> bool:
    parts = [part.lower() for part in _PARTS.findall(name)]
    return any(part in KEY_WORDS or part in KEY_PARTS for part in parts) or name.lower().endswith(tuple(KEY_WORDS))


def _assigned(text: str, begin: int, end: int, bare: re.Pattern[str] = _TO_SPACE) -> Iterator[tuple[int, int]]:
    """(start, end) of values assigned to names with a key word: up to the closing quote, else up to white space.

    Values in values count, too: those in quotes in other quotes, and those of a list parted by ``&``, ``;`` or ``,``.
    """
    while found := _NAME.search(text, begin, end):
        begin = found.end()
        if not _is_key(found[1]):
            continue
        while begin < end:
            opened = _OPEN.match(text, begin, end)
            closed = opened and _CLOSED[opened[1]].match(text, opened.end(), end)
            if closed:
                yield closed.span(1)
                yield from _assigned(text, *closed.span(1))
                begin = closed.end()
            elif opened and text.startswith(opened[1], opened.end(), end):
                begin = opened.end() + len(opened[1])
            else:
                # What begins with a quote that isn't closed isn't quoted.
                value = bare.match(text, begin, end)
                if not value or opened and value.end() == opened.end():
                    break
                yield value.span()
                if bare is _TO_SPACE:
                    yield from _assigned(text, *value.span(), _TO_SEPARATOR)
                begin = value.end()
            again = _AGAIN.match(text, begin, end)
            if not again:
                break
            begin = again.end()


def _armoured(text: str) -> list[tuple[int, int]]:
    """Blocks between a line BEGIN and the next line END of the same name."""
    spans, open_ = [], None
    for mark in _ARMOUR.finditer(text):
        if mark[1] == "BEGIN":
            open_ = mark
        elif open_ is not None and mark[2] == open_[2]:
            spans.append((open_.start(), mark.end()))
            open_ = None
    return spans


def candidates_of(text: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, candidate), each span once, in their order.

    Candidates are runs of 12 or more key characters that hold a digit or change case inside, and whatever
    is assigned to a key word (`KEY_WORDS`, also as a part of a name): of any length and any characters, up to the
    closing quote or else up to white space. A run inside such a value is a candidate of its own.
    """
    spans = set(_assigned(text, 0, len(text)))
    spans.update(found.span(1) for found in _SCHEME.finditer(text))
    for found in CANDIDATE.finditer(text):
        value = found[0].strip(".-/")
        if len(value) >= 12 and (any(c.isdigit() for c in value) or re.search(r"[a-z][A-Z]", value)):
            start = found.start() + found[0].index(value)
            spans.add((start, start + len(value)))
    blocks = _armoured(text)
    if blocks:
        # Blocks are in order and apart.
        starts = [begin for begin, _ in blocks]
        near = lambda span: blocks[max(0, bisect.bisect(starts, span[0]) - 1) : bisect.bisect_left(starts, span[1])]
        spans = {span for span in spans if all(end <= span[0] for _, end in near(span))} | set(blocks)
    for start, end in sorted(spans):
        yield start, end, text[start:end]


NEIGHBOURHOOD = 40
_SCHEMA = "start int, end int, candidate string, before string, after string, features array<double>"


def find_candidates(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    path_column: str | None = None,
    language: Language | None = None,
) -> DataFrame:
    """One row per candidate: the id, where it stands (in code points), its neighbourhood and features.

    With a ``language`` (`learn_language`) the features of dictionary and transitions go by the corpus.

    Null and empty texts have no candidates. Whole texts are searched. A candidate may be of any length, and
    one may lie inside another (`candidates_of`). A path is used where there is one. Rows that repeat give their candidates again; other columns, whatever
    their names, are left out.
    """
    path = F.col(path_column).cast("string") if path_column else F.lit(None).cast("string")
    kind = documents.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "start", "end", "candidate", "before", "after", "features"]
        types = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.list_(pa.float64())]
        for batch in batches:
            for begin in range(0, len(batch), 500):
                part, rows = batch.slice(begin, 500), []
                for i, (text, where) in enumerate(zip(part.column(1).to_pylist(), part.column(2).to_pylist())):
                    known = None
                    for start, end, value in candidates_of(text or ""):
                        if known is None:
                            known = frozenset(re.findall(r"\b[a-z]{3,}\b", text))
                        before, after = text[max(0, start - NEIGHBOURHOOD) : start], text[end : end + NEIGHBOURHOOD]
                        rows.append((i, start, end, value, before, after, describe(value, before, after, where, known, language)))
                if rows:
                    owner, *columns = zip(*rows)
                    arrays = [pa.array(column, type_) for column, type_ in zip(columns, types)]
                    yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(owner)), *arrays], names)

    texts = documents.select(F.col(id_column), F.col(text_column).cast("string"), path)
    return texts.mapInArrow(run, f"id {kind}, {_SCHEMA}").withColumnRenamed("id", id_column)


def _with_vector(candidates: DataFrame) -> DataFrame:
    columns = [F.col("features")[k].alias(f"_f{k}") for k in range(len(FEATURES))]
    assembler = VectorAssembler(inputCols=[f"_f{k}" for k in range(len(FEATURES))], outputCol="_vector")
    return assembler.transform(candidates.select("*", *columns)).drop(*assembler.getInputCols())


def train_forest(
    findings: DataFrame, limit: int = 5000, trees: int = 30, depth: int = 8, seed: int = 3
) -> RandomForestClassificationModel | None:
    """A random forest from labelled findings: rows of `find_candidates` with ``label`` (1 secret, 0 not).

    At most ``limit`` findings of each label are used, in the order of a hash. None if a label is missing.
    """
    known = findings.where(F.col("label").isin(0, 1))
    order = [F.xxhash64("candidate", "before", "start"), F.col("candidate"), F.col("before")]
    parts = [known.where(F.col("label") == k).orderBy(*order).limit(limit) for k in (0, 1)]
    sample = materialize(parts[0].unionByName(parts[1]).select("label", "features"), "findings")
    if {row["label"] for row in sample.select("label").distinct().collect()} != {0, 1}:
        return None
    forest = RandomForestClassifier(
        featuresCol="_vector", labelCol="label", numTrees=trees, maxDepth=depth, seed=seed, subsamplingRate=0.8
    )
    return forest.fit(_with_vector(sample.withColumn("label", F.col("label").cast("double")).coalesce(1)))


def score_candidates(
    candidates: DataFrame, model: RandomForestClassificationModel | None, threshold: float = 0.5
) -> DataFrame:
    """`find_candidates` with ``score`` (the share of votes for a secret) and ``secret``; without a model all are 1."""
    if model is None:
        return candidates.withColumns({"score": F.lit(1.0), "secret": F.lit(True)})
    scored = model.transform(_with_vector(candidates)).withColumn("score", vector_to_array("probability")[1])
    return scored.select(*candidates.columns, "score", (F.col("score") >= threshold).alias("secret"))


def with_review(candidates: DataFrame, review: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Candidates with the ``label`` that a review gives them: rows of id, ``start``, ``end`` and ``label``.

    Findings that a review contradicts itself about count as secrets.
    """
    key = [id_column, "start", "end"]
    labels = review.where(F.col("label").isin(0, 1)).groupBy(*key).agg(F.max("label").alias("label"))
    return candidates.drop("label").join(labels, key)


def reviewed(candidates: DataFrame, known: Sequence[str] = (r"^AKIA[0-9A-Z]{16}$",)) -> DataFrame:
    """Findings labelled by rules, for corpora without a review by hand.

    A secret is what has one of the ``known`` formats, or what is assigned to a key word and is no
    word. Not one is an address, a number, or what reads like words. What no rule tells is left out.
    """
    value, before = F.col("candidate"), F.lower("before")
    feature = lambda name: F.col("features")[FEATURES.index(name)]
    formats = F.lit(False)
    for pattern in known:
        formats = formats | value.rlike(pattern)
    assigned = before.rlike(r"(password|passwd|secret|token|api_?key)\s*[=:]\s*[\"']?\z") & (feature("dictionary") < 0.5)
    plain = value.contains("@") | value.rlike(r"^[0-9.+-]+$") | (feature("dictionary") >= 0.8)
    label = F.when(formats | assigned, 1).when(plain, 0)
    return candidates.withColumn("label", label).where("label IS NOT NULL")
