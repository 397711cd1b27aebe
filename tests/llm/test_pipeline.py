"""The pipeline, stage by stage, against what each stage must do with its own input."""

from __future__ import annotations

import random
from pathlib import Path

import corpus_pipeline
import pytest
from llm_helpers import A, ROWS, SCHEMA, alphanumeric
from quoteflow.plans.workspace import CLEANUP, materialize


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
        found.append(docs)
    return found


def ids(df):
    return {row["doc_id"] for row in df.select("doc_id").collect()}


def test_stages(spark, sf_dir, stages):
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for before, after in zip(stages[:-2], stages[1:-1]):
        assert after.columns == before.columns
        assert ids(after) <= ids(before)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    clean = ids(labels.where("toxic = 0"))
    assert len(clean & ids(stages[1])) >= 0.99 * len(clean)
    learnt = ids(labels.where("toxic = 1 AND crc32(cast(cast(doc_id AS string) AS binary)) % 4 <> 2"))
    assert len(learnt & ids(stages[1])) <= 0.15 * len(learnt)
    assert ids(stages[2]) == ids(stages[1]) and ids(stages[5]) == ids(stages[4])
    assert 0 < len(ids(stages[2]) - ids(stages[3])) < 0.3 * len(ids(stages[2]))


def test_no_passage_is_left(spark, sf_dir, stages):
    windows = set()
    for row in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect():
        words = alphanumeric(row["text"])
        windows |= {tuple(words[k : k + 10]) for k in range(len(words) - 9)}

    def hit(df):
        found = set()
        for row in df.select("doc_id", "text").collect():
            words = alphanumeric(row["text"])
            if any(tuple(words[k : k + 10]) in windows for k in range(len(words) - 9)):
                found.add(row["doc_id"])
        return found

    assert hit(stages[3])
    # Cutting a passage out joins what stood around it, which can't make another one here.
    assert not hit(stages[4])
    untouched = {row["doc_id"]: row["text"] for row in stages[3].collect()}
    gone = hit(stages[3])
    assert all(row["text"] == untouched[row["doc_id"]] for row in stages[4].collect() if row["doc_id"] not in gone)


def test_edges(spark, sf_dir):
    rows = [*ROWS, (50, " ".join(f"w{k}" for k in range(60)), "en", "a", 1), (51, " ".join(f"w{k}" for k in range(61)), "en", "a", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "edges")
        assert docs.columns == [field.split()[0] for field in SCHEMA.split(", ")]
    left = [row["doc_id"] for row in docs.collect()]
    assert None in left and 4 in left and 50 in left and 51 not in left
    assert corpus_pipeline.mixing(spark, docs, sf_dir).count() == len(left)
    empty = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0
    assert A


def test_near_duplicates_go_by_id_and_text(spark, sf_dir):
    """A text goes by its own group whatever other texts its id has, and of rows that repeat both one stays."""
    words = [f"w{k}" for k in range(80)]
    one, near = " ".join(words), " ".join(words[:79])
    other = " ".join(f"v{k}" for k in range(50))
    rows = [
        (1, one, "en", "a", 1),
        (2, near, "en", "a", 2),
        (2, other, "en", "a", 3),
        (3, "alone", "en", "a", 4),
        (3, "alone", "en", "a", 4),
        (4, other, "en", "b", 5),
        (5, one, "en", "a", 6),
        (5, "clean text of its own", "en", "a", 7),
        (6, None, "en", "a", None),
        (6, None, "en", "a", None),
        (None, one, "en", "a", 8),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    for order in (docs, docs.repartition(5)):
        left = corpus_pipeline.near_duplicates(spark, order, sf_dir)
        assert left.columns == docs.columns
        kept = sorted(((r["doc_id"], r["text"], r["n_chars"]) for r in left.collect()), key=str)
        expected = [(1, one, 1), (2, other, 3), (3, "alone", 4), (5, "clean text of its own", 7), (6, None, None), (6, None, None), (None, one, 8)]
        assert kept == sorted(expected, key=str)


def test_near_duplicates_move_few_texts(spark, sf_dir, setting):
    """Only texts that share a group are moved to tell which of them stay."""
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    setting(CLEANUP, "false")
    draw = random.Random(5)
    texts = [" ".join(f"{draw.getrandbits(64):x}" for _ in range(200)) for _ in range(300)]
    rows = [(k, text, "en", "a", k) for k, text in enumerate([*texts, texts[7]])]
    left = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, SCHEMA), sf_dir)
    folders = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs())
    held = lambda: {p for folder in folders for p in Path(folder.getPath()).rglob("shuffle_*.data")}
    before = held()
    assert sorted((r["doc_id"], r["text"]) for r in left.collect()) == list(enumerate(texts))
    moved = sum(p.stat().st_size for p in held() - before)
    assert 0 < moved < 0.1 * sum(map(len, texts))
