"""The registered queries against SQL, or against brute force where SQL can't express them."""

from __future__ import annotations

import collections
import hashlib
import zlib

import __spark_entry__ as entry
import duckdb
import pytest
from llm_helpers import alphanumeric, spaced
from oracle_check import connect, difference
from quoteflow.llm.queries import ORACLE, QUERIES


def test_registered():
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(spark, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLE[name]) is None


def documents(sf_dir):
    return duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet'").fetchall()


def test_decontamination_equals_brute_force(spark, sf_dir):
    windows = collections.defaultdict(set)
    for item, text in duckdb.sql(f"SELECT item_id, text FROM '{sf_dir}/benchmark.parquet'").fetchall():
        words = alphanumeric(text)
        for k in range(max(1, len(words) - 9)) if words else ():
            windows[tuple(words[k : k + 10])].add(item)
    lengths = {len(window) for window in windows}
    expected = {}
    for doc, text in documents(sf_dir):
        words, hit, items = alphanumeric(text), set(), set()
        for length in lengths:
            for k in range(len(words) - length + 1):
                if owners := windows.get(tuple(words[k : k + length])):
                    hit |= set(range(k, k + length))
                    items |= owners
        digest = hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()
        expected[doc] = (len(words), len(hit), len(items), digest, bool(hit))
    found = {row[0]: tuple(row)[1:] for row in QUERIES["op5_decontaminate"](spark, sf_dir).collect()}
    assert found == expected
    assert any(row[4] for row in expected.values())


def test_jaccard_join_equals_brute_force(spark, sf_dir):
    sets, holders = {}, collections.defaultdict(list)
    for doc, text in documents(sf_dir):
        words = spaced(text)
        sets[doc] = {tuple(words[k : k + 3]) for k in range(max(1, len(words) - 2))} if words else set()
    component = {doc: doc for doc in sets}

    def root(doc):
        while component[doc] != doc:
            doc = component[doc]
        return doc

    for doc, grams in sets.items():
        common = collections.Counter(other for gram in grams for other in holders[gram])
        for gram in grams:
            holders[gram].append(doc)
        for other, n in common.items():
            if 100 * n >= 90 * (len(grams) + len(sets[other]) - n):
                a, b = sorted((root(doc), root(other)))
                component[b] = a
    found = {row[0]: tuple(row)[1:] for row in QUERIES["op9_jaccard_join"](spark, sf_dir).collect()}
    assert found == {doc: (len(grams), root(doc)) for doc, grams in sets.items()}
    assert any(root(doc) != doc for doc in sets)


def test_token_counts_equal_the_tokenizer(spark, sf_dir):
    import sentencepiece
    from quoteflow.llm.token_counts import public_model

    encoder = sentencepiece.SentencePieceProcessor(model_file=public_model())
    texts = [text or "" for _, text in documents(sf_dir)]
    expected = collections.Counter(map(len, encoder.encode(texts, num_threads=1)))
    found = QUERIES["op7_token_counts"](spark, sf_dir).collect()
    assert collections.Counter(row["n_tokens"] for row in found) == expected
    assert all(row["closed"] for row in found)


@pytest.mark.parametrize(
    ("name", "label", "least_found", "least_kept"),
    [("op1_quality_fm", "quality", 0.97, 0.9), ("op2_toxicity", "toxic", 0.8, 0.99)],
)
def test_scores_of_held_out_documents(spark, name, label, least_found, least_kept):
    sf_dir = "/root/testdata/sf0.1"
    labels = dict(duckdb.sql(f"SELECT doc_id, {label} FROM '{sf_dir}/labels.parquet'").fetchall())
    rows = QUERIES[name](spark, sf_dir).collect()
    assert len(rows) == 10_000
    for row in rows:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 4 == 2)
        assert 0 <= row["score"] <= 1
    told = [(labels[row["doc_id"]], row["predicted"]) for row in rows if row["held_out"] and row["doc_id"] in labels]
    ones, zeros = ([got for label_, got in told if label_ == k] for k in (1, 0))
    assert sum(ones) / len(ones) >= least_found
    assert 1 - sum(zeros) / len(zeros) >= least_kept


def test_secrets(spark):
    """Values assigned to a key word in the text are secrets, addresses are not."""
    sf_dir = "/root/testdata/sf0.1"
    texts = dict(documents(sf_dir))
    rows = QUERIES["op3_secrets"](spark, sf_dir).collect()
    before = [texts[row["doc_id"]][max(0, row["start"] - 12) : row["start"]] for row in rows]
    assert all(texts[row["doc_id"]][row["start"] : row["end"]] == row["candidate"] for row in rows)
    assigned = [row["secret"] for row, text in zip(rows, before) if text.lower().endswith(('token = "', "password="))]
    addresses = [row["secret"] for row in rows if "@" in row["candidate"]]
    assert assigned and sum(assigned) >= 0.95 * len(assigned)
    assert addresses and not any(addresses)
