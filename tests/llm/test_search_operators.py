"""Spelling variants, nearest neighbours and ranked search against brute force."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_helpers import alphanumeric

from quoteflow.llm import neighbours, ranked_search, spelling
from quoteflow.llm.neighbours import build_tree, chi_square, incremental, stopping_ratio
from quoteflow.llm.spelling import count_words, one_apart, spelling_forms

CLASHING = ("rank", "word", "n", "shard", "term", "item", "cell", "tree", "class", "query", "hash", "copy", "id", "vector")


def clashing(df):
    """With further columns that bear names used inside."""
    taken = {name.lower() for name in df.columns}
    return df.selectExpr("*", *(f"'x' AS {name}" for name in CLASHING if name not in taken))


# Spelling


def runs(text):
    return [re.sub("[A-Z]+", lambda m: m[0].lower(), run) for run in re.findall("[A-Za-zÀ-ÿ]+", text or "")]


def counted(rows, one_in):
    found = Counter()
    for doc, text in rows:
        for run in runs(text):
            crc = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if one_in and crc % one_in == 0:
                run = run[: crc % len(run)] + run[crc % len(run) + 1 :]
            found[run] += 1
    found.pop("", None)
    return found


def forms(counts, ratio=2):
    """By comparing all words with each other."""
    near = {w: [v for v in counts if abs(len(v) - len(w)) < 2 and one_apart(v, w)] for w in counts}
    best = {w: min(vs, key=lambda v: (-counts[v], v), default=None) for w, vs in near.items()}
    form = {w: v if v is not None and counts[v] >= ratio * counts[w] else None for w, v in best.items()}
    found = {}
    for word, n in counts.items():
        root = word
        while form[root] is not None:
            root = form[root]
        found[word] = (n, len(near[word]), form[word], counts[form[word]] if form[word] else None, root)
    return found


def as_forms(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in rows}


@pytest.mark.parametrize(
    ("a", "b", "near"),
    [
        ("abcd", "abcd", False), ("abcd", "abed", True), ("abcd", "abc", True), ("abcd", "bcd", True), ("abcd", "acbd", False),
        ("aab", "ab", True), ("", "a", True), ("abcd", "ab", False), ("a", "b", True), ("ab", "ba", False), ("éa", "ea", True),
    ],
)
def test_one_apart(a, b, near):
    assert one_apart(a, b) == near == one_apart(b, a)


def test_words_of_edge_documents_are_counted(spark, edges, nothing):
    rows = [(r.doc_id, r.text) for r in edges.collect()]
    rows += [(3, "ÀÉ×÷ßÿ ĀbcŸ don't x-y C3 한글a"), (None, "Grüße GRÜSSE GRÜßE")]
    given = spark.createDataFrame(rows, "doc_id long, text string")
    for one_in in (0, 1, 7):
        found = {r.word: r.n for r in count_words(clashing(given), one_in=one_in, held=5).collect()}
        assert found == dict(counted(rows, one_in))
    assert count_words(nothing).isEmpty()
    assert spelling_forms(count_words(nothing)).isEmpty()


@pytest.mark.parametrize("written", [64, 6, 2])
def test_forms_equal_brute_force(spark, written):
    """Few letters, so many words are near each other, with runs of equal letters; short limits force digests."""
    chance = random.Random(written)
    words = {"".join(chance.choice("abé") for _ in range(chance.randint(1, 9))) for _ in range(500)}
    counts = {word: chance.choice([1, 2, 2, 4, 8, 16, 40]) for word in sorted(words)}
    given = spark.createDataFrame(list(counts.items()) + [(None, 3), ("", 9)], "word string, n long")
    assert as_forms(spelling_forms(clashing(given), written=written)) == forms(counts)


def test_a_very_long_word(spark):
    long = "".join(random.Random(1).choice("abcdefgh") for _ in range(30_000))
    counts = {long: 3, long[:500] + "z" + long[501:]: 6, long[1:]: 12, long + "y": 3, long[2:]: 30, "short": 2, "shorts": 4}
    found = as_forms(spelling_forms(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert found == forms(counts)


def test_ranges_hold_a_word_for_each_letter_at_most(spark):
    """All words of a hot range, which is that of one place of one word."""
    counts = {f"hous{chr(c)}": n for n, c in enumerate([*range(97, 123), *range(0xC0, 0x100)], 1)} | {"hous": 1000}
    found = as_forms(spelling_forms(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert found == forms(counts)


def test_crc32_of_many_stretches():
    words = [b"", b"a", b"hello", "grüße".encode(), b"x" * 1000]
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    starts = ends - [len(w) for w in words]
    begun = np.array([zlib.crc32(f"{i}:".encode()) for i in range(len(words))], np.uint32)
    expected = [zlib.crc32(f"{i}:".encode() + word) for i, word in enumerate(words)]
    assert spelling.crc32(data, starts, ends, begun).tolist() == expected


# Nearest neighbours


def brute_neighbours(rows, queries, k=10):
    """(id, vector) to the exact answers; of rows that repeat an id the smallest vector counts."""
    vectors = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        vectors[i] = min(vectors.get(i, v), v)
    found = {}
    for q in queries:
        if q in vectors:
            away = sorted((float(np.sqrt(((np.array(v) - vectors[q]) ** 2).sum())), i) for i, v in vectors.items() if i != q)
            found[q] = away[:k]
    return found


def as_neighbours(df):
    found = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(found.setdefault(r.query_id, [])) + 1
        found[r.query_id].append((r.score, r.vec_id))
    return found


def vectors(spark, rows, kind="double"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")


def test_the_stopping_test():
    assert chi_square(0.0, 8) == 0.0
    assert chi_square(15.507, 8) == pytest.approx(0.95, abs=1e-4)
    assert chi_square(stopping_ratio(0.9, 4), 4) == pytest.approx(0.9)
    draws = (np.random.default_rng(1).standard_normal((100_000, 6)) ** 2).sum(1)
    assert (draws <= stopping_ratio(0.8, 6)).mean() == pytest.approx(0.8, abs=0.01)


def test_a_tree_gives_all_points_by_rising_distance():
    points = np.random.default_rng(2).integers(0, 6, (500, 4)).astype(float)
    for query in points[:20]:
        away = ((points - query) ** 2).sum(1)
        seen, bound = [], 0.0
        for lot, least in incremental(build_tree(points, 8), points, query):
            assert (away[lot] >= bound).all() and (away[lot] <= least).all()
            seen, bound = seen + lot.tolist(), least
        assert sorted(seen) == list(range(500))


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (1, [1.5, 2.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (None, [1.0, 1.0]),
        (7, []), (8, [1.0, 2.0, 3.0]), (9, [1.0, 2.0]), (9, [1.0, 2.0]), (10, [5.0, 5.0]), (10, [4.0, 9.0]), (100, [-0.0, 7.0]), (101, [0.0, 7.0]),
    ]
    given = clashing(vectors(spark, rows))
    ids = [*range(11), 100, 101]
    expected = brute_neighbours([r for r in rows if r[1] is None or len(r[1]) == 2], ids)
    assert as_neighbours(neighbours.search(neighbours.build_index(given), given)) == expected
    assert neighbours.search(neighbours.build_index(given.where("vec_id in (2, 3)")), given).isEmpty()
    assert neighbours.search(neighbours.build_index(given.limit(0)), given).isEmpty()
    assert neighbours.search(neighbours.build_index(given), given.limit(0)).isEmpty()
    assert neighbours.search(neighbours.build_index(given.where("vec_id = 1")), given).isEmpty()


def test_a_vector_of_very_many_rows(spark):
    """Ties at distance 0 and behind it go to smaller ids, in any number of cells and trees."""
    chance = np.random.default_rng(3)
    rows = [(int(i), [1.0, 1.0, 1.0, 1.0]) for i in chance.permutation(400)]
    rows += [(400 + i, [float(x) for x in chance.integers(0, 3, 4)]) for i in range(200)]
    given = vectors(spark, rows, "float")
    queries = given.where("vec_id % 25 = 0")
    for options in ({}, {"cell": 20, "tree_bytes": 320, "leaf": 4}):
        # All points are compared, so nothing is left to chance.
        found = neighbours.search(neighbours.build_index(given, k=5, **options), queries, 5, confidence=1 - 1e-12)
        assert as_neighbours(found) == brute_neighbours(rows, range(0, 600, 25), 5)


def test_recall_in_many_cells(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in given.collect()]
    index = neighbours.build_index(given, cell=60, tree_bytes=64 * 8 * 25)
    assert index.trees.count() > 15
    found = as_neighbours(neighbours.search(index, given.where("vec_id % 10 = 0")))
    exact = brute_neighbours(rows, range(0, 10**6, 10))
    assert found.keys() == exact.keys()
    hits = sum(len({i for _, i in exact[q]} & {i for _, i in found[q]}) for q in exact)
    assert hits >= 0.9 * sum(len(x) for x in exact.values())
    for q, near in found.items():
        own = {i: v for i, v in rows}
        assert [d for d, _ in near] == [float(np.sqrt(((np.array(own[i]) - own[q]) ** 2).sum())) for _, i in near]


# Ranked search


def brute_search(rows, items, k=10):
    texts = [(doc, Counter(alphanumeric(text))) for doc, text in rows]
    texts = [(doc, words) for doc, words in texts if words]
    documents, total = len(texts), sum(words.total() for _, words in texts)
    df = Counter(word for _, words in texts for word in words)
    asked = {}
    for item, text in items:
        if item is not None:
            asked.setdefault(item, set()).update(alphanumeric(text))
    found = set()
    for item, terms in asked.items():
        scored = []
        for doc, words in texts:
            m = 10 + 90 * words.total() * documents // total
            score = sum(
                math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1))) * (10**9 * words[t] // (1000 * words[t] + 8 * m))
                for t in terms
                if words[t]
            )
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        found |= {(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(scored)[:k], 1)}
    return found


def as_ranks(df):
    rows = [(r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


ITEMS = [(1, "one two three GRÜSSE grüße"), (2, None), (3, ""), (None, "one"), (4, "nowhere"), (5, "one"), (5, "line"), (6, "köln x " * 900)]


def test_edge_documents_and_items(spark, edges, nothing):
    rows = [(r.doc_id, r.text) for r in edges.collect()]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    for options in ({}, {"shard_words": 5, "block": 1}):
        index = ranked_search.build_index(clashing(edges), **options)
        for query_terms in (100_000, 2):
            assert as_ranks(ranked_search.search(index, clashing(items), query_terms=query_terms)) == brute_search(rows, ITEMS)
    assert ranked_search.search(ranked_search.build_index(nothing), items).isEmpty()
    assert ranked_search.search(index, items.limit(0)).isEmpty()
    assert ranked_search.search(index, items.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]


@pytest.mark.parametrize("seed", range(3))
def test_search_equals_brute_force(spark, seed):
    """Words as rare as in a language, many copies of one document, several shards, short and long blocks."""
    chance = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    rows = [(i, " ".join(chance.choices(words, weights, k=chance.choice([0, 1, 5, 40, 300])))) for i in range(400)]
    rows += [(1000 + i, rows[7][1] or "w5 w6") for i in range(150)]
    chance.shuffle(rows)
    items = [(i, " ".join(chance.choices(words, k=chance.choice([1, 3, 12, 60])))) for i in range(40)]
    given = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string")
    for shard_words, block in ((2000, 4), (10**6, 64)):
        index = ranked_search.build_index(given, shard_words=shard_words, block=block)
        assert as_ranks(ranked_search.search(index, asked, k=7, query_terms=100)) == brute_search(rows, items, 7)


def test_numbers_as_bytes():
    values = np.array([0, 1, 127, 128, 16383, 16384, 2**31, 2**40 + 5], np.int64)
    data, at = ranked_search.encode(values)
    assert ranked_search.decode(data).tolist() == values.tolist()
    assert ranked_search.decode(data[at[3] : at[5]]).tolist() == [128, 16383]


def test_blocks_that_cannot_win_stay_compressed():
    """A common term's blocks are decompressed for candidates only."""
    scoring = ranked_search.Scoring(10_000, 100_000)
    lengths = np.full(10_000, 10)
    lists = []
    for docs in (np.arange(10_000), np.array([50, 7000])):
        tf, gap = np.ones(len(docs), np.int64), docs.copy()
        gap[1:] -= np.where(np.arange(1, len(docs)) % 64 == 0, 0, docs[:-1])
        data, byte = ranked_search.encode(np.stack([gap, tf], 1).ravel())
        starts = np.arange(0, len(docs), 64)
        ends = np.minimum(starts + 64, len(docs))
        head = np.stack([docs[ends - 1], byte[2 * ends] - byte[2 * starts], np.ones(len(starts), np.int64)], 1).ravel()
        head = np.concatenate([head, np.tile([1, 10], len(starts))]).astype(np.int32)
        weight = 1 if len(docs) > 2 else 9000
        lists.append(ranked_search.PostingList(len(docs), head.tobytes(), data.tobytes(), weight, lengths, scoring, 64))
    docs, scores = ranked_search.max_score(lists, 10_000, 2, 0)
    assert docs.tolist() == [50, 7000] and scores[0] == scores[1] == sum(int(x.best[0]) for x in lists)
    assert np.flatnonzero(lists[0].open).tolist() == [0, 7000 // 64]
