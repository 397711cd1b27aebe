"""Ranked lexical search: an inverted index in shards, searched with block maxima.

Documents are indexed by the partitions they come in, in shards of a bounded number of words. A shard
has, for each of its terms, a posting list cut into blocks that are compressed one by one. Beside a
block stand its last document and its impacts: those pairs of occurrences and document length of which no
other pair of the block has more occurrences in a document that is not longer. A score grows with the
one and falls with the other, so the best score of a block follows from its impacts whatever the
statistics of the corpus are, without reading the block.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quoteflow.llm.words import ALPHANUMERIC, find_words, pieces
from quoteflow.plans.workspace import materialize

# Words of a shard, about; a document is never cut.
SHARD_WORDS = 1 << 21
# Postings of a block.
BLOCK = 64
# Terms of queries, about, that are searched in one pass over the index.
QUERY_TERMS = 100_000

INDEX_SCHEMA = "shard long, term long, n long, words long, head binary, data binary"


# Numbers as bytes: seven bits each, the lowest first, the eighth set if another byte follows.
def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values, and where the bytes of each begin, with the end of the last."""
    lengths = np.ones(len(values), np.int64)
    for bits in range(7, 63, 7):
        lengths += values >= (1 << bits)
    at = np.concatenate([[0], np.cumsum(lengths)])
    out = np.zeros(at[-1], np.uint8)
    for k in range(int(lengths.max(initial=0))):
        has = np.flatnonzero(lengths > k)
        more = (lengths[has] > k + 1).astype(np.uint8) << 7
        out[at[has] + k] = ((values[has] >> (7 * k)) & 127).astype(np.uint8) | more
    return out, at


def decode(data: np.ndarray) -> np.ndarray:
    last = data < 128
    starts = np.concatenate([[0], np.flatnonzero(last)[:-1] + 1])
    place = np.arange(len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
    return np.add.reduceat((data & 127).astype(np.int64) << (7 * place), starts)


def impacts(block: np.ndarray, tf: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Which postings are impacts of their block; ``block`` is a number that never falls."""
    order = np.lexsort((length, -tf, block))
    at = length[order].astype(np.int64) - block[order].astype(np.int64) * (int(length.max(initial=0)) + 1)
    least = np.minimum.accumulate(np.concatenate([[np.iinfo(np.int64).max], at[:-1]]))
    return np.sort(order[at < least])


def _shard(number: int, ids: pa.Array, lengths: np.ndarray, hashes: np.ndarray, size: int) -> pa.RecordBatch:
    """The rows of one shard: its documents, in a row without a term, and a row for each term."""
    doc = np.repeat(np.arange(len(lengths)), lengths)
    order = np.argsort(hashes, kind="stable")
    term, doc = hashes[order], doc[order]
    first = np.ones(len(term), bool)
    first[1:] = (term[1:] != term[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(first)
    tf = np.diff(np.append(at, len(term)))
    term, doc = term[at], doc[at]
    begins = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]])) if len(term) else np.zeros(0, np.int64)
    counts = np.diff(np.append(begins, len(term)))
    place = np.arange(len(term)) - np.repeat(begins, counts)
    opens = place % size == 0
    gap = doc.copy()
    gap[1:] -= np.where(opens[1:], 0, doc[:-1])
    data, byte = encode(np.stack([gap, tf], 1).ravel())
    # Per block: its last document, its bytes, the number of its impacts.
    block = np.cumsum(opens) - 1
    starts = np.flatnonzero(opens)
    ends = np.append(starts[1:], len(term))
    best = impacts(block, tf, lengths[doc]) if len(term) else np.zeros(0, np.int64)
    blocks = np.stack([doc[ends - 1], byte[2 * ends] - byte[2 * starts], np.bincount(block[best], minlength=len(starts))], 1)
    best = np.stack([tf[best], lengths[doc[best]]], 1)
    # A head has the blocks of a list and then their impacts.
    of_list = np.cumsum(np.concatenate([[0], -(-counts // size)]))
    of_impacts = np.concatenate([[0], np.cumsum(blocks[:, 2])])[of_list]
    widths = 3 * np.diff(of_list) + 2 * np.diff(of_impacts)
    ends_of_heads = np.cumsum(widths)
    head = np.zeros(int(widths.sum()), np.int32)
    in_block = np.repeat(ends_of_heads - widths, 3 * np.diff(of_list)) + _ramp(3 * np.diff(of_list))
    head[in_block] = blocks.ravel()
    rest = np.repeat(ends_of_heads - 2 * np.diff(of_impacts), 2 * np.diff(of_impacts)) + _ramp(2 * np.diff(of_impacts))
    head[rest] = best.ravel()
    known = ids.is_valid().to_numpy(zero_copy_only=False)
    documents = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).tobytes() + known.astype(np.uint8).tobytes()
    n = len(begins)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(n + 1, number)),
            pa.array(np.concatenate([[0], term[begins].view(np.int64)]), mask=np.arange(n + 1) == 0),
            pa.array(np.concatenate([[np.count_nonzero(lengths)], counts])),
            pa.array(np.concatenate([[lengths.sum()], np.zeros(n, np.int64)])),
            _binary(documents, np.append(0, ends_of_heads) * 4, head.tobytes()),
            _binary(lengths.astype(np.int32).tobytes(), byte[2 * np.append(begins, len(term))], data.tobytes()),
        ],
        ["shard", "term", "n", "words", "head", "data"],
    )


def _ramp(counts: np.ndarray) -> np.ndarray:
    """0 .. n - 1 for each n of ``counts``, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def _binary(first: bytes, offsets: np.ndarray, rest: bytes) -> pa.Array:
    """A first value, and then the values that ``offsets`` cut out of the rest."""
    at = np.concatenate([[0], offsets + len(first)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at.tobytes()), pa.py_buffer(first + rest)])


def _indexer(shard_words: int, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, lengths, hashes, held = [], [], [], 0
        for batch in batches:
            for at, data, offsets in pieces(batch.column(1)):
                words = find_words(data, offsets, ALPHANUMERIC)
                if hashes and held + len(words.hashes) > shard_words:
                    yield _shard(number, pa.concat_arrays(ids), np.concatenate(lengths), np.concatenate(hashes), block)
                    ids, lengths, hashes, held, number = [], [], [], 0, number + 1
                ids.append(batch.column(0).slice(at, len(offsets) - 1))
                lengths.append(words.counts())
                hashes.append(words.hashes)
                held += len(words.hashes)
        if hashes:
            yield _shard(number, pa.concat_arrays(ids), np.concatenate(lengths), np.concatenate(hashes), block)

    return run


class Index(NamedTuple):
    """``rows`` of all shards; ``documents`` with a term, all their ``words`` with repeats; postings of a ``block``."""

    rows: DataFrame
    documents: int
    words: int
    block: int


def build_index(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shard_words: int = SHARD_WORDS,
    block: int = BLOCK,
) -> Index:
    """Index whole texts; the index is a table in the shared folder. There is no shuffle.

    Terms are runs of digits, letters and characters beyond ASCII, A to Z in lower case, and are known by
    64-bit hashes. Each row is a document of its own, also where rows repeat an id. A null or empty text has no
    terms; a null id is kept. Other columns, whatever their names, are left out.
    """
    rows = documents.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    rows = materialize(rows.mapInArrow(_indexer(shard_words, block), INDEX_SCHEMA), "index")
    total = rows.where("term IS NULL").agg(F.sum("n").alias("n"), F.sum("words").alias("words")).first()
    return Index(rows, total.n or 0, total.words or 0, block)


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, data, offsets in pieces(batch.column(1)):
            words = find_words(data, offsets, ALPHANUMERIC)
            items = batch.column(0).take(pa.array(at + words.texts()))
            yield pa.RecordBatch.from_arrays([items, pa.array(words.hashes.view(np.int64))], ["item", "term"])


class Scoring(NamedTuple):
    """A score is the sum of weight * ((1000000000 * tf) div (1000 * tf + 8 * m)) over the terms, with
    m = 10 + ((90 * length * documents) div words). Whole numbers throughout."""

    documents: int
    words: int

    def parts(self, weight: int, tf: np.ndarray, length: np.ndarray) -> np.ndarray:
        tf = tf.astype(np.int64)
        m = 10 + (90 * length.astype(np.int64) * self.documents) // self.words
        return weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


class PostingList:
    """One list of a shard. Blocks are decompressed when they are first asked for."""

    def __init__(self, n: int, head: bytes, data: bytes, weight: int, lengths: np.ndarray, scoring: Scoring, size: int):
        self.weight, self.lengths, self.scoring, self.size, self.n = weight, lengths, scoring, size, n
        head_ = np.frombuffer(head, np.int32).astype(np.int64)
        blocks = -(-n // size)
        self.last, widths, counts = head_[: 3 * blocks].reshape(-1, 3).T
        self.bytes = np.concatenate([[0], np.cumsum(widths)])
        pairs = head_[3 * blocks :].reshape(-1, 2)
        parts = scoring.parts(weight, pairs[:, 0], pairs[:, 1])
        # Block maxima: upper bounds that some document of the block reaches.
        self.best = np.maximum.reduceat(parts, np.concatenate([[0], np.cumsum(counts)[:-1]]))
        self.most = int(self.best.max())
        self.data = np.frombuffer(data, np.uint8)
        self.docs, self.scores = np.full(n, -1, np.int64), np.zeros(n, np.int64)
        self.open = np.zeros(blocks, bool)

    def decompress(self, wanted: np.ndarray) -> None:
        """Fill in the postings of blocks (numbers that rise)."""
        wanted = wanted[~self.open[wanted]]
        if not len(wanted):
            return
        self.open[wanted] = True
        widths = self.bytes[wanted + 1] - self.bytes[wanted]
        values = decode(self.data[np.repeat(self.bytes[wanted], widths) + _ramp(widths)]).reshape(-1, 2)
        counts = np.minimum(self.size, self.n - wanted * self.size)
        running = np.cumsum(values[:, 0])
        starts = np.cumsum(counts) - counts
        docs = running - np.repeat(running[starts] - values[starts, 0], counts)
        at = np.repeat(wanted * self.size, counts) + _ramp(counts)
        self.docs[at] = docs
        self.scores[at] = self.scoring.parts(self.weight, values[:, 1], self.lengths[docs])

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        self.decompress(np.arange(len(self.open)))
        return self.docs, self.scores

    def blocks_of(self, docs: np.ndarray) -> np.ndarray:
        """The block in which each document would be; as many as there are blocks if it lies behind all."""
        return np.searchsorted(self.last, docs)

    def scores_of(self, docs: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """Scores of documents (numbers that rise) in the blocks they would be in; 0 if they aren't."""
        wanted = np.unique(blocks)
        self.decompress(wanted)
        counts = np.minimum(self.size, self.n - wanted * self.size)
        at = np.repeat(wanted * self.size, counts) + _ramp(counts)
        found = np.minimum(np.searchsorted(self.docs[at], docs), len(at) - 1)
        return np.where(self.docs[at[found]] == docs, self.scores[at[found]], 0)


def max_score(lists: list[PostingList], n_docs: int, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) that hold the ``k`` best of a shard with at least ``floor``, ties included.

    Lists are taken by falling bounds until the bounds of the rest together can't reach the k-th best
    score so far: these are essential, and only their documents are candidates. The rest are looked up
    for candidates alone. Before a block is decompressed for a candidate, its maximum must allow the
    candidate to reach the k-th best score.
    """
    lists = sorted(lists, key=lambda x: x.most)
    below = np.concatenate([[0], np.cumsum([x.most for x in lists])])
    sums = np.zeros(n_docs, np.int64)
    floor, rest = max(floor, 1), len(lists)
    while rest and below[rest] >= floor:
        rest -= 1
        docs, scores = lists[rest].all()
        sums[docs] += scores
        # Worth a look only where it may end the loop.
        if below[rest] < floor or below[rest] * 2 < below[-1]:
            floor = _kth(sums, k, floor)
    candidates = np.flatnonzero(sums)
    reached = sums[candidates]
    while rest:
        floor = _kth(reached, k, floor)
        keep = reached + below[rest] >= floor
        candidates, reached = candidates[keep], reached[keep]
        if not len(candidates):
            break
        rest -= 1
        blocks = lists[rest].blocks_of(candidates)
        inside = blocks < len(lists[rest].best)
        bound = np.where(inside, lists[rest].best[np.minimum(blocks, len(lists[rest].best) - 1)], 0)
        keep = reached + bound + below[rest] >= floor
        candidates, reached, blocks, inside = candidates[keep], reached[keep], blocks[keep], inside[keep]
        if inside.any():
            reached[inside] += lists[rest].scores_of(candidates[inside], blocks[inside])
    floor = _kth(reached, k, floor)
    keep = reached >= floor
    return candidates[keep], reached[keep]


def _kth(scores: np.ndarray, k: int, floor: int) -> int:
    """The k-th best score, if there are so many and it is above ``floor``."""
    return max(floor, int(np.partition(scores, -k)[-k])) if len(scores) >= k else floor


def _searcher(items: np.ndarray, first: np.ndarray, terms: np.ndarray, weights: np.ndarray, scoring: Scoring, k: int, size: int):
    """For rows sorted by shard: the best documents of each item in all shards of the task.

    ``terms`` of item i stand from ``first[i]`` to ``first[i + 1]``.
    """
    weight_of = dict(zip(terms.tolist(), weights.tolist()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Per item: scores, whether an id is null, ids; the best first.
        heaps = [(np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))] * len(items)

        def search(rows: list[tuple]) -> None:
            documents = next((row for row in rows if row[1] is None), None)
            if documents is None or len(rows) == 1:
                return
            lengths = np.frombuffer(documents[4], np.int32).astype(np.int64)
            n = len(lengths)
            ids, unknown = np.frombuffer(documents[3], np.int64, n), np.frombuffer(documents[3], np.uint8, n, 8 * n) == 0
            lists = {
                term: PostingList(count, head, data, weight_of[term], lengths, scoring, size)
                for _, term, count, head, data in rows
                if term is not None
            }
            for i in range(len(items)):
                own = [lists[t] for t in terms[first[i] : first[i + 1]].tolist() if t in lists]
                if not own:
                    continue
                best, null, known = heaps[i]
                docs, scores = max_score(own, n, k, int(best[-1]) if len(best) == k else 0)
                best = np.concatenate([best, scores])
                null, known = np.concatenate([null, unknown[docs]]), np.concatenate([known, ids[docs]])
                order = np.lexsort((known, null, -best))[:k]
                heaps[i] = best[order], null[order], known[order]

        held, shard = [], None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in range(5))):
                if row[0] != shard:
                    search(held)
                    held, shard = [], row[0]
                held.append(row)
        search(held)
        sizes = [len(scores) for scores, _, _ in heaps]
        if sum(sizes):
            scores, null, ids = (np.concatenate(part) for part in zip(*heaps))
            found = [pa.array(np.repeat(items, sizes)), pa.array(ids, mask=null), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(found, ["item", "id", "score"])

    return run


def search(
    index: Index,
    items: DataFrame,
    k: int = 10,
    id_column: str = "item_id",
    text_column: str = "text",
    query_terms: int = QUERY_TERMS,
) -> DataFrame:
    """For each item its ``k`` best documents: the item's id, ``rank`` (from 1), ``doc_id``, ``score``.

    A term weighs floor(1000 * ln((2 * documents + 2) / (2 * df + 1))); scores are `Scoring`'s. Equal scores go
    by rising id, null last; scores of 0 are left out, so an item may have fewer rows, or none. Items are a set of
    queries: they go to the tasks in blocks of about ``query_terms`` terms, each a pass over the posting
    lists of its terms, in which a task searches its shards one after the other (`max_score`), holding on to the
    ``k`` best of each item so far. These are merged last.

    Rows that repeat an item's id are one item with the terms of all. An item with a null id or text has no result.
    """
    spark = index.rows.sparkSession
    schema = "item long, rank int, doc_id long, score long"
    rows = items.select(F.col(id_column).cast("long").alias("item"), F.col(text_column).cast("string").alias("text"))
    asked = rows.where("item IS NOT NULL").mapInArrow(_terms, "item long, term long").distinct()
    asked = materialize(asked, "asked")
    lists = index.rows.where("term IS NOT NULL")
    wanted = materialize(asked.select("term").distinct(), "terms")
    df = lists.join(wanted, "term", "left_semi").groupBy("term").agg(F.sum("n").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(float(2 * index.documents + 2)) / (2 * F.col("df") + 1)))
    weighed = materialize(asked.join(df.select("term", weight.alias("weight")).where("weight > 0"), "term"), "weights")
    blocks = -(-weighed.count() // query_terms)
    scoring = Scoring(index.documents, index.words)
    found = []
    for number in range(blocks):
        part = weighed.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == number)
        pairs = part.select("item", "term", "weight").toArrow().sort_by([("item", "ascending"), ("term", "ascending")])
        item, term, weights = (pairs[name].to_numpy() for name in ("item", "term", "weight"))
        names, first = np.unique(item, return_index=True)
        searcher = _searcher(names, np.append(first, len(item)), term, weights, scoring, k, index.block)
        needed = lists.join(part.select("term").distinct(), "term", "left_semi")
        needed = needed.unionByName(index.rows.where("term IS NULL")).select("shard", "term", "n", "head", "data")
        needed = needed.repartition("shard").sortWithinPartitions("shard", "term")
        found.append(materialize(needed.mapInArrow(searcher, "item long, id long, score long"), "best"))
    if not found:
        return spark.createDataFrame([], schema.replace("item ", f"`{id_column}` ", 1))
    best = found[0]
    for more in found[1:]:
        best = best.union(more)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("item").alias(id_column), "rank", F.col("id").alias("doc_id"), "score")
