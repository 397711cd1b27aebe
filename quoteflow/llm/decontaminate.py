"""Find passages of a benchmark in documents, with one index per shard of documents."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quoteflow.llm.fm_index import FMIndex
from quoteflow.llm.words import ALPHANUMERIC, find_words, pieces

# Words of a shard, about; a longer document is a shard of its own.
SHARD_WORDS = 1 << 19
# Windows of phrases that are searched at once, about 16 MB; blocks of them are sent to every executor.
BLOCK_WINDOWS = 100_000


class Phrases(NamedTuple):
    """A block of windows of the benchmark: for each length the hashes of their words, a window in each line, and the items of
    the windows, those of window i from ``first[i]`` to ``first[i + 1]`` of ``owners``, as places in ``names``."""

    groups: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    names: list[str]


class Known:
    """Which words the benchmark has: bits for the beginnings of their hashes, of a fixed size. Others may be among them."""

    BITS = 22

    def __init__(self):
        self.bits = np.zeros(1 << self.BITS - 3, np.uint8)

    def add(self, hashes: np.ndarray) -> None:
        place = hashes >> np.uint64(64 - self.BITS)
        np.bitwise_or.at(self.bits, (place >> np.uint64(3)).astype(np.int64), (1 << (place & np.uint64(7)).astype(np.int64)).astype(np.uint8))

    def among(self, hashes: np.ndarray) -> np.ndarray:
        place = hashes >> np.uint64(64 - self.BITS)
        return (self.bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _packed(windows: dict[tuple, set[int]], names: list[str]) -> Phrases:
    by_length: dict[int, list[tuple]] = {}
    for window in windows:
        by_length.setdefault(len(window), []).append(window)
    groups = []
    for _, found in sorted(by_length.items()):
        owners = [sorted(windows[window]) for window in found]
        first = np.cumsum([0, *map(len, owners)])
        groups.append((np.array(found, np.uint64), first, np.array([k for own in owners for k in own], np.int64)))
    return Phrases(groups, names)


def _blocks(items: DataFrame, id_column: str, text_column: str, size: int, known: Known) -> Iterator[Phrases]:
    """The windows of all items, about `BLOCK_WINDOWS` at a time; a long item may go on in the next block."""
    windows: dict[tuple, set[int]] = {}
    numbers: dict[str, int] = {}
    for item, text in items.select(F.col(id_column).cast("string"), F.col(text_column).cast("string")).toLocalIterator():
        for _, data, offsets in pieces(pa.array([text], pa.string())):
            hashes = find_words(data, offsets, ALPHANUMERIC).hashes
            known.add(hashes)
            words = hashes.tolist()
            for k in range(max(len(words) - size + 1, 1)) if words else ():
                owners = windows.setdefault(tuple(words[k : k + size]), set())
                if item is not None:
                    owners.add(numbers.setdefault(item, len(numbers)))
                if len(windows) >= BLOCK_WINDOWS:
                    yield _packed(windows, list(numbers))
                    windows, numbers = {}, {}
    if windows:
        yield _packed(windows, list(numbers))


def _loaded(block: Broadcast) -> Phrases:
    """The value of a broadcast, which the worker doesn't hold on to: one block at a time is in memory."""
    return block.load_from_path(block._path)


class Shard:
    """The index of some documents, whose words stand one after the other.

    Words that the benchmark hasn't can't be in an occurrence. Each run of them, and each
    border between documents, goes into the index as one parting symbol. Its alphabet are the other words of
    the shard itself, so it serves any block of phrases.
    """

    def __init__(self, hashes: np.ndarray, first: np.ndarray, known: Known):
        self.documents = np.repeat(np.arange(len(first) - 1), np.diff(first))
        keep = known.among(hashes)
        self.alphabet, symbols = np.unique(hashes[keep], return_inverse=True)
        starts = first[:-1][first[:-1] < first[1:]]
        parted = keep & ~np.append(False, keep[:-1])
        parted[starts] = keep[starts]
        places = np.flatnonzero(keep)
        # A parting symbol stands before each run of known words.
        slots = np.cumsum(parted[places]) + np.arange(len(places))
        text = np.zeros(len(places) + int(parted.sum()), np.int64)
        text[slots] = symbols + 1
        self.position = np.full(len(text), -1, np.int64)
        self.position[slots] = places
        self.index = FMIndex(text, len(self.alphabet) + 1) if len(text) else None

    def search(self, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
        """Covered stretches of words, as (start, end) lines, and (document, item) lines."""
        nothing = np.zeros((0, 2), np.int64)
        spans, items = [nothing], [nothing]
        for hashes, first, owners in phrases.groups if self.index else ():
            symbols = np.searchsorted(self.alphabet, hashes)
            # A window with a word that the shard hasn't is not in it.
            here = (self.alphabet[np.minimum(symbols, len(self.alphabet) - 1)] == hashes).all(1)
            windows = np.flatnonzero(here)
            low, high = self.index.search(symbols[windows] + 1)
            hits = np.flatnonzero(low < high)
            if not len(hits):
                continue
            counts = high[hits] - low[hits]
            which = np.repeat(hits, counts)
            rows = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + low[which]
            at = self.position[self.index.locate(rows)]
            spans.append(np.stack([at, at + hashes.shape[1]], 1))
            begins, sizes = first[windows[which]], np.diff(first)[windows[which]]
            owned = owners[np.repeat(begins, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)]
            items.append(np.unique(np.stack([np.repeat(self.documents[at], sizes), owned], 1), axis=0))
        return _merged(np.concatenate(spans)), np.unique(np.concatenate(items), axis=0)


def _merged(spans: np.ndarray) -> np.ndarray:
    """Stretches that cover the same words and don't overlap. Those that only touch stay apart."""
    if not len(spans):
        return spans
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    reach = np.maximum.accumulate(spans[:, 1])
    begins = np.append(True, spans[1:, 0] >= reach[:-1])
    ends = np.append(np.flatnonzero(begins)[1:] - 1, len(spans) - 1)
    return np.stack([spans[begins, 0], reach[ends]], 1)


def _finder(blocks: list[Broadcast], known: Known, columns: list[str]):
    """Indexes shard after shard, and searches block after block in each."""

    def shard(texts: list) -> list[pa.Array]:
        hashes = np.concatenate([words.hashes for words in texts])
        first = np.cumsum(np.concatenate([[0], *[words.counts() for words in texts]]))
        index, n_docs = Shard(hashes, first, known), len(first) - 1
        spans = np.zeros((0, 2), np.int64)
        found: dict[int, set[str]] = {}
        for block in blocks:
            phrases = _loaded(block)
            more, items = index.search(phrases)
            spans = _merged(np.concatenate([spans, more]))
            for doc, item in items.tolist():
                found.setdefault(doc, set()).add(phrases.names[item])
        owner = np.searchsorted(first, spans[:, 0], "right") - 1
        hit = np.bincount(owner, spans[:, 1] - spans[:, 0], n_docs).astype(np.int64)
        bounds = pa.array(np.searchsorted(owner, np.arange(n_docs + 1)), pa.int32())
        places = [pa.array(spans[:, k] - first[owner], pa.int64()) for k in (0, 1)]
        return [
            pa.array(np.diff(first)),
            pa.array(hit),
            pa.ListArray.from_arrays(bounds, pa.StructArray.from_arrays(places, ["start", "end"])),
            pa.array([sorted(found.get(k, ())) for k in range(n_docs)], pa.list_(pa.string())),
        ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, begin, held = [], 0, 0
            kept = pa.RecordBatch.from_arrays(batch.column(0).flatten(), columns)
            for at, data, offsets in pieces(batch.column(1)):
                words = find_words(data, offsets, ALPHANUMERIC)
                if texts and held + len(words.hashes) > SHARD_WORDS:
                    yield pa.RecordBatch.from_arrays([*kept.slice(begin, at - begin).columns, *shard(texts)], [*columns, *ADDED])
                    texts, begin, held = [], at, 0
                texts.append(words)
                held += len(words.hashes)
            if texts:
                yield pa.RecordBatch.from_arrays([*kept.slice(begin).columns, *shard(texts)], [*columns, *ADDED])

    return run


ADDED = ["n_words", "n_hit", "spans", "items"]
_TYPES = "n_words long, n_hit long, spans array<struct<start: long, end: long>>, items array<string>"


def find_passages(
    documents: DataFrame,
    items: DataFrame,
    size: int = 10,
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """``documents`` with ``n_words``, ``n_hit`` (words inside an occurrence of a window of the
    benchmark), ``spans`` (the stretches of such words, as word numbers) and ``items`` (their ids).

    Words are runs of digits, letters and characters beyond ASCII, A to Z in lower case. A window is
    ``size`` words in a row of an item, or a shorter item as a whole. Documents are indexed in shards of
    about `SHARD_WORDS` words, each by an `FMIndex`: windows are searched backwards through the ranks
    of a wavelet matrix, occurrences are located by sampled suffix positions, and stretches that
    overlap are merged. Shards are parts of one task's input, so there is no shuffle and a document
    never leaves its row. Windows of the benchmark go to the tasks in blocks of bounded size, about `BLOCK_WINDOWS`, of which a
    task has one in memory at a time; an index is built once and all blocks are searched in it, in one pass over the
    documents. ``spans`` are merged over all blocks.

    Null and empty texts have no words and no hits. Items without words have no windows; an item with
    a null id counts as a hit but is not listed; items that repeat an id are listed once. Rows are
    independent, so repeated rows get equal results. Columns of the input with a name that is added here are
    replaced.
    """
    columns = [name for name in documents.columns if name not in ADDED]
    context, known = documents.sparkSession.sparkContext, Known()
    blocks = [context.broadcast(phrases) for phrases in _blocks(items, item_column, item_text_column, size, known)]
    # Columns of the input travel in one, so that their names can't clash with those used here.
    row = F.struct(*[F.col(f"`{name}`") for name in columns]).alias("row")
    kept = documents.select(*columns)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema), _TYPES])
    return kept.select(row, F.col(text_column).cast("string").alias("read")).mapInArrow(_finder(blocks, known, columns), schema)


def remove_passages(found: DataFrame, text_column: str = "text") -> DataFrame:
    """`find_passages` without the words of the spans, and all between them, in the text.

    A text that is not hit stays as it is, byte for byte. Words on both sides of a span may form a passage that was not
    there before: search the result again, until nothing is found, to be sure.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_column)
            all_spans = batch.column(batch.schema.get_field_index("spans"))
            hit = np.flatnonzero(all_spans.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            if not len(hit):
                yield batch
                continue
            texts, cut = batch.column(at).take(pa.array(hit)).to_pylist(), []
            for text, spans in zip(texts, all_spans.take(pa.array(hit)).to_pylist()):
                for _, data, offsets in pieces(pa.array([text])):
                    words, text = find_words(data, offsets, ALPHANUMERIC), data.tobytes()
                begins = [0, *(int(words.ends[span["end"] - 1]) for span in spans)]
                ends = [*(int(words.starts[span["start"]]) for span in spans), len(text)]
                cut.append(b"".join(text[b:e] for b, e in zip(begins, ends)).decode())
            mask = np.zeros(len(batch), bool)
            mask[hit] = True
            changed = pc.replace_with_mask(batch.column(at), pa.array(mask), pa.array(cut, batch.column(at).type))
            yield batch.set_column(at, batch.schema.field(at).name, changed)

    return found.mapInArrow(run, found.schema)
