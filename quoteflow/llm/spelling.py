"""Spelling variants: words that differ by one code point, found by permuterm rotations.

A word marked with a terminator, ``word$``, has as many rotations as it has code points and one more. Cut a word
into x, one code point and y: the rotation ``y$x`` + code point shows the rest of the word before the code point
that is left out. So in the sorted rotations of all words those with the same code points around a
replaced one are a range with the prefix ``y$x``, and that range begins with the whole rotation ``y$x`` of the word
xy, which has the code point deleted. Such a range holds a word for each letter at most.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quoteflow.llm.words import find_words, mix, pieces
from quoteflow.plans.workspace import materialize

# Distinct words, about, that a task counts before it passes the counts on.
HELD = 400_000
# Code points of a word up to which its rotations are written out; longer words have digests of them.
WRITTEN = 64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ASCII = np.zeros(256, bool)
_ASCII[65:91] = _ASCII[97:123] = True
_AS_IS = np.arange(256, dtype=np.uint8)
_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    # The polynomial of CRC-32.
    _CRC = np.where(_CRC & 1, (_CRC >> 1) ^ np.uint32(0xEDB88320), _CRC >> 1).astype(np.uint32)


def letters(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The bytes in lower case (A to Z only), and 0 for all but A to Z and U+00C0 to U+00FF.

    In UTF-8 the latter are the byte C3 and one more; C3 is never a later byte of a character.
    """
    lead = data == 0xC3
    inside = _ASCII[data] | lead
    inside[1:] |= lead[:-1]
    return np.where(inside, _LOWER[data], 0).astype(np.uint8)


def crc32(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, begun: np.ndarray) -> np.ndarray:
    """CRC-32 of many stretches of bytes, each going on from a CRC of what stands before it."""
    crc = begun ^ np.uint32(0xFFFFFFFF)
    order = np.argsort(starts - ends, kind="stable")  # the longest first
    lengths, at = (ends - starts)[order], starts[order]
    crc = crc[order]
    for k in range(int(lengths[0]) if len(lengths) else 0):
        n = int(np.searchsorted(-lengths, -k))  # those longer than k
        crc[:n] = _CRC[(crc[:n] ^ data[at[:n] + k]) & np.uint32(0xFF)] ^ (crc[:n] >> np.uint32(8))
    out = np.empty_like(crc)
    out[order] = crc ^ np.uint32(0xFFFFFFFF)
    return out


def _gather(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    widths = ends - starts
    at = np.concatenate([[0], np.cumsum(widths)])
    index = np.arange(at[-1]) + np.repeat(starts - at[:-1], widths)
    return pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(at.astype(np.int32).tobytes()), pa.py_buffer(data[index].tobytes())])


def _damaged(word: bytes, crc: int) -> str:
    """The word without the code point that the CRC picks."""
    text = word.decode()
    return text[: crc % len(text)] + text[crc % len(text) + 1 :]


def _counter(one_in: int, held: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0

        def counted() -> pa.RecordBatch:
            table = pa.concat_tables(parts).group_by("word").aggregate([("n", "sum")])
            return pa.RecordBatch.from_arrays([x.combine_chunks() for x in (table["word"], table["n_sum"])], ["word", "n"])

        for batch in batches:
            ids = batch.column(0).cast(pa.string()).fill_null("").to_pylist()
            for at, data, offsets in pieces(batch.column(1)):
                plain = letters(data, offsets)
                words = find_words(plain, offsets, _AS_IS)
                if not len(words.hashes):
                    continue
                begun = np.array([zlib.crc32(f"{x}:".encode()) for x in ids[at : at + len(offsets) - 1]], np.uint32)
                crc = crc32(plain, words.starts, words.ends, begun[words.texts()])
                struck = crc % np.uint32(one_in) == 0 if one_in else np.zeros(len(crc), bool)
                whole = np.flatnonzero(~struck)
                _, first, n = np.unique(words.hashes[whole], return_index=True, return_counts=True)
                first = whole[first]
                parts.append(pa.table({"word": _gather(plain, words.starts[first], words.ends[first]), "n": pa.array(n, pa.int64())}))
                odd = [
                    _damaged(plain[words.starts[i] : words.ends[i]].tobytes(), int(crc[i])) for i in np.flatnonzero(struck).tolist()
                ]
                if odd:
                    parts.append(pa.table({"word": pa.array(odd, pa.string()), "n": pa.array(np.ones(len(odd), np.int64))}))
                size += len(first) + len(odd)
                if size > held:
                    parts = [pa.Table.from_batches([counted()])]
                    size = len(parts[0])
                    if 2 * size > held:
                        yield parts[0].combine_chunks().to_batches()[0]
                        parts, size = [], 0
        if parts:
            yield counted()

    return run


def count_words(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", one_in: int = 0, held: int = HELD
) -> DataFrame:
    """(``word``, ``n``): all maximal runs of A to Z and U+00C0 to U+00FF in whole texts, A to Z in lower case.

    With ``one_in`` some occurrences lose a code point: where the CRC-32 of ``<id>:<run>`` is divisible by it, the
    one at the place CRC-32 modulo length; an occurrence of one code point then is no word any more. Null and empty
    texts have no words; a null id is written as nothing. Tasks count ``held`` words at a time before the shuffle.
    """
    rows = documents.select(F.col(f"`{id_column}`").cast("string").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    counts = rows.mapInArrow(_counter(one_in, held), "word string, n long")
    return counts.where("word <> ''").groupBy("word").agg(F.sum("n").alias("n"))


def rotations(words: DataFrame) -> DataFrame:
    """(``key``, ``edited``, ``n``) for each word: its whole rotations, of which nothing is left out (``edited`` is empty),
    and its rotations without their last code point, which is ``edited``. Sorted by key."""
    marked = F.concat("word", F.lit("$"), "word")
    placed = words.select("word", "n", F.length("word").alias("length"), marked.alias("marked"))
    placed = placed.select("*", F.explode(F.sequence(F.lit(0), F.col("length"))).alias("i"))
    whole = F.struct(F.substr("marked", F.col("i") + 1, F.col("length") + 1).alias("key"), F.lit("").alias("edited"))
    # The rotation that begins behind code point i of the word, and ends with it.
    around = F.struct(F.substr("marked", F.col("i") + 2, F.col("length")).alias("key"), F.substr("word", F.col("i") + 1, F.lit(1)).alias("edited"))
    both = F.when(F.col("i") < F.col("length"), F.array(whole, around)).otherwise(F.array(whole))
    rows = placed.select("n", F.explode(both).alias("rotation")).select("rotation.key", "rotation.edited", "n")
    return rows.repartition("key").sortWithinPartitions("key")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of sorted rows with whole groups of equal keys only."""
    rest = None
    for batch in batches:
        if rest is not None:
            batch = pa.concat_batches([rest, batch])
        if not len(batch):
            continue
        last = pc.not_equal(batch.column(0), batch.column(0)[-1]).to_numpy(zero_copy_only=False)
        cut = int(np.flatnonzero(last)[-1]) + 1 if last.any() else 0
        rest = batch.slice(cut)
        if cut:
            yield batch.slice(0, cut)
    if rest is not None and len(rest):
        yield rest


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per group and word: how many near words the group has for it, and the best of them.

    A deletion from a run of equal code points shows up once for each of them; the first one counts. Texts in Python compare by code
    points, as UTF-8 does by bytes.
    """
    for batch in _groups(batches):
        keys = batch.column(0)
        new = np.ones(len(batch), bool)
        new[1:] = pc.not_equal(keys.slice(1), keys.slice(0, len(batch) - 1)).to_numpy(zero_copy_only=False)
        begins = np.flatnonzero(new)
        sizes = np.diff(np.append(begins, len(batch)))
        shared = np.repeat(sizes > 1, sizes)
        if not shared.any():
            continue
        kept = batch.filter(pa.array(shared))
        keys, edited, n = (column.to_pylist() for column in kept.columns)
        sizes = sizes[sizes > 1]
        out_word, out_near, out_n, out_best = [], [], [], []
        at = 0
        for size in sizes.tolist():
            behind, before = keys[at].split("$")
            members = sorted(zip(n[at : at + size], edited[at : at + size]), key=lambda x: (-x[0], before + x[1] + behind))
            at += size
            # The whole rotation is near only those whose code point isn't the same as the one before it.
            repeats = before[-1:]
            for count, letter in members:
                if letter:
                    near = [m for m in members if m[1] != letter and (m[1] or letter != repeats)][:1]
                    others = size - 1 - (letter == repeats and any(not m[1] for m in members))
                else:
                    near = [m for m in members if m[1] and m[1] != repeats][:1]
                    others = sum(1 for m in members if m[1] and m[1] != repeats)
                if near:
                    out_word.append(before + letter + behind)
                    out_near.append(others)
                    out_n.append(near[0][0])
                    out_best.append(before + near[0][1] + behind)
        if out_word:
            columns = [pa.array(out_word, pa.string()), pa.array(out_near, pa.int64()), pa.array(out_n, pa.int64()), pa.array(out_best, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["word", "near", "best_n", "best"])


_BEST = "word string, near long, best_n long, best string"


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, word): digests of the rotations of long words, as a number and the word's own number.

    Where a code point is left out, the digest is that of the code points before it and behind it. Digests
    only bring words together; who is near is tested on the words themselves.
    """
    base = 0x9E3779B97F4A7C15
    for batch in batches:
        for word, number in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            points = mix(np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1))
            n = len(points)
            powers = _powers(n + 1, base)
            before = np.concatenate([np.zeros(1, np.uint64), np.cumsum(points * powers[:n], dtype=np.uint64)])
            # The word without code point i: those behind it move down by one place.
            back = np.uint64(pow(base, -1, 1 << 64))
            around = before[:-1] + (before[-1] - before[1:]) * back
            place = np.arange(n + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
            left_out = mix(around + place[:n] + np.uint64(n - 1) * np.uint64(0xA0761D6478BD642F))
            whole = mix(before[-1] + place + np.uint64(n) * np.uint64(0xA0761D6478BD642F))
            keys = np.concatenate([left_out, whole]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.full(len(keys), number))], ["key", "number"])


def one_apart(a: str, b: str) -> bool:
    """Whether the texts differ by exactly one inserted, deleted or replaced code point."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    x, y = (np.frombuffer(t.encode("utf-32-le"), np.uint32) for t in (a, b))
    n = min(len(x), len(y))
    differs = np.flatnonzero(x[:n] != y[:n])
    same = int(differs[0]) if len(differs) else n
    if len(x) == len(y):
        return len(differs) == 1
    longer, shorter = (x, y) if len(x) > len(y) else (y, x)
    return bool((longer[same + 1 :] == shorter[same:]).all())


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words, others = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        yield batch.filter(pa.array([one_apart(a, b) for a, b in zip(words, others)], pa.bool_()))


def _long_neighbours(words: DataFrame) -> DataFrame:
    """The same for words too long to write their rotations out: these would take the square of their length."""
    numbered = materialize(words.withColumn("number", F.xxhash64("word")), "long")
    keys = materialize(numbered.select("word", "number").mapInArrow(_digests, "key long, number long").distinct(), "digests")
    # A key brings together a word for each letter at most, and one more.
    met = keys.join(keys.select("key", F.col("number").alias("other")), "key").where("number <> other")
    pairs = met.select("number", "other").distinct()
    named = pairs.join(numbered.select("number", "word"), "number")
    named = named.join(numbered.select(F.col("number").alias("other"), F.col("word").alias("best"), F.col("n").alias("best_n")), "other")
    near = named.select("word", "best", "best_n").mapInArrow(_verified, "word string, best string, best_n long")
    return near.select("word", F.lit(1).cast("long").alias("near"), "best_n", "best")


def spelling_forms(words: DataFrame, ratio: int = 2, written: int = WRITTEN) -> DataFrame:
    """For each of ``words`` (distinct ``word``, ``n``): ``n_near``, ``form``, ``form_n`` and ``root``.

    Near words differ by one inserted, deleted or replaced code point. The form is the near word of largest n,
    the smallest of these by code points, if its n is at least ``ratio`` times the word's own; else null. The root is the
    last form reached from the word, or the word itself. All rotations of words of up to ``written`` code points
    are sorted and scanned (`rotations`, `_scan`); longer words meet by digests of them and are then compared.
    Null and empty words are left out; words hold no ``$``.
    """
    words = materialize(words.where("word <> ''").select("word", "n"), "words")
    near = rotations(words.where(F.length("word") <= written)).mapInArrow(_scan, _BEST)
    # One code point shorter than the shortest long word: it may be near one of them.
    longer = words.where(F.length("word") >= written)
    if not words.where(F.length("word") > written).isEmpty():
        far = _long_neighbours(longer)
        # Neighbours of up to ``written`` code points have met already.
        far = far.where((F.length("word") > written) | (F.length("best") > written))
        near = near.unionByName(far)
    best = near.groupBy("word").agg(F.sum("near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("n"), "best")).alias("best"))
    found = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.col("best.best").alias("best"), (-F.col("best.n")).alias("best_n")
    )
    chosen = F.col("best_n") >= ratio * F.col("n")
    found = found.select("word", "n", "n_near", F.when(chosen, F.col("best")).alias("form"), F.when(chosen, F.col("best_n")).alias("form_n"))
    found = materialize(found, "forms")
    roots = _roots(found.where("form IS NOT NULL").select("word", F.col("form").alias("to")))
    return found.join(roots.withColumnRenamed("to", "root"), "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
    )


def _roots(steps: DataFrame) -> DataFrame:
    """Where following the steps (``word``, ``to``) ends. Each round doubles the length of the steps, and counts grow by a
    factor with each step, so there are few rounds."""
    steps, moving = materialize(steps, "steps"), True
    while moving:
        onward = steps.select(F.col("word").alias("to"), F.col("to").alias("next"))
        followed = steps.join(onward, "to", "left").select("word", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved"))
        followed = materialize(followed, "steps")
        steps, moving = followed.select("word", "to"), not followed.where("moved").isEmpty()
    return steps
