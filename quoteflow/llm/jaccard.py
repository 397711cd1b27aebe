"""Similarity join of documents by the Jaccard coefficient of their shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quoteflow.llm.graph import components
from quoteflow.llm.presence import among, present
from quoteflow.llm.scratch import Scratch
from quoteflow.llm.words import SPACED, find_words, mix, pieces, shingles
from quoteflow.plans.workspace import materialize

# Fragments of the n-gram order in which overlaps are counted.
FRAGMENTS = 8
# A sketch bounds overlaps before they are counted: sizes of so many finer fragments, and bits, in words of 16, of which an
# n-gram sets one. Sizes tell more about long texts and bits about short ones.
SIZES, WORDS = 128, 128
SKETCH = SIZES + WORDS
# Rounds in which members of a bucket are compared with one of them, before those that remain are compared.
HUB_ROUNDS = 2
# Members of a bucket, about, that one row holds when those that remain are compared.
BLOCK = 256


class Cuts:
    """How sets of a size are cut so that linked sets agree in whole fragments.

    Sets A and B link when ``100 * |A & B| >= percent * |A | B|``. Then they differ in at most
    ``(100 - percent) * (|A| + |B|) / (100 + percent)`` n-grams. Cut the n-gram order into more
    fragments than that and some fragments hold no difference. The number of fragments must be the same
    for both, so it belongs to a class of sizes. A set is cut for its own class, and also for the next one if
    it is large enough to link with a set in there.
    """

    def __init__(self, percent: int):
        self.percent = percent
        # Sizes of a class: fewer fragments for the smallest against fewer sets cut for two classes.
        self.ratio = (100 / percent) ** 3
        # Sets smaller than this link only if they are equal.
        self.smallest = next(n for n in range(1, 10**6) if self.differences(n, n + 1) or self.differences(n, n))
        self.bounds = [self.smallest]

    def differences(self, a: int, b: int) -> int:
        return (100 - self.percent) * (a + b) // (100 + self.percent)

    def _bound(self, k: int) -> int:
        while len(self.bounds) <= k:
            self.bounds.append(int(self.bounds[-1] * self.ratio) + 1)
        return self.bounds[k]

    def __call__(self, n: int) -> list[tuple[int, int, int]]:
        """(class, fragments, least number of them that agree) for which a set of ``n`` is cut."""
        if n < self.smallest - 1:
            return []
        k = 0
        while self._bound(k + 1) <= n:
            k += 1
        classes = [k] if n >= self.smallest else []
        follow = k + 1 if classes else 0
        if 100 * n >= self.percent * self._bound(follow):
            classes.append(follow)
        found = []
        for k in classes:
            largest = self._bound(k + 1) - 1
            fragments = self.differences(largest, largest) + 3
            found.append((k, fragments, fragments - self.differences(n, min(largest, 100 * n // self.percent))))
        return found


def signatures(grams: np.ndarray, cuts: Cuts) -> np.ndarray:
    """Hashes of the fragments of a sorted set, one for each class and fragment that isn't empty.

    Two sets that both have no n-gram in a fragment agree there without having anything in common. A
    set with fewer empty fragments than must agree shares one that isn't empty with each set that it
    links with. For two sets that both have more of them there is the prefix argument: linked sets
    share an n-gram among their first few, so such a set gets its first n-grams as signatures, too.
    """
    found, n = [], len(grams)
    running = np.zeros(n + 1, np.uint64)
    np.cumsum(mix(grams), out=running[1:])
    sparse = False
    for k, fragments, agreeing in cuts(n):
        # Fragment f holds the n-grams from f * 2 ** 64 / fragments on.
        borders = [0, *((f << 64) // fragments for f in range(1, fragments))]
        at = np.append(np.searchsorted(grams, np.array(borders, np.uint64)), n)
        filled = np.flatnonzero(np.diff(at))
        sums = running[at[filled + 1]] - running[at[filled]]
        tag = (np.uint64(k) << np.uint64(32)) + filled.astype(np.uint64) + np.uint64(1)
        found.append(mix(sums + mix(tag) * np.uint64(0xD6E8FEB86659FD93)))
        sparse |= fragments - len(filled) >= agreeing
    if sparse:
        prefix = n - -(-cuts.percent * n // 100) + 1
        found.append(mix(grams[:prefix] + np.uint64(0xA0761D6478BD642F)))
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


# The largest size of a sketch, which stands for any that is not smaller; it rules nothing out.
FULL = 32767


def _sketch(grams: np.ndarray) -> np.ndarray:
    """Sizes of `SIZES` fragments, and the bits that the n-grams set.

    The sum of the smaller sizes of two sets is at least their overlap. A bit that only one of them has set stands for an
    n-gram, at least, that the other hasn't.
    """
    shift = np.uint64(64 - (SIZES - 1).bit_length())
    sizes = np.bincount((grams >> shift).astype(np.int64), minlength=SIZES)
    bits = np.zeros(16 * WORDS, bool)
    bits[(grams % np.uint64(len(bits))).astype(np.int64)] = True
    return np.concatenate([np.minimum(sizes, FULL).astype(np.int16), np.packbits(bits).view(np.int16)])


def _key(grams: np.ndarray) -> np.uint64:
    """The class of a set: sets of equal n-grams, and only they but for chance, have equal keys."""
    sums = [mix(grams + np.uint64(salt)).sum(dtype=np.uint64) for salt in (17, 0x5851F42D4C957F2D)]
    return mix(np.array([sums[0]]) + mix(np.array([sums[1]]) + np.uint64(len(grams))))[0]


def _keys(sets: list[np.ndarray]) -> pa.Array:
    return pa.array(np.array([_key(grams) for grams in sets], np.uint64).view(np.int64))


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    """Lists of hashes as signed numbers of their width."""
    ends = np.cumsum([0] + [len(part) for part in parts])
    flat = np.concatenate(parts)
    flat = flat.view(f"i{flat.itemsize}")
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))


def _sets(size: int):
    """Per document the number of shingles and the key of the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, offsets in pieces(batch.column(2)):
                sets = shingles(find_words(data, offsets, SPACED), size)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(sets)),
                        batch.column(1).slice(at, len(sets)),
                        pa.array(np.array([len(grams) for grams in sets], np.int64)),
                        _keys(sets),
                    ],
                    ["id", "text_hash", "n", "key"],
                )

    return run


def _signed(size: int, cuts: Cuts, met: np.ndarray | None = None):
    """The signatures of all sets; with ``met``, those that are in that table, and the key of the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in pieces(batch.column(0)):
                sets = [grams for grams in shingles(find_words(data, offsets, SPACED), size) if len(grams)]
                if not sets:
                    continue
                found = [signatures(grams, cuts) for grams in sets]
                flat = np.concatenate(found).view(np.int64)
                if met is None:
                    yield pa.RecordBatch.from_arrays([pa.array(flat)], ["signature"])
                    continue
                kept = np.flatnonzero(among(met, flat))
                owner = np.repeat(np.arange(len(sets)), [len(part) for part in found])[kept]
                yield pa.RecordBatch.from_arrays([pa.array(flat[kept]), _keys(sets).take(pa.array(owner))], ["signature", "key"])

    return run


def _wanted(batches: Iterator[pa.RecordBatch], size: int, *tables: np.ndarray) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """Hashes and sets of all rows whose hash is in one of the tables, and perhaps of others."""
    for batch in batches:
        hashes = batch.column(0).to_numpy(zero_copy_only=False)
        batch = batch.filter(pa.array(np.logical_or.reduce([among(table, hashes) for table in tables])))
        for at, data, offsets in pieces(batch.column(1)):
            sets = shingles(find_words(data, offsets, SPACED), size)
            yield batch.column(0).slice(at, len(sets)).to_numpy(zero_copy_only=False), sets


def _sketches(size: int, wanted: np.ndarray):
    """The size and the sketch of each set that is wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in _wanted(batches, size, wanted):
            sizes = pa.array(np.array([len(grams) for grams in sets], np.int64))
            ends = np.arange(len(sets) + 1) * SKETCH
            flat = np.concatenate([_sketch(grams) for grams in sets]) if sets else np.zeros(0, np.int16)
            sketches = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([_keys(sets), sizes, sketches], ["key", "n", "sketch"])

    return run


def _segments(size: int, fragments: int, of_a: np.ndarray, of_b: np.ndarray, coarse: bool):
    """Per set that is wanted on either side of a pair and fragment of the n-gram order the n-grams in it and their number.

    If ``coarse``, of the n-grams only the last 16 bits, each value once.
    """
    bits = np.uint64(64 - (fragments - 1).bit_length())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hashes, sets in _wanted(batches, size, of_a, of_b):
            cut = [np.searchsorted(grams >> bits, np.arange(fragments + 1)) for grams in sets]
            parts = [grams[at[f] : at[f + 1]] for grams, at in zip(sets, cut) for f in range(fragments)]
            each = pa.array(np.repeat(np.arange(len(sets)), fragments))
            columns = {
                "key": _keys(sets).take(each),
                "n": pa.array(np.array([len(grams) for grams in sets], np.int64)).take(each),
                "fragment": pa.array(np.tile(np.arange(fragments), len(sets)), pa.int32()),
                "of_a": pa.array(among(of_a, hashes)).take(each),
                "of_b": pa.array(among(of_b, hashes)).take(each),
                "grams": pa.array(np.array([len(part) for part in parts], np.int64)),
                "segment": _lists([np.unique(part.astype(np.uint16)) for part in parts] if coarse else parts),
            }
            yield pa.RecordBatch.from_arrays([*columns.values()], [*columns])

    return run


def _bounded(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` whose sketches don't rule a link out."""
    of_a = sketches.select(F.col("key").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("s_a"))
    of_b = sketches.select(F.col("key").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("s_b"))
    both = pairs.join(of_a, "a").join(of_b, "b")
    total = lambda parts: F.aggregate(parts, F.lit(0), lambda sum_, x: sum_ + x)
    part = lambda name, kind: F.slice(name, 1, SIZES) if kind == "sizes" else F.slice(name, SIZES + 1, WORDS)
    smaller = total(F.zip_with(part("s_a", "sizes"), part("s_b", "sizes"), lambda x, y: F.least(x, y)))
    # Bits are counted in words of 16, which are signed.
    alone = lambda x, y: F.bit_count(x.cast("int").bitwiseAND(F.bitwise_not(y.cast("int"))).bitwiseAND(F.lit(0xFFFF)))
    only_a = total(F.zip_with(part("s_a", "bits"), part("s_b", "bits"), alone))
    only_b = total(F.zip_with(part("s_b", "bits"), part("s_a", "bits"), alone))
    most = F.least(smaller, F.col("n_a") - only_a, F.col("n_b") - only_b)
    full = (F.array_max(part("s_a", "sizes")) == FULL) | (F.array_max(part("s_b", "sizes")) == FULL)
    both = both.select("a", "b", (F.col("n_a") + F.col("n_b")).alias("n"), most.alias("most"), full.alias("full"))
    return both.where(F.col("full") | (F.col("most") * 100 >= (F.col("n") - F.col("most")) * percent)).select("a", "b")


def _between(percent: int):
    """Pairs of members of two blocks of a bucket that are in different components and aren't ruled out."""

    def members(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lists = column[k].values
        of = lambda name: lists.field(name).to_numpy(zero_copy_only=False)
        sketches = lists.field("sketch").flatten().to_numpy(zero_copy_only=False).reshape(-1, SKETCH)
        return of("key"), of("component"), sketches

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                ids, components_, sketches = members(batch.column(0), k)
                others, other_components, other_sketches = members(batch.column(1), k)
                other_sizes, other_bits = other_sketches[:, :SIZES], other_sketches[:, SIZES:]
                totals, full = other_sizes.sum(1, dtype=np.int64), other_sizes.max(1) == FULL
                found = []
                for i in range(len(ids)):
                    open_ = np.flatnonzero((other_components != components_[i]) & (others > ids[i]))
                    sizes, bits = sketches[i, :SIZES], sketches[i, SIZES:]
                    own, theirs = sizes.sum(dtype=np.int64), totals[open_]
                    met = other_bits[open_]
                    most = np.minimum.reduce(
                        [
                            np.minimum(sizes, other_sizes[open_]).sum(1, dtype=np.int64),
                            own - np.bitwise_count((bits & ~met).view(np.uint16)).sum(1, dtype=np.int64),
                            theirs - np.bitwise_count((met & ~bits).view(np.uint16)).sum(1, dtype=np.int64),
                        ]
                    )
                    may = (most * 100 >= (own + theirs - most) * percent) | full[open_] | (sizes.max() == FULL)
                    hits = others[open_[may]]
                    found.append(np.stack([np.full(len(hits), ids[i]), hits], 1))
                pairs = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
                if len(pairs):
                    yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return run


def _buckets(labeled: DataFrame, turn: int) -> DataFrame:
    """The buckets whose members (signature, key, component) are in different components, with a hub and its component.

    Of buckets of the same members, as texts that share several fragments give, there is one; they are told by their size and
    two sums of hashes of their keys. The hub depends on the members and the turn.
    """
    order = F.xxhash64("key", F.lit(turn)) if turn else F.col("key")
    sums = [F.sum(F.xxhash64("key", F.lit(salt)).cast("decimal(20,0)")).alias(name) for salt, name in ((-1, "sum"), (-2, "other_sum"))]
    buckets = labeled.groupBy("signature").agg(
        F.min("component").alias("low"),
        F.max("component").alias("high"),
        F.min_by("key", order).alias("hub"),
        F.min_by("component", order).alias("hub_component"),
        F.count(F.lit(1)).alias("size"),
        *sums,
    )
    same = ["size", "sum", "other_sum", "hub", "hub_component"]
    return buckets.where("low < high").groupBy(same).agg(F.min("signature").alias("signature")).select("signature", "hub", "hub_component")


def _remaining(members: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs of members of the same bucket (signature, key, component) that are in different
    components and aren't ruled out. Members meet in rows of about `BLOCK` of them; only pairs that may
    link become rows."""
    sizes = members.groupBy("signature").agg(F.count(F.lit(1)).alias("size"))
    sizes = sizes.select("signature", F.ceil(F.col("size") / BLOCK).alias("blocks"))
    placed = members.join(sizes, "signature").join(sketches, "key")
    placed = placed.withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")))
    blocks = placed.groupBy("signature", "block", "blocks").agg(
        F.collect_list(F.struct("key", "component", "sketch")).alias("members")
    )
    # Ordered pairs of blocks, as a member is compared with larger keys only.
    partner = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    left = blocks.select("signature", F.col("members").alias("x"), partner.alias("block"))
    met = left.join(blocks.select("signature", "block", F.col("members").alias("y")), ["signature", "block"])
    return met.select("x", "y").mapInArrow(_between(percent), "a long, b long").distinct()


def _overlaps(pairs: DataFrame, segments: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (``a``, ``b``) that link: overlaps counted per fragment, then summed per pair.

    Of coarse segments, those that may link: n-grams whose values differ do, so an overlap is at most the values that both
    have and, for the smaller surplus, the n-grams that share a value with others of their set.
    """
    cut = lambda x: segments.where(f"of_{x}").select(
        F.col("key").alias(x), "fragment", F.col("n").alias(f"n_{x}"), F.col("grams").alias(f"grams_{x}"), F.col("segment").alias(f"in_{x}")
    )
    fragments = F.explode(F.array(*[F.lit(f) for f in range(FRAGMENTS)]))
    parts = pairs.select("a", "b", fragments.alias("fragment")).join(cut("a"), ["a", "fragment"])
    parts = parts.join(cut("b"), ["b", "fragment"]).where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
    surplus = F.least(F.col("grams_a") - F.size("in_a"), F.col("grams_b") - F.size("in_b"))
    parts = parts.select("a", "b", "n_a", "n_b", (F.size(F.array_intersect("in_a", "in_b")) + surplus).alias("common"))
    # A set may have been cut more than once; then each of its fragments is there equally often.
    total = parts.groupBy("a", "b", "n_a", "n_b").agg(
        (F.sum("common") * FRAGMENTS / F.count(F.lit(1))).cast("long").alias("common")
    )
    return total.where(F.col("common") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("common")) * percent).select("a", "b")


def jaccard_classes(
    documents: DataFrame,
    shingle: int = 3,
    percent: int = 90,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """For each row its id, ``text_hash``, ``n_shingles``, ``representative``, ``component_id`` and ``component``.

    Texts are compared by the sets of their shingles (`shingles`, A to Z in lower case). Rows with
    equal sets are one class, of which ``representative`` is the smallest id. Two classes link when their intersection is at
    least ``percent`` per cent of their union, and ``component_id`` is the smallest id that links
    reach. Nothing is left out: candidates are complete (`Cuts`) and each is verified exactly.

    The n-gram order is the order of 64-bit hashes; it is cut into fragments twice. For candidates,
    classes with an equal fragment meet in a bucket. A bucket does not emit all its pairs: its
    members are compared with one of them, a hub, which then leaves it; only members that are still in different
    components meet other hubs, and after such rounds (`HUB_ROUNDS`) each other, in blocks. Of buckets of the same members one stays. Sizes of finer
    fragments bound the overlap of a pair; where the bound allows a link, the overlap is counted in each
    of `FRAGMENTS` fragments separately and summed per pair, first of n-grams cut to 16 bits, which bounds it, and of
    whole ones where that bound allows a link.

    A null text or one without words has no shingles and links with nothing. A null id gets no
    component (null) and takes no part. Classes are known by a 64-bit key of their set, so rows that repeat an id with
    another text are in the class of that text; ids may be numbers or texts. A row is told by its id and ``text_hash``
    (`xxhash64` of the text), a component by the number ``component``, null where nothing is linked for want of words or
    id. Other columns, whatever their names, are left out; join for them.
    """
    spark, scratch, cuts = documents.sparkSession, Scratch(documents.sparkSession), Cuts(percent)
    text = F.col(text_column).cast("string")
    rows = documents.select(F.col(id_column).alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    sets = scratch.table(rows.mapInArrow(_sets(shingle), f"id {id_type}, text_hash long, n long, key long"), "sets")
    worded = sets.where("n > 0 AND id IS NOT NULL")
    copies = worded.groupBy("key").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("rows"))
    copies = scratch.table(copies.where("rows > 1").drop("rows"), "copies")
    named = sets.select("id", "text_hash", "n", "key").join(copies, "key", "left")
    takes_part = (F.col("n") > 0) & F.col("id").isNotNull()
    named = named.select("id", "text_hash", "n", F.when(takes_part, F.col("key")).alias("key"), F.coalesce("first", "id").alias("first"))
    named = materialize(named, "classes")
    scratch.release(copies)

    # Signatures that occur more than once, and the classes that have them. They take more room than texts, so they are made
    # twice rather than written.
    texts = rows.where("id IS NOT NULL").select("text")
    met = texts.mapInArrow(_signed(shingle, cuts), "signature long").groupBy("signature").count()
    met = scratch.table(met.where("count > 1").select("signature"), "met")
    signed = texts.mapInArrow(_signed(shingle, cuts, present(met)), "signature long, key long")
    members = scratch.table(signed.join(met, "signature").distinct(), "members")
    scratch.release(met)

    sketches, links, chosen = None, None, None
    labels = spark.range(0).select(F.col("id").alias("key"), F.col("id").alias("component"))
    cut = rows.where("id IS NOT NULL").select(F.xxhash64("id", "text_hash").alias("hash"), "text")
    turn, last = 0, False
    while not last:
        labeled = members.join(labels, "key", "left").withColumn("component", F.coalesce("component", "key"))
        # Members of buckets with one component are settled, and stay so.
        unsettled = scratch.table(labeled.join(_buckets(labeled, turn), "signature"), "unsettled")
        scratch.release(members)
        members = unsettled
        if members.isEmpty():
            break
        last = turn >= HUB_ROUNDS
        if sketches is None:
            # Only classes that share a bucket are compared, so hardly any others are cut again.
            # A class of very many copies is reduced to its first row before any join.
            first = worded.groupBy("key").agg(F.min(F.struct("id", "text_hash")).alias("row"))
            chosen = first.join(members.select("key").distinct(), "key", "left_semi")
            chosen = scratch.table(chosen.select("key", F.xxhash64("row.id", "row.text_hash").alias("hash")), "chosen")
            scratch.release(sets)
            sketched = cut.mapInArrow(_sketches(shingle, present(chosen.select("hash"))), "key long, n long, sketch array<smallint>")
            sketches = scratch.table(sketched.dropDuplicates(["key"]), "sketches")
        if last:
            pairs = _remaining(members.select("signature", "key", "component"), sketches, percent)
        else:
            apart = members.where("component <> hub_component")
            apart = apart.select(F.least("hub", "key").alias("a"), F.greatest("hub", "key").alias("b"))
            pairs = _bounded(apart.distinct(), sketches, percent)
        pairs = scratch.table(pairs, "pairs")
        # The hub of a bucket has met all its members.
        members = scratch.table(members.where("key <> hub").select("signature", "key"), "members")
        scratch.release(unsettled)
        turn += 1
        if pairs.isEmpty():
            scratch.release(pairs)
            continue
        # Few classes are left in pairs, so their n-grams are cut for each round anew and no others are moved: first in
        # a coarse form, as most pairs that the sketches leave don't link.
        for coarse in (True, False):
            ends = [pairs.select(F.col(end).alias("key")).distinct() for end in ("a", "b")]
            wanted = [present(chosen.join(end, "key", "left_semi").select("hash")) for end in ends]
            schema = "key long, n long, fragment int, of_a boolean, of_b boolean, grams long, segment array<" + ("smallint>" if coarse else "long>")
            segments = cut.mapInArrow(_segments(shingle, FRAGMENTS, *wanted, coarse), schema)
            segments = scratch.table(segments, "coarse-segments" if coarse else "segments")
            linked = scratch.table(_overlaps(pairs, segments, percent), "linked")
            scratch.release(pairs, segments)
            pairs = linked
            if linked.isEmpty():
                break
        if linked.isEmpty():
            continue
        links = linked if links is None else scratch.table(links.union(linked), "links")
        labels = components(links).withColumnRenamed("node", "key")
    scratch.release(members, *([sketches, chosen] if sketches else [sets]))
    # The smallest ids of components of several classes.
    named = named.withColumnRenamed("n", "n_shingles").join(labels, "key", "left")
    smallest = named.where("component IS NOT NULL").groupBy("component").agg(F.min("first").alias("smallest"))
    named = named.join(materialize(smallest, "smallest"), "component", "left")
    return named.select(
        F.col("id").alias(id_column),
        "text_hash",
        "n_shingles",
        F.col("first").alias("representative"),
        F.coalesce("smallest", "first").alias("component_id"),
        F.coalesce("component", "key").alias("component"),
    )
