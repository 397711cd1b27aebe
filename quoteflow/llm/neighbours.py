"""Approximate nearest neighbours by stable projections.

A projection by independent normal numbers keeps Euclidean distances on average: the squared distance of two
projected vectors, divided by the squared true distance, is distributed as chi-square with as many degrees of
freedom as there are projected dimensions. So vectors are searched in the few projected dimensions, which a
kd-tree can index, nearest first; each is verified by its true distance. Once the next projected distance is
so large that a vector at the distance of the k-th best found would hardly have it, the search stops.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quoteflow.plans.workspace import materialize

# Projected dimensions; an even number, for which the chi-square distribution has a closed form.
PROJECTED = 8
# How sure the stopping test must be that a true neighbour would have been met.
CONFIDENCE = 0.95
# Distinct vectors of a cell, about; bytes of the vectors of a tree; points of a leaf.
CELL = 1 << 15
TREE_BYTES = 1 << 22
LEAF = 256
# Queries, about, that a task takes at a time.
QUERIES = 256
# Vectors, at most, from which the borders of cells are learnt, and so many at least for each cell.
SAMPLE = 100_000
SAMPLE_PER_CELL = 20


def chi_square(x: float, freedom: int) -> float:
    """The distribution function, for an even number of degrees of freedom."""
    term = total = 1.0
    for i in range(1, freedom // 2):
        term *= x / 2 / i
        total += term
    return 1.0 - math.exp(-x / 2) * total


def stopping_ratio(confidence: float, freedom: int) -> float:
    """The x at which the distribution function is ``confidence``."""
    low, high = 0.0, 1.0
    while chi_square(high, freedom) < confidence:
        high *= 2
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, freedom) < confidence else (low, middle)
    return high


def projection(dimensions: int, projected: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dimensions, projected))


class Tree(NamedTuple):
    """A kd-tree. Node i has the points ``order[begin[i]:end[i]]`` in the box ``low[i]`` to ``high[i]``; its
    children are ``child[i]`` and the one after, or none (0)."""

    order: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    child: np.ndarray
    low: np.ndarray
    high: np.ndarray


def build_tree(points: np.ndarray, leaf: int = LEAF) -> Tree:
    """Each node is halved at the median of its widest dimension; equal points are never parted for nothing."""
    order = np.arange(len(points))
    nodes = [(0, len(points))]
    child, low, high = [], [], []
    for begin, end in nodes:
        inside = points[order[begin:end]]
        low.append(inside.min(0))
        high.append(inside.max(0))
        width = high[-1] - low[-1]
        if end - begin <= leaf or not width.max() > 0:
            child.append(0)
            continue
        middle = (end - begin) // 2
        order[begin:end] = order[begin:end][np.argpartition(inside[:, int(width.argmax())], middle)]
        child.append(len(nodes))
        nodes += [(begin, begin + middle), (begin + middle, end)]
    spans = np.array(nodes)
    return Tree(order, spans[:, 0], spans[:, 1], np.array(child), np.array(low), np.array(high))


def incremental(tree: Tree, points: np.ndarray, query: np.ndarray) -> Iterator[tuple[np.ndarray, float]]:
    """Points by rising distance from ``query``, in lots: (their numbers, least squared distance of all later ones)."""
    outside = np.maximum(np.maximum(tree.low - query, query - tree.high), 0.0)
    distance = (outside * outside).sum(1).tolist()
    child, begin, end = tree.child.tolist(), tree.begin, tree.end
    nodes = [(distance[0], 0)]
    far, waiting = np.zeros(0), np.zeros(0, np.int64)
    while nodes:
        _, node = heapq.heappop(nodes)
        if child[node]:
            for k in (child[node], child[node] + 1):
                heapq.heappush(nodes, (distance[k], k))
            continue
        met = tree.order[begin[node] : end[node]]
        away = points[met] - query
        far, waiting = np.append(far, (away * away).sum(1)), np.append(waiting, met)
        # Nothing in the boxes that are left is nearer than the first of them.
        bound = nodes[0][0] if nodes else math.inf
        near = far <= bound
        if near.any():
            lot, far, waiting = waiting[near], far[~near], waiting[~near]
            yield lot, bound


def nearest(
    tree: Tree, points: np.ndarray, vectors: np.ndarray, query: np.ndarray, projected: np.ndarray, k: int, ratio: float, most: float
) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, distances) of the ``k`` nearest found, ties included, that aren't farther than ``most``."""
    found, distances = np.zeros(0, np.int64), np.zeros(0)
    square = float(query @ query)
    for lot, bound in incremental(tree, points, projected):
        near = vectors[lot]
        # By the products first, whose rounding errors are far smaller than the margin; then exactly.
        squares = np.einsum("ij,ij->i", near, near)
        close = squares - 2 * (near @ query) <= most * most - square + 1e-9 * (squares + square)
        lot, near = lot[close], near[close] - query
        found, distances = np.append(found, lot), np.append(distances, np.sqrt((near * near).sum(1)))
        if len(lot) and len(found) >= k:
            most = min(most, float(np.partition(distances, k - 1)[k - 1]))
            keep = distances <= most
            found, distances = found[keep], distances[keep]
        if bound > ratio * most * most:
            break
    keep = distances <= most
    return found[keep], distances[keep]


def _cells(sample: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Borders of cells: per inner node the dimension and the place at which it is cut, and the first child;
    a leaf has a dimension of -1 and its number as child."""
    parts, dimension, place, child = [(sample, cells)], [], [], []
    leaves = 0
    for points, wanted in parts:
        width = points.max(0) - points.min(0) if len(points) > 1 else np.zeros(1)
        if wanted < 2 or not width.max() > 0:
            dimension.append(-1)
            place.append(0.0)
            child.append(leaves)
            leaves += 1
            continue
        d = int(width.argmax())
        cut = float(np.quantile(points[:, d], (wanted // 2) / wanted))
        left = points[:, d] < cut
        if not left.any():
            cut = float(points[points[:, d] > cut, d].min())
            left = points[:, d] < cut
        dimension.append(d)
        place.append(cut)
        child.append(len(parts))
        parts += [(points[left], wanted // 2), (points[~left], wanted - wanted // 2)]
    return np.array(dimension), np.array(place), np.array(child)


def _cell_of(points: np.ndarray, borders: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    dimension, place, child = borders
    node = np.zeros(len(points), np.int64)
    while True:
        inner = np.flatnonzero(dimension[node] >= 0)
        if not len(inner):
            return child[node]
        at = node[inner]
        node[inner] = child[at] + (points[inner, dimension[at]] >= place[at])


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def _placed(plane: np.ndarray, borders):
    """(cell, projected vector) for each vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _matrix(batch.column(1), len(plane)).astype(np.float64) @ plane
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(points) + 1) * plane.shape[1], pa.int32()), pa.array(points.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_cell_of(points, borders)), flat], [*batch.schema.names, "cell", "point"])

    return run


def _planted(leaf: int):
    """A group of vectors as one row with their tree."""

    def run(key, table):
        table = table.sort_by("class").combine_chunks()
        points = table["point"].combine_chunks()
        points = points.flatten().to_numpy().reshape(len(table), -1)
        tree = build_tree(points, leaf)
        vectors = table["vector"].combine_chunks()
        values = vectors.flatten()
        part = lambda x: pa.array([np.ascontiguousarray(x).tobytes()], pa.binary())
        return pa.table(
            {
                "cell": pa.array([key[0].as_py()], pa.int64()),
                "tree": pa.array([key[1].as_py()], pa.int64()),
                "n": pa.array([len(table)], pa.int64()),
                "low": pa.array([tree.low[0].tolist()], pa.list_(pa.float64())),
                "high": pa.array([tree.high[0].tolist()], pa.list_(pa.float64())),
                "classes": part(table["class"].to_numpy()),
                "vectors": part(values.to_numpy().astype(np.float64)),
                "points": part(points),
                "order": part(tree.order),
                "nodes": part(np.stack([tree.begin, tree.end, tree.child], 1)),
                "boxes": part(np.stack([tree.low, tree.high])),
            }
        )

    return run


TREE_SCHEMA = (
    "cell long, tree long, n long, low array<double>, high array<double>, classes binary, vectors binary, points binary, "
    "order binary, nodes binary, boxes binary"
)


def _visited(dimensions: int, projected: int, k: int, ratio: float):
    """The nearest of a tree for the queries that visit it. Groups: one tree, some queries."""

    def run(trees, queries):
        found_q, found_c, found_d = [], [], []
        if len(trees) and len(queries):
            of = lambda name, kind=np.float64: np.frombuffer(trees[name][0].as_py(), kind)
            points, vectors = of("points").reshape(-1, projected), of("vectors").reshape(-1, dimensions)
            classes, nodes = of("classes", np.int64), of("nodes", np.int64).reshape(-1, 3)
            low, high = of("boxes").reshape(2, -1, projected)
            tree = Tree(of("order", np.int64), nodes[:, 0], nodes[:, 1], nodes[:, 2], low, high)
            own = queries["query"].to_numpy()
            most = queries["most"].to_numpy()
            asked = _matrix(queries["vector"].combine_chunks(), dimensions).astype(np.float64)
            at = _matrix(queries["point"].combine_chunks(), projected)
            for i in range(len(own)):
                found, distances = nearest(tree, points, vectors, asked[i], at[i], k, ratio, float(most[i]))
                order = np.lexsort((classes[found], distances))[:k]
                found_q.append(np.full(len(order), own[i]))
                found_c.append(classes[found[order]])
                found_d.append(distances[order])
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        return pa.table(
            {"query": join(found_q, np.int64), "class": join(found_c, np.int64), "distance": join(found_d, np.float64)}
        )

    return run


class Index(NamedTuple):
    """``rows``: (id, vector) of all that take part; ``members``: the first ids, as many as ``copies``, of each
    class of equal vectors, with the smallest, which names the class; ``placed``: classes with vector, projected
    point and cell; ``trees``: a row for each tree."""

    rows: DataFrame
    members: DataFrame
    placed: DataFrame
    trees: DataFrame
    dimensions: int
    projected: int
    copies: int


def _usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, vector) of the rows that take part, but for the length of vectors."""
    given = F.col(f"`{vector_column}`")
    given = given if vectors.schema[vector_column].dataType.simpleString() == "array<float>" else given.cast("array<double>")
    rows = vectors.select(F.col(f"`{id_column}`").cast("long").alias("id"), given.alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("id").isNotNull() & finite & F.exists("vector", lambda x: x != 0))


def _one_each(rows: DataFrame) -> DataFrame:
    """One row of each id, with a hash of its vector."""
    return rows.groupBy("id").agg(F.min("vector").alias("vector")).withColumn("hash", F.xxhash64("vector"))


def build_index(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    k: int = 10,
    projected: int = PROJECTED,
    cell: int = CELL,
    tree_bytes: int = TREE_BYTES,
    leaf: int = LEAF,
    seed: int = 7,
) -> Index | None:
    """Index all vectors; None if there is none. For at most ``k`` neighbours.

    Equal vectors are one class, of which the first ``k`` + 1 ids are kept, as further ones come after these in
    any result; so a vector that very many rows share is no burden. Classes are dealt to cells of projected
    space, whose borders are learnt from `SAMPLE` vectors at most, and the classes of a cell are parted by hash into
    trees of about ``tree_bytes``: nothing grows with the number of rows but the number of trees.

    Rows whose id or vector is null, whose vector is zero, or holds a null or a number that is not finite, take no
    part; nor do vectors of another length than the commonest (of equally common ones the longest). Of rows that
    repeat an id the smallest vector counts. Other columns are left out.
    """
    if projected % 2:
        raise ValueError("the number of projected dimensions must be even")
    rows = _usable(vectors, id_column, vector_column)
    lengths = rows.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    if lengths is None:
        return None
    dimensions = lengths["length"]
    rows = rows.where(F.size("vector") == dimensions)
    of_class = Window.partitionBy("hash", "vector")
    members = _one_each(rows).withColumn("copy", F.row_number().over(of_class.orderBy("id"))).where(F.col("copy") <= k + 1)
    members = materialize(members.withColumn("class", F.min("id").over(of_class)), "members")
    classes = members.where("copy = 1").select("class", "vector")

    plane = projection(dimensions, projected, seed)
    total = classes.count()
    cells = min(-(-total // cell), SAMPLE // SAMPLE_PER_CELL)
    # The smallest hashes: the same sample in each run.
    sample = classes.orderBy(F.xxhash64("class"), "class").limit(min(SAMPLE, 20 * SAMPLE_PER_CELL * cells))
    sample = sample.select("vector").toArrow()["vector"].combine_chunks()
    borders = _cells(_matrix(sample, dimensions) @ plane, cells)
    kind = members.schema["vector"].dataType.simpleString()
    placed = classes.mapInArrow(_placed(plane, borders), f"class long, vector {kind}, cell long, point array<double>")
    placed = materialize(placed, "placed")
    tree = max(1, tree_bytes // (8 * dimensions))
    sizes = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / tree).alias("trees"))
    # No more cells than `SAMPLE` allows.
    dealt = placed.join(F.broadcast(sizes), "cell").withColumn("tree", F.pmod(F.xxhash64("class"), F.col("trees")))
    trees = dealt.select("cell", "tree", "class", "vector", "point").groupBy("cell", "tree").applyInArrow(_planted(leaf), TREE_SCHEMA)
    return Index(rows, members, placed, materialize(trees, "trees"), dimensions, projected, k + 1)


def _visit(index: Index, points: DataFrame, visits: DataFrame, k: int, ratio: float) -> DataFrame:
    """The nearest found by ``visits`` (query, cell, most) in all trees of the cells; ``points`` of the queries."""
    wanted = materialize(visits.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / QUERIES).alias("lots")), "lots")
    lot = F.pmod(F.xxhash64("query"), F.col("lots")).alias("lot")
    asking = visits.join(wanted, "cell").select("query", "cell", "most", lot)
    asking = materialize(asking.join(index.trees.select("cell", "tree"), "cell"), "asking").join(points.drop("cell"), "query")
    growing = index.trees.join(wanted, "cell").withColumn("lot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("lots") - 1)))
    key = ["cell", "tree", "lot"]
    visiting = _visited(index.dimensions, index.projected, k, ratio)
    found = growing.drop("lots").groupBy(key).cogroup(asking.select(*key, "query", "most", "vector", "point").groupBy(key))
    return found.applyInArrow(visiting, "query long, class long, distance double")


def _reached(boxes: list, ratio: float):
    """Further cells that a query must visit, by the stopping test with the nearest point of their boxes."""
    cells = np.array([box["cell"] for box in boxes])
    low, high = (np.array([box[name] for box in boxes]) for name in ("low", "high"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            queries, home, most = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 3))
            points = _matrix(batch.column(2), low.shape[1])
            for i in range(len(queries)):
                outside = np.maximum(np.maximum(low - points[i], points[i] - high), 0.0)
                near = ((outside * outside).sum(1) <= ratio * most[i] * most[i]) & (cells != home[i])
                if near.any():
                    n = int(near.sum())
                    columns = [np.full(n, queries[i]), cells[near], np.full(n, most[i])]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["query", "cell", "most"])

    return run


def search(index: Index | None, queries: DataFrame, k: int = 10, id_column: str = "vec_id", confidence: float = CONFIDENCE) -> DataFrame:
    """For each row of ``queries`` (ids of indexed rows) the ``k`` nearest other rows found: ``query_id``, ``rank``
    (from 1), ``vec_id``, ``score`` (Euclidean distance in double precision), nearest first, ties to smaller ids.

    Equal vectors are asked for once. A query first visits the cell it lies in; the k-th distance
    found there then tells which other cells pass the stopping test by the box they fill, and these are visited
    with that distance as a bound from the start. In each tree `nearest` goes on until the stopping test holds:
    a vector within the k-th distance found would have been met before with a probability of ``confidence``.
    Visits are dealt by cell, tree and lot of queries, so neither a cell of very many vectors nor one that very
    many queries lie in meets in one task.

    Ids that aren't indexed (see `build_index`) have no rows. Fewer rows than ``k`` if there are fewer candidates.
    """
    if index is None:
        return queries.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if k >= index.copies:
        raise ValueError(f"this index is for {index.copies - 1} neighbours")
    ratio = stopping_ratio(confidence, index.projected)
    ids = queries.select(F.col(f"`{id_column}`").cast("long").alias("id")).distinct()
    classes = index.members.where("copy = 1").select("hash", "vector", F.col("class").alias("query"))
    asked = _one_each(index.rows.join(ids, "id", "left_semi")).join(classes, ["hash", "vector"]).select("id", "query")
    asked = materialize(asked, "asked")
    points = index.placed.withColumnRenamed("class", "query").join(asked, "query", "left_semi")
    points = materialize(points, "queries")
    # One more than k, as the query's own row is no candidate.
    most = k + 1
    nearer = Window.partitionBy("query").orderBy("distance", "class")
    home = points.select("query", "cell", F.lit(float("inf")).alias("most"))
    near = materialize(_visit(index, points, home, most, ratio), "near")
    last = near.withColumn("place", F.row_number().over(nearer)).where(F.col("place") <= most)
    last = last.where(F.col("place") == most).select("query", F.col("distance").alias("last"))
    reach = points.join(last, "query", "left")
    reach = reach.select("query", "cell", "point", F.coalesce("last", F.lit(float("inf"))).alias("most"))
    # Cells are few (`SAMPLE`), and so are their boxes.
    low = [F.min(F.col("low")[i]) for i in range(index.projected)]
    high = [F.max(F.col("high")[i]) for i in range(index.projected)]
    boxes = index.trees.groupBy("cell").agg(F.array(*low).alias("low"), F.array(*high).alias("high")).collect()
    further = materialize(reach.mapInArrow(_reached(boxes, ratio), "query long, cell long, most double"), "visits")
    best = near if further.isEmpty() else near.union(_visit(index, points, further, most, ratio))
    # The first k + 1 classes hold the first k + 1 ids: each class is named by its smallest.
    best = best.withColumn("place", F.row_number().over(nearer)).where(F.col("place") <= most)
    found = best.join(index.members.select("class", "id"), "class").select("query", F.col("id").alias("vec_id"), "distance")
    first = Window.partitionBy("query").orderBy("distance", "vec_id")
    found = materialize(found.withColumn("place", F.row_number().over(first)).where(F.col("place") <= most), "found")
    pairs = asked.join(found, "query").where("id <> vec_id")
    ranked = Window.partitionBy("id").orderBy("distance", "vec_id")
    return (
        pairs.withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
        .select(F.col("id").alias("query_id"), "rank", "vec_id", F.col("distance").alias("score"))
    )
