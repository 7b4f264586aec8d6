"""Embedding near-duplicates: exact pairs above a cosine by dual traversal of cover trees.

Levels of nested nodes with halving radii are laid out in two parts. The upper ones are built by
Spark until no node holds more points than a task takes, and pairs of nodes are followed down level by
level, dropped as soon as their covering radii tell that no two points can be near. The lower
ones are built and traversed in the same way inside the task that compares two leaves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkdex.llm.common import batch_of, components, slices
from inkdex.operators.joins import join_by_weight
from inkdex.session import settle

MIN_COSINE = 0.98
# Points of a leaf, the unit of comparison between tasks; points of a group that a task assigns.
LEAF_POINTS, BLOCK_POINTS = 2048, 8192
# Points of a node that its children's centres are chosen from, and the most children of a node.
SAMPLE_POINTS, MOST_CHILDREN = 256, 64
# Levels after which nodes that still are too large are cut anyhow (radii have halved that often).
MOST_LEVELS = 12
# Inside a task: most children of a node, and points up to which pairs are simply multiplied.
FANOUT, BASE_POINTS = 16, 128
# Room for rounding in bounds; the pairs themselves are decided by their cosine.
SLACK = 1e-9


def spread(points: np.ndarray, most: int, radius: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centres, each the point farthest from those before, until all are within ``radius`` or ``most`` are chosen.

    Returns the centres' places, the nearest centre of each point, and the distance to it.
    """
    chosen, nearest = [0], np.zeros(len(points), np.int64)
    away = np.linalg.norm(points - points[0], axis=1)
    while len(chosen) < most and away.max() > radius:
        far = int(away.argmax())
        to_it = np.linalg.norm(points - points[far], axis=1)
        closer = to_it < away
        nearest[closer], away[closer] = len(chosen), to_it[closer]
        chosen.append(far)
    return np.array(chosen), nearest, away


class Node:
    """A node of a tree in memory: centre, covering radius, the places of its points, and its children."""

    def __init__(self, points: np.ndarray, places: np.ndarray, centre: np.ndarray, radius: float) -> None:
        self.centre, self.radius, self.places, self.children = centre, radius, places, []
        if len(places) > BASE_POINTS and radius > SLACK:
            chosen, nearest, away = spread(points[places], FANOUT, radius / 2)
            for number, place in enumerate(chosen if len(chosen) > 1 else []):
                own = nearest == number
                self.children.append(Node(points, places[own], points[places[place]], float(away[own].max())))


def root_of(points: np.ndarray) -> Node:
    centre = points.mean(axis=0)
    return Node(points, np.arange(len(points)), centre, float(np.linalg.norm(points - centre, axis=1).max()))


class Links:
    """Counts of links per point, and which points links join."""

    def __init__(self, weights: np.ndarray) -> None:
        self.weights, self.links, self.root = weights, np.zeros(len(weights), np.int64), np.arange(len(weights))

    def add(self, one: np.ndarray, other: np.ndarray) -> None:
        """Links between one[i] and other[i], each pair once."""
        size = len(self.links)
        self.links += np.bincount(one, self.weights[other], size).astype(np.int64)
        self.links += np.bincount(other, self.weights[one], size).astype(np.int64)
        self._join(one, other)

    def add_all(self, one: np.ndarray, other: np.ndarray) -> None:
        """Links between every place of ``one`` and every of ``other``."""
        self.links[one] += self.weights[other].sum()
        self.links[other] += self.weights[one].sum()
        self._join(one, np.full(len(one), other[0]))
        self._join(np.full(len(other), one[0]), other)

    def _join(self, one: np.ndarray, other: np.ndarray) -> None:
        a, b = self.root[one], self.root[other]
        apart = a != b
        if not apart.any():
            return
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1)[apart], axis=0)
        for low, high in pairs.tolist():
            while self.root[low] != low:
                low = self.root[low]
            while self.root[high] != high:
                high = self.root[high]
            self.root[max(low, high)] = min(low, high)
        while (again := self.root[self.root]).tolist() != self.root.tolist():
            self.root = again


def traverse(points: np.ndarray, one: Node, other: Node, least: float, links: Links) -> None:
    """Follow two trees down at once; ``one is other`` finds the pairs within a tree, each once."""
    reach = math.sqrt(max(2 - 2 * least, 0.0))
    stack = [(one, other)]
    while stack:
        a, b = stack.pop()
        if a is not b:
            apart = float(np.linalg.norm(a.centre - b.centre))
            if apart - a.radius - b.radius > reach + SLACK:
                continue
            if apart + a.radius + b.radius < reach - SLACK:
                links.add_all(a.places, b.places)
                continue
        if a is b and a.children:
            stack.extend((x, y) for i, x in enumerate(a.children) for y in a.children[i:])
        elif a is not b and a.children and (not b.children or a.radius >= b.radius):
            stack.extend((x, b) for x in a.children)
        elif a is not b and b.children:
            stack.extend((a, y) for y in b.children)
        else:
            _multiply(points, a.places, b.places, least, links)


def _multiply(points: np.ndarray, one: np.ndarray, other: np.ndarray, least: float, links: Links) -> None:
    """All pairs of two sets of places (of one set with itself: each once), by blocks of rows."""
    for start in range(0, len(one), 1024):
        rows = one[start : start + 1024]
        i, j = np.nonzero(points[rows] @ points[other].T >= least)
        if one is other:
            own = i + start < j
            i, j = i[own], j[own]
        if len(i):
            links.add(rows[i], other[j])


_UNITS = pa.schema([("vec_id", pa.int64()), ("label", pa.int64()), ("unit", pa.binary())])


def _units(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, unit): the vector over its length as bytes of doubles, null if it links with nothing."""

    def unit_of(label: int | None, values: list | None) -> bytes | None:
        if label is None or not values or None in values:
            return None
        vector = np.array(values, np.float64)
        largest = np.abs(vector).max()
        if not np.isfinite(vector).all() or largest == 0:
            return None
        vector = vector / largest  # keeps the squares of very large and very small values within range
        return (vector / np.linalg.norm(vector) + 0.0).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1024):
            vec_id, label, values = batch.columns
            units = [unit_of(a, b) for a, b in zip(label.to_pylist(), values.to_pylist(), strict=True)]
            yield batch_of(_UNITS, [vec_id, label, units])

    columns = [F.col(c).cast("bigint").alias(c) for c in ("vec_id", "label")]
    rows = vectors.select(*columns, F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.mapInArrow(run, "vec_id bigint, label bigint, unit binary")


def _matrix(units: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(units), np.float64).reshape(len(units), -1)


_CENTRES = pa.schema([("node", pa.string()), ("number", pa.int32()), ("centre", pa.binary())])
_ASSIGNED = pa.schema([("node", pa.string()), ("class_id", pa.int64()), ("weight", pa.int64()), ("unit", pa.binary()), ("away", pa.float64()), ("number", pa.int32())])
_LEAVES = pa.schema([("node", pa.string()), ("class_ids", pa.binary()), ("weights", pa.binary()), ("units", pa.binary())])
_FOUND = pa.schema([("class_id", pa.int64()), ("links", pa.int64()), ("joined", pa.int64())])


def _choose(radius: float, leaf_points: int):
    """Centres of a node's children, from the sample of its points."""

    def choose(key: tuple, table: pa.Table) -> pa.Table:
        units = table.column("unit").to_pylist()
        wanted = math.ceil(1.5 * table.column("n")[0].as_py() / leaf_points)
        chosen, _, _ = spread(_matrix(units), min(max(wanted, 2), MOST_CHILDREN), radius)
        if len(chosen) < 2:  # this level's radius covers the sample; the next ones are smaller
            chosen, _, _ = spread(_matrix(units), 2, 0.0)
        rows = [[key[0].as_py()] * len(chosen), list(range(len(chosen))), [units[c] for c in chosen]]
        return pa.Table.from_batches([batch_of(_CENTRES, rows)])

    return choose


def _levels(points: DataFrame, leaf_points: int) -> tuple[DataFrame, list[DataFrame]]:
    """Points (node, class_id, weight, unit) in leaves of at most ``leaf_points``, and the nodes of each level.

    A level has the columns parent, node, centre and radius, which covers all points below the node.
    """
    levels = []
    done = []
    for level in range(MOST_LEVELS + 1):
        sizes = settle(points.groupBy("node").agg(F.count(F.lit(1)).alias("n")), "sizes")
        if sizes.where(F.col("n") > leaf_points).isEmpty():
            break
        sized = join_by_weight(points, sizes, "node", "n")
        done.append(sized.where(F.col("n") <= leaf_points).drop("n"))
        large = sized.where(F.col("n") > leaf_points)
        if level == MOST_LEVELS:
            # Points too close to tell apart: any cut does, with the bounds of the node.
            pieces = F.pmod(F.xxhash64("class_id"), F.ceil(F.col("n") / leaf_points * 2).cast("bigint"))
            cut = settle(large.withColumn("parent", F.col("node")).withColumn("node", F.concat_ws("/", "node", pieces)), "cut")
            same = levels[-1].select(F.col("node").alias("parent"), "centre", "radius")
            levels.append(settle(cut.select("parent", "node").distinct().join(same, "parent"), "level"))
            points = cut.select("node", "class_id", "weight", "unit")
            break
        large = settle(large, "large")
        order = Window.partitionBy("node").orderBy(F.xxhash64("class_id"), "class_id")
        sample = large.withColumn("place", F.row_number().over(order)).where(F.col("place") <= SAMPLE_POINTS)
        centres = settle(
            sample.select("node", "n", "unit").groupBy("node").applyInArrow(_choose(1.0 / 2**level, leaf_points), "node string, number int, centre binary"), "centres"
        )
        # A node's points are assigned in blocks; each block gets the centres of its node.
        blocks = F.ceil(F.col("n") / BLOCK_POINTS).cast("int")
        blocked = large.withColumn("block", F.pmod(F.xxhash64("class_id"), blocks).cast("int"))
        per_block = sizes.where(F.col("n") > leaf_points).select("node", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"))
        per_block = per_block.join(centres, "node")

        def assign(key: tuple, table: pa.Table, near: pa.Table) -> pa.Table:
            if not table.num_rows:
                return pa.Table.from_batches([], _ASSIGNED)
            own = _matrix(table.column("unit").to_pylist())
            numbers = near.column("number").to_pylist()
            to_each = np.stack([np.linalg.norm(own - c, axis=1) for c in _matrix(near.column("centre").to_pylist())])
            best = to_each.argmin(axis=0)
            columns = [table.column(c).to_pylist() for c in ("node", "class_id", "weight", "unit")]
            return pa.Table.from_batches([batch_of(_ASSIGNED, [*columns, to_each.min(axis=0), np.array(numbers)[best]])])

        assigned = settle(
            blocked.select("node", "block", "class_id", "weight", "unit")
            .groupBy("node", "block")
            .cogroup(per_block.groupBy("node", "block"))
            .applyInArrow(assign, "node string, class_id bigint, weight bigint, unit binary, away double, number int"),
            "assigned",
        )
        child = F.concat_ws("/", "node", "number")
        radii = assigned.groupBy("node", "number").agg(F.max("away").alias("radius"))
        nodes = radii.join(centres, ["node", "number"])
        levels.append(settle(nodes.select(F.col("node").alias("parent"), child.alias("node"), "centre", "radius"), "level"))
        points = assigned.select(child.alias("node"), "class_id", "weight", "unit")
    for part in done:
        points = points.unionByName(part.select(*points.columns))
    return points, levels


def _near_nodes(roots: DataFrame, levels: list[DataFrame], least: float) -> DataFrame:
    """Pairs of leaves (a, b) of one root, a <= b, that may hold points within reach of each other."""
    reach = math.sqrt(max(2 - 2 * least, 0.0)) + SLACK
    schema = pa.schema([("a", pa.string()), ("b", pa.string())])

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1024):
            one, other, radius_a, radius_b = (batch.column(c) for c in ("centre_a", "centre_b", "radius_a", "radius_b"))
            known = np.array([x.is_valid and y.is_valid for x, y in zip(one, other, strict=True)], bool)
            kept = np.ones(batch.num_rows, bool)
            if known.any():
                apart = [
                    np.linalg.norm(np.frombuffer(x.as_py()) - np.frombuffer(y.as_py()))
                    for x, y, k in zip(one, other, known, strict=True)
                    if k
                ]
                radii = (radius_a.to_numpy(zero_copy_only=False) + radius_b.to_numpy(zero_copy_only=False))[known]
                kept[known] = np.array(apart) - radii <= reach
            yield batch.filter(pa.array(kept)).select(["a", "b"]).cast(schema)

    pairs = roots.select(F.col("node").alias("a"), F.col("node").alias("b"))
    for level in levels:

        def children(side: str, level: DataFrame = level) -> DataFrame:
            names = [F.col("node").alias(f"child_{side}"), F.col("centre").alias(f"centre_{side}"), F.col("radius").alias(f"radius_{side}")]
            return level.select(F.col("parent").alias(side), *names)

        # A leaf of an earlier level stays as it is; without a centre here it is not dropped here.
        both = pairs.join(children("a"), "a", "left").join(children("b"), "b", "left")
        a, b = F.coalesce("child_a", "a"), F.coalesce("child_b", "b")
        both = both.where((F.col("a") != F.col("b")) | (a <= b))
        both = both.select(a.alias("a"), b.alias("b"), "centre_a", "centre_b", "radius_a", "radius_b")
        pairs = settle(both.mapInArrow(prune, "a string, b string"), "pairs")
    return pairs


def near_duplicates(vectors: DataFrame, least: float = MIN_COSINE, leaf_points: int = LEAF_POINTS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of ``vectors`` (vec_id, embedding, label).

    Two rows link if their labels are equal and the cosine of their embeddings, in double precision,
    is at least ``least`` (above 0). ``n_links`` counts the other rows linked directly, ``component_id`` is the
    smallest vec_id that links reach, ``kept`` says whether that is the row's own.

    Null labels, and embeddings that are null, empty, zero, or hold null or non-finite values, link
    with nothing; embeddings of different lengths do not link. Repeated rows are rows of their own, linked
    to each other. A null vec_id is linked like any other but names no component; alone it is kept.
    An empty table gives no rows. Further columns are not read.

    Equal vectors are one point with a weight. No pairs leave a task: counts do, and as many links as
    join the points that links join.
    """
    if not 0 < least <= 1:
        raise ValueError("least must be above 0 and at most 1")
    rows = settle(_units(vectors), "units")
    linkable = rows.where("unit IS NOT NULL").withColumn("key", F.concat(F.col("label").cast("string").cast("binary"), F.lit(":").cast("binary"), "unit"))
    classes = linkable.groupBy("key").agg(
        F.min("label").alias("label"), F.min("unit").alias("unit"), F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("weight")
    )
    classes = settle(classes.withColumn("class_id", F.monotonically_increasing_id()), "classes")
    root = F.concat_ws(":", "label", F.octet_length("unit")).alias("node")
    points = classes.select(root, "class_id", "weight", "unit")
    leaves, levels = _levels(points, leaf_points)

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        ids, weights = (table.column(c).to_numpy() for c in ("class_id", "weight"))
        units = b"".join(table.column("unit").to_pylist())
        return pa.Table.from_batches([batch_of(_LEAVES, [[key[0].as_py()], [ids.tobytes()], [weights.tobytes()], [units]])])

    packed = settle(leaves.groupBy("node").applyInArrow(pack, "node string, class_ids binary, weights binary, units binary"), "leaves")
    pairs = _near_nodes(points.select("node").distinct(), levels, least)
    # Either leaf of a pair comes first as often, so that none meets all of its partners on one side.
    swap = F.pmod(F.xxhash64("a", "b"), F.lit(2)) == 0
    pairs = pairs.select(F.when(swap, F.col("b")).otherwise(F.col("a")).alias("a"), F.when(swap, F.col("a")).otherwise(F.col("b")).alias("b"))

    def side(name: str) -> DataFrame:
        return packed.select(F.col("node").alias(name), *(F.col(c).alias(f"{c}_{name}") for c in ("class_ids", "weights", "units")))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            row = batch.to_pylist()[0]
            ids, weights = (np.frombuffer(row[f"{c}_a"], np.int64) for c in ("class_ids", "weights"))
            points = np.frombuffer(row["units_a"]).reshape(len(ids), -1)
            one = other = root_of(points)
            if row["a"] != row["b"]:
                n, second = len(ids), np.frombuffer(row["class_ids_b"], np.int64)
                theirs = np.frombuffer(row["units_b"]).reshape(len(second), -1)
                other = root_of(theirs)
                stack = [other]
                while stack:
                    node = stack.pop()
                    node.places = node.places + n
                    stack.extend(node.children)
                ids, points = np.concatenate([ids, second]), np.concatenate([points, theirs])
                weights = np.concatenate([weights, np.frombuffer(row["weights_b"], np.int64)])
            links = Links(weights)
            traverse(points, one, other, least, links)
            used = np.flatnonzero(links.links)
            yield batch_of(_FOUND, [ids[used], links.links[used], ids[links.root[used]]])

    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    found = settle(joined.mapInArrow(compare, "class_id bigint, links bigint, joined bigint"), "found")
    links = found.groupBy("class_id").agg(F.sum("links").alias("links"))
    reached = components(found.select(F.col("class_id").alias("a"), F.col("joined").alias("b"))).withColumnRenamed("node", "class_id")
    told = classes.join(links, "class_id", "left").join(reached, "class_id", "left")
    told = told.withColumn("component", F.coalesce("component", "class_id"))
    told = settle(told.select("key", "component", "first", "weight", "links"), "told")
    firsts = told.groupBy("component").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("classes"))
    told = join_by_weight(told, settle(firsts, "firsts"), "component", "classes")
    told = told.select("key", "weight", "component_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    linked = join_by_weight(settle(linkable, "linkable"), settle(told, "told"), "key", "weight")
    linked = linked.select("vec_id", "n_links", "component_id")
    alone = rows.where("unit IS NULL").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
