"""Exact k nearest neighbours in the plane by a k-d tree from a bounded sample.

A sample of the targets' places gives a tree of cuts, broadcast with at most `MAX_LEAVES` leaves. Every target goes to one leaf, every query
place first to its own: the k-th distance there bounds the answer, and the query goes on to just those other leaves whose box of
targets is nearer than that. A leaf is searched in numpy by a tree of its own. Queries of a crowded leaf are cut into blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.functions.geo import distance
from roadpulse.operators.skew import salted_join
from roadpulse.session import materialize

#: Targets meant for a leaf, leaves at most, sampled places for a leaf, queries that search a leaf together.
LEAF_TARGETS, MAX_LEAVES, SAMPLED, QUERY_BLOCK = 20_000, 16_384, 16, 20_000
#: Points in a leaf of the tree inside a task.
INNER = 128
#: Distances are taken a hair larger before anything is left out, so that rounding can't lose a neighbour or a tie.
SLACK = 1 + 1e-9


class Tree:
    """Cuts of the plane at medians, in turn along the longer side. Leaves are numbered from 0."""

    def __init__(self, points: np.ndarray, leaf: int, most: int = 1 << 30):
        self.axis, self.cut, self.child = [], [], []
        self.leaves = 0
        self.root = self._split(points, leaf, most)

    def _split(self, points: np.ndarray, leaf: int, most: int) -> int:
        """Number of a node; leaves count down from -1."""
        if len(points) > leaf and most > 1:
            sides = points.max(0) - points.min(0)
            axis = int(sides.argmax())
            along = points[:, axis]
            cut = float(np.partition(along, (len(along) - 1) // 2)[(len(along) - 1) // 2])
            below = along <= cut
            if below.all():  # more than half of them lie on the largest value
                cut = float(np.nextafter(cut, -np.inf))
                below = along <= cut
            if below.any() and not below.all():
                node = len(self.axis)
                self.axis.append(axis)
                self.cut.append(cut)
                self.child.append((0, 0))
                self.child[node] = (self._split(points[below], leaf, most // 2), self._split(points[~below], leaf, most - most // 2))
                return node
        self.leaves += 1
        return -self.leaves

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        out, todo = np.zeros(len(points), np.int64), [(self.root, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            if node < 0:
                out[rows] = -1 - node
            elif len(rows):
                below = points[rows, self.axis[node]] <= self.cut[node]
                todo += [(self.child[node][0], rows[below]), (self.child[node][1], rows[~below])]
        return out


class Search:
    """A tree with what its leaves hold: the box of their points and how many there are."""

    def __init__(self, tree: Tree, boxes: np.ndarray, counts: np.ndarray):
        self.tree, nodes = tree, len(tree.axis)
        self.box = np.zeros((nodes + tree.leaves, 4))
        self.count = np.zeros(nodes + tree.leaves, np.int64)
        self.box[nodes:], self.count[nodes:] = boxes, counts
        for node in range(nodes - 1, -1, -1):  # children come after their parent
            a, b = (self._at(c) for c in tree.child[node])
            self.box[node, :2] = np.minimum(self.box[a, :2], self.box[b, :2])
            self.box[node, 2:] = np.maximum(self.box[a, 2:], self.box[b, 2:])
            self.count[node] = self.count[a] + self.count[b]

    def _at(self, node: int) -> int:
        return node if node >= 0 else len(self.tree.axis) - 1 - node

    def least(self, node: int, points: np.ndarray) -> np.ndarray:
        """Distance to the box of a node, infinite where it is empty."""
        low, high = self.box[self._at(node), :2], self.box[self._at(node), 2:]
        gap = np.maximum(np.maximum(low - points, points - high), 0)
        return np.sqrt((gap**2).sum(1))

    def reach(self, points: np.ndarray, k: int) -> np.ndarray:
        """A distance within which every point has k others: the far corner of the smallest node around it that holds k."""
        out, todo = np.full(len(points), np.inf), [(self.tree.root, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            at = self._at(node)
            if len(rows) and self.count[at] >= k:
                away = np.maximum(np.abs(points[rows] - self.box[at, :2]), np.abs(points[rows] - self.box[at, 2:]))
                out[rows] = np.minimum(out[rows], np.sqrt((away**2).sum(1)))
                if node >= 0:
                    below = points[rows, self.tree.axis[node]] <= self.tree.cut[node]
                    todo += [(self.tree.child[node][0], rows[below]), (self.tree.child[node][1], rows[~below])]
        return out

    def touched(self, points: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of each leaf whose box is within reach of a point."""
        rows_out, leaves, todo = [], [], [(self.tree.root, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            rows = rows[self.least(node, points[rows]) <= reach[rows] * SLACK]
            if not len(rows) or not self.count[self._at(node)]:
                continue
            if node < 0:
                rows_out.append(rows)
                leaves.append(np.full(len(rows), -1 - node))
            else:
                todo += [(c, rows) for c in self.tree.child[node]]
        return (np.concatenate(rows_out), np.concatenate(leaves)) if rows_out else (np.zeros(0, int), np.zeros(0, int))


def boxes_of(points: np.ndarray, leaf: np.ndarray, leaves: int) -> tuple[np.ndarray, np.ndarray]:
    boxes = np.concatenate([np.full((leaves, 2), np.inf), np.full((leaves, 2), -np.inf)], axis=1)
    np.minimum.at(boxes[:, :2], leaf, points)
    np.maximum.at(boxes[:, 2:], leaf, points)
    return boxes, np.bincount(leaf, minlength=leaves)


def search(targets: np.ndarray, queries: np.ndarray, reach: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, target) rows of the k nearest within `reach` and all that are as near as the k-th; and the narrowed reach."""
    tree = Tree(targets, max(INNER, 2 * k))
    leaf = tree.leaf_of(targets)
    inner = Search(tree, *boxes_of(targets, leaf, tree.leaves))
    order = np.argsort(leaf, kind="stable")
    starts = np.searchsorted(leaf[order], np.arange(tree.leaves + 1))

    def within(rows: np.ndarray, of: int) -> np.ndarray:
        own = targets[order[starts[of] : starts[of + 1]]]
        dx = queries[rows, None, 0] - own[None, :, 0]
        dy = queries[rows, None, 1] - own[None, :, 1]
        return np.sqrt(dx * dx + dy * dy)

    # The own leaf narrows the reach, then leaves within it are searched.
    reach = np.minimum(reach, inner.reach(queries, k))
    home = tree.leaf_of(queries)
    by_home = np.argsort(home, kind="stable")
    cuts = np.searchsorted(home[by_home], np.arange(tree.leaves + 1))
    for of in range(tree.leaves):
        rows = by_home[cuts[of] : cuts[of + 1]]
        if starts[of + 1] - starts[of] >= k:
            for part in np.array_split(rows, len(rows) // 2048 + 1):
                if len(part):
                    reach[part] = np.minimum(reach[part], np.partition(within(part, of), k - 1, axis=1)[:, k - 1])
    rows, leaves = inner.touched(queries, reach)
    by_leaf = np.argsort(leaves, kind="stable")
    rows, cuts = rows[by_leaf], np.searchsorted(leaves[by_leaf], np.arange(tree.leaves + 1))
    found = []
    for of in range(tree.leaves):
        own = rows[cuts[of] : cuts[of + 1]]
        for part in np.array_split(own, len(own) // 2048 + 1):
            if len(part):
                d = within(part, of)
                q, t = np.nonzero(d <= reach[part, None] * SLACK)
                found.append((part[q], order[starts[of] + t], d[q, t]))
    if not found:
        return np.zeros(0, int), np.zeros(0, int), reach
    q, t, d = (np.concatenate(c) for c in zip(*found))
    ordered = np.lexsort((d, q))
    q, t, d = q[ordered], t[ordered], d[ordered]
    first = np.searchsorted(q, q)
    last = np.minimum(first + k - 1, np.searchsorted(q, q, side="right") - 1)
    keep = d <= d[last] * SLACK
    return q[keep], t[keep], reach


def sampled_tree(places: DataFrame, n: int) -> Tree:
    """Cuts from a bounded sample of distinct places (x, y): `SAMPLED` places a leaf, by hash."""
    leaves = min(max(-(-n // LEAF_TARGETS), 1), MAX_LEAVES)
    if leaves == 1:
        return Tree(np.zeros((0, 2)), 1)
    share = F.pmod(F.xxhash64("x", "y"), F.lit(1 << 30)) < int(min(1.0, leaves * SAMPLED / n) * (1 << 30))
    sample = places.filter(share).select("x", "y").limit(2 * MAX_LEAVES * SAMPLED).toArrow()
    return Tree(np.stack([sample.column(c).to_numpy() for c in ("x", "y")], axis=1), SAMPLED, leaves)


def _first_k(candidates: DataFrame, k: int) -> DataFrame:
    """`rank` 1..k of the candidates of each place; also limited before the shuffle."""
    by_place = Window.partitionBy("qx", "qy").orderBy("dist_m", "t_id")
    return candidates.withColumn("rank", F.row_number().over(by_place)).filter(F.col("rank") <= k)


def nearest(queries: DataFrame, targets: DataFrame, k: int) -> DataFrame:
    """(q_id, t_id, dist_m, rank) of the k nearest targets per query point, ties by id.

    Both frames hold (id, x, y); rows without a finite place take no part. Of nodes at one place only the k smallest ids can matter, and query points at
    one place share their candidates, so neither fills a leaf. With fewer than k targets all of them are found.
    """
    spark = queries.sparkSession
    here = "abs(x) < double('inf') AND abs(y) < double('inf')"
    at_place = Window.partitionBy("x", "y").orderBy("id")
    as_double = [F.col(c).cast("double").alias(c) for c in ("x", "y")]
    slim = materialize(
        targets.select("id", *as_double).filter(here).withColumn("_rn", F.row_number().over(at_place)).filter(F.col("_rn") <= k), "targets"
    )
    firsts = slim.filter("_rn = 1")
    tree = sampled_tree(firsts, firsts.count())
    shared = spark.sparkContext.broadcast(tree)

    @F.pandas_udf("int")
    def leaf_at(x, y):
        return type(x)(shared.value.leaf_of(np.stack([x.to_numpy(), y.to_numpy()], axis=1)).astype(np.int32))

    def in_leaf(df: DataFrame) -> DataFrame:
        return df.withColumn("leaf", leaf_at("x", "y") if tree.leaves > 1 else F.lit(0))

    held = in_leaf(slim.select(F.col("id").alias("t_id"), "x", "y"))
    held = materialize(held, "leaves") if tree.leaves > 1 else held
    ends = [pick(c).alias(f"{c}{i}") for i, pick in enumerate((F.min, F.max)) for c in ("x", "y")]
    edges = held.groupBy("leaf").agg(*ends, F.count(F.lit(1)).alias("n"))
    boxes, counts = boxes_of(np.zeros((0, 2)), np.zeros(0, int), tree.leaves)
    for r in edges.collect():
        boxes[r.leaf], counts[r.leaf] = (r.x0, r.y0, r.x1, r.y1), r.n
    outer = spark.sparkContext.broadcast(Search(tree, boxes, counts))
    id_type = dict(held.dtypes)["t_id"]
    found_type = f"qx double, qy double, t_id {id_type}, tx double, ty double, reach double"

    def xy(t: pa.Table) -> np.ndarray:
        return np.stack([t.column(c).to_numpy() for c in ("x", "y")], axis=1)

    def searched(asked: pa.Table, own: pa.Table) -> pa.Table:
        """Finds, and for each query its narrowed reach in a row without a target."""
        points, to = xy(asked), xy(own)
        reach = asked.column("reach").to_numpy()
        q, t = np.zeros(0, int), np.zeros(0, int)
        if len(points) and len(to):
            q, t, reach = search(to, points, reach, k)
        rows = np.concatenate([q, np.arange(len(points))])
        ids = pa.concat_arrays([own.column("t_id").take(pa.array(t)).combine_chunks(), pa.nulls(len(points), own.schema.field("t_id").type)])
        blank = np.full(len(points), np.nan)
        columns = [points[rows, 0], points[rows, 1], ids, np.concatenate([to[t, 0], blank]), np.concatenate([to[t, 1], blank]), reach[rows]]
        return pa.table([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], names=["qx", "qy", "t_id", "tx", "ty", "reach"])

    def visit(asked: DataFrame) -> DataFrame:
        """Queries (x, y, reach, leaf) against the targets of their leaf; those of a crowded leaf in blocks."""
        crowd = {r.leaf: -(-r["count"] // QUERY_BLOCK) for r in asked.groupBy("leaf").count().collect() if r["count"] > QUERY_BLOCK}
        left, right = asked.withColumn("block", F.lit(0)), held.withColumn("block", F.lit(0))
        if crowd:
            blocks = F.broadcast(spark.createDataFrame(list(crowd.items()), "leaf int, blocks int"))
            n = F.coalesce(F.col("blocks"), F.lit(1))
            left = asked.join(blocks, "leaf", "left").withColumn("block", F.pmod(F.xxhash64("x", "y"), n).cast("int")).drop("blocks")
            right = held.join(blocks, "leaf", "left").withColumn("block", F.explode(F.sequence(F.lit(0), n - 1))).drop("blocks")
        return left.groupBy("leaf", "block").cogroup(right.groupBy("leaf", "block")).applyInArrow(searched, found_type)

    def bound(batches):
        for batch in batches:
            points = np.stack([batch.column(i).to_numpy() for i in (0, 1)], axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(outer.value.reach(points, k))], names=["x", "y", "leaf", "reach"])

    def others(batches):
        for batch in batches:
            points = np.stack([batch.column(i).to_numpy() for i in (0, 1)], axis=1)
            reach = batch.column(2).to_numpy()
            rows, leaves = outer.value.touched(points, reach)
            away = leaves != shared.value.leaf_of(points)[rows]
            rows, leaves = rows[away], leaves[away]
            columns = [pa.array(points[rows, 0]), pa.array(points[rows, 1]), pa.array(reach[rows]), pa.array(leaves.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["x", "y", "reach", "leaf"])

    asked_of = queries.select("id", *as_double).filter(here)
    places = in_leaf(asked_of.select("x", "y").distinct())
    places = places.mapInArrow(bound, "x double, y double, leaf int, reach double").select("x", "y", "reach", "leaf")
    found = materialize(visit(materialize(places, "places")), "own-leaf")
    parts = found.filter("tx IS NOT NULL AND NOT isnan(tx)")
    if tree.leaves > 1:
        narrowed = found.filter("isnan(tx)").select(F.col("qx").alias("x"), F.col("qy").alias("y"), "reach")
        far = materialize(narrowed.mapInArrow(others, "x double, y double, reach double, leaf int"), "other-leaves")
        parts = parts.unionByName(visit(far).filter("NOT isnan(tx)"))
    parts = parts.withColumn("dist_m", distance(F.col("qx"), F.col("qy"), F.col("tx"), F.col("ty")))
    best = _first_k(parts, k).select("qx", "qy", "t_id", "dist_m", "rank")
    named = asked_of.select(F.col("id").alias("q_id"), F.col("x").alias("qx"), F.col("y").alias("qy"))
    # A place has k rows in `best`, but may hold any number of queries.
    return salted_join(named, best, ["qx", "qy"], right_is_even=True).select("q_id", "t_id", "dist_m", "rank")
