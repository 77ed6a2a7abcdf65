"""Hulls and the sampled k-d tree against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadpulse.operators import graph, hull, neighbours


def frame(spark, points, parts=4):
    rows = [(i, float(x), float(y)) for i, (x, y) in enumerate(points)]
    return spark.createDataFrame(rows, "id long, x double, y double").repartition(parts)


def brute(points):
    p = np.array(points, float)
    return max(float(np.sqrt(((p - a) ** 2).sum(1)).max()) for a in p)


RNG = np.random.default_rng(2)
TURN = np.linspace(0, 2 * np.pi, 400, endpoint=False)
SETS = {
    "disc": RNG.normal(size=(700, 2)),
    "square": RNG.random((700, 2)) * 5 + 6e6,
    "circle": np.c_[np.cos(TURN), np.sin(TURN)] * 1000 + 5e5,
    "polygon": np.c_[np.cos(TURN[::80]), np.sin(TURN[::80])],
    "rectangle": [(0, 0), (4, 0), (4, 1), (0, 1), (2, 0), (2, 1), (0, 0)],
    "triangle": [(0, 0), (10, 1), (3, 9)],
    "line": [(i, 2 * i) for i in range(50)],
    "copies": [(3, 4)] * 80,
    "two": [(0, 0), (3, 4), (0, 0)],
    "grid": [(i, j) for i in range(20) for j in range(15)],
}


@pytest.mark.parametrize("name", list(SETS))
def test_furthest_of_a_hull(name):
    points = np.array(SETS[name], float)
    assert hull.furthest(hull.convex_hull(points)) == pytest.approx(brute(points), rel=1e-12, abs=1e-9)


def test_hull_of_random_small_sets():
    for seed in range(300):
        rng = np.random.default_rng(seed)
        points = rng.integers(0, 8, (rng.integers(1, 30), 2)).astype(float)
        assert hull.furthest(hull.convex_hull(points)) == pytest.approx(brute(points))


@pytest.mark.parametrize("shape", ["disc", "circle"])
def test_furthest_of_many_points_without_pairs(spark, shape):
    n = 100_000
    angle = F.rand(3) * 2 * np.pi
    away = F.sqrt(F.rand(4)) * 5000 if shape == "disc" else F.lit(5000.0)
    points = spark.range(0, n, 1, 8).select((F.cos(angle) * away).alias("x"), (F.sin(angle) * away).alias("y"))
    points = points.union(spark.createDataFrame([(-6000.0, 1.0), (6000.0, -2.0)], "x double, y double"))
    found = hull.furthest_distance(points)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("MapInArrow") == 4
    assert found.first().furthest_m == pytest.approx(np.hypot(12_000, 3))
    if shape == "disc":
        assert hull.hull_of(points).count() < 1000


def test_furthest_of_nothing_and_of_odd_rows(spark):
    assert hull.furthest_distance(spark.createDataFrame([], "x double, y double")).first().furthest_m is None
    odd = spark.createDataFrame([(0.0, 0.0), (None, 1.0), (float("nan"), 1.0), (float("inf"), 2.0), (3.0, 4.0)], "x double, y double")
    assert hull.furthest_distance(odd).first().furthest_m == 5.0


@pytest.fixture(scope="module")
def cloud():
    """Scattered and clustered places, a grid full of ties, copies of one place, an outlier."""
    rng = np.random.default_rng(9)
    grid = [(100.0 * i, 100.0 * j) for i in range(15) for j in range(15)]
    return np.vstack([rng.uniform(0, 1e4, (500, 2)), rng.normal(5000, 5, (300, 2)), grid, np.full((400, 2), 777.0), [[9e5, -9e5]]])


def brute_nearest(queries, targets, k):
    out = {}
    for i, q in enumerate(queries):
        d = np.sqrt((q[0] - targets[:, 0]) ** 2 + (q[1] - targets[:, 1]) ** 2)
        out[i] = np.lexsort((np.arange(len(targets)), d))[:k].tolist()
    return out


@pytest.mark.parametrize("leaf, block", [(20_000, 20_000), (40, 25)])
@pytest.mark.parametrize("k", [1, 9])
def test_nearest_over_leaves_and_blocks(spark, cloud, monkeypatch, leaf, block, k):
    monkeypatch.setattr(neighbours, "LEAF_TARGETS", leaf)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", block)
    rng = np.random.default_rng(4)
    queries = np.vstack([cloud[::3], rng.uniform(-2e4, 3e4, (150, 2)), np.full((60, 2), 777.0), rng.normal(8e5, 10, (90, 2))])
    got = {}
    for r in neighbours.nearest(frame(spark, queries), frame(spark, cloud), k).collect():
        got.setdefault(r.q_id, {})[r.rank] = r.t_id
    want = brute_nearest(queries, cloud, k)
    assert got == {i: dict(enumerate(ids, 1)) for i, ids in want.items()}


def test_each_target_goes_to_one_leaf(spark, cloud, monkeypatch):
    """Places enter a leaf once, and a place with very many nodes counts as k of them."""
    monkeypatch.setattr(neighbours, "LEAF_TARGETS", 50)
    kept = {}
    real = neighbours.materialize
    monkeypatch.setattr(neighbours, "materialize", lambda df, name: kept.setdefault(name, real(df, name)))
    crowd = frame(spark, cloud).unionByName(spark.range(10_000, 60_000).select("id", F.lit(1234.5).alias("x"), F.lit(5.0).alias("y")))
    neighbours.nearest(crowd, crowd, 3).count()
    places = len(np.unique(cloud, axis=0)) + 1
    held = kept["leaves"]
    assert held.count() == places + 2 * 2  # two places with copies hold three ids each
    sizes = [r["count"] for r in held.groupBy("leaf").count().collect()]
    assert len(sizes) > 10 and max(sizes) < 250
    assert kept["places"].count() == places


def test_tree_cuts_ties_and_stops():
    same = np.full((100, 2), 3.0)
    assert neighbours.Tree(same, 10).leaves == 1
    line = np.c_[np.r_[np.zeros(90), np.arange(10)], np.zeros(100)]
    tree = neighbours.Tree(line, 10)
    leaf = tree.leaf_of(line)
    assert tree.leaves > 1 and len(set(leaf[:90].tolist())) == 1
    assert neighbours.Tree(np.random.default_rng(1).random((5000, 2)), 1, 64).leaves <= 64


def test_nearest_without_targets_or_queries(spark):
    some, none = frame(spark, [(0, 0), (1, 1)]), frame(spark, [(0, 0)]).filter("id < 0")
    assert neighbours.nearest(some, none, 2).count() == 0 and neighbours.nearest(none, some, 2).count() == 0
    odd = spark.createDataFrame([(7, None, 1.0), (8, float("nan"), 0.0), (9, 0.2, 0.0)], "id long, x double, y double")
    assert [r.t_id for r in neighbours.nearest(odd, some, 1).collect()] == [0]


def test_extremes_follow(spark, cloud):
    row = graph.distance_extremes(frame(spark, cloud)).first()
    places = np.unique(cloud, axis=0)
    closest = min(float(np.sort(np.sqrt(((places - p) ** 2).sum(1)))[1]) for p in places)
    assert row.closest_m == pytest.approx(closest) and row.furthest_m == pytest.approx(brute(places))
