import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadpulse.functions.geo import project_utm33
from roadpulse.operators import graph, neighbours, ordering, skew, tiles


def nodes_of(spark, points):
    return spark.createDataFrame(
        [(i, float(x), float(y)) for i, (x, y) in enumerate(points, start=1)], "id long, x double, y double"
    )


LINE = [(0, 0), (0, 0), (1999.9, 0), (2000, 0)]


@pytest.fixture(scope="module")
def cloud():
    """Scattered points, a dense cluster, many copies of one place, and a far outlier."""
    rng = np.random.default_rng(7)
    scattered = rng.uniform(0, 20_000, (60, 2))
    cluster = rng.normal(5_000, 3, (60, 2))
    return [tuple(p) for p in np.vstack([scattered, cluster, np.full((40, 2), 900.0), [[90_000.0, -40_000.0]]])]


def dist(a, b):
    return math.sqrt((a[0] - b[0]) ** 2 + (a[1] - b[1]) ** 2)


def test_projection(spark):
    df = spark.createDataFrame([(13.377704, 52.516275)], "lon double, lat double")
    row = project_utm33(df).first()
    assert (round(row.x, 2), round(row.y, 2)) == (389918.04, 5819699.13)
    assert project_utm33(df).columns == ["lon", "lat", "x", "y"]


def edge_set(df):
    return {(r.src, r.dst) for r in df.collect()}


def test_binary_graph_golden(spark):
    nodes = nodes_of(spark, LINE)
    loops = {(i, i) for i in range(1, 5)}
    half = {(1, 2), (1, 3), (2, 3), (3, 4)}
    assert edge_set(graph.radius_graph_binary(nodes)) == loops | half | {(b, a) for a, b in half}
    for density in (graph.radius_graph_density(nodes), graph.graph_density(graph.radius_graph_binary(nodes), nodes)):
        assert tuple(density.first()) == (4, 12, 0.75)
    far = nodes_of(spark, [(0, 0), (9e5, 0)])
    assert tuple(graph.radius_graph_density(far).first()) == (2, 2, 0.5)


def test_gaussian_graph_golden(spark):
    edges = {(r.src, r.dst): r.weight for r in graph.radius_graph_gaussian(nodes_of(spark, LINE), sigma=2000.0).collect()}
    assert edges[(1, 2)] == edges[(1, 1)] == 1.0
    assert edges[(1, 4)] == edges[(4, 2)] == pytest.approx(0.367879, abs=1e-6)


def test_graphs_of_one_place(spark):
    nodes = nodes_of(spark, [(5, 5), (5, 5)])
    assert {r.weight for r in graph.radius_graph_gaussian(nodes).collect()} == {1.0}
    two = {(r.src, r.dst): r.weight for r in graph.radius_graph_gaussian(nodes_of(spark, [(0, 0), (9, 0)])).collect()}
    assert two[(1, 2)] == 0.0 and two[(1, 1)] == 1.0
    assert graph.sigma_all_pairs(nodes_of(spark, [(1, 1)])).first()[0] is None


def test_binary_graph_against_brute_force(spark, cloud):
    want = {
        (i, j)
        for i, a in enumerate(cloud, 1)
        for j, b in enumerate(cloud, 1)
        if i == j or dist(a, b) < 2000
    }
    edges = graph.radius_graph_binary(nodes_of(spark, cloud))
    assert edges.count() == len(want) and edge_set(edges) == want


def test_pairwise_distance(spark, cloud):
    got = {(r.src, r.dst): r.dist_m for r in graph.pairwise_distance(nodes_of(spark, cloud), 3000.0).collect()}
    want = {
        (i, j): dist(cloud[i - 1], cloud[j - 1])
        for i in range(1, len(cloud) + 1)
        for j in range(i + 1, len(cloud) + 1)
        if dist(cloud[i - 1], cloud[j - 1]) <= 3000
    }
    assert got == pytest.approx(want)


@pytest.mark.parametrize("k", [1, 8])
def test_knn_against_brute_force(spark, cloud, k):
    got = {}
    for r in graph.knn_graph(nodes_of(spark, cloud), k).collect():
        got.setdefault(r.src, {})[r.rank] = r.dst
    for i, a in enumerate(cloud, 1):
        near = sorted((dist(a, b), j) for j, b in enumerate(cloud, 1) if j != i)[:k]
        assert got[i] == {rank: j for rank, (_, j) in enumerate(near, 1)}


def test_nearest_with_fewer_targets_than_k(spark):
    targets = nodes_of(spark, [(0, 0), (1e6, 1e6)])
    points = nodes_of(spark, [(-3e5, 10)])
    got = neighbours.nearest(points, targets, 5).orderBy("rank").collect()
    assert [r.t_id for r in got] == [1, 2]


def test_graph_joins_have_no_cross_product(spark, cloud):
    nodes = nodes_of(spark, cloud)
    for df in (graph.radius_graph_binary(nodes), graph.knn_graph(nodes), graph.nearest_sensor(nodes, nodes)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def all_distances(cloud):
    return np.array([dist(a, b) for i, a in enumerate(cloud) for b in cloud[i + 1 :]])


@pytest.mark.parametrize("block", [7, 5000])
def test_pair_sums_against_brute_force(spark, cloud, block):
    d = all_distances(cloud)
    row = tiles.pair_sums(tiles.weighted_points(nodes_of(spark, cloud)), block).first()
    assert row.sum_d == pytest.approx(d.sum()) and row.sum_d2 == pytest.approx((d * d).sum())
    assert row.max_d == pytest.approx(d.max())


def test_statistics_of_all_pairs(spark, cloud):
    d = all_distances(cloud)
    nodes = nodes_of(spark, cloud)
    assert graph.sigma_all_pairs(nodes).first()[0] == pytest.approx(d.std())
    row = graph.distance_extremes(nodes).first()
    assert row.closest_m == pytest.approx(d[d > 0].min()) and row.furthest_m == pytest.approx(d.max())


def test_furthest_pair_of_a_ring(spark):
    ring = [(math.cos(t) * 500, math.sin(t) * 500) for t in np.linspace(0, 6.2, 37)]
    assert graph.distance_extremes(nodes_of(spark, ring)).first().furthest_m == pytest.approx(all_distances(ring).max())


def test_sym_normalized_adjacency(spark):
    edges = spark.createDataFrame(
        [(1, 1, 1.0), (1, 2, 0.5), (2, 1, 0.5), (2, 2, 1.0), (3, 3, 1.0)], "src int, dst int, weight double"
    )
    got = {(r.src, r.dst): r.weight for r in graph.sym_normalized_adjacency(edges).collect()}
    assert got[(1, 2)] == pytest.approx(0.5 / 1.5) and got[(3, 3)] == 1.0


def test_neighbour_aggregate(spark):
    edges = spark.createDataFrame([("a", "a", 1.0), ("b", "a", 3.0), ("b", "b", 1.0)], "src string, dst string, weight double")
    cells = spark.createDataFrame(
        [("a", 0, 10.0), ("b", 0, 20.0), ("a", 200, 1.0), ("b", 200, 5.0)], "det_id string, t_idx int, v double"
    )
    got = {(r.det_id, r.t_idx): r.v for r in graph.neighbour_aggregate(cells, edges, ["v"], hours=201).collect()}
    assert got == {("a", 0): 17.5, ("b", 0): 20.0, ("a", 200): 4.0, ("b", 200): 5.0}


def test_salted_join_is_a_join(spark):
    """A third of both sides under one key, cut into chunks."""
    left = spark.range(300).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k", "id AS a")
    right = spark.range(240).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k", "id AS b")
    want = left.join(right, "k")
    got = skew.salted_join(left, right, ["k"], min_rows=10)
    assert got.columns == want.columns
    assert got.count() == want.count() == 100 * 80 + 160
    assert got.exceptAll(want).count() == 0
    few = right.groupBy("k").agg(F.min("b").alias("b"))
    assert skew.salted_join(left, few, ["k"], 10, right_is_even=True).exceptAll(left.join(few, "k")).count() == 0
    plain = skew.salted_join(left, right, ["k"])
    assert plain.exceptAll(want).count() == 0


@pytest.mark.parametrize("buckets", [2, 5, 256])
def test_global_rank(spark, buckets):
    ids = [f"TEU{i:05d}_Det{j}" for i in range(40) for j in range(2)]
    df = spark.createDataFrame([(i,) for i in ids], "det_id string")
    got = {r.det_id: r["rank"] for r in ordering.global_rank(df, "det_id", buckets).collect()}
    assert got == {d: n for n, d in enumerate(sorted(ids), 1)}


@pytest.mark.parametrize("buckets", [3, 256])
def test_exact_quantiles(spark, buckets):
    rng = np.random.default_rng(1)
    a = np.where(rng.random(500) < 0.4, 7.0, rng.normal(0, 50, 500))  # one value holds 40 % of the rows
    b = rng.integers(0, 5, 500).astype(float)
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)] + [(None, None)], "a double, b double")
    probs = [0.0, 0.25, 0.333, 0.5, 0.9, 1.0]
    got = {(r.feature, r.prob): r.value for r in ordering.exact_quantiles(df, ["a", "b"], probs, buckets).collect()}
    for name, data in (("a", a), ("b", b)):
        for p in probs:
            assert got[(name, p)] == pytest.approx(np.quantile(data, p))


def test_running_totals_by_group(spark):
    df = spark.createDataFrame([("f", 1.0, 2), ("f", 3.0, 5), ("g", 2.0, 1), ("g", 9.0, 4)], "feature string, v double, n long")
    got = {(r.feature, r.v): r.cum_n for r in ordering.running_totals(df, "v", ["n"], ["feature"], buckets=3).collect()}
    assert got == {("f", 1.0): 2, ("f", 3.0): 7, ("g", 2.0): 1, ("g", 9.0): 5}


def test_identity(spark):
    assert edge_set(graph.identity_graph(nodes_of(spark, LINE))) == {(i, i) for i in range(1, 5)}
    assert graph.identity_graph(nodes_of(spark, LINE)).agg(F.sum("weight")).first()[0] == 4
