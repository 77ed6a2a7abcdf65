"""Graphs over places that hold many nodes: distances once for two places, work in even shares."""

import math

import pytest

from roadpulse.operators import graph

PLACES = [(0.0, 0.0), (700.0, 0.0), (1500.0, 900.0), (2600.0, 100.0), (90_000.0, 5.0), (float("nan"), 1.0), (None, 1.0)]


@pytest.fixture
def crowd(spark):
    """Thirty nodes at each place; one node has a second row there and one a row elsewhere."""
    points = [(i, *PLACES[i % len(PLACES)]) for i in range(30 * len(PLACES))]
    points += [points[0], (points[0][0], *PLACES[1])]
    return points, spark.createDataFrame(points, "id long, x double, y double")


def near(points, radius, strict=False):
    found = []
    for a in points:
        for b in points:
            if a[0] != b[0] and None not in (*a, *b):
                d = math.sqrt((a[1] - b[1]) ** 2 + (a[2] - b[2]) ** 2)
                if d < radius if strict else d <= radius:
                    found.append((a[0], b[0], round(d, 3)))
    return sorted(found)


@pytest.fixture(params=[50, 8_000_000])
def small_tasks(request, monkeypatch):
    monkeypatch.setattr(graph, "PAIRS_PER_TASK", request.param)
    monkeypatch.setattr(graph, "CHUNK_NODES", 7 if request.param == 50 else 1_000)
    return request.param == 50


def test_distances_and_binary_graph(crowd, small_tasks):
    points, nodes = crowd
    got = graph.pairwise_distance(nodes, 1200.0, digits=3)
    assert sorted(map(tuple, got.collect())) == [r for r in near(points, 1200.0) if r[0] < r[1]]
    edges = graph.radius_graph_binary(nodes, 1500.0)
    want = [r[:2] for r in near(points, 1500.0, strict=True)] + [(p[0], p[0]) for p in points]
    assert sorted((r.src, r.dst) for r in edges.collect()) == sorted(want)


def test_work_is_cut_into_tasks(crowd, monkeypatch):
    """30 nodes at each of four places within a cell or two: one key held all pairs, and a task with it."""
    monkeypatch.setattr(graph, "PAIRS_PER_TASK", 500)
    monkeypatch.setattr(graph, "CHUNK_NODES", 7)
    tiles = graph._close_chunks(crowd[1], 3000.0, strict=False)
    sizes = tiles.selectExpr("spark_partition_id() AS p", "size(a_ids) * size(b_ids) AS n").groupBy("p").sum("n").collect()
    assert len(sizes) > 5 and max(r[1] for r in sizes) < sum(r[1] for r in sizes) / 3


def test_one_row_for_two_places(crowd):
    """Four places near each other, one far off: ten pairs of places with the places themselves, and the far one, whatever the nodes."""
    assert graph._close_chunks(crowd[1], 5000.0, strict=False).count() == 11


def test_normalised_graph_without_edges(crowd, small_tasks):
    _, nodes = crowd
    want = graph.sym_normalized_adjacency(graph.radius_graph_gaussian(nodes, sigma=900.0))
    got = graph.sym_normalized_radius_graph(nodes, sigma=900.0)
    listed = lambda df: sorted((r.src, r.dst, round(r.weight, 9)) for r in df.collect())
    assert listed(got) == listed(want)


def test_normalised_graph_stores_no_edges(crowd, monkeypatch):
    """What is written for 210 nodes are nodes and places, not their 14,000 edges."""
    written, store = [], graph.materialize

    def counted(df, name):
        written.append(df.count())
        return store(df, name)

    monkeypatch.setattr(graph, "materialize", counted)
    assert graph.sym_normalized_radius_graph(crowd[1], radius=4000.0, sigma=900.0).count() > 14_000
    assert max(written) <= 212
