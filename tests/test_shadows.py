"""Sums of all pair distances from shadows against brute force."""

import numpy as np
import pytest

from roadpulse.operators import graph, shadows
from roadpulse.operators.tiles import weighted_points

RNG = np.random.default_rng(8)
TURN = np.linspace(0, 2 * np.pi, 300, endpoint=False)
SETS = {
    "square": RNG.random((900, 2)) * 1000 + 6e6,
    "circle": np.c_[np.cos(TURN), np.sin(TURN)] * 5000,
    "line": np.c_[np.arange(200.0), np.arange(200.0)],
    "two towns": np.r_[RNG.normal(size=(500, 2)), RNG.normal(size=(500, 2)) * 0.01 + 1e4],
    "hot place": np.r_[np.zeros((400, 2)), RNG.random((500, 2)) * 50],
    "two": np.array([(0.0, 0.0), (3.0, 4.0)]),
}


def frame(spark, points):
    rows = [(i, float(x), float(y)) for i, (x, y) in enumerate(points)]
    return spark.createDataFrame(rows, "id long, x double, y double").repartition(3)


def distances(points):
    i, j = np.triu_indices(len(points), 1)
    return np.hypot(*(points[i] - points[j]).T)


@pytest.mark.parametrize("name", list(SETS))
def test_sum_is_within_its_bound(spark, monkeypatch, name):
    monkeypatch.setattr(shadows, "SLICE_PLACES", 300)  # several slices
    want = distances(SETS[name]).sum()
    for max_error in (0.05, 1e-4):
        found, bound = shadows.distance_sum(weighted_points(frame(spark, SETS[name])), max_error)
        assert abs(found - want) <= bound <= max_error * found
        assert abs(found - want) <= max_error * want * 1.1


def test_deviation_within_an_error(spark):
    points = SETS["two towns"]
    nodes = frame(spark, points)
    assert graph.sigma_all_pairs(nodes, 1e-5).first()[0] == pytest.approx(distances(points).std(), rel=1e-4)
    close = graph.radius_graph_gaussian(nodes, 1.0, sigma_error=1e-5)
    exact = {(r.src, r.dst): r.weight for r in graph.radius_graph_gaussian(nodes, 1.0).collect()}
    got = {(r.src, r.dst): r.weight for r in close.collect()}
    assert got.keys() == exact.keys() and all(got[k] == pytest.approx(exact[k], rel=1e-4) for k in exact)


def test_few_places(spark):
    for points in ([], [(1, 1)], [(3, 4)] * 60):
        places = weighted_points(frame(spark, points))
        assert shadows.distance_sum(places, 1e-3) == (0.0, 0.0)
    assert graph.sigma_all_pairs(frame(spark, []), 1e-3).first()[0] is None
    assert graph.sigma_all_pairs(frame(spark, [(1, 1)]), 1e-3).first()[0] is None
    assert graph.sigma_all_pairs(frame(spark, [(3, 4)] * 9), 1e-3).first()[0] == 0
    with pytest.raises(ValueError):
        shadows.distance_sum(weighted_points(frame(spark, [(1, 1)])), 0)
