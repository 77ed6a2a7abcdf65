"""Pairs at a distance of exactly the radius across the borders of grid cells."""

import pytest

from roadpulse.operators import graph


def found(spark, points, radius):
    nodes = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "id long, x double, y double")
    return sorted((r.src, r.dst, r.dist_m) for r in graph.pairwise_distance(nodes, radius).collect())


@pytest.mark.parametrize("x1, x2, radius", [(-1e-13, 3000.0, 3000.0), (-1e-13, 1500.5, 1500.5)])
def test_no_pair_lost_by_rounding(spark, x1, x2, radius):
    """The lower place rounds into the cell before a border, the upper one into the cell after the next: they were two cells apart."""
    assert abs(x1 - x2) <= radius
    assert found(spark, [(x1, 5.0), (x2, 5.0)], radius) == [(0, 1, x2 - x1)]
    assert found(spark, [(5.0, x1), (5.0, x2)], radius) == [(0, 1, x2 - x1)]


def test_distance_of_zero(spark):
    assert found(spark, [(1.0, 2.0), (1.0, 2.0), (1.0, 2.5)], 0.0) == [(0, 1, 0.0)]
