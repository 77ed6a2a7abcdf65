"""Many nodes at one place: what one row of two chunks is expanded to stays small, and no pair is lost."""

import pytest
from pyspark.sql import functions as F

from roadpulse.operators import graph
from roadpulse.sources import bundle


@pytest.fixture
def heap(spark):
    return spark.range(500).select("id", F.lit(10.0).alias("x"), F.lit(20.0).alias("y"))


def test_rows_of_two_chunks_are_few(heap):
    """Spark holds all rows that come out of one row: 250,000 of these 500 nodes before, and a million at most."""
    tiles = graph._close_chunks(heap, 100.0, strict=False)
    assert tiles.agg(F.max(F.size("a_ids") * F.size("b_ids"))).first()[0] <= 10_000
    assert graph.pairwise_distance(heap, 100.0).distinct().count() == 500 * 499 // 2
    assert graph.radius_graph_binary(heap, 100.0).distinct().count() == 500 * 500
    assert graph.radius_graph_gaussian(heap, 100.0, sigma=50.0).distinct().count() == 500 * 500


def test_written_graph_is_whole(spark, heap, tmp_path):
    bundle.write_graph(heap, graph.radius_graph_binary(heap, 100.0), str(tmp_path / "g"))
    nodes, edges = bundle.read_graph(spark, str(tmp_path / "g"))
    assert nodes.count() == 500
    assert edges.distinct().count() == 500 * 500
