"""The sparse block product against a plain sum over edges."""

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadpulse.operators import blocks, graph


def plain(cells, edges, n_cols):
    at = defaultdict(list)
    for node, t, *values in cells:
        at[node].append((t, values))
    sums = defaultdict(lambda: [0.0, [0.0] * n_cols, [0] * n_cols])
    for src, dst, w in edges:
        for t, values in at[src]:
            own = sums[dst, t]
            own[0] += w
            for i, v in enumerate(values):
                if v is not None:
                    own[1][i] += w * v
                    own[2][i] += 1
    return {k: tuple(s / w if n and w else None for s, n in zip(ss, nn)) for k, (w, ss, nn) in sums.items()}


@pytest.fixture(scope="module")
def network():
    """Places on a street grid with edges to close ones, a hub that all see, one that sees all, gaps and nulls."""
    rng = np.random.default_rng(6)
    places = [(i, 100.0 * (i % 20), 100.0 * (i // 20)) for i in range(200)]
    edges = [(a, b, float(rng.random())) for a, ax, ay in places for b, bx, by in places if abs(ax - bx) + abs(ay - by) <= 100]
    edges += [(7, b, 0.5) for b in range(200)] + [(a, 150, 0.25) for a in range(200)] + [(3, 900, 1.0), (3, 3, 0.0)]
    cells = [
        (n, t, None if rng.random() < 0.1 else float(rng.normal()), float(n))
        for n in range(0, 198) for t in (0, 1, 99, 100, 101, 350) if rng.random() < 0.9
    ]
    return places, edges, cells


def frames(spark, network):
    places, edges, cells = network
    return (
        spark.createDataFrame(places, "id long, x double, y double"),
        spark.createDataFrame(edges, "src long, dst long, weight double").repartition(3),
        spark.createDataFrame(cells, "det_id long, t_idx int, a double, b double").repartition(3),
    )


@pytest.mark.parametrize("placed, chunk", [(True, 4096), (False, 4096), (True, 30)])
def test_neighbour_aggregate_by_blocks(spark, network, monkeypatch, placed, chunk):
    monkeypatch.setattr(blocks, "CHUNK_EDGES", chunk)
    nodes, edges, cells = frames(spark, network)
    got = graph.neighbour_aggregate(cells, edges, ["a", "b"], 351, bucket_hours=100, nodes=nodes if placed else None)
    want = plain(network[2], network[1], 2)
    rows = {(r.det_id, r.t_idx): (r.a, r.b) for r in got.collect()}
    assert rows.keys() == want.keys() and got.columns == ["det_id", "t_idx", "a", "b"]
    for k, v in want.items():
        assert rows[k] == pytest.approx(v), k


def test_shuffled_sums_grow_with_borders_not_with_edges(spark, monkeypatch):
    """Ten times the edges between the same nodes give the same partial sums; inner targets are never summed again."""
    places = [(i, float(i % 16), float(i // 16)) for i in range(256)]
    nodes = spark.createDataFrame(places, "id long, x double, y double")
    cells = spark.range(256).select(F.col("id").alias("det_id"), F.explode(F.sequence(F.lit(0), F.lit(9))).alias("t_idx"), F.lit(1.0).alias("v"))

    def sums(reach):
        edges = [(a, b, 1.0) for a, ax, ay in places for b, bx, by in places if abs(ax - bx) <= reach and abs(ay - by) <= reach]
        df = spark.createDataFrame(edges, "src long, dst long, weight double")
        out = blocks.block_product(cells, df, ["v"], 10, "det_id", nodes).groupBy("border").count().collect()
        return len(edges), {r.border: r["count"] for r in out}

    few, one = sums(1)
    many, three = sums(3)
    assert many > 4 * few
    # The curve cuts the square into four quarters: targets next to their borders meet sums of two blocks, the middle four of four.
    assert one == {False: 10 * 196, True: 10 * (56 * 2 + 4 * 4)}
    assert three == {False: 10 * 100, True: 10 * (120 * 2 + 36 * 4)}
    edges = spark.createDataFrame([(0, 0, 1.0)], "src long, dst long, weight double")
    plan = blocks.block_product(cells, edges, ["v"], 10, "det_id", nodes)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_z_order_keeps_squares_together(spark):
    rows = spark.range(16).select((F.col("id") % 4).alias("x"), F.floor(F.col("id") / 4).alias("y"))
    got = {(r.x, r.y): r.z for r in rows.withColumn("z", blocks.z_order(F.col("x"), F.col("y"))).collect()}
    assert [got[p] for p in ((0, 0), (1, 0), (0, 1), (1, 1), (2, 0), (3, 3))] == [0, 1, 2, 3, 4, 15]


def test_nothing_to_multiply(spark):
    none = spark.createDataFrame([], "src long, dst long, weight double")
    cells = spark.createDataFrame([(1, 0, 1.0)], "det_id long, t_idx int, v double")
    assert graph.neighbour_aggregate(cells, none, ["v"], 1).count() == 0
    edges = spark.createDataFrame([(1, 2, 1.0), (1, 1, None)], "src long, dst long, weight double")
    assert graph.neighbour_aggregate(cells.limit(0), edges, ["v"], 1).count() == 0
    assert {tuple(r) for r in graph.neighbour_aggregate(cells, edges, ["v"], 1).collect()} == {(2, 0, 1.0), (1, 0, None)}
