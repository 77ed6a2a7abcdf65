"""Sensor graphs as sparse edge lists (src, dst, weight). Nodes are (id, x, y) in metres."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.columns import KNN_K, RADIUS_M
from roadpulse.functions.geo import distance
from roadpulse.operators.blocks import block_product
from roadpulse.operators.hull import furthest_distance
from roadpulse.operators.neighbours import nearest
from roadpulse.operators.shadows import distance_sum
from roadpulse.operators.skew import salted_join
from roadpulse.operators.tiles import pair_sums, weighted_points
from roadpulse.session import materialize


# --- pairs within a distance -----------------------------------------------------

# A cell's own column and row, and the half of its neighbours that lie "ahead" of it:
# every unordered pair of cells is met once.
_AHEAD = [(0, 0), (1, -1), (1, 0), (1, 1), (0, 1)]


# Cells are this much wider than the distance, so that rounding of a coordinate's cell never puts a pair two cells apart.
CELL_MARGIN = 1e-3
# A join of cells is cut where it would compare more pairs than this in one task.
PAIRS_PER_TASK = 8_000_000
MOST_TASKS = 20_000
# Nodes at one place that are listed together in one row. Spark holds all rows that come out of one row, so two chunks make some thousand.
CHUNK_NODES = 32


def _close_pairs(
    df: DataFrame, keep: list[str], order: str, radius: float, strict: bool, own: bool = False, nodes: str | None = None
) -> DataFrame:
    """Unordered pairs of different rows within a distance: columns `a_*`, `b_*`, dist_m; with `own` each row with itself, too.

    A row may stand for many nodes (`nodes`, a number). Tasks get about even numbers of compared pairs of nodes: a cell with many
    is cut into shares, of which each takes a part of the rows that reach the cell and all rows in it.
    """
    side = radius * (1 + CELL_MARGIN) or 1.0
    cell = df.withColumn("cx", F.floor(F.col("x") / side)).withColumn("cy", F.floor(F.col("y") / side))
    cell = cell.filter(F.col("cx").isNotNull() & F.col("cy").isNotNull())
    steps = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in _AHEAD])

    def ahead(rows: DataFrame, *cols: Column | str) -> DataFrame:
        return rows.withColumn("step", F.explode(steps)).select(
            (F.col("cx") + F.col("step.dx")).alias("cx"), (F.col("cy") + F.col("step.dy")).alias("cy"), *cols
        )

    size = F.col(nodes).cast("double") if nodes else F.lit(1.0)
    held = cell.groupBy("cx", "cy").agg(F.sum(size).alias("_held"))
    met = ahead(held, F.col("_held").alias("_met")).groupBy("cx", "cy").agg(F.sum("_met").alias("_met"))
    work = held.join(met, ["cx", "cy"]).select("cx", "cy", (F.col("_held") * F.col("_met") / PAIRS_PER_TASK).alias("_work"))
    whole = work.agg(F.coalesce(F.sum("_work"), F.lit(0.0))).first()[0]
    shares = work.filter(F.col("_work") > 1).select("cx", "cy", F.ceil("_work").cast("int").alias("_shares"))

    here = cell.select("cx", "cy", *[F.col(c).alias(f"b_{c}") for c in dict.fromkeys([*keep, order, "x", "y"])])
    reach = ahead(
        cell,
        ((F.col("step.dx") == 0) & (F.col("step.dy") == 0)).alias("same_cell"),
        *[F.col(c).alias(f"a_{c}") for c in dict.fromkeys([*keep, order, "x", "y"])],
    )
    keys = ["cx", "cy"]
    if whole > 1:
        n = F.coalesce(F.col("_shares"), F.lit(1))
        reach = reach.join(shares, keys, "left").withColumn("share", F.pmod(F.xxhash64(f"a_{order}"), n).cast("int"))
        here = here.join(shares, keys, "left").withColumn("share", F.explode(F.sequence(F.lit(0), n - 1)))
        keys = [*keys, "share"]
        tasks = min(int(whole) + 1, MOST_TASKS)
        reach, here = reach.drop("_shares").repartition(tasks, *keys), here.drop("_shares").repartition(tasks, *keys)
    d = distance(F.col("a_x"), F.col("a_y"), F.col("b_x"), F.col("b_y"))
    a, b = F.col(f"a_{order}"), F.col(f"b_{order}")
    pairs = reach.join(here, keys).filter(~F.col("same_cell") | (a <= b if own else a < b)).withColumn("dist_m", d)
    within = F.col("dist_m") < radius if strict else F.col("dist_m") <= radius
    return pairs.filter(within).drop(*keys, "same_cell")


def _chunks(nodes: DataFrame, by: list[str]) -> DataFrame:
    """(x, y, .., place, ids, n): the nodes that are alike in the columns `by`, at most about `CHUNK_NODES` in a row; equal ids share a row."""
    nodes = nodes.filter(F.col("id").isNotNull())
    sizes = nodes.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / CHUNK_NODES).cast("int").alias("_parts"))
    part = F.pmod(F.xxhash64("id"), F.col("_parts")).cast("int").alias("part")
    cut = salted_join(nodes.select("id", *by), sizes, by, right_is_even=True).groupBy(*by, part)
    chunks = cut.agg(F.collect_list("id").alias("ids")).withColumns({"n": F.size("ids"), "place": F.struct(*by, "part")})
    return materialize(chunks, "places")


def _close_chunks(nodes: DataFrame, radius: float, strict: bool, extra: tuple[str, ...] = ()) -> DataFrame:
    """Rows of two chunks of nodes within a distance, or of one with itself (`same`): a_ids, b_ids, dist_m, `a_` and `b_` columns of `extra`.

    Nodes at one place have the same distances, so these are found once for two places; the nodes are listed last (`_listed`).
    """
    chunks = _chunks(nodes, ["x", "y", *extra])
    pairs = _close_pairs(chunks, ["ids", *extra], "place", radius, strict, own=True, nodes="n")
    return pairs.withColumn("same", F.col("a_place") == F.col("b_place"))


def _listed(tiles: DataFrame, value: Column, both_ways: bool) -> DataFrame:
    """(src, dst, value): one row for each pair of nodes of two chunks with src < dst, or for both directions."""
    sides = F.struct(F.col("a_ids").alias("one"), F.col("b_ids").alias("other"), F.lit(True).alias("up"))
    back = F.struct(F.col("b_ids").alias("one"), F.col("a_ids").alias("other"), F.lit(False).alias("up"))
    if both_ways:
        ends = F.when(F.col("same"), F.array(sides)).otherwise(F.array(sides, back))
        rows = tiles.select(value, F.inline(ends))
    else:
        rows = tiles.select(value, "same", F.col("a_ids").alias("one"), F.col("b_ids").alias("other"))
    name = rows.columns[0]
    rows = rows.withColumn("src", F.explode("one")).withColumn("dst", F.explode("other"))
    if both_ways:
        return rows.filter(F.col("src") != F.col("dst")).select("src", "dst", name)
    met = rows.filter((F.col("src") < F.col("dst")) | (~F.col("same") & (F.col("src") > F.col("dst"))))
    return met.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"), name)


def _round(value: Column, digits: int | None) -> Column:
    return value if digits is None else F.round(value, digits)


def pairwise_distance(nodes: DataFrame, max_m: float, digits: int | None = None) -> DataFrame:
    """(src, dst, dist_m), src < dst, of every pair at most `max_m` apart.

    The full distance matrix is never built: statistics over all pairs come from
    `distance_extremes` and `sigma_all_pairs`. Distances are computed, and rounded to `digits` if given, once for two places.
    """
    tiles = _close_chunks(nodes, max_m, strict=False)
    return _listed(tiles, _round(F.col("dist_m"), digits).alias("dist_m"), both_ways=False)


def identity_graph(nodes: DataFrame) -> DataFrame:
    """Self-loops only."""
    return nodes.select(F.col("id").alias("src"), F.col("id").alias("dst"), F.lit(1.0).alias("weight"))


def radius_graph_binary(nodes: DataFrame, radius: float = RADIUS_M) -> DataFrame:
    """Weight 1 where the distance is below the radius (strictly), self-loops included."""
    tiles = _close_chunks(nodes, radius, strict=True)
    return _listed(tiles, F.lit(1.0).alias("weight"), both_ways=True).unionByName(identity_graph(nodes))


def _sigma(nodes: DataFrame, sigma: float | None, sigma_error: float) -> Column:
    return F.lit(float(sigma)) if sigma is not None else sigma_all_pairs(nodes, sigma_error).scalar()


def _decay(dist: Column, sigma: Column) -> Column:
    """exp(-d^2 / sigma^2); without any spread (sigma 0) only nodes at the same place stay related."""
    return F.when(dist == 0, 1.0).otherwise(F.coalesce(F.exp(-F.try_divide(dist * dist, sigma * sigma)), F.lit(0.0)))


def radius_graph_gaussian(
    nodes: DataFrame, radius: float = RADIUS_M, sigma: float | None = None, sigma_error: float = 0.0, digits: int | None = None
) -> DataFrame:
    """exp(-d^2 / sigma^2) where the distance is at most the radius, self-loops included.

    Without `sigma` the deviation of all pair distances is used, exact or within `sigma_error` (`sigma_all_pairs`). Weights are computed, and
    rounded to `digits` if given, once for two places.
    """
    tiles = _close_chunks(nodes, radius, strict=False).withColumn("_s", _sigma(nodes, sigma, sigma_error))
    weight = _round(_decay(F.col("dist_m"), F.col("_s")), digits).alias("weight")
    return _listed(tiles, weight, both_ways=True).unionByName(identity_graph(nodes))


def knn_graph(nodes: DataFrame, k: int = KNN_K) -> DataFrame:
    """Directed edges to the k nearest other nodes, weight 1, ties by id."""
    ranked = nearest(nodes, nodes, k + 1).filter(F.col("q_id") != F.col("t_id"))
    w = Window.partitionBy("q_id").orderBy("rank")
    return (
        ranked.withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= k)
        .select(F.col("q_id").alias("src"), F.col("t_id").alias("dst"), F.lit(1.0).alias("weight"), "rank", "dist_m")
    )


def nearest_sensor(points: DataFrame, sensors: DataFrame) -> DataFrame:
    """(id, sensor, dist_m): the closest sensor of each point; both frames hold (id, x, y)."""
    return nearest(points, sensors, 1).select(F.col("q_id").alias("id"), F.col("t_id").alias("sensor"), "dist_m")


# --- statistics of a graph --------------------------------------------------------


def graph_density(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(nodes, edges, density) of an edge list."""
    n = nodes.agg(F.count(F.lit(1))).scalar()
    return edges.agg(F.count(F.lit(1)).alias("edges")).withColumn("nodes", n).select(
        "nodes", "edges", F.try_divide("edges", F.col("nodes") * F.col("nodes")).alias("density")
    )


def radius_graph_density(nodes: DataFrame, radius: float = RADIUS_M) -> DataFrame:
    """Density of the binary radius graph without listing its edges.

    Works on distinct places: two of them with m and n nodes stand for 2mn directed
    edges, and a place for the m * m among its own nodes.
    """
    # Tiny numeric ids would only order the places; their coordinates do that as well.
    places = weighted_points(nodes).withColumn("place", F.struct("x", "y"))
    pairs = _close_pairs(places, ["place", "members"], "place", radius, strict=True)
    apart = pairs.agg(F.coalesce(F.sum(2 * F.col("a_members") * F.col("b_members")), F.lit(0.0))).scalar()
    return places.agg(
        F.sum("members").cast("long").alias("nodes"),
        F.sum(F.col("members") * F.col("members")).alias("together"),
    ).withColumn("apart", apart).select(
        "nodes",
        (F.col("together") + F.col("apart")).cast("long").alias("edges"),
        F.try_divide(F.col("together") + F.col("apart"), F.col("nodes") * F.col("nodes")).alias("density"),
    )


def distance_extremes(nodes: DataFrame) -> DataFrame:
    """(closest_m, furthest_m): smallest positive and largest distance of all pairs.

    The closest pair comes from the nearest-neighbour search of distinct places, the furthest one from the convex hull.
    """
    places = materialize(weighted_points(nodes), "places")
    if places.isEmpty():
        raise ValueError("no nodes")
    as_nodes = places.select(F.struct("x", "y").alias("id"), "x", "y")
    closest = nearest(as_nodes, as_nodes, 2).filter(F.col("q_id") != F.col("t_id"))
    return furthest_distance(places).select(closest.agg(F.min("dist_m")).scalar().alias("closest_m"), "furthest_m")


def sigma_all_pairs(nodes: DataFrame, max_error: float = 0.0) -> DataFrame:
    """One value: the population deviation of the distances of all unordered node pairs.

    Exact by default, in work that grows as the square of the places. With `max_error` the mean distance is within that share of the true
    one, from shadows (`shadows.distance_sum`) in work that grows as the places; the squares have a closed form.
    """
    places = weighted_points(nodes)
    n = nodes.agg(F.count(F.lit(1)).cast("double")).scalar()
    pairs = F.nullif(F.col("_n") * (F.col("_n") - 1) / 2, F.lit(0.0))
    mean = F.col("sum_d") / pairs
    if max_error:
        total, _bound = distance_sum(materialize(places, "places"), max_error)
        spread = F.var_pop("x") + F.var_pop("y")
        sums = nodes.agg(F.lit(total).alias("sum_d"), (spread * F.pow(F.count(F.lit(1)), 2)).alias("sum_d2"))
    else:
        sums = pair_sums(places)
    return (
        sums.withColumn("_n", n)
        .withColumn("_var", F.col("sum_d2") / pairs - mean * mean)
        .select(F.when(F.col("_var").isNotNull(), F.sqrt(F.greatest("_var", F.lit(0.0)))).alias("sigma_m"))
    )


def sym_normalized_adjacency(edges: DataFrame) -> DataFrame:
    """D^-1/2 A D^-1/2 of an edge list that already holds its self-loops."""
    degree = edges.groupBy("src").agg(F.sum("weight").alias("degree"))
    of_src = degree.withColumnRenamed("degree", "_du")
    of_dst = degree.select(F.col("src").alias("dst"), F.col("degree").alias("_dv"))
    return (
        edges.join(of_src, "src")
        .join(of_dst, "dst")
        .select("src", "dst", (F.col("weight") / F.sqrt(F.col("_du") * F.col("_dv"))).alias("weight"))
    )


def sym_normalized_radius_graph(
    nodes: DataFrame, radius: float = RADIUS_M, sigma: float | None = None, sigma_error: float = 0.0, digits: int | None = None
) -> DataFrame:
    """`sym_normalized_adjacency(radius_graph_gaussian(nodes))` without an edge list: degrees come from places and their numbers of nodes.

    No edge is stored, grouped or joined; each comes out of the pair of places it belongs to. Rows of one id are one node with all their edges.
    """
    nodes = nodes.filter(F.col("id").isNotNull())
    s = sigma_all_pairs(nodes, sigma_error) if sigma is None else nodes.sparkSession.range(1).select(F.lit(float(sigma)))
    s = materialize(s.toDF("sigma_m"), "sigma").scalar()
    places = materialize(weighted_points(nodes).withColumn("place", F.struct("x", "y")), "places")
    pairs = _close_pairs(places, ["members"], "place", radius, strict=False, own=True).withColumn("_s", s)
    w = _decay(F.col("dist_m"), F.col("_s"))

    def end(one: str, other: str) -> Column:
        return F.struct(F.col(f"{one}_x").alias("x"), F.col(f"{one}_y").alias("y"), (w * F.col(f"{other}_members")).alias("w"))

    ends = F.when(F.col("a_place") == F.col("b_place"), F.array(end("a", "b"))).otherwise(F.array(end("a", "b"), end("b", "a")))
    around = pairs.select(F.inline(ends)).groupBy("x", "y").agg(F.sum("w").alias("around"))

    # An id's rows have no edges among themselves but the self-loops.
    rows = nodes.groupBy("id", "x", "y").agg(F.count(F.lit(1)).cast("double").alias("copies"))
    others = rows.select("id", F.col("x").alias("ox"), F.col("y").alias("oy"), F.col("copies").alias("others"))
    d = distance(F.col("x"), F.col("y"), F.col("ox"), F.col("oy"))
    own = rows.join(others, "id").withColumns({"dist_m": d, "_s": s}).withColumn("w", F.when(F.col("dist_m") <= radius, w * F.col("others")))
    own = own.groupBy("id", "x", "y", "copies").agg(F.sum("w").alias("own"))
    linked = F.coalesce(F.col("around") - F.col("own"), F.lit(0.0))
    met = salted_join(own.filter(F.col("own").isNotNull()), around, ["x", "y"], right_is_even=True)
    alone = own.filter(F.col("own").isNull()).withColumn("around", F.lit(None).cast("double"))
    degree = met.unionByName(alone).groupBy("id").agg(F.sum(F.col("copies") * (linked + 1)).alias("degree"))
    known = materialize(nodes.select("id", "x", "y").join(degree, "id"), "degrees")

    tiles = _close_chunks(known, radius, strict=False, extra=("degree",)).withColumn("_s", s)
    scale = F.sqrt(F.col("a_degree") * F.col("b_degree"))
    loops = known.select(F.col("id").alias("src"), F.col("id").alias("dst"), _round(1 / F.sqrt(F.col("degree") * F.col("degree")), digits).alias("weight"))
    return _listed(tiles, _round(w / scale, digits).alias("weight"), both_ways=True).unionByName(loops)


def neighbour_aggregate(
    cells: DataFrame,
    edges: DataFrame,
    cols: list[str],
    hours: int,
    key: str = "det_id",
    bucket_hours: int = 168,
    nodes: DataFrame | None = None,
) -> DataFrame:
    """Weighted mean of the neighbours' features per node and hour; NULL values are left out of the sum, their weight is not.

    A product of sparse blocks (`blocks.block_product`): what is shuffled per hour are the targets at the borders of blocks, not the edges. `nodes`
    (id, x, y) orders the blocks in the plane, so borders are short; without it ids do. `edges` is read several times, so hand in a stored table.
    """
    sums = materialize(block_product(cells, edges, cols, hours, key, nodes, bucket_hours), "products")
    parts = [f"{p}{i}" for i in range(len(cols)) for p in ("s", "n")]
    met = sums.filter("border").groupBy("dst", "t_idx").agg(*[F.sum(c).alias(c) for c in ["w", *parts]])
    whole = sums.filter("NOT border").drop("border").unionByName(met)
    means = [F.when(F.col(f"n{i}") > 0, F.try_divide(f"s{i}", "w")).alias(c) for i, c in enumerate(cols)]
    return whole.select(F.col("dst").alias(key), "t_idx", *means)
