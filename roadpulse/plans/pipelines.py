"""Composite jobs: the feature table, the bundle, the graph, profiles and reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.columns import (
    DET,
    FEATURES,
    QUALITY,
    QUALITY_THRESHOLD,
    RADIUS_M,
    SHORT_GAP_HOURS,
    SPLIT_RATIOS,
    TRAFFIC,
    UTC,
    ZONE,
)
from roadpulse.functions.geo import project_utm33
from roadpulse.operators import eda, evaluate, forecast
from roadpulse.operators.axes import (
    Axis,
    filter_locations_with_data,
    node_index,
    split_bounds,
    split_ratio,
)
from roadpulse.operators.clean import clean_grid, dedupe_first
from roadpulse.operators.features import calendar, engineer_features
from roadpulse.operators.graph import (
    distance_extremes,
    graph_density,
    identity_graph,
    knn_graph,
    neighbour_aggregate,
    radius_graph_binary,
    radius_graph_density,
    radius_graph_gaussian,
)
from roadpulse.operators.normalize import apply_normalization, normalization_stats
from roadpulse.session import materialize
from roadpulse.sources.bundle import write_bundle


def feature_cells(
    readings: DataFrame,
    nodes: DataFrame,
    axis: Axis,
    threshold: float = QUALITY_THRESHOLD,
    limit: int = SHORT_GAP_HOURS,
    zone: str = ZONE,
    fit_on: str = "all",
    ratios: tuple[float, float, float] = SPLIT_RATIOS,
    unique: bool = False,
) -> DataFrame:
    """Raw readings to dense cells: det_id, t_idx, utc, ten features, mask.

    `nodes` lists the detectors and may carry a boolean `failed`; the cells of failed
    detectors are all zero with a FALSE mask. `unique=True` states that readings already
    hold one row per detector and hour.
    """
    if "failed" not in nodes.columns:
        nodes = nodes.select(DET, F.lit(False).alias("failed"))
    else:
        nodes = nodes.select(DET, "failed")
    if not unique:
        order = [c for c in ("month", "file_start", "row_order") if c in readings.columns]
        # Without a file order any fixed order serves.
        readings = dedupe_first(readings, [DET, UTC], order or [F.xxhash64(QUALITY, *TRAFFIC)])
    cleaned = clean_grid(readings, nodes, axis, threshold, limit)
    train_end = split_bounds(axis.hours, ratios)[0]
    cells = engineer_features(cleaned, zone, fit_on, train_end, calendar(readings.sparkSession, axis, zone))
    failed = F.col("failed")
    return cells.select(
        DET,
        "t_idx",
        UTC,
        *[F.when(failed, F.lit(0.0)).otherwise(F.col(c)).alias(c) for c in FEATURES],
        (F.col("mask") & ~failed).alias("mask"),
    )


def normalized_cells(
    cells: DataFrame, axis: Axis, ratios: tuple[float, float, float] = SPLIT_RATIOS
) -> tuple[DataFrame, DataFrame]:
    """(cells with split and z-scored traffic columns, one-row statistics).

    The cells are read twice, once for the statistics: hand in a stored table.
    """
    labelled = split_ratio(cells, axis.hours, ratios)
    stats = normalization_stats(labelled)
    return apply_normalization(labelled, stats), stats


def build_bundle(
    spark: SparkSession,
    readings: DataFrame,
    nodes: DataFrame,
    axis: Axis,
    path: str,
    ratios: tuple[float, float, float] = SPLIT_RATIOS,
    **cleaning,
) -> str:
    """Readings to a committed bundle; returns the path of the new build.

    The dense cells are written once to the shared scratch folder: statistics and the normalised
    table then read columns from storage instead of running the chain twice. So are the listed detectors, which may come from the files
    themselves and are read for the cells, their number and their index.
    """
    nodes = materialize(nodes, "listed")
    cells = feature_cells(readings, nodes, axis, ratios=ratios, **cleaning)
    staged = split_ratio(materialize(cells, "cells"), axis.hours, ratios)
    stats = materialize(normalization_stats(staged), "stats")
    config = {
        "quality_threshold": str(cleaning.get("threshold", QUALITY_THRESHOLD)),
        "short_gap_limit": str(cleaning.get("limit", SHORT_GAP_HOURS)),
        "split_ratios": ",".join(str(r) for r in ratios),
        "zone": cleaning.get("zone", ZONE),
    }
    return write_bundle(
        spark, apply_normalization(staged, stats), nodes.select(DET), axis, stats, path, ratios, config
    )


def graph_nodes(locations: DataFrame, data_ids: DataFrame) -> DataFrame:
    """(n_idx, id, x, y) of the located detectors with data, in id order, written once."""
    kept = filter_locations_with_data(locations.select(DET, "lon", "lat"), data_ids)
    placed = project_utm33(kept).select(DET, "x", "y")
    indexed = placed.join(node_index(placed), DET)
    return materialize(indexed.select("n_idx", F.col(DET).alias("id"), "x", "y"), "nodes")


def build_graph(
    locations: DataFrame, data_ids: DataFrame, radius: float = RADIUS_M
) -> dict[str, DataFrame]:
    """Nodes, binary edges, and one row of figures on the graph."""
    nodes = graph_nodes(locations, data_ids)
    edges = radius_graph_binary(nodes, radius)
    extremes = distance_extremes(nodes)
    density = radius_graph_density(nodes, radius)
    summary = density.select(
        "*",
        extremes.select("closest_m").scalar().alias("closest_m"),
        extremes.select("furthest_m").scalar().alias("furthest_m"),
    )
    return {"nodes": nodes, "edges": edges, "summary": summary}


def _hours(ts: str) -> Column:
    """Hours since 1970 of a stamp."""
    return (F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")) * 24 + F.hour(ts)).cast("double")


def _long(df: DataFrame, section: str, name: Column, value: Column) -> DataFrame:
    return df.select(F.lit(section).alias("section"), name.alias("name"), value.cast("double").alias("value"))


def profile_readings(readings: DataFrame) -> DataFrame:
    """The standard first look at readings as (section, name, value): first rows, columns, statistics, sensors, range, interval."""
    numeric = [QUALITY, *TRAFFIC]
    head = eda.head_rows(readings, [DET, UTC])
    stats = ["n", "mean", "std", "min", "q25", "q50", "q75", "max"]
    described = eda.describe_numeric(readings, numeric).select(
        "feature", F.inline(F.array(*[F.struct(F.lit(s).alias("stat"), F.col(s).cast("double").alias("v")) for s in stats]))
    )
    parts = [
        _long(head, "head", F.concat_ws("@", DET, _hours(UTC).cast("long").cast("string")), F.col("qkfz")),
        _long(eda.profile_columns(readings), "columns", F.concat_ws(":", "column", "type"), F.col("non_null")),
        _long(described, "describe", F.concat_ws(".", "feature", "stat"), F.col("v")),
        _long(eda.distinct_sensors(readings), "sensors", F.lit("distinct"), F.col("sensors")),
        _long(eda.time_range(readings), "range", F.lit("first"), _hours("first_utc")),
        _long(eda.time_range(readings), "range", F.lit("last"), _hours("last_utc")),
        _long(eda.sampling_interval(readings), "interval", F.col(DET), F.col("step_minutes")),
    ]
    return reduce(DataFrame.unionByName, parts)


def profile_locations(locations: DataFrame) -> DataFrame:
    """First rows, columns, and the coordinate of the first location, as (section, name, value)."""
    first = locations.orderBy(DET).limit(1)
    parts = [
        _long(eda.head_rows(locations, [DET]), "head", F.col(DET), F.col("lon")),
        _long(eda.profile_columns(locations), "columns", F.concat_ws(":", "column", "type"), F.col("non_null")),
        _long(first, "first", F.lit("lon"), F.col("lon")),
        _long(first, "first", F.lit("lat"), F.col("lat")),
    ]
    return reduce(DataFrame.unionByName, parts)


def baseline_report(cells: DataFrame, axis: Axis, col: str = "vkfz") -> DataFrame:
    """Test errors of the naive models, horizons as columns. Cells carry split and mask."""
    judged = forecast.naive_forecasts(cells, axis.hours, col)
    return evaluate.error_table(evaluate.errors_on_test(judged))


def graph_ablation(cells: DataFrame, nodes: DataFrame, axis: Axis, col: str = "vkfz", ahead: int = 3) -> DataFrame:
    """Density of each graph kind, and how well a node's neighbours now tell its own value `ahead` hours later.

    Judged on the test split, on the cells whose node has neighbours in every graph, so all kinds answer the same questions.
    Edges are read towards the node that lists them: its neighbours are what it sees.
    """
    kinds = {
        "binary": radius_graph_binary(nodes),
        "gaussian": radius_graph_gaussian(nodes),
        "knn": knn_graph(nodes).select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"),
        "identity": identity_graph(nodes),
    }
    kinds = {name: materialize(edges, "edges") for name, edges in kinds.items()}
    judged_nodes = reduce(
        lambda a, b: a.join(b, DET), [e.select(F.col("dst").alias(DET)).distinct() for e in kinds.values()]
    )
    later = split_ratio(cells, axis.hours).filter("split = 'test'").join(judged_nodes, DET)
    later = materialize(later.select(DET, (F.col("t_idx") - ahead).alias("t_idx"), "mask", F.col(col).alias("y")), "later")
    out = None
    for name, edges in kinds.items():
        near = neighbour_aggregate(cells, edges, [col], axis.hours, nodes=nodes).withColumnRenamed(col, "y_hat")
        judged = later.join(near, [DET, "t_idx"])
        row = graph_density(edges, nodes).select(
            F.lit(name).alias("graph"), "nodes", "edges", "density", evaluate.masked_mae(judged).scalar().alias("mae")
        )
        out = row if out is None else out.unionByName(row)
    return out
