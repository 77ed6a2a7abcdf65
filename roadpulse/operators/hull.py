"""The furthest pair of a point set: hulls of the partitions, the hull of those hulls, and rotating calipers around it.

A batch is reduced to its convex hull together with the hull found so far, so a task holds one batch and one hull. Points inside
the polygon of a few extreme ones are dropped in numpy before. Partial hulls are joined in two rounds; the last task
gets their vertices alone, which for points in general are few: n^(1/3) of n on a disc, log n on a square. Only points in convex position are all kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Directions whose extreme points span the polygon of the first reduction.
DIRECTIONS = 16


def _outside(points: np.ndarray) -> np.ndarray:
    """The points that are not well inside the polygon of the extreme points in some directions."""
    angles = np.arange(DIRECTIONS) * (2 * np.pi / DIRECTIONS)
    corner = points[(points @ np.array([np.cos(angles), np.sin(angles)])).argmax(0)]
    following = np.roll(corner, -1, axis=0)
    scale = np.abs(points).max() + 1
    left = np.ones(len(points), bool)
    for (ax, ay), (bx, by) in zip(corner, following):
        if ax != bx or ay != by:
            cross = (bx - ax) * (points[:, 1] - ay) - (by - ay) * (points[:, 0] - ax)
            left &= cross > 1e-9 * scale * (abs(bx - ax) + abs(by - ay))
    return points[~left]


def convex_hull(points: np.ndarray) -> np.ndarray:
    """Vertices of the convex hull, counter-clockwise from the leftmost; one or two for degenerate sets."""
    if len(points) > 4 * DIRECTIONS:
        points = _outside(points)
    points = np.unique(points, axis=0)
    if len(points) < 3:
        return points

    def chain(rows: list[tuple[float, float]]) -> list[tuple[float, float]]:
        out: list[tuple[float, float]] = []
        for x, y in rows:
            while len(out) > 1:
                (ax, ay), (bx, by) = out[-2], out[-1]
                if (bx - ax) * (y - ay) > (by - ay) * (x - ax):
                    break
                out.pop()
            out.append((x, y))
        return out[:-1]

    rows = list(zip(points[:, 0].tolist(), points[:, 1].tolist()))
    return np.array(chain(rows) + chain(rows[::-1]))


def furthest(hull: np.ndarray) -> float:
    """Largest distance of two vertices of a hull: each edge against the vertices that a parallel line touches on the other side.

    Edges go round by rising angle, so the vertex opposite to an edge is found by a search for its angle turned by half a circle; the
    vertices next to it are tried as well, for edges that are parallel but for rounding.
    """
    if len(hull) < 3:
        return float(np.sqrt(((hull[-1] - hull[0]) ** 2).sum())) if len(hull) else 0.0
    step = np.roll(hull, -1, axis=0) - hull
    angle = np.arctan2(step[:, 1], step[:, 0])
    order = np.argsort(angle, kind="stable")
    turned = np.where(angle > 0, angle - np.pi, angle + np.pi)
    # The edge that starts at the opposite vertex is the first one beyond the turned angle.
    opposite = order[np.searchsorted(angle[order], turned) % len(hull)]
    best = 0.0
    for near in (0, 1):
        for far in (-1, 0, 1):
            ends = hull[(np.arange(len(hull)) + near) % len(hull)] - hull[(opposite + far) % len(hull)]
            best = max(best, float((ends**2).sum(1).max()))
    return float(np.sqrt(best))


def _hulls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hull = np.zeros((0, 2))
    for batch in batches:
        points = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)], axis=1)
        hull = convex_hull(np.concatenate([hull, points]))
    if len(hull):
        yield pa.RecordBatch.from_arrays([pa.array(hull[:, 0]), pa.array(hull[:, 1])], names=["x", "y"])


def hull_of(points: DataFrame) -> DataFrame:
    """(x, y) of the convex hull's vertices, in one partition. Rows without a finite place are left out."""
    placed = points.select(points["x"].cast("double").alias("x"), points["y"].cast("double").alias("y"))
    placed = placed.filter("abs(x) < double('inf') AND abs(y) < double('inf')")
    partial = placed.mapInArrow(_hulls, "x double, y double")
    rounds = max(int(int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")) ** 0.5), 1)
    return partial.repartition(rounds).mapInArrow(_hulls, "x double, y double").coalesce(1).mapInArrow(_hulls, "x double, y double")


def furthest_distance(points: DataFrame) -> DataFrame:
    """One row, `furthest_m`: the largest distance of two points; NULL without points."""

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [np.stack([b.column(0).to_numpy(), b.column(1).to_numpy()], axis=1) for b in batches if b.num_rows]
        found = furthest(np.concatenate(parts)) if parts else None
        yield pa.RecordBatch.from_arrays([pa.array([found], pa.float64())], names=["furthest_m"])

    return hull_of(points).mapInArrow(turn, "furthest_m double")
