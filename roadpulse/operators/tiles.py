"""Sums over all pairs of a point set without ever emitting a pair.

Distinct points with their multiplicity are cut into blocks of a fixed size, each pair of
blocks is one row, and one vectorised call reduces a block pair to three numbers.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK_POINTS = 1500


_SUMS = T.StructType([T.StructField(c, T.DoubleType()) for c in ("sum_d", "sum_d2", "max_d")])


def _tile_reducer():
    """Built per call, so that it is shipped by value to the executors."""

    def reduce_tile(
        xa: pd.Series, ya: pd.Series, wa: pd.Series, xb: pd.Series, yb: pd.Series, wb: pd.Series
    ) -> pd.DataFrame:
        out = np.empty((len(xa), 3))
        for i, (x1, y1, w1, x2, y2, w2) in enumerate(zip(xa, ya, wa, xb, yb, wb)):
            d = np.hypot(np.subtract.outer(x1, x2), np.subtract.outer(y1, y2))
            out[i] = w1 @ d @ w2, w1 @ (d * d) @ w2, d.max()
        return pd.DataFrame(out, columns=["sum_d", "sum_d2", "max_d"])

    return F.pandas_udf(reduce_tile, _SUMS)


def weighted_points(nodes: DataFrame) -> DataFrame:
    """(x, y, members): distinct places and the number of nodes at each."""
    return nodes.groupBy("x", "y").agg(F.count(F.lit(1)).cast("double").alias("members"))


def pair_sums(points: DataFrame, block_points: int = BLOCK_POINTS) -> DataFrame:
    """One row: sum and sum of squares of the distances of all node pairs, and the largest one."""
    blocks = points.agg(F.greatest(F.ceil(F.count(F.lit(1)) / block_points), F.lit(1)).cast("int")).scalar()
    # Distinct points spread evenly by hash, so a block holds about `block_points` of them.
    blocked = (
        points.withColumn("blocks", blocks)
        .groupBy(F.pmod(F.xxhash64("x", "y"), F.col("blocks")).cast("int").alias("block"), "blocks")
        .agg(F.collect_list(F.struct("x", "y", "members")).alias("p"))
    )

    def side(name: str, partners) -> DataFrame:
        return blocked.select(
            F.col("block").alias(name),
            F.explode(partners).alias("b" if name == "a" else "a"),
            F.col("p.x").alias(f"x{name}"),
            F.col("p.y").alias(f"y{name}"),
            F.col("p.members").alias(f"w{name}"),
        )

    later = F.sequence(F.col("block"), F.col("blocks") - 1)
    earlier = F.sequence(F.lit(0), F.col("block"))
    tiles = side("a", later).join(side("b", earlier), ["a", "b"])
    reduced = tiles.select(
        (F.col("a") == F.col("b")).alias("same"), _tile_reducer()("xa", "ya", "wa", "xb", "yb", "wb").alias("r")
    )
    half = F.when(F.col("same"), 0.5).otherwise(1.0)  # a block against itself sees each pair twice
    return reduced.agg(
        F.sum(half * F.col("r.sum_d")).alias("sum_d"),
        F.sum(half * F.col("r.sum_d2")).alias("sum_d2"),
        F.max("r.max_d").alias("max_d"),
    )
