"""Sum of all pair distances of a plane set within a stated error, without a pair.

A length is, up to a factor, the mean of its shadows over all directions (Crofton's formula), and on a line the sum of all distances
follows from counts and sums in order. So the points are projected on equally spaced directions and counted in bins there: pairs
in different bins are exact, those inside one bin have at most its width. Work grows as the number of places; what is shuffled
after the projections are bins. Both errors, of the directions and of the bins, are bounded and reported.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Places that one task projects at a time, and directions it does that for.
SLICE_PLACES = 1_000_000
DIRECTIONS_A_TASK = 64
#: Sampled places for each bin; they only say where bins end.
SAMPLE_A_BIN = 8
_BINS = "direction int, n binary, first binary, own binary, low double, high double"


def _edges(sample: np.ndarray, direction: np.ndarray, bins: int) -> np.ndarray:
    """Inner ends of the bins: quantiles of the sample's shadows, without repeats."""
    return np.unique(np.quantile(sample @ direction, np.linspace(0, 1, bins + 1)[1:-1]))


def _angles(count: int) -> np.ndarray:
    turn = np.pi * np.arange(count) / count
    return np.column_stack([np.cos(turn), np.sin(turn)])


def _binner(sample: np.ndarray, centre: np.ndarray, directions: int, bins: int):
    """Counts, sums and own squares of the members by direction and bin, for a slice of places."""

    def project(pdf: pd.DataFrame) -> pd.DataFrame:
        at, members = pdf[["x", "y"]].to_numpy(float) - centre, pdf["members"].to_numpy(float)
        start, rows = int(pdf["part"].iloc[0]) * DIRECTIONS_A_TASK, []
        for k, direction in enumerate(_angles(directions)[start : start + DIRECTIONS_A_TASK], start):
            place = at @ direction
            bin_of = np.searchsorted(_edges(sample, direction, bins), place, side="right")
            sums = (np.bincount(bin_of, w, bins).tobytes() for w in (members, members * place, members * members))
            rows.append((k, *sums, place.min(), place.max()))
        return pd.DataFrame(rows, columns=["direction", "n", "first", "own", "low", "high"])

    return project


def _folder(sample: np.ndarray, directions: int, bins: int):
    """(sum of distances, half of what is open) of one direction."""

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        n, first, own = (sum(np.frombuffer(b) for b in pdf[c]) for c in ("n", "first", "own"))
        edges = _edges(sample, _angles(directions)[int(pdf["direction"].iloc[0])], bins)
        width = np.diff(np.concatenate([[min(pdf["low"].min(), *edges[:1])], edges, [max(pdf["high"].max(), *edges[-1:])]]))
        across = float(((np.cumsum(n) - n) * first - (np.cumsum(first) - first) * n).sum())
        # Inside a bin distances add up to most when half of the members are at each end; copies of a place add nothing.
        inside = float((np.minimum(n * n / 4, (n * n - own) / 2)[: len(width)] * width).sum())
        return pd.DataFrame({"total": [across + inside / 2], "open": [inside / 2]})

    return fold


def distance_sum(places: DataFrame, max_error: float) -> tuple[float, float]:
    """(sum of the distances of all unordered node pairs, bound of its error), the bound at most `max_error` of the sum.

    `places` has x, y and members (nodes at that place), a row per place; it is read several times. No place, one place or copies of
    one give (0, 0). The bins' ends come from a sample of places by hash: bins are made four times as many until the bound holds.
    """
    if not max_error > 0:
        raise ValueError("the error must be above zero; `pair_sums` is exact")
    n_places = places.count()
    if n_places < 2:
        return 0.0, 0.0
    # The shares of the error: three quarters for directions, whose bound is pi^2 / (16 n^2).
    directions = math.ceil(math.pi / 4 / math.sqrt(0.75 * max_error))
    bins = 2 ** math.ceil(math.log2(4 / math.sqrt(max_error)))
    t = math.pi / (2 * directions)
    least, most = t / math.tan(t), t / math.sin(t)
    slices, parts = math.ceil(n_places / SLICE_PLACES), math.ceil(directions / DIRECTIONS_A_TASK)
    slice_of = F.pmod(F.xxhash64("x", "y"), F.lit(slices)).alias("slice")
    split = places.select(F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), slice_of, "x", "y", "members")
    split = split.repartition(parts * slices, "part", "slice")
    while True:
        # Another hash than that of the slices, and the place itself for equal ones.
        near = places.select("x", "y").orderBy(F.xxhash64("y", "x"), "x", "y").limit(SAMPLE_A_BIN * bins).toPandas()
        centre = near.to_numpy(float).mean(0)
        sample = near.to_numpy(float) - centre
        binned = split.groupBy("part", "slice").applyInPandas(_binner(sample, centre, directions, bins), _BINS)
        folded = binned.groupBy("direction").applyInPandas(_folder(sample, directions, bins), "total double, open double")
        total, unsure = folded.agg(F.sum("total"), F.sum("open")).first()
        found = t * total * 2 / (least + most)
        error = found * (most - least) / (2 * least) + t * unsure / least
        if error <= max_error * found:
            return found, error
        bins *= 4
