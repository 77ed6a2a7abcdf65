"""Exact quantiles, and the distance of two distributions, from a sketch and counts of brackets.

A first scan makes a mergeable sketch of every column (`percentile_approx`, ranks right to one in `SKETCH`). It cuts the value axis into cells. A
second scan counts each cell, and value by value only those cells that can hold a wanted rank: within twice the sketch's error
around it, a few thousandths of the rows. Every count is summed up in the task that reads the rows, so no row is shuffled, however many columns
there are; counts then say exactly which value has the rank. Should a sketch have missed, the counts show it, and the whole axis is counted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.operators.ordering import running_totals
from roadpulse.session import materialize

#: One over the largest error of a sketched rank, as a share of the rows.
SKETCH = 10_000
#: Cells of the first cut when distributions are compared.
GRID = 128
#: Counted values that one task orders; with more, they are ordered in range partitions.
ORDERED_ROWS = 1_000_000
#: Values of open cells that a task holds before it sums up.
HELD = 1 << 20


@dataclass(frozen=True)
class Cells:
    """A column's axis cut at `cuts`: value v lies in the cell numbered by the cuts below v. Values of `open` cells are counted one by one."""

    cuts: np.ndarray
    open: np.ndarray

    @staticmethod
    def of(cuts: list[float], intervals: list[tuple[float, float]]) -> Cells:
        """Cells at `cuts` and at the ends of closed `intervals`, which are open."""
        below = [np.nextafter(lo, -np.inf) for lo, _ in intervals]
        edges = np.unique(np.array([*cuts, *below, *[hi for _, hi in intervals]], np.float64))
        edges = edges[np.isfinite(edges)]
        opened = np.zeros(len(edges) + 1, bool)
        for lo, (_, hi) in zip(below, intervals):
            first = np.searchsorted(edges, lo, side="left") + (1 if np.isfinite(lo) else 0)
            opened[first : np.searchsorted(edges, hi, side="left") + 1] = True
        return Cells(edges, opened)


def cell_counts(df: DataFrame, cells: dict[str, Cells], group: Column | None = None) -> DataFrame:
    """(feature, cell, value, group, n): counts of cells, those of open cells by value; `value` is NULL for the others.

    `group` is a small integer that splits the counts. NULLs are not counted; NaN is the largest value.
    """
    names, plans = list(cells), list(cells.values())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        closed: dict[tuple[int, int], np.ndarray] = {}
        held: dict[tuple[int, int], list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0

        def summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
            values, at = np.unique(np.concatenate([v for v, _ in parts]), return_inverse=True)
            return values, np.bincount(at, weights=np.concatenate([n for _, n in parts]), minlength=len(values)).astype(np.int64)

        def rows(key: tuple[int, int], cell, values, n) -> pa.RecordBatch:
            k = len(n)
            value = pa.nulls(k, pa.float64()) if values is None else pa.array(values)
            columns = [pa.array([names[key[0]]] * k, pa.string()), pa.array(cell, pa.int32()), value, pa.array([key[1]] * k, pa.int32()), pa.array(n)]
            return pa.RecordBatch.from_arrays(columns, names=["feature", "cell", "value", "group", "n"])

        def handed() -> Iterator[pa.RecordBatch]:
            for key, parts in held.items():
                values, n = summed(parts)
                yield rows(key, np.searchsorted(plans[key[0]].cuts, values, side="left"), values, n)

        for batch in batches:
            groups = batch.column(len(names)).to_numpy(zero_copy_only=False)
            for f, plan in enumerate(plans):
                column = batch.column(f)
                there = column.is_valid().to_numpy(zero_copy_only=False)
                values, of = column.drop_null().to_numpy(zero_copy_only=False) + 0.0, groups[there]
                cell = np.searchsorted(plan.cuts, values, side="left")
                inside = plan.open[cell]
                for g in np.unique(of).tolist():
                    key, own = (f, g), of == g
                    closed[key] = closed.get(key, 0) + np.bincount(cell[own & ~inside], minlength=len(plan.open))
                    if (own & inside).any():
                        found = np.unique(values[own & inside], return_counts=True)
                        held.setdefault(key, []).append(found)
                        size += len(found[0])
            if size > HELD:
                held = {key: [summed(parts)] for key, parts in held.items()}
                size = sum(len(parts[0][0]) for parts in held.values())
                if size > HELD // 2:
                    yield from handed()
                    held, size = {}, 0
        yield from handed()
        for key, n in closed.items():
            at = np.flatnonzero(n)
            yield rows(key, at, None, n[at])

    wide = df.select(*[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(names)], (group if group is not None else F.lit(0)).cast("int"))
    counted = wide.mapInArrow(count, "feature string, cell int, value double, group int, n long")
    return counted.groupBy("feature", "cell", "value", "group").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Sketch:
    """Rows with a value, least and largest value, NaNs, and the sketched values of some shares."""

    n: int
    least: float
    largest: float
    nans: int
    values: dict[float, float]

    def bracket(self, prob: float) -> tuple[float, float]:
        """A closed interval that holds both neighbours of the wanted place."""
        if self.nans or self.n < 4 * SKETCH:
            return -np.inf, np.inf
        lo, hi = prob - 2 / SKETCH, prob + 2 / SKETCH
        return (self.least if lo <= 0 else self.values[lo]), (self.largest if hi >= 1 else self.values[hi])


def sketch_columns(cols: list[str], shares: list[float], where: Column | None = None, prefix: str = "") -> list[Column]:
    """Aggregates for `sketches_of`, to be joined with others of the same scan."""
    shares = sorted({s for s in shares if 0 < s < 1}) or [0.5]
    out = []
    for c in cols:
        value = F.col(c).cast("double") if where is None else F.when(where, F.col(c).cast("double"))
        plain = F.when(~F.isnan(value), value)
        out.append(
            F.struct(
                F.count(value).alias("n"),
                F.min(plain).alias("least"),
                F.max(plain).alias("largest"),
                F.count_if(F.isnan(value)).alias("nans"),
                F.percentile_approx(plain, F.array(*[F.lit(s) for s in shares]), F.lit(SKETCH)).alias("values"),
                F.array(*[F.lit(s) for s in shares]).alias("shares"),
            ).alias(f"{prefix}{c}")
        )
    return out


def sketches_of(row, cols: list[str], prefix: str = "") -> dict[str, Sketch]:
    return {
        c: Sketch(s.n, s.least, s.largest, s.nans, dict(zip(s.shares, s["values"] or []))) for c in cols for s in [row[f"{prefix}{c}"]]
    }


def bracket_shares(probs: list[float]) -> list[float]:
    return [p + d for p in probs for d in (-2 / SKETCH, 2 / SKETCH)]


def values_at(counted: DataFrame, ranks: dict[str, list[int]], cells: dict[str, Cells]) -> dict[tuple[str, int], float] | None:
    """Values with the given ranks (from 0) among a stored (feature, cell, value, n); None where a rank lies in a cell that is not open."""
    totals: dict[str, np.ndarray] = {f: np.zeros(len(c.open), np.int64) for f, c in cells.items()}
    for row in counted.groupBy("feature", "cell").agg(F.sum("n").alias("n")).collect():
        totals[row.feature][row.cell] = row.n
    wanted = []
    for f, own in ranks.items():
        ends = np.cumsum(totals[f])
        for rank in own:
            cell = int(np.searchsorted(ends, rank, side="right"))
            if not cells[f].open[cell]:
                return None
            wanted.append((f, cell, rank, rank - int(ends[cell] - totals[f][cell])))
    if not wanted:
        return {}
    places = counted.sparkSession.createDataFrame(wanted, "feature string, cell int, rank long, place long")
    # Only the cells with a wanted rank are ordered.
    needed = counted.filter("value IS NOT NULL").join(F.broadcast(places.select("feature", "cell").distinct()), ["feature", "cell"], "left_semi")
    ordered = running(needed, ["n"])
    hits = ordered.join(F.broadcast(places), ["feature", "cell"]).filter((F.col("place") < F.col("cum_n")) & (F.col("place") >= F.col("cum_n") - F.col("n")))
    return {(r.feature, r.rank): r.value for r in hits.select("feature", "rank", "value").collect()}


def running(counted: DataFrame, sums: list[str]) -> DataFrame:
    """Add `cum_<c>`: running totals within a (feature, cell) in order of value."""
    if counted.count() > ORDERED_ROWS:
        return running_totals(materialize(counted, "cells"), "value", sums, by=["feature", "cell"])
    upto = Window.partitionBy("feature", "cell").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counted.select("*", *[F.sum(c).over(upto).alias(f"cum_{c}") for c in sums])


def interpolated(found: dict[tuple[str, int], float], feature: str, position: float) -> float:
    lo, hi = found[feature, int(np.floor(position))], found[feature, int(np.ceil(position))]
    return lo if lo == hi else lo + (hi - lo) * float(position - np.floor(position))


def located(
    df: DataFrame, sketches: dict[str, Sketch], probs: list[float], cuts: dict[str, list[float]] | None = None, group: Column | None = None
) -> tuple[dict[tuple[str, float], float], DataFrame, dict[str, Cells]]:
    """Exact quantiles by (column, prob) of the rows of group 0, with the counts and cells they come from.

    Linear interpolation between the two nearest ranks. One scan, another over the whole axis should a sketch have missed.
    """
    at = {f: [p * (s.n - 1) for p in probs] if s.n else [] for f, s in sketches.items()}
    ranks = {f: sorted({int(r(p)) for p in own for r in (np.floor, np.ceil)}) for f, own in at.items()}
    cuts = cuts or {f: [] for f in sketches}
    for whole in (False, True):
        cells = {f: Cells.of(cuts[f], [(-np.inf, np.inf)] if whole else [s.bracket(p) for p in probs] if s.n else []) for f, s in sketches.items()}
        counted = materialize(cell_counts(df, cells, group), "counts")
        found = values_at(counted.filter(F.col("group") == 0), ranks, cells)
        if found is not None:
            return {(f, p): interpolated(found, f, x) for f, own in at.items() for p, x in zip(probs, own)}, counted, cells
    raise AssertionError("a rank lies in no cell")


def cell_totals(counted: DataFrame, cells: dict[str, Cells], groups: int) -> dict[str, np.ndarray]:
    """Counts by (group, cell) of each feature: as many numbers as there are cells."""
    out = {f: np.zeros((groups, len(c.open)), np.int64) for f, c in cells.items()}
    for row in counted.groupBy("feature", "cell", "group").agg(F.sum("n").alias("n")).collect():
        out[row.feature][row.group, row.cell] = row.n
    return out


@dataclass(frozen=True)
class Comparison:
    """Quantiles of the first sample, counts of both between them, and the largest gap of the distribution functions."""

    edges: list[float]
    first: np.ndarray
    second: np.ndarray
    gap: float | None


def compared(first: DataFrame, second: DataFrame, cols: list[str], probs: list[float]) -> dict[str, Comparison]:
    """Both samples column by column, exact, in three scans.

    Between two cuts the distribution functions can differ by no more than from the start of one to the end of the other. So after the
    second scan only cells whose bound exceeds the largest gap at a cut are counted by value, in the third.
    """

    def of(sample: DataFrame, group: int) -> DataFrame:
        return sample.select(*[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(cols)], F.lit(group).alias("g"))

    both, names = of(first, 0).unionByName(of(second, 1)), [f"v{i}" for i in range(len(cols))]
    grid = [i / GRID for i in range(1, GRID)]
    row = both.agg(
        *sketch_columns(names, grid + bracket_shares(probs), F.col("g") == 0, "a"), *sketch_columns(names, grid, F.col("g") == 1, "b")
    ).first()
    one, two = sketches_of(row, names, "a"), sketches_of(row, names, "b")
    cuts = {f: [v for s in (one[f], two[f]) for share, v in s.values.items() if share in set(grid)] for f in names}
    quantiles, counted, cells = located(both, one, probs, cuts, F.col("g"))
    edges = {f: [quantiles[f, p] for p in probs] if one[f].n else [] for f in names}

    def gaps(total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distribution functions of both at the start and the end of each cell."""
        ends = np.cumsum(total, axis=1) / total.sum(1, keepdims=True)
        return np.concatenate([np.zeros((2, 1)), ends[:, :-1]], axis=1), ends

    comparable = [f for f in names if one[f].n and two[f].n]
    # Without one of the samples nothing is compared; its rows are counted between the edges all the same.
    totals, finer, best = cell_totals(counted, cells, 2), {}, {}
    for f in names:
        intervals = []
        if f in comparable:
            start, end = gaps(totals[f])
            best[f] = float(np.abs(end[0] - end[1]).max())
            bound = np.maximum(end[0] - start[1], end[1] - start[0])
            limits = np.concatenate([[-np.inf], cells[f].cuts, [np.inf]])
            intervals = [(np.nextafter(limits[i], np.inf), limits[i + 1]) for i in np.flatnonzero(bound > best[f]).tolist()]
            intervals = [(-np.inf if lo == np.nextafter(-np.inf, np.inf) else lo, hi) for lo, hi in intervals]
        finer[f] = Cells.of(edges[f], intervals)
    counted = materialize(cell_counts(both, finer, F.col("g")), "counts")
    totals = cell_totals(counted, finer, 2)
    before = []
    for f in comparable:
        start = np.cumsum(totals[f], axis=1) - totals[f]
        before += [(f, i, int(start[0, i]), int(start[1, i])) for i in np.flatnonzero(finer[f].open).tolist()]
    if before:
        starts = F.broadcast(both.sparkSession.createDataFrame(before, "feature string, cell int, a0 long, b0 long"))
        n = F.broadcast(both.sparkSession.createDataFrame([(f, one[f].n, two[f].n) for f in comparable], "feature string, a_all long, b_all long"))
        values = counted.filter("value IS NOT NULL").groupBy("feature", "cell", "value")
        values = values.agg(*[F.sum(F.when(F.col("group") == g, F.col("n")).otherwise(0)).alias(c) for g, c in enumerate(("a", "b"))])
        gap = F.abs((F.col("a0") + F.col("cum_a")) / F.col("a_all") - (F.col("b0") + F.col("cum_b")) / F.col("b_all"))
        inside = running(values, ["a", "b"]).join(starts, ["feature", "cell"]).join(n, "feature").groupBy("feature").agg(F.max(gap).alias("gap"))
        for r in inside.collect():
            best[r.feature] = max(best[r.feature], r.gap)

    out = {}
    for f, c in zip(names, cols):
        if not one[f].n and not two[f].n:
            continue
        # A cell lies in one bin: its start says how many edges are below.
        bins = np.searchsorted(edges[f], np.concatenate([[-np.inf], finer[f].cuts]), side="right")
        sums = [np.bincount(bins, weights=totals[f][g], minlength=len(probs) + 1).astype(np.int64) for g in (0, 1)]
        out[c] = Comparison(edges[f], sums[0], sums[1], best.get(f))
    return out
