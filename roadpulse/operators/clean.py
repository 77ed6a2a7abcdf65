"""From irregular readings to a gap-free grid with bounded fills and a validity mask."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from roadpulse.columns import (
    COVERAGE_FLOOR,
    DET,
    FLOWS,
    QUALITY,
    QUALITY_THRESHOLD,
    SHORT_GAP_HOURS,
    TRAFFIC,
    UTC,
)
from roadpulse.operators.axes import Axis

# Hours of the grid that one task makes and sorts.
HOURS_PER_TASK = 500_000


def project_keep_cols(df: DataFrame) -> DataFrame:
    """Key, stamp, quality and the six traffic columns, in fixed order."""
    return df.select(DET, UTC, QUALITY, *TRAFFIC)


def dedupe_first(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """First row per key in the given order.

    The rank filter is applied before the shuffle as well (window group limit), so
    a key with very many copies sends one row per map task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def _observed(
    readings: DataFrame, nodes: DataFrame, axis: Axis, cols: list[str]
) -> tuple[DataFrame, WindowSpec, list[str]]:
    """On-axis readings and, at t_idx -1, one marker row per listed detector.

    The grid is far larger than the readings it is shuffled as, so the number of tasks follows from the grid: a task's memory is that of
    `HOURS_PER_TASK` hours, however many detectors there are.
    """
    flags = [c for c in nodes.columns if c != DET]
    types, flag_types = dict(readings.dtypes), dict(nodes.dtypes)
    marks = nodes.select(
        DET,
        F.lit(-1).alias("t_idx"),
        *[F.lit(None).cast(types[c]).alias(c) for c in cols],
        *flags,
    )
    rows = axis.select_on_axis(readings).select(
        DET, "t_idx", *cols, *[F.lit(None).cast(flag_types[c]).alias(c) for c in flags]
    )
    marked = rows.unionByName(marks)
    tasks = math.ceil(nodes.count() * axis.hours / HOURS_PER_TASK)
    if tasks > 1:
        marked = marked.repartition(tasks, DET)
    return marked, Window.partitionBy(DET).orderBy("t_idx"), flags


def _spread(
    rows: DataFrame, w: WindowSpec, flags: list[str], axis: Axis, carried: dict[str, Column]
) -> DataFrame:
    """One row per hour: each observed row (position `_at`) also emits the empty hours up to the next one.

    `carried` columns are computed on the observed rows, in the same window pass.
    Detectors without a marker are not listed and fall out.
    """
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    start = F.greatest("_at", F.lit(0))
    placed = rows.select(
        DET,
        F.col("t_idx").alias("_at"),
        F.coalesce(F.lead("t_idx").over(w), F.lit(axis.hours)).alias("_next"),
        F.first("t_idx").over(so_far).alias("_first"),
        *[F.first(c).over(so_far).alias(c) for c in flags],
        *[col.alias(name) for name, col in carried.items()],
    )
    hours = F.when(F.col("_next") > start, F.sequence(start, F.col("_next") - 1))
    return placed.filter(F.col("_first") == -1).select("*", F.explode(hours).alias("t_idx"))


def reindex_hourly(
    readings: DataFrame, nodes: DataFrame, axis: Axis, cols: list[str] | None = None
) -> DataFrame:
    """One row per listed detector and hour of the axis; hours without a reading are NULL.

    `readings` holds at most one row per (det_id, utc). Off-axis stamps and unlisted
    detectors are dropped. Each detector gets a marker before its first hour, and every
    row then emits the empty hours up to the next one. That takes one shuffle on det_id
    and neither a grid join nor a cross product. Further columns of `nodes` are carried.
    """
    cols = cols or [QUALITY, *TRAFFIC]
    rows, w, flags = _observed(readings, nodes, axis, cols)
    spread = _spread(rows, w, flags, axis, {c: F.col(c) for c in cols})
    seen = F.col("t_idx") == F.col("_at")
    return spread.select(
        DET,
        "t_idx",
        axis.stamp("t_idx").alias(UTC),
        *[F.when(seen, F.col(c)).alias(c) for c in cols],
        *flags,
    )


def clean_grid(
    readings: DataFrame,
    nodes: DataFrame,
    axis: Axis,
    threshold: float = QUALITY_THRESHOLD,
    limit: int = SHORT_GAP_HOURS,
) -> DataFrame:
    """`clean_detectors(reindex_hourly(..))` with a single window pass over the observed rows.

    Each observed row remembers, per feature, the last usable value and its hour; an hour takes
    that value when it is at most `limit` hours old. The empty hours are made after that, so
    the dense grid is neither sorted nor windowed for the fill.
    """
    rows, w, flags = _observed(readings, nodes, axis, [QUALITY, *TRAFFIC])
    usable = quality_filter(rows, threshold=threshold)
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = {QUALITY: F.col(QUALITY)}
    for c in TRAFFIC:
        carried[c] = F.last(c, ignorenulls=True).over(so_far)
        carried[f"_t_{c}"] = F.last(F.when(F.col(c).isNotNull(), F.col("t_idx")), ignorenulls=True).over(so_far)
    spread = _spread(usable, w, flags, axis, carried)
    filled = spread.select(
        DET,
        "t_idx",
        axis.stamp("t_idx").alias(UTC),
        F.when(F.col("t_idx") == F.col("_at"), F.col(QUALITY)).alias(QUALITY),
        *[F.when(F.col("t_idx") - F.col(f"_t_{c}") <= limit, F.col(c)).alias(c) for c in TRAFFIC],
        *flags,
    )
    return valid_mask(filled)


def quality_filter(
    df: DataFrame,
    cols: list[str] = TRAFFIC,
    threshold: float = QUALITY_THRESHOLD,
    quality: str = QUALITY,
) -> DataFrame:
    """NULL the features of rows below the threshold (strictly); a NULL quality passes."""
    low = F.col(quality) < threshold
    return df.withColumns({c: F.when(low, None).otherwise(F.col(c)) for c in cols})


def ffill_limit(
    df: DataFrame,
    cols: list[str] = TRAFFIC,
    key: str = DET,
    t: str = "t_idx",
    limit: int = SHORT_GAP_HOURS,
) -> DataFrame:
    """Forward fill by at most `limit` rows, per column; long gaps get their first hours."""
    w = Window.partitionBy(key).orderBy(t).rowsBetween(-limit, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})


def ffill_short_gaps_only(
    df: DataFrame,
    cols: list[str] = TRAFFIC,
    key: str = DET,
    t: str = "t_idx",
    max_gap: int = SHORT_GAP_HOURS,
) -> DataFrame:
    """Fill only gaps of at most `max_gap` rows in total; longer ones stay wholly empty.

    A gap is short when a value lies within `max_gap + 1` rows in both directions whose
    positions are at most `max_gap + 1` apart, or when the series ends inside it early.
    """
    ordered = Window.partitionBy(key).orderBy(t)
    upto = ordered.rowsBetween(-max_gap, 0)
    ahead = ordered.rowsBetween(0, max_gap)
    out = df.withColumn("_end", F.max(t).over(Window.partitionBy(key)))
    position = {c: F.when(F.col(c).isNotNull(), F.col(t)) for c in cols}
    out = out.withColumns(
        {f"_prev_{c}": F.last(position[c], ignorenulls=True).over(upto) for c in cols}
        | {f"_next_{c}": F.first(position[c], ignorenulls=True).over(ahead) for c in cols}
        | {f"_fill_{c}": F.last(c, ignorenulls=True).over(upto) for c in cols}
    )

    def filled(c: str) -> Column:
        nxt = F.coalesce(
            F.col(f"_next_{c}"),
            F.when(F.col("_end") - F.col(t) < max_gap, F.col("_end") + 1),
        )
        short = nxt - F.col(f"_prev_{c}") - 1 <= max_gap
        return F.when(F.col(c).isNotNull(), F.col(c)).when(short, F.col(f"_fill_{c}"))

    return out.withColumns({c: filled(c) for c in cols}).select(*df.columns)


def valid_mask(df: DataFrame, cols: list[str] = TRAFFIC) -> DataFrame:
    """`mask`: every feature has a value."""
    return df.withColumn("mask", reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]))


def clean_detectors(
    df: DataFrame, threshold: float = QUALITY_THRESHOLD, limit: int = SHORT_GAP_HOURS
) -> DataFrame:
    """Quality filter, bounded forward fill, mask."""
    return valid_mask(ffill_limit(quality_filter(df, threshold=threshold), limit=limit))


def null_counts(df: DataFrame, cols: list[str] = TRAFFIC) -> DataFrame:
    """(feature, nulls)."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return counted.unpivot([], cols, "feature", "nulls")


def coverage_report(cleaned: DataFrame, threshold: float = QUALITY_THRESHOLD) -> DataFrame:
    """Per detector: rows, raw-valid and mask-valid rows, and their difference.

    Cleaned cells keep the quality they were judged by.
    """
    raw = F.count_if(F.col(QUALITY) >= threshold)
    ok = F.count_if("mask")
    return cleaned.groupBy(DET).agg(
        F.count(F.lit(1)).alias("n_rows"),
        raw.alias("raw_valid"),
        ok.alias("mask_valid"),
        (ok - raw).alias("recovered"),
    )


def valid_share_by_detector(cells: DataFrame) -> DataFrame:
    """Share of valid cells in percent, per detector and (det_id NULL) overall."""
    return cells.rollup(DET).agg((F.avg(F.col("mask").cast("double")) * 100).alias("valid_pct"))


def min_coverage_nodes(cells: DataFrame, floor: float = COVERAGE_FLOOR) -> DataFrame:
    """Keep the cells of detectors with at least `floor` valid hours."""
    kept = (
        cells.groupBy(DET)
        .agg(F.avg(F.col("mask").cast("double")).alias("share"))
        .filter(F.col("share") >= floor)
    )
    return cells.join(kept.select(DET), DET, "left_semi")


def site_id(det: Column | str = DET) -> Column:
    return F.regexp_extract(det, r"^(TEU\d+)_", 1)


def site_aggregate(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Site-hour values: flows summed, speeds weighted by the flow of the same class.

    Where the flow sums to zero the plain mean of the speeds is taken.
    """
    keys = keys or [UTC]
    aggs = [F.sum(q).alias(q) for q in FLOWS]
    for q in FLOWS:
        v = "v" + q[1:]
        both = F.col(q).isNotNull() & F.col(v).isNotNull()
        weight = F.sum(F.when(both, F.col(q)))
        aggs.append(
            F.when(weight != 0, F.sum(F.col(q) * F.col(v)) / weight).otherwise(F.avg(v)).alias(v)
        )
    return df.withColumn("site_id", site_id()).groupBy("site_id", *keys).agg(*aggs)
