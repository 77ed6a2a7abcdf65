"""Model inputs, targets and naive forecasts on the gap-free axis.

All windows partition by detector; a detector has as many rows as the axis has hours.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from roadpulse.columns import DET, FEATURES, HORIZONS, TRAFFIC, UTC, ZONE
from roadpulse.functions.timefn import hour_of_week


def _by_time() -> WindowSpec:
    return Window.partitionBy(DET).orderBy("t_idx")


def window_samples(
    cells: DataFrame, cols: list[str] = FEATURES, target: str = "vkfz", past: int = 12, ahead: int = 12
) -> DataFrame:
    """Sliding samples, stride 1, never across a split border.

    (det_id, split, t0, x_in [past][cols], y [ahead], y_mask [ahead]); t0 is the position
    of the first input row. Copies each row past + ahead times, so project first.
    """
    w = Window.partitionBy(DET, "split").orderBy("t_idx")
    x = F.array(*[F.col(c).cast("float") for c in cols])
    inputs = F.collect_list(x).over(w.rowsBetween(-(past - 1), 0))
    targets = F.collect_list(F.struct(F.col(target).cast("float").alias("v"), F.col("mask").alias("m"))).over(
        w.rowsBetween(1, ahead)
    )
    return (
        cells.select(DET, "split", "t_idx", inputs.alias("x_in"), targets.alias("_y"))
        .filter((F.size("x_in") == past) & (F.size("_y") == ahead))
        .select(
            DET,
            "split",
            (F.col("t_idx") - (past - 1)).alias("t0"),
            "x_in",
            F.col("_y.v").alias("y"),
            F.col("_y.m").alias("y_mask"),
        )
    )


def input_length_variants(cells: DataFrame, lengths: tuple[int, ...] = (6, 12, 24, 48), **kw) -> DataFrame:
    """Samples for several input lengths, with the length as a column."""
    parts = [
        window_samples(cells, past=length, **kw).withColumn("input_length", F.lit(length)) for length in lengths
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def horizon_targets(cells: DataFrame, col: str = "vkfz", horizons: tuple[int, ...] = HORIZONS) -> DataFrame:
    """Add `y_<h>` and `mask_<h>`, the target and its validity h hours ahead."""
    cols = {}
    for h in horizons:
        cols[f"y_{h}"] = F.lead(col, h).over(_by_time())
        cols[f"mask_{h}"] = F.lead("mask", h).over(_by_time())
    return cells.withColumns(cols)


MODELS = ("last_value", "hour_of_week", "ar1")


def naive_forecasts(
    cells: DataFrame,
    hours: int,
    col: str = "vkfz",
    horizons: tuple[int, ...] = HORIZONS,
    models: tuple[str, ...] = MODELS,
    zone: str = ZONE,
) -> DataFrame:
    """Forecasts of the naive models beside their targets, in one pass over the cells.

    (model, det_id, t_idx, horizon, y_hat, y, mask, split), where t_idx and the last three are of the hour
    the forecast is for. Everything is a window over the detector, so no model reads the cells
    again and the targets need no join.
    """
    w, whole = _by_time(), Window.partitionBy(DET)
    valid = (F.col("split") == "train") & F.col("mask")
    df = cells.select(DET, "t_idx", UTC, "split", "mask", F.col(col).alias("_now"))
    if "hour_of_week" in models:
        by_hour = Window.partitionBy(DET, "_how")
        df = df.withColumn("_how", hour_of_week(UTC, zone)).withColumn(
            "_mean", F.avg(F.when(valid, F.col("_now"))).over(by_hour)
        )
    if "ar1" in models:
        # Fitted on consecutive valid training hours.
        df = df.withColumn("_x", F.when(valid, F.lag(F.when(valid, F.col("_now"))).over(w)))
        df = df.withColumn("_y", F.when(F.col("_x").isNotNull(), F.col("_now")))
        df = df.withColumn("_b", F.regr_slope("_y", "_x").over(whole)).withColumn(
            "_a", F.regr_intercept("_y", "_x").over(whole)
        )

    def y_hat(model: str, h: int) -> Column:
        if model == "last_value":
            return F.col("_now")
        if model == "hour_of_week":
            return F.lead("_mean", h).over(w)
        if model == "ar1":
            a, b = F.col("_a"), F.col("_b")
            power = F.pow(b, F.lit(float(h)))
            return F.when(b == 1, F.col("_now") + a * h).otherwise(
                power * F.col("_now") + a * (1 - power) / (1 - b)
            )
        raise ValueError(f"unknown model {model}")

    wide = df.select(
        DET,
        "t_idx",
        *[y_hat(m, h).alias(f"{m}_{h}") for m in models for h in horizons],
        *[F.lead(F.struct(F.col("_now").alias("y"), "mask", "split"), h).over(w).alias(f"at_{h}") for h in horizons],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(m).alias("model"),
                F.lit(h).alias("horizon"),
                (F.col("t_idx") + h).alias("at"),
                F.col(f"{m}_{h}").alias("y_hat"),
                F.col(f"at_{h}").alias("target"),
            )
            for m in models
            for h in horizons
        ]
    )
    return (
        wide.select(DET, F.inline(rows))
        .filter(F.col("at") < hours)
        .select("model", DET, F.col("at").alias("t_idx"), "horizon", "y_hat", "target.y", "target.mask", "target.split")
    )


_FORECAST = ("model", DET, "t_idx", "horizon", "y_hat")


def baseline_last_value(
    cells: DataFrame, hours: int, col: str = "vkfz", horizons: tuple[int, ...] = HORIZONS
) -> DataFrame:
    """The current value, carried h hours ahead."""
    return naive_forecasts(cells, hours, col, horizons, ("last_value",)).select(*_FORECAST)


def baseline_hour_of_week(
    cells: DataFrame, hours: int, col: str = "vkfz", horizons: tuple[int, ...] = HORIZONS, zone: str = ZONE
) -> DataFrame:
    """Mean of valid training rows of the target's local hour of week."""
    return naive_forecasts(cells, hours, col, horizons, ("hour_of_week",), zone).select(*_FORECAST)


def baseline_ar1(
    cells: DataFrame, hours: int, col: str = "vkfz", horizons: tuple[int, ...] = HORIZONS
) -> DataFrame:
    """First-order autoregression per detector, h steps in closed form."""
    return naive_forecasts(cells, hours, col, horizons, ("ar1",)).select(*_FORECAST)


def forecast_vs_actual(preds: DataFrame, cells: DataFrame, col: str = "vkfz") -> DataFrame:
    """Predictions beside target, mask and split of the hour they are for."""
    actual = cells.select(DET, "t_idx", "split", F.col(col).alias("y"), "mask")
    return preds.join(actual, [DET, "t_idx"])


def week_over_week(df: DataFrame, col: str = "vkfz") -> DataFrame:
    """Value, the value 168 hours earlier, and the change, on the gap-free axis."""
    before = F.lag(col, 168).over(_by_time())
    return df.withColumn("last_week", before).withColumn("change", F.col(col) - F.col("last_week"))


def historical_slice(df: DataFrame, ids: list[str], start: datetime, end: datetime) -> DataFrame:
    """Rows of some sensors with start <= utc < end; all conditions reach the scan."""

    def at(ts: datetime) -> Column:
        return F.lit(ts.isoformat(sep=" ")).cast("timestamp_ntz")

    return df.filter(F.col(DET).isin(ids) & (F.col(UTC) >= at(start)) & (F.col(UTC) < at(end)))
