"""Masked errors, report tables, significance, drift and the promotion gate.

Input rows carry y, y_hat and mask, and the keys a report groups by.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.columns import (
    DET,
    FREE_FLOW_ABOVE,
    HORIZONS,
    MAPE_MIN_TARGET,
    PROMOTION_MARGIN,
    TRAFFIC,
)
from roadpulse.functions.stats import t_two_sided
from roadpulse.operators.quantiles import compared

SHARE_FLOOR = 1e-6


def congestion_regime(df: DataFrame, col: str = "vkfz", above: float = FREE_FLOW_ABOVE) -> DataFrame:
    return df.withColumn("regime", F.when(F.col(col) > above, "free_flow").when(F.col(col) <= above, "congested"))


def mape_domain(y: Column | str = "y", least: float = MAPE_MIN_TARGET) -> Column:
    """Targets the percentage error is defined on."""
    return (F.col(y) if isinstance(y, str) else y) >= least


def _grouped(df: DataFrame, by: list[str] | None, *aggs: Column) -> DataFrame:
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def masked_mae(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Sum of valid absolute errors over the number of valid rows, at least 1."""
    err = F.when(F.col("mask"), F.abs(F.col("y_hat") - F.col("y")))
    mae = F.coalesce(F.sum(err), F.lit(0.0)) / F.greatest(F.count(err), F.lit(1))
    return _grouped(df, by, mae.alias("mae"))


def error_metrics(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """n, MAE, RMSE and MAPE (percent, small targets left out) over valid rows with a prediction."""
    by = ["model", "horizon"] if by is None else by
    e = F.col("y_hat") - F.col("y")
    rows = df.filter(F.col("mask") & e.isNotNull())
    return _grouped(
        rows,
        by,
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        (F.avg(F.when(mape_domain(), F.abs(e / F.col("y")))) * 100).alias("mape"),
    )


def errors_on_test(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    return error_metrics(df.filter(F.col("split") == "test"), by)


def error_table(metrics: DataFrame, horizons: tuple[int, ...] = HORIZONS) -> DataFrame:
    """One row per model, metrics of each horizon as columns `<metric>_h<h>`."""
    names = ["mae", "rmse", "mape"]
    wide = metrics.groupBy("model").pivot("horizon", list(horizons)).agg(*[F.max(m).alias(m) for m in names])
    return wide.select("model", *[F.col(f"{h}_{m}").alias(f"{m}_h{h}") for m in names for h in horizons])


def error_by_sensor(df: DataFrame, locations: DataFrame) -> DataFrame:
    """Test MAE per sensor (over models and horizons present) with its coordinates."""
    per_sensor = errors_on_test(df, [DET]).select(DET, "n", "mae")
    return per_sensor.join(locations.select(DET, "lon", "lat"), DET, "left")


def error_by_regime(df: DataFrame) -> DataFrame:
    return errors_on_test(congestion_regime(df, "y"), ["model", "regime"])


def seed_summary(metrics: DataFrame, metric: str = "mae") -> DataFrame:
    """Mean and sample deviation of a metric over the seeds of each model and horizon."""
    return metrics.groupBy("model", "horizon").agg(
        F.count(F.lit(1)).alias("seeds"), F.avg(metric).alias("mean"), F.stddev_samp(metric).alias("std")
    )


def paired_t_statistic(df: DataFrame, a: str, b: str) -> DataFrame:
    """Paired t of the absolute errors of two models over the rows both predict, and its two-sided probability.

    Without two rows, or where all differences are equal, t and p are NULL.
    """
    err = F.when(F.col("mask"), F.abs(F.col("y_hat") - F.col("y")))
    paired = (
        df.filter(F.col("model").isin(a, b))
        .groupBy(DET, "t_idx", "horizon")
        .agg(
            F.max(F.when(F.col("model") == a, err)).alias("_a"),
            F.max(F.when(F.col("model") == b, err)).alias("_b"),
        )
        .select((F.col("_a") - F.col("_b")).alias("d"))
    )
    n = F.count("d")
    spread = F.stddev_samp("d")
    found = paired.agg(
        n.alias("n"),
        F.avg("d").alias("mean_difference"),
        (F.avg("d") / F.nullif(spread / F.sqrt(n), F.lit(0.0))).alias("t"),
        (n - 1).alias("df"),
    )
    return found.withColumn("p", t_two_sided("t", "df"))


def feature_drift(
    train: DataFrame, new: DataFrame, cols: list[str] = TRAFFIC, bins: int = 10
) -> DataFrame:
    """Per feature: population stability index on training quantile bins, and KS distance, both exact.

    NULL for a feature one of the samples lacks; a feature without any value has no row. `quantiles.compared` reads the samples three times
    and shuffles counts only.
    """
    found = compared(train, new, cols, [i / bins for i in range(1, bins)])
    rows = []
    for feature, c in found.items():
        psi = None
        if c.gap is not None:
            a, b = (np.maximum(n / n.sum(), SHARE_FLOOR) for n in (c.first, c.second))
            psi = float(((b - a) * np.log(b / a)).sum())
        rows.append((feature, psi, c.gap))
    return train.sparkSession.createDataFrame(rows, "feature string, psi double, ks double")


def promotion_gate(
    metrics: DataFrame, champion: str, challenger: str, margin: float = PROMOTION_MARGIN
) -> DataFrame:
    """Promote when the challenger's MAE is at most (1 - margin) times the champion's."""
    old = F.max(F.when(F.col("model") == champion, F.col("mae")))
    new = F.max(F.when(F.col("model") == challenger, F.col("mae")))
    both = metrics.agg(old.alias("champion_mae"), new.alias("challenger_mae"))
    return both.withColumn(
        "promote", F.coalesce(F.col("challenger_mae") <= F.col("champion_mae") * (1 - margin), F.lit(False))
    )
