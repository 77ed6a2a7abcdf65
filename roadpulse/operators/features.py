"""Dense model inputs: imputation, time features, calendar and node features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadpulse.columns import CYCLIC, DET, FEATURE_SETS, FEATURES, TRAFFIC, UTC, ZONE
from roadpulse.functions.timefn import cyclic, hour_of_week, local_time
from roadpulse.operators.axes import Axis, time_axis


def cyclic_features(df: DataFrame, zone: str = ZONE, utc: str = UTC) -> DataFrame:
    return df.withColumns(cyclic(utc, zone))


def with_hour_of_week(df: DataFrame, zone: str = ZONE, utc: str = UTC) -> DataFrame:
    return df.withColumn("how", hour_of_week(utc, zone))


def seasonal_mean(df: DataFrame, cols: list[str] = TRAFFIC, zone: str = ZONE) -> DataFrame:
    """Mean per detector and local hour of week, NULLs skipped."""
    return (
        with_hour_of_week(df, zone)
        .groupBy(DET, "how")
        .agg(*[F.avg(c).alias(c) for c in cols])
    )


def _fit_rows(fit_on: str, train_end: int | None):
    if fit_on == "all":
        return lambda c: F.col(c)
    if fit_on == "train" and train_end is not None:
        return lambda c: F.when(F.col("t_idx") < train_end, F.col(c))
    raise ValueError("fit_on is 'all', or 'train' with train_end")


def calendar(spark: SparkSession, axis: Axis, zone: str = ZONE) -> DataFrame:
    """(t_idx, how, cyclic columns) per hour of the axis.

    Zone arithmetic is then done once per hour and not once per cell. It is joined without a hint: Spark knows its
    size from the length of the axis and broadcasts what its own limit allows.
    """
    hours = time_axis(spark, axis)
    return cyclic_features(with_hour_of_week(hours, zone), zone).drop(UTC)


def seasonal_lookup(
    df: DataFrame,
    cols: list[str] = TRAFFIC,
    zone: str = ZONE,
    fit_on: str = "all",
    train_end: int | None = None,
) -> DataFrame:
    """Attach `<c>_seasonal`, the detector's mean for the same local hour of week."""
    fit = _fit_rows(fit_on, train_end)
    w = Window.partitionBy(DET, "how")
    known = df if "how" in df.columns else with_hour_of_week(df, zone)
    return known.withColumns({f"{c}_seasonal": F.avg(fit(c)).over(w) for c in cols})


def impute_seasonal(
    df: DataFrame,
    cols: list[str] = TRAFFIC,
    zone: str = ZONE,
    fit_on: str = "all",
    train_end: int | None = None,
) -> DataFrame:
    """Fill by hour-of-week mean, then by the mean of the so filled column, then by 0.

    Both windows partition by detector, so a frame already hashed on det_id is only sorted.
    `fit_on='train'` keeps later hours out of the means.
    """
    fit = _fit_rows(fit_on, train_end)
    looked = seasonal_lookup(df, cols, zone, fit_on, train_end).withColumns(
        {c: F.coalesce(F.col(c), F.col(f"{c}_seasonal")) for c in cols}
    )
    w = Window.partitionBy(DET)
    filled = looked.withColumns(
        {c: F.coalesce(F.col(c), F.avg(fit(c)).over(w), F.lit(0.0)) for c in cols}
    )
    return filled.select(*df.columns)


def engineer_features(
    df: DataFrame,
    zone: str = ZONE,
    fit_on: str = "all",
    train_end: int | None = None,
    hours: DataFrame | None = None,
) -> DataFrame:
    """Imputed traffic columns and the four cyclic ones.

    `hours`, a `calendar` of the axis, saves the zone arithmetic per cell.
    """
    if hours is None:
        return cyclic_features(impute_seasonal(df, TRAFFIC, zone, fit_on, train_end), zone)
    return impute_seasonal(df.join(hours, "t_idx"), TRAFFIC, zone, fit_on, train_end).drop("how")


def feature_subset(df: DataFrame, kind: str = "all") -> DataFrame:
    """Keys, the chosen traffic columns ('all', 'flow' or 'speed') and the cyclic ones."""
    keys = [c for c in df.columns if c not in FEATURES]
    return df.select(*keys, *FEATURE_SETS[kind], *CYCLIC)


def cast_float32(df: DataFrame, cols: list[str] = FEATURES) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("float") for c in cols})


def holiday_feature(df: DataFrame, holidays: DataFrame, zone: str = ZONE, utc: str = UTC) -> DataFrame:
    """`is_holiday`, `is_public_holiday`, `is_school_holiday` of the local date.

    The calendar is reduced to one row per date first, so overlapping kinds add no rows.
    """
    days = holidays.groupBy("d").agg(
        F.max(F.col("kind") == "public").alias("_public"),
        F.max(F.col("kind") == "school").alias("_school"),
    )
    joined = df.withColumn("_d", F.to_date(local_time(utc, zone))).join(
        days, F.col("_d") == days["d"], "left"
    )
    no = F.lit(False)
    return joined.select(
        *df.columns,
        F.col("d").isNotNull().alias("is_holiday"),
        F.coalesce("_public", no).alias("is_public_holiday"),
        F.coalesce("_school", no).alias("is_school_holiday"),
    )


def direction_lane_features(df: DataFrame, locations: DataFrame, directions: list[str]) -> DataFrame:
    """Lane number and one 0/1 column per listed direction, joined by detector."""
    attrs = locations.select(
        DET,
        F.col("lane").cast("int").alias("lane"),
        *[
            F.coalesce((F.col("direction") == d).cast("int"), F.lit(0)).alias(f"dir_{d.lower()}")
            for d in directions
        ],
    )
    return df.join(attrs, DET, "left")
