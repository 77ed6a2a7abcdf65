"""The two axes of the feature table: hours and detectors; and the chronological split."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.columns import DET, MODERN_ID, SPLIT_RATIOS, UTC
from roadpulse.functions.timefn import hour_floor
from roadpulse.operators.ordering import global_rank
from roadpulse.session import materialize


@dataclass(frozen=True)
class Axis:
    """Gap-free hourly UTC axis, closed on the left: [start, end)."""

    start: datetime
    end: datetime

    def __post_init__(self) -> None:
        hour = timedelta(hours=1)
        if self.end <= self.start or (self.end - self.start) % hour:
            raise ValueError("an axis spans a positive whole number of hours")
        if self.start.minute or self.start.second or self.start.microsecond:
            raise ValueError("an axis starts on a full hour")

    @classmethod
    def year(cls, year: int) -> Axis:
        return cls(datetime(year, 1, 1), datetime(year + 1, 1, 1))

    @property
    def hours(self) -> int:
        return int((self.end - self.start) / timedelta(hours=1))

    @property
    def _start(self) -> Column:
        return F.lit(self.start.isoformat(sep=" ")).cast("timestamp_ntz")

    def stamp(self, t_idx: Column | str) -> Column:
        return F.timestamp_add("HOUR", F.col(t_idx) if isinstance(t_idx, str) else t_idx, self._start)

    def position(self, utc: Column | str = UTC) -> Column:
        """Position of an on-axis stamp, from calendar parts only (no session zone)."""
        utc = F.col(utc) if isinstance(utc, str) else utc
        days = F.datediff(F.to_date(utc), F.lit(self.start.date()))
        return (days * 24 + F.hour(utc) - F.lit(self.start.hour)).cast("int")

    def select_on_axis(self, df: DataFrame, utc: str = UTC) -> DataFrame:
        """Rows whose stamp lies exactly on the axis, with `t_idx`.

        The two range bounds are plain comparisons, so they reach the scan.
        """
        stop = F.lit(self.end.isoformat(sep=" ")).cast("timestamp_ntz")
        return df.filter(
            (F.col(utc) >= self._start) & (F.col(utc) < stop) & (hour_floor(utc) == F.col(utc))
        ).withColumn("t_idx", self.position(utc))


def time_axis(spark: SparkSession, axis: Axis) -> DataFrame:
    """(t_idx, utc), one row per hour."""
    return spark.range(axis.hours).select(
        F.col("id").cast("int").alias("t_idx"), axis.stamp(F.col("id").cast("int")).alias(UTC)
    )


def modern_ids(df: DataFrame, id_col: str = DET) -> DataFrame:
    """Keep ids of the modern naming scheme; legacy names are left out."""
    return df.filter(F.col(id_col).rlike(MODERN_ID))


def valid_detectors(data_ids: DataFrame, location_ids: DataFrame) -> DataFrame:
    """Distinct ids with data and a location. Use `require_rows` where emptiness is an error."""
    return data_ids.select(DET).distinct().join(location_ids.select(DET), DET, "left_semi")


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """Fail at run time when a frame is empty: one count as a scalar subquery, no collect."""
    some = F.count(F.lit(1)) > 0
    guard = df.agg(F.when(some, True).otherwise(F.raise_error(F.lit(message)).cast("boolean"))).scalar()
    return df.filter(guard)


def without_match(left: DataFrame, right: DataFrame, key: str = DET) -> DataFrame:
    """Distinct keys of `left` that `right` lacks."""
    return left.select(key).distinct().join(right.select(key), key, "left_anti")


def detectors_without_location(data_ids: DataFrame, location_ids: DataFrame) -> DataFrame:
    return without_match(data_ids, location_ids)


def locations_without_data(data_ids: DataFrame, location_ids: DataFrame) -> DataFrame:
    return without_match(location_ids, data_ids)


def filter_locations_with_data(locations: DataFrame, data_ids: DataFrame) -> DataFrame:
    """Whole location rows whose id has data."""
    return locations.join(data_ids.select(DET).distinct(), DET, "left_semi")


def union_months(*parts: DataFrame) -> DataFrame:
    """Concatenate monthly parts; columns a part lacks become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def node_index(ids: DataFrame, id_col: str = DET) -> DataFrame:
    """(n_idx, id): position of every distinct id in byte order, from 0.

    The ids are written once: ranking reads them three times, their source only once.
    """
    ranked = global_rank(materialize(ids.select(id_col).distinct(), "ids"), id_col)
    return ranked.select((F.col("rank") - 1).cast("int").alias("n_idx"), id_col)


# --- chronological split ---------------------------------------------------


def split_bounds(hours: int, ratios: tuple[float, float, float] = SPLIT_RATIOS) -> tuple[int, int]:
    """(train_end, val_end), half-open, rounded half to even."""
    train_end = round(hours * ratios[0])
    val_end = round(hours * (ratios[0] + ratios[1]))
    if not 0 < train_end < val_end < hours:
        raise ValueError(f"empty split for {hours} hours: train_end={train_end}, val_end={val_end}")
    return train_end, val_end


def split_ratio(
    df: DataFrame, hours: int, ratios: tuple[float, float, float] = SPLIT_RATIOS, t: str = "t_idx"
) -> DataFrame:
    train_end, val_end = split_bounds(hours, ratios)
    return df.withColumn(
        "split",
        F.when(F.col(t) < train_end, "train").when(F.col(t) < val_end, "val").otherwise("test"),
    )


def split_calendar(df: DataFrame, val_start: datetime, test_start: datetime, utc: str = UTC) -> DataFrame:
    if not val_start < test_start:
        raise ValueError("validation starts before test")

    def at(stamp: datetime) -> Column:
        return F.lit(stamp.isoformat(sep=" ")).cast("timestamp_ntz")

    return df.withColumn(
        "split",
        F.when(F.col(utc) < at(val_start), "train")
        .when(F.col(utc) < at(test_start), "val")
        .otherwise("test"),
    )
