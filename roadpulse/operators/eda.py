"""Profiles of readings and locations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.columns import DET, QUALITY, UTC, ZONE
from roadpulse.functions.timefn import local_hour, local_weekday, minutes_between
from roadpulse.operators.clean import dedupe_first, site_id
from roadpulse.operators.quantiles import bracket_shares, located, sketch_columns, sketches_of
from roadpulse.operators.skew import salted_join
from roadpulse.session import materialize

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


DESCRIBED = "feature string, n long, mean double, std double, min double, max double, q25 double, q50 double, q75 double"


def describe_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """count, mean, std, min, quartiles, max per column, all exact; NULLs are not counted, a column without values has n 0 and NULLs.

    Two scans: one for the moments and a sketch, one that counts the values near the quartiles.
    """
    probs = list(QUARTILES.values())
    moments = [
        F.struct(F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"), F.min(F.col(c).cast("double")).alias("min"), F.max(F.col(c).cast("double")).alias("max")).alias(f"m_{c}")
        for c in cols
    ]
    row = df.agg(*moments, *sketch_columns(cols, bracket_shares(probs), prefix="s_")).first()
    sketches = sketches_of(row, cols, "s_")
    quartiles, _, _ = located(df, sketches, probs)
    rows = [(c, sketches[c].n, *row[f"m_{c}"], *[quartiles.get((c, p)) for p in probs]) for c in cols]
    return df.sparkSession.createDataFrame(rows, DESCRIBED)


def profile_columns(df: DataFrame) -> DataFrame:
    """(position, column, type, non_null) of every column."""
    wide = df.agg(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(name).alias("column"),
                F.lit(kind).alias("type"),
                F.count(F.col(f"`{name}`")).alias("non_null"),
            ).alias(f"c{i}")
            for i, (name, kind) in enumerate(df.dtypes)
        ]
    )
    return wide.select(F.inline(F.array(*wide.columns)))


def distinct_sensors(df: DataFrame, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct(DET) if approximate else F.count_distinct(DET)
    return df.agg(count.alias("sensors"))


def time_range(df: DataFrame, utc: str = UTC) -> DataFrame:
    return df.agg(F.min(utc).alias("first_utc"), F.max(utc).alias("last_utc"))


def sampling_interval(df: DataFrame, utc: str = UTC) -> DataFrame:
    """Most frequent step between consecutive stamps per detector, in minutes; ties to the smaller.

    Steps are taken inside each (detector, day) and across the day borders from the
    days' first and last stamps, so a detector with very many rows is spread over days.
    """
    stamps = df.select(DET, F.col(utc).alias("_at"), F.to_date(utc).alias("_day")).distinct()
    inside = Window.partitionBy(DET, "_day").orderBy("_at")
    within = stamps.select(DET, F.lag("_at").over(inside).alias("_prev"), "_at")
    days = stamps.groupBy(DET, "_day").agg(F.min("_at").alias("_at"), F.max("_at").alias("_last"))
    by_day = Window.partitionBy(DET).orderBy("_day")
    across = days.select(DET, F.lag("_last").over(by_day).alias("_prev"), "_at")
    steps = (
        within.unionByName(across)
        .filter(F.col("_prev").isNotNull())
        .select(DET, minutes_between("_prev", "_at").alias("step_minutes"))
        .groupBy(DET, "step_minutes")
        .agg(F.count(F.lit(1)).alias("steps"))
    )
    return dedupe_first(steps, [DET], [F.desc("steps"), F.asc("step_minutes")])


def _profile(df: DataFrame, key: Column, name: str) -> DataFrame:
    return df.groupBy(key.alias(name)).agg(
        F.avg("qkfz").alias("mean_flow"), F.avg("vkfz").alias("mean_speed"), F.count(F.lit(1)).alias("n")
    )


def daily_profile(df: DataFrame, zone: str = ZONE) -> DataFrame:
    """Mean flow and speed by local hour of day."""
    return _profile(df, local_hour(UTC, zone), "hour")


def weekly_profile(df: DataFrame, zone: str = ZONE) -> DataFrame:
    """Mean flow and speed by local weekday, Monday = 0."""
    return _profile(df, local_weekday(UTC, zone), "weekday")


def quality_histogram(df: DataFrame, width: float = 5.0) -> DataFrame:
    """Rows per completeness bin; the NULL bin holds rows without a completeness."""
    start = F.floor(F.col(QUALITY) / width) * width
    return df.groupBy(start.cast("double").alias("quality_from")).agg(F.count(F.lit(1)).alias("n"))


def sibling_detectors(ids: DataFrame) -> DataFrame:
    """(site_id, det_a, det_b): every two detectors of a site, the smaller id first."""
    own = materialize(ids.select(DET).distinct().withColumn("site_id", site_id()), "sited")
    a = own.select("site_id", F.col(DET).alias("det_a"))
    b = own.select("site_id", F.col(DET).alias("det_b"))
    return salted_join(a, b, ["site_id"]).filter(F.col("det_a") < F.col("det_b")).select("site_id", "det_a", "det_b")


def sibling_pairs(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Readings of every two siblings side by side, one row per pair and common hour. Reads `df` three times: store it."""
    cols = cols or ["qkfz", "vkfz"]
    pairs = sibling_detectors(df)
    a = df.select(F.col(DET).alias("det_a"), UTC, *[F.col(c).alias(f"{c}_a") for c in cols])
    b = df.select(F.col(DET).alias("det_b"), UTC, *[F.col(c).alias(f"{c}_b") for c in cols])
    return a.join(pairs, "det_a").join(b, ["det_b", UTC]).select(
        "site_id", UTC, "det_a", "det_b", *[f"{c}_{s}" for c in cols for s in ("a", "b")]
    )


def sibling_correlation(pairs: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Pearson r per pair; NULL below three common values or without variation."""
    cols = cols or ["qkfz", "vkfz"]
    aggs = []
    for c in cols:
        a, b = F.col(f"{c}_a"), F.col(f"{c}_b")
        both = a.isNotNull() & b.isNotNull()
        x, y = F.when(both, a), F.when(both, b)
        enough = (F.count_if(both) >= 3) & (F.min(x) < F.max(x)) & (F.min(y) < F.max(y))
        # corr() itself divides by zero for a constant series in ANSI mode.
        r = F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
        aggs += [F.count_if(both).alias(f"n_{c}"), F.when(enough, r).alias(f"r_{c}")]
    return pairs.groupBy("det_a", "det_b").agg(*aggs)


def detectors_per_site(ids: DataFrame) -> DataFrame:
    """Detectors per site; the row with a NULL site holds the mean over sites."""
    per_site = ids.select(DET).distinct().groupBy(site_id().alias("site_id")).agg(
        F.count(F.lit(1)).cast("double").alias("detectors")
    )
    return per_site.rollup("site_id").agg(F.avg("detectors").alias("detectors"))


def sort_ids(ids: DataFrame, id_col: str = DET) -> DataFrame:
    """Distinct ids in byte order (a range-partitioned sort)."""
    return ids.select(id_col).distinct().orderBy(id_col)


def sort_time(df: DataFrame) -> DataFrame:
    """Rows clustered by detector and in time order inside each partition."""
    return df.repartition(DET).sortWithinPartitions(DET, UTC)


def head_rows(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)


def first_valid_row(df: DataFrame, col: str = "vkfz") -> DataFrame:
    """First row with a value of `col`, per detector."""
    return dedupe_first(df.filter(F.col(col).isNotNull()), [DET], [UTC])


def first_failures(failures: DataFrame, n: int = 5) -> DataFrame:
    """The first `n` failed detectors in id order, beside the number of all."""
    total = failures.agg(F.count(F.lit(1))).scalar()
    return failures.withColumn("failed_total", total).orderBy(DET).limit(n)
