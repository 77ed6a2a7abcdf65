"""Refresh that runs on: duplicates by watermarked state, and statistics of a rolling window from mergeable moments.

The stream's state holds the keys of the last `delay`, so the stored table is never read to find duplicates. A row whose stamp lies before the watermark (the newest stamp
of the batches before, less `delay`) comes too late and is not taken; `Refreshed` counts these. Each batch writes folders of its own, named by its number, so a
batch that is run again after a failure replaces what it wrote.

Besides the rows a batch writes, for each day it has touched, their number, means and sums of squared deviations. These
merge without loss (Chan, Golub and LeVeque 1979), so a window is summed up from a row a day and batch; only the first
day, which a window may cut, is read itself.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.columns import DET, QUALITY, SIGMA_EPS, TRAFFIC, UTC
from roadpulse.operators.clean import quality_filter, valid_mask
from roadpulse.streaming.refresh import DAY, read_target

#: Readings that come more than this behind the newest one are late.
DELAY = "14 days"
BATCH = "batch"


@dataclass(frozen=True)
class Refreshed:
    """What one run did: rows read and written, rows that came too late, keys held in state at its end."""

    read: int
    late: int
    state: int


def first_readings(stream: DataFrame, delay: str = DELAY) -> DataFrame:
    """Readings whose (det_id, utc) has not come within `delay` before; of two in one batch either may stay. Rows without a stamp go."""
    rows = stream.select(DET, UTC, QUALITY, *TRAFFIC).filter(F.col(UTC).isNotNull())
    # A watermark needs an instant; which zone the stamps are read in changes nothing but by the hour of a clock change.
    timed = rows.withColumn("_event_time", F.col(UTC).cast("timestamp")).withWatermark("_event_time", delay)
    return timed.dropDuplicatesWithinWatermark([DET, UTC]).drop("_event_time")


def day_moments(readings: DataFrame) -> DataFrame:
    """(day, n, last_utc, <c>_mean, <c>_m2) over complete rows that pass the quality filter; `last_utc` is over all rows."""
    judged = valid_mask(quality_filter(readings)).withColumn(DAY, F.to_date(UTC))
    used = {c: F.when(F.col("mask"), F.col(c)) for c in TRAFFIC}
    aggs = [a for c, v in used.items() for a in (F.avg(v).alias(f"{c}_mean"), (F.var_pop(v) * F.count(v)).alias(f"{c}_m2"))]
    return judged.groupBy(DAY).agg(F.count_if("mask").alias("n"), F.max(UTC).alias("last_utc"), *aggs)


def merged(moments: DataFrame) -> DataFrame:
    """One row (n, <c>_mean, <c>_m2) for all rows of moments. Means first, then deviations from them, so nothing cancels out."""
    n = F.sum("n")
    parts = moments.filter("n > 0")
    means = parts.agg(n.alias("n"), *[(F.sum(F.col("n") * F.col(f"{c}_mean")) / n).alias(f"{c}_mean") for c in TRAFFIC])
    centre = {c: means.select(f"{c}_mean").scalar() for c in TRAFFIC}
    away = {c: F.col("n") * F.pow(F.col(f"{c}_mean") - centre[c], 2) for c in TRAFFIC}
    return parts.agg(
        F.coalesce(n, F.lit(0)).alias("n"),
        *[a for c in TRAFFIC for a in (F.max(centre[c]).alias(f"{c}_mean"), F.sum(F.col(f"{c}_m2") + away[c]).alias(f"{c}_m2"))],
    )


def store_batch(batch: DataFrame, number: int, target: str, moments: str) -> None:
    """Rows and moments of one batch, each in a folder of its number that is replaced as a whole."""
    rows = batch.withColumn(DAY, F.to_date(UTC)).persist()
    try:
        if not rows.isEmpty():
            rows.hint("rebalance", DAY).write.mode("overwrite").partitionBy(DAY).parquet(f"{target}/{BATCH}={number}")
            day_moments(rows).coalesce(1).write.mode("overwrite").partitionBy(DAY).parquet(f"{moments}/{BATCH}={number}")
    finally:
        rows.unpersist()


def continuous_refresh(
    stream: DataFrame, target: str, moments: str, checkpoint: str, delay: str = DELAY, every: str | None = None, seconds: float | None = None
) -> Refreshed:
    """Take everything that has arrived and stop; with `every`, a trigger interval, run on, for `seconds` if given.

    The checkpoint holds the files taken, the keys seen and the watermark: the next run goes on from there.
    """
    writer = first_readings(stream, delay).writeStream.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    query = writer.foreachBatch(lambda batch, number: store_batch(batch, number, target, moments)).start()
    try:
        query.awaitTermination(seconds) if seconds else query.awaitTermination()
    finally:
        query.stop()
    steps = query.recentProgress
    states = [s["stateOperators"][0] for s in steps if s["stateOperators"]]
    return Refreshed(
        read=sum(s["numInputRows"] for s in steps),
        late=sum(s["numRowsDroppedByWatermark"] for s in states),
        state=states[-1]["numRowsTotal"] if states else 0,
    )


def window_moments(spark: SparkSession, target: str, moments: str, days: int) -> DataFrame:
    """Moments of the last `days` days up to the newest stamp: those of whole days, and those of the rows of the day that the window cuts."""
    stored = read_target(spark, moments)
    if stored is None:
        raise ValueError("no readings yet")
    newest = stored.agg(F.max("last_utc")).first()[0]
    start = F.timestamp_add("DAY", F.lit(-days), F.lit(newest).cast("timestamp_ntz"))
    first_day = spark.range(1).select(F.to_date(start)).first()[0]
    # Both are partition columns: other days are not read.
    whole = stored.filter(F.col(DAY) > F.lit(first_day))
    cut = read_target(spark, target).filter((F.col(DAY) == F.lit(first_day)) & (F.col(UTC) > start))
    return whole.drop(BATCH).unionByName(day_moments(cut.drop(DAY, BATCH)))


def rolling_stats(spark: SparkSession, target: str, moments: str, days: int = 28, eps: float = SIGMA_EPS) -> DataFrame:
    """One wide row `<c>_mu`, `<c>_sigma`, as `refresh.rolling_stats` gives from the rows; fewer than two complete rows are an error."""
    row = merged(window_moments(spark, target, moments, days))
    fail = F.raise_error(F.lit("fewer than two valid training cells")).cast("double")
    sigma = {c: F.greatest(F.sqrt(F.col(f"{c}_m2") / (F.col("n") - 1)), F.lit(eps)) for c in TRAFFIC}
    return row.select(
        *[a for c in TRAFFIC for a in (F.col(f"{c}_mean").alias(f"{c}_mu"), F.when(F.col("n") >= 2, sigma[c]).otherwise(fail).alias(f"{c}_sigma"))]
    )
