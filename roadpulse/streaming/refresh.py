"""Appending fresh readings to a stored table, and statistics of a rolling window."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.columns import DET, QUALITY, READINGS_SCHEMA, TRAFFIC, UTC
from roadpulse.operators.clean import dedupe_first, quality_filter, valid_mask
from roadpulse.operators.normalize import normalization_stats

DAY = "day"


def read_target(spark: SparkSession, target: str) -> DataFrame | None:
    try:
        return spark.read.parquet(target)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def append_new(batch: DataFrame, target: str) -> None:
    """Append the rows of a batch whose (det_id, utc) the target lacks.

    Stored rows win over later ones, so a batch that is run again after a failure adds
    nothing twice. Only the day partitions between the batch's first and last day are read.
    """
    spark = batch.sparkSession
    rows = batch.select(DET, UTC, QUALITY, *TRAFFIC).filter(F.col(UTC).isNotNull())
    fresh = dedupe_first(rows, [DET, UTC], [QUALITY, *TRAFFIC]).withColumn(DAY, F.to_date(UTC))
    span = rows.agg(F.to_date(F.min(UTC)).alias("lo"), F.to_date(F.max(UTC)).alias("hi")).first()
    if span.lo is None:
        return
    stored = read_target(spark, target)
    if stored is not None:
        touched = stored.filter(F.col(DAY).between(F.lit(span.lo), F.lit(span.hi))).select(DET, UTC)
        fresh = fresh.join(touched, [DET, UTC], "left_anti")
    fresh.hint("rebalance", DAY).write.mode("append").partitionBy(DAY).parquet(target)


def reading_stream(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files of readings as they arrive in a folder."""
    reader = spark.readStream.schema(READINGS_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def incremental_refresh(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Bring the target up to date with everything that has arrived, then stop.

    The checkpoint remembers the files already taken, so the next run starts where this one ended.
    """
    query = (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(lambda batch, _: append_new(batch, target))
        .start()
    )
    query.awaitTermination()


def rolling_stats(readings: DataFrame, days: int = 28) -> DataFrame:
    """One wide row of mean and deviation over complete rows of the last `days` days that pass the quality filter."""
    newest = readings.agg(F.max(UTC)).scalar()
    recent = readings.filter(F.col(UTC) > F.timestamp_add("DAY", F.lit(-days), newest))
    if DAY in readings.columns:  # lets the scan skip the older partitions
        recent = recent.filter(F.col(DAY) >= F.date_sub(F.to_date(newest), days))
    return normalization_stats(valid_mask(quality_filter(recent)), train="true")
