"""Global order without a single-task window.

Rows are first reduced to (group, value, weight). They are range-partitioned by (group, value) and written with the number
of their partition as bucket; the window then runs per bucket, and bucket totals shift the running sums. A value that
holds many rows is one row by then, so a hot value cannot fill a bucket, and buckets grow in number with the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.session import materialize

#: Rows meant for a bucket, hence for a task.
BUCKET_ROWS = 100_000


def running_totals(
    counted: DataFrame, value: str, sums: list[str], by: list[str] | None = None, buckets: int | None = None
) -> DataFrame:
    """Add `cum_<c>` for every c in `sums`: the inclusive running total in order of `value`.

    `counted` holds one row per (by, value) and is read three times, so hand in a stored table.
    """
    by = by or []
    buckets = buckets or -(-counted.count() // BUCKET_ROWS) or 1
    ranged = counted.repartitionByRange(buckets, *by, value).withColumn("_bucket", F.spark_partition_id())
    # Stored: the bucket is a plain column for what follows, and the same one in each pass.
    placed = materialize(ranged, "buckets")

    # One row per (group, bucket).
    totals = placed.groupBy(*by, "_bucket").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    before = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by, "_bucket", *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in sums]
    )

    within = (
        Window.partitionBy(*by, "_bucket")
        .orderBy(value)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summed = placed.select("*", *[F.sum(c).over(within).alias(f"_c_{c}") for c in sums])
    return summed.join(offsets, [*by, "_bucket"]).select(
        *counted.columns, *[(F.col(f"_c_{c}") + F.col(f"_o_{c}")).alias(f"cum_{c}") for c in sums]
    )


def global_rank(distinct_values: DataFrame, value: str, buckets: int | None = None) -> DataFrame:
    """Add `rank`, 1-based, to a frame of distinct values."""
    ones = distinct_values.withColumn("_one", F.lit(1).cast("long"))
    return (
        running_totals(ones, value, ["_one"], buckets=buckets)
        .withColumnRenamed("cum__one", "rank")
        .drop("_one")
    )


def unpivot(df: DataFrame, cols: list[str], keep: list[Column | str] | None = None) -> DataFrame:
    """(keep.., feature, value) with one row per column and row."""
    keep = keep or []
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in cols])
    )
    return df.select(*keep, pairs.alias("_p")).select(*keep, "_p.feature", "_p.value")


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float], buckets: int | None = None) -> DataFrame:
    """(feature, prob, value): linear interpolation between the two nearest ranks.

    Works on value counts in bucketed global order; no group is held by one task.
    """
    counted = (
        unpivot(df, cols)
        .filter(F.col("value").isNotNull())
        .groupBy("feature", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return quantiles_of_counts(materialize(counted, "counts"), probs, buckets)


def quantiles_of_counts(counted: DataFrame, probs: list[float], buckets: int | None = None) -> DataFrame:
    """Quantiles per feature of a (feature, value, n) frame, which is read several times."""
    ranked = running_totals(counted, "value", ["n"], by=["feature"], buckets=buckets)
    sizes = counted.groupBy("feature").agg(F.sum("n").alias("_size"))
    targets = sizes.select(
        "feature",
        F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob"),
        "_size",
    ).withColumn("_pos", F.col("prob") * (F.col("_size") - 1))
    # One row per feature, holding the wanted zero-based positions.
    wanted = targets.groupBy("feature").agg(F.collect_set("_pos").alias("_wanted"))
    first = F.col("cum_n") - F.col("n")
    hit = (
        ranked.join(wanted, "feature")
        .withColumn("_pos", F.explode("_wanted"))
        .filter(
            F.floor("_pos").between(first, F.col("cum_n") - 1)
            | F.ceil("_pos").between(first, F.col("cum_n") - 1)
        )
        .groupBy("feature", "_pos")
        .agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"))
    )
    return hit.join(targets, ["feature", "_pos"]).select(
        "feature",
        "prob",
        (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("_pos") - F.floor("_pos"))).alias("value"),
    )
