"""Train-only masked z-scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.columns import SIGMA_EPS, TRAFFIC


def normalization_stats(
    df: DataFrame,
    cols: list[str] = TRAFFIC,
    by: str | None = None,
    eps: float = SIGMA_EPS,
    train: str = "split = 'train'",
) -> DataFrame:
    """One wide row `<c>_mu`, `<c>_sigma` over valid training cells (or one row per `by`).

    Sample standard deviation with a floor of `eps`. Without a group, fewer than two
    valid rows are an error; with one, such groups get the floor.
    """
    fit = df.filter(train).filter("mask")
    n = F.count(F.lit(1))
    aggs = []
    for c in cols:
        sigma = F.greatest(F.stddev_samp(c), F.lit(eps))
        if by is None:
            fail = F.raise_error(F.lit("fewer than two valid training cells")).cast("double")
            sigma = F.when(n >= 2, sigma).otherwise(fail)
        aggs += [F.avg(c).alias(f"{c}_mu"), sigma.alias(f"{c}_sigma")]
    return fit.agg(*aggs) if by is None else fit.groupBy(by).agg(*aggs)


def stats_long(stats: DataFrame, cols: list[str] = TRAFFIC) -> DataFrame:
    """(feature, mu, sigma) from the wide row."""
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature"), F.col(f"{c}_mu").alias("mu"), F.col(f"{c}_sigma").alias("sigma")
            )
            for c in cols
        ]
    )
    keys = [k for k in stats.columns if not k.endswith(("_mu", "_sigma"))]
    return stats.select(*keys, F.inline(rows))


def stats_wide(long_stats: DataFrame, cols: list[str] = TRAFFIC) -> DataFrame:
    """The wide row back from (feature, mu, sigma)."""
    aggs = []
    for c in cols:
        here = F.col("feature") == c
        aggs += [
            F.max(F.when(here, F.col("mu"))).alias(f"{c}_mu"),
            F.max(F.when(here, F.col("sigma"))).alias(f"{c}_sigma"),
        ]
    return long_stats.agg(*aggs)


def _with_stats(df: DataFrame, stats: DataFrame, cols: list[str], by: str | None, formula) -> DataFrame:
    if by is not None:
        joined = df.join(stats, by, "left")
        done = joined.withColumns(
            {c: formula(F.col(c), F.col(f"{c}_mu"), F.col(f"{c}_sigma")) for c in cols}
        )
        return done.select(*df.columns)
    # A scalar subquery: the one row of statistics becomes a constant of the stage.
    packed = stats.select(F.struct(*[F.col(c) for c in stats.columns])).scalar()
    done = df.withColumn("_stats", packed)
    s = F.col("_stats")
    return done.withColumns(
        {c: formula(F.col(c), s[f"{c}_mu"], s[f"{c}_sigma"]) for c in cols}
    ).drop("_stats")


def apply_normalization(
    df: DataFrame, stats: DataFrame, cols: list[str] = TRAFFIC, by: str | None = None
) -> DataFrame:
    """(x - mu) / sigma for every cell, masked or not; other columns pass through."""
    return _with_stats(df, stats, cols, by, lambda x, mu, sigma: (x - mu) / sigma)


def denormalize(
    df: DataFrame, stats: DataFrame, cols: list[str] = TRAFFIC, by: str | None = None
) -> DataFrame:
    return _with_stats(df, stats, cols, by, lambda x, mu, sigma: x * sigma + mu)


def split_drift_stats(df: DataFrame, cols: list[str] = TRAFFIC) -> DataFrame:
    """(split, feature, mean, std) of valid normalised cells."""
    wide = df.filter("mask").groupBy("split").agg(
        *[
            F.struct(F.lit(c).alias("feature"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std")).alias(c)
            for c in cols
        ]
    )
    return wide.select("split", F.inline(F.array(*cols)))
