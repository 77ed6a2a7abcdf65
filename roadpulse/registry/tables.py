"""Queries on cleaning, features, normalisation and axes."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from roadpulse import fixtures as fx
from roadpulse.columns import CYCLIC, DET, FEATURES, QUALITY, TRAFFIC, UTC
from roadpulse.operators import axes, clean, features, normalize
from roadpulse.plans.pipelines import feature_cells, normalized_cells
from roadpulse.registry.base import query, rounded
from roadpulse.registry.views import CYC, T6, each, how, r, rs, sql
from roadpulse.session import materialize

T6S = ", ".join(T6)
KEY = "det_id, t_idx, utc"


def grid(spark, d):
    return clean.reindex_hourly(fx.readings(spark, d), fx.data_ids(spark, d), fx.AXIS)


def cleaned(spark, d):
    return clean.clean_grid(fx.readings(spark, d), fx.data_ids(spark, d), fx.AXIS)


def cells(spark, d):
    return feature_cells(fx.readings(spark, d), fx.data_ids(spark, d), fx.AXIS, unique=True)


def labelled(spark, d):
    return axes.split_ratio(cells(spark, d), fx.AXIS.hours)


def norm(spark, d):
    return normalized_cells(materialize(cells(spark, d), "cells"), fx.AXIS)


# --- projections, filters, predicates ---------------------------------------


@query("project_keep_cols", sql("readings", f"SELECT det_id, utc, {rs(['quality', *T6])} FROM readings"))
def _(spark, d):
    return rounded(clean.project_keep_cols(fx.readings(spark, d)))


@query(
    "modern_id_filter",
    sql("file_names", r"SELECT det_id, count(*) AS files FROM file_names WHERE regexp_matches(det_id, '^TEU\d+_Det\d+$') GROUP BY 1"),
)
def _(spark, d):
    return axes.modern_ids(fx.file_names(spark, d)).groupBy(DET).agg(F.count(F.lit(1)).alias("files"))


@query("quality_filter", sql("nulled", f"SELECT {KEY}, {rs(T6)} FROM nulled"))
def _(spark, d):
    return rounded(clean.quality_filter(grid(spark, d)).drop(QUALITY))


@query("valid_mask", sql("cleaned", f"SELECT {KEY}, mask FROM cleaned"))
def _(spark, d):
    return cleaned(spark, d).select(DET, "t_idx", UTC, "mask")


@query(
    "cyclic_features",
    sql("cells", f"SELECT {KEY}, {rs(CYC)} FROM cells"),
)
def _(spark, d):
    return rounded(features.cyclic_features(grid(spark, d)).select(DET, "t_idx", UTC, *CYCLIC))


@query("hour_of_week", sql("readings", f"SELECT det_id, utc, {how()} AS how FROM readings"))
def _(spark, d):
    return features.with_hour_of_week(fx.readings(spark, d)).select(DET, UTC, "how")


@query("split_ratio", sql("labelled", f"SELECT {KEY}, split FROM labelled"))
def _(spark, d):
    return axes.split_ratio(grid(spark, d), fx.AXIS.hours).select(DET, "t_idx", UTC, "split")


@query(
    "split_calendar",
    sql(
        "readings",
        """SELECT det_id, utc, CASE WHEN utc < TIMESTAMP '2024-01-21' THEN 'train'
           WHEN utc < TIMESTAMP '2024-01-26' THEN 'val' ELSE 'test' END AS split FROM readings""",
    ),
)
def _(spark, d):
    split = axes.split_calendar(fx.readings(spark, d), datetime(2024, 1, 21), datetime(2024, 1, 26))
    return split.select(DET, UTC, "split")


NORM_SQL = sql("norm", f"SELECT {KEY}, {rs(T6 + CYC)}, mask, split FROM norm")


@query("apply_normalization", NORM_SQL)
def _(spark, d):
    return rounded(norm(spark, d)[0])


@query("denormalize", sql("labelled", f"SELECT {KEY}, {rs(T6)}, mask, split FROM labelled"))
def _(spark, d):
    scaled, stats = norm(spark, d)
    return rounded(normalize.denormalize(scaled, stats).drop(*CYCLIC))


@query(
    "apply_stats_to_new_data",
    sql(
        ("readings", "stats"),
        f"SELECT det_id, utc, {each(r('(x.{c} - s.{c}_mu) / s.{c}_sigma') + ' AS {c}')} FROM readings x CROSS JOIN stats s",
    ),
)
def _(spark, d):
    stats = norm(spark, d)[1]
    scaled = normalize.apply_normalization(fx.readings(spark, d), stats)
    return rounded(scaled.drop(QUALITY))


@query("feature_subset", sql("cells", f"SELECT {KEY}, {rs(T6[:3] + CYC)}, mask FROM cells"))
def _(spark, d):
    return rounded(features.feature_subset(cells(spark, d), "flow"))


@query(
    "historical_slice",
    sql(
        "readings",
        f"""SELECT det_id, utc, {rs(['quality', *T6])} FROM readings
        WHERE det_id IN ('TEU00000_Det0', 'TEU00002_Det1')
        AND utc >= TIMESTAMP '2024-01-05' AND utc < TIMESTAMP '2024-01-12'""",
    ),
)
def _(spark, d):
    from roadpulse.operators.forecast import historical_slice

    ids = ["TEU00000_Det0", "TEU00002_Det1"]
    return rounded(
        historical_slice(fx.readings(spark, d), ids, datetime(2024, 1, 5), datetime(2024, 1, 12))
    )


@query(
    "cast_float32",
    sql("cells", f"SELECT {KEY}, {each(r('CAST(CAST({c} AS FLOAT) AS DOUBLE)', 3) + ' AS {c}', T6 + CYC)}, mask FROM cells"),
)
def _(spark, d):
    stored = features.cast_float32(cells(spark, d))
    wide = stored.withColumns({c: F.col(c).cast("double") for c in FEATURES})
    return rounded(wide, *FEATURES, digits=3)


DIRECTIONS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query(
    "direction_lane_features",
    sql(
        ("data_ids", "locations"),
        "SELECT n.det_id, lane, "
        + ", ".join(f"CAST(direction = '{s}' AS INTEGER) AS dir_{s.lower()}" for s in DIRECTIONS)
        + " FROM data_ids n LEFT JOIN locations l ON l.det_id = n.det_id",
    ),
)
def _(spark, d):
    return features.direction_lane_features(fx.data_ids(spark, d), fx.locations(spark, d), DIRECTIONS)


# --- axes and sets -----------------------------------------------------------


@query(
    "time_axis",
    sql(
        ("axis", "readings"),
        "SELECT t_idx, a.utc, count(r.det_id) AS detectors FROM axis a LEFT JOIN readings r ON r.utc = a.utc GROUP BY 1, 2",
    ),
)
def _(spark, d):
    """The axis with the number of detectors reporting in each hour."""
    reporting = fx.readings(spark, d).groupBy(UTC).agg(F.count(F.lit(1)).alias("detectors"))
    return (
        axes.time_axis(spark, fx.AXIS)
        .join(reporting, UTC, "left")
        .select("t_idx", UTC, F.coalesce("detectors", F.lit(0)).alias("detectors"))
    )


@query(
    "valid_detectors",
    sql(("data_ids", "surveyed_locations"), "SELECT det_id FROM data_ids INTERSECT SELECT det_id FROM surveyed_locations"),
)
def _(spark, d):
    found = axes.valid_detectors(fx.data_ids(spark, d), fx.surveyed_locations(spark, d))
    return axes.require_rows(found, "no detector has both data and a location")


@query(
    "detectors_without_location",
    sql(("data_ids", "surveyed_locations"), "SELECT det_id FROM data_ids EXCEPT SELECT det_id FROM surveyed_locations"),
)
def _(spark, d):
    return axes.detectors_without_location(fx.data_ids(spark, d), fx.surveyed_locations(spark, d))


@query(
    "locations_without_data",
    sql(("data_ids", "surveyed_locations"), "SELECT det_id FROM surveyed_locations EXCEPT SELECT det_id FROM data_ids"),
)
def _(spark, d):
    return axes.locations_without_data(fx.data_ids(spark, d), fx.surveyed_locations(spark, d))


@query("union_months", sql("readings", f"SELECT det_id, utc, {rs(T6)} FROM readings"))
def _(spark, d):
    """The month as three parts, put together again."""
    df = fx.readings(spark, d).drop(QUALITY)
    day = F.dayofmonth(UTC)
    parts = [df.filter(day <= 10), df.filter((day > 10) & (day <= 20)), df.filter(day > 20)]
    return rounded(axes.union_months(*parts))


@query(
    "node_index",
    sql("locations", "SELECT CAST(row_number() OVER (ORDER BY det_id) - 1 AS INTEGER) AS n_idx, det_id FROM locations"),
)
def _(spark, d):
    return axes.node_index(fx.locations(spark, d))


# --- joins on the grid ---------------------------------------------------------


@query("reindex_hourly", sql("grid", f"SELECT {KEY}, {rs(['quality', *T6])} FROM grid"))
def _(spark, d):
    return rounded(grid(spark, d))


@query(
    "filter_locations_with_data",
    sql(("locations", "data_ids"), f"SELECT det_id, {rs(['lon', 'lat'])}, direction, lane, surveyed FROM locations WHERE det_id IN (SELECT det_id FROM data_ids)"),
)
def _(spark, d):
    return rounded(axes.filter_locations_with_data(fx.locations(spark, d), fx.data_ids(spark, d)))


@query(
    "holiday_feature",
    sql(
        ("readings", "holidays"),
        """SELECT det_id, utc, h.d IS NOT NULL AS is_holiday, coalesce(h.p, false) AS is_public_holiday,
             coalesce(h.s, false) AS is_school_holiday
           FROM readings LEFT JOIN (SELECT d, bool_or(kind = 'public') AS p, bool_or(kind = 'school') AS s FROM holidays GROUP BY d) h
           ON h.d = CAST(timezone('Europe/Berlin', timezone('UTC', utc)) AS DATE)""",
    ),
)
def _(spark, d):
    return features.holiday_feature(fx.readings(spark, d).select(DET, UTC), fx.holidays(spark, d))


@query(
    "seasonal_lookup",
    sql(
        ("cleaned", "seasonal"),
        f"SELECT c.det_id, c.t_idx, s.how, {each(r('s.{c}') + ' AS {c}_seasonal')} FROM cleaned c JOIN seasonal s ON s.det_id = c.det_id AND s.how = {how('c.utc')}",
    ),
)
def _(spark, d):
    looked = features.seasonal_lookup(cleaned(spark, d))
    return rounded(looked.select(DET, "t_idx", "how", *[f"{c}_seasonal" for c in TRAFFIC]))


# --- aggregations of the chain ----------------------------------------------


@query("seasonal_mean", sql("seasonal", f"SELECT det_id, how, {rs(T6)} FROM seasonal"))
def _(spark, d):
    return rounded(features.seasonal_mean(cleaned(spark, d)))


@query("impute_seasonal", sql("imputed", f"SELECT {KEY}, mask, {rs(T6)} FROM imputed"))
def _(spark, d):
    return rounded(features.impute_seasonal(cleaned(spark, d)).drop(QUALITY))


STATS_LONG = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {r(c + '_mu')} AS mu, {r(c + '_sigma')} AS sigma FROM stats" for c in T6
)


@query("normalization_stats", sql("stats", STATS_LONG))
def _(spark, d):
    return rounded(normalize.stats_long(norm(spark, d)[1]))


@query(
    "normalization_stats_per_node",
    sql(
        "labelled",
        "SELECT det_id, "
        + each(r("avg({c})") + " AS {c}_mu, " + r("greatest(stddev_samp({c}), 1e-6)") + " AS {c}_sigma")
        + " FROM labelled WHERE split = 'train' AND mask GROUP BY 1",
    ),
)
def _(spark, d):
    return rounded(normalize.normalization_stats(labelled(spark, d), by=DET))


@query(
    "coverage_report",
    sql(
        ("grid", "cleaned"),
        """SELECT det_id, count(*) AS n_rows, count(*) FILTER (quality >= 90) AS raw_valid,
           count(*) FILTER (mask) AS mask_valid, count(*) FILTER (mask) - count(*) FILTER (quality >= 90) AS recovered
           FROM cleaned GROUP BY 1""",
    ),
)
def _(spark, d):
    return clean.coverage_report(cleaned(spark, d))


@query(
    "null_counts",
    sql("cleaned", " UNION ALL ".join(f"SELECT '{c}' AS feature, count(*) FILTER ({c} IS NULL) AS nulls FROM cleaned" for c in T6)),
)
def _(spark, d):
    return clean.null_counts(cleaned(spark, d))


@query(
    "valid_share_by_detector",
    sql("cleaned", f"SELECT det_id, {r('avg(CAST(mask AS INT)) * 100')} AS valid_pct FROM cleaned GROUP BY ROLLUP (det_id)"),
)
def _(spark, d):
    return rounded(clean.valid_share_by_detector(cleaned(spark, d)))


@query(
    "split_drift_stats",
    sql(
        "norm",
        " UNION ALL ".join(
            f"SELECT split, '{c}' AS feature, {r(f'avg({c})')} AS mean, {r(f'stddev_samp({c})')} AS std FROM norm WHERE mask GROUP BY split"
            for c in T6
        ),
    ),
)
def _(spark, d):
    return rounded(normalize.split_drift_stats(norm(spark, d)[0]))


@query(
    "min_coverage_nodes",
    sql(
        "cleaned",
        """SELECT det_id, count(*) AS hours, count(*) FILTER (mask) AS valid FROM cleaned
           GROUP BY 1 HAVING avg(CAST(mask AS INT)) >= 0.55""",
    ),
)
def _(spark, d):
    kept = clean.min_coverage_nodes(cleaned(spark, d), floor=0.55)
    return kept.groupBy(DET).agg(F.count(F.lit(1)).alias("hours"), F.count_if("mask").alias("valid"))


def _site_speed(q: str, v: str) -> str:
    both = f"FILTER ({q} IS NOT NULL AND {v} IS NOT NULL)"
    ratio = f"CASE WHEN sum({q}) {both} <> 0 THEN sum({q} * {v}) / sum({q}) {both} ELSE avg({v}) END"
    return f"{r(ratio)} AS {v}"


@query(
    "site_aggregate",
    sql(
        "readings",
        "SELECT regexp_extract(det_id, '^(TEU\\d+)_', 1) AS site_id, utc, "
        + each(r("sum({c})") + " AS {c}", T6[:3])
        + ", "
        + ", ".join(_site_speed(q, "v" + q[1:]) for q in T6[:3])
        + " FROM readings GROUP BY 1, 2",
    ),
)
def _(spark, d):
    return rounded(clean.site_aggregate(fx.readings(spark, d)))


# --- windows ---------------------------------------------------------------------


@query(
    "dedupe_first",
    sql(
        "raw_readings",
        f"""SELECT det_id, utc, event_id, event_type, {r('value')} AS value FROM raw_readings
        QUALIFY row_number() OVER (PARTITION BY det_id, utc ORDER BY ts, event_id) = 1""",
    ),
)
def _(spark, d):
    first = clean.dedupe_first(fx.raw_readings(spark, d), [DET, UTC], ["ts", "event_id"])
    return rounded(first.drop("ts"))


@query("ffill_limit", sql("filled", f"SELECT {KEY}, {rs(T6)} FROM filled"))
def _(spark, d):
    return rounded(clean.ffill_limit(clean.quality_filter(grid(spark, d))).drop(QUALITY))


_ISLANDS = each("count({c}) OVER (PARTITION BY det_id ORDER BY t_idx) AS g_{c}")
_SHORT = each(
    r(
        "CASE WHEN {c} IS NOT NULL THEN {c} "
        "WHEN g_{c} > 0 AND count(*) OVER (PARTITION BY det_id, g_{c}) - 1 <= 3 "
        "THEN max({c}) OVER (PARTITION BY det_id, g_{c}) END"
    )
    + " AS {c}"
)


@query(
    "ffill_short_gaps_only",
    sql("nulled", f"SELECT {KEY}, {_SHORT} FROM (SELECT *, {_ISLANDS} FROM nulled)"),
)
def _(spark, d):
    return rounded(clean.ffill_short_gaps_only(clean.quality_filter(grid(spark, d))).drop(QUALITY))


# --- composites ---------------------------------------------------------------------


CLEAN_SQL = sql("cleaned", f"SELECT {KEY}, {rs(T6)}, mask FROM cleaned")


@query("clean_detectors", CLEAN_SQL)
def _(spark, d):
    """The three steps one after the other on the grid."""
    return rounded(clean.clean_detectors(grid(spark, d)).drop(QUALITY))


@query("clean_grid", CLEAN_SQL)
def _(spark, d):
    """The same in the single pass the feature table uses."""
    return rounded(cleaned(spark, d).drop(QUALITY))


@query("engineer_features", sql("cells", f"SELECT {KEY}, mask, {rs(T6 + CYC)} FROM cells"))
def _(spark, d):
    return rounded(features.engineer_features(cleaned(spark, d)).drop(QUALITY))


@query(
    "feature_cells",
    sql(
        ("cells", "axis"),
        f"""SELECT {KEY}, {rs(T6 + CYC)}, mask FROM cells
        UNION ALL
        SELECT det_id, t_idx, utc, {each('0.0::DOUBLE AS {c}', T6 + CYC)}, false AS mask
        FROM (SELECT concat('TEU', lpad(CAST(n_nationkey AS VARCHAR), 5, '0'), '_Det1') AS det_id FROM nation) CROSS JOIN axis
        WHERE det_id NOT IN (SELECT det_id FROM cells)""",
    ),
)
def _(spark, d):
    """All detectors with data and one listed per nation; listed ones without data have failed."""
    ids = fx.data_ids(spark, d)
    failed = fx.listed_detectors(spark, d).join(ids, DET, "left_anti").withColumn("failed", F.lit(True))
    nodes = ids.withColumn("failed", F.lit(False)).unionByName(failed)
    return rounded(feature_cells(fx.readings(spark, d), nodes, fx.AXIS, unique=True))


@query("build_bundle", NORM_SQL)
def _(spark, d):
    return rounded(norm(spark, d)[0])
