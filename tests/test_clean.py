from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roadpulse.columns import DET, QUALITY, TRAFFIC, UTC
from roadpulse.operators import axes, clean
from roadpulse.operators.axes import Axis
from roadpulse.plans.pipelines import feature_cells

DAY = Axis(datetime(2023, 1, 2), datetime(2023, 1, 3))
GAPS = [1.0, None, None, None, None, None, 7.0, None]


def test_axis_lengths(spark):
    assert axes.time_axis(spark, Axis.year(2023)).count() == 8760
    assert axes.time_axis(spark, Axis.year(2024)).count() == 8784
    row = axes.time_axis(spark, Axis.year(2023)).orderBy(F.desc("t_idx")).first()
    assert (row.t_idx, row.utc) == (8759, datetime(2023, 12, 31, 23))
    with pytest.raises(ValueError):
        Axis(datetime(2023, 1, 2), datetime(2023, 1, 1))


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
def test_axis_does_not_depend_on_the_session_zone(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        axis = Axis.year(2023)
        df = axis.select_on_axis(axes.time_axis(spark, axis).withColumnRenamed("t_idx", "want"))
        assert df.filter("want <> t_idx").count() == 0
        assert df.count() == 8760
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_ffill_limit(series, values):
    out = clean.ffill_limit(series(GAPS), ["vkfz"])
    assert values(out, "vkfz") == [1, 1, 1, 1, None, None, 7, 7]


def test_ffill_short_gaps_only(series, values):
    out = clean.ffill_short_gaps_only(series(GAPS), ["vkfz"])
    assert values(out, "vkfz") == [1, None, None, None, None, None, 7, 7]
    out = clean.ffill_short_gaps_only(series([None, 2.0, None, None, None, 3.0, None, None, None, None]), ["vkfz"])
    assert values(out, "vkfz") == [None, 2, 2, 2, 2, 3, None, None, None, None]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(0, 9).map(float)), min_size=1, max_size=40))
def test_ffill_limit_is_pandas_ffill(series, values, data):
    want = pd.Series(data, dtype="float64").ffill(limit=3)
    got = values(clean.ffill_limit(series(data), ["qkfz"]), "qkfz")
    assert [None if np.isnan(x) else x for x in want] == got


def test_quality_filter_is_strict_and_keeps_null(series, values):
    df = series([5.0, 5.0, 5.0], quality=[89.9, 90.0, None])
    assert values(clean.quality_filter(df), "qlkw") == [None, 5, 5]


def test_mask_needs_every_feature(spark, series, values):
    df = series([1.0, 2.0]).withColumn("vlkw", F.when(F.col("t_idx") == 1, F.col("vlkw")))
    assert values(clean.valid_mask(df), "mask") == [False, True]


def test_dedupe_keeps_the_earliest_month(spark):
    df = spark.createDataFrame(
        [("a", 1, "02", 0, 9.0), ("a", 1, "01", 5, 1.0), ("a", 1, "01", 7, 2.0)],
        "det_id string, utc int, month string, row_order long, v double",
    )
    assert [r.v for r in clean.dedupe_first(df, ["det_id", "utc"], ["month", "row_order"]).collect()] == [1.0]


def test_dedupe_limits_rows_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS v")
    plan = clean.dedupe_first(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_reindex_places_every_hour_once(spark, readings_of):
    df = readings_of(
        [
            ("A", 3, 1.0, 95.0),
            ("A", 5, 2.0, 95.0),
            ("A", datetime(2023, 1, 2, 10, 30), 9.0, 95.0),  # off the axis
            ("A", 30, 9.0, 95.0),  # after its end
            ("Z", 1, 9.0, 95.0),  # not listed
        ]
    )
    nodes = spark.createDataFrame([("A",), ("B",)], "det_id string")
    out = clean.reindex_hourly(df, nodes, DAY)
    assert out.count() == 48 and out.select(DET, "t_idx").distinct().count() == 48
    kept = {(r.det_id, r.t_idx): r.vkfz for r in out.filter("vkfz IS NOT NULL").collect()}
    assert kept == {("A", 3): 1.0, ("A", 5): 2.0}
    at = out.filter("det_id = 'A' AND t_idx = 3").first()
    assert at.utc == datetime(2023, 1, 2, 3)


def test_reindex_first_and_last_hour(spark, readings_of):
    nodes = spark.createDataFrame([("A",)], "det_id string")
    out = clean.reindex_hourly(readings_of([("A", 0, 1.0, 95.0), ("A", 23, 2.0, 95.0)]), nodes, DAY)
    assert out.count() == 24
    assert [r.vkfz for r in out.filter("t_idx IN (0, 23)").orderBy("t_idx").collect()] == [1.0, 2.0]


def test_single_pass_equals_the_separate_steps(spark):
    rng = np.random.default_rng(3)
    rows = []
    for det in ("A", "B", "C"):
        for t in range(24):
            if rng.random() < 0.6:
                values = [None if rng.random() < 0.3 else float(rng.integers(1, 90)) for _ in TRAFFIC]
                quality = [80.0, 90.0, 100.0, None][rng.integers(0, 4)]
                rows.append((det, datetime(2023, 1, 2, t), quality, *values))
    from roadpulse.columns import READINGS_SCHEMA

    df = spark.createDataFrame(rows, READINGS_SCHEMA)
    nodes = spark.createDataFrame([("A",), ("B",), ("C",), ("D",)], "det_id string")
    one = clean.clean_grid(df, nodes, DAY)
    steps = clean.clean_detectors(clean.reindex_hourly(df, nodes, DAY))
    cols = [DET, "t_idx", UTC, QUALITY, *TRAFFIC, "mask"]
    assert one.select(cols).exceptAll(steps.select(cols)).count() == 0
    assert one.count() == steps.count() == 96


def test_chain_shuffles_once_on_the_detector(spark, readings_of):
    nodes = spark.createDataFrame([("A",)], "det_id string")
    out = feature_cells(readings_of([("A", 1, 1.0, 95.0)]), nodes, DAY, unique=True)
    plan = out._jdf.queryExecution().executedPlan().toString()
    shuffles = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
    assert len(shuffles) == 1 and "det_id" in shuffles[0]
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_failed_detector_is_zero_and_invalid(spark, readings_of):
    nodes = spark.createDataFrame([("A", False), ("B", True), ("C", False)], "det_id string, failed boolean")
    out = feature_cells(readings_of([("A", 1, 4.0, 95.0)]), nodes, DAY)
    b = out.filter("det_id = 'B'")
    assert b.count() == 24
    assert b.filter("mask OR vkfz <> 0 OR cos_hod <> 0 OR sin_dow <> 0").count() == 0
    # Present but empty: traffic 0, real time features.
    c = out.filter("det_id = 'C' AND t_idx = 0").first()
    assert c.vkfz == 0.0 and c.cos_hod != 0.0 and not c.mask


def test_site_aggregate(spark):
    rows = [
        ("TEU00001_Det0", 1, 10.0, 50.0),
        ("TEU00001_Det1", 1, 30.0, 70.0),
        ("TEU00002_Det0", 1, 0.0, 50.0),
        ("TEU00002_Det1", 1, 0.0, 70.0),
    ]
    df = spark.createDataFrame(rows, "det_id string, utc int, q double, v double").selectExpr(
        "det_id", "utc", "q AS qkfz", "q AS qpkw", "q AS qlkw", "v AS vkfz", "v AS vpkw", "v AS vlkw"
    )
    out = {r.site_id: (r.qkfz, r.vkfz) for r in clean.site_aggregate(df).collect()}
    assert out == {"TEU00001": (40.0, 65.0), "TEU00002": (0.0, 60.0)}


def test_min_coverage(spark):
    df = spark.createDataFrame([("A", True), ("A", False), ("B", True)], "det_id string, mask boolean")
    assert {r.det_id for r in clean.min_coverage_nodes(df, 0.7).collect()} == {"B"}


def test_empty_intersection_is_an_error(spark):
    a = spark.createDataFrame([("A",)], "det_id string")
    b = spark.createDataFrame([("B",)], "det_id string")
    with pytest.raises(Exception, match="no detector"):
        axes.require_rows(axes.valid_detectors(a, b), "no detector").collect()
    assert axes.require_rows(axes.valid_detectors(a, a), "no detector").count() == 1


def test_split_bounds():
    want = {10: (7, 8), 30: (21, 26), 720: (504, 612), 8760: (6132, 7446), 8784: (6149, 7466)}
    assert {t: axes.split_bounds(t) for t in want} == want
    with pytest.raises(ValueError):
        axes.split_bounds(2)


def test_split_partitions_the_axis(spark):
    df = axes.split_ratio(axes.time_axis(spark, DAY), 24)
    got = {r.split: (r.lo, r.hi, r.n) for r in df.groupBy("split").agg(
        F.min("t_idx").alias("lo"), F.max("t_idx").alias("hi"), F.count("*").alias("n")).collect()}
    assert got == {"train": (0, 16, 17), "val": (17, 19, 3), "test": (20, 23, 4)}


def test_split_calendar(spark):
    axis = Axis.year(2023)
    df = axes.split_calendar(axes.time_axis(spark, axis), datetime(2023, 9, 1), datetime(2023, 10, 16))
    got = {r.split: r["count"] for r in df.groupBy("split").count().collect()}
    assert got == {"train": 243 * 24, "val": 45 * 24, "test": 77 * 24}


def test_modern_ids(spark):
    df = spark.createDataFrame([("TEU00002_Det0",), ("teuscalaS00000DD1D1",), ("TEU1_Det2x",)], "det_id string")
    assert [r.det_id for r in axes.modern_ids(df).collect()] == ["TEU00002_Det0"]
