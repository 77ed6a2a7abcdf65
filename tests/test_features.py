import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from roadpulse.columns import TRAFFIC
from roadpulse.functions.timefn import hour_floor, local_hour, minutes_between
from roadpulse.operators import features, normalize
from roadpulse.operators.axes import Axis, time_axis


def imputed(spark, rows, **kw):
    """rows of (how, value): stamps are put on the wanted hour of week in UTC."""
    data = [("A", i, h, v) for i, (h, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "det_id string, t_idx int, h int, vkfz double").withColumn(
        "utc", F.timestamp_add("HOUR", F.col("h") + F.lit(168) * F.col("t_idx"), F.lit("2023-01-02").cast("timestamp_ntz"))
    )
    out = features.impute_seasonal(df, ["vkfz"], zone="UTC", **kw)
    return [r.vkfz for r in out.orderBy("t_idx").collect()]


def test_impute_seasonal_goldens(spark):
    assert imputed(spark, [(1, 10.0), (2, 20.0), (3, None), (1, None), (1, 30.0)]) == [10, 20, 20, 20, 30]
    assert imputed(spark, [(1, 10.0), (1, None), (1, None), (2, 40.0), (3, None)]) == [10, 10, 10, 40, 17.5]
    assert imputed(spark, [(1, None), (2, None)]) == [0.0, 0.0]


def test_impute_can_leave_later_hours_out(spark):
    rows = [(1, 10.0), (1, None), (1, 50.0)]
    assert imputed(spark, rows)[1] == 30
    assert imputed(spark, rows, fit_on="train", train_end=2)[1] == 10
    with pytest.raises(ValueError):
        imputed(spark, rows, fit_on="test")


def test_cyclic_and_hour_of_week(stamps):
    row = features.cyclic_features(stamps("2023-01-01 00:00:00")).first()
    want = (math.sin(2 * math.pi / 24), math.cos(2 * math.pi / 24), math.sin(12 * math.pi / 7), math.cos(12 * math.pi / 7))
    assert (row.sin_hod, row.cos_hod, row.sin_dow, row.cos_dow) == pytest.approx(want)
    assert features.with_hour_of_week(stamps("2023-01-02 00:00:00")).first().how == 1


def test_cyclic_repeats_after_a_week(stamps):
    a, b = features.cyclic_features(stamps("2023-05-03 15:00:00", "2023-05-10 15:00:00")).collect()
    assert a[1:] == b[1:]


def test_zone_changes(stamps):
    df = stamps("2023-03-26 00:00:00", "2023-03-26 01:00:00", "2023-10-29 00:00:00", "2023-10-29 01:00:00")
    assert [r[0] for r in df.orderBy("utc").select(local_hour()).collect()] == [1, 3, 2, 2]


def test_local_hours_agree_with_pandas_for_a_year(spark):
    import pandas as pd

    axis = Axis.year(2023)
    got = features.with_hour_of_week(time_axis(spark, axis)).orderBy("t_idx").toPandas()
    local = pd.date_range("2023-01-01", periods=8760, freq="1h", tz="UTC").tz_convert("Europe/Berlin")
    assert (got["how"].to_numpy() == (local.dayofweek * 24 + local.hour).to_numpy()).all()


def test_calendar_gives_the_same_features(spark):
    axis = Axis(datetime(2023, 3, 25), datetime(2023, 3, 28))
    cells = time_axis(spark, axis).withColumn("det_id", F.lit("A")).withColumns(
        {c: F.when(F.col("t_idx") % 5 != 0, F.col("t_idx") * 1.0) for c in TRAFFIC}
    )
    a = features.engineer_features(cells)
    b = features.engineer_features(cells, hours=features.calendar(spark, axis))
    assert a.select(sorted(a.columns)).exceptAll(b.select(sorted(a.columns))).count() == 0


def test_time_helpers(stamps):
    row = stamps("2023-03-26 02:45:30").select(
        hour_floor("utc"), minutes_between(F.lit("2023-03-25 02:45:00").cast("timestamp_ntz"), "utc")
    ).first()
    assert row[0] == datetime(2023, 3, 26, 2) and row[1] == 1440.5


def masked(spark, rows):
    return spark.createDataFrame(rows, "det_id string, split string, mask boolean, v double")


def test_normalization_stats(spark):
    df = masked(
        spark,
        [("A", "train", True, 1.0), ("A", "train", True, 2.0), ("B", "train", True, 3.0),
         ("A", "train", False, 99.0), ("A", "test", True, 99.0)],
    )
    assert tuple(normalize.normalization_stats(df, ["v"]).first()) == (2.0, 1.0)
    constant = masked(spark, [("A", "train", True, 5.0)] * 2)
    assert tuple(normalize.normalization_stats(constant, ["v"]).first()) == (5.0, 1e-6)
    with pytest.raises(Exception, match="fewer than two"):
        normalize.normalization_stats(masked(spark, [("A", "train", False, 1.0)]), ["v"]).collect()


def test_per_node_stats(spark):
    df = masked(spark, [("A", "train", True, 1.0), ("A", "train", True, 3.0), ("B", "train", True, 7.0)])
    got = {r.det_id: (r.v_mu, r.v_sigma) for r in normalize.normalization_stats(df, ["v"], by="det_id").collect()}
    assert got["A"] == (2.0, pytest.approx(2**0.5)) and got["B"] == (7.0, 1e-6)


def test_denormalize_inverts(spark):
    df = masked(spark, [("A", "train", True, float(i)) for i in range(10)] + [("A", "val", False, 42.0)])
    for by in (None, "det_id"):
        stats = normalize.normalization_stats(df, ["v"], by=by)
        z = normalize.apply_normalization(df, stats, ["v"], by=by)
        train = z.filter("split = 'train'").agg(F.avg("v"), F.stddev_samp("v")).first()
        assert train[0] == pytest.approx(0, abs=1e-9) and train[1] == pytest.approx(1)
        back = normalize.denormalize(z, stats, ["v"], by=by)
        assert sorted(r.v for r in back.collect()) == pytest.approx(sorted(r.v for r in df.collect()))


def test_stats_round_trip_and_no_join(spark):
    df = masked(spark, [("A", "train", True, 1.0), ("A", "train", True, 3.0)])
    stats = normalize.normalization_stats(df, ["v"])
    wide = normalize.stats_wide(normalize.stats_long(stats, ["v"]), ["v"])
    assert tuple(wide.first()) == tuple(stats.first())
    plan = normalize.apply_normalization(df, stats, ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_holidays_add_no_rows(spark, stamps):
    days = spark.createDataFrame(
        [(date(2023, 10, 3), "public"), (date(2023, 10, 3), "school")], "d date, kind string"
    )
    out = features.holiday_feature(stamps("2023-10-02 21:00:00", "2023-10-02 22:00:00"), days).orderBy("utc").collect()
    assert [tuple(r)[1:] for r in out] == [(False, False, False), (True, True, True)]


def test_subset_and_directions(spark):
    row = {c: 1.0 for c in [*TRAFFIC, "sin_hod", "cos_hod", "sin_dow", "cos_dow"]}
    df = spark.createDataFrame([{"det_id": "A", **row}])
    assert features.feature_subset(df, "speed").columns == [
        "det_id", "vkfz", "vpkw", "vlkw", "sin_hod", "cos_hod", "sin_dow", "cos_dow"]
    places = spark.createDataFrame([("A", "Nord", "2")], "det_id string, direction string, lane string")
    got = features.direction_lane_features(df.select("det_id"), places, ["Nord", "Ost"]).first()
    assert (got.lane, got.dir_nord, got.dir_ost) == (2, 1, 0)
