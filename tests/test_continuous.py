"""The refresh with state: files out of order, late and repeated rows, restarts, and statistics from moments."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadpulse.columns import READINGS_SCHEMA, TRAFFIC
from roadpulse.streaming import continuous, refresh

START = datetime(2023, 1, 1, 5)


def reading(det, day, value, quality=100.0):
    return (det, START + timedelta(days=day), quality, *([value] * len(TRAFFIC)))


class Feed:
    def __init__(self, spark, root, delay="3 days"):
        self.spark, self.delay = spark, delay
        self.folder, self.target, self.moments, self.progress = (f"{root}/{p}" for p in ("in", "rows", "moments", "progress"))

    def arrive(self, rows):
        self.spark.createDataFrame(rows, READINGS_SCHEMA).coalesce(1).write.mode("append").parquet(self.folder)

    def run(self):
        stream = refresh.reading_stream(self.spark, self.folder, 1)
        return continuous.continuous_refresh(stream, self.target, self.moments, self.progress, self.delay)

    def rows(self):
        found = refresh.read_target(self.spark, self.target).collect()
        got = {(r.det_id, (r.utc - START).days): r.vkfz for r in found}
        assert len(got) == len(found)
        return got


def test_repeated_late_and_unordered_rows_over_restarts(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.arrive([reading("A", d, float(d)) for d in range(5)])
    done = feed.run()
    assert (done.read, done.late) == (5, 0) and feed.rows() == {("A", d): float(d) for d in range(5)}
    # A new run, from the checkpoint: a repeated stamp loses, an older row within the delay is taken, a twin in the batch counts once.
    feed.arrive([reading("A", 4, 99.0), reading("B", 2, 2.5), *[reading("A", 5, 5.0)] * 2, (None, None, 1.0, *([1.0] * len(TRAFFIC)))])
    done = feed.run()
    assert done.late == 0 and feed.rows() == {**{("A", d): float(d) for d in range(6)}, ("B", 2): 2.5}
    # Far ahead; then a row from before the watermark, which is late, and one just within it.
    feed.arrive([reading("A", 30, 30.0)])
    feed.run()
    feed.arrive([reading("C", 10, 1.0), reading("C", 28, 28.0)])
    done = feed.run()
    assert done.late == 1
    assert feed.rows() == {**{("A", d): float(d) for d in range(6)}, ("B", 2): 2.5, ("A", 30): 30.0, ("C", 28): 28.0}
    # Only keys within the delay are still held.
    assert done.state <= 2
    again = feed.run()
    assert again.read == 0 and len(feed.rows()) == 9


def test_a_batch_run_again_replaces_itself(spark, tmp_path):
    target, moments = str(tmp_path / "rows"), str(tmp_path / "moments")
    batch = spark.createDataFrame([reading("A", d, float(d)) for d in range(4)], READINGS_SCHEMA)
    for _ in range(2):
        continuous.store_batch(batch, 7, target, moments)
    continuous.store_batch(batch.limit(0), 8, target, moments)
    assert refresh.read_target(spark, target).count() == 4
    assert refresh.read_target(spark, moments).agg(F.sum("n")).first()[0] == 4


@pytest.mark.parametrize("days", [1, 3, 6, 40])
def test_statistics_from_moments_equal_those_from_rows(spark, tmp_path, days):
    rng = np.random.default_rng(days)
    feed = Feed(spark, tmp_path, "40 days")
    rows = []
    for hour in rng.permutation(24 * 9):
        at = START + timedelta(hours=int(hour))
        # Values far from zero: sums of squares would lose the deviation.
        values = [None if rng.random() < 0.05 else 1e7 + float(v) for v in rng.normal(size=len(TRAFFIC))]
        rows.append(("A", at, None if rng.random() < 0.1 else float(rng.integers(85, 101)), *values))
    for part in range(3):
        feed.arrive(rows[part::3])
    feed.run()
    want = refresh.rolling_stats(refresh.read_target(spark, feed.target), days).first()
    got = continuous.rolling_stats(spark, feed.target, feed.moments, days).first()
    for c in TRAFFIC:
        assert got[f"{c}_mu"] == pytest.approx(want[f"{c}_mu"], rel=1e-14) and got[f"{c}_sigma"] == pytest.approx(want[f"{c}_sigma"], rel=1e-6)


def test_only_days_of_the_window_are_read(spark, tmp_path):
    feed = Feed(spark, tmp_path, "90 days")
    feed.arrive([reading("A", d, float(d)) for d in range(60)])
    feed.run()
    window = continuous.window_moments(spark, feed.target, feed.moments, 7)
    plan = window._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 2 and all("PartitionFilters: [isnotnull(day" in line for line in scans)
    row = continuous.merged(window).first()
    assert row.n == 7 and row.vkfz_mean == pytest.approx(56.0)


def test_statistics_need_rows(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    with pytest.raises(ValueError):
        continuous.rolling_stats(spark, feed.target, feed.moments)
    feed.arrive([reading("A", 0, 1.0), reading("B", 0, 2.0, quality=10.0)])
    feed.run()
    with pytest.raises(Exception, match="fewer than two"):
        continuous.rolling_stats(spark, feed.target, feed.moments).collect()
