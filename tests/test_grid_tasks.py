"""The dense grid is made in tasks of a bounded number of hours."""

from datetime import datetime

from roadpulse.columns import DET
from roadpulse.operators import clean
from roadpulse.operators.axes import Axis

AXIS = Axis(datetime(2023, 1, 2), datetime(2023, 1, 4))


def test_grid_tasks_follow_the_grid(spark, readings_of, monkeypatch):
    """40 detectors with one reading each: few rows to shuffle, 1,920 hours to make."""
    dets = [f"TEU{i:05d}_Det0" for i in range(40)]
    readings = readings_of([(d, 5, 1.0, 100.0) for d in dets])
    nodes = spark.createDataFrame([(d,) for d in dets], f"{DET} string")

    def rows(df):
        return sorted(map(tuple, df.collect()), key=lambda r: r[:2])

    grids = (clean.clean_grid, clean.reindex_hourly)
    want = [rows(f(readings, nodes, AXIS)) for f in grids]
    monkeypatch.setattr(clean, "HOURS_PER_TASK", 150)
    for df, after in zip([f(readings, nodes, AXIS) for f in grids], want):
        assert rows(df) == after and len(after) == 40 * AXIS.hours
        held = [r["count"] for r in df.selectExpr("spark_partition_id() AS p").groupBy("p").count().collect()]
        assert len(held) > 6 and max(held) < len(after) / 2
