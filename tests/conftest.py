import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from roadpulse.columns import DET, QUALITY, READINGS_SCHEMA, TRAFFIC, UTC  # noqa: E402
from roadpulse.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session(4, app="tests", memory="4g", spark__checkpoint__dir=shared)
    yield session
    session.stop()


@pytest.fixture
def series(spark):
    """Gap-free frame of one detector from a list of values (all six features alike)."""

    def make(values, det="TEU00001_Det0", quality=None):
        rows = [
            (det, t, 100.0 if quality is None else quality[t], *([v] * len(TRAFFIC)))
            for t, v in enumerate(values)
        ]
        cols = ", ".join(f"{c} double" for c in [QUALITY, *TRAFFIC])
        return spark.createDataFrame(rows, f"{DET} string, t_idx int, {cols}")

    return make


@pytest.fixture
def readings_of(spark):
    """Readings from (det, hour offset or stamp, value, quality)."""

    def make(rows, start=datetime(2023, 1, 2)):
        from datetime import timedelta

        full = []
        for det, at, value, quality in rows:
            stamp = at if isinstance(at, datetime) else start + timedelta(hours=at)
            full.append((det, stamp, quality, *([value] * len(TRAFFIC))))
        return spark.createDataFrame(full, READINGS_SCHEMA)

    return make


def column(df, name, order="t_idx"):
    return [r[0] for r in df.orderBy(order).select(name).collect()]


@pytest.fixture
def values():
    return column


@pytest.fixture
def stamps(spark):
    def make(*texts):
        return spark.createDataFrame([(t,) for t in texts], "s string").selectExpr(
            f"cast(s as timestamp_ntz) AS {UTC}"
        )

    return make
