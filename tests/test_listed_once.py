"""A build reads its list of detectors once, as the list may come from many files."""

from datetime import datetime

from roadpulse.columns import DET
from roadpulse.operators.axes import Axis
from roadpulse.plans import pipelines


def test_bundle_stores_its_detectors(spark, readings_of, monkeypatch, tmp_path):
    dets = ["TEU00001_Det0", "TEU00002_Det0"]
    source = str(tmp_path / "listed")
    spark.createDataFrame([(d,) for d in dets], f"{DET} string").write.parquet(source)
    seen = []
    for name, at in (("feature_cells", 1), ("write_bundle", 2)):
        real = getattr(pipelines, name)

        def spy(*args, _real=real, _at=at, **kw):
            seen.append(args[_at].inputFiles())
            return _real(*args, **kw)

        monkeypatch.setattr(pipelines, name, spy)
    axis = Axis(datetime(2023, 1, 2), datetime(2023, 1, 4))
    rows = [(d, h, float(h % 7), 100.0) for d in dets for h in range(48)]
    pipelines.build_bundle(spark, readings_of(rows), spark.read.parquet(source), axis, str(tmp_path / "bundle"))
    assert len(seen) == 2 and not any(source in f for files in seen for f in files)
