import io
import json
import os
import tarfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from roadpulse.columns import CSV_HEADER, READINGS_SCHEMA, TRAFFIC
from roadpulse.operators.axes import Axis
from roadpulse.plans import pipelines
from roadpulse.session import checkpoint_root, materialize
from roadpulse.sources import bundle, readings
from roadpulse.streaming import refresh


def csv_text(rows, header=CSV_HEADER):
    lines = [";".join(header)]
    for row in rows:
        lines.append(";".join(str(row.get(c, "")) for c in header))
    return "\n".join(lines) + "\n"


def hour(stamp, value, quality=100):
    return {"utc": stamp, "Vollständigkeit": quality, **{c: value for c in TRAFFIC}, "hist_cor": "x"}


def put(root, month, det, rows, header=CSV_HEADER):
    folder = root / month
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{det}.csv").write_text(csv_text(rows, header), encoding="utf-8")


@pytest.fixture
def root(tmp_path):
    root = tmp_path / "csv"
    put(root, "01", "TEU00001_Det0", [hour("2023-01-31 22:00:00", 10), hour("2023-01-31 23:00:00", 11), hour("2023-02-01 00:00:00", 12)])
    put(root, "02", "TEU00001_Det0", [hour("2023-02-01 00:00:00", 99), hour("2023-02-01 01:00:00", "")])
    put(root, "01", "TEU00001_Det1", [hour("2023-01-31 23:00:00", "NaN", 80)])
    put(root, "01", "TEU00002_Det0", [hour("2023-01-31 23:00:00", "broken")])
    put(root, "01", "TEU00003_Det0", [])
    put(root, "01", "teuscalaS00000DD1D1", [hour("2023-01-31 23:00:00", 1)])
    return str(root)


def test_read_detector_csv(spark, root):
    df = readings.read_detector_csv(spark, root)
    got = {(r.det_id, r.utc, r.month): (r.quality, r.vkfz, r.bad) for r in df.collect()}
    assert len(got) == 8
    assert got[("TEU00001_Det0", datetime(2023, 1, 31, 22), "01")] == (100.0, 10.0, False)
    assert got[("TEU00001_Det0", datetime(2023, 2, 1, 1), "02")] == (100.0, None, False)
    assert got[("TEU00001_Det1", datetime(2023, 1, 31, 23), "01")] == (80.0, None, False)
    assert got[("TEU00002_Det0", datetime(2023, 1, 31, 23), "01")][2] is True
    plan = df.select("det_id", "vkfz")._jdf.queryExecution().executedPlan().toString()
    assert "hist_cor" not in plan.split("ReadSchema")[-1]


def test_columns_are_found_by_name(spark, tmp_path):
    other = list(reversed(CSV_HEADER))
    put(tmp_path / "csv", "03", "TEU00009_Det0", [hour("2023-03-01 00:00:00", 7)], other)
    row = readings.read_detector_csv(spark, str(tmp_path / "csv")).first()
    assert (row.utc, row.quality, row.qkfz, row.month) == (datetime(2023, 3, 1), 100.0, 7.0, "03")
    put(tmp_path / "bad", "03", "TEU00009_Det0", [], ["utc", "qkfz"])
    with pytest.raises(ValueError, match="columns missing"):
        readings.read_detector_csv(spark, str(tmp_path / "bad"))


def test_each_file_is_read_by_its_own_header(spark, root, tmp_path):
    folder = tmp_path / "csv"
    put(folder, "03", "TEU00004_Det0", [hour("2023-03-01 00:00:00", 7)], list(reversed(CSV_HEADER)))
    put(folder, "03", "TEU00005_Det0", [hour("2023-03-01 00:00:00", 8)], ["utc", "qkfz"])
    (folder / "03" / "TEU00006_Det0.csv").write_text("no;header\n1;2\n")
    raw = readings.read_detector_csv(spark, root)
    got = {(r.det_id, r.utc): (r.qkfz, r.bad) for r in raw.collect()}
    assert got[("TEU00004_Det0", datetime(2023, 3, 1))] == (7.0, False)
    assert got[("TEU00005_Det0", datetime(2023, 3, 1))] == (8.0, True)
    assert got[("TEU00001_Det0", datetime(2023, 1, 31, 22))] == (10.0, False)
    ids = readings.detectors_from_paths(spark, root)
    failed = {r.det_id for r in readings.failed_detectors(ids, ids, raw).filter("failed").collect()}
    assert failed == {"TEU00002_Det0", "TEU00005_Det0", "TEU00006_Det0"}


def test_stamps_with_and_without_offset(spark):
    df = spark.createDataFrame(
        [("2023-08-31 22:00",), ("2023-08-31 22:00:00+00:00",), ("2023-09-01T00:00:00+02:00",), ("",), ("soon",)], "s string"
    )
    want = datetime(2023, 8, 31, 22)
    assert [r[0] for r in df.select(readings.parse_utc(F.col("s"))).collect()] == [want, want, want, None, None]


def test_detectors_and_failures(spark, root):
    ids = readings.detectors_from_paths(spark, root)
    assert {r.det_id for r in ids.collect()} == {
        "TEU00001_Det0", "TEU00001_Det1", "TEU00002_Det0", "TEU00003_Det0", "teuscalaS00000DD1D1"}
    listed = spark.createDataFrame([("TEU00001_Det0",), ("TEU00002_Det0",), ("TEU00003_Det0",), ("TEU00008_Det0",)], "det_id string")
    found = readings.failed_detectors(listed, ids, readings.read_detector_csv(spark, root))
    assert {r.det_id: r.reason for r in found.filter("failed").collect()} == {
        "TEU00002_Det0": "unreadable row", "TEU00008_Det0": "no file"}


def test_files_to_bundle_and_back(spark, root, tmp_path):
    axis = Axis(datetime(2023, 1, 31, 20), datetime(2023, 2, 1, 16))
    raw = readings.read_detector_csv(spark, root)
    listed = spark.createDataFrame([("TEU00001_Det0",), ("TEU00002_Det0",), ("TEU00003_Det0",)], "det_id string")
    nodes = readings.failed_detectors(listed, readings.detectors_from_paths(spark, root), raw)
    path = str(tmp_path / "bundle")
    pipelines.build_bundle(spark, raw, nodes, axis, path)
    # Without its last table a later build does not exist for readers.
    spark.range(1).write.parquet(f"{path}/build=99999999/cells")
    tables = bundle.read_bundle(spark, path)
    assert {r.key: r.n_rows for r in bundle.bundle_schema_check(tables).collect()}["X"] == 60
    assert bundle.bundle_schema_check(tables).filter("not present").count() == 0
    lacking = bundle.bundle_schema_check({k: v for k, v in tables.items() if k != "norm_stats"}).filter("not present")
    assert {r.key for r in lacking.collect()} == {"mu", "sigma"}
    assert [(r.n_idx, r.det_id) for r in tables["nodes"].orderBy("n_idx").collect()] == [
        (0, "TEU00001_Det0"), (1, "TEU00002_Det0"), (2, "TEU00003_Det0")]
    cells = tables["cells"]
    assert cells.count() == 60 and dict(cells.dtypes)["vkfz"] == "float"
    meta = tables["bundle_meta"].first()
    assert (meta.format_version, meta.train_end, meta.val_end, len(meta.feature_names)) == (1, 14, 17, 10)
    stats = {r.feature: (r.mu, r.sigma) for r in tables["norm_stats"].collect()}
    mu, sigma = stats["vkfz"]
    first = cells.filter("det_id = 'TEU00001_Det0' AND t_idx = 4").first()
    assert first.vkfz * sigma + mu == pytest.approx(12.0, abs=1e-4)  # month 01 wins over 02
    failed = cells.filter("det_id = 'TEU00002_Det0'")
    assert failed.filter("mask").count() == 0
    assert failed.first().vkfz == pytest.approx(-mu / sigma, rel=1e-5)


def test_unknown_bundle_version(spark, tmp_path):
    spark.range(1).select(F.lit(2).alias("format_version")).write.parquet(f"{tmp_path}/build=1/bundle_meta")
    with pytest.raises(ValueError, match="format 2"):
        bundle.read_bundle(spark, str(tmp_path))


def test_archives(spark, tmp_path):
    folder = tmp_path / "tgz"
    folder.mkdir()

    def member(tar, name, text):
        info = tarfile.TarInfo(name)
        info.size = len(text.encode())
        tar.addfile(info, io.BytesIO(text.encode()))

    with tarfile.open(folder / "detektoren_2023_01.tgz", "w:gz") as tar:
        member(tar, "TEU00001_Det0.csv", csv_text([hour("2023-01-01 00:00:00", 5), hour("2023-01-01 01:00:00", "")]))
        member(tar, "../../sub/TEU00002_Det0.csv", csv_text([hour("2023-01-01 00:00:00", 6)], list(reversed(CSV_HEADER))))
        member(tar, "readme.txt", "no data")
    whole = (folder / "detektoren_2023_01.tgz").read_bytes()
    (folder / "detektoren_2023_02.tgz").write_bytes(whole[: len(whole) // 2])
    (folder / "detektoren_2023_03.tgz").write_bytes(b"not an archive")
    before = sorted(os.listdir(tmp_path))
    lines, errors = readings.unpack_archives(spark, f"{folder}/*.tgz")
    got = {(r.det_id, r.month, r.utc): r.vkfz for r in readings.parse_lines(lines).collect()}
    assert got == {
        ("TEU00001_Det0", "01", datetime(2023, 1, 1, 0)): 5.0,
        ("TEU00001_Det0", "01", datetime(2023, 1, 1, 1)): None,
        ("TEU00002_Det0", "01", datetime(2023, 1, 1, 0)): 6.0,
    }
    assert {os.path.basename(r.archive) for r in errors.collect()} == {"detektoren_2023_02.tgz", "detektoren_2023_03.tgz"}
    assert sorted(os.listdir(tmp_path)) == before
    landed, errors = readings.land_archives(spark, f"{folder}/*.tgz", str(tmp_path / "landed"))
    assert errors.count() == 2
    assert landed.filter("month = '01'").count() == 3


def test_archive_lines_from_chunks(spark, monkeypatch):
    text = csv_text([hour(f"2023-01-01 {h:02d}:00:00", h) for h in range(24)])
    quoted = text.replace(";", '";"').replace("\n", '"\r\n"')
    members = {"TEU1.csv": text, "TEU2.csv": '"' + quoted.removesuffix('"'), "TEU3.csv": text.split("\n")[0], "TEU4.csv": ""}
    blob = io.BytesIO()
    with tarfile.open(fileobj=blob, mode="w:gz") as tar:
        for name, content in members.items():
            info = tarfile.TarInfo(name)
            info.size = len(content.encode())
            tar.addfile(info, io.BytesIO(content.encode()))
    archives = spark.createDataFrame([("detektoren_2023_01.tgz", blob.getvalue())], "path string, content binary")
    found = []
    for size in (1, 70, 10**6):
        reader = readings._chunk_reader
        monkeypatch.setattr(readings, "_chunk_reader", lambda: reader(size))
        lines, errors = readings.unpack(archives)
        assert errors.count() == 0
        found.append(sorted((r.det_id, r.row_order, r.utc, r.vkfz) for r in readings.parse_lines(lines).collect()))
        monkeypatch.undo()
    assert found[0] == found[1] == found[2]
    want = [(h + 1, datetime(2023, 1, 1, h), float(h)) for h in range(24)]
    assert found[0] == [(det, *row) for det in ("TEU1", "TEU2") for row in want]


def test_locations_and_holidays(spark, tmp_path):
    feature = {
        "type": "Feature",
        "properties": {"teuID": "TEU00001_Det0", "RICHTUNG": "Nord", "spur": 2, "x": None},
        "geometry": {"type": "Point", "coordinates": [13.3777, 52.5163]},
    }
    path = tmp_path / "places.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": [feature, feature]}, indent=1))
    rows = readings.read_locations(spark, str(path), properties={"direction": "RICHTUNG", "lane": "spur"}).collect()
    assert [tuple(r) for r in rows] == [("TEU00001_Det0", 13.3777, 52.5163, "Nord", "2")] * 2
    days = tmp_path / "days.csv"
    days.write_text("d,kind\n2023-10-03,public\n")
    assert readings.read_holidays(spark, str(days)).first().kind == "public"


def test_graph_store(spark, tmp_path):
    locations = spark.createDataFrame(
        [("TEU00002_Det0", 13.1, 52.4), ("TEU00001_Det0", 13.1, 52.4), ("TEU00009_Det0", 13.1, 52.4)], "det_id string, lon double, lat double"
    )
    ids = spark.createDataFrame([("TEU00001_Det0",), ("TEU00002_Det0",)], "det_id string")
    parts = pipelines.build_graph(locations, ids)
    bundle.write_graph(parts["nodes"], parts["edges"], str(tmp_path / "g"))
    nodes, edges = bundle.read_graph(spark, str(tmp_path / "g"))
    assert [r.id for r in nodes.orderBy("n_idx").collect()] == ["TEU00001_Det0", "TEU00002_Det0"]
    assert edges.count() == 4
    row = parts["summary"].first()
    assert (row.nodes, row.edges, row.density, row.furthest_m, row.closest_m) == (2, 4, 1.0, 0.0, None)


def test_fingerprint(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (2, None)], "k int, v string")
    same = a.orderBy(F.desc("k")).select("v", "k").repartition(3)
    assert tuple(bundle.dataset_fingerprint(a).first()) == tuple(bundle.dataset_fingerprint(same).first())
    other = spark.createDataFrame([(1, "x"), (2, None), (3, None)], "k int, v string")
    assert tuple(bundle.dataset_fingerprint(a).first()) != tuple(bundle.dataset_fingerprint(other).first())


def reading(det, at, value):
    return (det, at, 100.0, *([value] * len(TRAFFIC)))


def test_refresh_is_incremental_and_repeatable(spark, tmp_path):
    folder, target, progress = (str(tmp_path / p) for p in ("in", "out", "progress"))

    def arrive(rows):
        spark.createDataFrame(rows, READINGS_SCHEMA).coalesce(1).write.mode("append").parquet(folder)

    def run():
        refresh.incremental_refresh(refresh.reading_stream(spark, folder, 1), target, progress)
        return {(r.det_id, r.utc): r.vkfz for r in refresh.read_target(spark, target).collect()}

    week1 = [reading("A", datetime(2023, 1, d, 5), float(d)) for d in range(1, 9)]
    arrive(week1)
    assert len(run()) == 8 and len(run()) == 8
    # The next file repeats the border day with another value, which loses, and one row twice.
    arrive([reading("A", datetime(2023, 1, 8, 5), 99.0)] + [reading("A", datetime(2023, 1, 9, 5), 9.0)] * 2)
    got = run()
    assert len(got) == 9 and got[("A", datetime(2023, 1, 8, 5))] == 8.0
    again = spark.createDataFrame(week1, READINGS_SCHEMA)
    refresh.append_new(again, target)  # a batch run a second time
    assert refresh.read_target(spark, target).count() == 9
    stats = refresh.rolling_stats(refresh.read_target(spark, target), days=3).first()
    assert stats.vkfz_mu == 8.0 and stats.vkfz_sigma == pytest.approx(1.0)


def test_scratch_goes_to_the_folder_the_session_names(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert checkpoint_root(spark) == root
    before = set(os.listdir(root))
    assert materialize(spark.range(3).toDF("n"), "counted").count() == 3
    assert [p.split("-")[0] for p in set(os.listdir(root)) - before] == ["counted"]
