"""Queries on readers, the bundle, the graph store and the refresh stream.

Each writes the given tables in the format concerned and reads them back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from roadpulse import fixtures as fx
from roadpulse.columns import DET, FEATURES, QUALITY, TRAFFIC, UTC
from roadpulse.operators import axes, graph, normalize
from roadpulse.plans import pipelines
from roadpulse.registry.base import query, rounded
from roadpulse.registry.tables import CYC, T6, cells
from roadpulse.registry.views import r, rs, sql, view
from roadpulse.session import materialize, scratch_path
from roadpulse.sources import bundle, readings
from roadpulse.streaming import continuous, refresh

Q7 = ["quality", *T6]


@query("read_detector_csv", sql("readings", f"SELECT det_id, utc, {rs(Q7)}, '01' AS month FROM readings"))
def _(spark, d):
    found = readings.read_detector_csv(spark, fx.detector_files(spark, d))
    return rounded(found.select(DET, UTC, QUALITY, *TRAFFIC, "month"))


@query("detectors_from_paths", sql("data_ids", "SELECT det_id FROM data_ids"))
def _(spark, d):
    return readings.detectors_from_paths(spark, fx.detector_files(spark, d))


@query("month_from_archive", sql("readings", "SELECT DISTINCT strftime(utc, '%m') AS month FROM readings"))
def _(spark, d):
    archives = fx.month_archives(spark, d)
    return archives.select(readings.month_from_archive("path").alias("month")).distinct()


@query("unpack_archives", sql("readings", f"SELECT det_id, utc, {rs(Q7)}, '01' AS month FROM readings"))
def _(spark, d):
    lines, _errors = readings.unpack(fx.month_archives(spark, d))
    return rounded(readings.parse_lines(lines).select(DET, UTC, QUALITY, *TRAFFIC, "month"))


@query(
    "archive_contents",
    sql(
        "readings",
        """SELECT 'read' AS kind, '01' AS month, det_id, count(*) AS n FROM readings GROUP BY det_id
           UNION ALL SELECT 'damaged', '01', NULL, 1""",
    ),
)
def _(spark, d):
    lines, errors = readings.unpack(fx.some_damaged(fx.month_archives(spark, d)))
    read = readings.parse_lines(lines).groupBy(F.lit("read").alias("kind"), "month", DET).agg(F.count(F.lit(1)).alias("n"))
    month = readings.month_from_archive("archive").alias("month")
    # How many archives a month is packed in is the fixture's choice, that each broken copy is reported once is not.
    lost = errors.groupBy(month).agg((F.count(F.lit(1)) / F.count_distinct("archive")).cast("long").alias("n"))
    return read.unionByName(lost.select(F.lit("damaged").alias("kind"), "month", F.lit(None).cast("string").alias(DET), "n"))


@query("read_locations", sql("locations", f"SELECT det_id, {rs(['lon', 'lat'])}, direction, CAST(lane AS VARCHAR) AS lane FROM locations"))
def _(spark, d):
    found = readings.read_locations(
        spark, fx.location_documents(spark, d), properties={"direction": "richtung", "lane": "spur"}
    )
    return rounded(found)


@query("read_holidays", sql("holidays", "SELECT d, kind FROM holidays"))
def _(spark, d):
    path = scratch_path(spark, "holidays")
    fx.holidays(spark, d).write.option("header", True).csv(path)
    return readings.read_holidays(spark, path)


def _bundle(spark, d) -> str:
    path = scratch_path(spark, "bundle")
    pipelines.build_bundle(spark, fx.readings(spark, d), fx.data_ids(spark, d), fx.AXIS, path, unique=True)
    return path


_F32 = ", ".join(f"{r(f'CAST(CAST({c} AS FLOAT) AS DOUBLE)', 3)} AS {c}" for c in T6 + CYC)


@query("write_bundle", sql("norm", f"SELECT det_id, t_idx, utc, {_F32}, mask, split FROM norm"))
def _(spark, d):
    stored = bundle.read_bundle(spark, _bundle(spark, d))["cells"]
    wide = stored.withColumns({c: F.col(c).cast("double") for c in FEATURES})
    return rounded(wide, *FEATURES, digits=3)


@query("files_to_bundle", sql("norm", f"SELECT det_id, t_idx, utc, {_F32}, mask, split FROM norm"))
def _(spark, d):
    """Files of overlapping months and locations to the committed bundle, whole chain."""
    files = fx.overlapping_files(spark, d)
    # Opening the many small files costs most, so they are parsed once and their names listed once.
    raw = materialize(readings.read_detector_csv(spark, files), "raw")
    listed = materialize(axes.modern_ids(readings.detectors_from_paths(spark, files)), "named")
    located = axes.valid_detectors(listed, fx.locations(spark, d))
    nodes = readings.failed_detectors(located, listed, raw)
    path = scratch_path(spark, "bundle")
    pipelines.build_bundle(spark, raw, nodes, fx.AXIS, path)
    wide = bundle.read_bundle(spark, path)["cells"].withColumns({c: F.col(c).cast("double") for c in FEATURES})
    return rounded(wide, *FEATURES, digits=3)


@query(
    "read_bundle",
    sql(
        "data_ids",
        """SELECT CAST(1 AS INTEGER) AS format_version, CAST(6 AS INTEGER) AS n_traffic_features, CAST(504 AS INTEGER) AS train_end,
        CAST(612 AS INTEGER) AS val_end, CAST(720 AS BIGINT) AS hours, count(*) AS detectors FROM data_ids""",
    ),
)
def _(spark, d):
    tables = bundle.read_bundle(spark, _bundle(spark, d))
    count = F.count(F.lit(1))
    return tables["bundle_meta"].select(
        "format_version",
        "n_traffic_features",
        "train_end",
        "val_end",
        tables["time_axis"].agg(count).scalar().alias("hours"),
        tables["nodes"].agg(count).scalar().alias("detectors"),
    )


_KEY_ROWS = {"X": "720 * n", "mask": "720 * n", "det_ids": "n", "time_index": "720", "mu": "6", "sigma": "6"}


@query(
    "bundle_schema_check",
    sql(
        "data_ids",
        " UNION ALL ".join(
            f"SELECT '{key}' AS key, true AS present, CAST({_KEY_ROWS.get(key, '1')} AS BIGINT) AS n_rows FROM (SELECT count(*) AS n FROM data_ids)"
            for key in bundle.BUNDLE_KEYS
        ),
    ),
)
def _(spark, d):
    """Keys of a bundle built from the tables, and the rows that answer for them."""
    return bundle.bundle_schema_check(bundle.read_bundle(spark, _bundle(spark, d)))


@query(
    "write_graph",
    sql(
        ("cust_binary", "customer_nodes"),
        f"""SELECT n.id, {r('any_value(x)', 3)} AS x, {r('any_value(y)', 3)} AS y, count(*) AS degree
        FROM customer_nodes n JOIN cust_binary e ON e.src = n.id GROUP BY 1""",
    ),
)
def _(spark, d):
    nodes = fx.customer_nodes(spark, d)
    path = scratch_path(spark, "graph")
    bundle.write_graph(nodes, graph.radius_graph_binary(nodes), path)
    stored, edges = bundle.read_graph(spark, path)
    degree = edges.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("degree"))
    return rounded(stored.join(degree, "id"), digits=3)


_CELL_COLS = sorted(["det_id", "t_idx", *T6, *CYC, "mask"])
_CELL_TEXT = ", ".join(
    f"coalesce(CAST(CAST(round({c} * 1e4) AS BIGINT) AS VARCHAR), '~')" if c in T6 + CYC else f"coalesce(lower(CAST({c} AS VARCHAR)), '~')" for c in _CELL_COLS
)


@query(
    "dataset_fingerprint",
    sql(
        "cells",
        f"""SELECT count(*) AS n_rows, CAST(CAST(sum(h) AS DECIMAL(38, 0)) AS VARCHAR) AS hash_sum, bit_xor(h) AS hash_xor FROM (
              SELECT CAST('0x' || substr(md5(concat_ws('|', {_CELL_TEXT})), 1, 15) AS BIGINT) AS h FROM cells)""",
    ),
)
def _(spark, d):
    """Fingerprint of the dense cells."""
    dense = cells(spark, d).withColumn(DET, F.lower(DET)).select(*_CELL_COLS)
    return bundle.dataset_fingerprint(dense).withColumn("hash_sum", F.col("hash_sum").cast("string"))


view(
    "recent",
    ("readings",),
    "SELECT * FROM readings WHERE utc > (SELECT max(utc) FROM readings) - INTERVAL 14 DAY "
    "AND (quality IS NULL OR quality >= 90) AND "
    + " AND ".join(f"{c} IS NOT NULL" for c in T6),
)


@query(
    "incremental_refresh",
    sql(
        "recent",
        " UNION ALL ".join(
            f"SELECT '{c}' AS feature, {r(f'avg({c})')} AS mu, {r(f'greatest(stddev_samp({c}), 1e-6)')} AS sigma FROM recent"
            for c in T6
        ),
    ),
)
def _(spark, d):
    """Weekly files with overlapping borders, taken one at a time; statistics of the last 14 days."""
    target = scratch_path(spark, "target")
    stream = refresh.reading_stream(spark, fx.weekly_files(spark, d), files_per_batch=1)
    refresh.incremental_refresh(stream, target, scratch_path(spark, "progress"))
    stats = refresh.rolling_stats(refresh.read_target(spark, target), days=14)
    return rounded(normalize.stats_long(stats))


@query(
    "continuous_refresh",
    sql(
        "recent",
        " UNION ALL ".join(
            f"SELECT '{c}' AS feature, {r(f'avg({c})')} AS mu, {r(f'greatest(stddev_samp({c}), 1e-6)')} AS sigma FROM recent"
            for c in T6
        ),
    ),
)
def _(spark, d):
    """The same files through a stream with state; statistics merged from the moments of days."""
    target, moments = scratch_path(spark, "rows"), scratch_path(spark, "moments")
    stream = refresh.reading_stream(spark, fx.weekly_files(spark, d), files_per_batch=1)
    continuous.continuous_refresh(stream, target, moments, scratch_path(spark, "progress"), delay="8 days")
    return rounded(normalize.stats_long(continuous.rolling_stats(spark, target, moments, days=14)))
