"""The feature bundle and the graph as Parquet tables, and a fingerprint of a frame.

A build is a new folder below the bundle's path; its `bundle_meta` is written last and
marks it complete, so a reader never sees half a build and an older one stays readable.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.columns import BUNDLE_FORMAT_VERSION, DET, FEATURES, SPLIT_RATIOS, TRAFFIC
from roadpulse.operators.axes import Axis, node_index, split_bounds, time_axis
from roadpulse.operators.features import cast_float32
from roadpulse.operators.normalize import stats_long

# The keys a complete bundle answers for, and the table or column holding each.
BUNDLE_KEYS = {
    "format_version": "bundle_meta.format_version",
    "X": "cells",
    "mask": "cells.mask",
    "det_ids": "nodes.det_id",
    "time_index": "time_axis.utc",
    "feature_names": "bundle_meta.feature_names",
    "n_traffic_features": "bundle_meta.n_traffic_features",
    "mu": "norm_stats.mu",
    "sigma": "norm_stats.sigma",
    "train_end": "bundle_meta.train_end",
    "val_end": "bundle_meta.val_end",
    "config": "bundle_meta.config",
}
TABLES = ("cells", "nodes", "time_axis", "norm_stats", "bundle_meta")


def _new_build(path: str) -> str:
    """A fresh folder below `path`; names sort by time."""
    return f"{path.rstrip('/')}/build={datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def _newest_build(spark: SparkSession, path: str, last_table: str) -> str:
    """The newest folder whose last table holds rows, that is, whose build was finished."""
    built = spark.read.option("basePath", path).parquet(f"{path.rstrip('/')}/build=*/{last_table}")
    name = built.agg(F.max(F.col("build").cast("string"))).first()[0]
    if name is None:
        raise ValueError(f"no complete build below {path}")
    return f"{path.rstrip('/')}/build={name}"


def write_bundle(
    spark: SparkSession,
    cells: DataFrame,
    nodes: DataFrame,
    axis: Axis,
    stats: DataFrame,
    path: str,
    ratios: tuple[float, float, float] = SPLIT_RATIOS,
    config: dict[str, str] | None = None,
) -> str:
    """Write all tables of one build and return its path. `cells` carry `split`."""
    target = _new_build(path)
    train_end, val_end = split_bounds(axis.hours, ratios)

    # Clustered by detector, so that min/max of a file prune a sensor list.
    cast_float32(cells).repartition("split", DET).sortWithinPartitions("split", DET, "t_idx").write.partitionBy(
        "split"
    ).parquet(f"{target}/cells")
    node_index(nodes).write.parquet(f"{target}/nodes")
    time_axis(spark, axis).coalesce(1).write.parquet(f"{target}/time_axis")
    long_stats = stats_long(stats).withColumns(
        {c: F.col(c).cast("float") for c in ("mu", "sigma")}
    )
    long_stats.coalesce(1).write.parquet(f"{target}/norm_stats")

    meta = spark.range(1).select(
        F.lit(BUNDLE_FORMAT_VERSION).alias("format_version"),
        F.array(*[F.lit(c) for c in FEATURES]).alias("feature_names"),
        F.lit(len(TRAFFIC)).alias("n_traffic_features"),
        F.lit(train_end).alias("train_end"),
        F.lit(val_end).alias("val_end"),
        F.map_from_arrays(
            F.array(*[F.lit(k) for k in (config or {"axis": "hourly"})]),
            F.array(*[F.lit(str(v)) for v in (config or {"axis": "hourly"}).values()]),
        ).alias("config"),
    )
    meta.coalesce(1).write.parquet(f"{target}/bundle_meta")
    return target


def read_bundle(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Tables of the newest complete build; an unknown format version is an error."""
    target = _newest_build(spark, path, "bundle_meta")
    version = spark.read.parquet(f"{target}/bundle_meta").select("format_version").first()[0]
    if version != BUNDLE_FORMAT_VERSION:
        raise ValueError(f"bundle format {version}, expected {BUNDLE_FORMAT_VERSION}: build it again")
    return {t: spark.read.parquet(f"{target}/{t}") for t in TABLES}


def bundle_schema_check(tables: dict[str, DataFrame]) -> DataFrame:
    """(key, present, n_rows) of every expected key: whether the tables answer for it, and the rows that do."""
    spark = next(iter(tables.values())).sparkSession
    count = F.count(F.lit(1))
    rows = {name: df.agg(count).scalar() for name, df in tables.items()}
    parts = []
    for key, place in BUNDLE_KEYS.items():
        table, _, column = place.partition(".")
        have = table in tables and (not column or column in tables[table].columns)
        if key == "X":
            have = have and not set(FEATURES) - set(tables["cells"].columns)
        found = rows[table] if have else F.lit(None).cast("long")
        parts.append(F.struct(F.lit(key).alias("key"), F.lit(bool(have)).alias("present"), found.alias("n_rows")))
    return spark.range(1).select(F.inline(F.array(*parts)))


def write_graph(nodes: DataFrame, edges: DataFrame, path: str) -> str:
    """Sparse adjacency and the ordered nodes (n_idx, id, x, y) as a new build; the nodes complete it."""
    target = _new_build(path)
    # Edges of a source take less than a byte each; Parquet's writer then adds up its buffers at every row, unless told a least number of rows.
    edges.write.option("parquet.page.size.row.check.min", 2**31 - 1).parquet(f"{target}/edges")
    nodes.write.parquet(f"{target}/graph_nodes")
    return target


def read_graph(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of the newest complete build."""
    target = _newest_build(spark, path, "graph_nodes")
    return spark.read.parquet(f"{target}/graph_nodes"), spark.read.parquet(f"{target}/edges")


def dataset_fingerprint(df: DataFrame) -> DataFrame:
    """One row that changes with the content of a frame, not with the order of its rows or columns.

    Any engine can make it: a row's text is its columns in order of their names, `|` between them, `~` for NULL and fractions as whole
    ten-thousandths; its number the first 15 hexadecimal digits of the text's MD5. Sum and exclusive or of the numbers are the fingerprint.
    """

    def text(name: str, kind: str) -> Column:
        c = F.col(f"`{name}`")
        c = F.round(c.cast("double") * 1e4).cast("long") if kind in ("double", "float") else c
        return F.coalesce(c.cast("string"), F.lit("~"))

    whole = F.concat_ws("|", *[text(name, kind) for name, kind in sorted(df.dtypes)])
    h = F.conv(F.substring(F.md5(whole.cast("binary")), 1, 15), 16, 10).cast("long")
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(h.cast("decimal(38,0)")).alias("hash_sum"),
        F.bit_xor(h).alias("hash_xor"),
    )
