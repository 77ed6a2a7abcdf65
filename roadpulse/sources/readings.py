"""Detector files, monthly archives, locations and the holiday calendar."""

from __future__ import annotations

import io
import tarfile
from collections.abc import Iterator
from functools import reduce
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.columns import (
    CSV_NUMERIC,
    CSV_QUALITY,
    DET,
    HOLIDAYS_SCHEMA,
    LOCATIONS_SCHEMA,
    QUALITY,
    TRAFFIC,
    UTC,
)
from roadpulse.session import materialize

SEP = ";"
# <month>/<detector>.csv, where both may carry a "name=" prefix as in folders Spark wrote.
MONTH_IN_PATH = r"(?:^|[/=])(\d{2})/(?:[^/=]+=)?[^/]+\.csv"
DETECTOR_IN_PATH = r"(?:^|[/=])\d{2}/(?:[^/=]+=)?([^/]+?)\.csv"
MONTH_IN_ARCHIVE = r"_(\d{2})\.tgz$"
# Texts a CSV cell holds in place of a number when there is none.
MISSING = ["", "nan", "na", "n/a", "null", "none"]


def _blank_to_null(raw: Column) -> Column:
    text = F.trim(raw)
    return F.when(F.lower(text).isin(MISSING), None).otherwise(text)


def _number(raw: Column) -> Column:
    value = _blank_to_null(raw).try_cast("double")
    return F.when(F.isnan(value), None).otherwise(value)


def parse_utc(raw: Column) -> Column:
    """Text to an NTZ stamp in UTC; a stamp with an offset is shifted, one without is UTC already."""
    text = _blank_to_null(raw)
    offset = text.rlike(r"(Z|[+-]\d{2}:?\d{2})$") & text.rlike(r"\d:\d{2}")
    shifted = F.convert_timezone(
        F.current_timezone(), F.lit("UTC"), text.try_cast("timestamp").cast("timestamp_ntz")
    )
    return F.when(offset, shifted).otherwise(text.try_cast("timestamp_ntz"))


def _typed(df: DataFrame, order: dict[str, Column]) -> DataFrame:
    """Text columns named as in the file to readings; `bad` marks rows with an unreadable cell."""
    raw_utc = _blank_to_null(F.col(UTC))
    utc = parse_utc(F.col(UTC))
    bad = raw_utc.isNotNull() & utc.isNull()
    for c in CSV_NUMERIC:
        cell = F.col(f"`{c}`")
        bad = bad | (_blank_to_null(cell).isNotNull() & _blank_to_null(cell).try_cast("double").isNull())
    return df.select(
        DET,
        utc.alias(UTC),
        _number(F.col(f"`{CSV_QUALITY}`")).alias(QUALITY),
        *[_number(F.col(c)).alias(c) for c in TRAFFIC],
        *[col.alias(name) for name, col in order.items()],
        bad.alias("bad"),
    )


def _headers(spark: SparkSession, paths: str) -> dict[tuple[str, ...] | None, list[str]]:
    """Files by the column names of their own header; under None those with lines but no header. As many entries as files."""
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("path"))
    cells = F.split("value", SEP)
    is_header = F.col("value").contains(UTC) & F.exists(cells, lambda c: F.regexp_replace(c, "[\ufeff\"\\s]", "") == UTC)
    found = lines.groupBy("path").agg(F.max(F.when(is_header, F.col("value"))).alias("header")).collect()
    by_header: dict[tuple[str, ...] | None, list[str]] = {}
    for row in found:
        names = row.header and tuple(c.strip("\ufeff").strip().strip('"').strip() for c in row.header.split(SEP))
        by_header.setdefault(names, []).append(unquote(row.path))
    return by_header


def read_detector_csv(spark: SparkSession, root: str) -> DataFrame:
    """All months of all detectors under `<root>/<MM>/<det_id>.csv`.

    Each file is read by its own header, so the order of columns may differ. A file that lacks a needed column or a header gives
    rows marked `bad`, and the others go on; when no file has them all it is an error. Only the eight needed columns are
    parsed. `month`, `file_start` and `row_order` give the file order for `dedupe_first`.
    """
    by_header = _headers(spark, f"{root.rstrip('/')}/*/*.csv")
    needed = [UTC, *CSV_NUMERIC]
    lacking = [set(needed) - set(names or ()) for names in by_header]
    if by_header and all(lacking):
        raise ValueError(f"columns missing in the detector files: {sorted(set.intersection(*lacking))}")
    place = F.col("_metadata.file_path")
    parts = []
    for names, files in sorted(by_header.items(), key=lambda x: x[0] or ()):
        names = names or ()
        # Columns by position: a header may name one twice.
        schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(max(1, len(names)))])
        reader = spark.read.option("sep", SEP).option("header", bool(names)).option("encoding", "UTF-8").schema(schema)
        cells = [F.col(f"c{names.index(c)}") if c in names else F.lit(None).cast("string") for c in needed]
        raw = reader.csv(files).select(
            F.regexp_extract(place, DETECTOR_IN_PATH, 1).alias(DET),
            F.regexp_extract(place, MONTH_IN_PATH, 1).alias("month_dir"),
            F.col("_metadata.file_block_start").alias("file_start"),
            F.lit(bool(set(needed) - set(names))).alias("_short"),
            *[cell.alias(c) for cell, c in zip(cells, needed)],
        )
        parts.append(raw)
    if not parts:
        columns = f"{DET} string, month_dir string, file_start long, _short boolean, " + ", ".join(f"`{c}` string" for c in needed)
        parts = [spark.createDataFrame([], columns)]
    order = {"month": F.col("month_dir"), "file_start": F.col("file_start"), "row_order": F.monotonically_increasing_id()}
    typed = _typed(reduce(DataFrame.unionByName, parts), {**order, "_short": F.col("_short")})
    return typed.withColumn("bad", F.col("bad") | F.col("_short")).drop("_short")


def detectors_from_paths(spark: SparkSession, root: str) -> DataFrame:
    """Distinct detector ids from the file names of all months; no file is opened."""
    files = spark.read.format("binaryFile").load(f"{root.rstrip('/')}/*/*.csv").select("path")
    return files.select(F.regexp_extract("path", DETECTOR_IN_PATH, 1).alias(DET)).distinct()


def failed_detectors(listed: DataFrame, file_ids: DataFrame, readings: DataFrame) -> DataFrame:
    """(det_id, failed, reason): listed detectors without a file or with an unreadable row."""
    bad = readings.filter("bad").select(DET).distinct().withColumn("_bad", F.lit(True))
    have = file_ids.select(DET).distinct().withColumn("_file", F.lit(True))
    reason = F.when(F.col("_file").isNull(), "no file").when(F.col("_bad"), "unreadable row")
    return (
        listed.select(DET)
        .distinct()
        .join(have, DET, "left")
        .join(bad, DET, "left")
        .select(DET, reason.isNotNull().alias("failed"), reason.alias("reason"))
    )


# --- archives ------------------------------------------------------------------

_CHUNKS = "archive string, member string, header string, first_line long, chunk string, error string"
#: Characters of a member that pass from Python to Spark in one piece, to the end of a line.
CHUNK_CHARS = 4_000_000


def _chunk_reader(size: int = CHUNK_CHARS):
    """Built per call, so that it is shipped by value to the executors."""
    names = [c.split()[0] for c in _CHUNKS.split(", ")]

    def chunks(path: str, content: bytes) -> Iterator[tuple]:
        with tarfile.open(fileobj=io.BytesIO(content), mode="r:gz") as tar:
            for info in tar.getmembers():  # reads to the end: a cut archive fails here
                if not (info.isfile() and info.name.endswith(".csv")):
                    continue
                text = io.TextIOWrapper(tar.extractfile(info), encoding="utf-8-sig")
                header, line = text.readline().rstrip("\n"), 1
                while chunk := text.read(size):
                    chunk = (chunk + text.readline()).removesuffix("\n")
                    yield path, info.name, header, line, chunk, None
                    line += chunk.count("\n") + 1

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                try:
                    for row in chunks(path, content):
                        yield pd.DataFrame([row], columns=names)
                except (tarfile.TarError, EOFError, OSError, UnicodeDecodeError, ValueError) as e:
                    failed = (path, None, None, None, None, f"{type(e).__name__}: {e}")
                    yield pd.DataFrame([failed], columns=names)

    return read


def month_from_archive(path: Column | str) -> Column:
    """`detektoren_2023_01.tgz` to `01`."""
    return F.regexp_extract(path, MONTH_IN_ARCHIVE, 1)


def unpack(archives: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lines, errors) of a frame of archives (path, content).

    One task per archive hands on its members in chunks of text, which Spark splits into lines; no member path is ever written. A
    corrupt archive gives a row in `errors` and the others go on. Archives are read once: what they hold
    is written to the scratch folder and both results read that.
    """
    all_rows = materialize(archives.mapInPandas(_chunk_reader(), _CHUNKS), "chunks")
    lines = all_rows.filter(F.col("error").isNull()).select(
        "archive",
        month_from_archive("archive").alias("month"),
        F.regexp_extract("member", r"([^/]+)\.csv$", 1).alias(DET),
        "header",
        "first_line",
        F.posexplode(F.split("chunk", "\n")).alias("_at", "line"),
    )
    lines = lines.withColumn("line_no", F.col("first_line") + F.col("_at")).drop("first_line", "_at")
    return lines, all_rows.filter(F.col("error").isNotNull()).select("archive", "error")


def unpack_archives(spark: SparkSession, glob: str) -> tuple[DataFrame, DataFrame]:
    """(lines, errors) of the monthly `.tgz` archives of detector files that match `glob`."""
    return unpack(spark.read.format("binaryFile").load(glob).select("path", "content"))


def _fields(line: Column) -> Column:
    """Cells of a line; a separator between quotes is part of a cell."""
    outside = SEP + r'(?=(?:[^"]*"[^"]*")*[^"]*$)'
    bare = F.transform(
        F.split(line, outside), lambda c: F.replace(F.regexp_replace(c, r'^\s*"(.*)"\s*$', "$1"), F.lit('""'), F.lit('"'))
    )
    return F.when(F.contains(line, F.lit('"')), bare).otherwise(F.split(line, SEP))


def parse_lines(lines: DataFrame) -> DataFrame:
    """Archive lines to readings; cells are found by the name in the header of their file."""
    names = F.transform(_fields(F.col("header")), lambda c: F.trim(c))
    cells = lines.withColumn("_names", names).withColumn("_cells", _fields(F.col("line")))

    def cell(name: str) -> Column:
        at = F.array_position("_names", F.lit(name)).cast("int")
        return F.when(at > 0, F.try_element_at("_cells", F.greatest(at, F.lit(1))))

    wide = cells.select(DET, "month", "line_no", *[cell(c).alias(c) for c in [UTC, *CSV_NUMERIC]])
    return _typed(wide, {"month": F.col("month"), "file_start": F.lit(0).cast("long"), "row_order": F.col("line_no")})


def land_archives(spark: SparkSession, glob: str, target: str) -> tuple[DataFrame, DataFrame]:
    """Unpack once to Parquet by month; queries then read columns and not archives.

    (readings, errors): a corrupt archive is a row of `errors`, and what was read of it before the damage is landed.
    """
    lines, errors = unpack_archives(spark, glob)
    parse_lines(lines).hint("rebalance", "month").write.mode("overwrite").partitionBy("month").parquet(target)
    landed = spark.read.parquet(target)
    return landed.withColumn("month", F.lpad(F.col("month").cast("string"), 2, "0")), errors


# --- locations and holidays ---------------------------------------------------------


def read_locations(
    spark: SparkSession, path: str, id_property: str = "teuID", properties: dict[str, str] | None = None
) -> DataFrame:
    """One row per GeoJSON feature: det_id, lon, lat and the named properties as columns."""
    properties = properties or {}
    features = spark.read.schema(LOCATIONS_SCHEMA).option("multiLine", True).json(path)
    f = features.select(F.explode("features").alias("f")).select("f.properties", "f.geometry")
    at = F.col("geometry.coordinates")
    return f.select(
        F.col("properties")[id_property].alias(DET),
        at[0].alias("lon"),
        at[1].alias("lat"),
        *[F.col("properties")[p].alias(name) for name, p in properties.items()],
    )


def read_holidays(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """(d, kind) with kind `public` or `school`."""
    return spark.read.schema(HOLIDAYS_SCHEMA).option("header", True).option("sep", sep).csv(path)
