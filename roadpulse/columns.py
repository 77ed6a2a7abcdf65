"""Column names, defaults and schemas shared by every module."""

from __future__ import annotations

from pyspark.sql import types as T

# Names, order and thresholds of the published hourly detector data.
DET = "det_id"
UTC = "utc"
QUALITY = "quality"
TRAFFIC = ["qkfz", "qpkw", "qlkw", "vkfz", "vpkw", "vlkw"]
FLOWS = ["qkfz", "qpkw", "qlkw"]
SPEEDS = ["vkfz", "vpkw", "vlkw"]
CYCLIC = ["sin_hod", "cos_hod", "sin_dow", "cos_dow"]
FEATURES = TRAFFIC + CYCLIC
FEATURE_SETS = {"all": TRAFFIC, "flow": FLOWS, "speed": SPEEDS}

MODERN_ID = r"^TEU\d+_Det\d+$"
ZONE = "Europe/Berlin"
QUALITY_THRESHOLD = 90.0
SHORT_GAP_HOURS = 3
SPLIT_RATIOS = (0.70, 0.15, 0.15)
SIGMA_EPS = 1e-6
RADIUS_M = 2000.0
KNN_K = 8
HORIZONS = (3, 6, 12)
COVERAGE_FLOOR = 0.70
MAPE_MIN_TARGET = 5.0
FREE_FLOW_ABOVE = 50.0
PROMOTION_MARGIN = 0.02
BUNDLE_FORMAT_VERSION = 1

# Header of one detector-month file, in the published order.
CSV_HEADER = [
    "utc",
    "Datum (Ortszeit)",
    "Stunde des Tages (Ortszeit)",
    "localTime",
    "month",
    "Vollständigkeit",
    "qkfz",
    "qpkw",
    "qlkw",
    "vkfz",
    "vpkw",
    "vlkw",
    "ZScore_Det0",
    "ZScore_Det1",
    "ZScore_Det2",
    "hist_cor",
]
CSV_QUALITY = "Vollständigkeit"
CSV_NUMERIC = [CSV_QUALITY, *TRAFFIC]

READINGS_SCHEMA = T.StructType(
    [
        T.StructField(DET, T.StringType()),
        T.StructField(UTC, T.TimestampNTZType()),
        T.StructField(QUALITY, T.DoubleType()),
        *[T.StructField(c, T.DoubleType()) for c in TRAFFIC],
    ]
)

LOCATIONS_SCHEMA = T.StructType(
    [
        T.StructField(
            "features",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
                        T.StructField(
                            "geometry",
                            T.StructType(
                                [
                                    T.StructField("type", T.StringType()),
                                    T.StructField("coordinates", T.ArrayType(T.DoubleType())),
                                ]
                            ),
                        ),
                    ]
                )
            ),
        )
    ]
)

HOLIDAYS_SCHEMA = T.StructType(
    [T.StructField("d", T.DateType()), T.StructField("kind", T.StringType())]
)
