"""WGS-84 longitude/latitude to UTM zone 33N metres (EPSG:25833) as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# GRS80 ellipsoid, zone 33N, third-order Krueger series.
CENTRAL_MERIDIAN_DEG = 15.0
FALSE_EASTING = 500000.0
SCALE = 0.9996
RECTIFYING_RADIUS = 6367449.145771048
ECCENTRICITY = 0.08181919104281579
ALPHA = (0.0008377318229233356, 7.608497033275728e-07, 1.203487805324186e-09)


def project_utm33(df: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Add easting `x` and northing `y` in metres.

    Built in steps, so that shared parts are columns computed once and not copied into
    every term of the series.
    """
    e = F.lit(ECCENTRICITY)
    k = F.lit(SCALE * RECTIFYING_RADIUS)
    sin_lat = F.sin(F.radians(F.col(lat)))
    conformal = df.withColumns(
        {
            "_t": F.sinh(F.atanh(sin_lat) - e * F.atanh(e * sin_lat)),
            "_lam": F.radians(F.col(lon) - F.lit(CENTRAL_MERIDIAN_DEG)),
        }
    )
    t, lam = F.col("_t"), F.col("_lam")
    sphere = conformal.withColumns(
        {"_xi": F.atan2(t, F.cos(lam)), "_eta": F.atanh(F.sin(lam) / F.sqrt(F.lit(1.0) + t * t))}
    )
    xi, eta = F.col("_xi"), F.col("_eta")
    east, north = eta, xi
    for j, a in enumerate(ALPHA, start=1):
        east = east + F.lit(a) * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        north = north + F.lit(a) * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return sphere.withColumns({"x": F.lit(FALSE_EASTING) + k * east, "y": k * north}).drop(
        "_t", "_lam", "_xi", "_eta"
    )


def distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    dx, dy = x1 - x2, y1 - y2
    return F.sqrt(dx * dx + dy * dy)
