"""The fixtures and the feature chain as plain SQL views, for the result checks.

Independent of the Spark code: the grid is a join here, fills are window functions over it.
"""

from __future__ import annotations

T6 = ["qkfz", "qpkw", "qlkw", "vkfz", "vpkw", "vlkw"]
CYC = ["sin_hod", "cos_hod", "sin_dow", "cos_dow"]
LOCAL = "timezone('Europe/Berlin', timezone('UTC', {utc}))"


def r(expr: str, digits: int = 6) -> str:
    """Rounded, without a negative zero."""
    return f"(CASE WHEN round({expr}, {digits}) = 0 THEN 0.0::DOUBLE ELSE round({expr}, {digits}) END)"


def rs(cols: list[str], digits: int = 6, prefix: str = "") -> str:
    return ", ".join(f"{r(prefix + c, digits)} AS {c}" for c in cols)


def each(template: str, cols: list[str] = T6, sep: str = ", ") -> str:
    return sep.join(template.format(c=c) for c in cols)


def how(utc: str = "utc") -> str:
    t = LOCAL.format(utc=utc)
    return f"CAST((isodow({t}) - 1) * 24 + hour({t}) AS INTEGER)"


_EVENT_DET = (
    "concat('TEU', lpad(CAST(CAST(floor(user_id/20) AS INT) AS VARCHAR), 5, '0'), "
    "'_Det', CAST(CAST(floor(user_id/10) AS INT) % 2 AS VARCHAR))"
)
_LAT = "CAST(52.40 AS DOUBLE) + CAST(0.006 AS DOUBLE) * (CAST(floor(c_custkey/2) AS INT) % 40)"
_LON = "CAST(13.10 AS DOUBLE) + CAST(0.009 AS DOUBLE) * (CAST(floor(floor(c_custkey/2)/40) AS INT) % 60)"
_CUST_DET = (
    "concat('TEU', lpad(CAST(CAST(floor(c_custkey/2) AS INT) AS VARCHAR), 5, '0'), "
    "'_Det', CAST(c_custkey % 2 AS VARCHAR))"
)
_HOD = f"2 * pi() * hour({LOCAL.format(utc='utc')}) / 24"
_DOW = f"2 * pi() * (isodow({LOCAL.format(utc='utc')}) - 1) / 7"


def utm(lon: str, lat: str) -> tuple[str, str]:
    """EPSG:25833 easting and northing, third-order Krueger series."""
    e = "0.08181919104281579"
    t = f"sinh(atanh(sin(radians({lat}))) - {e} * atanh({e} * sin(radians({lat}))))"
    lam = f"radians({lon} - 15.0)"
    xi = f"atan2({t}, cos({lam}))"
    eta = f"atanh(sin({lam}) / sqrt(1.0 + {t} * {t}))"
    alpha = ["0.0008377318229233356", "7.608497033275728e-07", "1.203487805324186e-09"]
    east, north = eta, xi
    for j, a in enumerate(alpha, 1):
        east += f" + {a} * cos({2*j} * {xi}) * sinh({2*j} * {eta})"
        north += f" + {a} * sin({2*j} * {xi}) * cosh({2*j} * {eta})"
    k = "(CAST(0.9996 AS DOUBLE) * 6367449.145771048)"
    return f"500000.0 + {k} * ({east})", f"{k} * ({north})"


VIEWS: dict[str, tuple[tuple[str, ...], str]] = {}


def view(name: str, uses: tuple[str, ...], body: str) -> None:
    VIEWS[name] = (uses, body)


view(
    "raw_readings",
    (),
    f"SELECT {_EVENT_DET} AS det_id, date_trunc('hour', ts) AS utc, ts, event_id, event_type, value FROM events",
)
view(
    "readings",
    ("raw_readings",),
    """SELECT det_id, utc,
       CAST(100 AS DOUBLE) - CAST(20 AS DOUBLE) * count(CASE WHEN event_type = 'error' THEN 1 END) / count(*) AS quality,
       CAST(count(*) AS DOUBLE) AS qkfz,
       CAST(count(CASE WHEN event_type IN ('click','view','purchase') THEN 1 END) AS DOUBLE) AS qpkw,
       CAST(count(CASE WHEN event_type IN ('signup','error') THEN 1 END) AS DOUBLE) AS qlkw,
       avg(value) AS vkfz,
       avg(CASE WHEN event_type IN ('click','view','purchase') THEN value END) AS vpkw,
       avg(CASE WHEN event_type IN ('signup','error') THEN value END) AS vlkw
FROM raw_readings GROUP BY 1, 2""",
)
view("data_ids", ("readings",), "SELECT DISTINCT det_id FROM readings")
view(
    "file_names",
    (),
    f"""SELECT CASE WHEN event_type = 'signup'
       THEN concat('teuscalaS00000DD', lpad(CAST(CAST(floor(user_id/20) AS INT) AS VARCHAR), 5, '0'), 'D1')
       ELSE {_EVENT_DET} END AS det_id FROM events""",
)
view(
    "locations",
    (),
    f"""SELECT {_CUST_DET} AS det_id, {_LON} AS lon, {_LAT} AS lat, c_mktsegment AS direction,
       CAST(c_custkey % 2 + 1 AS INTEGER) AS lane, c_acctbal >= 0 AS surveyed FROM customer""",
)
view("surveyed_locations", ("locations",), "SELECT * FROM locations WHERE surveyed")
view(
    "customer_nodes",
    (),
    f"""SELECT id, {utm('lon', 'lat')[0]} AS x, {utm('lon', 'lat')[1]} AS y
       FROM (SELECT c_custkey AS id, {_LON} AS lon, {_LAT} AS lat FROM customer)""",
)
view(
    "detector_nodes",
    ("locations", "data_ids"),
    f"""SELECT det_id AS id, {utm('lon', 'lat')[0]} AS x, {utm('lon', 'lat')[1]} AS y
       FROM locations WHERE det_id IN (SELECT det_id FROM data_ids)""",
)
view(
    "holidays",
    (),
    f"""SELECT d, unnest(CASE WHEN isodow(d) = 7 THEN ['public', 'school'] ELSE ['school'] END) AS kind
       FROM (SELECT DISTINCT CAST({LOCAL.format(utc='ts')} AS DATE) AS d FROM events) WHERE isodow(d) >= 5""",
)
view(
    "axis",
    (),
    "SELECT CAST(i AS INTEGER) AS t_idx, TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(i AS INTEGER)) AS utc FROM range(720) g(i)",
)
view(
    "grid",
    ("data_ids", "axis", "readings"),
    f"""SELECT n.det_id, a.t_idx, a.utc, quality, {", ".join(T6)}
FROM data_ids n CROSS JOIN axis a LEFT JOIN readings r ON r.det_id = n.det_id AND r.utc = a.utc""",
)
view(
    "nulled",
    ("grid",),
    "SELECT det_id, t_idx, utc, quality, "
    + each("CASE WHEN quality < 90 THEN NULL ELSE {c} END AS {c}")
    + " FROM grid",
)
view(
    "filled",
    ("nulled",),
    "SELECT det_id, t_idx, utc, quality, "
    + each("last_value({c} IGNORE NULLS) OVER w AS {c}")
    + " FROM nulled WINDOW w AS (PARTITION BY det_id ORDER BY t_idx ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)",
)
view("cleaned", ("filled",), f"SELECT *, {each('{c} IS NOT NULL', sep=' AND ')} AS mask FROM filled")
view(
    "seasonal",
    ("cleaned",),
    f"SELECT det_id, {how()} AS how, " + each("avg({c}) AS {c}") + " FROM cleaned GROUP BY 1, 2",
)
view(
    "imputed1",
    ("cleaned", "seasonal"),
    "SELECT c.det_id, c.t_idx, c.utc, c.mask, "
    + each("coalesce(c.{c}, s.{c}) AS {c}")
    + f" FROM cleaned c JOIN seasonal s ON s.det_id = c.det_id AND s.how = {how('c.utc')}",
)
view(
    "imputed",
    ("imputed1",),
    "SELECT det_id, t_idx, utc, mask, "
    + each("coalesce({c}, avg({c}) OVER (PARTITION BY det_id), 0.0) AS {c}")
    + " FROM imputed1",
)
view(
    "cells",
    ("imputed",),
    f"""SELECT *, sin({_HOD}) AS sin_hod, cos({_HOD}) AS cos_hod, sin({_DOW}) AS sin_dow, cos({_DOW}) AS cos_dow
FROM imputed""",
)
view(
    "labelled",
    ("cells",),
    "SELECT *, CASE WHEN t_idx < 504 THEN 'train' WHEN t_idx < 612 THEN 'val' ELSE 'test' END AS split FROM cells",
)
view(
    "stats",
    ("labelled",),
    "SELECT "
    + each("avg({c}) AS {c}_mu, greatest(stddev_samp({c}), 1e-6) AS {c}_sigma")
    + " FROM labelled WHERE split = 'train' AND mask",
)
view(
    "norm",
    ("labelled", "stats"),
    "SELECT det_id, t_idx, utc, "
    + each("(c.{c} - s.{c}_mu) / s.{c}_sigma AS {c}")
    + f", {', '.join(CYC)}, mask, split FROM labelled c CROSS JOIN stats s",
)


def sql(uses: str | tuple[str, ...], body: str) -> str:
    """`body` after the views it uses, in dependency order."""
    todo = (uses,) if isinstance(uses, str) else uses
    ordered: list[str] = []

    def add(name: str) -> None:
        if name not in ordered:
            for parent in VIEWS[name][0]:
                add(parent)
            ordered.append(name)

    for name in todo:
        add(name)
    # Materialized: a view read twice is computed once.
    ctes = ",\n".join(f"{name} AS MATERIALIZED ({VIEWS[name][1]})" for name in ordered)
    return f"WITH {ctes}\n{body}" if ordered else body
