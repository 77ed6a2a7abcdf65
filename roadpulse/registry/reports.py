"""Queries on profiles, forecasts and evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadpulse import fixtures as fx
from roadpulse.columns import DET, FEATURES, HORIZONS, QUALITY, TRAFFIC, UTC
from roadpulse.functions.timefn import minutes_between
from roadpulse.operators import eda, evaluate, forecast
from roadpulse.plans import pipelines
from roadpulse.registry.base import query, rounded
from roadpulse.registry.tables import cleaned, labelled
from roadpulse.registry.views import LOCAL, T6, how, r, rs, sql, view
from roadpulse.session import materialize

Q7 = ["quality", *T6]

# --- profiles ----------------------------------------------------------------

DESCRIBE = " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, count({c}) AS n, {r(f'avg({c})')} AS mean, {r(f'stddev_samp({c})')} AS std,
    {r(f'min({c})')} AS min, {r(f'quantile_cont({c}, 0.25)')} AS q25, {r(f'quantile_cont({c}, 0.5)')} AS q50,
    {r(f'quantile_cont({c}, 0.75)')} AS q75, {r(f'max({c})')} AS max FROM readings"""
    for c in Q7
)


@query("describe_numeric", sql("readings", DESCRIBE))
def _(spark, d):
    return rounded(eda.describe_numeric(fx.readings(spark, d), Q7))


@query(
    "profile_columns",
    sql(
        "readings",
        " UNION ALL ".join(
            f"SELECT {i} AS position, '{c}' AS \"column\", '{t}' AS type, count({c}) AS non_null FROM readings"
            for i, (c, t) in enumerate(
                [("det_id", "string"), ("utc", "timestamp_ntz"), *[(c, "double") for c in Q7]]
            )
        ),
    ),
)
def _(spark, d):
    return eda.profile_columns(fx.readings(spark, d).select(DET, UTC, QUALITY, *TRAFFIC))


@query("distinct_sensors", sql("file_names", "SELECT count(DISTINCT det_id) AS sensors FROM file_names"))
def _(spark, d):
    return eda.distinct_sensors(fx.file_names(spark, d))


@query("time_range", "SELECT min(ts) AS first_utc, max(ts) AS last_utc FROM events")
def _(spark, d):
    return eda.time_range(fx.table(spark, d, "events"), "ts")


@query(
    "sampling_interval",
    sql(
        "readings",
        """SELECT det_id, step_minutes, steps FROM (
             SELECT det_id, CAST(date_diff('minute', prev, utc) AS DOUBLE) AS step_minutes, count(*) AS steps
             FROM (SELECT det_id, utc, lag(utc) OVER (PARTITION BY det_id ORDER BY utc) AS prev FROM readings)
             WHERE prev IS NOT NULL GROUP BY 1, 2)
           QUALIFY row_number() OVER (PARTITION BY det_id ORDER BY steps DESC, step_minutes) = 1""",
    ),
)
def _(spark, d):
    return eda.sampling_interval(fx.readings(spark, d))


def _profile_sql(name: str, key: str) -> str:
    return sql(
        "readings",
        f"""SELECT CAST({key} AS INTEGER) AS {name}, {r('avg(qkfz)')} AS mean_flow, {r('avg(vkfz)')} AS mean_speed,
        count(*) AS n FROM readings GROUP BY 1""",
    )


@query("daily_profile", _profile_sql("hour", f"hour({LOCAL.format(utc='utc')})"))
def _(spark, d):
    return rounded(eda.daily_profile(fx.readings(spark, d)))


@query("weekly_profile", _profile_sql("weekday", f"isodow({LOCAL.format(utc='utc')}) - 1"))
def _(spark, d):
    return rounded(eda.weekly_profile(fx.readings(spark, d)))


@query(
    "quality_histogram",
    sql("readings", "SELECT CAST(floor(quality / 5) * 5 AS DOUBLE) AS quality_from, count(*) AS n FROM readings GROUP BY 1"),
)
def _(spark, d):
    return eda.quality_histogram(fx.readings(spark, d))


# Two neighbouring sites taken as one, so that sites hold up to four detectors.
view(
    "sited_readings",
    ("readings",),
    """SELECT * REPLACE (concat('TEU', lpad(CAST(CAST(substr(det_id, 4, 5) AS INT) // 2 AS VARCHAR), 5, '0'), '_Det',
       CAST(2 * (CAST(substr(det_id, 4, 5) AS INT) % 2) + CAST(substr(det_id, 13, 1) AS INT) AS VARCHAR)) AS det_id) FROM readings""",
)
view(
    "sibling_pairs",
    ("sited_readings",),
    r"""SELECT regexp_extract(a.det_id, '^(TEU\d+)_', 1) AS site_id, a.utc, a.det_id AS det_a, b.det_id AS det_b,
       a.qkfz AS qkfz_a, b.qkfz AS qkfz_b, a.vkfz AS vkfz_a, b.vkfz AS vkfz_b
       FROM sited_readings a JOIN sited_readings b ON a.utc = b.utc AND a.det_id < b.det_id
       AND regexp_extract(a.det_id, '^(TEU\d+)_', 1) = regexp_extract(b.det_id, '^(TEU\d+)_', 1)""",
)


@query(
    "sibling_pairs",
    sql("sibling_pairs", f"SELECT site_id, utc, det_a, det_b, {rs(['qkfz_a', 'qkfz_b', 'vkfz_a', 'vkfz_b'])} FROM sibling_pairs"),
)
def _(spark, d):
    return rounded(eda.sibling_pairs(_sited(spark, d)))


def _sited(spark, d):
    site, pos = F.substring(DET, 4, 5).cast("int"), F.substring(DET, 13, 1).cast("int")
    number = F.lpad(F.floor(site / 2).cast("string"), 5, "0")
    det = F.concat(F.lit("TEU"), number, F.lit("_Det"), (2 * (site % 2) + pos).cast("string"))
    return materialize(fx.readings(spark, d).withColumn(DET, det), "sited")


def _corr_sql(c: str) -> str:
    return (
        f"count(*) FILTER ({c}_a IS NOT NULL AND {c}_b IS NOT NULL) AS n_{c}, "
        f"CASE WHEN count(*) FILTER ({c}_a IS NOT NULL AND {c}_b IS NOT NULL) >= 3 "
        f"AND min({c}_a) FILTER ({c}_b IS NOT NULL) < max({c}_a) FILTER ({c}_b IS NOT NULL) "
        f"AND min({c}_b) FILTER ({c}_a IS NOT NULL) < max({c}_b) FILTER ({c}_a IS NOT NULL) "
        f"THEN {r(f'corr({c}_a, {c}_b)')} END AS r_{c}"
    )


@query(
    "sibling_correlation",
    sql("sibling_pairs", f"SELECT det_a, det_b, {_corr_sql('qkfz')}, {_corr_sql('vkfz')} FROM sibling_pairs GROUP BY 1, 2"),
)
def _(spark, d):
    return rounded(eda.sibling_correlation(eda.sibling_pairs(_sited(spark, d))))


view(
    "site_sizes",
    ("locations",),
    r"""SELECT regexp_extract(det_id, '^(TEU\d+)_', 1) AS site_id, CAST(count(DISTINCT det_id) AS DOUBLE) AS detectors
       FROM locations GROUP BY 1""",
)


@query(
    "detectors_per_site",
    sql("site_sizes", f"SELECT site_id, detectors FROM site_sizes UNION ALL SELECT NULL, {r('avg(detectors)')} FROM site_sizes"),
)
def _(spark, d):
    return rounded(eda.detectors_per_site(fx.locations(spark, d)))


@query("sort_ids", sql("locations", "SELECT det_id FROM locations ORDER BY det_id"))
def _(spark, d):
    return eda.sort_ids(fx.locations(spark, d))


@query(
    "sort_time",
    sql(
        "readings",
        """SELECT det_id, utc, CAST(date_diff('minute', lag(utc) OVER (PARTITION BY det_id ORDER BY utc), utc) AS DOUBLE) AS since_last
           FROM readings""",
    ),
)
def _(spark, d):
    """Time order per detector, seen as the minutes since the row before."""
    from pyspark.sql import Window

    ordered = eda.sort_time(fx.readings(spark, d))
    before = F.lag(UTC).over(Window.partitionBy(DET).orderBy(UTC))
    return ordered.select(DET, UTC, before.alias("prev")).select(
        DET, UTC, minutes_between("prev", UTC).alias("since_last")
    )


@query(
    "head_rows",
    sql("readings", f"SELECT det_id, utc, {rs(Q7)} FROM readings ORDER BY det_id, utc LIMIT 5"),
)
def _(spark, d):
    return rounded(eda.head_rows(fx.readings(spark, d), [DET, UTC]))


@query(
    "first_valid_row",
    sql(
        "readings",
        f"""SELECT det_id, utc, {rs(Q7)} FROM readings WHERE vlkw IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY det_id ORDER BY utc) = 1""",
    ),
)
def _(spark, d):
    return rounded(eda.first_valid_row(fx.readings(spark, d), "vlkw"))


@query(
    "first_failures",
    sql(
        "data_ids",
        """SELECT det_id, count(*) OVER () AS failed_total
           FROM (SELECT concat('TEU', lpad(CAST(n_nationkey AS VARCHAR), 5, '0'), '_Det1') AS det_id FROM nation)
           WHERE det_id NOT IN (SELECT det_id FROM data_ids) ORDER BY det_id LIMIT 5""",
    ),
)
def _(spark, d):
    failed = fx.listed_detectors(spark, d).join(fx.data_ids(spark, d), DET, "left_anti")
    return eda.first_failures(failed)


def _sql_hours(ts: str) -> str:
    return f"CAST(date_diff('day', DATE '1970-01-01', CAST({ts} AS DATE)) * 24 + hour({ts}) AS DOUBLE)"


def _columns_sql(columns: list[tuple[str, str]], of: str) -> str:
    return " UNION ALL ".join(f"SELECT 'columns' AS section, '{c}:{t}' AS name, CAST(count({c}) AS DOUBLE) AS value FROM {of}" for c, t in columns)


_STATS = {"n": "CAST(count({c}) AS DOUBLE)", "mean": "avg({c})", "std": "stddev_samp({c})", "min": "min({c})", "max": "max({c})"}
_STATS |= {f"q{p}": "quantile_cont({c}, 0." + p + ")" for p in ("25", "50", "75")}


@query(
    "profile_readings",
    sql(
        "readings",
        f"""SELECT section, name, {r('value')} AS value FROM (
        SELECT * FROM (SELECT 'head' AS section, concat(det_id, '@', CAST(CAST({_sql_hours('utc')} AS BIGINT) AS VARCHAR)) AS name,
          qkfz AS value FROM readings ORDER BY det_id, utc LIMIT 5)
        UNION ALL {_columns_sql([("det_id", "string"), ("utc", "timestamp_ntz"), *[(c, "double") for c in Q7]], "readings")}
        UNION ALL {" UNION ALL ".join(f"SELECT 'describe', '{c}.{s}', {e.format(c=c)} FROM readings" for c in Q7 for s, e in _STATS.items())}
        UNION ALL SELECT 'sensors', 'distinct', CAST(count(DISTINCT det_id) AS DOUBLE) FROM readings
        UNION ALL SELECT 'range', 'first', {_sql_hours('min(utc)')} FROM readings
        UNION ALL SELECT 'range', 'last', {_sql_hours('max(utc)')} FROM readings
        UNION ALL SELECT 'interval', det_id, step FROM (
          SELECT det_id, CAST(date_diff('minute', prev, utc) AS DOUBLE) AS step, count(*) AS steps
          FROM (SELECT det_id, utc, lag(utc) OVER (PARTITION BY det_id ORDER BY utc) AS prev FROM readings)
          WHERE prev IS NOT NULL GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY det_id ORDER BY count(*) DESC, step) = 1))""",
    ),
)
def _(spark, d):
    return rounded(pipelines.profile_readings(materialize(fx.readings(spark, d), "readings")))


_PLACE = [("det_id", "string"), ("lon", "double"), ("lat", "double"), ("direction", "string"), ("lane", "int"), ("surveyed", "boolean")]


@query(
    "profile_locations",
    sql(
        "locations",
        f"""SELECT section, name, {r('value')} AS value FROM (
        SELECT * FROM (SELECT 'head' AS section, det_id AS name, lon AS value FROM locations ORDER BY det_id LIMIT 5)
        UNION ALL {_columns_sql(_PLACE, "locations")}
        UNION ALL SELECT 'first', 'lon', arg_min(lon, det_id) FROM locations
        UNION ALL SELECT 'first', 'lat', arg_min(lat, det_id) FROM locations)""",
    ),
)
def _(spark, d):
    return rounded(pipelines.profile_locations(fx.locations(spark, d)))


# --- forecasts ---------------------------------------------------------------

_DIGEST = (
    "SELECT split, {length} AS input_length, count(*) AS samples, "
    + r("avg(sx)", 4)
    + " AS mean_input, "
    + r("avg(sy)", 4)
    + " AS mean_target, CAST(sum(sm) AS BIGINT) AS valid_targets "
    "FROM (SELECT split, count(*) OVER past AS n_past, count(*) OVER ahead AS n_ahead, "
    "sum(" + " + ".join(FEATURES) + ") OVER past AS sx, sum(vkfz) OVER ahead AS sy, sum(CAST(mask AS INT)) OVER ahead AS sm "
    "FROM labelled WINDOW past AS (PARTITION BY det_id, split ORDER BY t_idx ROWS BETWEEN {before} PRECEDING AND CURRENT ROW), "
    "ahead AS (PARTITION BY det_id, split ORDER BY t_idx ROWS BETWEEN 1 FOLLOWING AND 12 FOLLOWING)) "
    "WHERE n_past = {length} AND n_ahead = 12 GROUP BY split"
)


def _digest(samples):
    total = lambda arr: F.aggregate(arr, F.lit(0.0), lambda a, x: a + x.cast("double"))
    per = samples.select(
        "split",
        "input_length",
        total(F.flatten("x_in")).alias("sx"),
        total(F.col("y")).alias("sy"),
        F.size(F.filter("y_mask", lambda m: m)).alias("sm"),
    )
    return rounded(
        per.groupBy("split", "input_length").agg(
            F.count(F.lit(1)).alias("samples"),
            F.avg("sx").alias("mean_input"),
            F.avg("sy").alias("mean_target"),
            F.sum("sm").alias("valid_targets"),
        ),
        digits=3,
    )


def _digest_sql(length: int) -> str:
    return _DIGEST.format(length=length, before=length - 1).replace(", 4)", ", 3)")


@query("window_samples", sql("labelled", _digest_sql(12)))
def _(spark, d):
    samples = forecast.window_samples(labelled(spark, d))
    return _digest(samples.withColumn("input_length", F.lit(12)))


@query("input_length_variants", sql("labelled", " UNION ALL ".join(_digest_sql(n) for n in (6, 12, 24, 48))))
def _(spark, d):
    return _digest(forecast.input_length_variants(labelled(spark, d)))


@query(
    "horizon_targets",
    sql(
        "cells",
        "SELECT det_id, t_idx, "
        + ", ".join(f"{r(f'lead(vkfz, {h}) OVER w')} AS y_{h}, lead(mask, {h}) OVER w AS mask_{h}" for h in HORIZONS)
        + " FROM cells WINDOW w AS (PARTITION BY det_id ORDER BY t_idx)",
    ),
)
def _(spark, d):
    wide = forecast.horizon_targets(labelled(spark, d))
    return rounded(wide.select(DET, "t_idx", *[f"{p}_{h}" for h in HORIZONS for p in ("y", "mask")]))


def _horizons_sql(model: str, source: str, y_hat: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{model}' AS model, det_id, t_idx + {h} AS t_idx, {h} AS horizon, {y_hat.format(h=h)} AS y_hat "
        f"FROM {source} WHERE t_idx + {h} < 720"
        for h in HORIZONS
    )


view("preds_last", ("labelled",), _horizons_sql("last_value", "labelled", "vkfz"))
view(
    "train_means",
    ("labelled",),
    f"SELECT det_id, {how()} AS how, avg(vkfz) AS m FROM labelled WHERE split = 'train' AND mask GROUP BY 1, 2",
)
view(
    "preds_how",
    ("labelled", "train_means"),
    " UNION ALL ".join(
        f"""SELECT 'hour_of_week' AS model, c.det_id, c.t_idx, {h} AS horizon, m.m AS y_hat
        FROM labelled c LEFT JOIN train_means m ON m.det_id = c.det_id AND m.how = {how('c.utc')} WHERE c.t_idx >= {h}"""
        for h in HORIZONS
    ),
)
view(
    "ar1",
    ("labelled",),
    """SELECT det_id, regr_slope(vkfz, x) AS b, regr_intercept(vkfz, x) AS a FROM (
         SELECT det_id, vkfz, split = 'train' AND mask AS ok,
           CASE WHEN lag(split = 'train' AND mask) OVER w THEN lag(vkfz) OVER w END AS x
         FROM labelled WINDOW w AS (PARTITION BY det_id ORDER BY t_idx)) WHERE ok GROUP BY 1""",
)
view(
    "ar1_cells",
    ("labelled", "ar1"),
    "SELECT c.det_id, t_idx, vkfz, a, b FROM labelled c JOIN ar1 ON ar1.det_id = c.det_id",
)
view(
    "preds_ar1",
    ("ar1_cells",),
    _horizons_sql(
        "ar1",
        "ar1_cells",
        "CASE WHEN b = 1 THEN vkfz + a * {h} ELSE pow(b, {h}) * vkfz + a * (1 - pow(b, {h})) / (1 - b) END",
    ),
)
view(
    "preds",
    ("preds_last", "preds_how", "preds_ar1"),
    "SELECT * FROM preds_last UNION ALL SELECT * FROM preds_how UNION ALL SELECT * FROM preds_ar1",
)
view(
    "judged",
    ("preds", "labelled"),
    """SELECT p.*, c.split, c.vkfz AS y, c.mask FROM preds p JOIN labelled c ON c.det_id = p.det_id AND c.t_idx = p.t_idx""",
)

PRED_COLS = "model, det_id, t_idx, horizon"


def judged(spark, d):
    return forecast.naive_forecasts(labelled(spark, d), fx.AXIS.hours)


@query("baseline_last_value", sql("preds_last", f"SELECT {PRED_COLS}, {r('y_hat')} AS y_hat FROM preds_last"))
def _(spark, d):
    return rounded(forecast.baseline_last_value(labelled(spark, d), fx.AXIS.hours))


@query("baseline_hour_of_week", sql("preds_how", f"SELECT {PRED_COLS}, {r('y_hat')} AS y_hat FROM preds_how"))
def _(spark, d):
    return rounded(forecast.baseline_hour_of_week(labelled(spark, d), fx.AXIS.hours))


@query("baseline_ar1", sql("preds_ar1", f"SELECT {PRED_COLS}, {r('y_hat')} AS y_hat FROM preds_ar1"))
def _(spark, d):
    return rounded(forecast.baseline_ar1(labelled(spark, d), fx.AXIS.hours))


@query(
    "forecast_vs_actual",
    sql("judged", f"SELECT {PRED_COLS}, {rs(['y_hat', 'y'])}, split, mask FROM judged"),
)
def _(spark, d):
    """Forecasts without their targets, joined to the hours they are for."""
    cells = labelled(spark, d)
    preds = judged(spark, d).select("model", DET, "t_idx", "horizon", "y_hat")
    return rounded(forecast.forecast_vs_actual(preds, cells))


@query(
    "week_over_week",
    sql(
        "filled",
        f"""SELECT det_id, t_idx, {r('qkfz')} AS qkfz, {r('lag(qkfz, 168) OVER w')} AS last_week,
        {r('qkfz - lag(qkfz, 168) OVER w')} AS change FROM filled WINDOW w AS (PARTITION BY det_id ORDER BY t_idx)""",
    ),
)
def _(spark, d):
    change = forecast.week_over_week(cleaned(spark, d), "qkfz")
    return rounded(change.select(DET, "t_idx", "qkfz", "last_week", "change"))


# --- evaluation --------------------------------------------------------------


def _metrics_sql(keys: str, where: str = "split = 'test'", source: str = "judged") -> str:
    return f"""SELECT {keys}, count(*) AS n, avg(abs(y_hat - y)) AS mae, sqrt(avg((y_hat - y) * (y_hat - y))) AS rmse,
    avg(CASE WHEN y >= 5 THEN abs((y_hat - y) / y) END) * 100 AS mape
    FROM {source} WHERE mask AND y_hat IS NOT NULL AND {where} GROUP BY {keys}"""


ERR = ["mae", "rmse", "mape"]
view("metrics", ("judged",), _metrics_sql("model, horizon"))


@query(
    "congestion_regime",
    sql(
        "readings",
        "SELECT det_id, utc, CASE WHEN vkfz > 50 THEN 'free_flow' WHEN vkfz <= 50 THEN 'congested' END AS regime FROM readings",
    ),
)
def _(spark, d):
    return evaluate.congestion_regime(fx.readings(spark, d)).select(DET, UTC, "regime")


@query(
    "mape_domain_mask",
    sql("judged", "SELECT model, count(*) FILTER (y >= 5) AS inside, count(*) FILTER (NOT y >= 5) AS outside FROM judged GROUP BY 1"),
)
def _(spark, d):
    inside = evaluate.mape_domain()
    return judged(spark, d).groupBy("model").agg(
        F.count_if(inside).alias("inside"), F.count_if(~inside).alias("outside")
    )


@query(
    "masked_mae",
    sql(
        "judged",
        f"""SELECT model, horizon, {r('coalesce(sum(abs(y_hat - y)) FILTER (mask), 0) / greatest(count(y_hat - y) FILTER (mask), 1)')} AS mae
        FROM judged GROUP BY 1, 2""",
    ),
)
def _(spark, d):
    return rounded(evaluate.masked_mae(judged(spark, d), ["model", "horizon"]))


@query("error_metrics", sql("metrics", f"SELECT model, horizon, n, {rs(ERR)} FROM metrics"))
def _(spark, d):
    return rounded(evaluate.errors_on_test(judged(spark, d)))


ERROR_TABLE = sql(
    "metrics",
    "SELECT model, "
    + ", ".join(f"{r(f'max({m}) FILTER (horizon = {h})')} AS {m}_h{h}" for m in ERR for h in HORIZONS)
    + " FROM metrics GROUP BY model",
)


@query("error_table", ERROR_TABLE)
def _(spark, d):
    return rounded(evaluate.error_table(evaluate.errors_on_test(judged(spark, d))))


@query("baseline_report", ERROR_TABLE)
def _(spark, d):
    return rounded(pipelines.baseline_report(labelled(spark, d), fx.AXIS))


view("sensor_metrics", ("judged",), _metrics_sql("det_id"))


@query(
    "error_by_sensor",
    sql(
        ("sensor_metrics", "locations"),
        f"SELECT s.det_id, n, {rs(['mae', 'lon', 'lat'])} FROM sensor_metrics s LEFT JOIN locations l ON l.det_id = s.det_id",
    ),
)
def _(spark, d):
    return rounded(evaluate.error_by_sensor(judged(spark, d), fx.locations(spark, d)))


view(
    "regime_judged",
    ("judged",),
    "SELECT *, CASE WHEN y > 50 THEN 'free_flow' ELSE 'congested' END AS regime FROM judged",
)
view("regime_metrics", ("regime_judged",), _metrics_sql("model, regime", source="regime_judged"))


@query("error_by_regime", sql("regime_metrics", f"SELECT model, regime, n, {rs(ERR)} FROM regime_metrics"))
def _(spark, d):
    return rounded(evaluate.error_by_regime(judged(spark, d)))


# Three "seeds" of one model: the value one, two or three days before.
view(
    "seeded",
    ("labelled",),
    " UNION ALL ".join(
        f"""SELECT 'days_back' AS model, {s} AS seed, 24 AS horizon, split, mask, vkfz AS y,
        lag(vkfz, {24 * s}) OVER (PARTITION BY det_id ORDER BY t_idx) AS y_hat FROM labelled"""
        for s in (1, 2, 3)
    ),
)
view("seed_metrics", ("seeded",), _metrics_sql("model, horizon, seed", source="seeded"))


def seeded_metrics(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy(DET).orderBy("t_idx")
    runs = F.array(
        *[
            F.struct(F.lit(s).alias("seed"), F.lag("vkfz", 24 * s).over(w).alias("y_hat"))
            for s in (1, 2, 3)
        ]
    )
    preds = labelled(spark, d).select("split", "mask", F.col("vkfz").alias("y"), runs.alias("runs"))
    flat = preds.select(
        F.lit("days_back").alias("model"), F.lit(24).alias("horizon"), "split", "mask", "y", F.inline("runs")
    )
    return evaluate.errors_on_test(flat, ["model", "horizon", "seed"])


@query(
    "seed_summary",
    sql(
        "seed_metrics",
        f"SELECT model, horizon, count(*) AS seeds, {r('avg(mae)')} AS mean, {r('stddev_samp(mae)')} AS std FROM seed_metrics GROUP BY 1, 2",
    ),
)
def _(spark, d):
    return rounded(evaluate.seed_summary(seeded_metrics(spark, d)))


view(
    "paired_t",
    ("judged",),
    """SELECT count(d) AS n, avg(d) AS m, avg(d) / (stddev_samp(d) / sqrt(count(d))) AS t, count(d) - 1 AS df FROM (
         SELECT abs(a.y_hat - a.y) - abs(b.y_hat - b.y) AS d FROM judged a JOIN judged b
         ON a.det_id = b.det_id AND a.t_idx = b.t_idx AND a.horizon = b.horizon
         WHERE a.model = 'ar1' AND b.model = 'last_value' AND a.mask AND a.split = 'test')""",
)
# The probability as one minus the density's integral between -|t| and |t|, by Simpson's rule on 20,000 steps.
view(
    "paired_t_inside",
    ("paired_t",),
    """SELECT 2 * any_value(abs(t)) / 20000 / 3 * exp(any_value(lgamma((df + 1) / 2.0) - lgamma(df / 2.0) - 0.5 * ln(df * pi()))) * sum(
         CASE WHEN i = 0 OR i = 20000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
         * exp(-(df + 1) / 2.0 * ln(1 + pow(t * i / 20000, 2) / df))) AS inside
       FROM paired_t CROSS JOIN range(20001) s(i)""",
)


@query(
    "paired_t_statistic",
    sql(
        ("paired_t", "paired_t_inside"),
        f"""SELECT n, {r('m')} AS mean_difference, {r('t')} AS t, df, {r('greatest(1 - inside, 0)')} AS p
        FROM paired_t CROSS JOIN paired_t_inside""",
    ),
)
def _(spark, d):
    on_test = judged(spark, d).filter("split = 'test'")
    return rounded(evaluate.paired_t_statistic(on_test, "ar1", "last_value"))


_LONG = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {c} AS v, split FROM labelled WHERE mask AND split IN ('train', 'test')" for c in T6
)
view("drift_long", ("labelled",), _LONG)
view(
    "drift_edges",
    ("drift_long",),
    """SELECT feature, quantile_cont(v, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges, count(*) AS n_train
       FROM drift_long WHERE split = 'train' GROUP BY 1""",
)
view(
    "drift_sizes",
    ("drift_long",),
    "SELECT feature, count(*) FILTER (split = 'train') AS a, count(*) FILTER (split = 'test') AS b FROM drift_long GROUP BY 1",
)
view(
    "drift_bins",
    ("drift_long", "drift_edges"),
    """SELECT l.feature, len(list_filter(edges, lambda e: e < v)) AS bin,
       count(*) FILTER (split = 'train') AS p, count(*) FILTER (split = 'test') AS q
       FROM drift_long l JOIN drift_edges e ON e.feature = l.feature GROUP BY 1, 2""",
)
view(
    "drift_cum",
    ("drift_long",),
    """SELECT feature, v, sum(p) OVER w AS cp, sum(q) OVER w AS cq FROM (
         SELECT feature, v, count(*) FILTER (split = 'train') AS p, count(*) FILTER (split = 'test') AS q
         FROM drift_long GROUP BY 1, 2) WINDOW w AS (PARTITION BY feature ORDER BY v)""",
)


@query(
    "feature_drift",
    sql(
        ("drift_sizes", "drift_bins", "drift_cum"),
        f"""SELECT s.feature, {r('any_value(psi)')} AS psi, {r('max(abs(cp / a - cq / b))')} AS ks
        FROM drift_sizes s
        JOIN (SELECT f.feature, sum((greatest(coalesce(q, 0) / b, 1e-6) - greatest(coalesce(p, 0) / a, 1e-6))
                * ln(greatest(coalesce(q, 0) / b, 1e-6) / greatest(coalesce(p, 0) / a, 1e-6))) AS psi
              FROM drift_sizes f CROSS JOIN range(10) n(i) LEFT JOIN drift_bins d ON d.feature = f.feature AND d.bin = n.i
              GROUP BY 1) x ON x.feature = s.feature
        JOIN drift_cum c ON c.feature = s.feature GROUP BY 1""",
    ),
)
def _(spark, d):
    valid = materialize(labelled(spark, d).filter("mask"), "valid")
    return rounded(evaluate.feature_drift(valid.filter("split = 'train'"), valid.filter("split = 'test'")))


view("model_mae", ("judged",), _metrics_sql("model"))


@query(
    "promotion_gate",
    sql(
        "model_mae",
        f"""SELECT {r("max(mae) FILTER (model = 'last_value')")} AS champion_mae, {r("max(mae) FILTER (model = 'ar1')")} AS challenger_mae,
        max(mae) FILTER (model = 'ar1') <= max(mae) FILTER (model = 'last_value') * 0.98 AS promote FROM model_mae""",
    ),
)
def _(spark, d):
    metrics = evaluate.errors_on_test(judged(spark, d), ["model"])
    return rounded(evaluate.promotion_gate(metrics, "last_value", "ar1"))
