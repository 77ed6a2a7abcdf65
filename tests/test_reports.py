from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadpulse.operators import context, eda, evaluate, forecast


@pytest.fixture
def cells_of(spark):
    def make(values, split=None, mask=None, det="A"):
        rows = [
            (det, t, (split or {}).get(t, "train"), True if mask is None else mask[t], float(v))
            for t, v in enumerate(values)
        ]
        df = spark.createDataFrame(rows, "det_id string, t_idx int, split string, mask boolean, vkfz double")
        return df.withColumn("utc", F.timestamp_add("HOUR", F.col("t_idx"), F.lit("2023-01-02").cast("timestamp_ntz")))

    return make


def test_window_samples_count(cells_of):
    assert forecast.window_samples(cells_of(range(24)), ["vkfz"]).count() == 1
    assert forecast.window_samples(cells_of(range(40)), ["vkfz"]).count() == 40 - 23
    assert forecast.window_samples(cells_of(range(23)), ["vkfz"]).count() == 0


def test_window_samples_content(cells_of):
    split = {t: "test" for t in range(6, 12)}
    out = forecast.window_samples(cells_of(range(12), split), ["vkfz"], past=2, ahead=3).orderBy("t0").collect()
    assert [(r.split, r.t0) for r in out] == [("train", 0), ("train", 1), ("test", 6), ("test", 7)]
    assert out[0].x_in == [[0.0], [1.0]] and out[0].y == [2.0, 3.0, 4.0] and out[0].y_mask == [True] * 3


def test_horizon_targets(cells_of):
    out = forecast.horizon_targets(cells_of(range(5), mask=[True, True, True, False, True]), horizons=(1, 3)).orderBy("t_idx")
    assert [(r.y_1, r.mask_1, r.y_3, r.mask_3) for r in out.collect()] == [
        (1, True, 3, False), (2, True, 4, True), (3, False, None, None), (4, True, None, None), (None,) * 4]


def test_last_value_and_hour_of_week(cells_of):
    split = {t: "test" for t in range(168, 336)}
    cells = cells_of([t % 168 for t in range(336)], split)
    out = forecast.naive_forecasts(cells, 336, horizons=(3,), models=("last_value", "hour_of_week"))
    test = out.filter("split = 'test'")
    assert test.filter("model = 'hour_of_week' AND y_hat <> y").count() == 0
    row = test.filter("model = 'last_value' AND t_idx = 200").first()
    assert (row.y_hat, row.y) == (197 % 168, 200 % 168)
    assert out.filter("model = 'last_value'").count() == 333


def test_ar1_closed_form(cells_of):
    a, b, y = 4.0, 0.5, [1.0]
    for _ in range(39):
        y.append(a + b * y[-1])
    got = forecast.baseline_ar1(cells_of(y), 40, horizons=(1, 6)).collect()
    for r in got:
        assert r.y_hat == pytest.approx(y[r.t_idx])
    line = forecast.baseline_ar1(cells_of(range(10)), 10, horizons=(3,)).filter("t_idx = 5").first()
    assert line.y_hat == pytest.approx(5.0)


def test_ar1_of_a_constant_series_has_no_forecast(cells_of):
    got = forecast.baseline_ar1(cells_of([5.0] * 10), 10, horizons=(1,)).collect()
    assert len(got) == 9 and all(r.y_hat is None for r in got)


def test_ar1_fits_training_hours_only(cells_of):
    y = [1.0, 2.0, 4.0, 8.0, 16.0, 3.0, 5.0, 3.0]
    split = {t: "test" for t in (5, 6, 7)}
    row = forecast.baseline_ar1(cells_of(y, split), 8, horizons=(1,)).filter("t_idx = 7").first()
    assert row.y_hat == pytest.approx(10.0)


def test_week_over_week_and_slice(cells_of):
    out = forecast.week_over_week(cells_of(range(170)), "vkfz").filter("t_idx = 169").first()
    assert (out.last_week, out.change) == (1.0, 168.0)
    part = forecast.historical_slice(cells_of(range(10)), ["A"], datetime(2023, 1, 2, 3), datetime(2023, 1, 2, 5))
    assert sorted(r.t_idx for r in part.collect()) == [3, 4]


def errors_of(spark, rows):
    return spark.createDataFrame(rows, "y_hat double, y double, mask boolean")


def test_masked_mae(spark):
    rows = [(1.0, 0.0, True), (-3.0, 0.0, True), (9.0, 0.0, False)]
    assert evaluate.masked_mae(errors_of(spark, rows)).first().mae == 2
    assert evaluate.masked_mae(errors_of(spark, [(a, b, False) for a, b, _ in rows])).first().mae == 0


def test_error_metrics(spark):
    row = evaluate.error_metrics(errors_of(spark, [(9.0, 10.0, True), (4.0, 3.0, True)]), []).first()
    assert (row.n, row.mae, row.rmse, round(row.mape, 9)) == (2, 1, 1, 10)


def test_error_table_and_seeds(spark):
    rows = [("m", h, 1.0 * h, 2.0, 3.0) for h in (3, 6, 12)]
    df = spark.createDataFrame(rows, "model string, horizon int, mae double, rmse double, mape double")
    row = evaluate.error_table(df).first()
    assert (row.mae_h3, row.mae_h6, row.mae_h12, row.rmse_h3, row.mape_h12) == (3, 6, 12, 2, 3)
    seeds = spark.createDataFrame([("m", 3, 1.0), ("m", 3, 2.0), ("m", 3, 3.0)], "model string, horizon int, mae double")
    assert tuple(evaluate.seed_summary(seeds).first()) == ("m", 3, 3, 2.0, 1.0)


def test_regimes(spark):
    df = spark.createDataFrame([(50.0,), (50.1,), (None,)], "vkfz double")
    assert [r.regime for r in evaluate.congestion_regime(df).collect()] == ["congested", "free_flow", None]


def test_paired_t(spark):
    a, b = [1.0, 2.0, 4.0, 3.0], [2.0, 4.0, 4.5, 6.0]
    rows = [(m, "A", t, 3, v, 0.0, True) for m, vs in (("a", a), ("b", b)) for t, v in enumerate(vs)]
    rows.append(("a", "A", 99, 3, 5.0, 0.0, True))  # only one of them predicts this hour
    df = spark.createDataFrame(rows, "model string, det_id string, t_idx int, horizon int, y_hat double, y double, mask boolean")
    row = evaluate.paired_t_statistic(df, "a", "b").first()
    d = np.array(a) - np.array(b)
    assert (row.n, row.df) == (4, 3) and row.t == pytest.approx(d.mean() / (d.std(ddof=1) / 2))


def test_promotion_gate(spark):
    def promote(new):
        df = spark.createDataFrame([("old", 10.0), ("new", new)], "model string, mae double")
        return evaluate.promotion_gate(df, "old", "new").first().promote

    assert promote(9.8) and not promote(9.81)
    alone = spark.createDataFrame([("old", 10.0)], "model string, mae double")
    assert evaluate.promotion_gate(alone, "old", "new").first().promote is False


def test_feature_drift_against_numpy(spark):
    rng = np.random.default_rng(5)
    p = np.where(rng.random(400) < 0.35, 10.0, rng.normal(0, 5, 400))
    q = rng.normal(2, 6, 300)
    train = spark.createDataFrame([(float(x),) for x in p], "v double")
    new = spark.createDataFrame([(float(x),) for x in q], "v double")
    row = evaluate.feature_drift(train, new, ["v"]).first()
    edges = np.quantile(p, np.arange(1, 10) / 10)

    def share(x):
        return np.maximum(np.bincount(np.searchsorted(edges, x, side="left"), minlength=10) / len(x), 1e-6)

    psi = ((share(q) - share(p)) * np.log(share(q) / share(p))).sum()
    grid = np.sort(np.concatenate([p, q]))
    ks = max(abs((p <= g).mean() - (q <= g).mean()) for g in grid)
    assert row.psi == pytest.approx(psi) and row.ks == pytest.approx(ks)
    nothing = evaluate.feature_drift(train, new.filter("v > 1e9"), ["v"]).first()
    assert nothing.psi is None and nothing.ks is None
    same = evaluate.feature_drift(train, train, ["v"]).first()
    assert same.psi == pytest.approx(0) and same.ks == pytest.approx(0)


def test_describe_matches_pandas(spark):
    import pandas as pd

    data = pd.DataFrame({"a": [1.0, 2.0, 2.0, 9.0], "b": [None, 5.0, 1.0, 0.5]})
    df = spark.createDataFrame([tuple(None if pd.isna(x) else float(x) for x in r) for r in data.to_numpy()], "a double, b double")
    got = {r.feature: r for r in eda.describe_numeric(df, ["a", "b"]).collect()}
    for c in ("a", "b"):
        want = data[c].describe()
        assert [got[c].n, got[c].mean, got[c].std, got[c].min, got[c].q25, got[c].q50, got[c].q75, got[c].max] == pytest.approx(list(want))


def test_sampling_interval(spark):
    at = [datetime(2023, 1, 1, 22), datetime(2023, 1, 1, 23), datetime(2023, 1, 2, 0), datetime(2023, 1, 2, 0),
          datetime(2023, 1, 2, 0, 30), datetime(2023, 1, 5, 0, 30), datetime(2023, 1, 5, 1)]
    df = spark.createDataFrame([("A", t) for t in at], "det_id string, utc timestamp_ntz")
    row = eda.sampling_interval(df).first()
    assert (row.step_minutes, row.steps) == (30.0, 2)  # two steps of 30 and two of 60 minutes


def test_siblings(spark):
    base = datetime(2023, 1, 1)
    rows = []
    for h in range(4):
        t = base.replace(hour=h)
        rows += [("TEU00001_Det0", t, float(h), 50.0), ("TEU00001_Det1", t, 2.0 * h, 50.0 + h), ("TEU00002_Det0", t, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "det_id string, utc timestamp_ntz, qkfz double, vkfz double")
    pairs = eda.sibling_pairs(df)
    assert pairs.count() == 4 and {r.site_id for r in pairs.collect()} == {"TEU00001"}
    row = eda.sibling_correlation(pairs).first()
    assert row.r_qkfz == pytest.approx(1.0) and row.r_vkfz is None and row.n_qkfz == 4
    few = eda.sibling_correlation(pairs.limit(2)).first()
    assert few.r_qkfz is None


def test_every_two_detectors_of_a_site_are_siblings(spark):
    names = ["TEU1_Det0", "TEU1_Det1", "TEU1_Det2", "TEU12_Det0", "TEU12_Det1", "TEU2_Det0"]
    ids = spark.createDataFrame([(n,) for n in names], "det_id string")
    got = {(r.det_a, r.det_b) for r in eda.sibling_detectors(ids).collect()}
    own = {("TEU1_Det0", "TEU1_Det1"), ("TEU1_Det0", "TEU1_Det2"), ("TEU1_Det1", "TEU1_Det2")}
    assert got == own | {("TEU12_Det0", "TEU12_Det1")}


def test_sites_and_first_rows(spark):
    ids = spark.createDataFrame([("TEU00001_Det0",), ("TEU00001_Det1",), ("TEU00002_Det0",)], "det_id string")
    got = {r.site_id: r.detectors for r in eda.detectors_per_site(ids).collect()}
    assert got == {"TEU00001": 2.0, "TEU00002": 1.0, None: 1.5}
    assert [tuple(r) for r in eda.first_failures(ids, 2).collect()] == [("TEU00001_Det0", 3), ("TEU00001_Det1", 3)]
    columns = eda.profile_columns(ids).first()
    assert tuple(columns) == (0, "det_id", "string", 3)


def test_relevant_events_against_brute_force(spark):
    rng = np.random.default_rng(2)
    base = datetime(2023, 1, 1)
    from datetime import timedelta

    events = []
    for i in range(150):
        at = base + timedelta(minutes=int(rng.integers(0, 3000))) if i % 3 else base + timedelta(hours=5)
        place = rng.uniform(0, 9000, 2) if i % 3 else np.array([3000.0, 3000.0])  # a third at one time and place
        end = at + timedelta(minutes=int(rng.integers(0, 900))) if i % 10 else None
        events.append((i, at, end, *map(float, place)))
    asked = [(f"q{j}", base + timedelta(hours=int(rng.integers(0, 60))), *map(float, rng.uniform(0, 9000, 2))) for j in range(25)]
    e = spark.createDataFrame(events, "event_id long, start_utc timestamp_ntz, end_utc timestamp_ntz, x double, y double")
    q = spark.createDataFrame(asked, "q_id string, utc timestamp_ntz, x double, y double")
    got = {}
    for r in context.relevant_events(q, e, hours=3, radius=2000.0, k=4).collect():
        got.setdefault(r.q_id, {})[r["rank"]] = r.event_id
    reach = timedelta(hours=3)
    for name, t, x, y in asked:
        near = sorted(
            (((x - ex) ** 2 + (y - ey) ** 2) ** 0.5, i)
            for i, s, f, ex, ey in events
            if s - reach <= t and (f is None or t <= f + reach) and ((x - ex) ** 2 + (y - ey) ** 2) ** 0.5 <= 2000
        )[:4]
        assert got.get(name, {}) == {n: i for n, (_, i) in enumerate(near, 1)}


@pytest.mark.parametrize("small", [True, False])
def test_embedding_topk_against_numpy(spark, small, monkeypatch):
    if small:
        monkeypatch.setattr(context, "QUERY_BLOCK", 5)
        monkeypatch.setattr(context, "VECTOR_BLOCK", 20)
    rng = np.random.default_rng(4)
    v, q = rng.normal(size=(90, 8)), rng.normal(size=(12, 8))
    v[5] = v[17]  # a tie
    vectors = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)], "vec_id long, embedding array<float>")
    queries = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(q)], "q_id long, embedding array<double>")
    got = {}
    for r in context.embedding_topk(queries, vectors, 7).collect():
        got.setdefault(r.q_id, {})[r["rank"]] = r.vec_id
    v32 = v.astype(np.float32).astype(float)
    s = (q / np.linalg.norm(q, axis=1, keepdims=True)) @ (v32 / np.linalg.norm(v32, axis=1, keepdims=True)).T
    for i in range(12):
        want = sorted(range(90), key=lambda j: (-round(s[i, j], 12), j))[:7]
        assert got[i] == {n: j for n, j in enumerate(want, 1)}
