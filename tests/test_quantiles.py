"""Exact quantiles and comparisons from sketches, against numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadpulse.operators import eda, evaluate, quantiles
from roadpulse.operators.quantiles import Cells, bracket_shares, cell_counts, located, sketch_columns, sketches_of

N = 120_000


@pytest.fixture(scope="module")
def table(spark):
    """Spread values, a value that a third of the rows hold, few distinct values, mostly nulls, and integers beyond their bracket."""
    x = F.rand(3)
    df = spark.range(0, N, 1, 6).select(
        (F.randn(5) * 100).alias("spread"),
        F.when(x < 0.34, 7.5).otherwise(F.rand(9) * 20).alias("hot"),
        F.floor(F.rand(11) * 4).alias("few"),
        F.when(F.col("id") % 1000 == 0, F.rand(13)).alias("rare"),
        F.when(x < 0, 1.0).alias("none"),
        F.when(F.col("id") == 5, float("nan")).otherwise(F.col("id") - 60_000.0).alias("nan"),
    )
    return df.cache()


def quantiles_of(df, cols, probs):
    row = df.agg(*sketch_columns(cols, bracket_shares(probs))).first()
    return located(df, sketches_of(row, cols), probs)


def test_quantiles_are_exact_beyond_the_sketch(table):
    probs = [0.0, 0.0001, 0.1, 0.25, 0.333, 0.5, 0.75, 0.999, 1.0]
    cols = ["spread", "hot", "few", "rare"]
    found, counted, cells = quantiles_of(table, cols, probs)
    frame = table.toPandas()
    for c in cols:
        want = np.quantile(frame[c].dropna().to_numpy(float), probs)
        assert [found[c, p] for p in probs] == pytest.approx(list(want), rel=1e-12), c
    # Only a few thousandths of the spread values were counted one by one.
    by_value = counted.filter("feature = 'spread' AND value IS NOT NULL").agg(F.sum("n")).first()[0]
    assert by_value < N * 4 * len(probs) / quantiles.SKETCH * 1.5


def test_columns_with_nan_and_without_values(table):
    found, _, _ = quantiles_of(table, ["nan", "none"], [0.5, 1.0])
    values = sorted(i - 60_000.0 for i in range(N) if i != 5)
    assert found["nan", 0.5] == (values[N // 2 - 1] + values[N // 2]) / 2 and math.isnan(found["nan", 1.0])
    assert ("none", 0.5) not in found


def test_a_sketch_that_missed_is_noticed(table, monkeypatch):
    monkeypatch.setattr(quantiles.Sketch, "bracket", lambda self, p: (0.0, 0.5))
    found, _, _ = quantiles_of(table, ["spread"], [0.1, 0.9])
    assert [found["spread", p] for p in (0.1, 0.9)] == pytest.approx(list(np.quantile(table.toPandas()["spread"], [0.1, 0.9])))


def test_many_counted_values_are_ordered_in_ranges(table, monkeypatch):
    monkeypatch.setattr(quantiles, "ORDERED_ROWS", 10)
    found, _, _ = quantiles_of(table, ["spread"], [0.5])
    assert found["spread", 0.5] == pytest.approx(np.quantile(table.toPandas()["spread"], 0.5))


def test_no_row_is_shuffled(spark, table, tmp_path):
    """What goes through the exchange are sums by task: at most cells and open values, far fewer than the rows."""
    table.write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    counted = cell_counts(df, {"spread": Cells.of([], [(-0.5, 0.5)])})
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "MapInArrow" in plan
    assert plan.index("Exchange hashpartitioning") < plan.index("MapInArrow")  # the map is below the exchange
    assert "Generate" not in plan and "Expand" not in plan
    rows = counted.agg(F.count(F.lit(1)), F.sum("n")).first()
    assert rows[1] == N and rows[0] < N / 100


@pytest.mark.parametrize(
    "cuts, intervals, edges, opened",
    [
        ([1.0, 2.0], [], [1.0, 2.0], [0, 0, 0]),
        ([], [(-math.inf, math.inf)], [], [1]),
        ([5.0], [(1.0, 2.0)], [np.nextafter(1.0, -math.inf), 2.0, 5.0], [0, 1, 0, 0]),
        ([1.5], [(1.0, 2.0), (1.2, 3.0)], None, [0, 1, 1, 1, 1, 0]),
    ],
)
def test_cells(cuts, intervals, edges, opened):
    cells = Cells.of(cuts, intervals)
    assert cells.open.tolist() == [bool(o) for o in opened] and (edges is None or cells.cuts.tolist() == edges)


def test_describe_beyond_the_sketch(table):
    frame = table.select("spread", "hot", F.col("few").cast("double"), "none").toPandas()
    for r in eda.describe_numeric(table, ["spread", "hot", "few", "none"]).collect():
        want = frame[r.feature].describe()
        assert r.n == want["count"]
        if r.n:
            got = [r["mean"], r["std"], r["min"], r.q25, r.q50, r.q75, r["max"]]
            assert got == pytest.approx([want[s] for s in ("mean", "std", "min", "25%", "50%", "75%", "max")], rel=1e-9)
        else:
            assert r.q50 is None and r["min"] is None


def test_drift_beyond_the_sketch(spark, table):
    new = table.sample(0.5, seed=4).withColumns({"spread": F.col("spread") * 1.1 + 3, "hot": F.when(F.col("hot") == 7.5, 7.6).otherwise(F.col("hot"))})
    cols = ["spread", "hot", "few", "rare"]
    got = {r.feature: r for r in evaluate.feature_drift(table, new, cols).collect()}
    a, b = table.toPandas(), new.toPandas()
    for c in cols:
        x, y = np.sort(a[c].dropna().to_numpy(float)), np.sort(b[c].dropna().to_numpy(float))
        at = np.union1d(x, y)
        ks = np.abs(np.searchsorted(x, at, "right") / len(x) - np.searchsorted(y, at, "right") / len(y)).max()
        edges = np.quantile(x, [i / 10 for i in range(1, 10)])
        p, q = (np.maximum(np.bincount(np.searchsorted(edges, v, "left"), minlength=10) / len(v), 1e-6) for v in (x, y))
        assert got[c].ks == pytest.approx(ks, rel=1e-9) and got[c].psi == pytest.approx(((q - p) * np.log(q / p)).sum(), rel=1e-6), c
    nothing = evaluate.feature_drift(table, table.limit(0), ["spread", "none"]).collect()
    assert [(r.feature, r.psi, r.ks) for r in nothing] == [("spread", None, None)]
