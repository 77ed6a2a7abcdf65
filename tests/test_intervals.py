"""Aligned blocks of intervals, the events found by them, and the probability of a paired test."""

import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from roadpulse.functions.stats import t_two_sided
from roadpulse.operators import context, evaluate
from roadpulse.operators.intervals import cover, holders


def test_blocks_tile_every_interval_once(spark):
    pairs = [(a, b) for a in range(-9, 10) for b in range(a - 2, 18)] + [(0, 2**40 - 1), (-1, 2**33), (None, 3), (3, None)]
    df = spark.createDataFrame(pairs, "a long, b long").withColumn("tiles", cover(F.col("a"), F.col("b")))
    for r in df.collect():
        if r.a is None or r.b is None:
            assert r.tiles is None
            continue
        tiles = sorted((t.block << t.level, (t.block + 1) << t.level) for t in r.tiles)
        assert len(tiles) <= 2 * max(1, math.ceil(math.log2(max(1, r.b - r.a + 1))) + 1)
        at = r.a
        for lo, hi in tiles:
            assert lo == at
            at = hi
        assert at == max(r.a, r.b + 1)


def test_a_number_meets_its_interval_once(spark):
    numbers = spark.range(-40, 40).select(F.col("id").alias("n"), F.inline(holders(F.col("id"), F.sequence(F.lit(0), F.lit(8)))))
    spans = spark.createDataFrame([(-17, 23), (5, 5), (-40, 39), (4, 3)], "a long, b long")
    tiles = spans.select("a", "b", F.inline(cover(F.col("a"), F.col("b"))))
    got = sorted(tuple(r) for r in numbers.join(tiles, ["level", "block"]).select("a", "b", "n").collect())
    assert got == sorted((a, b, n) for a, b in ((-17, 23), (5, 5), (-40, 39)) for n in range(a, b + 1))


EVENTS = "event_id long, start_utc timestamp_ntz, end_utc timestamp_ntz, x double, y double"
ASKED = "q_id string, utc timestamp_ntz, x double, y double"


def events_and_questions(spark):
    start = datetime(1968, 1, 1)
    day = timedelta(days=1)
    events = [
        (0, start, start + 900 * day, 100.0, 100.0),  # over two years, and over 1970
        (1, start + 30 * day, None, 150.0, 100.0),  # still going on
        (2, start + 400 * day, start + 400 * day, 200.0, -100.0),
        (3, None, start + 900 * day, 100.0, 100.0),  # no start: never found
        (4, start, start + 900 * day, None, 100.0),
        (5, start - 900 * day, start - 800 * day, 100.0, 100.0),  # before every question
        (6, start, start + 900 * day, 5000.0, 100.0),
    ]
    asked = [(f"q{n}", start + timedelta(hours=37 * n), 100.0, 100.0) for n in range(0, 600, 7)]
    asked += [("edge", start + 400 * day + timedelta(hours=3), 100.0, 100.0), ("no time", None, 100.0, 100.0), ("no place", start, None, None)]
    return spark.createDataFrame(events, EVENTS), spark.createDataFrame(asked, ASKED), events, asked


def test_long_and_open_events(spark):
    e, q, events, asked = events_and_questions(spark)
    found = context.relevant_events(q, e, hours=3, radius=2000.0, k=2)
    got = {(r.q_id, r["rank"]): r.event_id for r in found.collect()}
    want = {}
    reach = timedelta(hours=3)
    for name, t, x, y in asked:
        if t is None or x is None:
            continue
        near = sorted(
            (math.dist((x, y), (ex, ey)), i)
            for i, s, f, ex, ey in events
            if s and ex and s - reach <= t and (f is None or t <= f + reach) and math.dist((x, y), (ex, ey)) <= 2000
        )[:2]
        want.update({(name, n): i for n, (_, i) in enumerate(near, 1)})
    assert got == want and ("edge", 2) in got


def test_few_rows_an_event_and_the_best_before_the_shuffle(spark):
    e, q, _, _ = events_and_questions(spark)
    rows = e.filter("event_id = 0").select(F.size(cover(F.lit(-2922), F.lit(678))).alias("n")).first().n
    assert rows <= 24  # 3,601 buckets of six hours
    plan = context.relevant_events(q, e)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


def test_events_without_questions(spark):
    e, q, _, _ = events_and_questions(spark)
    assert context.relevant_events(q.limit(0), e).count() == 0
    assert context.relevant_events(q, e.limit(0)).count() == 0


#: Tabulated or closed-form values: t, degrees of freedom, two-sided probability.
KNOWN = [
    (0.0, 7, 1.0),
    (1.0, 1, 0.5),
    (-12.706204736432095, 1, 0.05),
    (math.sqrt(2), 2, 1 - math.sqrt(0.5)),
    (2.2281388519649385, 10, 0.05),
    (2.0422724563012373, 30, 0.05),
    (2.7499956535672250, 30, 0.01),
    (0.6827556, 30, 0.5),
    (1.9599639845400545, 10**9, 0.05),
    (1.0, 10**9, math.erfc(math.sqrt(0.5))),
    (40.0, 10**6, 0.0),
]


def test_probability_of_t(spark):
    df = spark.createDataFrame([(float(t), n, p) for t, n, p in KNOWN], "t double, n long, want double")
    for r in df.withColumn("p", t_two_sided("t", "n")).collect():
        assert r.p == pytest.approx(r.want, abs=1e-7), r
    odd = spark.createDataFrame([(None, 5), (1.0, 0), (1.0, None)], "t double, n long")
    assert [r.p for r in odd.select(t_two_sided("t", "n").alias("p")).collect()] == [None] * 3


def test_paired_test_has_its_probability(spark):
    schema = "model string, det_id string, t_idx int, horizon int, y_hat double, y double, mask boolean"
    rows = [(m, "A", t, 3, v, 0.0, True) for m, vs in (("a", [1.0, 2.0, 4.0]), ("b", [2.0, 4.0, 7.0])) for t, v in enumerate(vs)]
    row = evaluate.paired_t_statistic(spark.createDataFrame(rows, schema), "a", "b").first()
    # Differences -1, -2, -3: t = -2 sqrt(3) with two degrees, whose distribution has a closed form.
    assert row.t == pytest.approx(-math.sqrt(12)) and row.p == pytest.approx(1 - math.sqrt(12 / 14))
    same = [(m, "A", t, 3, v, 0.0, True) for m, v in (("a", 1.0), ("b", 2.0)) for t in range(3)]
    assert evaluate.paired_t_statistic(spark.createDataFrame(same, schema), "a", "b").first().p is None


def brute_context(events, asked, k):
    reach, found = timedelta(hours=3), {}
    for name, t, x, y in asked:
        for i, s, f, ex, ey in events:
            if None not in (t, x, y, s, ex, ey) and s - reach <= t and (f is None or t <= f + reach) and math.dist((x, y), (ex, ey)) <= 2000:
                found.setdefault(name, []).append((math.dist((x, y), (ex, ey)), -1 if i is None else i))
    return {name: sorted(rows)[:k] for name, rows in found.items()}


def test_repeated_and_null_ids_at_any_second(spark):
    import random

    rng, start = random.Random(3), datetime(2023, 3, 1)
    places = [(rng.uniform(-3000, 3000), rng.uniform(-3000, 3000)) for _ in range(6)]
    at = lambda: start + timedelta(seconds=rng.randrange(40 * 3600))
    events = [(rng.choice([None, *range(90)]), s := at(), s + timedelta(minutes=rng.randrange(-500, 900)) if i % 9 else None, *rng.choice(places)) for i in range(250)]
    asked = [(rng.choice([None, *map(str, range(40))]), at(), *rng.choice(places)) for _ in range(120)]
    asked += [asked[0], ("out", start - timedelta(days=9), 0.0, 0.0), ("late", start + timedelta(days=9), 0.0, 0.0)]
    found = context.relevant_events(spark.createDataFrame(asked, ASKED), spark.createDataFrame(events, EVENTS), hours=3, radius=2000.0, k=4)
    got = {}
    for r in found.orderBy("q_id", "rank").collect():
        got.setdefault(r.q_id, []).append((r.dist_m, -1 if r.event_id is None else r.event_id))
    want = brute_context(events, asked, 4)
    assert {n: [i for _, i in rows] for n, rows in got.items()} == {n: [i for _, i in rows] for n, rows in want.items()}
    assert all(a == pytest.approx(b) for n in want for (a, _), (b, _) in zip(got[n], want[n]))


def test_matches_are_not_listed(spark, monkeypatch):
    """300 events and 300 questions at one place and time: 90,000 matches, of which no join makes more than some a question."""
    start = datetime(2023, 3, 1)
    events = [(i, start, start + timedelta(hours=1), 10.0, 10.0) for i in range(300)]
    asked = [(f"q{i}", start, 10.0, 10.0) for i in range(300)]
    made, real = [], context.salted_join

    def spy(*args, **kw):
        made.append(real(*args, **kw))
        return made[-1]

    monkeypatch.setattr(context, "salted_join", spy)
    found = context.relevant_events(spark.createDataFrame(asked, ASKED), spark.createDataFrame(events, EVENTS), k=5)
    assert sorted(map(tuple, found.select("q_id", "rank", "event_id").collect())) == sorted((q, n, n - 1) for q, *_ in asked for n in range(1, 6))
    assert max(df.count() for df in made) <= 5 * len(asked)
