"""Retrieval of context for a forecast: events near a time and place, and similar vectors."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.functions.geo import distance
from roadpulse.operators.intervals import cover, holders
from roadpulse.operators.skew import salted_join
from roadpulse.session import materialize

QUERY_BLOCK = 512
VECTOR_BLOCK = 4_096


def relevant_events(
    queries: DataFrame, events: DataFrame, hours: int = 3, radius: float = 2000.0, k: int = 5
) -> DataFrame:
    """The k nearest events of each query within a radius and a time window, ties by event id.

    `queries` (q_id, utc, x, y); `events` (event_id, start_utc, end_utc, x, y). An event matches when
    it overlaps [utc - hours, utc + hours]; one without an end is still going on, one without a start matches nothing.

    The matches themselves, events times queries, are never listed. The distinct times of the queries are numbered in order, hour by hour, so an
    event matches an interval of numbers, which is tiled by aligned blocks (`intervals`): a few rows for a year as for an hour. Events of one place and block match
    the same queries at the same distance, so only their k smallest ids can be among the k best of any. These heads meet the distinct
    (time, place) of the queries on (level, block, grid cell), the head in the nine cells around it, the query in its own and one block of each level. As a
    head has an event, the k nearest heads hold the k nearest events; they are found once for all queries of one time and place. Hot keys are split.
    """

    def hour(ts):
        day = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("long")
        return day * 24 + F.hour(ts)

    def cell(coordinate):
        return F.floor(F.col(coordinate) / radius)

    points = materialize(queries.select("utc", "x", "y").dropna().distinct(), "points")
    times = points.groupBy(hour(F.col("utc")).alias("hour")).agg(F.array_sort(F.collect_set("utc")).alias("times"))
    times = materialize(times, "times")
    # Each hour has as many numbers as the fullest one has times.
    span = times.agg(F.max(F.size("times")).alias("n"), F.min("hour").alias("first"), F.max("hour").alias("last")).first()
    n, begin, finish = F.lit(span["n"] or 1), F.lit(span["first"]).cast("long"), F.lit(span["last"]).cast("long")

    def numbered(df: DataFrame, ts: str, until) -> DataFrame:
        """`df` and the number of the first time of the queries' that is not `until(time, ts)`."""
        of = times.select(F.col("hour").alias("_hour"), F.col("times").alias("_times"))
        met = df.withColumn("_hour", hour(F.col(ts))).join(of, "_hour", "left")
        within = F.when(F.col("_times").isNull(), 0).otherwise(F.size(F.filter("_times", lambda t: until(t, F.col(ts)))))
        return met.withColumn(f"{ts}_no", F.col("_hour") * n + within).drop("_hour", "_times")

    first = F.timestamp_add("HOUR", F.lit(-hours), F.col("start_utc"))
    last = F.timestamp_add("HOUR", F.lit(hours), F.col("end_utc"))
    within = events.filter(F.col("start_utc").isNotNull() & F.col("x").isNotNull() & F.col("y").isNotNull())
    within = within.select("event_id", "x", "y", first.alias("first"), last.alias("last"))
    within = numbered(numbered(within, "first", lambda t, own: t < own), "last", lambda t, own: t <= own)
    tiles = cover(F.greatest("first_no", begin * n), F.least(F.col("last_no") - 1, (finish + 1) * n - 1))
    w = Window.partitionBy("x", "y", "level", "block").orderBy("event_id")
    tiled = within.select("event_id", "x", "y", F.inline(tiles)).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    ids = F.struct("event_id")  # a null id is an id too, and the smallest
    heads = tiled.groupBy("x", "y", "level", "block").agg(F.collect_list(ids).alias("ids"), F.min(ids).alias("least"))
    heads = materialize(heads, "heads")
    levels = heads.agg(F.collect_set("level")).scalar()

    q = numbered(points, "utc", lambda t, own: t < own).withColumn("levels", levels).select(
        "utc",
        F.col("x").alias("qx"),
        F.col("y").alias("qy"),
        cell("x").alias("cx"),
        cell("y").alias("cy"),
        F.inline(holders(F.col("utc_no"), F.col("levels"))),
    )
    around = F.sequence(F.lit(-1), F.lit(1))
    e = (
        heads.withColumn("dx", F.explode(around))
        .withColumn("dy", F.explode(around))
        .select(
            "ids",
            "least",
            F.col("x").alias("ex"),
            F.col("y").alias("ey"),
            (cell("x") + F.col("dx")).alias("cx"),
            (cell("y") + F.col("dy")).alias("cy"),
            "level",
            "block",
        )
    )
    d = distance(F.col("qx"), F.col("qy"), F.col("ex"), F.col("ey"))
    near = salted_join(q, e, ["level", "block", "cx", "cy"]).withColumn("dist_m", d).filter(F.col("dist_m") <= radius)
    w = Window.partitionBy("utc", "qx", "qy").orderBy("dist_m", "least")
    nearest = near.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    matches = F.transform("ids", lambda i: F.struct(F.col("dist_m").alias("dist_m"), i["event_id"].alias("event_id")))
    best = F.slice(F.array_sort(F.flatten(F.collect_list(matches))), 1, k)
    answers = nearest.groupBy(F.col("utc"), F.col("qx").alias("x"), F.col("qy").alias("y")).agg(best.alias("best"))
    answers = materialize(answers, "answers")

    found = salted_join(queries, answers, ["utc", "x", "y"], right_is_even=True).select("q_id", F.inline("best"))
    # An id that several queries have gets the k best of them all.
    w = Window.partitionBy("q_id").orderBy("dist_m", "event_id")
    return (
        found.withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= k)
        .select("q_id", "event_id", "dist_m", "rank")
    )


_SCORES = T.StructType(
    [
        T.StructField("q_id", T.LongType()),
        T.StructField("vec_id", T.LongType()),
        T.StructField("score", T.DoubleType()),
    ]
)


def _block_scorer(k: int):
    """Cosine of every query with every vector of a block; only the k best per query leave it."""

    def unit(rows) -> np.ndarray:
        m = np.stack([np.asarray(r, dtype=np.float64) for r in rows])
        length = np.linalg.norm(m, axis=1, keepdims=True)
        return np.divide(m, length, out=np.zeros_like(m), where=length > 0)

    def score(q_ids: np.ndarray, q_unit: np.ndarray, v_ids: np.ndarray, v_unit: np.ndarray) -> pd.DataFrame:
        s = q_unit @ v_unit.T
        kept = min(k, s.shape[1])
        # Ties to the smaller id: order by (-score, id), stable.
        by_id = np.argsort(v_ids, kind="stable")
        top = by_id[np.argsort(-s[:, by_id], axis=1, kind="stable")[:, :kept]]
        return pd.DataFrame(
            {
                "q_id": np.repeat(q_ids, kept),
                "vec_id": v_ids[top].ravel(),
                "score": np.take_along_axis(s, top, axis=1).ravel(),
            }
        )

    return unit, score


def embedding_topk(queries: DataFrame, vectors: DataFrame, k: int = 5) -> DataFrame:
    """(q_id, vec_id, score, rank): the k vectors of highest cosine per query, ties by id.

    `queries` (q_id, embedding), `vectors` (vec_id, embedding). Both are cut into blocks; each two blocks meet under a key of their own
    and hand on the k best per query, so a task holds two blocks whatever the sizes.
    """
    unit, score = _block_scorer(k)

    def blocks(df: DataFrame, id_col: str, size: int) -> tuple[DataFrame, Column]:
        n = df.agg(F.greatest(F.ceil(F.count(F.lit(1)) / size), F.lit(1)).cast("int")).scalar()
        cut = (
            df.withColumn("_n", n)
            .groupBy(F.pmod(F.xxhash64(id_col), F.col("_n")).cast("int").alias("block"), "_n")
            .agg(F.collect_list(F.struct(F.col(id_col).cast("long").alias("id"), "embedding")).alias("p"))
        )
        return cut, n

    q, q_count = blocks(queries, "q_id", QUERY_BLOCK)
    v, v_count = blocks(vectors, "vec_id", VECTOR_BLOCK)
    q = q.select(F.col("block").alias("q_block"), F.explode(F.sequence(F.lit(0), v_count - 1)).alias("v_block"), F.col("p").alias("q"))
    v = v.select(F.explode(F.sequence(F.lit(0), q_count - 1)).alias("q_block"), F.col("block").alias("v_block"), F.col("p").alias("v"))
    tiles = q.join(v, ["q_block", "v_block"]).select(
        F.col("q.id").alias("q_ids"), F.col("q.embedding").alias("q_vecs"), F.col("v.id").alias("v_ids"), F.col("v.embedding").alias("v_vecs")
    )

    def scan(batches):
        for batch in batches:
            for row in batch.itertuples(index=False):
                yield score(np.asarray(row.q_ids), unit(row.q_vecs), np.asarray(row.v_ids), unit(row.v_vecs))

    w = Window.partitionBy("q_id").orderBy(F.desc("score"), F.asc("vec_id"))
    scored = tiles.mapInPandas(scan, _SCORES)
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
