"""Approximate nearest neighbours by vantage-point trees, one a shard, for the largest inner product.

Each vector gets one more component, the square root of M^2 - |x|^2 with M the largest norm, and queries get a zero: then nearer means a
larger inner product, and the triangle inequality holds. Queries are scaled to the norm M, which changes no order and brings them near their finds. A vantage-point tree over a bounded sample cuts space into
shards; every vector goes to the shard it falls in, and each shard has a tree of its own, built in the task that
searches it. A query searches its own shard first. The distance of its k-th find is then what others have to beat: a
branch, or a whole shard, is left out when the least distance that the triangle inequality allows, times `factor`, is beyond
it. A factor of one prunes only what can't matter, so the search is exact; larger factors prune more.

Equal vectors are one entry with its k + 1 smallest ids, so a vector that a third of all rows hold is searched once. Queries
are grouped the same way. Shards hold max(`SHARD_ROWS`, `SHARD_ROOTS` sqrt(n)) vectors and meet their queries in blocks of `QUERY_BLOCK`, so neither a
task nor the number of shards grows as the input.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadpulse.llm.common import Query, stored, table

K = 20
FACTOR = 1.1
SHARD_ROWS = 4096
SHARD_ROOTS = 16
LEAF_ROWS = 128
#: Vectors of the sample for each shard, and of the sample in all, on which the shards' tree is built.
SAMPLE_A_SHARD = 64
MAX_SAMPLE = 65_536
#: Queries that meet a shard in one task.
QUERY_BLOCK = 4096
#: Room for rounding in bounds.
SLACK = 1e-9


class VpTree:
    """Inner nodes hold a vantage point and the median distance to it; leaves hold row numbers."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.vantage, self.radius, self.near, self.far, self.leaves = [], [], [], [], []
        self.root = self._build(points, np.arange(len(points)), leaf)

    def _build(self, points: np.ndarray, rows: np.ndarray, leaf: int) -> int:
        """Number of the node; leaves count down from -1."""
        if len(rows) > leaf:
            own = points[rows]
            vantage = own[int(((own - own.mean(0)) ** 2).sum(1).argmax())]
            distance = np.sqrt(((own - vantage) ** 2).sum(1))
            radius = float(np.partition(distance, (len(rows) - 1) // 2)[(len(rows) - 1) // 2])
            inside = distance <= radius
            if not inside.all():
                node = len(self.vantage)
                self.vantage.append(vantage)
                self.radius.append(radius)
                self.near.append(0)
                self.far.append(0)
                self.near[node] = self._build(points, rows[inside], leaf)
                self.far[node] = self._build(points, rows[~inside], leaf)
                return node
        self.leaves.append(rows)
        return -len(self.leaves)

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        """The leaf each point falls in."""
        out, todo = np.zeros(len(points), np.int64), [(self.root, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            if node < 0:
                out[rows] = -1 - node
            elif len(rows):
                inside = np.sqrt(((points[rows] - self.vantage[node]) ** 2).sum(1)) <= self.radius[node]
                todo += [(self.near[node], rows[inside]), (self.far[node], rows[~inside])]
        return out

    def visit(self, points: np.ndarray, reach: Callable[[np.ndarray], np.ndarray], factor: float, at_leaf: Callable[[int, np.ndarray], None]) -> None:
        """Call `at_leaf(leaf, rows)` with the points that may find something there nearer than `reach(rows)`, all points of a node together."""
        todo = [(self.root, np.arange(len(points)), np.zeros(len(points)))]
        while todo:
            node, rows, least = todo.pop()
            keep = least * factor <= reach(rows) + SLACK
            rows, least = rows[keep], least[keep]
            if not len(rows):
                continue
            if node < 0:
                at_leaf(-1 - node, rows)
                continue
            distance = np.sqrt(((points[rows] - self.vantage[node]) ** 2).sum(1))
            todo.append((self.far[node], rows, np.maximum(least, self.radius[node] - distance)))
            todo.append((self.near[node], rows, np.maximum(least, distance - self.radius[node])))


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in column]) if len(column) else np.zeros((0, 1))


def lifted(x: np.ndarray, largest: float) -> np.ndarray:
    return np.column_stack([x, np.sqrt(np.maximum(0, largest * largest - (x * x).sum(1)))])


def asking(q: np.ndarray, largest: float) -> tuple[np.ndarray, np.ndarray]:
    """Queries as points among the lifted vectors, and what an inner product has to be multiplied by for them."""
    scale = largest / np.sqrt((q * q).sum(1))
    return np.column_stack([q * scale[:, None], np.zeros(len(q))]), scale


def search(x: np.ndarray, order: np.ndarray, q: np.ndarray, reach: np.ndarray, largest: float, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
    """Of the rows of x the k with the largest inner product with each query, as (row or -1, product).

    Ties go to the smaller `order`. `reach` is a distance that finds have to be within.
    """
    tree = VpTree(lifted(x, largest), LEAF_ROWS)
    flat, scale = asking(q, largest)
    rows_, found = np.full((len(q), k), -1), np.full((len(q), k), -np.inf)
    reach = reach.copy()

    def at_leaf(leaf: int, asked: np.ndarray) -> None:
        own = tree.leaves[leaf]
        score = np.concatenate([found[asked], q[asked] @ x[own].T], 1)
        row = np.concatenate([rows_[asked], np.broadcast_to(own, (len(asked), len(own)))], 1)
        # Products that differ by rounding only count as a tie here; they are computed anew below.
        tie = np.where(row < 0, np.iinfo(np.int64).max, order[row])
        best = np.lexsort((tie, -np.round(score, 12)), axis=1)[:, :k]
        found[asked] = np.take_along_axis(score, best, 1)
        rows_[asked] = np.take_along_axis(row, best, 1)
        least = found[asked, -1]
        full = np.isfinite(least)
        distance = np.sqrt(np.maximum(0, 2 * largest * largest - 2 * scale[asked] * np.where(full, least, 0)))
        reach[asked] = np.minimum(reach[asked], np.where(full, distance, np.inf))

    home = tree.leaf_of(flat)
    for leaf in np.unique(home):
        at_leaf(int(leaf), np.flatnonzero(home == leaf))

    def elsewhere(leaf: int, asked: np.ndarray) -> None:
        asked = asked[home[asked] != leaf]
        if len(asked):
            at_leaf(leaf, asked)

    tree.visit(flat, lambda rows: reach[rows], factor, elsewhere)
    exact = np.where(rows_ >= 0, np.einsum("qd,qkd->qk", q, x[rows_]), -np.inf)
    return rows_, exact


def usable(vectors: DataFrame, id: str, vector: str) -> DataFrame:
    """(id, v): rows with an id whose vector has components, all finite, not all zero, and as many as most vectors have."""
    v = F.col(vector).cast("array<double>")
    fine = F.col(id).isNotNull() & v.isNotNull() & (F.size(v) > 0)
    fine &= F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))) & F.exists(v, lambda c: c != 0)
    rows = vectors.filter(fine).select(F.col(id).cast("long").alias("id"), F.transform(v, lambda c: c + F.lit(0.0)).alias("v"))
    sizes = rows.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "n").limit(1).collect()
    return rows.filter(F.size("v") == (sizes[0]["n"] if sizes else 0))


def grouped(rows: DataFrame, most: int) -> DataFrame:
    """Equal vectors as one row: (key, v, ids), key the smallest id and ids the `most` smallest."""
    hashed = rows.distinct().withColumn("h", F.xxhash64("v"))
    ranked = hashed.withColumn("r", F.row_number().over(Window.partitionBy("h", "v").orderBy("id"))).filter(F.col("r") <= most)
    ids = F.sort_array(F.collect_list("id")).alias("ids")
    return ranked.groupBy("h", "v").agg(F.min("id").alias("key"), ids).drop("h")


def nearest(
    vectors: DataFrame, is_query: Column, id: str = "vec_id", vector: str = "embedding", k: int = K, factor: float = FACTOR
) -> DataFrame:
    """One row per query and find: query_id, rank, the id, score. Queries are the usable rows for which `is_query`, over the columns id and v, holds.

    The score is the inner product in double precision; the largest come first, ties by the smaller id. A query's own id is no
    candidate; fewer candidates than k give fewer rows. Vectors that are null, empty, zero or hold null or non-finite components,
    those of another length than most, and rows without an id take no part. Rows that repeat an id with the same vector count once, with another
    vector they are candidates too, but never of that id. Other columns are not read. No rows, no result.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id, vector)
    index = stored(grouped(rows, k + 1), "vectors")
    queries = rows.filter(is_query).select("id", "v").distinct()
    asked = stored(queries.groupBy("v").agg(F.min("id").alias("query")), "queries")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c))
    n, largest = index.agg(F.count(F.lit(1)), F.max(norm)).collect()[0]
    schema = "query long, key long, ids array<long>, score double"
    if not n:
        return spark.createDataFrame([], f"query_id long, rank int, `{id}` long, score double")
    largest = float(largest) * (1 + 1e-12)

    shard_rows = max(SHARD_ROWS, int(SHARD_ROOTS * math.sqrt(n)))
    n_shards = -(-n // shard_rows)
    wanted = min(MAX_SAMPLE, n_shards * SAMPLE_A_SHARD)
    let = int(min(1.0, 2 * wanted / n) * (1 << 30))
    least = F.xxhash64("key", F.lit(1))
    sample = index.filter(F.pmod(least, F.lit(1 << 30)) < let).orderBy(least, "key").limit(wanted).select("v").toPandas()
    router = VpTree(lifted(matrix(sample["v"]), largest), max(1, -(-len(sample) // n_shards))) if n_shards > 1 and len(sample) else None
    sent = spark.sparkContext.broadcast(router)

    @F.pandas_udf("int")
    def shard_of(v: pd.Series) -> pd.Series:
        if sent.value is None:
            return pd.Series(np.zeros(len(v), np.int32))
        return pd.Series(sent.value.leaf_of(lifted(matrix(v), largest)).astype(np.int32))

    @F.pandas_udf("int")
    def home_of(v: pd.Series) -> pd.Series:
        if sent.value is None:
            return pd.Series(np.zeros(len(v), np.int32))
        return pd.Series(sent.value.leaf_of(asking(matrix(v), largest)[0]).astype(np.int32))

    @F.pandas_udf("array<int>")
    def others(v: pd.Series, home: pd.Series, reach: pd.Series) -> pd.Series:
        """Shards, but the own one, that may hold something within reach."""
        q = matrix(v)
        found: list[list[int]] = [[] for _ in range(len(v))]
        own, r = home.to_numpy(), reach.to_numpy(float)

        def at_leaf(leaf: int, rows: np.ndarray) -> None:
            for i in rows.tolist():
                if own[i] != leaf:
                    found[i].append(leaf)

        if sent.value is not None:
            sent.value.visit(asking(q, largest)[0], lambda rows: r[rows], factor, at_leaf)
        return pd.Series(found, dtype=object)

    def in_shard(pdf: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        if not len(pdf) or not len(ask):
            return pd.DataFrame({"query": [], "key": [], "ids": pd.Series([], dtype=object), "score": []})
        pdf, ask = pdf.sort_values("key", ignore_index=True), ask.sort_values("query", ignore_index=True)
        keys = pdf["key"].to_numpy()
        at, score = search(matrix(pdf["v"]), keys, matrix(ask["v"]), ask["reach"].to_numpy(float), largest, k + 1, factor)
        q, c = np.nonzero(at >= 0)
        rows = at[q, c]
        return pd.DataFrame({"query": ask["query"].to_numpy()[q], "key": keys[rows], "ids": pdf["ids"].to_numpy()[rows], "score": score[q, c]})

    located = stored(index.withColumn("shard", shard_of("v")), "shards")
    asked = stored(asked.withColumn("shard", home_of("v")).withColumn("reach", F.lit(float("inf"))), "asked")

    def searched(ask: DataFrame, name: str) -> DataFrame:
        """Finds of the stored queries; a shard meets its queries in blocks, so no task holds more than a shard and a block."""

        def counted(name: str) -> DataFrame:
            return ask.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).cast("int").alias(name))

        copied = located.join(counted("copies"), "shard").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
        dealt = ask.join(counted("blocks"), "shard").withColumn("block", F.pmod(F.xxhash64("query"), F.col("blocks")).cast("int"))
        both = copied.groupBy("shard", "block").cogroup(dealt.groupBy("shard", "block"))
        return stored(both.applyInPandas(in_shard, schema), name)

    def best(found: DataFrame, most: int) -> DataFrame:
        ranked = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))
        return found.withColumn("r", ranked).filter(F.col("r") <= most)

    first = searched(asked, "found-at-home")
    # The distance of the k+1-th vector found at home; without so many, anything may be nearer.
    last = first.groupBy("query").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
    reach = F.when(F.col("n") > k, F.sqrt(F.greatest(F.lit(0.0), 2 * largest * (largest - F.col("least") / norm)))).otherwise(F.lit(float("inf")))
    onward = asked.drop("reach").join(last, "query", "left").withColumn("reach", reach)
    onward = onward.withColumn("shard", F.explode(others("v", "shard", "reach"))).select("query", "v", "shard", "reach")
    onward = stored(onward, "onward")
    found = first.unionByName(searched(onward, "found-elsewhere")).select("query", F.explode("ids").alias("id"), "score").distinct()
    finds = best(found, k + 1).select("query", "id", "score")

    mine = queries.join(asked.select("v", "query"), "v").select(F.col("id").alias("query_id"), "query")
    final = mine.join(finds, "query").filter(F.col("id") != F.col("query_id"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return final.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id), "score")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


QUERIES: dict[str, tuple[Query, str | None]] = {"op4_vp_search": (op4, None)}
