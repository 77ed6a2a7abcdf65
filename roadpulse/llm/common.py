"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import gc
import os
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadpulse.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

#: Rows of a bucket or shard that one task is meant to hold; counts of buckets follow from it and the input.
SHARD_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: lost executors don't lose it, later passes don't redo it."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of finished steps now: it does so when the driver collects its garbage, which may be long after."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def text_or_empty(text: str) -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def crc_mod(doc_id: str, n: int) -> Column:
    """crc32 of the id's decimal text modulo n; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(n))


def tokenizer_path(name: str) -> str:
    """Where a public vocabulary file lies: `ROADPULSE_TOKENIZERS` names another folder."""
    folder = os.environ.get("ROADPULSE_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def spread(spark: SparkSession) -> int:
    """Partitions for shuffles whose size follows the session's setting."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_batches(spark: SparkSession) -> None:
    """Arrow batches by bytes as well as rows, so that a run of very long texts doesn't fill a Python worker."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key, str(2**31 - 1))) > 2**24:
        spark.conf.set(key, str(2**24))


#: Classes whose thresholds are broadcast; those of more are joined by a shuffle.
BROADCAST_CLASSES = 100_000


def class_sample(rows: DataFrame, cls: str, hashed: Column, per_class: dict | int, most: int | None = None) -> DataFrame:
    """At most `per_class` rows of each class, those with the smallest hash, whatever the number of rows.

    With `most` rows wanted in all, many classes get fewer each, but every class at least one: no class is left out.
    Classes are counted first; then a threshold on the hash lets about twice as many rows through as are wanted, so
    that ranking them is a matter of a few thousand rows. `rows` should be narrow: it is read twice. Adds the column `_rank`.
    """
    counts = stored(rows.groupBy(cls).agg(F.count(F.lit(1)).alias("n")), "classes")
    n_classes = counts.count()
    if isinstance(per_class, int):
        wanted = F.lit(per_class if most is None else max(1, min(per_class, most // max(n_classes, 1))))
    else:
        wanted = F.coalesce(*[F.when(F.col(cls) == c, F.lit(n)) for c, n in per_class.items()], F.lit(0))
    whole = 1 << 30
    share = F.least(F.lit(1.0), 2 * F.col("_most") / F.col("n")) * whole
    limits = counts.withColumn("_most", wanted).select(cls, F.floor(share).alias("_let"), "_most")
    narrowed = rows.withColumn("_hash", hashed).join(F.broadcast(limits) if n_classes <= BROADCAST_CLASSES else limits, cls)
    narrowed = narrowed.filter(F.pmod("_hash", F.lit(whole)) < F.col("_let"))
    order = Window.partitionBy(cls).orderBy("_hash", *[c for c in rows.columns if c != cls])
    return narrowed.withColumn("_rank", F.row_number().over(order)).filter("_rank <= _most").drop("_let", "_most")


#: Places of an id filter: one bit each, so it takes a megabyte whatever the number of ids.
FILTER_BITS = 1 << 23


def id_filter(ids: DataFrame, id: str) -> np.ndarray:
    """Bits of the places `id mod FILTER_BITS` that some id has: rows that can't be wanted are dropped before a shuffle, an exact join follows.

    With far more ids than bits all rows pass, and only the saving is lost.
    """
    words = ids.groupBy(F.expr(f"cast(pmod(`{id}`, {FILTER_BITS}) div 64 as int)").alias("w"))
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    for r in words.agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(`{id}`, 64) as int))")).alias("b")).collect():
        bits[r["w"]] = r["b"]
    return bits


def may_hold(bits: np.ndarray, ids: np.ndarray) -> np.ndarray:
    place = np.mod(ids, FILTER_BITS)
    return (bits.view(np.uint64)[place // 64] >> (place % 64).astype(np.uint64)) & np.uint64(1) == 1


def fresh(columns: list[str], name: str) -> str:
    """`name`, made longer until no column has it, whatever its case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
