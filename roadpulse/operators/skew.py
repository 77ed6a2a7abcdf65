"""Equi-join that splits hot keys on both sides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_MIN_ROWS = 20_000
HOT_SHARES = 10_000


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    min_rows: int = HOT_MIN_ROWS,
    right_is_even: bool = False,
) -> DataFrame:
    """Inner equi-join on `keys` that survives keys holding a large part of either side.

    A key is hot when it holds more than 1/10000 of a side's rows (and `min_rows`). There are
    fewer than 10,000 of those per side whatever the data, so their list is broadcast. The
    rows of a hot key are cut into chunks on each side, and every chunk meets every chunk of
    the other side: each pair is produced once and no task gets a whole hot key. One
    counting pass decides; without hot keys this is a plain join. A right side
    that holds few rows per key by construction need not be counted (`right_is_even`).
    """
    sides = (0,) if right_is_even else (0, 1)
    counts = [df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")) for df in (left, right)]
    sizes = [
        counts[s].agg(F.lit(s).alias("side"), F.max("_n").alias("largest"), F.sum("_n").alias("rows"))
        for s in sides
    ]
    # One row per side: its largest key and its size.
    found = (sizes[0] if right_is_even else sizes[0].unionByName(sizes[1])).collect()
    limits = {row.side: max(float(min_rows), (row["rows"] or 0) / HOT_SHARES) for row in found}
    hot = [row.side for row in found if (row.largest or 0) > limits[row.side]]
    if not hot:
        return left.join(right, keys)

    chunks = {
        s: F.broadcast(
            counts[s]
            .filter(F.col("_n") > limits[s])
            .select(*keys, F.ceil(F.col("_n") / limits[s]).cast("int").alias(f"_chunks{s}"))
        )
        for s in hot
    }

    def salted(df: DataFrame, own: int) -> DataFrame:
        tagged = df
        for s in hot:
            tagged = tagged.join(chunks[s], keys, "left")

        def n(side: int) -> Column:
            return F.coalesce(F.col(f"_chunks{side}"), F.lit(1)) if side in hot else F.lit(1)

        return (
            tagged.withColumn(f"_salt{own}", F.pmod(F.xxhash64(*df.columns), n(own)).cast("int"))
            .withColumn(f"_salt{1 - own}", F.explode(F.sequence(F.lit(0), n(1 - own) - 1)))
            .drop("_chunks0", "_chunks1")
        )

    salts = ["_salt0", "_salt1"]
    return salted(left, 0).join(salted(right, 1), [*keys, *salts]).drop(*salts)
