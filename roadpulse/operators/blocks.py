"""A sparse matrix of edges times a dense one of node values, in blocks of nodes that lie close together.

Nodes are ordered along a space-filling curve and cut into blocks. A block's edges are one packed row, its values of a week one array a node;
each (block, week) is multiplied in numpy and gives one partial sum per target and hour, whatever its number of edges. Targets whose
sources all lie in one block are finished there. Only the others, at the borders of blocks, are shuffled and summed up.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.operators.ordering import global_rank
from roadpulse.session import materialize

#: Nodes of a block, and edges that are multiplied together: those of a hub are cut into chunks by their target.
BLOCK_NODES, CHUNK_EDGES = 64, 4096


def z_order(x: Column, y: Column) -> Column:
    """Place on a Z-shaped curve of two coordinates from 0 to 65535: their bits in turn."""

    def spread(v: Column) -> Column:
        for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
            v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
        return v

    return spread(x.cast("long")).bitwiseOR(F.shiftleft(spread(y.cast("long")), 1))


def node_blocks(edges: DataFrame, nodes: DataFrame | None, block_nodes: int) -> DataFrame:
    """(src, block, idx) of the nodes that edges come from, in order of the curve through `nodes` (id, x, y), or of their ids without places."""
    sources = edges.select("src").distinct()
    if nodes is None:
        ranked = global_rank(materialize(sources, "sources"), "src")
    else:
        box = nodes.agg(F.min("x").alias("x0"), F.min("y").alias("y0"), F.greatest(F.max("x") - F.min("x"), F.max("y") - F.min("y")).alias("side")).first()
        scale = 65535 / (box.side or 1.0)
        place = [F.coalesce(F.floor((F.col(c) - low) * scale), F.lit(0)) for c, low in (("x", box.x0 or 0.0), ("y", box.y0 or 0.0))]
        at = nodes.groupBy(F.col("id").alias("src")).agg(F.min(z_order(*place)).alias("z"))
        placed = sources.join(at, "src", "left").select(F.struct(F.coalesce("z", F.lit(-1)).alias("z"), "src").alias("place"))
        ranked = global_rank(materialize(placed, "sources"), "place").select("place.src", "rank")
    rank = F.col("rank") - 1
    return ranked.select("src", F.floor(rank / block_nodes).cast("int").alias("block"), (rank % block_nodes).cast("int").alias("idx"))


def block_product(
    cells: DataFrame,
    edges: DataFrame,
    cols: list[str],
    hours: int,
    key: str,
    nodes: DataFrame | None = None,
    bucket_hours: int = 168,
    block_nodes: int = BLOCK_NODES,
) -> DataFrame:
    """(dst, t_idx, border, w, s0, n0, ..): per target and hour the sum of weights, and for each column that of weight times value and its values.

    One row for each target and hour that some source has a cell for, several where `border` is true: one for each block. `edges` is read several times.
    """
    blocks = materialize(node_blocks(edges, nodes, block_nodes), "blocks")
    placed = edges.join(blocks, "src")
    border = placed.groupBy("dst").agg((F.min("block") != F.max("block")).alias("border"))
    chunks = placed.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / CHUNK_EDGES).cast("int").alias("chunks"))
    chunks = materialize(chunks, "chunks")
    # All edges of a block to one target are in one chunk, so a target within a block is finished there.
    chunk = F.pmod(F.xxhash64("dst"), F.col("chunks")).cast("int")
    packed = (
        placed.join(border, "dst")
        .join(chunks, "block")
        .groupBy("block", chunk.alias("chunk"))
        .agg(F.collect_list(F.struct("idx", "dst", F.col("weight").cast("double").alias("weight"), "border")).alias("e"))
    )
    weeks = F.sequence(F.lit(0), F.lit(max(hours - 1, 0) // bucket_hours))
    packed = packed.withColumn("week", F.explode(weeks))

    hour = F.struct((F.col("t_idx") % bucket_hours).cast("int").alias("h"), *[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(cols)])
    by_week = (
        cells.filter(F.col("t_idx").between(0, hours - 1))
        .groupBy(F.col(key).alias("src"), F.floor(F.col("t_idx") / bucket_hours).cast("int").alias("week"))
        .agg(F.collect_list(hour).alias("v"))
        .join(blocks, "src")
        .join(chunks, "block")
        # Named anew: both sides of the product come from `blocks`.
        .select(F.col("block").alias("block"), "idx", "week", "v", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    )
    fields = ["dst", "t_idx", "border", "w", *[f"{p}{i}" for i in range(len(cols)) for p in ("s", "n")]]

    def multiply(links: pa.Table, values: pa.Table) -> pa.Table:
        dst_type = links.schema.field("e").type.value_type.field("dst").type
        kinds = [dst_type, pa.int32(), pa.bool_(), pa.float64(), *[k for _ in cols for k in (pa.float64(), pa.int64())]]
        if not links.num_rows or not values.num_rows:
            return pa.table([pa.array([], k) for k in kinds], names=fields)
        week = links.column("week")[0].as_py()
        e = links.column("e").combine_chunks().flatten()
        # Edges by target.
        dst = e.field("dst").dictionary_encode()
        code = dst.indices.to_numpy()
        order = np.argsort(code, kind="stable")
        starts = np.flatnonzero(np.diff(code[order], prepend=-1))
        idx = e.field("idx").to_numpy()[order]
        weight = e.field("weight").to_numpy(zero_copy_only=False)[order]
        known = ~np.isnan(weight)
        weight = np.where(known, weight, 0.0)

        lists = values.column("v").combine_chunks()
        size = np.diff(lists.offsets.to_numpy())
        cell = lists.flatten()
        at = np.repeat(values.column("idx").to_numpy(), size) * bucket_hours + cell.field("h").to_numpy()
        shape = (block_nodes, bucket_hours)

        def dense(weights=None) -> np.ndarray:
            return np.bincount(at, weights, block_nodes * bucket_hours).reshape(shape)

        def product(matrix: np.ndarray, by: np.ndarray) -> np.ndarray:
            return np.add.reduceat(matrix[idx] * by[:, None], starts, axis=0)

        there = dense().astype(np.float64)
        rows, hour_at = np.nonzero(product(there, np.ones(len(idx))) > 0)
        out = [
            dst.dictionary.take(dst.indices.take(pa.array(order[starts][rows]))),
            pa.array((week * bucket_hours + hour_at).astype(np.int32)),
            e.field("border").take(pa.array(order[starts][rows])),
            pa.array(product(there, weight)[rows, hour_at]),
        ]
        for i in range(len(cols)):
            column = cell.field(f"v{i}")
            valid = column.is_valid().to_numpy(zero_copy_only=False)
            numbers = np.where(valid, column.to_numpy(zero_copy_only=False), 0.0)
            out.append(pa.array(product(dense(numbers), weight)[rows, hour_at]))
            out.append(pa.array(product(dense(valid.astype(np.float64)), known.astype(np.float64))[rows, hour_at].astype(np.int64)))
        return pa.table(out, names=fields)

    dst_kind = dict(edges.dtypes)["dst"]
    sums = ", ".join(f"s{i} double, n{i} long" for i in range(len(cols)))
    by = ["block", "chunk", "week"]
    schema = f"dst {dst_kind}, t_idx int, border boolean, w double, {sums}"
    return packed.groupBy(*by).cogroup(by_week.groupBy(*by)).applyInArrow(multiply, schema)
