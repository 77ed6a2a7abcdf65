"""Exact dedup by deterministic block naming, in DataFrame operations only.

Texts are cut into blocks of a fixed number of characters. Distinct blocks, compared byte by byte, are
sorted inside the partition that their content hashes to, and their place in that order is their
integer name. Then the names of adjacent blocks form pairs, distinct pairs are named the same way, and so on,
until each text has one name. Equal names at one level mean equal texts: a block keeps its content while it is named,
so no hash decides equality. A digest only carries names back to their blocks, and only after a count has shown that
no two blocks share one; else the content itself is the join key.

The text is shuffled once, one copy of a block per map task. A group of copies is summed up before
each shuffle, and the joins back have exchanges on both sides that Spark splits where a key is hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.common import Query, stored, table, text_or_empty

#: Characters in a block. Larger blocks mean fewer rounds, smaller ones shorter rows.
BLOCK = 8192


def normalised(text: str) -> Column:
    """White-space runs as one space; null as the empty text. A lone space, the usual run, is not touched."""
    return F.regexp_replace(text_or_empty(text), r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")


def blocks_of(norm: Column, size: int) -> Column:
    found = F.regexp_extract_all(norm, F.lit(rf"[\s\S]{{1,{size}}}"), F.lit(0))
    return F.when(F.length(norm) <= size, F.array(norm)).otherwise(found)


def named(distinct: DataFrame, keys: list[str]) -> DataFrame:
    """Integer names of distinct keys: (partition of the key, place in its sorted order)."""
    return distinct.sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id())


def identities(docs: DataFrame, text: str, keep: list[str], block: int = BLOCK) -> DataFrame:
    """One row per row of `docs`: the columns `keep`, `_row`, `text_sha256`, and (`level`, `name`), equal for equal texts."""
    rows = docs.select(*keep, F.monotonically_increasing_id().alias("_row"), normalised(text).alias("_norm"))
    cut = rows.select(
        *keep,
        "_row",
        F.sha2(F.col("_norm").cast("binary"), 256).alias("text_sha256"),
        F.posexplode(blocks_of(F.col("_norm"), block)).alias("_pos", "_block"),
    )
    digest = F.unhex(F.sha2(F.col("_block").cast("binary"), 256)).alias("_digest")
    names = stored(
        named(cut.groupBy("_block").agg(F.lit(1).alias("_one")), ["_block"]).select("name", digest), "block-names"
    )
    clash = names.groupBy("_digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).count()
    if clash:  # two blocks with one digest: join on the content
        names, key = stored(named(cut.select("_block").distinct(), ["_block"]), "block-names"), "_block"
        placed = cut
    else:
        key, placed = "_digest", cut.select(*keep, "_row", "text_sha256", "_pos", digest)
    current = stored(placed.join(names, key).drop(key), "blocks")

    done, level = None, 0
    while True:
        # A text is finished when it has one name; the rest goes on in pairs.
        last = current.groupBy("_row").agg(F.max("_pos").alias("_last"))
        if level == 0:
            current = stored(current.join(last, "_row"), "counted")
        finished = current.filter("_last = 0").select(*keep, "_row", "text_sha256", F.lit(level).alias("level"), "name")
        done = finished if done is None else done.unionByName(finished)
        rest = current.filter("_last > 0")
        if rest.isEmpty():
            return done
        pairs = stored(
            rest.groupBy("_row", F.expr("_pos div 2").cast("int").alias("_pos")).agg(
                *[F.first(c).alias(c) for c in [*keep, "text_sha256"]],
                F.expr("cast(max(_last) div 2 as int)").alias("_last"),
                F.max(F.expr("if(_pos % 2 = 0, name, null)")).alias("_a"),
                F.coalesce(F.max(F.expr("if(_pos % 2 = 1, name, null)")), F.lit(-1).cast("long")).alias("_b"),
            ),
            "pairs",
        )
        pair_names = stored(named(pairs.select("_a", "_b").distinct(), ["_a", "_b"]), "pair-names")
        current = stored(pairs.join(pair_names, ["_a", "_b"]).drop("_a", "_b"), "named-pairs")
        level += 1


def exact_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per row of `docs`: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are after each white-space run became one space; null counts as empty, and empty texts
    equal each other. Of equal texts the row with the smallest id stays, a null id only where there is no other; of rows
    that repeat the id too, one stays. Other columns of `docs` are not read. An empty table gives no rows.
    """
    rows = stored(identities(docs.select(F.col(id).alias("_id"), F.col(text).alias("_text")), "_text", ["_id"], block), "identities")
    groups = stored(
        rows.groupBy("level", "name").agg(
            F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_row")).alias("_first"),
            F.count(F.lit(1)).alias("group_size"),
        ),
        "groups",
    )
    return rows.join(groups, ["level", "name"]).select(
        F.col("_id").alias(id),
        F.col("_first._id").alias("keep_id"),
        "group_size",
        (F.col("_row") == F.col("_first._row")).alias("kept"),
        "text_sha256",
    )


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM n WINDOW w AS (PARTITION BY norm)
"""

QUERIES: dict[str, tuple[Query, str | None]] = {"op9_exact_dedup": (op9, ORACLE)}
