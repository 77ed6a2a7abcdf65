"""Near-duplicate groups by fast similarity sketching, banding and exact verification.

A document is the set of hashes of its distinct five-word shingles. Its sketch has `LANES` coordinates: in round i each
element falls into a bin by a hash of its own for that round, and a coordinate keeps the least (round, hash) it gets; after
`LANES` rounds every further round gives all elements to one bin, so at most 2 * LANES rounds fill every coordinate, and one or two do for most
texts. The share of equal coordinates estimates the similarity with concentration like that of independent ones. Bands of some
coordinates then give candidates; their width follows from the threshold (`band_width`): four at 85 %, where a pair shares no band with
probability 2e-8, three at 80 % (1e-10; four would miss 3e-6).

1. Documents with the same set are one class, named by its smallest id.
2. In each band's bucket the members meet its smallest member only (a star, so a bucket gives as many pairs as it has members). Pairs
   whose sizes or sketches rule a link out are dropped (`least_lanes`: 1e-10 at the threshold), the others confirmed on full sets.
3. A bucket whose members are then all in one component needs nothing more: copies of one text end here, however many. For the rest,
   buckets that hang together are a cluster, and clusters are checked whole, in blocks of `BLOCK` members against each
   other, by exact intersections; a block hands on links that join components only. So no link is missed, no pair list is emitted, and no
   task holds more than two blocks.
4. Components of the links.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.common import Query, id_filter, may_hold, small_batches, spread, stored, table
from roadpulse.llm.components import components

SHINGLE = 5
LANES = 96
#: A link: 100 * intersection >= percent * union; this one unless the caller gives another.
PERCENT = 85
#: Share of the links at the threshold that may have no band in common, and that may be dropped by their sketches.
MISSED_BY_BANDS = 1e-7
MISSED_BY_LANES = 1e-10
BLOCK = 1500

_rng = np.random.default_rng(20170402)
SEEDS = _rng.integers(1, 2**63, 2 * LANES, np.uint64)
PRIME = np.uint64(0x9E3779B97F4A7C15)


def band_width(percent: int) -> int:
    """Coordinates of a band: as many as the threshold allows, as wide bands give fewer candidates."""
    widths = [w for w in (8, 6, 4, 3, 2) if (1 - (percent / 100) ** w) ** (LANES // w) <= MISSED_BY_BANDS]
    return max(widths, default=1)


def least_lanes(percent: int) -> int:
    """Coordinates that must be equal for a pair to be looked at: 56 at 85 %, where 82 are expected of a link."""
    p, below = percent / 100, 0.0
    for n in range(LANES):
        below += math.comb(LANES, n) * p**n * (1 - p) ** (LANES - n)
        if below > MISSED_BY_LANES:
            return n
    return LANES


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None) -> np.ndarray:
    """Sorted hashes of the distinct shingles; of a text with fewer words, the hash of all its words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    a = np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)
    width = min(SHINGLE, len(a))
    h = np.full(len(a) - width + 1, width, np.uint64)
    for j in range(width):
        h = h * PRIME + a[j : len(a) - width + 1 + j]
    return np.unique(mixed(h))


def sketch(items: np.ndarray) -> np.ndarray:
    """The least (round, hash) of each coordinate."""
    least = np.full(LANES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(2 * LANES):
        x = mixed(items ^ SEEDS[i])
        value = (np.uint64(i) << np.uint64(54)) | (x >> np.uint64(10))
        if i < LANES:
            np.minimum.at(least, ((x & np.uint64(0xFFFFFFFF)) * np.uint64(LANES)) >> np.uint64(32), value)
        else:
            least[i - LANES] = min(least[i - LANES], value.min())
        if (least != np.iinfo(np.uint64).max).all():
            break
    return least


def band_keys(least: np.ndarray, width: int) -> np.ndarray:
    rows = least.reshape(-1, width)
    h = np.arange(len(rows), dtype=np.uint64)
    for column in rows.T:
        h = mixed(h * PRIME + column)
    return h.view(np.int64)


def lanes(least: np.ndarray) -> np.ndarray:
    """One byte a coordinate, eight to a long: unequal bytes mean unequal coordinates."""
    return (least & np.uint64(0xFF)).astype(np.uint8).view(np.int64)


def different_lanes(a: Column, b: Column) -> Column:
    """Bytes that differ between two arrays of longs."""

    def unequal(x: Column, y: Column) -> Column:
        d = x.bitwiseXOR(y)
        for shift, mask in ((4, 0x0F0F0F0F0F0F0F0F), (2, 0x0303030303030303), (1, 0x0101010101010101)):
            d = d.bitwiseOR(F.shiftrightunsigned(d, shift).bitwiseAND(F.lit(mask)))
        return F.bit_count(d.bitwiseAND(F.lit(0x0101010101010101)))

    return F.aggregate(F.zip_with(a, b, unequal), F.lit(0), lambda total, n: total + n)


def linked(common: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    return 100 * common >= percent * (a + b - common)


def described(docs: DataFrame, id: str, text: str, percent: int) -> DataFrame:
    """(id, n, digest, bands, lanes) of each row."""
    small_batches(docs.sparkSession)
    width = band_width(percent)
    narrow = docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for text in pdf["text"]:
                items = shingles(text)
                if len(items):
                    least = sketch(items)
                    out.append((len(items), hashlib.blake2b(items.tobytes(), digest_size=16).digest(), band_keys(least, width), lanes(least)))
                else:
                    out.append((0, None, None, None))
            yield pd.DataFrame(out, columns=["n", "digest", "bands", "lanes"]).assign(id=pdf["id"].astype("Int64"))[["id", "n", "digest", "bands", "lanes"]]

    return stored(narrow.mapInPandas(run, "id long, n long, digest binary, bands array<long>, lanes array<long>"), "sketches")


def sets_of(docs: DataFrame, wanted: DataFrame, id: str, text: str) -> DataFrame:
    """(id, items) for the ids and digests in `wanted`: whole texts read again, for these documents only."""
    narrow = docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text")).filter("id is not null")
    bits = docs.sparkSession.sparkContext.broadcast(id_filter(wanted, "id"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf = pdf[may_hold(bits.value, pdf["id"].to_numpy())]
            items = [shingles(t).tobytes() for t in pdf["text"]]
            yield pd.DataFrame({"id": pdf["id"].to_numpy(), "digest": [hashlib.blake2b(x, digest_size=16).digest() for x in items], "items": items})

    found = narrow.mapInPandas(run, "id long, digest binary, items binary")
    # Rows that repeat an id: the one that stands for its class.
    return stored(found.join(wanted.select("id", "digest"), ["id", "digest"]).dropDuplicates(["id"]).select("id", "items"), "sets")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are links by their full sets."""
    one = sets.select(F.col("id").alias("b"), F.col("items").alias("items_b"))
    other = sets.select(F.col("id").alias("a"), F.col("items").alias("items_a"))

    @F.pandas_udf("boolean")
    def is_link(left: pd.Series, right: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(left, right):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = np.sort(np.concatenate([x, y]))
            out.append(bool(linked((both[1:] == both[:-1]).sum(), len(x), len(y), percent)))
        return pd.Series(out, dtype=bool)

    return pairs.join(one, "b").join(other, "a").filter(is_link("items_a", "items_b")).select("a", "b")


def block_links(ids: np.ndarray, component: np.ndarray, items: list[np.ndarray], part: np.ndarray, percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links of the members that join different components, no more than needed to join them; `part` says which of two blocks a
    member is in, and with two blocks only pairs across them count."""
    sizes = np.array([len(x) for x in items])
    token, member = np.unique(np.concatenate(items), return_inverse=True)[1], np.repeat(np.arange(len(items)), sizes)
    shared = np.bincount(token) > 1
    place = np.cumsum(shared) - 1
    keep = shared[token]
    token, member = place[token[keep]], member[keep]
    common = np.zeros((len(items), len(items)), np.float32)
    for start in range(0, int(shared.sum()), 4096):  # intersections as products, some thousand shingles at a time
        own = (token >= start) & (token < start + 4096)
        has = np.zeros((len(items), 4096), np.float32)
        has[member[own], token[own] - start] = 1
        common += has @ has.T
    two = len(set(part.tolist())) > 1
    a, b = np.nonzero(np.triu(linked(common.astype(np.int64), sizes[:, None], sizes[None, :], percent) & (component[:, None] != component[None, :]), 1))
    parent = {c: c for c in component.tolist()}

    def root(c: int) -> int:
        while parent[c] != c:
            parent[c] = c = parent[parent[c]]
        return c

    out = []
    for i, j in zip(a.tolist(), b.tolist()):
        if two and part[i] == part[j]:
            continue
        x, y = root(int(component[i])), root(int(component[j]))
        if x != y:
            parent[x] = y
            out.append((int(ids[i]), int(ids[j])))
    return out


def checked_whole(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between members (id, component, cluster) of a cluster that are in different components.

    Clusters of up to BLOCK members go together by a hash, into as many groups as hold BLOCK members each; a larger one is dealt into
    blocks, and each two blocks meet in a group of their own.
    """
    n_bins = max(4 * spread(members.sparkSession), -(-members.count() // BLOCK))
    sizes = members.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    placed = members.join(sizes, "cluster").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    meets = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least("block", o).alias("i"), F.greatest("block", o).alias("j")))
    placed = placed.withColumn("meet", F.explode(meets))
    bins = F.pmod(F.xxhash64("cluster"), F.lit(n_bins))
    own = F.concat_ws("-", F.col("cluster"), "meet.i", "meet.j")
    placed = placed.withColumn("group", F.when(F.col("blocks") == 1, bins.cast("string")).otherwise(own))
    full = placed.join(sets, "id").select("group", "cluster", "block", "id", "component", "items")

    def check(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, own in pdf.groupby("cluster"):
            own = own.sort_values("id")
            items = [np.frombuffer(x, np.uint64) for x in own["items"]]
            out += block_links(own["id"].to_numpy(), own["component"].to_numpy(), items, own["block"].to_numpy(), percent)
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return full.groupBy("group").applyInPandas(check, "a long, b long")


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per row of `docs`: id, n_shingles, component_id, kept.

    Linked are documents with 100 * common >= percent * all of their distinct five-word shingles (ASCII letters in lower case; a text of one to four words is
    one shingle); a component is all that links reach, named by its smallest id, which is kept. Documents without words, and null texts, are
    linked with nothing. Rows that repeat an id are documents of their own while their texts differ; where one id is the smallest of several classes, the
    classes are one component and one of its texts is compared. A row without an id is linked with nothing: component null, kept. Other columns are not read. An empty table gives no rows.
    """
    rows = described(docs, id, text, percent)
    usable = rows.filter("n > 0 and id is not null")
    classes = stored(usable.groupBy("digest").agg(F.min("id").alias("rep")), "classes")
    reps = usable.join(classes.withColumnRenamed("rep", "id"), ["digest", "id"], "left_semi")
    one = F.min_by(F.struct("digest", "n", "bands", "lanes"), "digest").alias("x")
    vertices = stored(reps.groupBy("id").agg(one).select("id", "x.*"), "vertices")

    # Stars: each member of a bucket with the bucket's smallest id.
    banded = vertices.select("id", F.explode("bands").alias("key"))
    buckets = banded.groupBy("key").agg(F.min("id").alias("center"), F.count(F.lit(1)).alias("members")).filter("members > 1")
    star = stored(banded.join(buckets, "key").select("key", "center", "id", "members"), "stars")
    involved = stored(star.select("id").distinct().join(vertices.select("id", "digest", "n", "lanes"), "id"), "involved")
    sets = sets_of(docs, involved, id, text)
    pairs = star.filter("id <> center").select(F.col("center").alias("a"), F.col("id").alias("b")).distinct()
    left = involved.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("lanes").alias("lanes_a"))
    right = involved.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("lanes").alias("lanes_b"))
    near = pairs.join(right, "b").join(left, "a").filter(
        (100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")) & (different_lanes(F.col("lanes_a"), F.col("lanes_b")) <= LANES - least_lanes(percent))
    )
    links = stored(confirmed(near.select("a", "b"), sets, percent), "star-links")
    first = components(links)

    # Buckets of three and more that still hold several components: whole clusters are checked.
    open_ = star.filter("members > 2").join(first, "id", "left").withColumn("component", F.coalesce("component", "id"))
    unsettled = open_.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y").select("key")
    rest = stored(open_.join(unsettled, "key").select("id", "center", "component"), "unsettled")
    clusters = components(rest.select(F.col("center").alias("a"), F.col("id").alias("b")))
    members = stored(rest.select("id", "component").distinct().join(clusters.withColumnRenamed("component", "cluster"), "id"), "members")
    more = stored(checked_whole(members, sets, percent), "cluster-links")
    final = components(links.unionByName(more)) if not more.isEmpty() else first

    of = classes.join(final.withColumnRenamed("id", "rep"), "rep", "left")
    of = of.select("digest", F.coalesce("component", "rep").alias("component_id"))
    found = rows.select("id", "n", "digest").join(of, "digest", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    found = found.select(F.col("id").alias(id), F.col("n").alias("n_shingles"), component.alias("component_id"))
    return found.withColumn("kept", F.coalesce(F.col(id) == F.col("component_id"), F.lit(True)))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES: dict[str, tuple[Query, str | None]] = {"op6_near_dedup": (op6, None)}
