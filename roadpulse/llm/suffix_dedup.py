"""Long-match dedup by a logarithmic family of suffix arrays.

A byte goes when a string of `LENGTH` bytes over it also starts in a document with a smaller id. Every such window of bytes has a key,
the least hash of its 16-byte grams, which depends on the window alone; neighbouring windows mostly share it, and such a run of windows
is one stretch of text. Equal windows lie in stretches of one key, so keys are dealt to shards, and a shard sees all there is to compare.

1. Documents are packed into chunks of about `CHUNK` bytes, compressed and written once.
2. Each chunk sends its distinct keys (48 bits); a shard answers with those that other chunks have too. Few keys are.
3. Each chunk sends its stretches of these keys, and of keys that several of its own documents have, once for equal ones, with the smallest id.
   In its shard about `BATCH_ROWS` stretches are a batch and get a suffix array; batches join a family of levels, in which levels of
   about equal size merge, so n batches make log(n) levels and every suffix is merged log(n) times. Then all batches are scanned against the
   family: a stretch whose key has no other text has one smallest id; where texts differ, at the border of a match, suffixes at
   every place of them are sorted `LENGTH` deep and each window gets its own. A shard does this for some of its keys at a time, so that
   a worker holds `ROUND_BYTES` of stretches and a few copies of `PART_BYTES` of them, not all that its shard got. Chunks of which a shard
   got little share a batch, so that its steps grow with its stretches, not with the number of chunks.
4. Each chunk marks the windows that have a smaller id elsewhere.

A passage that every document holds is sent once by a chunk, not by each document. Comparisons are on bytes: hashes
only bring together what may be equal. No task holds more than a chunk or a shard, and shards grow in number with the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.llm.common import Query, release, small_batches, stored, table

LENGTH = 50
GRAM = 16
#: Windows of a stretch at most.
RUN = 64
WIDTH = LENGTH - 1 + RUN
CHUNK = 4_000_000
SEGMENT = 500_000
#: Bytes of text for each shard, and shards at least.
SHARD_BYTES = 16_000_000
LEAST_SHARDS = 12
#: Parts that a shard's keys can be dealt to, and bytes of stretches for each: a shard is settled part by part.
PARTS = 64
PART_BYTES = 8_000_000
#: Bytes of stretches that are unpacked at once, some parts of them; stretches of a batch.
ROUND_BYTES = 48_000_000
BATCH_ROWS = 20_000
#: Windows that are sorted at once, a key's windows always together; stretches that are copied or hashed at once.
OPEN_WINDOWS = 100_000
ROWS = 10_000
NO_ID = np.iinfo(np.int64).max
C1, C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
BLOBS = "chunk long, kind int, shard int, a binary, b binary, c binary, d binary"


def pack(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=6).compress(np.ascontiguousarray(x).tobytes())


def unpack(blob: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), kind)


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending 48-bit numbers as the bytes of their steps, like bytes together."""
    steps = np.diff(values, prepend=np.uint64(0))
    return pack(steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].T)


def unpack_sorted(blob: bytes) -> np.ndarray:
    planes = unpack(blob, "u1").reshape(6, -1)
    steps = np.zeros((planes.shape[1], 8), np.uint8)
    steps[:, :6] = planes.T
    return np.cumsum(steps.view("<u8")[:, 0], dtype=np.uint64)


def window_keys(text: np.ndarray) -> np.ndarray:
    """For each window of LENGTH bytes the least hash of its grams."""
    n = len(text)
    if n < LENGTH:
        return np.zeros(0, np.uint64)
    eight = np.ndarray((n - 7,), "<u8", np.ascontiguousarray(text).data, strides=(1,))
    h = np.zeros(n - GRAM + 1, np.uint64)
    for j in range(0, GRAM, 8):
        h += eight[j : j + len(h)]
        h *= C1
        h ^= h >> np.uint64(31)
    h *= C2
    h ^= h >> np.uint64(32)
    grams, size = LENGTH - GRAM + 1, 1
    while 2 * size <= grams:
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    return np.minimum(h[: len(h) - (grams - size)], h[grams - size :])


def stretches(text: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, 48-bit key) of each run of windows with one key; `sizes` are the documents' bytes."""
    ends = np.cumsum(sizes)
    found = []
    for at in range(0, len(text), SEGMENT):
        keys = window_keys(text[at : at + SEGMENT + LENGTH - 1])
        if not len(keys):
            continue
        inside = np.ones(len(keys), bool)  # not over a document's end
        first, last = np.searchsorted(ends, [at, at + len(keys) + LENGTH], "right")
        for e in ends[first : last + 1].tolist():
            inside[max(0, e - LENGTH + 1 - at) : max(0, e - at)] = False
        change = np.flatnonzero((keys[1:] != keys[:-1]) | (inside[1:] != inside[:-1])) + 1
        start = np.concatenate([[0], change])
        count = np.diff(start, append=len(keys))
        start, count = start[inside[start]], count[inside[start]]
        parts = -(-count // RUN)
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        start, count = np.repeat(start, parts) + RUN * nth, np.minimum(RUN, np.repeat(count, parts) - RUN * nth)
        found.append((start + at, count, keys[start] >> np.uint64(16)))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found))


def suffixes(text: np.ndarray, start: np.ndarray, size: np.ndarray, depth: int) -> np.ndarray:
    """The bytes from each start, as comparable values: `size` of them, filled up to `depth`, and the size as a last byte."""
    padded = np.concatenate([text, np.zeros(depth, np.uint8)])
    rows = np.empty((len(start), depth + 1), np.uint8)
    view, step = np.lib.stride_tricks.sliding_window_view(padded, depth), np.arange(depth)
    for at in range(0, len(start), ROWS):
        part = slice(at, at + ROWS)
        rows[part, :depth] = view[start[part]]
        rows[part, :depth] *= step < size[part, None]
    rows[:, depth] = size
    return rows.reshape(-1).view(f"S{depth + 1}")


class Level:
    """A suffix array: distinct suffixes in order, each with the smallest id of a document that has it."""

    def __init__(self, suffix: np.ndarray, doc: np.ndarray):
        # A stable sort takes runs in order as they are: what merges are levels.
        order = np.argsort(suffix, kind="stable")
        rows = suffix[order]
        first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]])[: len(rows)])
        self.suffix, self.doc = rows[first], np.minimum.reduceat(doc[order], first) if len(first) else np.zeros(0, np.int64)

    def merged(self, other: Level) -> Level:
        return Level(np.concatenate([self.suffix, other.suffix]), np.concatenate([self.doc, other.doc]))


class Family:
    """Levels of falling size; a new batch is the last, and merges with those that are not at least twice as large."""

    def __init__(self) -> None:
        self.levels: list[Level] = []

    def add(self, level: Level) -> None:
        while self.levels and len(self.levels[-1].suffix) < 2 * len(level.suffix):
            level = self.levels.pop().merged(level)
        self.levels.append(level)

    def scan(self, suffix: np.ndarray) -> np.ndarray:
        """Smallest id that has each suffix, by one pass over each level in order."""
        least = np.full(len(suffix), NO_ID, np.int64)
        for level in self.levels:
            at = np.minimum(np.searchsorted(level.suffix, suffix), len(level.suffix) - 1)
            hit = level.suffix[at] == suffix
            least[hit] = np.minimum(least[hit], level.doc[at[hit]])
        return least

    def distinct(self) -> np.ndarray:
        return self.levels[0].suffix if len(self.levels) == 1 else np.unique(np.concatenate([x.suffix for x in self.levels]))


def keys_of(suffix: np.ndarray) -> np.ndarray:
    """The 48-bit key of each stretch, from its first window."""
    rows = suffix.view(np.uint8).reshape(len(suffix), -1)
    out = [np.zeros(0, np.uint64)]
    for at in range(0, len(rows), ROWS):
        flat = np.ascontiguousarray(rows[at : at + ROWS, :LENGTH]).reshape(-1)
        out.append(window_keys(flat)[::LENGTH] >> np.uint64(16))
    return np.concatenate(out)


def by_shard(shard: np.ndarray, values: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(shard, its values in their order), for the shards that have any: one sort, however many shards there are."""
    order = np.argsort(shard, kind="stable")
    names, first = np.unique(shard[order], return_index=True)
    return list(zip(names.tolist(), np.split(values[order], first[1:])))


class Stretches:
    """What a chunk has to compare, from its texts and the keys that other chunks have; the same whenever it is made."""

    def __init__(self, pdf: pd.DataFrame, shards: int):
        self.chunk, self.sizes, ids, self.text = _text(pdf)
        start, count, key = stretches(self.text, self.sizes)
        doc = ids[np.searchsorted(np.cumsum(self.sizes), start, "right")] if len(start) else np.zeros(0, np.int64)
        order = np.lexsort((doc, key))
        several = (key[order][1:] == key[order][:-1]) & (doc[order][1:] != doc[order][:-1])
        known = np.unique(np.concatenate([*[unpack_sorted(a) for a in pdf.loc[pdf["kind"] == 1, "a"]], key[order][1:][several]]))
        mine = known[np.minimum(np.searchsorted(known, key), len(known) - 1)] == key if len(known) else np.zeros(len(key), bool)
        self.start, self.count, self.doc = start[mine], count[mine], doc[mine]
        suffix = suffixes(self.text, self.start, self.count + LENGTH - 1, WIDTH)
        self.batch = Level(suffix, self.doc)
        self.entry = np.searchsorted(self.batch.suffix, suffix)
        shard = np.zeros(len(self.batch.suffix), np.int64)
        shard[self.entry] = (key[mine] % np.uint64(shards)).astype(np.int64)
        self.part = np.zeros(len(self.batch.suffix), np.uint8)
        self.part[self.entry] = key[mine] // np.uint64(shards) % np.uint64(PARTS)
        self.of_shard = dict(by_shard(shard, np.arange(len(shard))))


def open_answers(suffix: np.ndarray, key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For stretches whose keys have several texts: (place in `suffix`, first window, smallest id) wherever the id changes."""
    order = np.argsort(key, kind="stable")
    cuts = [0]
    windows_to = np.cumsum(suffix.view(np.uint8).reshape(len(suffix), -1)[order, -1].astype(np.int64) - (LENGTH - 1))
    for at in np.flatnonzero(np.diff(key[order]) != 0) + 1:
        if windows_to[at - 1] - (windows_to[cuts[-1] - 1] if cuts[-1] else 0) >= OPEN_WINDOWS:
            cuts.append(int(at))
    out = []
    for own in np.split(order, cuts[1:]):
        rows = suffix[own].view(np.uint8).reshape(len(own), -1)
        count = rows[:, -1].astype(np.int64) - (LENGTH - 1)
        of, nth = np.repeat(np.arange(len(own)), count), np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        flat = np.ascontiguousarray(rows[:, :-1]).reshape(-1)
        windows = suffixes(flat, of * (rows.shape[1] - 1) + nth, np.full(len(of), LENGTH), LENGTH)
        place = np.unique(windows, return_inverse=True)[1]
        least = np.full(place.max(initial=0) + 1, NO_ID, np.int64)
        np.minimum.at(least, place, doc[own][of])
        ids = least[place]
        change = (nth == 0) | (np.diff(ids, prepend=-1) != 0)
        out.append((own[of[change]], nth[change], ids[change]))
    return tuple(np.concatenate(x) for x in zip(*out))


def settled(family: Family) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct stretches of a family, where the answers of each begin, and the answers: (first window, smallest id) wherever the id changes."""
    suffix = family.distinct()
    least, key = family.scan(suffix), keys_of(suffix)
    family.levels.clear()
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    several = np.zeros(len(key), bool)
    several[order] = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    # One id each, or one for each part of an open one.
    open_, closed = np.flatnonzero(several), np.flatnonzero(~several)
    place, first, ids = closed, np.zeros(len(closed), np.int64), least[closed]
    if len(open_):
        p, f, i = open_answers(suffix[open_], key[open_], least[open_])
        place, first, ids = np.concatenate([place, open_[p]]), np.concatenate([first, f]), np.concatenate([ids, i])
    by = np.lexsort((first, place))
    place, first, ids = place[by], first[by], ids[by]
    return suffix, np.searchsorted(place, np.arange(len(suffix) + 1)), first, ids


def slots(begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The n places from each begin, one after the other."""
    return np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())


def _chunks(docs: DataFrame, id: str, text: str, keep: list[str]) -> DataFrame:
    """Kind 0: sizes, ids and compressed bytes of a chunk's documents; kind 5: their other columns, as Arrow bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n, size = TaskContext.get().partitionId() << 32, 0, 0
        texts: list[bytes] = []
        ids: list[int] = []
        rows: list[pa.RecordBatch] = []

        def flush() -> pa.RecordBatch:
            nonlocal n, size
            sizes = np.array([len(t) for t in texts], "<i8")
            whole = pack(np.frombuffer(b"".join(texts), np.uint8))
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                for r in rows:
                    writer.write_batch(r)
            found = [(task | n, 0, None, sizes.tobytes(), np.array(ids, "<i8").tobytes(), whole, None), (task | n, 5, None, sink.getvalue().to_pybytes(), None, None, None)]
            n, size = n + 1, 0
            texts.clear(), ids.clear(), rows.clear()
            kinds = [pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 4]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], ["chunk", "kind", "shard", "a", "b", "c", "d"])

        for batch in batches:
            others, start = batch.select(keep_names), 0
            for i, (t, doc) in enumerate(zip(batch.column("_text").to_pylist(), batch.column("_order").to_pylist())):
                texts.append(t)
                ids.append(doc)
                size += len(t)
                if size >= CHUNK:
                    rows.append(others.slice(start, i + 1 - start))
                    start = i + 1
                    yield flush()
            if start < batch.num_rows:
                rows.append(others.slice(start))
        if texts:
            yield flush()

    keep_names = [f"_k{i}" for i in range(len(keep))]
    narrow = docs.select(
        F.coalesce(F.col(text).cast("string").cast("binary"), F.lit(b"")).alias("_text"),
        F.coalesce(F.col(id).cast("long"), F.lit(NO_ID)).alias("_order"),
        *[F.col(c).alias(k) for c, k in zip(keep, keep_names)],
    )
    return stored(narrow.mapInArrow(run, BLOBS), "chunks")


def _blobs(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=["chunk", "kind", "shard", "a", "b", "c", "d"])
    return frame.astype({"chunk": "Int64", "kind": "Int32", "shard": "Int32"})


def _text(pdf: pd.DataFrame) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    row = pdf[pdf["kind"] == 0].iloc[0]
    return int(row["chunk"]), np.frombuffer(row["a"], "<i8"), np.frombuffer(row["b"], "<i8"), unpack(row["c"], "u1")


def remove_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", keep: list[str] | None = None, out: str = "_repeats") -> DataFrame:
    """One row per row of `docs`: the columns `keep` (by default the id), then `out`: struct of n_bytes, n_removed, n_spans, kept.

    `kept` holds the bytes that stay, as binary: a cut may fall inside a character. A null or empty text, or one shorter than LENGTH bytes,
    stays as it is. Of rows with one id none counts as smaller than another. A row without an id comes after all ids: what it shares with
    them goes, and nothing goes for its sake. All of `keep` passes with its type; other columns are not read. An empty table gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    keep = [id] if keep is None else keep
    chunks = _chunks(docs, id, text, keep)

    def volume(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"n": [int(np.frombuffer(a, "<i8").sum()) for a in pdf["a"]]})

    total = chunks.filter("kind = 0").select("a").mapInPandas(volume, "n long").agg(F.sum("n")).collect()[0][0] or 0
    shards = max(LEAST_SHARDS, -(-total // SHARD_BYTES))

    def distinct_keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for i in range(len(pdf)):
                chunk, sizes, _, text = _text(pdf.iloc[i : i + 1])
                keys = np.unique(stretches(text, sizes)[2])
                own = by_shard((keys % np.uint64(shards)).astype(np.int64), keys) if len(keys) else []
                yield _blobs([(chunk, 1, s, pack_sorted(k), None, None, None) for s, k in own])

    def shared(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [unpack_sorted(a) for a in pdf["a"]]
        keys, of = np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        order = np.argsort(keys, kind="stable")
        keys, of = keys[order], of[order]
        same = keys[1:] == keys[:-1]
        twice = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        keys, of = keys[twice], of[twice]
        by = np.argsort(of, kind="stable")
        cuts = np.searchsorted(of[by], np.arange(len(parts) + 1))
        rows = [(c, 1, None, pack_sorted(keys[by[x:y]]), None, None, None) for c, x, y in zip(pdf["chunk"], cuts, cuts[1:]) if x < y]
        return _blobs(rows)

    texts = chunks.filter("kind = 0")
    wanted = stored(texts.mapInPandas(distinct_keys, BLOBS).groupBy("shard").applyInPandas(shared, BLOBS), "shared-keys")
    release(spark)

    def send(pdf: pd.DataFrame) -> pd.DataFrame:
        own = Stretches(pdf, shards)
        rows = []
        for s, at in own.of_shard.items():
            ids, of = np.unique(own.batch.doc[at], return_inverse=True)
            rows.append((own.chunk, 2, s, pack(ids), pack(of.astype("<u4")), pack(own.batch.suffix[at]), pack(own.part[at])))
        return _blobs(rows)

    def settle(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("chunk")
        blobs = list(zip(pdf["a"], pdf["b"], pdf["c"]))
        part = [unpack(d, "u1") for d in pdf["d"]]
        to = np.cumsum([0, *map(len, part)])
        row_bytes = WIDTH + 1
        parts = min(PARTS, -(-int(to[-1]) * row_bytes // PART_BYTES))
        part = np.concatenate(part) % parts
        rounds = min(parts, -(-int(to[-1]) * row_bytes // ROUND_BYTES))
        # Rows by round and part, those of a part in the order of their chunks.
        order = np.lexsort((part, part % rounds))
        place = np.empty(len(part), np.int64)
        place[order] = np.arange(len(part))
        counts = np.zeros(len(part), np.int64)
        found = [(np.zeros(0, "u1"), np.zeros(0, "<i8"))]
        for r in range(rounds):
            own = [np.flatnonzero(part[x:y] % rounds == r) for x, y in zip(to, to[1:])]
            begin = int((part % rounds < r).sum())
            n = sum(map(len, own))
            suffix, doc = np.empty(n, f"S{row_bytes}"), np.empty(n, np.int64)
            for x, at, (a, b, c) in zip(to, own, blobs):
                if len(at):
                    row = place[x + at] - begin
                    suffix[row] = unpack(c, f"S{row_bytes}")[at]
                    doc[row] = unpack(a, "<i8")[unpack(b, "<u4")[at]]
            cuts = np.cumsum([0, *(n for n in np.bincount(part, minlength=parts)[r::rounds] if n)])
            for x, y in zip(cuts, cuts[1:]):
                family = Family()
                for at in range(x, y, BATCH_ROWS):
                    family.add(Level(suffix[at : min(y, at + BATCH_ROWS)], doc[at : min(y, at + BATCH_ROWS)]))
                distinct, first_of, first, ids = settled(family)
                at = np.searchsorted(distinct, suffix[x:y])
                counts[begin + x : begin + y] = n = first_of[at + 1] - first_of[at]
                pick = slots(first_of[at], n)
                found.append((first[pick].astype("u1"), ids[pick].astype("<i8")))
        first, ids = (np.concatenate(x) for x in zip(*found))
        starts = np.cumsum(counts) - counts
        rows = []
        for chunk, x, y in zip(pdf["chunk"], to, to[1:]):
            n = counts[place[x:y]]
            pick = slots(starts[place[x:y]], n)
            rows.append((chunk, 4, pdf["shard"].iloc[0], pack(n.astype("u1")), pack(first[pick]), pack(ids[pick]), None))
        return _blobs(rows)

    sent = texts.unionByName(wanted).groupBy("chunk").applyInPandas(send, BLOBS)
    answers = stored(sent.groupBy("shard").applyInPandas(settle, BLOBS), "answers")
    del sent
    release(spark)

    added = ["_n_bytes", "_n_removed", "_n_spans", "_kept"]
    kinds = [T.LongType(), T.LongType(), T.LongType(), T.BinaryType()]
    carried = [T.StructField(f"_k{i}", docs.schema[c].dataType, True) for i, c in enumerate(keep)]
    schema = T.StructType(carried + [T.StructField(n, k) for n, k in zip(added, kinds)])

    def mark(tab: pa.Table) -> pa.Table:
        pdf = tab.to_pandas()
        mine = Stretches(pdf, shards)
        sizes, text, start, count, doc = mine.sizes, mine.text, mine.start, mine.count, mine.doc
        change = np.zeros(len(text) + 1, np.int32)
        found = pdf[pdf["kind"] == 4]
        if len(found):
            of, first, least = [], [], []
            for s, a, b, c in zip(found["shard"], found["a"], found["b"], found["c"]):
                of.append(np.repeat(mine.of_shard[int(s)], unpack(a, "u1")))
                first.append(unpack(b, "u1"))
                least.append(unpack(c, "<i8"))
            of, first, least = np.concatenate(of), np.concatenate(first).astype(np.int64), np.concatenate(least)
            by = np.lexsort((first, of))
            of, first, least = of[by], first[by], least[by]
            begin, end = np.searchsorted(of, mine.entry), np.searchsorted(of, mine.entry, "right")
            n = end - begin
            run = np.repeat(np.arange(len(n)), n)
            at = slots(begin, n)
            to = np.where(at + 1 < np.repeat(end, n), first[np.minimum(at + 1, len(first) - 1)], count[run])
            gone = least[at] < doc[run]
            np.add.at(change, (start[run] + first[at])[gone], 1)
            np.add.at(change, (start[run] + to + LENGTH - 1)[gone], -1)
        covered = np.cumsum(change[:-1]) > 0
        out, at = [], 0
        for size in sizes.tolist():
            c, t = covered[at : at + size], text[at : at + size]
            at += size
            removed = int(c.sum())
            spans = int(c[:1].sum() + (c[1:] & ~c[:-1]).sum()) if removed else 0
            out.append((size, removed, spans, t.tobytes() if not removed else t[~c].tobytes()))
        kept = pa.ipc.open_stream(pdf.loc[pdf["kind"] == 5, "a"].iloc[0]).read_all()
        columns = [*kept.columns, *[pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.binary()))]]
        return pa.table(columns, names=schema.names)

    everything = chunks.unionByName(wanted).unionByName(answers)
    found = everything.groupBy("chunk").applyInArrow(mark, schema)
    result = F.struct(*[F.col(n).alias(n[1:]) for n in added]).alias(out)
    return found.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], result)


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kept = F.sha2("_repeats.kept", 256).alias("kept_sha256")
    return found.select("doc_id", "_repeats.n_bytes", "_repeats.n_removed", "_repeats.n_spans", kept)


QUERIES: dict[str, tuple[Query, str | None]] = {"op5_suffix_dedup": (op5, None)}
