"""Phrase collocations by Rabin-Karp fingerprints.

Prefix polynomials modulo 2^64 over the bytes of a batch give the hash of each word, and prefix polynomials over those the fingerprint of
each run of words, all in numpy. Phrases are counted length by length: a phrase can only be frequent when its two parts of one word less
are, so a bit map of the frequent fingerprints of one length, of a bounded size, spares most of the next. Tasks sum up what they have read, a shuffle on
the fingerprint sums up the rest.

Fingerprints only choose what is looked at. In a last pass every occurrence with a frequent fingerprint points to the first
one of its batch and is compared with it word by word in the text; then the phrase itself is made, once a batch, and
counted by its text. So equal fingerprints of different phrases change nothing, and only frequent phrases become text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadpulse.llm.common import Query, release, small_batches, stored, table, text_or_empty
from roadpulse.operators.skew import salted_join

LEAST, LONGEST, FACTOR, WITHIN, TOP = 100, 5, 1000, 100, 2000
#: Bytes of text that are hashed together, fingerprints that a task holds before it hands them on, and rows it hands on at once.
BATCH_BYTES, HELD, ROWS = 1 << 20, 1 << 21, 1 << 16
#: Bits of a map of frequent fingerprints at most (32 MB), and bits of the part that one group makes.
MAP_BITS, PART_BITS = 28, 20
#: Languages whose word totals are broadcast; more are joined by a shuffle.
MAX_LANGS = 10_000
#: Odd multipliers of the two polynomials and of the mixing step.
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
MIX = 0xBF58476D1CE4E5B9

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD, GAP, BREAK = 0, 1, 2
CLASSES = np.zeros(256, np.uint8)
CLASSES[[0x20, 0x09]] = GAP
CLASSES[[ord(c) for c in ".,;:!?"] + [0x0A, 0x0B, 0x0C, 0x0D]] = BREAK
PIECE_END = re.compile(rb"[.,;:!?\x0A-\x0D]")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Powers:
    """Powers of an odd base and of its inverse modulo 2^64, as many as were asked for."""

    def __init__(self, base: int):
        self.base, self.inverse, self.up, self.down = base, pow(base, -1, 1 << 64), np.ones(1, np.uint64), np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            steps = 1 << (n - 1).bit_length()
            self.up, self.down = (
                np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(steps, b, np.uint64))]) for b in (self.base, self.inverse)
            )
        return self.up[:n], self.down[:n]


def prefixes(values: np.ndarray, powers: Powers) -> np.ndarray:
    """Sums of value times power before each place and, last, of all."""
    up, _ = powers.upto(max(len(values), 1))
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * up[: len(values)], dtype=np.uint64)])


def between(sums: np.ndarray, first: np.ndarray, last: np.ndarray, powers: Powers) -> np.ndarray:
    """Hashes of the stretches from `first` up to `last`, the same wherever a stretch lies."""
    _, down = powers.upto(len(sums))
    return (sums[last] - sums[first]) * down[first]


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(MIX)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class Words:
    """The words of a batch of texts: where they lie, their piece, their text's language, and the fingerprints of their runs.

    `strength` is the number of bits that hashes keep: fewer than 64 make collisions, which tests want.
    """

    def __init__(self, texts: list[bytes], langs: list[str], bytes_: Powers, words: Powers, strength: int):
        # A line end between texts is the end of a piece.
        joined = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
        self.data, self.langs, self.powers, self.strength = LOWER[joined], langs, words, strength
        kind = CLASSES[self.data]
        inside = np.concatenate([[False], kind == WORD, [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.starts, self.ends = edges[0::2], edges[1::2]
        self.piece = np.searchsorted(np.flatnonzero(kind == BREAK), self.starts)
        text_ends = np.cumsum([len(t) + 1 for t in texts])
        self.lang = np.searchsorted(text_ends, self.starts, side="right")
        # A byte of zero counts as well, so that words of different lengths differ.
        sums = prefixes(self.data.astype(np.uint64) + np.uint64(1), bytes_)
        self.hashes = self._kept(mixed(between(sums, self.starts, self.ends, bytes_)))
        self.sums = prefixes(self.hashes, words)
        seeds = {lang: int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little") for lang in set(langs)}
        self.seeds = np.array([seeds[lang] for lang in langs], np.uint64)

    def _kept(self, hashes: np.ndarray) -> np.ndarray:
        return hashes if self.strength == 64 else hashes >> np.uint64(64 - self.strength) << np.uint64(64 - self.strength)

    def runs(self, n: int) -> np.ndarray:
        """First words of the runs of n words that lie within a piece."""
        count = max(len(self.starts) - n + 1, 0)
        return np.flatnonzero(self.piece[:count] == self.piece[n - 1 : n - 1 + count])

    def fingerprints(self, first: np.ndarray, n: int) -> np.ndarray:
        found = between(self.sums, first, first + n, self.powers)
        return self._kept(mixed(found + self.seeds[self.lang[first]] + np.uint64(n)))

    def ids(self) -> np.ndarray:
        """A number for each word, equal for equal words: the first of equal hash, and compared with it byte by byte."""
        _, at, ids = np.unique(self.hashes, return_index=True, return_inverse=True)
        first, length = at[ids], self.ends - self.starts
        same = length == length[first]
        place = np.arange(length[same].sum()) - np.repeat(np.cumsum(length[same]) - length[same], length[same])
        equal = self.data[np.repeat(self.starts[same], length[same]) + place] == self.data[np.repeat(self.starts[first[same]], length[same]) + place]
        wrong = np.bincount(np.repeat(np.flatnonzero(same), length[same])[~equal], minlength=len(ids)) > 0
        others: dict[bytes, int] = {}
        for i in np.flatnonzero(wrong | ~same):
            word = self.data[self.starts[i] : self.ends[i]].tobytes()
            ids[i] = others.setdefault(word, len(at) + len(others))
        return ids

    def joined(self) -> tuple[np.ndarray, np.ndarray]:
        """All words with one space after each, and where each begins there: a run of words is a stretch of it."""
        size = self.ends - self.starts + 1
        begin = np.concatenate([[0], np.cumsum(size)])
        out = self.data[np.arange(begin[-1]) + np.repeat(self.starts - begin[:-1], size)]
        out[begin[1:] - 1] = 0x20
        return out, begin


def phrases_of(out: np.ndarray, begin: np.ndarray, first: np.ndarray, n: int) -> pa.Array:
    """The texts of runs of n words in what `joined` gives."""
    size = begin[first + n] - 1 - begin[first]
    offsets = np.concatenate([[0], np.cumsum(size)])
    data = out[np.arange(offsets[-1]) + np.repeat(begin[first] - offsets[:-1], size)]
    return pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes()))


def batches_of(batches: Iterator[pa.RecordBatch], strength: int) -> Iterator[Words]:
    """Words of (text, lang) rows, about a megabyte of text at once; a longer text is cut, but only where a piece ends anyway."""
    bytes_, words = Powers(BYTE_BASE), Powers(WORD_BASE)
    texts: list[bytes] = []
    langs: list[str] = []
    size = 0
    for batch in batches:
        for text, lang in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist()):
            at = 0
            while at == 0 or at < len(text):
                end = PIECE_END.search(text, at + BATCH_BYTES)
                part = text[at : end.end()] if end else text[at:]
                texts.append(part)
                langs.append(lang)
                at += max(len(part), 1)
                size += len(part)
                if size >= BATCH_BYTES:
                    yield Words(texts, langs, bytes_, words, strength)
                    texts, langs, size = [], [], 0
    if texts:
        yield Words(texts, langs, bytes_, words, strength)


def in_map(bits: np.ndarray, prints: np.ndarray) -> np.ndarray:
    place = prints >> np.uint64(64 - (len(bits) * 64).bit_length() + 1)
    return (bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the counts by fingerprint."""
    prints = np.concatenate([p for p, _ in parts])
    counts = np.concatenate([c for _, c in parts])
    order = np.argsort(prints)
    prints, counts = prints[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], prints[1:] != prints[:-1]])) if len(prints) else np.zeros(0, np.int64)
    return prints[first], np.add.reduceat(counts, first) if len(first) else counts


def frequent_map(texts: DataFrame, n: int, before: np.ndarray | None, least: int, map_bits: int, strength: int) -> np.ndarray:
    """Bits of the places that the fingerprint of some phrase of n words with `least` occurrences has.

    More phrases than bits fill the map, and only its saving is lost: what it lets through is counted exactly later.
    """
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(before)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, held, size = shared.value, [], 0

        def rows() -> Iterator[pa.RecordBatch]:
            prints, counts = held[0][0].view(np.int64), held[0][1]
            for at in range(0, len(prints), ROWS):
                yield pa.RecordBatch.from_arrays([pa.array(prints[at : at + ROWS]), pa.array(counts[at : at + ROWS])], names=["print", "n"])

        for words in batches_of(batches, strength):
            first = words.runs(n)
            if before is not None:
                let = np.zeros(len(words.starts), bool)
                shorter = words.runs(n - 1)
                let[shorter] = in_map(before, words.fingerprints(shorter, n - 1))
                first = first[let[first] & let[first + 1]]
            prints, counts = np.unique(words.fingerprints(first, n), return_counts=True)
            held.append((prints, counts.astype(np.int64)))
            size += len(prints)
            if size > HELD:
                held = [merged(held)]
                size = len(held[0][0])
                if size > HELD // 2:
                    yield from rows()
                    held, size = [], 0
        if held:
            held = [merged(held)]
            yield from rows()

    # Tasks have summed up what is theirs: the sums over tasks are made after the shuffle alone.
    counted = texts.mapInArrow(count, "print long, n long").repartition("print").groupBy("print").agg(F.sum("n").alias("n"))
    place = F.shiftrightunsigned("print", 64 - map_bits)
    part = min(PART_BITS, map_bits)
    places = counted.filter(F.col("n") >= least).select(place.alias("place")).distinct()

    def bits_of(group: pa.Table) -> pa.Table:
        own = group.column("place").to_numpy()
        bits = np.zeros(1 << part, np.uint8)
        bits[own & ((1 << part) - 1)] = 1
        packed = np.packbits(bits, bitorder="little").tobytes()
        return pa.table({"part": pa.array([int(own[0] >> part)], pa.int64()), "bits": pa.array([packed], pa.binary())})

    parts = places.groupBy(F.shiftright("place", part).alias("key")).applyInArrow(bits_of, "part long, bits binary")
    found = np.zeros(1 << (map_bits - 6), np.uint64)
    words_a_part = 1 << (part - 6)
    for row in parts.collect():
        found[row["part"] * words_a_part : (row["part"] + 1) * words_a_part] = np.frombuffer(bytes(row["bits"]), np.uint64)
    shared.unpersist()
    release(spark)
    return found


def frequent_phrases(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST, strength: int = 64
) -> DataFrame:
    """(lang, words, phrase, f): phrases of 1 to `longest` words with at least `least` occurrences in their language, counted by their text.

    One more row a language has `words` 0, an empty phrase and the number of all words.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(text_or_empty(text).alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"))
    # Frequent phrases are fewer than bytes / (2 * least); some ten bits each, within the bound.
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    map_bits = min(max((10 * size // (2 * least)).bit_length(), 12), MAP_BITS)
    maps: list[np.ndarray] = []
    for n in range(1, longest + 1):
        maps.append(frequent_map(texts, n, maps[-1] if maps else None, least, map_bits, strength))
        if not maps[-1].any():
            break
    shared = spark.sparkContext.broadcast(maps)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["lang", "words", "phrase", "n"]
        for words in batches_of(batches, strength):
            langs, (out, begin), ids = pa.array(words.langs, pa.string()), words.joined(), words.ids()
            at, total = np.unique(words.lang, return_counts=True)
            zero, none = pa.array(np.zeros(len(at), np.int32)), pa.array([""] * len(at), pa.string())
            yield pa.RecordBatch.from_arrays([langs.take(pa.array(at)), zero, none, pa.array(total.astype(np.int64))], names=names)
            for n, bits in enumerate(shared.value, 1):
                first = words.runs(n)
                prints = words.fingerprints(first, n)
                let = in_map(bits, prints)
                first, prints = first[let], prints[let]
                _, at, group = np.unique(prints, return_index=True, return_inverse=True)
                pointer = first[at][group]
                # Each occurrence against the one it points to: language, then word for word. What differs goes on its own.
                same = words.seeds[words.lang[first]] == words.seeds[words.lang[pointer]]
                for j in range(n):
                    same &= ids[first + j] == ids[pointer + j]
                counts = np.concatenate([np.bincount(group[same], minlength=len(at)), np.ones((~same).sum(), np.int64)])
                each = np.concatenate([first[at], first[~same]])
                for i in range(0, len(each), ROWS):
                    part = each[i : i + ROWS]
                    columns = [
                        langs.take(pa.array(words.lang[part])),
                        pa.array(np.full(len(part), n, np.int32)),
                        phrases_of(out, begin, part, n),
                        pa.array(counts[i : i + ROWS]),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = texts.mapInArrow(made, "lang string, words int, phrase string, n long")
    counted = rows.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("f"))
    return counted.filter((F.col("f") >= least) | (F.col("words") == 0))


def whole(column: str) -> Column:
    return F.col(column).cast("decimal(19,0)")


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least: int = LEAST,
    longest: int = LONGEST,
    factor: int = FACTOR,
    within: int = WITHIN,
    strength: int = 64,
) -> DataFrame:
    """One row per phrase of 2 to `longest` words: lang, phrase, a, l, r, n, score.

    Texts are read in lower case (A-Z), cut into pieces at `.,;:!?` and line ends and those into words at spaces and tabs; phrases lie within a piece
    and are counted by language, overlaps included; a null language is `und`. `a` of at least `least` is the count of the phrase, `n` that of all words, `l` and `r` those of
    the parts of its weakest cut: the one with the smallest floor(factor * a * n / (l * r)), ties to the earliest. Phrases go that lie in a longer
    one with `within` percent of their count. Null and empty texts have no words, a text of any length is read whole, repeated rows count
    each; an empty table gives no rows. Other columns are not read.
    """
    found = stored(frequent_phrases(docs, text, lang, least, longest, strength), "frequent-phrases")
    phrases = found.filter("words > 0").select("lang", "words", "phrase", F.col("f").alias("a"))
    candidates = phrases.filter("words > 1")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).withColumns(
        {"first": F.expr("substring_index(phrase, ' ', k)"), "rest": F.expr("substring_index(phrase, ' ', k - words)")}
    )
    # Parts of a frequent phrase are frequent, so none is missing. A word in many phrases is a hot key.
    for part, count in (("first", "l"), ("rest", "r")):
        counts = phrases.select("lang", F.col("phrase").alias(part), F.col("a").alias(count))
        cuts = salted_join(cuts, counts, ["lang", part], right_is_even=True)
    totals = found.filter("words = 0").select("lang", F.col("f").alias("n"))
    cuts = cuts.join(F.broadcast(totals) if totals.count() <= MAX_LANGS else totals, "lang")
    products = cuts.withColumns({"_top": F.lit(factor).cast("decimal(10,0)") * (whole("a") * whole("n")), "_low": whole("l") * whole("r")})
    scored = products.withColumn("score", F.expr("_top div _low").cast("long"))
    best = scored.groupBy("lang", "phrase", "words").agg(
        F.first("a").alias("a"), F.first("n").alias("n"), F.min(F.struct("score", "k", "l", "r")).alias("_cut")
    )
    # Every stretch of a longer candidate, with the largest count that a phrase around it has.
    parts = candidates.filter("words > 2").select(
        "lang",
        "a",
        F.explode(
            F.expr(
                """flatten(transform(sequence(2, words - 1), m -> transform(sequence(0, words - m),
                   s -> substring_index(substring_index(phrase, ' ', s + m), ' ', -m))))"""
            )
        ).alias("phrase"),
    )
    around = parts.groupBy("lang", "phrase").agg(F.max("a").alias("_around"))
    kept = best.join(around, ["lang", "phrase"], "left").filter(
        F.col("_around").isNull() | (F.col("_around") * 100 < F.col("a") * within)
    )
    return kept.select("lang", "phrase", "a", "_cut.l", "_cut.r", "n", "_cut.score")



def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = collocations(table(spark, sf_dir, "documents")).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= TOP).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), runs AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), grams AS (
  SELECT lang, m, unnest([array_to_string(w[i:i + m - 1], ' ') FOR i IN range(1, len(w) - m + 2)]) AS phrase
  FROM runs, unnest(range(1, {LONGEST + 1})) AS t(m)
), f AS MATERIALIZED (
  SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= {LEAST}
), total AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM runs GROUP BY lang
), cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, k, x.f AS l, y.f AS r, n,
         CAST(CAST({FACTOR} AS HUGEINT) * c.f * n // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k, string_split(phrase, ' ') AS w FROM f WHERE m > 1) AS c
  JOIN f AS x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[:k], ' ')
  JOIN f AS y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:], ' ')
  JOIN total ON total.lang = c.lang
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), parts AS (
  SELECT lang, f, array_to_string(w[s:s + p - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, m - p + 2)) AS s
        FROM (SELECT lang, f, m, string_split(phrase, ' ') AS w, unnest(range(2, m)) AS p FROM f WHERE m > 2))
), around AS (
  SELECT lang, phrase, max(f) AS top FROM parts GROUP BY ALL
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best LEFT JOIN around USING (lang, phrase) WHERE top IS NULL OR 100 * top < {WITHIN} * a
QUALIFY rank <= {TOP}
"""


QUERIES: dict[str, tuple[Query, str | None]] = {"op13_collocations": (op13, ORACLE)}
