"""LM scoring by subword lattices: a word's probability is summed over all its segmentations.

The pieces of an existing vocabulary are the arcs of a word's lattice. Their first weights are the vocabulary's scores (merge
ranks, read as Zipf's law); expectation steps over all distinct training words then fit the weights.
The log-space forward recursion sums over all segmentations; a piece that begins a word ends the one before it, so
the weights of all words sum to one. That is the bottom of the model: above it stand the word counts of all training documents, which
give the discounted mass of their counts to it. So the score is a true log10 probability. Beside it stands `lattice_score`, the marginal
under the vocabulary's own scores alone, without anything learnt but how often a text ends.

Words of one length are summed together, place by place. Words of a rare length, and long runs without spaces such as whole texts in
scripts that write none, go through one automaton that names every piece at every place: time and memory grow as their length.

Passes over the texts: one counts words, one scores. Words above 1/`HOT_SHARES` of all tokens (fewer than `HOT_SHARES`,
whatever the corpus) are sent to the scoring tasks and scored in place. All others go, packed by chunk of documents, to the bucket of
their word, where each distinct word's lattice is summed once for the whole corpus; sums by document come back by
chunk. No task holds more than a bucket or a chunk, and nothing but weights, totals and hot words passes the driver.
"""

from __future__ import annotations

import math
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.common import Query, crc_mod, small_batches, stored, table, tokenizer_path

VOCABULARY = "piece_bpe_32k.model"
DISCOUNT = 0.75
HOT_SHARES = 100_000
#: Expectation steps, each over all distinct training words.
STEPS = 4
#: (document, word) pairs after which a chunk is closed, and distinct words of a bucket.
CHUNK_PAIRS = 800_000
LEAST_BUCKETS = 12
BUCKET_WORDS = 100_000
#: Tokens a bucket has on average at most; its pairs are no more than its tokens.
BUCKET_TOKENS = 10_000_000
#: Fewer words than this are not worth a pass of array operations for every place: each is walked alone.
TOGETHER = 200
#: Distinct words that a task counts before it hands them on.
COUNTED_WORDS = 200_000
ZIPF = 2.7
LN10 = float(np.log(10))


def words_of(text: str | None) -> list[bytes]:
    """Runs of anything but space, tab, newline, vertical tab, form feed and return; A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


class Lattice:
    """Pieces by the hash of their bytes; `▁` is the space before a word."""

    BASE = np.uint64(0x9E3779B97F4A7C15 | 1)

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces: dict[bytes, float] = {}
        for i in range(model.get_piece_size()):
            if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                continue
            name = model.id_to_piece(i)
            text = bytes([int(name[3:5], 16)]) if model.is_byte(i) else name.replace("▁", " ").encode()
            # A byte has no merge rank: it comes after all merges.
            rank = model.get_piece_size() if model.is_byte(i) else -model.get_score(i)
            pieces[text] = min(rank, pieces.get(text, np.inf))
        self.pieces = sorted(pieces)
        start = -np.log(np.array([pieces[p] for p in self.pieces]) + ZIPF)
        self.start = start - np.logaddexp.reduce(start)
        keys = np.array([self._key(p) for p in self.pieces], np.uint64)
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        self.lengths = sorted({len(p) for p in self.pieces})
        self.powers = np.array([pow(int(self.BASE), n, 1 << 64) for n in range(max(self.lengths) + 1)], np.uint64)
        self.sizes = np.array([len(p) for p in self.pieces])
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, p in enumerate(self.pieces):
            self.automaton.add_word(p.decode("latin-1"), i)  # a character a byte
        self.automaton.make_automaton()

    def _key(self, piece: bytes) -> int:
        h = 0
        for b in piece:
            h = (h * int(self.BASE) + b + 1) % (1 << 64)
        return h

    def _step(self, n: int) -> int:
        """Words of `n` bytes that are summed together."""
        return 1_000_000 // (n * len(self.lengths))

    def split(self, words: list[bytes]) -> tuple[dict[int, list[int]], list[int]]:
        """Places of the words to be summed together, by length with the space, and of those walked alone."""
        by_length: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            by_length.setdefault(len(w) + 1, []).append(i)
        together = {n: places for n, places in by_length.items() if min(len(places), self._step(n)) >= TOGETHER}
        return together, [i for n, places in by_length.items() if n not in together for i in places]

    def batches(
        self, words: list[bytes], by_length: dict[int, list[int]]
    ) -> Iterator[tuple[np.ndarray, list[list[tuple[int, np.ndarray, np.ndarray]]]]]:
        """Words of one length at a time: (their places, for each end the arcs (length, rows, pieces))."""
        for n, places in by_length.items():
            step = self._step(n)
            for at in range(0, len(places), step):
                rows = np.array(places[at : at + step])
                text = np.frombuffer(b"".join([b" " + words[i] for i in rows]), np.uint8).reshape(len(rows), n).astype(np.uint64) + np.uint64(1)
                prefix = np.zeros((n + 1, len(rows)), np.uint64)
                for t in range(n):
                    prefix[t + 1] = prefix[t] * self.BASE + text[:, t]
                ends = []
                for t in range(1, n + 1):
                    arcs = []
                    for size in self.lengths:
                        if size > t:
                            break
                        h = prefix[t] - prefix[t - size] * self.powers[size]
                        k = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
                        hit = np.flatnonzero(self.keys[k] == h)
                        if len(hit):
                            arcs.append((size, hit, self.order[k[hit]]))
                    ends.append(arcs)
                yield rows, ends

    def _forward(self, n_rows: int, ends, weight: np.ndarray) -> np.ndarray:
        """Log sums up to each place, by row of weights and word."""
        alpha = np.full((len(ends) + 1, len(weight), n_rows), -np.inf)
        alpha[0] = 0
        for t, arcs in enumerate(ends, 1):
            for size, hit, piece in arcs:
                alpha[t][:, hit] = np.logaddexp(alpha[t][:, hit], alpha[t - size][:, hit] + weight[:, piece])
        return alpha

    def log_probability(self, words: list[bytes], weight: np.ndarray) -> np.ndarray:
        """Natural log of each word's marginal probability over all segmentations, for each row of weights."""
        out = np.zeros((len(words), len(weight)))
        together, alone = self.split(words)
        for rows, ends in self.batches(words, together):
            out[rows] = self._forward(len(rows), ends, weight)[-1].T
        for i in alone:
            ends, pieces = self._arcs(words[i])
            places = ends.tolist(), (ends - self.sizes[pieces]).tolist()
            out[i] = [self._walk(*places, row[pieces].tolist())[-1] for row in weight]
        return out

    def _arcs(self, word: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(ends, pieces) of all arcs of a word's lattice, by end. Every byte is a piece, so every place has an arc."""
        ends, pieces = array("q"), array("q")
        for end, piece in self.automaton.iter((b" " + word).decode("latin-1")):
            ends.append(end + 1)
            pieces.append(piece)
        return np.frombuffer(ends, np.int64), np.frombuffer(pieces, np.int64)

    @staticmethod
    def _walk(ends: list[int], starts: list[int], weight: list[float]) -> list[float]:
        """Log sums up to each place of one word."""
        exp, log1p, alpha, last, total = math.exp, math.log1p, [0.0], 1, -math.inf
        for end, start, w in zip(ends, starts, weight):
            if end != last:
                alpha.append(total)
                last, total = end, -math.inf
            value = alpha[start] + w
            if value > total:
                total, value = value, total
            total += log1p(exp(value - total))
        alpha.append(total)
        return alpha

    def expected(self, words: list[bytes], weight: np.ndarray) -> np.ndarray:
        """How often each piece is used, expected over the segmentations of all words."""
        total = np.zeros(len(self.pieces))
        together, alone = self.split(words)
        for i in alone:
            ends, pieces = self._arcs(words[i])
            starts, n = ends - self.sizes[pieces], len(words[i]) + 1
            alpha = np.array(self._walk(ends.tolist(), starts.tolist(), weight[pieces].tolist()))
            # The same walk from the other end: arcs by their start, backwards.
            back = np.lexsort((ends, starts))[::-1]
            beta = self._walk((n - starts[back]).tolist(), (n - ends[back]).tolist(), weight[pieces[back]].tolist())
            through = alpha[starts] + weight[pieces] + np.array(beta)[n - ends] - alpha[-1]
            total += np.bincount(pieces, np.exp(through), len(total))
        for rows, ends in self.batches(words, together):
            alpha = self._forward(len(rows), ends, weight[None, :])[:, 0]
            beta = np.full_like(alpha, -np.inf)
            beta[-1] = 0
            for t in range(len(ends), 0, -1):
                for size, hit, piece in ends[t - 1]:
                    through = weight[piece] + beta[t, hit]
                    beta[t - size, hit] = np.logaddexp(beta[t - size, hit], through)
                    total += np.bincount(piece, np.exp(alpha[t - size, hit] + through - alpha[-1, hit]), len(total))
        return total

    @staticmethod
    def weights(expected: np.ndarray) -> np.ndarray:
        """Log weights; no piece is impossible."""
        return np.log((expected + 0.01) / (expected + 0.01).sum(-1, keepdims=True))


_loaded: dict[object, object] = {}


def once(key: object, make):
    """Made once in a process; of each kind (the key's first part) the latest is kept."""
    if _loaded.get(key[0], (None,))[0] != key:
        _loaded[key[0]] = (key, make())
    return _loaded[key[0]][1]


def lattice(vocabulary: str) -> Lattice:
    path = tokenizer_path(vocabulary)
    return once(("lattice", path), lambda: Lattice(path))


@dataclass
class Model:
    docs: int  # training documents
    tokens: int  # training tokens, ends included
    types: int  # distinct words
    weight: np.ndarray  # log weights of the pieces
    vocabulary: str
    hot: list[bytes]
    hot_counts: np.ndarray

    @property
    def n(self) -> int:
        return self.tokens

    @property
    def v(self) -> int:
        """Distinct tokens, the end included."""
        return self.types + int(self.docs > 0)

    def log10_words(self, words: list[bytes], counts: np.ndarray) -> np.ndarray:
        """log10 probability of each word, from its training count (counts in columns are added up)."""
        return self.log10_scores(words, counts)[0]

    def log10_scores(self, words: list[bytes], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """`log10_words`, and log10 probability of each word under the vocabulary's scores alone."""
        # In logs throughout: the probability of a long unknown word is far below the least number.
        shapes = lattice(self.vocabulary)
        lattice_p, plain_p = shapes.log_probability(words, np.stack([self.weight, shapes.start])).T
        total = counts.sum(1) if counts.ndim > 1 else counts
        words_n = max(1, self.tokens - self.docs)
        spare = DISCOUNT * self.types / words_n if self.types else 1.0
        with np.errstate(divide="ignore"):  # words not seen: minus infinity
            seen = np.log(np.maximum(total - DISCOUNT, 0) / words_n)
        goes_on = np.log10(1 - self.end_share())
        return np.logaddexp(seen, np.log(spare) + lattice_p) / LN10 + goes_on, plain_p / LN10 + goes_on

    def end_share(self) -> float:
        """Of all tokens, the ends; never none or all."""
        return (self.docs + 0.5) / (self.tokens + 1.0)


def count_words(docs: DataFrame, text: str) -> DataFrame:
    """(word, n): training counts; the word null holds the documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def flush() -> pa.RecordBatch:
            columns = [pa.array(seen.keys(), pa.binary()), pa.array(seen.values(), pa.int64())]
            seen.clear()
            return pa.RecordBatch.from_arrays(columns, ["word", "n"])

        for batch in batches:
            for t in batch.column(0):
                seen.update(words_of(t.as_py()))
                seen[None] += 1
                if len(seen) >= COUNTED_WORDS:
                    yield flush()
        yield flush()

    pairs = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(count, "word binary, n long")
    return pairs.groupBy("word").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY) -> Model:
    """Learn from all rows of `docs`. Without rows the model knows the vocabulary's scores only."""
    spark = docs.sparkSession
    small_batches(spark)
    counts = stored(count_words(docs, text), "word-counts")
    words = counts.filter("word is not null")
    types, n_words = words.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).collect()[0]
    ends = counts.filter("word is null").collect()
    n_docs = ends[0]["n"] if ends else 0

    shapes = lattice(vocabulary)
    weight = shapes.start
    for _ in range(STEPS if types else 0):
        weight = shapes.weights(_expected(words, weight, vocabulary))

    hot = words.filter(F.col("n") * HOT_SHARES > n_words + n_docs).collect()
    hot.sort(key=lambda r: bytes(r["word"]))
    return Model(
        n_docs,
        n_words + n_docs,
        types,
        weight,
        vocabulary,
        [bytes(r["word"]) for r in hot],
        np.array([r["n"] for r in hot], np.float64),
    )


def _expected(words: DataFrame, weight: np.ndarray, vocabulary: str) -> np.ndarray:
    """How often each piece is used, expected over the segmentations of all distinct words."""
    sent = words.sparkSession.sparkContext.broadcast(weight)

    def expect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shapes = lattice(vocabulary)
        total = np.zeros_like(sent.value)
        held: list[bytes] = []
        for pdf in batches:
            held += map(bytes, pdf["word"])
            # Many words at a time: the arrays of one word length should be long.
            if len(held) >= 100_000:
                total += shapes.expected(held, sent.value)
                held = []
        total += shapes.expected(held, sent.value)
        piece = np.flatnonzero(total)
        yield pd.DataFrame({"piece": piece.astype(np.int32), "n": total[piece]})

    found = words.select("word").mapInPandas(expect, "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect()
    expected = np.zeros_like(weight)
    expected[[r["piece"] for r in found]] = [r["n"] for r in found]
    return expected


def _packed(words: list[bytes], word: np.ndarray, pairs: np.ndarray, n_buckets: int) -> Iterator[tuple[int, bytes]]:
    """(bucket, its words, their numbers of pairs, the pairs in that order); `word` holds each pair's place in `words`."""
    bucket = np.array([zlib.crc32(w) % n_buckets for w in words], np.int64)
    order = np.lexsort((word, bucket[word]))
    pairs, sizes = pairs[order], np.bincount(word, minlength=len(words))
    by_bucket = np.argsort(bucket, kind="stable")
    used, first = np.unique(bucket[by_bucket], return_index=True)
    at = 0
    for b, own in zip(used.tolist(), np.split(by_bucket, first[1:])):
        names, n = [words[i] for i in own.tolist()], int(sizes[own].sum())
        head = np.array([len(own), *map(len, names), *sizes[own].tolist()], "<u4").tobytes()
        yield b, head + b"".join(names) + pairs[at : at + n].astype("<u8").tobytes()
        at += n


def _unpacked(blob: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    n = int(np.frombuffer(blob, "<u4", 1)[0])
    sizes = np.frombuffer(blob, "<u4", 2 * n, 4)
    at, words = 4 + 8 * n, []
    for size in sizes[:n].tolist():
        words.append(blob[at : at + size])
        at += size
    return words, sizes[n:], np.frombuffer(blob, "<u8", offset=at)


def score(docs: DataFrame, model: Model, learnt: Column, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: id, learnt, n_tokens, n_known, base_score, score, lattice_score.

    `learnt` says which rows the model was trained on; it must be the rows given to `train`, as counts of rare words are
    taken from them again. A null or empty text has the end as its only token. Repeated rows are scored each; null ids
    pass. A very long text is one row of a task and is scored whole, in time that grows as its length, with or without spaces. Other columns
    are not read. An empty table gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    sent = spark.sparkContext.broadcast(model)
    number = zlib.crc32(model.weight.tobytes()) ^ zlib.crc32(model.hot_counts.tobytes()) ^ model.n
    n_buckets = max(LEAST_BUCKETS, -(-model.types // BUCKET_WORDS), -(-model.tokens // BUCKET_TOKENS))
    narrow = docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"), learnt.alias("learnt"))

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m: Model = sent.value
        hot = once(("hot", number), lambda: {w: i for i, w in enumerate(m.hot)})
        log, plain = once(("hot-log", number), lambda: m.log10_scores(m.hot, m.hot_counts))
        base, get = np.log10(m.hot_counts + 1), hot.get
        chunk = TaskContext.get().partitionId() << 24
        rows, rare, word, pairs = [], {}, array("q"), array("Q")

        def flush() -> pd.DataFrame:
            blobs = _packed(list(rare), np.array(word), np.array(pairs), n_buckets)
            blobs = pd.DataFrame(blobs, columns=["bucket", "blob"])
            found = pd.DataFrame(rows, columns=["id", "learnt", "n_tokens", "n_known", "base", "log", "plain", "place"])
            frame = pd.concat([found.assign(bucket=-1), blobs])[["bucket", "blob", *found.columns]]
            return frame.assign(chunk=chunk).astype({"n_tokens": "Int64", "n_known": "Int64", "place": "Int64"})

        for pdf in batches:
            for i, text, own in zip(pdf["id"], pdf["text"], pdf["learnt"]):
                c = Counter(words_of(text))
                ref = (len(rows) << 4 | bool(own)) << 32
                at = np.array([get(w, -1) for w in c], int)
                n = np.array(list(c.values()), float)
                is_hot = at >= 0
                for w, h in zip(c, at.tolist()):
                    if h < 0:
                        word.append(rare.setdefault(w, len(rare)))
                        pairs.append(ref | min(c[w], 0xFFFFFFFF))
                at, n = at[is_hot], n[is_hot]
                rows.append((i, own, c.total() + 1, int(n.sum()), *(float(n @ v[at]) for v in (base, log, plain)), len(rows)))
                if len(pairs) >= CHUNK_PAIRS:
                    yield flush()
                    chunk, rows, rare, word, pairs = chunk + 1, [], {}, array("q"), array("Q")
        if rows:
            yield flush()

    kind = dict(narrow.dtypes)["id"]
    doc_columns = f"id {kind}, learnt boolean, n_tokens long, n_known long, base double, log double, plain double, place long"
    dealt = stored(narrow.mapInPandas(deal, f"bucket int, blob binary, {doc_columns}, chunk long"), "lm-chunks")

    partial = np.dtype([("doc", "<u4"), ("known", "<f8"), ("base", "<f8"), ("log", "<f8"), ("plain", "<f8")])

    def look_up(pdf: pd.DataFrame) -> pd.DataFrame:
        m: Model = sent.value
        number_of: dict[bytes, int] = {}
        parts, used = [], np.zeros(1)
        for blob in pdf["blob"]:
            words, sizes, pairs = _unpacked(blob)
            word = np.repeat(np.array([number_of.setdefault(w, len(number_of)) for w in words], np.int32), sizes)
            parts.append((word, pairs))
            if len(number_of) > len(used):
                used = np.concatenate([used, np.zeros(len(number_of) + len(used))])
            own = (pairs >> np.uint64(32)) & np.uint64(15) > 0
            np.add.at(used, word[own], (pairs[own] & np.uint64(0xFFFFFFFF)).astype(float))
        counts = used[: len(number_of)]
        log, plain = m.log10_scores(list(number_of), counts)
        base = np.log10(counts + 1)
        out = []
        for chunk, (word, pairs) in zip(pdf["chunk"], parts):
            times = (pairs & np.uint64(0xFFFFFFFF)).astype(float)
            docs, of = np.unique(pairs >> np.uint64(36), return_inverse=True)
            found = np.zeros(len(docs), partial)
            found["doc"] = docs
            found["base"] = np.bincount(of, times * base[word])
            found["known"] = np.bincount(of, times * (counts > 0)[word])
            found["log"] = np.bincount(of, times * log[word])
            found["plain"] = np.bincount(of, times * plain[word])
            out.append((chunk, found.tobytes()))
        return pd.DataFrame(out, columns=["chunk", "sums"])

    looked = dealt.filter("bucket >= 0").groupBy("bucket").applyInPandas(look_up, "chunk long, sums binary")

    def finish(pdf: pd.DataFrame, parts: pd.DataFrame) -> pd.DataFrame:
        m: Model = sent.value
        pdf = pdf.sort_values("place")
        total = pdf[["base", "n_known", "log", "plain"]].to_numpy(float)
        for blob in parts["sums"]:
            part = np.frombuffer(blob, partial)
            total[part["doc"]] += np.column_stack([part[c] for c in ("base", "known", "log", "plain")])
        n = pdf["n_tokens"].to_numpy(np.int64)
        base = total[:, 0] + np.log10(m.docs + 1) - n * np.log10(m.n + m.v + 1)
        out = pdf[["id", "learnt"]].assign(n_tokens=n, n_known=np.round(total[:, 1]).astype(np.int64) + (m.docs > 0), base_score=base)
        return out.assign(score=total[:, 2] + np.log10(m.end_share()), lattice_score=total[:, 3] + np.log10(m.end_share()))

    heads = dealt.filter("bucket < 0").drop("bucket", "blob")
    found = heads.groupBy("chunk").cogroup(looked.groupBy("chunk")).applyInPandas(
        finish, f"id {kind}, learnt boolean, n_tokens long, n_known long, base_score double, score double, lattice_score double"
    )
    return found.withColumnRenamed("id", id)


def held_out(id: str = "doc_id") -> Column:
    return crc_mod(id, 7) == 2


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs.filter(~held_out()))
    found = score(docs, model, ~held_out())
    train_tokens = F.lit(model.n).cast("long").alias("train_tokens")
    return found.select("doc_id", (~F.col("learnt")).alias("held_out"), "n_tokens", "n_known", train_tokens, "base_score", "score", "lattice_score")


QUERIES: dict[str, tuple[Query, str | None]] = {"op10_lattice_lm": (op10, None)}
