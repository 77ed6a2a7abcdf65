"""Toxicity by subword bags: character n-gram embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the mean of the vectors of its hashed n-grams (and of itself), a bag the mean of the words of a stretch of text;
a linear softmax tells the class of a bag. Unseen misspellings share n-grams with words seen, so they get near vectors. A few insults
in a long text would vanish in one mean, so a text is judged by its worst bag of `BAG` words, and a one-dimensional
logistic fit turns that into the document's probability. Only the label of whole documents is known: bags of toxic
documents all count as toxic first, then only those that the model so far finds toxic, at least one a document.

The fit takes a bounded sample of labelled rows (`PER_CLASS` a label by hash of the id), their texts whole: the driver holds a number for each
word of the rows trained on, and the executors find the worst bags of the rows that fit the probability. Class shares are counted over
all labels. Scoring is a map over whole texts: at that point a word is one number, kept in a bounded cache.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.common import Query, class_sample, crc_mod, small_batches, stored, table

PER_CLASS = {1: 1500, 0: 4000}
#: An n-gram's vector is learnt from so many sample documents at least; rarer ones stay zero.
MIN_DOCS = 8
#: Of the sample, one in so many documents is kept from the training and fits the document's probability.
CALIBRATE = 4
LONGEST = 64
BITS = 17
DIM = 6
BAG = 12
STRIDE = 6
#: A bag of fewer words is averaged as if it had so many: one odd word is no verdict.
LEAST = 8
EPOCHS = (15, 15, 10)
RATE = {"e": 2.0, "a": 0.2, "b": 0.1}
CACHED_WORDS = 600_000
EDGES = ".,;:!?\"'`()[]{}<>|*#%&$_~^=+-/\\"


def words_of(text: str | None) -> list[str]:
    """Words in lower case; one of more than `LONGEST` characters as overlapping parts that each count as a word.

    Scripts without spaces, and words joined by dots or the like, give such words. A part begins each `LONGEST / 2` characters, so what is no
    longer than that lies whole in one of them.
    """
    words = (text or "").lower().split()
    if max(map(len, words), default=0) <= LONGEST:
        return words
    out = []
    for word in words:
        if len(word) > LONGEST and len(word := word.strip(EDGES)) > LONGEST:
            step = LONGEST // 2
            out += [word[i : i + LONGEST] for i in range(0, len(word) - step, step)]
        else:
            out.append(word)
    return out


def grams(word: str) -> list[int]:
    """Bucket numbers of a word's n-grams of 3 to 5 characters and of the word itself."""
    word = f"<{word.strip(EDGES)}>"
    parts = [word[i : i + n] for n in (3, 4, 5) for i in range(len(word) - n + 1)]
    return [zlib.crc32(p.encode("utf-8", "replace")) & ((1 << BITS) - 1) for p in (*parts, word + "=")]


def again(values: np.ndarray) -> np.ndarray:
    """Which entries repeat one of the `BAG - 1` before them: a word said over and over counts once."""
    found = np.zeros(len(values), bool)
    for lag in range(1, min(BAG, len(values))):
        found[lag:] |= values[lag:] == values[:-lag]
    return found


def bags(values: np.ndarray) -> np.ndarray:
    """Mean of the words' values in each bag: `BAG` words, a new one each `STRIDE` words, the last one to the end."""
    n = len(values)
    values = np.where(again(values), 0, values)
    total = np.concatenate([[0.0], np.cumsum(values)])
    start = np.arange(0, max(1, n - BAG + STRIDE), STRIDE)
    end = np.minimum(start + BAG, n)
    return (total[end] - total[start]) / np.maximum(end - start, LEAST)


@dataclass
class Model:
    gram_score: np.ndarray  # of each bucket: how much its vector speaks for label 1
    bias: float
    slope: float  # of the worst bag
    length: float  # of the log number of bags
    intercept: float

    def probability(self, values: np.ndarray) -> float:
        found = bags(values)
        z = self.slope * (found.max() + self.bias) + self.length * np.log(len(found)) + self.intercept
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


class WordScores(dict):
    """Score of each word as written, computed when first met; starts anew when full. A Python worker keeps it between tasks."""

    of_broadcast: dict[int, WordScores] = {}

    def __init__(self, gram_score: np.ndarray):
        super().__init__()
        self.gram_score = gram_score.tolist()

    def __missing__(self, word: str) -> float:
        if len(self) >= CACHED_WORDS:
            self.clear()
        at = grams(word)
        self[word] = score = sum(map(self.gram_score.__getitem__, at)) / len(at)
        return score


class _Bags:
    """Training bags as index arrays: bag -> words -> n-gram buckets."""

    def __init__(self, docs: list[np.ndarray], names: list[str]):
        """Of each document the numbers of its words in `names`, in their order."""
        tokens, bag, size, doc, n_bags = [], [], [], [], 0
        for d, ids in enumerate(docs):
            first = ~again(ids)
            own = np.arange(len(ids), dtype=np.int32) // BAG
            kept, at = np.unique(own[first], return_inverse=True)  # bags that hold a word
            tokens.append(ids[first])
            bag.append((at + n_bags).astype(np.int32))
            size.append(np.maximum(np.bincount(own), LEAST)[kept])
            doc.append(np.full(len(kept), d, np.int32))
            n_bags += len(kept)
        buckets, n_grams = array("i"), []
        for w in names:
            own = grams(w)
            buckets.extend(own)
            n_grams.append(len(own))
        self.n_words, self.doc = len(names), np.concatenate(doc)
        self.tokens, self.bag, self.size = np.concatenate(tokens), np.concatenate(bag), np.concatenate(size).astype(np.float32)[:, None]
        self.bag_starts = np.flatnonzero(np.diff(self.bag, prepend=-1))
        grams_ = np.array(buckets)
        self.n_grams = np.array(n_grams, np.float32)[:, None]
        # The way back: tokens by word and n-grams by bucket.
        self.by_word = np.argsort(self.tokens, kind="stable").astype(np.int32)
        self.word_starts = np.flatnonzero(np.diff(self.tokens[self.by_word], prepend=-1))
        # Documents of each bucket, by its words (a little over the true number where words of a document share it).
        word_doc = np.unique(self.doc[self.bag].astype(np.int64) * self.n_words + self.tokens)
        docs_of_word = np.bincount(word_doc % self.n_words, minlength=self.n_words)
        word_of = np.repeat(np.arange(self.n_words, dtype=np.int32), n_grams)
        learnt = np.bincount(grams_, weights=docs_of_word[word_of], minlength=1 << BITS) >= MIN_DOCS
        kept = learnt[grams_]
        self.buckets, self.grams = np.unique(grams_[kept], return_inverse=True)  # places among the learnt buckets
        self.word_of_gram = word_of[kept]
        self.gram_starts = np.flatnonzero(np.diff(self.word_of_gram, prepend=-1))
        self.words_with = self.word_of_gram[self.gram_starts]
        by_bucket = np.argsort(self.grams, kind="stable")
        self.word_by_bucket = self.word_of_gram[by_bucket]
        self.bucket_starts = np.flatnonzero(np.diff(self.grams[by_bucket], prepend=-1))


def train(docs: list[np.ndarray], names: list[str], labels: np.ndarray, seed: int = 7) -> tuple[np.ndarray, float, np.ndarray]:
    """Embeddings and softmax together, by gradient steps on all bags. Gives the score of each bucket and the bias.

    Steps are scaled by the running size of the gradient, but by no less than that of the frequent n-grams: else rare ones would move as
    fast as they and the sample be learnt by heart.
    """
    data = _Bags(docs, names)
    rng = np.random.default_rng(seed)
    weights = {
        "e": rng.normal(0, 0.1, (len(data.buckets), DIM)).astype(np.float32),
        "a": rng.normal(0, 0.3, (DIM, 2)).astype(np.float32),
        "b": np.zeros(2, np.float32),
    }
    bag_by_word = data.bag[data.by_word]
    mean = {k: np.zeros_like(v) for k, v in weights.items()}
    square = {k: np.zeros_like(v) for k, v in weights.items()}
    y = labels[data.doc].astype(int)
    use = np.ones(len(y), np.float32)
    step = 0

    def forward() -> tuple[np.ndarray, np.ndarray]:
        word = np.zeros((data.n_words, DIM), np.float32)
        word[data.words_with] = np.add.reduceat(weights["e"][data.grams], data.gram_starts, axis=0)
        word /= data.n_grams
        bag = np.add.reduceat(word[data.tokens], data.bag_starts, axis=0) / data.size
        z = bag @ weights["a"] + weights["b"]
        z -= z.max(1, keepdims=True)
        p = np.exp(z)
        return bag, p / p.sum(1, keepdims=True)

    for phase, epochs in enumerate(EPOCHS):
        if phase:
            p = forward()[1][:, 1]
            best = np.full(len(docs), -1.0)
            np.maximum.at(best, data.doc, p)
            use = np.where((y == 0) | (p >= 0.5) | (p >= best[data.doc]), 1, 0).astype(np.float32)
        share = use / np.where(y == 1, max(1e-9, 2 * use[y == 1].sum()), max(1e-9, 2 * use[y == 0].sum()))
        for _ in range(epochs):
            step += 1
            bag, p = forward()
            d = p.copy()
            d[np.arange(len(y)), y] -= 1
            d *= share[:, None]
            back = (d @ weights["a"].T) / data.size
            word = np.add.reduceat(back[bag_by_word], data.word_starts, axis=0) / data.n_grams
            gradient = {
                "e": np.add.reduceat(word[data.word_by_bucket], data.bucket_starts, axis=0),
                "a": bag.T @ d,
                "b": d.sum(0),
            }
            for k, g in gradient.items():
                mean[k] += 0.1 * (g - mean[k])
                square[k] += 0.01 * (g * g - square[k])
                size = np.sqrt(square[k] / (1 - 0.99**step))
                least = np.quantile(size, 0.995) if k == "e" else 1e-9
                weights[k] -= RATE[k] * mean[k] / (1 - 0.9**step) / (size + least)
    toward = weights["a"][:, 1] - weights["a"][:, 0]
    scores = np.zeros(1 << BITS)
    scores[data.buckets] = weights["e"] @ toward
    return scores, float(weights["b"][1] - weights["b"][0])


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Newton's method with a little shrinkage; the last column of x is the constant."""
    beta = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        g = x.T @ (weight * (p - y)) + 1e-3 * beta
        h = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + 1e-3 * np.eye(x.shape[1])
        beta -= np.clip(np.linalg.solve(h, g), -5, 5)
    return beta


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Learn from the documents of `docs` that `labels` marks 0 or 1; other marks and null are left out.

    Give only the rows to learn from. A document marked both ways counts as toxic. Without rows of one label the model answers the
    share of label 1, without any labels 0.
    """
    spark = docs.sparkSession
    small_batches(spark)
    marks = labels.filter(F.col(label).isin(0, 1) & F.col(id).isNotNull()).groupBy(F.col(id).alias("id")).agg(F.max(label).cast("int").alias("y"))
    shares = {r["y"]: r["n"] for r in marks.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    texts = docs.filter(F.col(id).isNotNull()).select(F.col(id).alias("id"), F.col(text).alias("text"))
    chosen = class_sample(marks, "y", F.xxhash64("id"), PER_CLASS)
    chosen = chosen.select("id", "y", (F.col("_rank") % CALIBRATE == 1).alias("apart"))
    sample = stored(texts.join(F.broadcast(chosen), "id"), "labelled")  # at most the rows of PER_CLASS, should ids not repeat
    parts = {(r["apart"], r["y"]) for r in sample.select("apart", "y").distinct().collect()}
    whole = len(parts) < 4  # too few rows to keep some apart
    share = shares.get(1, 0) / max(1, sum(shares.values()))

    def numbered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for i, text, y in zip(pdf["id"], pdf["text"], pdf["y"]):
                number: dict[str, int] = {}
                ids = [number.setdefault(w, len(number)) for w in words_of(text)]
                out.append((str(i), int(y), " ".join(number), np.array(ids, "<i4").tobytes()))
            yield pd.DataFrame(out, columns=["id", "y", "words", "ids"])

    got = sample.filter(F.lit(whole) | ~F.col("apart")).mapInPandas(numbered, "id string, y int, words string, ids binary").toPandas()
    got = got.sort_values(["id", "words", "ids"], kind="stable")
    number: dict[str, int] = {}
    found, y = [], got["y"].to_numpy(int)
    for words, ids in zip(got["words"], got["ids"]):
        own = np.array([number.setdefault(w, len(number)) for w in words.split(" ")] if ids else [], np.int32)
        found.append(own[np.frombuffer(ids, "<i4")])
    del got
    if len({label for _, label in parts}) < 2 or not any(map(len, found)):
        flat = np.clip(share, 1e-9, 1 - 1e-9)
        return Model(np.zeros(1 << BITS), 0.0, 0.0, 0.0, float(np.log(flat / (1 - flat))))
    scores, bias = train(found, list(number), y)
    del found, number
    sent = spark.sparkContext.broadcast(scores)

    def judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordScores(sent.value)
        for pdf in batches:
            found = [bags(np.array([known[w] for w in words_of(t)], float)) for t in pdf["text"]]
            yield pd.DataFrame({"y": pdf["y"], "worst": [float(v.max()) for v in found], "n": [len(v) for v in found]})

    got = sample.filter(F.lit(whole) | F.col("apart")).mapInPandas(judged, "y int, worst double, n long").toPandas()
    got = got.sort_values(["y", "worst", "n"])
    y, worst = got["y"].to_numpy(int), got["worst"].to_numpy()
    x = np.column_stack([worst + bias, np.log(got["n"].to_numpy(float)), np.ones(len(y))])
    weight = np.where(y == 1, share / max(1, (y == 1).sum()), (1 - share) / max(1, (y == 0).sum())) * len(y)
    slope, length, intercept = _logistic(x, y, weight)
    return Model(scores, bias, float(slope), float(length), float(intercept))


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "_toxicity") -> DataFrame:
    """`docs` with the column `out`, the probability of label 1 between 0 and 1.

    A null or empty text is an empty bag and gets a score too. Very long texts are read whole; equal texts get equal
    scores. All other columns pass untouched (one named `out` is replaced). An empty table stays empty.
    """
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    number = zlib.crc32(model.gram_score.tobytes()) ^ zlib.crc32(repr((model.bias, model.slope)).encode())

    @F.pandas_udf("double")
    def probability(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = sent.value
        if number not in WordScores.of_broadcast:
            WordScores.of_broadcast = {number: WordScores(model.gram_score)}  # of the latest model only
        known = WordScores.of_broadcast[number]
        for texts in batches:
            yield pd.Series([model.probability(np.array(list(map(known.__getitem__, words_of(t))), float)) for t in texts], dtype=float)

    return docs.withColumn(out, probability(F.col(text)))


def held_out(id: str = "doc_id") -> Column:
    return crc_mod(id, 5) == 0


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    learn = ~held_out()
    model = fit(docs.filter(learn), table(spark, sf_dir, "labels").filter(learn))
    return score(docs, model).select(
        "doc_id",
        held_out().alias("held_out"),
        F.col("_toxicity").alias("score"),
        (F.col("_toxicity") >= 0.5).cast("int").alias("predicted"),
    )


QUERIES: dict[str, tuple[Query, str | None]] = {"op2_toxicity": (op2, None)}
