"""Language ID by nearest centroids of normalised TF-IDF character n-gram vectors.

The fit takes a bounded sample of labelled documents (`PER_LANG` a language by hash of the id, `MAX_SAMPLE` in all), whose
n-gram counts are made on the executors; the driver weights them, normalises them and clusters each language's vectors
into `CENTROIDS` spherical centroids. A text goes to the language of its nearest centroid by cosine. It is rejected when it has no
letter or lies further from that centroid than texts of its length do in the sample (`REJECT`).

Prediction is a map over whole texts without a shuffle: the model (centroids times 2**BITS floats) is all that is sent out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.common import Query, class_sample, crc_mod, small_batches, table

BITS = 13
#: Sample rows of a language, and of all languages together; with very many languages each still has one row.
PER_LANG = 400
MAX_SAMPLE = 4000
#: Centroids of a language, and of all together before languages get fewer, one at least.
CENTROIDS = 4
MAX_CENTROIDS = 2000
ROUNDS = 8
#: A text is rejected below this part of the similarity that 99 % of sample texts of its length reach.
REJECT = 0.4
#: Code points handled at once; n-grams don't cross such a border.
CHUNK = 1 << 20
UNDETERMINED = "und"

_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def gram_counts(text: str | None) -> np.ndarray:
    """Hashed counts of 1- to 3-grams of letters in lower case; anything between words is one space."""
    counts = np.zeros(1 << BITS, np.float64)
    low = (text or "").lower()
    for at in range(0, len(low), CHUNK):
        points = np.frombuffer(low[at : at + CHUNK].encode("utf-32-le", "surrogatepass"), "<u4")
        is_letter = letters()[points]
        if not is_letter.any():
            continue
        kept = is_letter.copy()
        kept[1:] |= is_letter[:-1]  # the first other character after a word
        a = np.concatenate([[32], np.where(is_letter, points, 32)[kept], [32]]).astype(np.uint32)
        mix, shift = np.uint32(2654435761), np.uint32(32 - BITS)
        two = a[:-1] * np.uint32(0x01000193) + a[1:]
        three = two[:-1] * np.uint32(0x01000193) + a[2:]
        for gram in (a[a != 32], two + np.uint32(0x9E3779B9), three + np.uint32(0x7F4A7C15)):
            gram = gram * mix
            gram ^= gram >> np.uint32(15)
            counts += np.bincount((gram * mix) >> shift, minlength=1 << BITS)
    return counts


def excerpt(text: str, id_hash: int) -> str:
    """1 to 128 words from somewhere in the text, to learn how near short texts come."""
    words = text.split()
    n = 1 << (id_hash % 8)
    start = (id_hash // 8) % max(1, len(words) - n + 1)
    return " ".join(words[start : start + n])


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray
    centroids: np.ndarray  # unit rows
    owner: np.ndarray  # of each centroid, its place in langs
    floor: np.ndarray  # least similarity by bit length of the n-gram count

    def vector(self, counts: np.ndarray) -> np.ndarray:
        v = np.zeros_like(counts)
        has = counts > 0
        v[has] = (1 + np.log(counts[has])) * self.idf[has]
        return v / (np.sqrt(v @ v) or 1)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, cosine, rejected)"""
        counts = gram_counts(text)
        total = int(counts.sum())
        if not total:
            return UNDETERMINED, 0.0, True
        if not self.langs:
            return UNDETERMINED, 0.0, False
        near = self.centroids @ self.vector(counts)
        best = int(near.argmax())
        score = float(min(1.0, max(0.0, near[best])))
        return self.langs[self.owner[best]], score, score < self.floor[min(total.bit_length(), len(self.floor) - 1)]


def clustered(x: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means; starts from the rows furthest from those chosen before."""
    chosen = [int((x @ x.mean(0)).argmax())]
    while len(chosen) < min(k, len(x)):
        chosen.append(int((x @ x[chosen].T).max(1).argmin()))
    centres = x[chosen]
    for _ in range(ROUNDS):
        of = (x @ centres.T).argmax(1)
        centres = np.stack([x[of == j].sum(0) if (of == j).any() else centres[j] for j in range(len(centres))])
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
    return centres


def fit(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Learn from the rows of `docs` whose language is not null and whose text has a letter.

    The sample holds the rows with the smallest hash of the id, language by language, so it doesn't depend on the
    order or number of files. No such row: a model without languages.
    """
    small_batches(docs.sparkSession)
    rows = docs.filter(F.col(lang).isNotNull()).select(
        F.col(id).cast("string").alias("id"), F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")
    )
    hashed = F.xxhash64("id", "lang")
    chosen = class_sample(rows.select("id", "lang"), "lang", hashed, PER_LANG, MAX_SAMPLE)
    # At most MAX_SAMPLE rows, or one a language: read the texts of just these.
    sample = rows.join(F.broadcast(chosen.select("id", "lang").distinct()), ["id", "lang"], "left_semi").withColumn("h", hashed)
    sample = sample.filter(F.col("text").rlike(r"\p{L}"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for lang, text, h in zip(pdf["lang"], pdf["text"], pdf["h"]):
                for whole, part in ((True, text), (False, excerpt(text, int(h) & (2**62 - 1)))):
                    c = gram_counts(part)
                    at = np.flatnonzero(c)
                    out.append((lang, whole, int(h), at.astype("<u2").tobytes(), c[at].astype("<f4").tobytes()))
            yield pd.DataFrame(out, columns=["lang", "whole", "h", "at", "n"])

    found = sample.mapInPandas(count, "lang string, whole boolean, h long, at binary, n binary")
    got = found.toPandas().sort_values(["lang", "whole", "h", "at"], kind="stable")
    if not len(got):
        return Model([], np.zeros(0), np.zeros((0, 0)), np.zeros(0, int), np.zeros(0))
    sparse = [(np.frombuffer(at, "<u2"), np.frombuffer(n, "<f4")) for at, n in zip(got["at"], got["n"])]
    whole, of = got["whole"].to_numpy(bool), got["lang"].to_numpy()
    entire = [i for i in range(len(got)) if whole[i]]
    holding = np.bincount(np.concatenate([sparse[i][0] for i in entire]), minlength=1 << BITS)
    langs = sorted(set(of))
    model = Model(langs, np.log((1 + len(entire)) / (1 + holding)) + 1, np.zeros((0, 0)), np.zeros(0, int), np.zeros(0))

    def vector(i: int) -> np.ndarray:
        counts = np.zeros(1 << BITS)
        counts[sparse[i][0]] = sparse[i][1]
        return model.vector(counts).astype(np.float32)

    centroids = max(1, min(CENTROIDS, MAX_CENTROIDS // len(langs)))
    own_rows = {name: [] for name in langs}
    for i in entire:
        own_rows[of[i]].append(i)
    groups = [clustered(np.stack([vector(i) for i in own_rows[name]]), centroids) for name in langs]
    model.centroids = np.concatenate(groups).astype(np.float32)
    model.owner = np.repeat(np.arange(len(langs)), [len(g) for g in groups])
    # How near texts come to their own language, by length; longer texts are never held to less.
    places = dict(zip(langs, groups))
    own = np.array([(places[of[i]].astype(np.float32) @ vector(i)).max() for i in range(len(got))])
    bits = np.array([int(n.sum()).bit_length() for _, n in sparse])
    low = np.array([np.quantile(own[bits == b], 0.01) if (bits == b).any() else np.inf for b in range(65)])
    least = np.minimum.accumulate(low[::-1])[::-1]
    floor = np.where(np.isfinite(least), least, least[np.isfinite(least)].max())
    floor[: int(bits.min())] = 0  # shorter than anything seen
    model.floor = REJECT * np.maximum(floor, 0)
    return model


def identify(docs: DataFrame, model: Model, text: str = "text", out: str = "_lid") -> DataFrame:
    """`docs` with the column `out`: struct of lang_pred, score and rejected.

    A null text or one without a letter is `und`, score 0, rejected. All other columns pass untouched (one named `out` is replaced);
    rows that repeat give the same answer each, and an empty table stays empty. Of centroids that tie the first language by
    name wins. With a model without languages every text is `und`, and only those without letters are rejected.
    """
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def predict(texts: pd.Series) -> pd.DataFrame:
        found = [sent.value.predict(t) for t in texts]
        return pd.DataFrame(found, columns=["lang_pred", "score", "rejected"])

    return docs.withColumn(out, predict(F.col(text)))


def held_out(id: str = "doc_id") -> Column:
    return crc_mod(id, 4) == 2


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.filter(~held_out()))
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out().alias("held_out"), "_lid.lang_pred", "_lid.score", "_lid.rejected")


QUERIES: dict[str, tuple[Query, str | None]] = {"op7_language_id": (op7, None)}
