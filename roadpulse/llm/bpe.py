"""Exact BPE encoding by backtracking over longest matches, and decoding by an offset table.

The vocabulary's tokens form an Aho-Corasick automaton that gives the longest token at each place of a word. The encoder takes the
longest token that is compatible with the one before it, shorter prefixes of it otherwise, and steps back when
none is; places that led nowhere are marked, so each is left at most once and the time is linear. Two
tokens are compatible when merging their joined text by the rules gives just these two: that is read off the merges, undoing them along
the border. A sequence of pairwise compatible tokens is what merging by rank gives for the word.

Words are encoded once while they are in a worker's bounded cache. The normaliser (NFC, white space, lower case) and the word pattern are
those named in the vocabulary file; the file is read by path on the executors and never copied. Texts with characters younger than the Unicode tables
of this Python, which other tables may read as letters, are normalised and cut into words by the `tokenizers` library itself.
"""

from __future__ import annotations

import functools
import hashlib
import json
import struct
import unicodedata
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from roadpulse.llm.common import Query, small_batches, table, tokenizer_path

VOCABULARY = "word_bpe_49k.json"
CACHED_WORDS = 250_000
#: Words longer than this are encoded but not kept.
CACHED_LENGTH = 200
#: Unicode's White_Space, and the vocabulary's word pattern with it written out.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
WORD = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{SPACE}\p{{L}}\p{{N}}]+")


@functools.cache
def unassigned() -> np.ndarray:
    """For each code point, whether it has no meaning in this Python's Unicode tables: only there can other versions differ."""
    return np.fromiter((unicodedata.category(chr(c)) == "Cn" for c in range(0x110000)), bool, 0x110000)


def has_unassigned(text: str) -> bool:
    return bool(unassigned()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")].any())


#: Stands for the end of a word inside tokens; always part of the token before it.
END = "\ue000"


def byte_chars() -> list[str]:
    """The character that byte-level vocabularies write for each byte: printable ones as themselves, the rest from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class Bpe:
    """One vocabulary. Tokens are numbered by rank inside: base symbols first, then merges in order."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        suffix = spec["model"]["end_of_word_suffix"]
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        made = {a + b for a, b in merges}
        base = sorted((t for t in vocab if t not in made and t not in self.added), key=vocab.get)
        rank = {t: i for i, t in enumerate(base)}
        self.pairs: dict[tuple[int, int], int] = {}
        self.split = [(i, i) for i in range(len(base))]
        self.ids = [vocab[t] for t in base]
        for a, b in merges:
            new = len(self.split)
            if a + b in rank:
                raise ValueError("a token is made by two merges: compatibility can't be read off the merges")
            rank[a + b] = new
            self.pairs[rank[a], rank[b]] = new
            self.split.append((rank[a], rank[b]))
            self.ids.append(vocab[a + b])
        inner = {(t.removesuffix(suffix) + END if t.endswith(suffix) else t): r for t, r in rank.items()}
        self.length = [0] * len(self.split)
        self.shorter = [-1] * len(self.split)  # longest token that is a proper prefix
        self.automaton = ahocorasick.Automaton()
        for t, r in inner.items():
            self.length[r] = len(t)
            self.automaton.add_word(t, r)
            for n in range(len(t) - 1, 0, -1):
                if t[:n] in inner:
                    self.shorter[r] = inner[t[:n]]
                    break
        self.automaton.make_automaton()
        self.chars = byte_chars()
        # Decoding: all tokens as one text, and where each begins.
        texts = [""] * (max([*vocab.values(), *self.added.values()]) + 1)
        for t, i in (*vocab.items(), *self.added.items()):
            texts[i] = t
        self.texts = "".join(texts)
        self.offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).tolist()
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.known: dict[str, tuple[bytes, str, int]] = {}

    def compatible(self, left: int, right: int) -> bool:
        """Whether the merges leave a border between two tokens: undo merges at it, latest first, and look for one that would cross it sooner."""
        limit = 1 << 60
        while True:
            if self.pairs.get((left, right), limit) < limit:
                return False
            if left > right:
                limit, (_, part) = left, self.split[left]
                if part != left:
                    left = part
                    continue
                limit = right + 1
                if self.split[right][0] == right:
                    return True
                right = self.split[right][0]
            else:
                limit, (part, _) = right + 1, self.split[right]
                if part != right:
                    right = part
                    continue
                limit = left
                if self.split[left][1] == left:
                    return True
                left = self.split[left][1]

    def encode_word(self, word: str) -> list[int]:
        """Ids of one word of the pattern, not cached."""
        chars = self.chars
        text = "".join([chars[b] for b in word.encode("utf-8", "replace")]) + END
        n = len(text)
        longest = [-1] * (n + 1)
        length = self.length
        for last, token in self.automaton.iter(text):
            start = last + 1 - length[token]
            if longest[start] < 0 or length[token] > length[longest[start]]:
                longest[start] = token
        out: list[int] = []
        open_ = [True] * (n + 1)
        at, token = 0, longest[0]
        while at < n:
            before = out[-1] if out else -1
            while True:
                if token >= 0:
                    end = at + length[token]
                    if open_[end] and (end == n or longest[end] >= 0) and (before < 0 or self.compatible(before, token)):
                        out.append(token)
                        at, token = end, longest[end]
                        break
                    token = self.shorter[token]
                else:
                    if not out:
                        raise ValueError(f"no tokens for {word!r}")
                    open_[at] = False
                    token = out.pop()
                    at -= length[token]
                    break
        return [self.ids[t] for t in out]

    def decode(self, ids: list[int]) -> str:
        """Tokens by their places in the offset table, a space between them."""
        texts, offsets = self.texts, self.offsets
        return " ".join([texts[offsets[i] : offsets[i + 1]] for i in ids])

    def _word(self, word: str) -> tuple[bytes, str, int]:
        ids = self.encode_word(word)
        found = (struct.pack(f"<{len(ids)}I", *ids), self.decode(ids), len(ids))
        if len(word) <= CACHED_LENGTH:
            if len(self.known) >= CACHED_WORDS:
                self.known.clear()
            self.known[word] = found
        return found

    def _library_words(self, part: str) -> list[str]:
        normal = self.library.normalizer.normalize_str(part)
        return [normal[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(normal)]

    def pieces(self, text: str) -> list[tuple[bytes, str, int]]:
        """Of each word in turn: its ids as bytes, their text, their number."""
        parts = self.special.split(text) if self.special and "<|" in text else [text]
        out = []
        get, word_of = self.known.get, self._word
        for k, part in enumerate(parts):
            if k % 2:
                i = self.added[part]
                out.append((struct.pack("<I", i), part, 1))
                continue
            if not part.isascii() and has_unassigned(part):
                out += [get(w) or word_of(w) for w in self._library_words(part)]
                continue
            if not part.isascii():
                # One character at a time, as the vocabulary's normaliser does: a final sigma is no special case.
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ")
            out += [get(w) or word_of(w) for w in WORD.findall(part.lower())]
        return out

    def encode(self, text: str) -> list[int]:
        joined = b"".join([p[0] for p in self.pieces(text)])
        return list(struct.unpack(f"<{len(joined) // 4}I", joined))


_loaded: dict[str, Bpe] = {}


def loaded(path: str) -> Bpe:
    """The vocabulary, read once in a process."""
    if path not in _loaded:
        _loaded[path] = Bpe(path)
    return _loaded[path]


def digests(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY, out: str = "_bpe") -> DataFrame:
    """`docs` with the column `out`: struct of n_tokens, ids_sha256 and decoded_sha256 of the whole text.

    A null text counts as empty: no tokens, digests of nothing. Strings of added tokens in a text are those tokens. All other columns
    pass untouched (one named `out` is replaced); repeated rows get the same answer each; an empty table stays empty.
    """
    small_batches(docs.sparkSession)

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = loaded(tokenizer_path(vocabulary))
        for texts in batches:
            out = []
            for text in texts:
                found = bpe.pieces(text or "")
                ids = hashlib.sha256(b"".join([p[0] for p in found])).hexdigest()
                decoded = hashlib.sha256(" ".join([p[1] for p in found]).encode("utf-8", "replace")).hexdigest()
                out.append((sum([p[2] for p in found]), ids, decoded))
            yield pd.DataFrame(out, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.withColumn(out, digest(F.col(text)))


def encode(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """`docs` with the column `_ids`, the token ids of the whole text; no ids for a null or empty text."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        bpe = loaded(tokenizer_path(vocabulary))
        return pd.Series([np.array(bpe.encode(t or ""), np.int32) for t in texts], dtype=object)

    return docs.withColumn("_ids", ids(F.col(text)))


def decode(docs: DataFrame, ids: str = "_ids", vocabulary: str = VOCABULARY) -> DataFrame:
    """`docs` with the column `_decoded`: the tokens' texts with a space between them; null ids give the empty text."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("string")
    def decoded(found: pd.Series) -> pd.Series:
        bpe = loaded(tokenizer_path(vocabulary))
        return pd.Series([bpe.decode([] if x is None else [int(i) for i in x]) for x in found], dtype=object)

    return docs.withColumn("_decoded", decoded(F.col(ids)))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(docs).select("doc_id", "_bpe.n_tokens", "_bpe.ids_sha256", "_bpe.decoded_sha256")


QUERIES: dict[str, tuple[Query, str | None]] = {"op8_bpe": (op8, None)}
