"""Mixture-controlled packing: deficit round-robin over source queues.

Every source is a queue of tokens. In each window of `WINDOW` tokens the queues are served in turn, each with the tokens due to it by its
target share; what rounding leaves undone is its deficit and is carried to the next window. When a queue runs dry, the others share the
rest by their targets (a new phase). Without targets the shares are the sources' own, and all queues end together in the last
window: then every window has the corpus's proportions. Windows are full but the last.

What a queue gets up to a place in the output is a closed formula of the place (`Schedule`), so deficits need no pass from
window to window or from partition to partition: texts are tokenised and written once, token counts by task and source
are summed into each document's place in its queue, and each document then finds its own pieces.

A source with less than one token in a window can't have a queue of its own served in each; such sources share one queue. So
there are at most `WINDOW` queues whatever the corpus, and the schedule stays small. In the shared queue the sources are dealt by blocks of
`BLOCK` tokens, in order of a block's fractional place within its source: at any place each has had its share but for about a block, and what
a window leaves undone comes in later ones.
"""

from __future__ import annotations

import bisect
import json
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadpulse.llm.common import Query, small_batches, stored, table, tokenizer_path
from roadpulse.operators.ordering import running_totals

WINDOW = 2048
VOCABULARY = "byte_bpe_50k.json"
#: The id after each document.
END_ID = 1
REST = ""
#: Tokens of a document of a small source that stay together.
BLOCK = 64

_loaded: dict[str, object] = {}


def tokenizer(path: str):
    """A byte-level BPE vocabulary file as a fast encoder that gives the same ids as the `tokenizers` library."""
    if path not in _loaded:
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        from roadpulse.llm.bpe import byte_chars

        byte_of = {c: b for b, c in enumerate(byte_chars())}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        encoder = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
        names = set(special)
        _loaded[path] = lambda text: encoder.encode_to_numpy(text, allowed_special=names)
    return _loaded[path]


class Schedule:
    """Who is served where, in phases: (first place, length, cumulated weights of the queues, tokens served before).

    In a phase the queues are the leaves of a balanced binary tree. Of the first x places of a node its left branch gets
    `floor(x * weight of the left / weight of both)` and the right branch the others. Both only grow with x, so each queue's
    tokens come in order, and a queue is off its share by one token a level of the tree at most, at any place: that is the deficit carried.
    """

    def __init__(self, sizes: list[int], weights: list[int], window: int = WINDOW):
        self.window, self.n = window, len(sizes)
        left, self.phases = list(sizes), []
        got = [0] * self.n
        slack = (self.n - 1).bit_length()

        def serve(due: dict[int, int], length: int) -> None:
            cumulated = self._cumulated(due)
            self.phases.append((sum(got), length, cumulated, list(got)))
            for j, s in enumerate(self._shares(due, length)):
                got[j] += s
                left[j] -= s

        while any(left):
            alive = [j for j in range(self.n) if left[j] and weights[j]] or [j for j in range(self.n) if left[j]]
            due = {j: weights[j] or left[j] for j in alive}
            total = sum(due.values())
            last = {j: left[j] * total // due[j] for j in alive}
            length = min(last.values())
            if any(s > left[j] for j, s in enumerate(self._shares(due, length))):
                length = min((left[j] - slack) * total // due[j] for j in alive)
            if length > 0:
                serve(due, length)
            # The queues that end here give what rounding has left behind.
            over = {j: left[j] for j in alive if left[j] and last[j] <= min(last.values()) + slack * total // due[j]}
            if over and left[min(last, key=last.get)]:
                serve(over, sum(over.values()))
        self.total = sum(got)

    def _cumulated(self, due: dict[int, int]) -> list[int]:
        out = [0]
        for j in range(self.n):
            out.append(out[-1] + due.get(j, 0))
        return out

    def _shares(self, due: dict[int, int], x: int) -> list[int]:
        cumulated = self._cumulated(due)
        return [self._dealt(cumulated, j, x)[1] for j in range(self.n)]

    def _dealt(self, cumulated: list[int], j: int, x: int) -> tuple[int, int]:
        """Of the first x places of a phase: those of the queues before j, and those of j."""
        low, high, before = 0, self.n, 0
        while high - low > 1:
            middle = (low + high) // 2
            both = cumulated[high] - cumulated[low]
            left = x * (cumulated[middle] - cumulated[low]) // both if both else 0
            if j < middle:
                x, high = left, middle
            else:
                before, x, low = before + left, x - left, middle
        return before, x

    def pieces(self, j: int, start: int, length: int) -> Iterator[tuple[int, int, int, int]]:
        """Where tokens [start, start + length) of queue j go: (first of the queue's tokens, number, window, offset)."""
        phase = max(0, bisect.bisect_right(self.phases, start, key=lambda p: p[3][j]) - 1)
        at, end, window = start, start + length, -1
        while at < end:
            first, size, cumulated, got = self.phases[phase]
            own, last = cumulated[j + 1] - cumulated[j], (first + size - 1) // self.window

            def up_to(w: int) -> tuple[int, int, int]:
                """Place within the phase where window w begins, and what it and earlier places gave: others before, own."""
                x = min(size, max(0, w * self.window - first))
                before, served = self._dealt(cumulated, j, x)
                return x, before, got[j] + served

            if not own or up_to(last + 1)[2] <= at:
                phase, window = phase + 1, -1
                continue
            if window < 0:
                # The window in which the queue's token `at` lies: estimated by the share, then put right.
                window = (first + min(size - 1, (at - got[j]) * cumulated[-1] // own)) // self.window
                while window * self.window > first and up_to(window)[2] > at:
                    window -= 1
                while up_to(window + 1)[2] <= at:
                    window += 1
            low = up_to(window)
            while at < end and window <= last:
                high = up_to(window + 1)
                n = min(end, high[2]) - at
                if n > 0:
                    turn = high[1] - low[1]
                    yield at, n, window, first + low[0] - window * self.window + turn + at - low[2]
                    at += n
                window, low = window + 1, high
            phase, window = phase + 1, -1


def _queue_key(source: str) -> F.Column:
    return F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("-"))


def tokenised(docs: DataFrame, id: str, text: str, source: str, vocabulary: str, end_id: int) -> DataFrame:
    """(id, source key, task, place in the task's part of the source, tokens, ids): written once, in the order read."""
    small_batches(docs.sparkSession)
    narrow = docs.select(F.col(id).alias("id"), _queue_key(source).alias("source"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, task, seen = tokenizer(tokenizer_path(vocabulary)), TaskContext.get().partitionId(), {}
        for pdf in batches:
            out = []
            for i, key, text in zip(pdf["id"], pdf["source"], pdf["text"]):
                ids = np.append(encode(text or ""), np.uint32(end_id)).astype("<u4")
                start = seen.get(key, 0)
                seen[key] = start + len(ids)
                # Two bytes an id where that does: half the file.
                out.append((i, key, task, start, len(ids), (ids.astype("<u2") if ids.max() < 65536 else ids).tobytes()))
            yield pd.DataFrame(out, columns=["id", "source", "task", "start", "n", "ids"]).astype({"id": pdf["id"].dtype})

    kind = dict(narrow.dtypes)["id"]
    return stored(narrow.mapInPandas(run, f"id {kind}, source string, task int, start long, n long, ids binary"), "tokens")


def _shared_queue(tokens: DataFrame, placed: DataFrame, sums: DataFrame) -> DataFrame:
    """`tokens` of the small sources with `bases`: the place of each block in the queue they share.

    A block that starts at token s of its source's n lies at (s + u * length) / n, where u is the source's own number between 0 and 1: else
    the first blocks of all sources would meet at one place. Sources keep their order. Blocks are sorted in range partitions, whose sums are added up.
    """
    of = placed.join(sums.withColumnRenamed("n", "of"), "source").withColumn("u", F.pmod(F.xxhash64("source"), F.lit(1 << 20)) / (1 << 20))
    docs = tokens.select("task", "source", "start", "n").join(of, ["task", "source"])
    blocks = docs.withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(BLOCK).cast("long"))))
    blocks = blocks.withColumn("length", F.least(F.lit(BLOCK).cast("long"), F.col("n") - F.col("at")))
    place = F.col("base") + F.col("start") + F.col("at")
    key = F.struct(((place + F.col("u") * F.col("length")) / F.col("of")).alias("share"), F.col("source"), place.alias("place"))
    blocks = stored(blocks.select(key.alias("key"), "task", "start", "at", "length"), "blocks")
    dealt = running_totals(blocks, "key", ["length"])
    run = F.sort_array(F.collect_list(F.struct("at", (F.col("cum_length") - F.col("length")).alias("first"))))
    bases = dealt.groupBy("task", F.col("key.source").alias("source"), "start").agg(run["first"].alias("bases"))
    return tokens.join(placed.drop("base"), ["task", "source"]).join(bases, ["task", "source", "start"])


def pack(
    docs: DataFrame,
    targets: dict[str | None, float] | None = None,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    window: int = WINDOW,
    vocabulary: str = VOCABULARY,
    end_id: int = END_ID,
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source.

    Every token of every document (its ids, then `end_id`) lies in one piece; null texts count as empty and have the
    end only. `targets` gives weights of sources (None: rows without a source); sources it doesn't name are served by their own
    share of the rest of the weight, or last if it leaves none. Without it all are served by their own share. Null ids and repeated
    rows are documents of their own. An empty table gives no rows. Order within a source is that of the files read.
    """
    spark = docs.sparkSession
    tokens = tokenised(docs, id, text, source, vocabulary, end_id)
    parts = stored(tokens.groupBy("task", "source").agg(F.sum("n").alias("n")), "part-sizes")
    total = parts.agg(F.sum("n")).collect()[0][0] or 0
    named = {"-" if k is None else f"={k}": w for k, w in (targets or {}).items()}
    if len(named) > window:
        raise ValueError(f"at most {window} sources can have a target")
    sums = parts.groupBy("source").agg(F.sum("n").alias("n"))
    # At most `window` sources hold so much, and as many are named.
    large = {r["source"]: r["n"] for r in sums.filter((F.col("n") * window >= total) | F.col("source").isin(list(named))).collect()}
    queues = sorted(large)
    sizes = [large[q] for q in queues] + [total - sum(large.values())]
    rest = [0 if q in named else s for q, s in zip([*queues, REST], sizes)]
    given = [Fraction(named.get(q, 0)).limit_denominator(10**6) for q in [*queues, REST]]
    spare = max(Fraction(0), 1 - sum(given)) if named else Fraction(1)
    shares = [g + (spare * Fraction(r, sum(rest)) if r else 0) for g, r in zip(given, rest)]
    scale = int(np.lcm.reduce([f.denominator for f in shares], dtype=object)) if shares else 1
    schedule = Schedule(sizes, [int(f * scale) for f in shares], window)
    sent = spark.sparkContext.broadcast(schedule)

    # Each task's place in its sources.
    number = spark.createDataFrame([(q, k) for k, q in enumerate(queues)], "source string, queue int")
    over = Window.partitionBy("source").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.withColumn("base", F.coalesce(F.sum("n").over(over), F.lit(0))).drop("n")
    placed = stored(before.join(F.broadcast(number), "source", "left").fillna({"queue": len(queues)}), "queue-places")
    located = tokens.join(placed.filter(F.col("queue") < len(queues)), ["task", "source"])
    located = located.withColumn("bases", F.array(F.col("base") + F.col("start"))).drop("base")
    if sizes[-1]:
        located = located.unionByName(_shared_queue(tokens, placed.filter(F.col("queue") == len(queues)), sums))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        plan = sent.value
        for pdf in batches:
            out = []
            for i, q, bases, n, ids, key in zip(*(pdf[c] for c in ("id", "queue", "bases", "n", "ids", "source"))):
                wide = np.frombuffer(ids, "<u2" if len(ids) == 2 * n else "<u4").astype("<u4")
                name = None if key == "-" else key[1:]
                size = BLOCK if q == len(queues) else int(n)
                for begin, first in zip(range(0, int(n), size), bases):
                    for at, k, sequence, offset in plan.pieces(int(q), int(first), min(size, int(n) - begin)):
                        at += begin - int(first)
                        out.append((i, at, k, zlib.crc32(wide[at : at + k]), int(n), sequence, offset, name))
            cols = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source"]
            yield pd.DataFrame(out, columns=cols).astype({"id": pdf["id"].dtype})

    kind = dict(located.dtypes)["id"]
    schema = f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string"
    return located.mapInPandas(cut, schema).withColumnRenamed("id", id)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


QUERIES: dict[str, tuple[Query, str | None]] = {"op3_packing": (op3, None)}
