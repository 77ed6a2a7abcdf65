"""Long-match dedup where a shard gets a little from each of many chunks: its steps grow with the stretches, not with the chunks."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from roadpulse.llm import suffix_dedup


@pytest.mark.parametrize("round_bytes", [48_000_000, 40_000])
def test_chunks_share_batches(spark, monkeypatch, round_bytes):
    from test_corpus_operators import brute_repeats

    rng = random.Random(7)
    pool = ["".join(rng.choices("abcd ", k=150)) for _ in range(40)]
    rows = [(i, "".join(rng.choices(pool, k=3)) + "".join(rng.choices("xyz", k=i % 70))) for i in range(120)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    made, real = spark.sparkContext.accumulator(0), suffix_dedup.Level

    def spy(suffix, doc):
        made.add(1)
        return real(suffix, doc)

    monkeypatch.setattr(suffix_dedup, "Level", spy)
    monkeypatch.setattr(suffix_dedup, "CHUNK", 400)
    monkeypatch.setattr(suffix_dedup, "LEAST_SHARDS", 1)
    monkeypatch.setattr(suffix_dedup, "PART_BYTES", 20_000)
    monkeypatch.setattr(suffix_dedup, "ROUND_BYTES", round_bytes, raising=False)
    got = suffix_dedup.remove_repeats(frame).select("doc_id", "_repeats.*", F.sha2("_repeats.kept", 256).alias("sha")).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["sha"]) for r in got) == brute_repeats(rows)
    # A batch was a chunk's stretches of a part: thousands of suffix arrays for 120 chunks.
    assert 0 < made.value <= suffix_dedup.PARTS, made.value
