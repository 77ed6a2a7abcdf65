"""Packing, nearest neighbours, long matches, near duplicates and the pipeline against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from roadpulse.llm import near_dedup, packing, suffix_dedup, vp_search
from roadpulse.llm.common import tokenizer_path


@pytest.mark.parametrize("seed", range(40))
def test_schedule_deals_every_token_once_by_share(seed):
    rng = random.Random(seed)
    n, window = rng.randint(1, 7), rng.choice([8, 64, 2048])
    sizes = [rng.choice([0, 1, 3, rng.randint(1, 4000)]) for _ in range(n)]
    weights = [rng.choice([0, 1, 5, s]) for s in sizes] if seed % 2 else sizes
    plan = packing.Schedule(sizes, weights, window)
    owner = {}
    for j in range(n):
        at = 0
        while at < sizes[j]:
            size = min(sizes[j] - at, rng.randint(1, 300))
            place = at
            for first, length, sequence, offset in plan.pieces(j, at, size):
                assert first == place and length > 0 and offset + length <= window
                for x in range(length):
                    assert (sequence, offset + x) not in owner
                    owner[sequence, offset + x] = j
                place += length
            assert place == at + size
            at += size
    assert {s * window + o for s, o in owner} == set(range(sum(sizes)))
    if seed % 2 == 0:
        held = Counter((s, j) for (s, _), j in owner.items())
        off = 2 * (n - 1).bit_length() + 1e-9
        assert all(abs(held[s, j] - window * sizes[j] / sum(sizes)) <= off for s in range(sum(sizes) // window) for j in range(n))


def check_pieces(pieces, texts, window=packing.WINDOW):
    library = Tokenizer.from_file(tokenizer_path(packing.VOCABULARY))
    want = Counter()
    for text in texts:
        want[tuple([*library.encode(text or "", add_special_tokens=False).ids, packing.END_ID])] += 1
    by_sequence = defaultdict(list)
    for p in pieces:
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
    for sequence, parts in by_sequence.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == window or sequence == max(by_sequence)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    return want


def test_packing_holds_every_id_once(edge_docs, edge_rows, no_docs):
    pieces = packing.pack(edge_docs, window=256).collect()
    want = check_pieces(pieces, [r[1] for r in edge_rows], 256)
    by_doc = defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"], p["doc_tokens"]].append(p)
    lengths = Counter(sum(k for k, v in Counter(map(len, want.elements())).items() if k == n) for n in ())
    assert sum(p["length"] for p in pieces) == sum(len(ids) * n for ids, n in want.items()) and not lengths
    for ids in want:  # documents that stand alone under their id and size
        for (doc, n), own in by_doc.items():
            if n == len(ids) and sum(p["length"] for p in own) == n and own[0]["ids_crc32"] == zlib.crc32(np.array(ids[: own[0]["length"]], "<u4").tobytes()):
                assert all(p["ids_crc32"] == zlib.crc32(np.array(ids[p["start"] : p["start"] + p["length"]], "<u4").tobytes()) for p in own)
    assert packing.pack(no_docs).count() == 0


def test_packing_meets_given_targets(spark):
    rows = [(i, "the thing " * 40, "ab"[i % 4 == 0]) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    pieces = packing.pack(docs, targets={"b": 0.5, "a": 0.5}, window=128).collect()
    held = defaultdict(Counter)
    for p in pieces:
        held[p["sequence_id"]][p["source"]] += p["length"]
    small = sum(p["length"] for p in pieces if p["source"] == "b")
    mixed = [c for s, c in held.items() if (s + 1) * 128 <= 2 * small - 4]
    assert mixed and all(abs(c["b"] - 64) <= 2 for c in mixed)


def test_packing_deals_many_small_sources_by_share(spark):
    n = 5000
    docs = spark.range(2 * n).selectExpr("id as doc_id", f"concat('s', id % {n}) as source", "repeat('the thing ', 100) as text").repartition(3)
    pieces = packing.pack(docs).collect()
    check_pieces(pieces, [])
    assert sum(p["length"] for p in pieces) == sum({p["doc_id"]: p["doc_tokens"] for p in pieces}.values())
    by_doc = defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append((p["start"], p["length"], p["sequence_id"]))
    for own in by_doc.values():
        own.sort()
        assert [s for s, _, _ in own] == [0, *np.cumsum([k for _, k, _ in own])[:-1]] and sorted(q for *_, q in own) == [q for *_, q in own]
    windows = max(p["sequence_id"] for p in pieces) + 1
    held = np.zeros((windows, n))
    for p in pieces:
        held[p["sequence_id"], int(p["source"][1:])] += p["length"]
    assert (held[:-1] > 0).sum(1).min() >= packing.WINDOW // packing.BLOCK
    due = np.cumsum(held.sum(1))[:, None] * (held.sum(0) / held.sum())
    assert np.abs(np.cumsum(held, axis=0) - due).max() < 2 * packing.BLOCK


def brute_nearest(rows, k):
    usable = {}
    for i, v in rows:
        if i is not None and v and None not in v and len(v) == 8 and all(np.isfinite(v)) and any(v):
            usable[i] = np.array(v, np.float64)
    ids = np.array(sorted(usable))
    x = np.stack([usable[i] for i in ids])
    out = {}
    for i in ids[ids % 20 == 0]:
        s = np.einsum("nd,d->n", x, usable[i])
        other = ids != i
        order = np.lexsort((ids[other], -np.round(s[other], 12)))[:k]
        out[int(i)] = [int(j) for j in ids[other][order]]
    return out


@pytest.mark.parametrize("factor,least", [(1.0, 1.0), (vp_search.FACTOR, 0.9)])
def test_nearest(spark, factor, least):
    rng = np.random.default_rng(0)
    centres = rng.normal(0, 1, (6, 8))
    rows = [(i, [float(np.float32(c)) for c in centres[i % 6] * (1 + i % 3) + rng.normal(0, 0.3, 8)]) for i in range(6000)]
    rows[500:900] = [(i, rows[7][1]) for i in range(500, 900)]  # a common vector, queries among them
    rows += [(7000, None), (7001, []), (7020, [0.0] * 8), (7021, [float("nan")] * 8), (7022, [None] * 8), (7023, [1.0] * 5), (None, [1.0] * 8), rows[40]]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit("x"))
    got = defaultdict(dict)
    for r in vp_search.nearest(frame, F.col("id") % 20 == 0, factor=factor).collect():
        got[r["query_id"]][r["rank"]] = r["vec_id"]
    want = brute_nearest(rows, 20)
    assert set(got) == set(want) and all(sorted(v) == list(range(1, 21)) for v in got.values())
    found = [[v[r] for r in sorted(v)] for q, v in sorted(got.items())]
    share = np.mean([len(set(f) & set(want[q])) / 20 for f, q in zip(found, sorted(want))])
    assert share >= least
    if factor == 1:
        assert found == [want[q] for q in sorted(want)]


def test_nearest_over_many_shards_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(vp_search, "SHARD_ROWS", 125)
    monkeypatch.setattr(vp_search, "LEAF_ROWS", 16)
    monkeypatch.setattr(vp_search, "QUERY_BLOCK", 4)
    monkeypatch.setattr(vp_search, "SHARD_ROOTS", 1)  # so that a small table has 16 shards
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(c)) for c in rng.normal(0, 1, 8) * (1 + i % 3)]) for i in range(2000)]
    got = defaultdict(dict)
    for r in vp_search.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("id") % 20 == 0, factor=1.0).collect():
        got[r["query_id"]][r["rank"]] = r["vec_id"]
    want = brute_nearest(rows, 20)
    assert {q: [v[r] for r in sorted(v)] for q, v in got.items()} == want


def test_nearest_with_few_and_none(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, -0.5])], "vec_id long, embedding array<float>")
    got = vp_search.nearest(few, F.col("id") % 20 == 0).collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 1, 0.5), (2, 2, 0.5)]
    assert vp_search.nearest(few.limit(0), F.col("id") % 20 == 0).count() == 0


def brute_repeats(rows):
    order = [(2**63 - 1 if i is None else i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, b in order:
        for j in range(len(b) - 49):
            w = b[j : j + 50]
            first[w] = min(i, first.get(w, i))
    out = []
    for (i, b), (doc, _) in zip(order, rows):
        gone = bytearray(len(b))
        for j in range(len(b) - 49):
            if first[b[j : j + 50]] < i:
                gone[j : j + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((doc, len(b), sum(gone), (b"\0" + bytes(gone)).count(b"\0\1"), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def test_long_matches_are_brute_force(spark, edge_docs, edge_rows, no_docs):
    got = suffix_dedup.remove_repeats(edge_docs, keep=["_row", "doc_id", "score"])
    assert got.columns == ["_row", "doc_id", "score", "_repeats"]
    rows = got.select("doc_id", "_repeats.*", F.sha2("_repeats.kept", 256).alias("sha")).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["sha"]) for r in rows) == brute_repeats([r[:2] for r in edge_rows])
    assert suffix_dedup.remove_repeats(no_docs).count() == 0


def test_long_matches_at_random_borders(spark):
    rng = random.Random(2)
    pool = ["".join(rng.choices("ab \0é", k=200)) for _ in range(4)]
    rows = []
    for i in range(80):
        parts = ["".join(rng.choices("abcdefgh ", k=rng.randint(0, 60)))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(pool)
            a = rng.randint(0, 150)
            parts += [p[a : a + rng.randint(30, 120)], "".join(rng.choices("xyz", k=rng.randint(0, 9)))]
        rows.append((i if i % 9 else None, "".join(parts)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = suffix_dedup.remove_repeats(frame).select("doc_id", "_repeats.*", F.sha2("_repeats.kept", 256).alias("sha")).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["sha"]) for r in got) == brute_repeats(rows)


def test_stretches_do_not_depend_on_segments(monkeypatch):
    rng = np.random.default_rng(4)
    text = rng.integers(97, 101, 5000).astype(np.uint8)
    text[1000:1400] = 97
    sizes = np.array([700, 0, 20, 2000, 49, 50, 2181])
    windows = lambda found: {(int(s) + o, int(k)) for s, c, k in zip(*found) for o in range(c)}
    whole = windows(suffix_dedup.stretches(text, sizes))
    ends = np.cumsum(sizes)
    assert {w for w, _ in whole} == {w for e, n in zip(ends, sizes) for w in range(e - n, e - 49)}
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 333)
    assert windows(suffix_dedup.stretches(text, sizes)) == whole


def test_family_keeps_few_levels():
    family, sizes = suffix_dedup.Family(), []
    for i in range(64):
        names = np.array([f"{i * 10 + j:05d}x" for j in range(10)], "S6")
        family.add(suffix_dedup.Level(names, np.full(10, i)))
        sizes.append(len(family.levels))
    assert max(sizes) <= 7 and len(family.distinct()) == 640
    assert family.scan(np.array(["00125x", "99999x"], "S6")).tolist() == [12, suffix_dedup.NO_ID]


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def brute_components(rows, percent=85):
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(i, shingle_set(t)) for i, t in rows if i is not None]
    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return Counter((i, len(shingle_set(t)), None if i is None else root(i)) for i, t in rows)


def near_rows():
    """Groups around a text with more and fewer edits: similarities on both sides of the border."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefghij", k=4))
    rows = []
    for g in range(3):
        base = [word() for _ in range(150)]
        for _ in range(60):
            edited = [word() if rng.random() < rng.choice([0, 0.005, 0.01, 0.02, 0.05]) else w for w in base]
            rows.append((rng.randint(0, 10**6), " ".join(edited)))
    return rows


@pytest.mark.parametrize("frame", ["edge", "near"])
def test_near_duplicates_are_brute_force(spark, edge_docs, edge_rows, frame):
    rows = [r[:2] for r in edge_rows] if frame == "edge" else near_rows()
    docs = edge_docs if frame == "edge" else spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = near_dedup.near_duplicates(docs).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute_components(rows)
    assert all(r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"]) for r in got)


def pairs_by_similarity(counts):
    """Pairs of documents of 100 shingles that differ in their last words: c of the shingles are common, so the similarity is c / (200 - c)."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    rows = []
    for c in counts:
        head = [word() for _ in range(c + 4)]
        rows += [(len(rows) + k, " ".join(head + [word() for _ in range(100 - c)])) for k in (0, 1)]
    return rows


def test_near_stage_takes_a_threshold(spark):
    common = [88, 89, 90, 91, 92] * 8  # similarities 0.786, 0.802, 0.818, 0.835 and 0.852
    docs = spark.createDataFrame(pairs_by_similarity(common), "doc_id long, text string").repartition(4)
    kept = {r["doc_id"] for r in corpus_pipeline.near_stage(spark, docs, "").collect()}
    assert kept == {2 * i for i in range(len(common))} | {2 * i + 1 for i, c in enumerate(common) if c == 88}
    own = {r["doc_id"] for r in near_dedup.near_duplicates(docs).filter("kept").collect()}  # op6's threshold is its own
    assert own == {2 * i for i in range(len(common))} | {2 * i + 1 for i, c in enumerate(common) if c < 92}


def test_filters_follow_the_threshold():
    assert (near_dedup.band_width(85), near_dedup.least_lanes(85)) == (4, 56)
    assert (near_dedup.band_width(80), near_dedup.least_lanes(80)) == (3, 49)


def test_near_duplicates_of_nothing(no_docs):
    assert near_dedup.near_duplicates(no_docs).count() == 0


@pytest.mark.parametrize("size", [1, 2, 5, 40, 3000])
def test_sketch_fills_and_estimates(size):
    rng = np.random.default_rng(size)
    items = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
    least = near_dedup.sketch(items)
    assert (least != np.iinfo(np.uint64).max).all()
    assert (near_dedup.sketch(rng.permutation(items)) == least).all()
    if size >= 40:
        other = np.concatenate([items[: int(len(items) * 0.9)], rng.integers(0, 2**63, len(items) // 10).astype(np.uint64)])
        assert abs((near_dedup.sketch(other) == least).mean() - 0.82) < 0.2


def test_blocks_find_all_components():
    rows = near_rows()[:60]
    items = [np.unique(near_dedup.shingles(t)) for _, t in rows]
    ids = np.arange(len(rows))
    whole = near_dedup.block_links(ids, ids, items, np.zeros(len(rows), int))
    part = ids % 2
    halves = [x for p in (0, 1) for x in near_dedup.block_links(ids[part == p], ids[part == p], [items[i] for i in ids[part == p]], part[part == p])]
    across = near_dedup.block_links(ids, ids, items, part)

    def grouped(links):
        of = list(ids)
        for _ in ids:
            for a, b in links:
                of[a] = of[b] = min(of[a], of[b])
        return of

    assert grouped(whole) == grouped(halves + across)


def test_pipeline_stages_keep_what_they_should(spark, edge_docs, edge_rows, no_docs, tmp_path):
    docs, before = edge_docs, None
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        out = stage(spark, docs, "")
        out.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        if i < 4:
            assert docs.columns == edge_docs.columns
    kept = [spark.read.parquet(f"{tmp_path}/{i}").collect() for i in range(4)]
    # Language: only texts without letters go, in this sample.
    letters = [r for r in edge_rows if any(c.isalpha() for c in r[1] or "")]
    assert Counter((r["doc_id"], r["text"]) for r in kept[0]) == Counter(r[:2] for r in letters)
    # Exact: one row of each text.
    norm = lambda t: " ".join(t.split(" ")) if "  " not in t else " ".join(t.split())
    assert len(kept[1]) == len({norm(r["text"]) for r in kept[0]})
    # Near: one of each component, linked from the stage's similarity of 0.8 on.
    want = brute_components([(r["doc_id"], r["text"]) for r in kept[1]], 80)
    assert Counter(r["doc_id"] for r in kept[2]) == Counter(d for d, _, c in want.elements() if d == c)
    # Long matches: texts shrink by what brute force removes.
    gone = {d: n - m for d, n, m, _, _ in brute_repeats([(r["doc_id"], r["text"]) for r in kept[2]])}
    for r in kept[3]:
        assert gone[r["doc_id"]] - len((r["text"] or "").encode()) in range(0, 7) and r["n_chars"] == len(r["text"])
    check_pieces(docs.collect(), [r["text"] for r in kept[3]])
    assert before is not None
    empty = no_docs
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, "")
    assert empty.count() == 0


def test_a_shard_is_settled_part_by_part(spark, monkeypatch):
    """Parts, and pieces of a sort, change no row; no more than a part's stretches are together in a family."""
    rng = random.Random(5)
    pool = ["".join(rng.choices("abcd ", k=150)) for _ in range(40)]
    rows = [(i, "".join(rng.choices(pool, k=3)) + "".join(rng.choices("xyz", k=i % 70))) for i in range(120)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    held = spark.sparkContext.accumulator(0)
    real = suffix_dedup.settled

    def spy(family):
        out = real(family)
        held.add(1)
        assert len(out[0]) < 400
        return out

    monkeypatch.setattr(suffix_dedup, "settled", spy)
    monkeypatch.setattr(suffix_dedup, "PART_BYTES", 10_000)
    monkeypatch.setattr(suffix_dedup, "OPEN_WINDOWS", 100)
    monkeypatch.setattr(suffix_dedup, "LEAST_SHARDS", 1)
    got = suffix_dedup.remove_repeats(frame).select("doc_id", "_repeats.*", F.sha2("_repeats.kept", 256).alias("sha")).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["sha"]) for r in got) == brute_repeats(rows)


def test_copies_of_stretches_take_little_memory():
    """100,000 stretches are copied, hashed and their windows sorted with little beside what is returned."""
    import tracemalloc

    text = np.random.default_rng(3).integers(97, 123, 200_000).astype(np.uint8)
    start, count = np.arange(100_000), np.full(100_000, 5)
    tracemalloc.start()
    rows = suffix_dedup.suffixes(text, start, count + suffix_dedup.LENGTH - 1, suffix_dedup.WIDTH)
    peak = tracemalloc.get_traced_memory()[1] - rows.nbytes
    tracemalloc.reset_peak()
    held = tracemalloc.get_traced_memory()[0]
    keys = suffix_dedup.keys_of(rows)
    hashed = tracemalloc.get_traced_memory()[1] - held
    tracemalloc.reset_peak()
    suffix_dedup.open_answers(rows, keys, start)
    opened = tracemalloc.get_traced_memory()[1] - held
    tracemalloc.stop()
    assert peak < 25e6 and hashed < 25e6 and opened < 60e6, (peak, hashed, opened)
