"""License scan, toxicity, language ID, BPE, exact dedup and LM scoring on small frames."""

import hashlib
import math
import random
import time
import unicodedata
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from roadpulse.llm import bpe, exact_dedup, language_id, lattice_lm, license_scan, license_texts, toxicity
from roadpulse.llm.common import tokenizer_path

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def test_license_scan_sees_through_layout_and_spelling(spark):
    mit = dict((n, t) for n, t in license_texts.KNOWN[:1])["MIT"]
    rewritten = "Copyright (c) 2020 Some Body\n" + " ".join(mit.upper().split()).replace("SUBLICENSE", "SUB-LICENSE").replace("NONINFRINGEMENT", "NON-INFRINGEMENT")
    rows = [(1, mit), (2, rewritten), (3, mit + " but"), (4, "A text.\nReleased under the MIT licence!\n"), (4, None), (None, ""), (6, "© 2020 me")]
    found = license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id int, text string")).collect()
    by = {(r["doc_id"], r["license"], r["n_notices"], r["notices"]) for r in found}
    assert by == {(1, "MIT", 0, ""), (2, "MIT", 1, "MIT"), (3, None, 0, ""), (4, None, 1, "MIT"), (4, None, 0, ""), (None, None, 0, ""), (6, None, 0, "")}
    empty = hashlib.sha256(b"").hexdigest()
    assert [r["digest"] == empty for r in found].count(True) == 3


def test_license_scan_takes_copyright_lines_of_many_forms(spark):
    mit = dict(license_texts.KNOWN[:1])["MIT"]
    heads = ["Copyright Jane Doe 2020", "Copyright: 1999-2021, The Doe Company", "  * copyright by jane doe", "COPYRIGHT (C) Jane Doe", "Copyright notice"]
    rows = [(i, f"{h}\n\n{mit}") for i, h in enumerate(heads)]
    found = license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id int, text string")).collect()
    assert {r["doc_id"]: r["license"] for r in found} == {0: "MIT", 1: "MIT", 2: "MIT", 3: "MIT", 4: None}


def test_license_scan_knows_long_texts_by_digest(spark):
    folder = Path("/usr/share/common-licenses")
    files = {"Apache-2.0": "Apache-2.0", "GPL-2.0": "GPL-2", "GPL-3.0": "GPL-3", "LGPL-2.1": "LGPL-2.1", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}
    if not all((folder / f).exists() for f in files.values()):
        pytest.skip("no licence texts here")
    rows = []
    for name, f in files.items():
        text = (folder / f).read_text()
        rows += [(name, text), (name, re.sub("[ \t]+", "\t ", text.upper())), (None, text.replace("program", "car", 1).replace("Work", "Car", 1).replace("Source", "Car", 1))]
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id int, text string")
    got = {r["doc_id"]: r["license"] for r in license_scan.scan_licenses(docs).collect()}
    assert [got[i] for i in range(0, len(rows), 3)] == list(files)
    assert [got[i] for i in range(1, len(rows), 3)] == list(files)
    assert [got[i] for i in range(2, len(rows), 3)] == [None] * len(files)
    own = license_scan.scan_licenses(docs, digests=[("mine", r["digest"]) for r in license_scan.scan_licenses(docs).filter("doc_id = 2").collect()])
    assert [r["doc_id"] for r in own.filter("license = 'mine'").collect()] == [2]


def test_license_scan_edges(edge_docs, edge_rows, no_docs):
    found = license_scan.scan_licenses(edge_docs).collect()
    assert len(found) == len(edge_rows) and license_scan.scan_licenses(no_docs).count() == 0
    assert [r["doc_id"] for r in found if r["n_notices"]] == []  # the notice shares its line with other words


def brute_exact(rows):
    groups = defaultdict(list)
    for i, (doc, text) in enumerate(rows):
        groups[SPACE.sub(" ", text or "")].append((doc is None, doc, i))
    out = []
    for norm, members in groups.items():
        first = min(members, key=lambda m: (m[0], m[1] or 0))
        out += [(d, first[1], len(members), hashlib.sha256(norm.encode()).hexdigest()) for _, d, _ in members]
    return out


@pytest.mark.parametrize("block", [7, exact_dedup.BLOCK])
def test_exact_dedup_is_brute_force(edge_docs, edge_rows, no_docs, block):
    small = [(r[0], r[1]) for r in edge_rows if block > 100 or len(r[1] or "") < 700]
    docs = edge_docs if block > 100 else edge_docs.filter("text is null or length(text) < 700")
    found = exact_dedup.exact_duplicates(docs, block=block).collect()
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in found) == Counter(brute_exact(small))
    kept = [r["text_sha256"] for r in found if r["kept"]]
    assert len(kept) == len(set(kept)) == len({r["text_sha256"] for r in found})
    assert all(r["doc_id"] == r["keep_id"] for r in found if r["kept"])


def test_exact_dedup_of_nothing(no_docs):
    assert exact_dedup.exact_duplicates(no_docs).count() == 0


def test_toxicity_generalises_to_misspellings(spark, edge_docs, edge_rows, no_docs):
    rng = random.Random(1)
    clean = ["tha ing", "erthe", "onre", "tion", "hean", "ster", "andre", "oulyr"]
    bad = ["idiot", "moron", "stupid", "clown"]
    rows = []
    for i in range(400):
        words = rng.choices(clean, k=rng.randint(5, 60))
        if i % 3 == 0:
            words = [w if rng.random() > 0.15 else rng.choice(bad) for w in words] + ["idiot"]
        rows.append((i, " ".join(words), int(i % 3 == 0)))
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(frame.filter("doc_id >= 100"), frame.select("doc_id", "toxic"))
    got = toxicity.score(frame.filter("doc_id < 100"), model).collect()
    assert np.mean([(r["_toxicity"] >= 0.5) == (r["toxic"] == 1) for r in got]) > 0.95
    unseen = spark.createDataFrame([("idiott idioot stuppid erthe",), ("erthe onre tion hean",), ("",), (None,)], "text string")
    scores = [r["_toxicity"] for r in toxicity.score(unseen, model).collect()]
    assert scores[0] > 0.5 > scores[1] and scores[2] == scores[3] < 0.5
    out = toxicity.score(edge_docs, model, out="extra")
    assert out.columns == [*edge_docs.columns, "extra"] and out.filter("extra between 0 and 1").count() == len(edge_rows)
    assert toxicity.score(no_docs, model).count() == 0
    flat = toxicity.fit(frame, frame.select("doc_id", F.lit(None).cast("int").alias("toxic")))
    assert toxicity.score(frame.limit(2), flat).first()["_toxicity"] < 1e-6


def test_toxicity_learns_from_whole_texts(spark):
    rng = random.Random(8)
    clean = ["".join(rng.choices(["tha", "ing", "er", "on", "re", "ti", "he", "an"], k=rng.randint(1, 4))) for _ in range(300)]
    rows = []
    for i in range(240):
        words = rng.choices(clean, k=1500)
        if i % 3 == 0:  # insults here and there, but not in 400 words that begin at a place given by the id
            start = zlib.crc32(str(i).encode()) % (len(words) - 400 + 1)
            for at in rng.sample([k for k in range(len(words)) if not start <= k < start + 400], 60):
                words[at] = rng.choice(["idiot", "moron", "stupid", "clown"])
        rows.append((i, " ".join(words), int(i % 3 == 0)))
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(frame.filter("doc_id >= 60"), frame.select("doc_id", "toxic"))
    got = toxicity.score(frame.filter("doc_id < 60"), model).collect()
    assert np.mean([(r["_toxicity"] >= 0.5) == (r["toxic"] == 1) for r in got]) > 0.95


def test_toxicity_reads_long_words_whole(spark):
    plain = ["idiot's", "x" * 64, "(" + "y" * 64 + ").", "-" * 100]
    assert toxicity.words_of(" ".join(plain)) == [*plain[:2], "y" * 64, ""]
    rng = random.Random(2)
    for n in (65, 95, 96, 97, 128, 1000):
        word = "".join(rng.choices("abcdefghij", k=n))
        parts = toxicity.words_of(f"a {word} b")
        assert (parts[0], parts[-1]) == ("a", "b") and max(map(len, parts)) <= 64
        assert all(any(word[i : i + 32] in p for p in parts) for i in range(n - 31))
    clean = ["tha ing", "erthe", "onre", "tion", "hean", "ster", "andre", "oulyr"]
    rows = [(i, " ".join(rng.choices(clean, k=rng.randint(5, 60)) + ["idiot"] * (i % 3 == 0)), int(i % 3 == 0)) for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(frame, frame.select("doc_id", "toxic"))
    head, tail = "tion.hean.ster.andre.oulyr." * 4, "onre.tion" * 10
    texts = [head + tail, head + "idiot.idiot.idiot.idiot.idiot.idiot." + tail]
    got = [r["_toxicity"] for r in toxicity.score(spark.createDataFrame([(t,) for t in texts], "text string"), model).collect()]
    assert got[1] > got[0]


def test_language_id(spark, edge_docs, edge_rows, no_docs):
    model = language_id.fit(edge_docs)
    found = language_id.identify(edge_docs, model, out="found")
    got = found.select("text", "lang", "_lid", "found.*").collect()
    assert len(got) == len(edge_rows) and all(r["_lid"] == 1 for r in got)
    for r in got:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] in model.langs) if letters else (r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True)
        assert 0 <= r["score"] <= 1
    long_enough = [r for r in got if r["lang"] and len(set(r["text"] or "")) > 8 and len(r["text"]) > 60]
    assert np.mean([r["lang_pred"] == r["lang"] for r in long_enough]) > 0.95
    strange = spark.createDataFrame([("ქართული ენა ლამაზია და ძველი " * 20,)], "text string")
    assert language_id.identify(strange, model).first()["_lid"]["rejected"]
    assert language_id.identify(no_docs, model, out="o").count() == 0
    nothing = language_id.fit(no_docs)
    assert {r["found"]["lang_pred"] for r in language_id.identify(edge_docs, nothing, out="found").collect()} == {"und"}


def test_every_language_is_learnt(spark):
    """More languages than the sample has rows for several of, one of them with most documents."""
    word = lambda n: "".join(chr(0x4E00 + (n * 131 + k * 17) % 20000) for k in range(12))
    rows = [(n, " ".join([word(n)] * 3), f"l{n}") for n in range(1500)] + [(5000 + k, "the same words again", "en") for k in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(docs)
    assert set(model.langs) == {r[2] for r in rows}
    got = language_id.identify(docs, model).selectExpr("lang = _lid.lang_pred AS same").groupBy("same").count().collect()
    assert {r["same"]: r["count"] for r in got}[True] > 0.99 * len(rows)


@pytest.fixture(scope="module")
def word_tokenizer():
    return Tokenizer.from_file(tokenizer_path(bpe.VOCABULARY))


def test_bpe_equals_the_tokenizers_library(word_tokenizer):
    coder = bpe.loaded(tokenizer_path(bpe.VOCABULARY))
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyzABCΣσςİéèßñ0123456789'’\"!?.,;  \n\t\x1c\x85\xa0漢字ひ🙂ﬁ½²​<|>_-Ǆ"
    texts = ["", "  ", "<|endoftext|>", "a<|startoftext|>B", "x" * 3000]
    texts += ["".join(rng.choices(letters, k=rng.randint(1, 50))) for _ in range(1500)]
    texts += ["".join(rng.choices("ainthesrod", k=rng.randint(1, 60))) for _ in range(500)]
    for text in texts:
        ids = word_tokenizer.encode(text, add_special_tokens=False).ids
        assert coder.encode(text) == ids
        assert coder.decode(ids) == word_tokenizer.decode(ids, skip_special_tokens=False)


def test_bpe_equals_the_library_on_code_points(word_tokenizer):
    """Each code point that Unicode tables of different age may read differently, and every 41st of the rest, alone before a letter, a digit, an end."""
    coder = bpe.loaded(tokenizer_path(bpe.VOCABULARY))
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    young = [c for c in regex.findall(r"[\p{L}\p{N}]", every) if unicodedata.category(c) == "Cn"]
    texts = [f"{c}a {c}1 {c}" for c in [*young[::11], "\u0558", "\u088f", "\u1c89", "\ua7cb", "\U00010940", *every[::41]]]
    for text, encoded in zip(texts, word_tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert coder.encode(text) == encoded.ids, ascii(text)


def test_bpe_frames(edge_docs, edge_rows, no_docs, word_tokenizer):
    want = Counter()
    for r in edge_rows:
        ids = word_tokenizer.encode(r[1] or "", add_special_tokens=False).ids
        raw = np.array(ids, "<u4").tobytes()
        want[len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(word_tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    got = bpe.digests(edge_docs)
    assert got.columns == [*edge_docs.columns, "_bpe"]
    assert Counter(tuple(r["_bpe"]) for r in got.collect()) == want
    there = bpe.decode(bpe.encode(edge_docs)).filter("doc_id = 20").first()
    assert there["_decoded"] == word_tokenizer.decode(there["_ids"], skip_special_tokens=False)
    assert bpe.digests(no_docs).count() == 0


def test_lattice_sums_over_all_segmentations():
    lattice = lattice_lm.lattice(lattice_lm.VOCABULARY)
    weight = lattice.start
    known = dict(zip(lattice.pieces, weight))

    def brute(word):
        text, total = b" " + word, [0.0]
        for end in range(1, len(text) + 1):
            total.append(sum(math.exp(known[text[s:end]]) * total[s] if s else math.exp(known[text[:end]]) for s in range(end) if text[s:end] in known))
        return math.log(total[-1])

    words = [b"the", b"thing", "é".encode(), b"a", b"zzxq", "漢".encode()]
    assert np.allclose(lattice.log_probability(words, weight[None, :])[:, 0], [brute(w) for w in words])
    uses = lattice.expected([b"the"], weight)
    assert abs(sum(len(p) * n for p, n in zip(lattice.pieces, uses)) - 4) < 1e-9  # the pieces cover the word and its space


def test_lattice_walks_alone_as_together(monkeypatch):
    lattice, rng = lattice_lm.lattice(lattice_lm.VOCABULARY), random.Random(3)
    words = [bytes(rng.choices(b"thenigsaor\xe6\xbc", k=rng.randrange(1, 30))) for _ in range(2000)]
    weight = np.stack([lattice.start, lattice.weights(lattice.expected(words[:500], lattice.start))])
    found = []
    for least in (1, 10**9):
        monkeypatch.setattr(lattice_lm, "TOGETHER", least)
        assert bool(lattice.split(words)[0]) == (least == 1)
        found.append((lattice.log_probability(words, weight), lattice.expected(words, weight[1])))
    assert np.allclose(found[0][0], found[1][0]) and np.allclose(found[0][1], found[1][1])


def test_lattice_of_long_texts_without_spaces():
    lattice, rng = lattice_lm.lattice(lattice_lm.VOCABULARY), random.Random(5)
    text = "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(70_000)).encode()
    began = time.process_time()
    (whole,) = lattice.log_probability([text], lattice.start[None, :])[:, 0]
    uses = lattice.expected([text], lattice.start)
    assert time.process_time() - began < 20  # 210 KB; array operations for every place took minutes
    assert math.isfinite(whole) and abs(uses @ lattice.sizes / (len(text) + 1) - 1) < 1e-5  # log sums of millions are rounded


def test_lattice_score_is_the_marginal_under_the_vocabulary(spark):
    rows = [(0, "the thing"), (1, ""), (2, "漢字と仮名 zzxq the the"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = lattice_lm.train(docs)
    shapes, end = lattice_lm.lattice(lattice_lm.VOCABULARY), model.end_share()
    plain = {w: shapes.log_probability([w], shapes.start[None, :])[0, 0] / math.log(10) for _, t in rows for w in lattice_lm.words_of(t)}
    want = {i: sum(plain[w] + math.log10(1 - end) for w in lattice_lm.words_of(t)) + math.log10(end) for i, t in rows}
    got = {r["doc_id"]: r["lattice_score"] for r in lattice_lm.score(docs, model, F.lit(True)).collect()}
    assert np.allclose([got[i] for i in want], list(want.values()))


def test_lm_scores(edge_docs, edge_rows, no_docs):
    learnt = F.coalesce(F.col("doc_id") % 3 != 1, F.lit(False))
    model = lattice_lm.train(edge_docs.filter(learnt))
    got = lattice_lm.score(edge_docs, model, learnt).collect()
    words = lambda t: lattice_lm.words_of(t) + [None]
    counts = Counter(w for r in edge_rows if r[0] is not None and r[0] % 3 != 1 for w in words(r[1]))
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for r in edge_rows:
        w = words(r[1])
        base = sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w)
        want[r[0], len(w), sum(counts[x] > 0 for x in w), round(base, 6)] += 1
    assert (model.n, model.v) == (n, v)
    assert Counter((r["doc_id"], r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in got) == want
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)
    # With the end, the probabilities of all tokens sum to one: those of seen words alone are below.
    seen = [w for w in counts if w is not None]
    by_kind = np.zeros((len(seen), 4))
    assert (10 ** model.log10_words(seen, by_kind)).sum() < 4
    untrained = lattice_lm.train(no_docs)
    assert lattice_lm.score(no_docs, untrained, F.lit(True)).count() == 0
    assert lattice_lm.score(edge_docs, untrained, F.lit(False)).filter("score < 0").count() == len(edge_rows)


def test_lm_scores_of_long_unknown_words(spark, edge_docs):
    model = lattice_lm.train(edge_docs)
    shapes = lattice_lm.lattice(lattice_lm.VOCABULARY)
    rng = random.Random(4)
    words = ["".join(rng.choices("qxzj0189", k=n)) for n in (30, 500, 50_000)]

    def brute(word):
        """Sums over the segmentations, scaled again at each place."""
        known, longest = dict(zip(shapes.pieces, np.exp(model.weight))), max(shapes.lengths)
        text, last, log = b" " + word.encode(), [1.0], 0.0  # of the places before, from far to near
        for end in range(1, len(text) + 1):
            x = sum(known.get(text[end - size : end], 0.0) * last[-size] for size in range(1, min(longest, end) + 1))
            log += math.log(x)
            last = [y / x for y in last[-longest:]] + [1.0]
        return log

    spare = lattice_lm.DISCOUNT * model.types / (model.n - model.docs)
    want = np.array([brute(w) for w in words]) / math.log(10) + np.log10(spare * (1 - model.end_share()))
    got = model.log10_words([w.encode() for w in words], np.zeros(len(words)))
    assert np.allclose(got, want, rtol=1e-9)
    assert got[1] < 10 * got[0] and got[2] < 50 * got[1]
    docs = spark.createDataFrame(list(enumerate(words)), "doc_id long, text string")
    scores = {r["doc_id"]: r["score"] for r in lattice_lm.score(docs, model, F.lit(False)).collect()}
    assert np.allclose([scores[i] for i in range(3)], want + np.log10(model.end_share()), rtol=1e-9)


def test_lm_learns_from_all_documents(spark):
    rng = random.Random(6)
    shared = [f"common{i}" for i in range(40)]
    rows = [(i, " ".join(rng.choices(shared, k=30))) for i in range(3000)]
    rare = [f"wörd{i}ß" for i in range(50)]  # of one document in 1,000, which shares no word with the others
    rows += [(10_000 + i, " ".join(rng.choices(rare, k=30))) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    model = lattice_lm.train(docs)
    counts = Counter(w for _, t in rows for w in lattice_lm.words_of(t))
    # The weights are those of the steps over all distinct words, on one machine.
    shapes = lattice_lm.lattice(lattice_lm.VOCABULARY)
    weight = shapes.start
    for _ in range(lattice_lm.STEPS):
        weight = shapes.weights(shapes.expected(sorted(counts), weight))
    assert np.allclose(model.weight, weight)
    # Every score is the product of what all counts say, whatever the sort of document.
    n = sum(counts.values())
    assert (model.docs, model.types, model.n) == (len(rows), len(counts), n + len(rows))
    lattice_p = dict(zip(counts, np.exp(shapes.log_probability(list(counts), weight[None, :])[:, 0])))
    p = {w: (c - lattice_lm.DISCOUNT * (1 - len(counts) * lattice_p[w])) / n for w, c in counts.items()}
    end = model.end_share()
    want = {i: sum(math.log10(p[w] * (1 - end)) for w in lattice_lm.words_of(t)) + math.log10(end) for i, t in rows}
    got = {r["doc_id"]: r["score"] for r in lattice_lm.score(docs, model, F.lit(True)).collect()}
    assert np.allclose([got[i] for i in want], list(want.values()))


def test_folds_are_crc32(edge_docs):
    for r in edge_docs.filter("doc_id is not null").select("doc_id", language_id.held_out().alias("a"), toxicity.held_out().alias("b")).collect():
        c = zlib.crc32(str(r["doc_id"]).encode())
        assert (r["a"], r["b"]) == (c % 4 == 2, c % 5 == 0)
