"""Personal data, whitening and collocations against plain versions on one machine."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from roadpulse.llm import collocations, pii, whitening

TEXTS = [
    "mail bob@x.com_foo@bar.com, a@b.com.x@y.z end a@b @c.d x@y..z",
    "host 1.2.3.4.5.6.7.8 and 300.1.1.1 version 1.2.3.4 0001.002.3.4 1.1.1.1234567890123456789012.5",
    "card 4111 1111 1111 1111 x 4111-1111-1111-1111 5 4111111111111111 5 12 4111111111111112 4111  1111 1111 1111 1-2-3",
    "call +1 (555) 555-1234 or +44 20 7946 0958. +1-2 +1------ +12345678901234567 (555) 555-1234 tel 555-123-4567",
    "IBAN DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432 XGB82WEST12345698765432 DE89370400440532013001",
    "my ssn 123-45-6789 or 666-12-1234; 1123-45-6789" + " and" * 20 + " 219-09-9998",
    "é" * 50 + "😀 a@b.co 😀 " + "9" * 100,
    "x" * 200_000 + "@b.com " + "1" * 200_000 + " " + "a.b@c.dd " * 3000,
    "+1" + " " * 100_000 + "2",
]

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits)))
    return total % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in BASE.items():
    
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                "card": 13 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def test_pii_base_spans_match_a_plain_search(spark, edge_rows):
    rows = [r[:2] for r in edge_rows] + [(200 + i, t) for i, t in enumerate(TEXTS) if i != 7]
    found = pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    got = Counter((r.doc_id, tuple((s.kind, s.start, s.end) for s in r.spans if s.kind in BASE)) for r in found.collect())
    assert got == Counter((i, tuple(base_spans(t or ""))) for i, t in rows)


def test_pii_long_runs_and_many_spans_take_no_square(spark):
    text = TEXTS[7]
    spans = pii.find_pii(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().spans
    assert (spans[0].start, spans[0].end) == (0, 200_006) and len(spans) == 3001
    assert all(text[s.start : s.end] == s.text for s in spans)


def test_pii_validators_and_context(spark):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    spans = {r.doc_id: [(s.kind, s.text, s.score) for s in r.spans] for r in pii.find_pii(rows).collect()}
    assert spans[1] == [("ip", "1.2.3.4", 80), ("ip", "5.6.7.8", 60), ("ip", "1.2.3.4", 30), ("ip", "0001.002.3.4", 60)]
    assert [s[0] for s in spans[4]] == ["iban", "iban"] and spans[4][0][1:] == ("DE89 3704 0044 0532 0130 00", 100)
    assert spans[5] == [("ssn", "123-45-6789", 60)]
    assert [s for s in spans[3] if s[0] == "local_phone"] == [("local_phone", "555-123-4567", 60)]


def test_pii_query_digests_and_clashing_columns(spark, edge_docs, no_docs, tmp_path):
    folder = str(tmp_path)
    edge_docs.withColumn("spans", edge_docs._row).withColumn("_text", edge_docs._row).write.parquet(folder + "/documents.parquet")
    rows = pii.op11(spark, folder).collect()
    assert len(rows) == edge_docs.count()
    for r in rows:
        spans = [s for s in r.spans.split(",") if s and s.split(":")[0] in BASE]
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert r.n_email + r.n_ip + r.n_card + r.n_phone == len(spans)
    assert pii.find_pii(no_docs).count() == 0


@pytest.mark.parametrize(
    "matrix",
    [np.eye(20) * 3, np.diag([5.0, 5, 5, 1, 1, 0]), np.array([[2.0]]), np.zeros((5, 5)), "random", "close", "wilkinson"],
    ids=["equal", "repeated", "one", "zero", "random", "close", "wilkinson"],
)
def test_leading_eigen(matrix):
    rng = np.random.default_rng(3)
    if isinstance(matrix, str):
        q = np.linalg.qr(rng.standard_normal((40, 40)))[0]
        wilkinson = np.diag(np.abs(np.arange(21) - 10.0)) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1)
        close = q @ np.diag([10 + 1e-13 * i for i in range(8)] + [1.0] * 32) @ q.T
        matrix = {"random": q @ np.diag(rng.random(40)) @ q.T, "close": (close + close.T) / 2, "wilkinson": wilkinson}[matrix]
        matrix = (matrix + matrix.T) / 2
    values, vectors = whitening.leading_eigen(matrix, 16)
    assert np.allclose(values, np.linalg.eigvalsh(matrix)[::-1][:16], atol=1e-13)
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-13
    assert np.abs(matrix @ vectors - vectors * values).max() < 1e-13 * max(values[0], 1)


VECTORS = "vec_id long, embedding array<float>, x string, _x int, component int"


def vectors(n=300, dims=12):
    rng = np.random.default_rng(8)
    rows = [(i, [float(v) for v in np.float32(rng.standard_normal(dims) * (1 + np.arange(dims)))]) for i in range(n)]
    rows += [(n + i, rows[0][1]) for i in range(150)]  # a third of all rows
    rows += [(None, rows[1][1]), (5, rows[5][1]), (900, None), (901, []), (902, [1.0] * 3), (903, [float("nan")] * dims)]
    rows += [(904, [None] + [1.0] * (dims - 1)), (905, [float("inf")] + [1.0] * (dims - 1)), (906, [0.0] * dims), (907, [3e30] * dims)]
    return [(*r, "x", 1, 2) for r in rows]


def test_whitening_matches_a_plain_version(spark):
    rows = vectors()
    got = whitening.whiten(spark.createDataFrame(rows, VECTORS).repartition(4)).collect()
    use = [(i, np.floor(64 * np.array(v)).astype(np.int64) + 10**6) for i, v, *_ in rows if v and len(v) == 12 and None not in v and np.abs(v).max() < 1e30]
    fit = np.unique([x for _, x in use], axis=0)
    n, total = len(fit), fit.sum(0)
    v = np.cov((fit - 10**6).T, bias=True)
    e, w = np.linalg.eigh(v)
    e, w = e[::-1], w[:, ::-1]
    want = defaultdict(list)
    for i, x in use:
        want[i].append((((n * x - total) ** 2).sum(), np.abs((x - total / n) @ w / np.sqrt(e))))
    assert len(got) == 12 * len(use) and {r.n for r in got} == {n}
    for r in got:
        assert any(int(r.deviation) == d and abs(abs(r.whitened) - white[r.component - 1]) < 1e-8 for d, white in want[r.vec_id])
        assert abs(r.explained / (e[r.component - 1] / np.trace(v)) - 1) < 1e-10 and r.identity_error < 1e-10


def test_whitening_of_hardly_any_vectors(spark):
    none = spark.createDataFrame([], VECTORS)
    assert whitening.whiten(none).count() == 0
    assert whitening.whiten(spark.createDataFrame(vectors()[300:440], VECTORS)).count() == 0  # one distinct vector
    few = whitening.whiten(spark.createDataFrame(vectors()[:3], VECTORS)).collect()
    assert {r.component for r in few} == {1, 2} and max(r.identity_error for r in few) < 1e-6


def test_whitening_deviation_beyond_a_long(spark):
    rows = [(i, [float(2**50 * (-1) ** i + 2**30 * i), 1.0 * i]) for i in range(40)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), components=1).collect()
    x = [[int(c) * 64 for c in v] for _, v in rows]
    total = [sum(v[j] for v in x) for j in range(2)]
    want = {i: sum((40 * c - t) ** 2 for c, t in zip(v, total)) for i, v in enumerate(x)}
    assert {r.vec_id: int(r.deviation) for r in got} == want


def plain_collocations(rows, least, longest=5):
    count, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            for m in range(1, longest + 1):
                for i in range(len(words) - m + 1):
                    count[lang or "und"][tuple(words[i : i + m])] += 1
    out = set()
    for lang, f in count.items():
        for p, a in f.items():
            if len(p) < 2 or a < least:
                continue
            score, k = min((1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            longer = [q for q, b in f.items() if len(q) > len(p) and b >= least and b >= a and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if not longer:
                out.add((lang, " ".join(p), a, f[p[:k]], f[p[k:]], totals[lang], score))
    return out


@pytest.mark.parametrize("strength", [64, 6])
def test_collocations_match_a_plain_count(spark, edge_docs, edge_rows, strength):
    got = collocations.collocations(edge_docs.withColumn("words", edge_docs._row), least=4, strength=strength)
    assert {tuple(r) for r in got.collect()} == plain_collocations([(r[1], r[2]) for r in edge_rows], 4)


def test_collocations_overlaps_cuts_and_long_texts(spark):
    rows = [("a a a a a A\ta", "en")] * 3 + [("x y z. x y z! y\nz", None), ("New  York\tcity, new york", "de"), ("new york city", "de")]
    rows += [("p q, " * 300_000, "es")]
    df = spark.createDataFrame(rows, "text string, lang string")
    want = plain_collocations(rows, 2)
    assert {tuple(r) for r in collocations.collocations(df, least=2).collect()} == want
    assert ("es", "p q", 300_000, 300_000, 300_000, 600_000, 2000) in want


def test_collocations_products_beyond_64_bits(spark, monkeypatch):
    found = spark.createDataFrame(
        [("en", 0, "", 10**15), ("en", 1, "a", 10**12 + 7), ("en", 1, "b", 10**12 + 9), ("en", 2, "a b", 10**12 + 1)],
        "lang string, words int, phrase string, f long",
    )
    monkeypatch.setattr(collocations, "frequent_phrases", lambda *a: found)
    row = collocations.collocations(found).first()
    assert row.score == 1000 * (10**12 + 1) * 10**15 // ((10**12 + 7) * (10**12 + 9))


def test_collocations_of_nothing(spark, no_docs):
    assert collocations.collocations(no_docs).count() == 0
