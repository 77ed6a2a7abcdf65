import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _row string, _lid int, score string"


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, empty and very long texts, ties, repeated rows, copies, and columns whose names operators use themselves."""
    rng = random.Random(5)
    syllables = {"en": "tha ing er the on ti re".split(), "de": "sch ein ung ß ü en ver".split()}

    def prose(lang, n):
        return " ".join("".join(rng.choices(syllables[lang], k=rng.randint(1, 3))) for _ in range(n))

    rows = [(i, prose(("en", "de")[i % 2], rng.choice([1, 3, 30, 120])), ("en", "de")[i % 2], f"s{i % 3}") for i in range(60)]
    long_ = prose("en", 9000)
    rows += [(100, None, "en", "s0"), (101, "", None, "s0"), (102, " \t\n ", "en", None), (103, "!!! 123", "de", "s1")]
    rows += [(104, long_, "en", "s0"), (105, long_.replace(" ", "  "), "en", "s1"), (106, long_[:30000] + " x " + long_[30000:], "en", "s1")]
    rows += [(107, rows[4][1], "en", "s0"), (108, rows[4][1].upper(), "en", "s0"), (5, rows[5][1], "de", "s2"), (None, rows[6][1], "en", "s2")]
    rows += [(None, None, None, None), (109, "thaing<|endoftext|> É'S " + rows[20][1], "en", "s2"), (110, "a" * 500, "en", "s2")]
    rows += [(111, ("é" * 40 + " ") * 8, "de", "s2"), (112, "é" * 40 + " ", "de", "s2"), (113, rows[20][1] + " Released under the MIT License.", "en", "s0")]
    return [(*r, None if r[1] is None else len(r[1]), "r", 1, "x") for r in rows]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    return spark.createDataFrame(edge_rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
