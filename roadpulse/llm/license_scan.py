"""License scan by canonical digests, in DataFrame operations only.

A text becomes canonical: copyright lines go, case and punctuation go, equivalent spellings become one. The digest of the
entire canonical text is joined with the digests of known licence texts. Each line is a text of its own as well, since
works name their licence in one line: so there is one unit for the whole text and one for each line.

The known texts are the fixed list in `license_texts.KNOWN`, the long texts known by digest alone in `license_texts.DIGESTS`, or pairs given
by the caller; their digests (32 bytes and a name each) are broadcast up to `MAX_KNOWN` texts and joined by shuffle beyond. Units are made, digested and looked up
where the text is read; only the whole-text unit and the lines found meet again by row, so no text is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.common import Query, table, text_or_empty
from roadpulse.llm.license_texts import DIGESTS, EQUIVALENT, KNOWN

MAX_KNOWN = 20_000

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: A line that begins with a copyright sign, or with "copyright" and holds a year or goes on with "by" or a sign.
COPYRIGHT_LINE = (
    r"^[^a-z0-9\n]*(copyright:?[ \t]*(\(c\)|©|[0-9]|by[ \t])|copyright[^\n]*[^0-9\n](19|20)[0-9][0-9]|©|\(c\)[ \t]*[0-9]"
    r"|all[ \t]+rights[ \t]+reserved)[^\n]*$"
)
NO_WORD = r"[^\p{L}\p{N}\n]+"
#: Variants of several words may be broken by a line's end; those of one word can't.
PHRASES = [p for p in EQUIVALENT if " " in p[0].strip()]
WORDS = [p for p in EQUIVALENT if " " not in p[0].strip()]


def _replaced(text: Column, pairs: list[tuple[str, str]]) -> Column:
    for variant, canon in pairs:
        text = F.replace(text, F.lit(variant), F.lit(canon))
    return text


def canonical_lines(text: Column) -> Column:
    """Lower case, no copyright lines, words by one space, single-word spellings made one; line ends stay."""
    low = F.translate(text, UPPER, UPPER.lower())
    kept = F.regexp_replace(low, "(?dm)" + COPYRIGHT_LINE, "")
    return _replaced(F.regexp_replace(kept, NO_WORD, " "), WORDS)


def canonical_whole(lines: Column) -> Column:
    return F.trim(_replaced(F.regexp_replace(lines, r"[ \n]+", " "), PHRASES))


def known_digests(spark: SparkSession, known: list[tuple[str, str]], digests: list[tuple[str, str]]) -> DataFrame:
    """(digest, license): one row per canonical text, given as such or by its digest; of licences with the same text the first by name."""
    given = spark.createDataFrame(known, "license string, text string")
    lines = given.select("license", canonical_lines(text_or_empty("text")).alias("l"))
    made = lines.select(F.sha2(canonical_whole(F.col("l")), 256).alias("digest"), "license")
    made = made.union(spark.createDataFrame([(d, name) for name, d in digests], "digest string, license string"))
    return made.groupBy("digest").agg(F.min("license").alias("license"))


def scan_licenses(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    known: list[tuple[str, str]] | None = None,
    digests: list[tuple[str, str]] | None = None,
) -> DataFrame:
    """One row per row of `docs`: id, digest, license, n_notices, notices.

    `digest` is the SHA-256 of the entire canonical text, `license` the known licence with that digest or null.
    `n_notices` counts the lines that are a known text as a whole; `notices` names their licences, sorted, comma between
    them, empty if none. A null text counts as empty; an empty text, or one of punctuation or copyright lines only, has the digest of
    the empty text, which no licence has. A very long text is one row and is digested whole. Repeated rows and null ids give a row each. Other columns are not read.

    `known` holds (licence, text), `digests` (licence, digest of the canonical text); without either the lists of `license_texts` count.
    """
    if known is None and digests is None:
        known, digests = KNOWN, DIGESTS
    known, digests = known or [], digests or []
    rows = docs.select(
        F.col(id).alias("_id"),
        F.monotonically_increasing_id().alias("_row"),
        canonical_lines(text_or_empty(text)).alias("_lines"),
    )
    units = rows.select(
        "_id",
        "_row",
        F.posexplode(
            F.concat(
                F.array(canonical_whole(F.col("_lines"))),
                F.filter(F.split(_replaced(F.col("_lines"), PHRASES), "\n"), lambda line: F.trim(line) != ""),
            )
        ).alias("_unit", "_text"),
    ).select("_id", "_row", "_unit", F.sha2(F.trim("_text"), 256).alias("digest"))
    lookup = known_digests(docs.sparkSession, known, digests).filter(F.col("digest") != F.sha2(F.lit(""), 256))
    if len(known) + len(digests) <= MAX_KNOWN:
        lookup = F.broadcast(lookup)
    found = units.join(lookup, "digest", "left").filter((F.col("_unit") == 0) | F.col("license").isNotNull())
    whole, line = F.col("_unit") == 0, F.col("_unit") > 0
    return (
        found.groupBy("_row")
        .agg(
            F.first("_id").alias(id),
            F.max(F.when(whole, F.col("digest"))).alias("digest"),
            F.max(F.when(whole, F.col("license"))).alias("license"),
            F.count(F.when(line, 1)).alias("n_notices"),
            F.array_join(F.sort_array(F.collect_set(F.when(line, F.col("license")))), ",").alias("notices"),
        )
        .drop("_row")
    )


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _sql_replaced(text: str, pairs: list[tuple[str, str]]) -> str:
    for variant, canon in pairs:
        text = f"replace({text}, {_sql_text(variant)}, {_sql_text(canon)})"
    return text


def oracle(known: list[tuple[str, str]], digests: list[tuple[str, str]]) -> str:
    def lines(text: str) -> str:
        low = f"translate(coalesce({text}, ''), '{UPPER}', '{UPPER.lower()}')"
        kept = f"regexp_replace({low}, {_sql_text('(?m)' + COPYRIGHT_LINE)}, '', 'g')"
        return _sql_replaced(f"regexp_replace({kept}, {_sql_text(NO_WORD)}, ' ', 'g')", WORDS)

    whole = f"trim({_sql_replaced(f"regexp_replace(l, '[ \\n]+', ' ', 'g')", PHRASES)}, ' ')"
    line = f"unnest(string_split({_sql_replaced('l', PHRASES)}, chr(10)))"
    values, long_values = (", ".join(f"({_sql_text(a)}, {_sql_text(b)})" for a, b in pairs) for pairs in (known, digests))
    return f"""
WITH known AS (
  SELECT digest, min(license) AS license FROM (
    SELECT sha256({whole}) AS digest, license
    FROM (SELECT license, {lines("text")} AS l FROM (VALUES {values}) AS k(license, text))
    UNION ALL SELECT digest, license FROM (VALUES {long_values}) AS k(license, digest)
  ) GROUP BY 1
), docs AS (
  SELECT row_number() OVER () AS r, doc_id, {lines("text")} AS l FROM documents
), hits AS (
  SELECT r, count(*) AS n, string_agg(DISTINCT license, ',' ORDER BY license) AS names
  FROM (SELECT r, sha256(trim(u, ' ')) AS digest FROM (SELECT r, {line} AS u FROM docs)) JOIN known USING (digest)
  GROUP BY r
)
SELECT doc_id, w.digest, license, coalesce(n, 0) AS n_notices, coalesce(names, '') AS notices
FROM (SELECT r, doc_id, sha256({whole}) AS digest FROM docs) AS w
LEFT JOIN known USING (digest) LEFT JOIN hits USING (r)
"""


QUERIES: dict[str, tuple[Query, str | None]] = {"op1_license_scan": (op1, oracle(KNOWN, DIGESTS))}
