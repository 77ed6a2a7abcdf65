"""Personal data in texts, in DataFrame operations only.

A regular expression for each kind proposes spans, a validator (Luhn, mod-97, ranges of numbers) confirms them, and words close by
raise or lower their score. Kinds of `BASE` keep every span that is confirmed, whatever its score; the other kinds need `least`.

All is computed where the text is read: nothing is shuffled. The text between two matches comes from the same expression as
the matches do, so places are running sums of lengths, and each text is read a fixed number of times however many matches it
has. Quantifiers are possessive and start where a run of characters starts, so no expression goes back over a long run.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.common import Query, table, text_or_empty

#: Score in percent that a span of the added kinds needs.
LEAST = 50
#: Characters read for context before and after a span, back to the match before and on to the next of the same kind.
BEFORE, AFTER = 40, 20
#: Lengths summed up at once for running sums.
BLOCK = 256

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Lengths of account numbers by country (ISO 13616 registry, the larger countries).
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI NL", 19: "SI", 20: "AT BA EE KZ LT LU", 21: "CH HR LI LV", 22: "BG DE GB GE IE ME RS",
    23: "AE IL", 24: "AD CZ ES PK RO SA SE SK TN", 25: "PT", 26: "IS TR", 27: "FR GR IT MC SM", 28: "AL AZ CY DO HU LB PL",
    29: "BR QA UA", 30: "JO KW MU", 31: "MT",
}
IBAN = "|".join(f"(?:{'|'.join(c.split())})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_LENGTHS.items())

PART = "0*(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"


def digits(span: Column) -> Column:
    return F.regexp_replace(span, "[^0-9]", "")


def remainder_97(span: Column) -> Column:
    """The account number as the standard reads it: first four characters last, letters as 10 to 35, modulo 97."""
    compact = F.replace(span, F.lit(" "), F.lit(""))
    moved = F.concat(F.substring(compact, 5, 64), F.substring(compact, 1, 4))
    value = F.transform(F.regexp_extract_all(moved, F.lit("[A-Z0-9]"), F.lit(0)), lambda c: F.ascii(c) - F.when(c >= "A", 55).otherwise(48))
    return F.aggregate(value, F.lit(0), lambda r, v: (r * F.when(v > 9, 100).otherwise(10) + v) % 97)


@dataclass(frozen=True)
class Kind:
    """A kind of span: expression, validator, the same in SQL over `span`, `before` and `after`, score, and words that change it."""

    name: str
    pattern: str
    sql_pattern: str
    valid: Callable[[Column, Column, Column], Column]
    sql_valid: str
    score: int
    raising: str
    lowering: str = "example|sample|dummy|placeholder"
    #: A character without which no span is there: searched first, as that is much faster than the expression.
    needs: str = ""


SQL_DIGITS = "regexp_replace(span, '[^0-9]', '', 'g')"
SQL_LUHN = (
    f"list_sum(list_transform(range(len({SQL_DIGITS})), lambda i: "
    f"CASE WHEN i % 2 = 0 THEN CAST({SQL_DIGITS}[len({SQL_DIGITS}) - i] AS INT) "
    f"ELSE [0, 2, 4, 6, 8, 1, 3, 5, 7, 9][CAST({SQL_DIGITS}[len({SQL_DIGITS}) - i] AS INT) + 1] END)) % 10 = 0"
)
SQL_97 = (
    "list_reduce(list_concat([0], list_transform(string_split("
    "replace(span, ' ', '')[5:] || replace(span, ' ', '')[:4], ''), "
    "lambda c: ascii(c) - CASE WHEN c >= 'A' THEN 55 ELSE 48 END)), "
    "lambda r, v: (r * CASE WHEN v > 9 THEN 100 ELSE 10 END + v) % 97) = 1"
)
#: A number that goes on before or after the span, or one with a country code before it.
LONGER = (r"([0-9][-.]?|\+[0-9][0-9 ().-]*)$", r"^[-.]?[0-9]")

KINDS = [
    Kind(
        "email",
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        lambda span, before, after: F.lit(True),
        "true",
        70,
        "mail|email|e-mail|contact|write|kontakt|courriel|correo",
        needs="@",
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        lambda span, before, after: span.rlike(rf"^{PART}(?:\.{PART}){{3}}$"),
        rf"regexp_full_match(span, '{PART}(?:\.{PART}){{3}}')",
        60,
        "ip|address|host|server|login|client|adresse",
        "version|release|build|section|chapter",
    ),
    Kind(
        "card",
        r"(?<![0-9])(?<![0-9][\x20-])(?=[0-9](?:[\x20-]?[0-9]){12})[0-9]++(?:[\x20-][0-9]++)*+",
        r"[0-9]([\x20-]?[0-9])+",
        # luhn_check wants digits only and takes no other length apart: both are checked before.
        lambda span, before, after: F.length(digits(span)).between(13, 19) & F.call_function("luhn_check", digits(span)),
        f"len({SQL_DIGITS}) BETWEEN 13 AND 19 AND {SQL_LUHN}",
        60,
        "card|visa|mastercard|amex|credit|debit|karte|carte|tarjeta",
        "order|invoice|isbn|serial|tracking",
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        lambda span, before, after: F.length(digits(span)).between(9, 15),
        f"len({SQL_DIGITS}) BETWEEN 9 AND 15",
        70,
        "phone|tel|telephone|call|mobile|cell|fax|whatsapp|telefon|handy|portable",
        needs="+",
    ),
    Kind(
        "iban",
        # The look ahead spares most places the long list of countries.
        f"(?=[A-Z]{{2}}[0-9]{{2}})(?:{IBAN})",
        IBAN,
        lambda span, before, after: ~before.rlike("[A-Za-z0-9]$") & ~after.rlike("^[A-Za-z0-9]") & (remainder_97(span) == 1),
        f"NOT regexp_matches(before, '[A-Za-z0-9]$') AND NOT regexp_matches(after, '^[A-Za-z0-9]') AND {SQL_97}",
        80,
        "iban|account|bank|konto|compte|cuenta",
    ),
    Kind(
        "ssn",
        r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
        r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
        lambda span, before, after: ~before.rlike(LONGER[0]) & ~after.rlike(LONGER[1]) & ~span.rlike("^(000|666|9)|-00-|-0000$"),
        f"NOT regexp_matches(before, '{LONGER[0]}') AND NOT regexp_matches(after, '{LONGER[1]}') "
        "AND NOT regexp_matches(span, '^(000|666|9)|-00-|-0000$')",
        40,
        "ssn|social security|social|taxpayer|tax id",
    ),
    Kind(
        "local_phone",
        r"\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}",
        r"\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}",
        lambda span, before, after: ~before.rlike(LONGER[0]) & ~after.rlike(LONGER[1]),
        f"NOT regexp_matches(before, '{LONGER[0]}') AND NOT regexp_matches(after, '{LONGER[1]}')",
        40,
        "phone|tel|telephone|call|mobile|cell|fax|whatsapp|telefon|handy|portable",
    ),
]
BASE = ["email", "ip", "card", "phone"]


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once, however often `use` reads it."""
    return F.transform(F.array(value), use)[0]


def running(lengths: Column) -> Column:
    """For each element the sum of those before it. By blocks, so that ten thousand elements don't take their square."""

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0).cast("long"), lambda s, x: s + x)

    blocks = F.transform(
        F.sequence(F.lit(0), F.floor(F.size(lengths) / BLOCK).cast("int")),
        lambda b: total(F.slice(lengths, b * BLOCK + 1, F.lit(BLOCK))),
    )
    return bound(
        blocks,
        lambda sums: F.transform(
            lengths,
            lambda _, j: total(F.slice(sums, F.lit(1), F.floor(j / BLOCK).cast("int")))
            + total(F.slice(lengths, (F.floor(j / BLOCK) * BLOCK + 1).cast("int"), j % BLOCK)),
        ),
    )


SPAN = "array<struct<kind:string,start:bigint,end:bigint,text:string,score:int>>"


def spans_of(text: Column, kind: Kind, least: int) -> Column:
    """Confirmed spans of one kind in order, with their scores."""

    def near(words: str, context: Column) -> Column:
        return context.rlike(f"(^|[^a-z])({words})([^a-z]|$)")

    def located(spans: Column) -> Column:
        def judged(pieces: Column) -> Column:
            # Spans and pieces take turns, so the lengths before a span are those of the pieces up to it and the spans before.
            lengths = F.transform(spans, lambda s, j: (F.length(F.get(pieces, j)) + F.length(s)).cast("long"))
            starts = bound(lengths, running)
            return bound(starts, lambda at: F.transform(spans, lambda s, j: one(s, F.get(at, j), F.get(pieces, j), F.get(pieces, j + 1))))

        return bound(F.split(text, kind.pattern, -1), judged)

    def one(span: Column, at: Column, before: Column, after: Column) -> Column:
        context = F.translate(F.concat(F.right(before, F.lit(BEFORE)), F.lit(" "), F.left(after, F.lit(AFTER))), UPPER, UPPER.lower())
        score = F.lit(kind.score) + F.when(near(kind.raising, context), 20).otherwise(0) - F.when(near(kind.lowering, context), 30).otherwise(0)
        start = at + F.length(before)
        # The neighbours that a validator looks at are near.
        valid = kind.valid(span, F.right(before, F.lit(BEFORE)), F.left(after, F.lit(AFTER)))
        return F.struct(
            F.lit(kind.name).alias("kind"),
            start.alias("start"),
            (start + F.length(span)).alias("end"),
            span.alias("text"),
            F.when(valid, score).alias("score"),
        )

    def kept(found: Column) -> Column:
        wanted = lambda s: s["score"].isNotNull() if kind.name in BASE else F.coalesce(s["score"] >= least, F.lit(False))
        return F.filter(found, wanted)

    none = F.array().cast(SPAN)
    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    spans = bound(matches, lambda m: F.when(F.size(m) > 0, kept(located(m))).otherwise(none))
    return (F.when(text.contains(kind.needs), spans).otherwise(none) if kind.needs else spans).cast(SPAN)


def find_pii(docs: DataFrame, id: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """One row per row of `docs`: id and spans, an array of (kind, start, end, text, score).

    Spans are in the order of `KINDS`, then of their start; places count code points from 0, the end is exclusive. Matches are leftmost and do not overlap
    within a kind; one that its validator rejects is dropped without another try. Score is in percent: that of the kind, 20 more with
    one of its words close by, 30 less with a word against it. A null text counts as empty, and an empty one has no spans;
    a text of any length is read whole. Null ids and repeated rows give a row each, an empty table none. Other columns are not read.
    """
    rows = docs.select(F.col(id).alias("_id"), text_or_empty(text).alias("_text"))
    found = F.concat(*[spans_of(F.col("_text"), kind, least) for kind in KINDS])
    return rows.select(F.col("_id").alias(id), found.alias("spans"))


def placed(spans: Column) -> Column:
    """kind:start:end of each span, comma between them."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents"))
    # The spans are an array that is read many times below: once made, it is kept by a generator that Spark doesn't fold away.
    one = found.select("doc_id", F.explode(F.array("spans")).alias("s"))
    number = lambda kind: F.size(F.filter("s", lambda x: x["kind"] == kind)).cast("long")
    return one.select(
        "doc_id",
        *[number(kind).alias(f"n_{kind}") for kind in BASE],
        F.sha2(placed(F.filter("s", lambda x: x["kind"].isin(BASE))).cast("binary"), 256).alias("base_sha256"),
        placed(F.col("s")).alias("spans"),
        *[number(kind.name).alias(f"n_{kind.name}") for kind in KINDS if kind.name not in BASE],
        F.size(F.filter("s", lambda x: x["score"] >= LEAST)).cast("long").alias("n_likely"),
    )


def _near(words: str) -> str:
    context = f"translate(right(before, {BEFORE}) || ' ' || left(after, {AFTER}), '{UPPER}', '{UPPER.lower()}')"
    return f"regexp_matches({context}, '(^|[^a-z])({words})([^a-z]|$)')"


def oracle() -> str:
    found = " UNION ALL ".join(
        f"SELECT r, {i} AS k, '{kind.name}' AS kind, regexp_extract_all(t, '{kind.sql_pattern}') AS m, "
        f"string_split_regex(t, '{kind.sql_pattern}') AS p FROM docs"
        for i, kind in enumerate(KINDS)
    )
    judged = " UNION ALL ".join(
        f"SELECT r, k, kind, a, a + len(span) AS b, {kind.score} + CASE WHEN {_near(kind.raising)} THEN 20 ELSE 0 END "
        f"- CASE WHEN {_near(kind.lowering)} THEN 30 ELSE 0 END AS score FROM placed WHERE k = {i} AND {kind.sql_valid}"
        for i, kind in enumerate(KINDS)
    )
    base = ", ".join(f"'{kind}'" for kind in BASE)
    counts = ", ".join(f"count(*) FILTER (kind = '{kind.name}') AS n_{kind.name}" for kind in KINDS)
    numbers = ", ".join(f"coalesce(n_{kind.name}, 0) AS n_{kind.name}" for kind in KINDS)
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), found AS ({found}), one AS (
  SELECT r, k, kind, i, m[i] AS span, p[i] AS before, p[i + 1] AS after
  FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM found)
), placed AS MATERIALIZED (
  SELECT *, CAST(sum(len(before) + len(span)) OVER (PARTITION BY r, k ORDER BY i) AS BIGINT) - len(span) AS a FROM one
), judged AS ({judged}), kept AS (
  SELECT *, kind || ':' || a || ':' || b AS s FROM judged WHERE kind IN ({base}) OR score >= {LEAST}
), sums AS (
  SELECT r, {counts}, count(*) FILTER (score >= {LEAST}) AS n_likely, string_agg(s, ',' ORDER BY k, a) AS spans,
         string_agg(s, ',' ORDER BY k, a) FILTER (kind IN ({base})) AS base FROM kept GROUP BY r
)
SELECT doc_id, {numbers}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_likely, 0) AS n_likely
FROM docs LEFT JOIN sums USING (r)
"""


QUERIES: dict[str, tuple[Query, str | None]] = {"op11_pii": (op11, oracle())}
