"""The corpus pipeline: documents through language ID, exact dedup, near dedup, long-match dedup and packing.

Each stage takes the documents that the one before has kept and returns documents again, the last one the pieces of the packed
sequences. Columns that documents have besides the usual ones pass through all stages but the last. Null and empty texts have no
letter: language ID rejects them. An empty table gives an empty result in each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm import exact_dedup, language_id, near_dedup, packing, suffix_dedup
from roadpulse.llm.common import fresh, stored


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language: those go that have no letter, or lie far from every centroid for their length."""
    found = fresh(docs.columns, "_lid")
    kept = language_id.identify(docs, language_id.fit(docs), out=found).filter(~F.col(f"{found}.rejected"))
    return kept.select(*docs.columns)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, white space aside: the one with the smallest id."""
    # Rows are known by id and text, so that rows repeating an id are told apart; ids are numbers, so "-" is none of them.
    row, digest = fresh(docs.columns, "_row"), fresh(docs.columns, "_digest")
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))
    kept = exact_dedup.exact_duplicates(docs).filter("kept").select(key.alias(row), F.col("text_sha256").alias(digest))
    keyed = docs.withColumns({row: key, digest: F.sha2(exact_dedup.normalised("text").cast("binary"), 256)})
    return keyed.dropDuplicates([row, digest]).join(kept, [row, digest], "left_semi").select(*docs.columns)


#: Percent of common five-word shingles from which documents are near duplicates here.
NEAR_PERCENT = 80


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str, percent: int = NEAR_PERCENT) -> DataFrame:
    """One document of each group of near duplicates, linked from `percent` of common shingles on; an id goes when none of its rows is kept."""
    found = near_dedup.near_duplicates(docs, percent=percent)
    gone = found.groupBy("doc_id").agg(F.max("kept").alias("any")).filter("not any").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def long_match_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that a 50-byte string shares with a document before; characters that a cut has broken go too."""
    others = [c for c in docs.columns if c != "text"]
    no_text, found = fresh(docs.columns, "_no_text"), fresh(docs.columns, "_repeats")
    marked = docs.withColumn(no_text, F.col("text").isNull())
    rest = suffix_dedup.remove_repeats(marked, keep=[*others, no_text], out=found)
    text = F.col(f"{found}.kept").cast("string")
    whole = F.regexp_replace(F.make_valid_utf8(text), "�", "")
    text = F.when(~F.col(no_text), F.when(F.col(f"{found}.n_removed") == 0, text).otherwise(whole))
    out = rest.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(dict(docs.dtypes)["n_chars"]))
    return out.select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens, every sequence with the corpus's mixture of sources."""
    return packing.pack(docs)


STAGES = [
    ("language ID", language_stage),
    ("exact dedup", exact_stage),
    ("near dedup", near_stage),
    ("long-match dedup", long_match_stage),
    ("packing", packing_stage),
]

#: SQL can't express the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over `documents`; what each returns is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, f"stage-{i}")
    return docs
