"""The corpus pipeline: toxicity, near duplicates, repeated passages, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir) and returns documents again (the last one returns packed
pieces). ``run`` writes every stage's result as Parquet in the shared folder and reads it back as
the next stage's input. Rows whose doc_id is null or repeated are told apart by their texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from kestrel.llm import curve_packing, decontam, minhash, rlz_dedup, toxicity
from kestrel.llm.common import KEY, ship, sieved, stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _rejected(rows: DataFrame, bad: DataFrame) -> DataFrame:
    """rows (COLUMNS and KEY) without those whose KEY is among bad (KEY). Only rows that may be among
    them are shuffled to find out."""
    bad = stored(bad.select(KEY).distinct())
    maybe, never = sieved(rows.select(*COLUMNS, KEY), bad)
    good = maybe.join(bad, KEY, "left_anti")
    return good.select(*COLUMNS).unionByName(never.select(*COLUMNS))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5 stay."""
    ship(spark)
    return toxicity.scored(docs.select(*COLUMNS), table(spark, sf_dir, "labels")).filter("score < 0.5").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked at similarity 0.8 or more the one with the smallest id stays;
    of rows that repeat id and text, one."""
    ship(spark)
    _, rows, named = minhash.linked(docs, keep=["lang", "source", "n_chars"])
    return _rejected(rows.withColumnRenamed("id", "doc_id"), named.filter(f"{KEY} != root"))


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words inside 20-word sequences that start earlier in the corpus go; a document that loses all
    its words goes too. Texts that lose nothing stay as they are."""
    ship(spark)
    cut = rlz_dedup.parse(docs.select(*COLUMNS), keep=["lang", "source"], single_spaces=False)
    return (cut.filter("n_removed = 0 or n_removed < n_words")
            .select(F.col("id").alias("doc_id"), F.col("kept").alias("text"), "lang", "source", F.length("kept").cast("bigint").alias("n_chars")))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold at least half of a benchmark item's tokens, in whatever order, go."""
    ship(spark)
    rows = docs.select(*COLUMNS, F.xxhash64("doc_id", "text").alias(KEY))
    return _rejected(rows, decontam.leaks(rows, table(spark, sf_dir, "benchmark"), id_col=KEY).select(F.col("id").alias(KEY)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents in sequences of 2048, neighbours on the curve together."""
    ship(spark)
    return curve_packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("curve_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; the packed pieces."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs


#: No SQL: a trained classifier, tiling and a tokenizer take part.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
