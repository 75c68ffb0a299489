"""Corpus pipeline: each stage works on what the one before it kept.

A stage begins by releasing what the stages before it shared with the executors;
their Python workers keep one operator's state at a time. Defined cases are those
of the operators: null or letterless texts are in no known language and go first;
rows that repeat a doc_id are one document to line dedup and near dedup, which keeps
one of them; an empty table gives an empty result; of other columns only the five of
``COLUMNS`` are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellkpi.llm import byte_bpe, decontaminate, language_id, near_dup
from cellkpi.llm.common import materialise, release_shared, table
from cellkpi.llm.line_dedup import dedup_lines

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; learns from the labels of those not held out."""
    release_shared()
    found = language_id.identify_language(docs.select(COLUMNS), language_id.learn(docs))
    return found.where(F.col("lang_pred") != language_id.UNKNOWN).select(COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier one holds; none is dropped."""
    release_shared()
    kept = dedup_lines(docs.select(COLUMNS)).select(COLUMNS)
    return kept.withColumn("n_chars", F.coalesce(F.char_length("text"), F.lit(0)).cast("long")).select(COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    release_shared()
    return near_dup.keep_one_of_each_group(docs.select(COLUMNS)).select(COLUMNS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    release_shared()
    return decontaminate.remove_leaks(docs.select(COLUMNS), table(spark, sf_dir, "benchmark")).select(COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of the ids and of the decoded bytes of each document."""
    release_shared()
    return byte_bpe.round_trip(docs.select("doc_id", "text"), offsets=False)


STAGES = [
    ("language_id", identify),
    ("line_dedup", drop_lines),
    ("near_dup", drop_near_duplicates),
    ("decontaminate", drop_leaks),
    ("byte_bpe", encode),
]

#: Language id, MinHash, latent retrieval and BPE have no SQL form; tests hold the
#: pipeline against plain versions of its stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
