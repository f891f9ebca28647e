"""A pipeline over `documents`: quality rules, near duplicates, repeated passages, mix, packing.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before it kept.
Stages but the last return the columns of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postsift.llm import curriculum, jaccard, packing, repetition, suffixes
from postsift.llm.tables import discard, importable, stored, table, with_row_key

#: Stages cut texts at bytes and token ids, which SQL cannot express.
ORACLE_SQL = None

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules reject go; null and empty texts among them."""
    importable(spark)
    return repetition.with_repetition(docs.select(*COLUMNS)).where("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id stays.

    Rows that repeat a doc_id are documents of their own; rows without one cannot be told apart
    and stay as they are.
    """
    importable(spark)
    rows, _ = with_row_key(docs.select(*COLUMNS), "doc_id", "text", "llm_key")
    classes = jaccard.jaccard_join(rows, doc_id="llm_key")
    others = classes.where("doc_id <> class_id").select(F.col("doc_id").alias("llm_key"))
    left = rows.join(others, "llm_key", "left_anti").select(*COLUMNS)
    return left.unionByName(docs.where("doc_id IS NULL").select(*COLUMNS))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 100 bytes that occurred before are cut out; a document of which nothing is left goes."""
    importable(spark)
    found = suffixes.repeated_passages(docs.select(*COLUMNS), keep=("lang", "source", "n_chars"), decoded=True)
    left = found.where("n_bytes = 0 OR length(kept) > 0")
    cut = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    chars = F.when(F.col("n_removed") > 0, F.length("kept").cast("bigint")).otherwise(F.col("n_chars"))
    named = left.select("doc_id", cut.alias("text"), "lang", "source", chars.alias("n_chars"))
    return named.unionByName(docs.where("doc_id IS NULL").select(*COLUMNS))


def curriculum_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each time the mix takes a document, with the words taken, in training order."""
    importable(spark)
    mix = curriculum.curriculum_mix(docs.select(*COLUMNS), size=curriculum.word_count(F.col("text")), ordered=False)
    takes = mix.select("doc_id", "text", "lang", "source", "n_chars", "mix_size", F.explode("mix_takes").alias("take"))
    whole = F.col("take.words") == F.col("mix_size")
    text = F.when(whole, F.col("text")).otherwise(curriculum.first_words(F.col("text"), F.col("take.words")))
    cut = takes.select("doc_id", text.alias("text"), "lang", "source", F.col("n_chars").alias("given"), whole.alias("whole"), "take.position")
    chars = F.when(F.col("whole"), F.col("given")).otherwise(F.length("text").cast("bigint"))
    return cut.orderBy("position", "doc_id").select("doc_id", "text", "lang", "source", chars.alias("n_chars"))


def sum_of_squares_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training sequences with their token ids."""
    importable(spark)
    pieces = packing.pack(docs, path=public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("mixing sources to target weights", curriculum_mix),
    ("packing", sum_of_squares_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what a stage returns is written, read by the next and then removed."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        done = stored(stage(spark, docs, sf_dir))
        if k:
            discard(docs)
        docs = done
    return STAGES[-1][1](spark, docs, sf_dir)
