"""The corpus pipeline: stages over ``documents``, each stored before the next one reads it.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the
last return the columns of ``documents``; ``n_chars`` follows the text. Columns that documents may
have besides those are dropped at the first stage.

1. quality: documents the importance resampling rejects go.
2. lines: chunks of lines and passages of over 50 words that repeat an earlier document's are cut
   out of the text. Documents
   whose whole text was cut out stay as empty ones, and are near duplicates of each other.
3. near duplicates: documents whose SimHash fingerprints (three-word shingles) differ in three bits
   or fewer are linked, and of each linked group the document of the smallest key stays;
   a document without a key stays only when no row of its group has one.
4. benchmark: documents that hold a benchmark item go.
5. tokens: ids of every text, and what they decode to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from ledgerline.llm import bpe, decontamination, line_dedup, resampling, simhash
from ledgerline.llm.common import stored, table
from ledgerline.llm.queries import GOOD

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    return resampling.resample(docs.select(*COLUMNS), labels, GOOD).select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(docs, passage_words=line_dedup.PASSAGE_WORDS, keep=("lang", "source"))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs.select(*COLUMNS), shingle=simhash.SHINGLE, distance=simhash.DISTANCE)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark", "item_id", "text")
    return decontamination.without_items(docs.select(*COLUMNS), items)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.tokens(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("tokens", tokens),
]

# Hashes, learned weights and BPE have no SQL form; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
