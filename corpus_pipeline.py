"""A corpus pipeline of five stages: language, lines, near-duplicates, substrings, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the next stage's docs; all but the last keep the columns of documents, and drop any others.
Rows are never merged by id: repeated rows are documents of their own.  An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runloom.llm import common, language, line_dedup, packing, simhash, substring_dedup
from runloom.llm.queries import tokenizer

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a sufficient margin; null and blank texts and those without letters go."""
    dictionaries = language.learn(docs.where(~language.held_out()))
    return language.classify(docs, dictionaries).where(~F.col("rejected")).select(COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that five documents or more share stay in one of them; n_chars follows the text.  Rows without id lose such lines, and a document can become blank."""
    done = line_dedup.drop_lines(docs)
    return done.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates; blank texts have equal fingerprints and are one group."""
    return simhash.keep_one(docs).select(COLUMNS)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 35 words or more that occur again go, everywhere; n_chars follows the text.  Null texts stay null."""
    done = substring_dedup.remove_repeats(docs)
    return done.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences of 2048; a null or empty text is its end token alone."""
    return packing.pack(docs, tokenizer("byte_bpe_50k.json"))


STAGES = [
    ("language", keep_known_language),
    ("lines", drop_repeated_lines),
    ("near_copies", keep_one_of_near_copies),
    ("passages", remove_repeated_passages),
    ("packing", pack_sequences),
]

#: The stages are not all expressible in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = common.table(docs)
    return docs
