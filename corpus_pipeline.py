"""The corpus pipeline: from raw documents to packed training sequences.

Each stage reads what the one before kept, written as Parquet, and its decisions take effect. All but
the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from supplylens.functions.workspace import hold, release_since, written
from supplylens.llm import exact_dedup, language, near_join, packing, suffix_dedup
from supplylens.llm.vocabularies import vocabulary

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; text without letters and doubtful text goes."""
    return language.keep_identified(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the one with the largest id."""
    return exact_dedup.drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8 or more."""
    return near_join.drop_near_duplicates(docs, size=5, num=4, den=5)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that several documents share stay in one of them only."""
    cut = suffix_dedup.cut_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands in the training sequences."""
    return packing.pack_documents(docs, vocabulary("word_bpe_49k.json"), give={"ids_crc32": F.crc32("ids")})


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("exact_dedup", exact),
    ("ngram_jaccard", near),
    ("suffix_array_dedup", passages),
    ("best_fit_packing", pack),
]

#: SQL cannot train a classifier, follow links to a fixpoint or run a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's rows are written and read again.

    What a stage has written, and what it has read from the one before, is deleted when its rows are
    there; no other query of this process may be running meanwhile.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = written()
    for name, stage in STAGES:
        docs = hold(stage(spark, docs, sf_dir), name)
        release_since(spark, before, keep=1)
        before = written() - 1
    return docs
