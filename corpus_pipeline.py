"""From raw documents to packed training sequences: five stages, each written as Parquet and read again by the next."""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assocspark.llm import decontam, linededup, minhash, packing, text, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the span tagger does not call toxic; it learns from the labelled ones that are not held out."""
    return toxicity.without_toxic(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def drop_repeated_runs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without runs that an earlier one has; those that are nothing else go. n_chars follows the text."""
    cut = linededup.remove_later_runs(docs, drop_emptied=True)
    return cut.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every class of near-duplicates."""
    return minhash.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.without_items(docs, _table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents left, with their place in sequences of 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=2048, end_id=0)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_runs),
    ("near_dedup", drop_near_copies),
    ("decontaminate", drop_leaks),
    ("pack", pack),
]

#: A trained tagger and iterated packing have no SQL form; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for _, apply in STAGES:
        docs = text.stage(apply(spark, docs, sf_dir))
    return docs


QUERIES = {"pipeline": (run, ORACLE_SQL)}
