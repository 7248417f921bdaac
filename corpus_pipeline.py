"""A corpus pipeline: toxic documents go, copies and near copies go, repeated passages are cut, and
what is left is packed into sequences. Each stage reads what the one before it wrote."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from thermolens.llm import exact, near, pack, suffix, toxicity
from thermolens.llm.common import settle

TOKENIZER = "word_bpe_49k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a machine fitted on the labels does not call toxic. Null and empty texts have
    the score of the bias alone; repeated rows are judged alike; without labels nothing goes."""
    machine = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, machine)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the longest original, then the smallest doc_id
    (nulls last), one of repeated rows. Null and empty texts are one group."""
    return exact.fresh_index(spark, docs).keep(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the smallest doc_id, nulls last, one of
    repeated rows. A text without words is its own class and stays."""
    return near.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of 200 bytes and more that occur elsewhere. No row goes,
    null and empty texts stay as they are."""
    return suffix.cut_texts(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens. Null and empty texts have the end id alone;
    an empty table gives no pieces."""
    return pack.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("near duplicates", drop_near_copies),
    ("repeated passages", cut_repeats),
    ("packing", pack_sequences),
]

#: The fitted scores cannot be told in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
