"""The registered queries of this package and their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from thermolens.llm import (
    align, bpe, byte_bpe, exact, language, lines, near, pack, quality, suffix, toxicity, urls,
    whitening)

TOKENIZER = "word_bpe_49k.json"
RANKS = "byte_bpe_50k.tiktoken"
ALIGNED = ("byte_bpe_50k.json", "piece_bpe_32k.model")
Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return exact.fresh_index(spark, docs).dedup(docs)


def op2_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    encoded = bpe.encode(table(spark, folder, "documents"), path)
    return bpe.decode(encoded, path).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.cascade(table(spark, folder, "documents"), measure_all=True)
    return judged.select("doc_id", *quality.MEASURES, "base_failed", "kept")


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack.pack(table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER))


#: allow or block, host, path
URL_RULES = [
    urls.Rule("allow", "com", "/"), urls.Rule("block", "example.com", "/en/"),
    urls.Rule("allow", "www.example.com", "/en/"), urls.Rule("block", "net", "/es/"),
    urls.Rule("block", "net", "/fr/")]


def op5_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(table(spark, folder, "pages"), URL_RULES)


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lines.drop_boilerplate(table(spark, folder, "pages")).select(
        "page_id", "host", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").withColumn(
        "held_out", F.coalesce(toxicity.fold("doc_id", 4) == 2, F.lit(False)))
    langs, prototypes = language.learn(docs.filter(~F.col("held_out")))
    return language.predict(docs, langs, prototypes).select(
        "doc_id", "held_out", "lang_pred", "score")


def op8_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = suffix.remove_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    return cut.select(
        "doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        "cut.n_removed", "cut.n_spans", F.sha2("cut.kept", 256).alias("kept_sha256"))


def op9_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return near.near_duplicates(table(spark, folder, "documents")).select(
        "doc_id", "class_id", "copy_id", "n_links")


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    machine = toxicity.train(docs, table(spark, folder, "labels"))
    return toxicity.score(docs, machine).select(
        "doc_id", F.coalesce(toxicity.fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return align.summary(table(spark, folder, "documents"),
                         *map(public_tokenizers.path, ALIGNED))


def op12_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


def op13_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path(RANKS)
    encoded = byte_bpe.encode(table(spark, folder, "documents"), path, public_tokenizers.PATTERN)
    return byte_bpe.decode(encoded, path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES: dict[str, Query] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_bpe": op2_bpe,
    "op3_quality_rules": op3_quality_rules,
    "op4_packing": op4_packing,
    "op5_url_filters": op5_url_filters,
    "op6_line_dedup": op6_line_dedup,
    "op7_language_id": op7_language_id,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_toxicity": op10_toxicity,
    "op11_token_alignment": op11_token_alignment,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_byte_bpe": op13_byte_bpe,
}
