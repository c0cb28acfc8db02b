"""One query for each operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.llm.chunk_bpe import chunked_digests
from corpusloom.llm.decontaminate import contamination
from corpusloom.llm.exact_dedup import exact_duplicates
from corpusloom.llm.language_id import held_out, predict_language, train_language_model
from corpusloom.llm.line_dedup import dedup_lines
from corpusloom.llm.ngram_join import jaccard_components
from corpusloom.llm.phrases import phrases
from corpusloom.llm.pieces import round_trip_pieces
from corpusloom.llm.pseudo_likelihood import pseudo_likelihood
from corpusloom.llm.sharding import shard_rows
from corpusloom.llm.token_store import id_digests, read_index, write_ids
from corpusloom.llm.url_filter import judge_urls
from corpusloom.llm.whitening import whiten
from corpusloom.shared import new_path

SHARDS = 24
RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo_likelihood(documents(spark, sf_dir))


def op2_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token-ids")
    write_ids(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), path)
    return id_digests(read_index(spark, path), path)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(documents(spark, sf_dir))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256")
    return dedup_lines(documents(spark, sf_dir)).select("doc_id", "n_lines", "n_dropped", digest)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = train_language_model(docs.where(~held_out(F.col("doc_id"))))
    held = held_out(F.col("doc_id")).alias("held_out")
    return predict_language(docs, model).select("doc_id", held, "lang_pred", "score")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contamination(documents(spark, sf_dir), benchmark)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(documents(spark, sf_dir), SHARDS)


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir))


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge_urls(pages, rules)


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.sha2(F.col("decoded").cast("binary"), 256).alias("text_sha256")
    rows = round_trip_pieces(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))
    return rows.select("doc_id", "n_ids", "ids_crc32", "same", digest)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return rows.withColumn("deviation", F.col("deviation").cast("long"))


def op12_chunk_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunked_digests(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases(documents(spark, sf_dir))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_lm_scoring": op1_lm_scoring,
        "op2_token_ids": op2_token_ids,
        "op3_exact_dedup": op3_exact_dedup,
        "op4_line_dedup": op4_line_dedup,
        "op5_language_id": op5_language_id,
        "op6_decontamination": op6_decontamination,
        "op7_sharding": op7_sharding,
        "op8_ngram_join": op8_ngram_join,
        "op9_url_filters": op9_url_filters,
        "op10_sentencepiece": op10_sentencepiece,
        "op11_whitening": op11_whitening,
        "op12_chunk_bpe": op12_chunk_bpe,
        "op13_phrases": op13_phrases,
    }
