"""Clean a corpus and turn it into token ids: each stage works on all that the one before it kept.

Rows are told apart by id and text together, so null and repeated ids do no harm; columns beyond
those of ``documents`` are carried along, and an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusloom.llm.decontaminate import contamination
from corpusloom.llm.exact_dedup import exact_duplicates
from corpusloom.llm.language_id import held_out, recognised, train_language_model
from corpusloom.llm.ngram_join import jaccard_components
from corpusloom.llm.pieces import encode_pieces
from corpusloom.llm.tables import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Below this share for the best language, a text is taken to be in none of those learned.
MIN_LANGUAGE_SCORE = 0.35
MODEL = "piece_bpe_32k.model"

_ROW = "__corpus_row"


def _row_key() -> Column:
    """Ids in order of size, null ones last, then the text."""
    doc_id = F.coalesce(F.lpad(F.col("doc_id").cast("string"), 20, "0"), F.lit("~"))
    return F.concat_ws("-", doc_id, F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))


def _keyed(docs: DataFrame) -> DataFrame:
    """Row keys and texts, all that an operator reads."""
    return docs.select(_row_key().alias(_ROW), "text")


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows whose keys are not in ``gone``."""
    return docs.withColumn(_ROW, _row_key()).join(gone.select(_ROW), _ROW, "left_anti")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have a language with some certainty; others, and those without a letter, go."""
    model = train_language_model(docs.where(~held_out(F.col("doc_id"))))
    if not model.languages:
        return docs.where(F.coalesce(F.col("text"), F.lit("")).rlike(r"\p{L}"))
    return docs.where(recognised(F.col("text"), model, MIN_LANGUAGE_SCORE))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the smallest id stays."""
    found = stored(exact_duplicates(_keyed(docs), _ROW), "duplicates")
    gone = found.where(F.col(_ROW) != F.col("keep_id")).distinct()
    return _without(docs, gone).dropDuplicates([_ROW]).drop(_ROW)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by their word shingles, the one with the smallest id stays."""
    found = stored(jaccard_components(_keyed(docs), _ROW), "components")
    gone = found.where(F.col(_ROW) != F.col("component_id")).distinct()
    return _without(docs, gone).dropDuplicates([_ROW]).drop(_ROW)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with passages of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    gone = stored(contamination(_keyed(docs), benchmark, _ROW).where("contaminated"), "contaminated")
    return _without(docs, gone.distinct()).drop(_ROW)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's id with its token ids."""
    return encode_pieces(docs, public_tokenizers.path(MODEL))


STAGES: list[tuple[str, Stage]] = [
    ("language ID", language_id),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", ngram_join),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding", sentencepiece),
]

# Language identification and the tokenizer are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES, start=1):
        docs = stored(stage(spark, docs, sf_dir), f"stage-{number}")
    return docs
