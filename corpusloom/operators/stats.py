"""Counts and averages over splits."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from corpusloom.operators.splits import MAX_TEXT_LENGTH, TRAIN

# Fixed value: training tokens for each model parameter.
TOKENS_PER_PARAMETER = 20


def split_counts(
    df: DataFrame,
    max_length: int = MAX_TEXT_LENGTH,
    text_column: str = "text",
    caps: Mapping[str, int] | None = None,
) -> DataFrame:
    """Rows of each split: all, with a null text, after the length filter, and after caps if given."""
    counts = df.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(text_column).isNull()).alias("n_null"),
        F.count_if(F.length(text_column) < max_length).alias("n_kept"),
    )
    if caps is None:
        return counts
    capped = F.col("n_kept")
    for split, cap in caps.items():
        capped = F.when(F.col("split") == split, F.least("n_kept", F.lit(cap))).otherwise(capped)
    return counts.withColumn("n_capped", capped.cast("long"))


def corpus_characters(df: DataFrame, text_column: str = "text") -> DataFrame:
    """Characters of all texts joined by line ends."""
    length = F.coalesce(F.sum(F.length(text_column).cast("long")), F.lit(0))
    joins = F.greatest(F.count(text_column) - 1, F.lit(0))
    return df.agg((length + joins).alias("n_chars"))


def token_budget(df: DataFrame, epochs: int = 1) -> DataFrame:
    """Tokens of the train split over all epochs, and the parameters they suggest."""
    total = F.coalesce(F.sum(F.size("ids").cast("long")), F.lit(0))
    return (
        df.where(F.col("split") == TRAIN)
        .agg(total.alias("total_tokens"))
        .withColumn("budget_tokens", F.col("total_tokens") * epochs)
        .withColumn("budget_millions", F.col("budget_tokens") / 1e6)
        .withColumn(
            "parameters_millions", F.col("budget_tokens") / (TOKENS_PER_PARAMETER * 1e6)
        )
    )


def token_length_range(df: DataFrame) -> DataFrame:
    """Longest and shortest ``ids`` of the train split."""
    return df.where(F.col("split") == TRAIN).agg(
        F.max(F.size("ids")).cast("long").alias("max_tokens"),
        F.min(F.size("ids")).cast("long").alias("min_tokens"),
    )


def batch_counts(df: DataFrame, batch_size: int) -> DataFrame:
    """Batches of each split; the last one may be short."""
    batches = F.ceil(F.count(F.lit(1)) / batch_size)
    return df.groupBy("split").agg(batches.cast("long").alias("n_batches"))


def evaluate_tokenizer(df: DataFrame, text_column: str = "text") -> DataFrame:
    """Tokens and characters per text and characters per token, for each split.

    Tokens are ``raw_ids``, without the end mark.
    """
    tokens = F.sum(F.size("raw_ids").cast("long"))
    characters = F.sum(F.length(text_column).cast("long"))
    return (
        df.groupBy("split")
        .agg(tokens.alias("_t"), characters.alias("_c"), F.count(F.lit(1)).alias("_n"))
        .select(
            "split",
            (F.col("_t") / F.col("_n")).alias("avg_tokens_per_sentence"),
            (F.col("_c") / F.col("_n")).alias("avg_chars_per_sentence"),
            F.when(F.col("_t") > 0, F.col("_c") / F.col("_t"))
            .otherwise(F.lit(0.0))
            .alias("compression_ratio"),
        )
    )
