"""Train a tokenizer on a corpus and evaluate it on both splits."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from corpusloom.functions.ordering import as_keys
from corpusloom.functions.text import CHAR_BPE
from corpusloom.operators.bpe import train_bpe
from corpusloom.operators.decode import vocabulary_size
from corpusloom.operators.encode import with_ids
from corpusloom.operators.splits import TRAIN
from corpusloom.operators.stats import evaluate_tokenizer
from corpusloom.plans.prepare import prepare_corpus
from corpusloom.shared import temporary_tables, through_table
from corpusloom.sources.tokenizers import Tokenizer, save_tokenizer, tokenizer_name


@dataclass(frozen=True)
class TrainedTokenizer:
    tokenizer: Tokenizer
    metrics: DataFrame
    path: str


def train_on_corpus(
    df: DataFrame,
    key: str | Sequence[str],
    folder: str,
    suffix: str,
    kind: str = CHAR_BPE,
    vocab_size: int | None = None,
    min_frequency: int | None = 2,
    text_column: str = "text",
    on_unknown: str | None = None,
    **preparation: object,
) -> TrainedTokenizer:
    """Prepare, train on the train split, store under a versioned name, evaluate.

    The metrics, one row for each split, are worked out at once, so that no intermediate table stays.
    """
    spark = df.sparkSession
    with temporary_tables(spark):
        corpus = df.select(*as_keys(key), text_column)
        corpus = through_table(prepare_corpus(corpus, key, text_column, **preparation), "corpus")
        train = corpus.where(F.col("split") == TRAIN)
        tokenizer = train_bpe(train, kind, vocab_size, min_frequency, text_column=text_column)
        path = f"{folder}/{tokenizer_name(vocabulary_size(tokenizer), kind, suffix)}"
        save_tokenizer(tokenizer, path)
        metrics = evaluate_tokenizer(with_ids(corpus, tokenizer, text_column, on_unknown), text_column)
        metrics = spark.createDataFrame(metrics.collect(), metrics.schema)
    return TrainedTokenizer(tokenizer, metrics, path)
