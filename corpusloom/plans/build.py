"""Turn a corpus into a model-ready dataset, and feed it in batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from corpusloom.operators.decode import eot_id, vocabulary_size
from corpusloom.operators.encode import with_ids
from corpusloom.operators.sequences import model_sequences
from corpusloom.plans.prepare import prepare_corpus
from corpusloom.shared import temporary_tables
from corpusloom.sources.texts import dataset_name, require_splits, write_dataset
from corpusloom.sources.tokenizers import Tokenizer


def tokenize_corpus(
    df: DataFrame,
    tokenizer: Tokenizer,
    text_column: str = "text",
    on_unknown: str | None = None,
) -> DataFrame:
    """All columns, and ``raw_ids``, ``ids``, ``input_ids``, ``output_ids``. ``df`` may be a stream."""
    return model_sequences(with_ids(df, tokenizer, text_column, on_unknown), eot_id(tokenizer).first()[0])


def model_ready(
    df: DataFrame,
    tokenizer: Tokenizer,
    key: str | Sequence[str],
    text_column: str = "text",
    on_unknown: str | None = None,
    **preparation: object,
) -> DataFrame:
    """Split and tokenize a corpus; filter and cap it first where ``preparation`` asks for it."""
    corpus = prepare_corpus(df, key, text_column, **preparation)
    return tokenize_corpus(require_splits(corpus), tokenizer, text_column, on_unknown)


def build_dataset(
    df: DataFrame,
    tokenizer: Tokenizer,
    key: str | Sequence[str],
    folder: str,
    name: str,
    version: str = "v1",
    **options: object,
) -> str:
    """Write the model-ready dataset under a versioned name; returns its path."""
    path = f"{folder}/{dataset_name(name, version, vocabulary_size(tokenizer))}"
    with temporary_tables(df.sparkSession):
        write_dataset(model_ready(df, tokenizer, key, **options), path)
    return path
