"""Tokenize a stream of texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from corpusloom.operators.splits import filter_length
from corpusloom.plans.build import tokenize_corpus
from corpusloom.sources.tokenizers import Tokenizer


def tokenize_stream(
    texts: DataFrame,
    tokenizer: Tokenizer,
    path: str,
    checkpoint: str,
    text_column: str = "text",
    max_length: int | None = None,
    on_unknown: str | None = None,
) -> StreamingQuery:
    """Write the model-ready rows of a stream to ``path``, each text once.

    Only texts shorter than ``max_length`` if it is given. The query ends when all texts at hand are done.
    """
    if max_length is not None:
        texts = filter_length(texts, max_length, text_column)
    return (
        tokenize_corpus(texts, tokenizer, text_column, on_unknown)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
