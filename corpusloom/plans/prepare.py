"""Split, filter and cap a corpus."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from corpusloom.functions.ordering import as_keys
from corpusloom.operators.splits import (
    SEED,
    VALIDATION_SIZE,
    cap_splits,
    filter_length,
    split_train_validation,
)
from corpusloom.shared import through_table


def prepare_corpus(
    df: DataFrame,
    key: str | Sequence[str],
    text_column: str = "text",
    validation_size: float = VALIDATION_SIZE,
    max_length: int | None = None,
    caps: Mapping[str, int] | None = None,
    seed: object = SEED,
) -> DataFrame:
    """All columns of the chosen rows, and ``split``. Without ``max_length`` and ``caps``, of all rows.

    The split counts every row, so it comes before the filter, which also drops null texts; the caps
    come last. Cutoffs are worked out on keys and lengths, so the texts themselves are never shuffled.
    """
    lengths = df.select(*as_keys(key), F.length(text_column).alias("_length"))
    lengths = through_table(lengths, "lengths")
    texts = split_train_validation(df, key, validation_size, seed, counted=lengths)
    if max_length is not None:
        texts = filter_length(texts, max_length, text_column)
    if caps is None:
        return texts
    counted = split_train_validation(lengths, key, validation_size, seed)
    if max_length is not None:
        counted = counted.where(F.col("_length") < max_length)
    return cap_splits(texts, key, caps, seed, counted=counted)
