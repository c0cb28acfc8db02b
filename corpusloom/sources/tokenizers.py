"""A tokenizer as two tables, kept as Parquet."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from corpusloom.functions.text import check_kind

VOCAB_SCHEMA = "token string, id int, is_special boolean"
MERGES_SCHEMA = "rank int, left string, right string, new_token string"


@dataclass(frozen=True)
class Tokenizer:
    """``vocab(token, id, is_special)`` and ``merges(rank, left, right, new_token)``."""

    kind: str
    vocab: DataFrame
    merges: DataFrame

    def __post_init__(self) -> None:
        check_kind(self.kind)


def tokenizer_name(vocab_size: int, kind: str, suffix: str) -> str:
    """Name of a stored tokenizer: ``vb-{vocab size}-{kind}-{suffix}``."""
    return f"vb-{vocab_size}-{kind}-{suffix}"


def save_tokenizer(tokenizer: Tokenizer, path: str, mode: str = "error") -> None:
    tokenizer.vocab.write.mode(mode).parquet(f"{path}/vocab")
    tokenizer.merges.write.mode(mode).parquet(f"{path}/merges")
    kind = tokenizer.vocab.sparkSession.createDataFrame([(tokenizer.kind,)], "kind string")
    kind.write.mode(mode).parquet(f"{path}/kind")


def load_tokenizer(spark: SparkSession, path: str) -> Tokenizer:
    kind = spark.read.schema("kind string").parquet(f"{path}/kind").first()
    if kind is None:
        raise ValueError(f"no tokenizer at {path}")
    return Tokenizer(
        kind["kind"],
        spark.read.schema(VOCAB_SCHEMA).parquet(f"{path}/vocab"),
        spark.read.schema(MERGES_SCHEMA).parquet(f"{path}/merges"),
    )
