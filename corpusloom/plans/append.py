"""A processed dataset that grows: only new texts are tokenized, and no row changes sides."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.functions.ordering import as_keys
from corpusloom.operators.ranking import order_position
from corpusloom.operators.splits import SEED, TRAIN, VALIDATION, VALIDATION_SIZE, split_added
from corpusloom.plans.build import tokenize_corpus
from corpusloom.shared import temporary_tables, through_table
from corpusloom.sources.tokenizers import Tokenizer


def history(spark: SparkSession, path: str) -> DataFrame | None:
    """One row for each finished addition, with its rows and its cutoff; none if there is no dataset yet."""
    try:
        return spark.read.parquet(f"{path}/history")
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_appended(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all finished additions, with ``added`` (1, 2, ...) and ``split``; what a broken one left is not read."""
    done = history(spark, path)
    if done is None:
        raise ValueError(f"no dataset at {path}")
    # One folder for each addition.
    folders = [f"{path}/rows/added={r.added}" for r in done.select("added").collect()]
    return spark.read.option("basePath", f"{path}/rows").parquet(*folders)


def append_dataset(
    texts: DataFrame,
    tokenizer: Tokenizer,
    key: str | Sequence[str],
    path: str,
    text_column: str = "text",
    on_unknown: str | None = None,
    validation_size: float = VALIDATION_SIZE,
    seed: object = SEED,
) -> int:
    """Add the texts whose key the dataset at ``path`` does not hold; returns how many.

    The first call makes the dataset, with the split of ``split_train_validation``. Afterwards validation grows to
    ``ceil(rows * validation_size)`` of all rows out of the new ones alone. An addition counts once its line in the
    history is written; one that broke off before is written again by the next call. One call at a time.
    """
    spark, keys = texts.sparkSession, as_keys(key)
    clash = sorted({"added", "split"} & set(texts.columns))
    if clash:
        raise ValueError(f"columns {', '.join(clash)} are named as those of the dataset")
    done = history(spark, path)
    rows_before = validation_before = number = 0
    fresh = texts
    if done is not None:
        rows_before, validation_before, number = done.agg(F.sum("n_rows"), F.sum("n_validation"), F.max("added")).first()
        held = read_appended(spark, path).select(*[F.col(k).alias(f"_held_{k}") for k in keys])
        same = [F.col(k).eqNullSafe(F.col(f"_held_{k}")) for k in keys]
        fresh = texts.join(held, same, "left_anti")
    number += 1
    with temporary_tables(spark):
        new_keys = through_table(fresh.select(*keys), "new-keys")
        n_rows = new_keys.count()
        if n_rows == 0:
            return 0
        cutoff = through_table(split_added(new_keys, key, rows_before, validation_before, validation_size, seed), "cutoff")
        is_validation = F.coalesce(order_position(key, [seed]) <= cutoff.scalar(), F.lit(False))
        placed = fresh.withColumn("split", F.when(is_validation, VALIDATION).otherwise(TRAIN))
        done_rows = f"{path}/rows/added={number}"
        tokenize_corpus(placed, tokenizer, text_column, on_unknown).write.mode("overwrite").partitionBy("split").parquet(done_rows)
        n_validation = new_keys.agg(F.count_if(order_position(key, [seed]) <= cutoff.scalar())).first()[0]
        line = spark.range(1).select(
            F.lit(n_rows).cast("long").alias("n_rows"),
            F.lit(n_validation).cast("long").alias("n_validation"),
            cutoff.scalar().alias("cutoff"),
        )
        line.coalesce(1).write.mode("overwrite").parquet(f"{path}/history/added={number}")
    return n_rows
