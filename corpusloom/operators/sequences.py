"""Model-ready sequences and padded batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from corpusloom.functions.ordering import as_keys
from corpusloom.functions.sequences import (
    all_but_first,
    all_but_last,
    append_eot,
    pad_input,
    pad_output,
)
from corpusloom.operators.ranking import join_null_safe, with_rank
from corpusloom.operators.splits import SEED

# Fixed value: rows in a batch by default.
BATCH_SIZE = 128


def model_sequences(df: DataFrame, eot_id: int = 2) -> DataFrame:
    """Add ``ids`` (``raw_ids`` and the end mark), ``input_ids`` and ``output_ids``."""
    return (
        df.withColumn("ids", append_eot(F.col("raw_ids"), eot_id))
        .withColumn("input_ids", all_but_last(F.col("ids")))
        .withColumn("output_ids", all_but_first(F.col("ids")))
    )


def select_model_columns(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    return df.select("split", *as_keys(key), "input_ids", "output_ids")


def padded_batches(
    df: DataFrame,
    key: str | Sequence[str],
    batch_size: int = BATCH_SIZE,
    epoch: int = 0,
    seed: object = SEED,
    eot_id: int = 2,
) -> DataFrame:
    """Rows ``(split, batch_id, *key, x, y)``, shuffled anew for each epoch.

    All arrays of a batch are as long as its longest input. Sequences cross the
    network once, for their rank. A batch that lies in one bucket finds its width
    there; the widths of the few that cross a bucket's edge are looked up.
    """
    keys = as_keys(key)
    order = dict(key=key, seeds=[seed, epoch], by=["split"])
    batch = F.floor((F.col("rank") - 1) / batch_size)

    lengths = df.select("split", *keys, F.size("input_ids").alias("_length"))
    crossing = (
        with_rank(lengths, **order)
        .groupBy("split", batch.alias("batch_id"))
        .agg(
            F.max("_length").alias("_whole_width"),
            F.min("_bucket").alias("_from"),
            F.max("_bucket").alias("_to"),
        )
        .where(F.col("_from") != F.col("_to"))
        .select("split", "batch_id", "_whole_width")
    )
    in_bucket = Window.partitionBy("split", "_bucket", "batch_id")
    ranked = (
        with_rank(select_model_columns(df, key), **order)
        .withColumn("batch_id", batch)
        .withColumn("_width", F.max(F.size("input_ids")).over(in_bucket))
    )
    # Fewer rows than buckets, for each split.
    ranked = join_null_safe(ranked, F.broadcast(crossing), ["split", "batch_id"], "left")
    width = F.coalesce(F.col("_whole_width"), F.col("_width"))
    return ranked.select(
        "split",
        "batch_id",
        *keys,
        pad_input(F.col("input_ids"), width, eot_id).alias("x"),
        pad_output(F.col("output_ids"), width).alias("y"),
    )
