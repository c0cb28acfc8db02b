"""Epochs stored in their order, so that training can go on at any batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from corpusloom.functions.ordering import as_keys
from corpusloom.functions.sequences import pad_input, pad_output
from corpusloom.operators.ranking import with_rank
from corpusloom.operators.sequences import BATCH_SIZE, select_model_columns
from corpusloom.operators.splits import SEED

# Rows of one file: what is read for a single batch, at most twice.
ROWS_PER_FILE = 65_536


def store_epoch(
    df: DataFrame,
    key: str | Sequence[str],
    path: str,
    epoch: int = 0,
    seed: object = SEED,
    rows_per_file: int = ROWS_PER_FILE,
) -> None:
    """Write the sequences in the order of one epoch, and an index: which ranks of which split are in which file.

    The batch size is not fixed by it. Files are ranges of ranks, so a range of batches lies in few of them.
    """
    spark = df.sparkSession
    ranked = with_rank(select_model_columns(df, key), key, [seed, epoch], by=["split"]).drop("_bucket")
    files = max(1, -(-df.count() // rows_per_file))
    ordered = ranked.repartitionByRange(files, "split", "rank").sortWithinPartitions("split", "rank")
    ordered.write.option("maxRecordsPerFile", rows_per_file).parquet(f"{path}/rows")
    # Only split and rank are read.
    stored = spark.read.schema(ordered.schema).parquet(f"{path}/rows").select("split", "rank", F.col("_metadata.file_path").alias("file"))
    index = stored.groupBy("split", "file").agg(F.min("rank").alias("first_rank"), F.max("rank").alias("last_rank"))
    index.write.parquet(f"{path}/index")


def stored_batches(
    spark: SparkSession,
    path: str,
    key: str | Sequence[str],
    split: str | None,
    first: int = 0,
    last: int | None = None,
    batch_size: int = BATCH_SIZE,
    eot_id: int = 2,
) -> DataFrame:
    """Batches ``first`` to ``last`` (to the end if none is named), as ``padded_batches`` gives them for that epoch.

    Only files that hold a row of them are opened, and no row is ranked again. Batches beyond the end do not exist.
    """
    low, high = first * batch_size + 1, (1 << 62) if last is None else (last + 1) * batch_size
    overlaps = F.col("split").eqNullSafe(F.lit(split)) & (F.col("last_rank") >= low) & (F.col("first_rank") <= high)
    # The files of the batches asked for.
    files = [r.file for r in spark.read.parquet(f"{path}/index").where(overlaps).select("file").collect()]
    schema = spark.read.parquet(f"{path}/rows").schema
    rows = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    chosen = rows.where(F.col("split").eqNullSafe(F.lit(split)) & F.col("rank").between(low, high))
    batched = chosen.withColumn("batch_id", F.floor((F.col("rank") - 1) / batch_size))
    # A window of one batch.
    width = F.max(F.size("input_ids")).over(Window.partitionBy("batch_id"))
    return batched.withColumn("_width", width).select(
        "split",
        "batch_id",
        *as_keys(key),
        pad_input(F.col("input_ids"), F.col("_width"), eot_id).alias("x"),
        pad_output(F.col("output_ids"), F.col("_width")).alias("y"),
    )
