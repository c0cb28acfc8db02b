"""A loss log ``(run, epoch, split, batch_num, loss)``; epochs count from 1."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from corpusloom.operators.ranking import join_null_safe
from corpusloom.operators.splits import TRAIN, VALIDATION

# Consecutive batch numbers that are summed in one task.
CHUNK = 1_000_000
# Runs and splits of one log, at most.
MAX_RUNS = 1_000_000


def epoch_losses(log: DataFrame) -> DataFrame:
    """Mean of the batch losses for each run and epoch, and validation minus train.

    A short last batch weighs as much as a full one.
    """
    return (
        log.groupBy("run", "epoch")
        .pivot("split", [TRAIN, VALIDATION])
        .agg(F.avg("loss"))
        .select(
            "run",
            "epoch",
            F.col(TRAIN).alias("train_loss"),
            F.col(VALIDATION).alias("val_loss"),
            (F.col(VALIDATION) - F.col(TRAIN)).alias("val_train_difference"),
        )
    )


def running_loss(log: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Add ``avg_so_far``: the mean of the epoch's losses up to each batch.

    One epoch may be most of the log, so it is cut into chunks of batch numbers:
    sums of whole chunks first, then a running sum inside each chunk. A null run, epoch or split is a
    value like others; null batch numbers come first; a null loss counts for nothing.
    """
    epoch = ["run", "epoch", "split"]
    chunked = log.withColumn("_chunk", F.floor(F.col("batch_num") / chunk))
    earlier = Window.partitionBy(*epoch).orderBy("_chunk")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    before = (
        chunked.groupBy(*epoch, "_chunk")
        .agg(F.sum("loss").alias("_sum"), F.count("loss").alias("_n"))
        .select(
            *epoch,
            "_chunk",
            F.coalesce(F.sum("_sum").over(earlier), F.lit(0.0)).alias("_sum_before"),
            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n_before"),
        )
    )
    inside = Window.partitionBy(*epoch, "_chunk").orderBy("batch_num")
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.col("_sum_before") + F.coalesce(F.sum("loss").over(inside), F.lit(0.0))
    rows = F.col("_n_before") + F.count("loss").over(inside)
    return (
        join_null_safe(chunked, before, [*epoch, "_chunk"])
        .withColumn("avg_so_far", F.when(rows > 0, total / rows))
        .select(*log.columns, "avg_so_far")
    )


def with_global_step(log: DataFrame, batches: DataFrame) -> DataFrame:
    """Add ``step``: full epochs times batches per epoch, plus the batch number.

    ``batches`` has one row ``(run, split, n_batches)`` for each run and split; rows of a run and
    split without one keep a null step. A few runs hold the whole log, so ``batches`` is
    broadcast, and refused if it has more than ``MAX_RUNS`` rows.
    """
    if batches.count() > MAX_RUNS:
        raise ValueError(f"batches holds at most {MAX_RUNS} rows")
    step = (F.col("epoch") - 1) * F.col("n_batches") + F.col("batch_num")
    return log.join(F.broadcast(batches), ["run", "split"], "left").select(*log.columns, step.alias("step"))
