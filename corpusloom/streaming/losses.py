"""Running and epoch means over a loss log that keeps arriving."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from corpusloom.operators.splits import TRAIN, VALIDATION

EPOCH = ("run", "epoch", "split")
_STATE = "n long, total double, last long"


def running_loss_stream(log: DataFrame) -> DataFrame:
    """Rows of the log with ``avg_so_far`` and ``late``, in append mode; three numbers are kept for each epoch and split.

    Rows that arrive together are taken by batch number. One whose number is not above all numbers counted before has come
    late or again: it is given out with ``late`` true and a null mean, and changes nothing; so is one without a number. Of equal
    numbers that arrive together the least loss counts. A null loss counts for nothing, but its number does. Null runs, epochs and
    splits are values like others. If no row is late, the means are those of ``running_loss``.
    """
    given = T.StructType([log.schema[c] for c in (*EPOCH, "batch_num", "loss")])
    result = T.StructType([*given, T.StructField("avg_so_far", T.DoubleType()), T.StructField("late", T.BooleanType())])
    kinds = {f.name: f.dataType for f in given}

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, total, last = state.get if state.exists else (0, 0.0, None)
        # The rows of one epoch that arrived together.
        rows = pd.concat([p[["batch_num", "loss"]] for p in parts]).sort_values(["batch_num", "loss"], na_position="last", ignore_index=True)
        numbers = rows["batch_num"]
        late = (numbers.isna() | numbers.duplicated()).to_numpy()
        if last is not None:
            late |= (numbers <= last).fillna(False).to_numpy(bool)
        losses = rows["loss"].to_numpy("float64", na_value=np.nan)
        counts = ~late & ~np.isnan(losses)
        sums = total + np.cumsum(np.where(counts, losses, 0.0))
        seen = n + np.cumsum(counts)
        means = np.where(late | (seen == 0), np.nan, sums / np.maximum(seen, 1))
        if not late.all():
            state.update((int(seen[-1]), float(sums[-1]), int(numbers[~late].max())))
        for name, value in zip(EPOCH, key, strict=True):
            rows[name] = value
        rows["avg_so_far"], rows["late"] = pd.Series(means).astype(object).where(~np.isnan(means), None), late
        whole = [f.name for f in given if isinstance(f.dataType, T.IntegralType)]
        rows = rows.astype({c: "Int64" for c in whole})
        yield rows[result.names]

    if not isinstance(kinds["batch_num"], T.IntegralType):
        raise ValueError("batch_num is a whole number")
    return log.select(*given.names).groupBy(*EPOCH).applyInPandasWithState(
        step, result, T.StructType.fromDDL(_STATE), "append", GroupStateTimeout.NoTimeout
    )


def epoch_losses_stream(log: DataFrame) -> DataFrame:
    """Mean losses by run and epoch so far, for update or complete mode; on a table at rest they equal ``epoch_losses``."""
    means = [F.avg(F.when(F.col("split") == split, F.col("loss"))) for split in (TRAIN, VALIDATION)]
    found = log.groupBy("run", "epoch").agg(means[0].alias("train_loss"), means[1].alias("val_loss"))
    return found.withColumn("val_train_difference", F.col("val_loss") - F.col("train_loss"))
