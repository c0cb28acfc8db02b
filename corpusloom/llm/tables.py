"""Helpers shared by the operators: intermediate tables, joins with hot keys, exact copies of rows."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.shared import through_table

# A key is hot if it has at least one in so many rows: at most this many keys can be.
HOT_SHARE = 1_024
# Short rows that are broadcast at most; beyond, the same join shuffles.
BROADCAST_ROWS = 1_000_000


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back, so lost executors cost one stage."""
    return through_table(df, name)


def input_columns(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, as ``alias=name``: other columns, whatever their names, stay out."""
    return df.select(*[F.col(f"`{name}`").alias(alias) for alias, name in columns.items()])


def blocks(batch: pd.DataFrame, column: str, size: int = 1 << 22) -> Iterator[pd.DataFrame]:
    """A batch in parts whose texts have about ``size`` characters together, or one long text."""
    ahead = batch[column].str.len().fillna(0).cumsum()
    for _, part in batch.groupby((ahead // size).to_numpy(), sort=True):
        yield part


def released(run: Callable[[Iterator], Iterator], forget: Callable[[], None] | None = None) -> Callable[[Iterator], Iterator]:
    """``run`` over the batches of a task, then give memory back: workers stay, and so would what their allocators hold.

    ``forget`` drops what the worker remembers.
    """

    def whole(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            if forget is not None:
                forget()
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):  # not this C library
                pass

    return whole


def with_copies(df: DataFrame, columns: Sequence[str], *carried: str) -> DataFrame:
    """One row for each distinct ``columns``, with ``copies``; summed up before the shuffle.

    ``carried`` are functions of ``columns``.
    """
    kept = [F.first(c).alias(c) for c in carried]
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies"), *kept)


def repeated(df: DataFrame) -> DataFrame:
    """As many rows as ``copies`` says, numbered from 1 in ``copy``."""
    numbers = F.sequence(F.lit(1), F.col("copies").cast("int"))
    return df.withColumn("copy", F.explode(numbers)).drop("copies")


def join_hot(rows: DataFrame, table: DataFrame, keys: Sequence[str], size: str, how: str = "inner") -> DataFrame:
    """Join ``rows`` with a stored ``table`` that has each of ``keys`` once.

    Column ``size`` of the table counts the rows of a key. Keys with more than one in
    ``HOT_SHARE`` of all rows, of which there can be no more than ``HOT_SHARE``, are
    broadcast; all others have few rows each and are joined by a shuffle.
    """
    total = table.agg(F.sum(size)).first()[0] or 0
    hot = F.col(size) * HOT_SHARE > total
    hot_keys = [tuple(r) for r in table.where(hot).select(*keys).collect()]
    if not hot_keys:
        return rows.join(table, list(keys), how)
    first = keys[0]
    is_hot = F.coalesce(F.col(first).isin([k[0] for k in hot_keys]), F.lit(False))
    table_hot = table.where(F.col(first).isin([k[0] for k in hot_keys]))
    # Rows that share only their first key with a hot one still find all of theirs.
    n_hot = table_hot.count()
    if n_hot > 64 * HOT_SHARE:
        return rows.join(table, list(keys), how)
    return rows.where(is_hot).join(F.broadcast(table_hot), list(keys), how).unionByName(
        rows.where(~is_hot).join(table.where(~is_hot), list(keys), how)
    )


def small_broadcast(table: DataFrame, weight: Column | int = 1) -> DataFrame:
    """A stored table, marked for broadcast only if its rows weigh no more than ``BROADCAST_ROWS`` in all."""
    total = table.agg(F.sum(weight if isinstance(weight, Column) else F.lit(weight))).first()[0] or 0
    return F.broadcast(table) if total <= BROADCAST_ROWS else table


def left_null_safe(rows: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join in which null keys match each other."""
    other = table.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return rows.join(other, same, "left").drop(*[f"_{k}" for k in keys])


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, everything else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
