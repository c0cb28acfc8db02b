"""Exact ranks and quotas in the shuffled order, without a one-task sort.

The hash that orders the rows also splits them into buckets. Counts per bucket
(at most 65,536 for each group) give every bucket its offset, so only rows of
one bucket are ever sorted together.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusloom.functions.ordering import as_keys, order_bucket, order_hash


def join_null_safe(rows: DataFrame, table: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join in which a null key is a key like any other; the columns of ``rows`` stay as they are."""
    other = table.select(*[F.col(c).alias(f"_of_{c}") if c in keys else F.col(c) for c in table.columns])
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    return rows.join(other, same, how).drop(*[f"_of_{k}" for k in keys])


def _with_order(df: DataFrame, key: str | Sequence[str], seeds: Sequence[object]) -> DataFrame:
    hashed = df.withColumn("_hash", order_hash(key, *seeds))
    return hashed.withColumn("_bucket", order_bucket(F.col("_hash")))


def _bucket_offsets(ordered: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of the group before each bucket, and rows of the whole group.

    The windows run over bucket counts, whose number is fixed, not over rows.
    """
    group = Window.partitionBy(*by)
    before = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = ordered.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    return counts.select(
        *by,
        "_bucket",
        "_rows",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"),
        F.sum("_rows").over(group).alias("_total"),
    )


def with_rank(
    df: DataFrame,
    key: str | Sequence[str],
    seeds: Sequence[object],
    by: Sequence[str] = (),
) -> DataFrame:
    """Add ``rank`` (1, 2, ...) within each group, and the ``_bucket`` it comes from.

    Rows are shuffled once, by group and bucket. ``by`` names a few groups, such as splits: of each, 65,536
    offsets are broadcast. Rows with null in ``by`` are a group of their own.
    """
    keys = as_keys(key)
    narrow = _with_order(df.select(*by, *keys), key, seeds)
    # At most 65,536 rows for each group.
    offsets = _bucket_offsets(narrow, by).select(*by, "_bucket", "_offset")
    inside = Window.partitionBy(*by, "_bucket").orderBy("_hash", *keys)
    return (
        join_null_safe(_with_order(df, key, seeds), F.broadcast(offsets), [*by, "_bucket"])
        .withColumn("rank", F.col("_offset") + F.row_number().over(inside))
        .drop("_offset", "_hash")
    )


def quota_cutoffs(
    df: DataFrame,
    key: str | Sequence[str],
    seeds: Sequence[object],
    quota: Callable[[Column], Column],
    by: Sequence[str] = (),
) -> DataFrame:
    """Where each group's quota ends: one row ``(*by, cutoff)`` per group.

    ``quota`` maps the group's row count to the number of rows to take. A group
    with a quota of zero has no row. Only the bucket the quota ends in is sorted. ``by`` names a few
    groups, of each of which a row is broadcast.
    """
    keys = as_keys(key)
    ordered = _with_order(df.select(*by, *keys), key, seeds)
    need = quota(F.col("_total")) - F.col("_offset")
    last = (
        _bucket_offsets(ordered, by)
        .withColumn("_need", need)
        .where((F.col("_need") > 0) & (F.col("_need") <= F.col("_rows")))
        .select(*by, "_bucket", "_need")
    )
    inside = Window.partitionBy(*by, "_bucket").orderBy("_hash", *keys)
    return (
        # One row for each group.
        join_null_safe(ordered, F.broadcast(last), [*by, "_bucket"])
        .withColumn("_row", F.row_number().over(inside))
        .where(F.col("_row") == F.col("_need"))
        .select(*by, F.struct("_hash", *keys).alias("cutoff"))
    )


def order_position(key: str | Sequence[str], seeds: Sequence[object]) -> Column:
    """A row's place in the shuffled order, to compare with a cutoff."""
    return F.struct(order_hash(key, *seeds).alias("_hash"), *as_keys(key))
