"""A seeded order of rows that does not depend on partitions or positions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Hex digits of the hash that name a bucket: 65,536 buckets.
BUCKET_DIGITS = 4


def as_keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def order_hash(key: str | Sequence[str], *seeds: object) -> Column:
    """``md5('seed|...|key|...')``; rows in this order are in shuffled order."""
    parts = [F.lit(str(s)) for s in seeds] + [F.col(k).cast("string") for k in as_keys(key)]
    return F.md5(F.concat_ws("|", *parts))


def order_bucket(hash_column: Column) -> Column:
    """Leading digits of the hash: buckets follow the order of the hash."""
    return F.substring(hash_column, 1, BUCKET_DIGITS)


def unit_interval(key: str | Sequence[str], *seeds: object) -> Column:
    """A number in [0, 1) from the first 13 hex digits of the hash."""
    digits = F.conv(F.substring(order_hash(key, *seeds), 1, 13), 16, 10).cast("double")
    return digits / F.lit(float(16**13))
