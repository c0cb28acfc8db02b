"""Split, filter, cap and sample a table of texts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.functions.ordering import as_keys, order_hash
from corpusloom.operators.ranking import order_position, quota_cutoffs

TRAIN = "train"
VALIDATION = "validation"
SPLITS = (TRAIN, VALIDATION)

# Defaults of split and length filter, and the customary caps, for callers that want them.
SEED = 123
VALIDATION_SIZE = 0.2
MAX_TEXT_LENGTH = 1500
MAX_ROWS = {TRAIN: 100_000, VALIDATION: 20_000}


def split_train_validation(
    df: DataFrame,
    key: str | Sequence[str],
    validation_size: float = VALIDATION_SIZE,
    seed: object = SEED,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Add ``split``; validation gets exactly ``ceil(rows * validation_size)`` rows.

    The rows themselves are not shuffled: the cutoff comes from the keys alone, read
    from ``counted`` if a narrower table with the same keys is at hand.
    """
    cutoffs = quota_cutoffs(
        df if counted is None else counted,
        key,
        [seed],
        lambda rows: F.ceil(rows * F.lit(float(validation_size))),
    )
    is_validation = order_position(key, [seed]) <= cutoffs.scalar()
    return df.withColumn("split", F.when(is_validation, VALIDATION).otherwise(TRAIN))


def split_added(
    df: DataFrame,
    key: str | Sequence[str],
    rows_before: int,
    validation_before: int,
    validation_size: float = VALIDATION_SIZE,
    seed: object = SEED,
) -> DataFrame:
    """Cutoff of the rows that are added to a split corpus: one row, or none if all of them go to train.

    Earlier rows stay where they are; of the new ones, as many as are missing go to validation, so that of all rows
    exactly ``ceil(rows * validation_size)`` are there again.
    """

    def missing(rows: Column) -> Column:
        wanted = F.ceil((rows + F.lit(rows_before)) * F.lit(float(validation_size))) - F.lit(validation_before)
        return F.least(rows, F.greatest(wanted, F.lit(0)))

    return quota_cutoffs(df, key, [seed], missing)


def filter_length(
    df: DataFrame, max_length: int = MAX_TEXT_LENGTH, text_column: str = "text"
) -> DataFrame:
    """Keep texts of fewer than ``max_length`` characters; a null text is dropped."""
    return df.where(F.length(text_column) < max_length)


def cap_splits(
    df: DataFrame,
    key: str | Sequence[str],
    caps: Mapping[str, int],
    seed: object = SEED,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Keep the first rows of each split in shuffled order, up to its cap; splits without one, null too, stay whole.

    Keys and splits are counted in ``counted`` if a narrower table is at hand.
    """
    cap = F.create_map(*[F.lit(v) for pair in caps.items() for v in pair])
    named = (df if counted is None else counted).where(F.col("split").isin(*caps))
    cutoffs = quota_cutoffs(
        named.withColumn("_cap", cap[F.col("split")]),
        key,
        [seed],
        lambda rows: F.least(F.col("_cap").cast("long"), rows),
        by=["split", "_cap"],
    ).drop("_cap")
    # At most one row for each named split.
    placed = df.join(F.broadcast(cutoffs), "split", "left")
    keep = ~F.coalesce(F.col("split").isin(*caps), F.lit(False)) | (order_position(key, [seed]) <= F.col("cutoff"))
    return placed.where(keep).drop("cutoff").select(*df.columns)


def quick_sample(
    df: DataFrame,
    key: str | Sequence[str],
    sizes: Mapping[str, int] | None = None,
    seed: object = SEED,
) -> DataFrame:
    """The first few rows of each split in shuffled order.

    Keys are chosen first; only the texts of these few rows are read.
    """
    sizes = {TRAIN: 10, VALIDATION: 2} if sizes is None else sizes
    narrow = df.select("split", *as_keys(key))
    chosen = [_first_rows(narrow.where(F.col("split") == split), key, seed, size) for split, size in sizes.items()]
    return _rows_of(df, reduce(DataFrame.unionByName, chosen), ["split", *as_keys(key)])


def _first_rows(keys: DataFrame, key: str | Sequence[str], seed: object, size: int) -> DataFrame:
    return keys.orderBy(order_hash(key, seed), *as_keys(key)).limit(size)


def _rows_of(df: DataFrame, chosen: DataFrame, columns: list[str]) -> DataFrame:
    """The rows with one of the few ``chosen`` keys; a null in a key matches a null."""
    chosen = chosen.withColumnsRenamed({c: f"_{c}" for c in columns})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns])
    # No more rows than were asked for.
    return df.join(F.broadcast(chosen), same, "left_semi")


def random_example(df: DataFrame, key: str | Sequence[str], seed: object = SEED) -> DataFrame:
    """One row, picked by the seed; only its text is read."""
    keys = as_keys(key)
    return _rows_of(df, _first_rows(df.select(*keys), key, seed, 1), keys)


def combine_splits(parts: Mapping[str, DataFrame]) -> DataFrame:
    """One table from one DataFrame per split; duplicates stay."""
    tagged = [df.withColumn("split", F.lit(name)) for name, df in parts.items()]
    whole = tagged[0]
    for part in tagged[1:]:
        whole = whole.unionByName(part)
    return whole
