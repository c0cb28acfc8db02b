"""Shards of nearly equal size: minimax contiguous partition over ordered groups of equal texts."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusloom.llm.tables import input_columns, repeated, stored, with_copies

# Leading hex digits of a group's digest that name a cell; a cell is split by two more.
CELL_DIGITS = 4
SPLIT_DIGITS = 2
ROW_BYTES = 8
# Buckets of a shard for numbering its rows.
SLOT_BUCKETS = 4_096


@dataclass
class Cells:
    """Neighbouring groups in order: their common digits, total size and number of groups."""

    prefix: list[str]
    size: np.ndarray
    groups: np.ndarray

    @property
    def bounds(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.size)])


def walk(cells: Cells, capacity: int, n_shards: int) -> tuple[list[int], list[int]]:
    """Cut greedily at ``capacity``: for each cut the least and the greatest place it can have.

    Cells of one group are atomic. A cut inside a larger cell is known only to lie between
    the last bound before it and the capacity.
    """
    bounds, low, high = cells.bounds, [0], [0]
    for _ in range(n_shards):
        at = int(np.searchsorted(bounds, low[-1] + capacity, "right")) - 1
        low.append(max(low[-1], int(bounds[at])))
        at = int(np.searchsorted(bounds, high[-1] + capacity, "right")) - 1
        inside = at < len(cells.groups) and cells.groups[at] > 1
        high.append(high[-1] + capacity if inside else int(bounds[at]))
    return low, high


def capacity_range(cells: Cells, n_shards: int) -> tuple[int, int]:
    """By binary search: the largest capacity that surely fails, the least that surely does."""
    total = int(cells.bounds[-1])

    def least(passes) -> int:
        low, high = -1, total
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (low, middle) if passes(middle) else (middle, high)
        return high

    may = least(lambda c: walk(cells, c, n_shards)[1][-1] >= total)
    will = least(lambda c: walk(cells, c, n_shards)[0][-1] >= total)
    return may - 1, will


def cells_to_split(cells: Cells, fails: int, fits: int, n_shards: int) -> list[int]:
    """Cells of several groups in which a cut can lie at any capacity still in question."""
    bounds = cells.bounds
    low, high = walk(cells, fails, n_shards)[0], walk(cells, fits, n_shards)[1]
    chosen: set[int] = set()
    for a, b in zip(low[1:], high[1:], strict=True):
        first = max(int(np.searchsorted(bounds, a, "right")) - 1, 0)
        last = int(np.searchsorted(bounds, b, "left"))
        chosen.update(i for i in range(first, min(last + 1, len(cells.groups))) if cells.groups[i] > 1)
    return sorted(chosen)


def even_cuts(bounds: np.ndarray, capacity: int, n_shards: int) -> list[int]:
    """Indices of the bounds to cut at, none of the shards being over a feasible capacity.

    Cutting greedily leaves what is missing to the last shard. So each cut has a least place, from
    cutting greedily from the end, and a greatest, from the start; the one nearest to even shards is taken.
    """
    total = int(bounds[-1])
    least = [total] * (n_shards + 1)
    for k in range(n_shards - 1, 0, -1):
        least[k] = int(bounds[np.searchsorted(bounds, max(least[k + 1] - capacity, 0))])
    cuts, at, furthest = [], 0, 0
    for k in range(1, n_shards):
        furthest = int(bounds[np.searchsorted(bounds, furthest + capacity, "right") - 1])
        first = int(np.searchsorted(bounds, least[k]))
        last = int(np.searchsorted(bounds, min(furthest, at + capacity), "right")) - 1
        even = total * k / n_shards
        near = int(np.searchsorted(bounds, even))
        if near == len(bounds) or near > 0 and even - bounds[near - 1] < bounds[near] - even:
            near -= 1
        cuts.append(min(max(near, first), last))
        at = int(bounds[cuts[-1]])
    return cuts


def _cells(groups: DataFrame, digits: int) -> list[tuple[str, int, int]]:
    rows = groups.groupBy(F.substring("digest", 1, digits).alias("p")).agg(
        F.sum("size").alias("s"), F.count(F.lit(1)).alias("n")
    )
    return [(r.p, r.s, r.n) for r in rows.collect()]


def minimax_cuts(groups: DataFrame, n_shards: int) -> list[str]:
    """Where shards after the first begin, as leading digits, at the smallest feasible capacity.

    ``groups`` has ``digest``, which orders them, and ``size``. The driver holds sums over cells: at
    most 65,536, and 256 more for each cell that can hold a cut, of which only those are split
    again until the smallest capacity is certain.
    """
    found = _cells(groups, CELL_DIGITS)
    while True:
        found.sort()
        cells = Cells([c[0] for c in found], np.array([c[1] for c in found], "int64"), np.array([c[2] for c in found], "int64"))
        fails, fits = capacity_range(cells, n_shards)
        if fails + 1 >= fits or not (split := cells_to_split(cells, fails, fits, n_shards)):
            break
        gone = {cells.prefix[i] for i in split}
        found = [c for c in found if c[0] not in gone]
        for digits in sorted({len(p) for p in gone}):
            inside = F.substring("digest", 1, digits).isin([p for p in gone if len(p) == digits])
            found += _cells(groups.where(inside), digits + SPLIT_DIGITS)
    return [cells.prefix[i] for i in even_cuts(cells.bounds, fits, n_shards) if i < len(cells.prefix)]


def _shard(digest: Column, cuts: list[str]) -> Column:
    shard = F.lit(0)
    for cut in cuts:
        shard = shard + (digest >= cut).cast("int")
    return shard


def _slots(rows: DataFrame, n_shards: int) -> DataFrame:
    """Number the rows of each shard from 0: counts by bucket, then inside the bucket."""
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("id", "digest"), F.lit(SLOT_BUCKETS)))
    ahead = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("shard", "bucket").agg(F.sum("copies").alias("n"))
    counts = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    # At most n_shards * SLOT_BUCKETS rows, whatever the input.
    rows = rows.join(F.broadcast(counts), ["shard", "bucket"])
    inside = Window.partitionBy("shard", "bucket").orderBy("id", "digest").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("ahead", F.col("ahead") + F.coalesce(F.sum("copies").over(inside), F.lit(0)))


def shard_rows(docs: DataFrame, n_shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Put all rows into ``n_shards`` shards whose largest is as small as it can be.

    Equal texts are one group, which is never cut. Groups are ordered by the SHA-256 of the
    text; each shard takes neighbouring groups. The size of a row is its UTF-8 bytes plus 8. Binary
    search finds the smallest capacity that greedy cutting can keep to; under it, each cut is made where shards
    come out most even.

    Returns key, ``size``, ``text_crc32``, ``law`` (``bytes``), ``shard``, ``slot`` (from 0, without
    gaps in a shard) and ``grown_shard`` (null) for each row. Null texts are as empty ones; null keys and
    repeated rows are rows like others. With fewer groups than shards, or one huge group, some
    shards stay empty. Of other columns none is read. An empty table gives an empty one.
    """
    rows = input_columns(docs, id=key, text=text).withColumn("text", F.coalesce("text", F.lit("")))
    rows = rows.select(
        "id", F.sha2(F.col("text").cast("binary"), 256).alias("digest"),
        (F.octet_length("text") + ROW_BYTES).cast("long").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
    )
    rows = stored(with_copies(rows, ["id", "digest"], "size", "text_crc32"), "shard-rows")
    groups = rows.groupBy("digest").agg(F.sum(F.col("size") * F.col("copies")).alias("size"))
    cuts = minimax_cuts(stored(groups, "shard-groups"), n_shards)
    placed = _slots(rows.withColumn("shard", _shard(F.col("digest"), cuts)), n_shards)
    return repeated(placed).select(
        F.col("id").alias(key), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("ahead") + F.col("copy") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
