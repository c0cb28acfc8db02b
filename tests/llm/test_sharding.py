import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from corpusloom.llm import sharding
from corpusloom.llm.sharding import shard_rows

from .messy import TEXTS, empty, messy


def least_capacity(sizes, n):
    low, high = max(sizes, default=0), sum(sizes)
    while low < high:
        middle, shards, filled = (low + high) // 2, 1, 0
        for s in sizes:
            if filled + s > middle:
                shards, filled = shards + 1, 0
            filled += s
        low, high = (low, middle) if shards <= n else (middle + 1, high)
    return low


def in_order(rows):
    """Sizes of groups in the order of their digests."""
    import hashlib

    groups = defaultdict(int)
    for _, text in rows:
        data = (text or "").encode()
        groups[hashlib.sha256(data).hexdigest()] += len(data) + 8
    return [groups[k] for k in sorted(groups)]


def check(result, texts, n):
    assert len(result) == len(texts)
    bytes_of, slots, shards_of = defaultdict(int), defaultdict(list), defaultdict(set)
    for r in result:
        bytes_of[r.shard] += r.size
        slots[r.shard].append(r.slot)
        shards_of[(r.text_crc32, r.size)].add(r.shard)
        assert 0 <= r.shard < n and r.law == "bytes" and r.grown_shard is None
    assert max(bytes_of.values()) == least_capacity(in_order(texts), n)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in shards_of.values())
    assert Counter(r.text_crc32 for r in result) == Counter(zlib.crc32((t or "").encode()) for _, t in texts)


@pytest.mark.parametrize("n", [1, 3, 24])
def test_messy_rows(spark, n):
    check(shard_rows(messy(spark), n).collect(), TEXTS, n)


@pytest.mark.parametrize("digits,hot", [(4, False), (1, False), (1, True)])
def test_smallest_capacity_with_cells_split_again(spark, monkeypatch, digits, hot):
    monkeypatch.setattr(sharding, "CELL_DIGITS", digits)
    draw = random.Random(5)
    texts = [(i, "same" if hot and i % 3 == 0 else "x" * draw.randint(0, 400) + str(i)) for i in range(600)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    check(shard_rows(docs, 7).collect(), texts, 7)


def test_capacity_range_brackets_the_least():
    draw = np.random.default_rng(2)
    for _ in range(50):
        sizes = draw.integers(1, 50, 60)
        cells = sharding.Cells([f"{i:02d}" for i in range(60)], sizes, np.ones(60, "int64"))
        fails, fits = sharding.capacity_range(cells, 5)
        assert fits == least_capacity(list(sizes), 5) == fails + 1


def test_cuts_are_even_under_the_capacity():
    draw = np.random.default_rng(3)
    for _ in range(200):
        sizes = draw.integers(1, draw.choice([3, 40, 1_000]), int(draw.integers(1, 80)))
        n = int(draw.integers(1, 9))
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        capacity = least_capacity(list(sizes), n)
        cuts = sharding.even_cuts(bounds, capacity, n)
        shards = np.diff([0, *bounds[cuts], bounds[-1]])
        assert len(cuts) == n - 1 and shards.min() >= 0 and shards.max() == capacity
    even = sharding.even_cuts(np.arange(0, 1_001), 101, 10)
    assert list(np.diff([0, *even, 1_000])) == [100] * 10


def test_empty(spark):
    assert shard_rows(empty(spark), 24).count() == 0
