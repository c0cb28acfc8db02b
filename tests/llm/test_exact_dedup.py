import hashlib
import re
from collections import Counter, defaultdict

import pytest

from corpusloom.llm.exact_dedup import build_index, exact_duplicates, grow_directory

from .messy import TEXTS, empty, messy


def expected():
    groups = defaultdict(list)
    for doc_id, text in TEXTS:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc_id)
    found = Counter()
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        kept = 0
        for i in ids:
            found[(i, keep, len(ids), i == keep and not kept, digest)] += 1
            kept += i == keep
    return found


@pytest.mark.parametrize("key_digits,capacity", [(16, 8_192), (1, 2), (4, 1)])
def test_equal_to_brute_force_with_collisions_and_splits(spark, key_digits, capacity):
    rows = exact_duplicates(messy(spark), capacity=capacity, key_digits=key_digits).collect()
    assert Counter(tuple(r) for r in rows) == expected()


def test_colliding_keys_make_chains(spark):
    _, index = build_index(messy(spark), "doc_id", "text", key_digits=1)
    assert index.groupBy("key").max("chain").agg({"max(chain)": "max"}).first()[0] > 1


def test_empty(spark):
    assert exact_duplicates(empty(spark)).count() == 0


def test_hot_text_is_counted_whole(spark):
    docs = spark.range(3_000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'same' ELSE string(id) END AS text")
    rows = exact_duplicates(docs, capacity=50).where("kept").toPandas()
    assert len(rows) == 2_001 and rows["group_size"].sum() == 3_000 and rows["keep_id"].min() == 0


def test_directory_splits_until_buckets_fit():
    cells = {f"{i:04x}": 1 for i in range(0, 65_536, 64)}
    directory = grow_directory(cells, 100)
    held = Counter()
    depth = (len(directory) - 1).bit_length()
    for cell in cells:
        held[directory[int(cell, 16) >> (16 - depth)]] += 1
    assert max(held.values()) <= 100 and len(held) == 16
    assert grow_directory({"00ff": 5}, 100) == [0]
    assert len(grow_directory({"0000": 500, "8000": 1}, 100)) == 65_536  # one cell can't be split further
