import hashlib
import random
import re
from collections import Counter

import pytest

from corpusloom.llm import decontaminate
from corpusloom.llm.decontaminate import contamination

from .messy import TEXTS, empty, messy

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items):
    windows = set()
    for item, text in items:
        w = words(text)
        k = min(13, len(w))
        windows |= {(str(item) if item is not None else "", tuple(w[i : i + k])) for i in range(len(w) - k + 1) if k}
    found = Counter()
    for doc_id, text in docs:
        w, hit, of = words(text), set(), set()
        for item, x in windows:
            for i in range(len(w) - len(x) + 1):
                if tuple(w[i : i + len(x)]) == x:
                    hit |= set(range(i, i + len(x)))
                    of.add(item)
        digest = hashlib.sha256(",".join(sorted(of)).encode()).hexdigest()
        found[(doc_id, len(w), len(hit), len(of), digest, bool(hit) and 20 * len(hit) >= len(w))] += 1
    return found


def made():
    draw = random.Random(4)
    vocabulary = ["The", "of", "a1", "É", "é", "x", "Rare-word", "it's", "b\n"]
    text = lambda n: " ".join(draw.choice(vocabulary) for _ in range(n))
    items = [(10, text(20)), (9, text(14)), (9, text(2)), (None, "x X x"), (3, None), (4, "!!"), (5, "one two three")]
    docs = [(i, text(draw.randint(0, 60))) for i in range(30)]
    docs += [(100, "pre " * 300 + items[0][1].upper() + " post"), (101, items[1][1]), (101, items[1][1]), (None, items[0][1])]
    return docs + TEXTS, items


@pytest.mark.parametrize("block_words", [200_000, 15])
def test_equal_to_brute_force(spark, monkeypatch, block_words):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block_words)
    docs, items = made()
    table = spark.createDataFrame([(*d, "id", 1) for d in docs], "doc_id long, text string, id string, pos int")
    benchmark = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, n int")
    rows = contamination(table, benchmark).collect()
    assert Counter(tuple(r) for r in rows) == brute(docs, items)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert contamination(empty(spark), none).count() == 0
    assert Counter(tuple(r) for r in contamination(messy(spark), none).collect()) == brute(TEXTS, [])


def test_documents_are_not_shuffled_whole(spark):
    docs, items = made()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    plan = contamination(messy(spark), benchmark)._jdf.queryExecution().optimizedPlan().toString()
    assert "pythonUDF" not in plan and "MapInPandas" not in plan
