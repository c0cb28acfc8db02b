import random
from collections import Counter

import numpy as np
import pytest

from corpusloom.llm import ngram_join
from corpusloom.llm.ngram_join import jaccard_components, tile_keys, tile_links

from .messy import TEXTS, empty, messy


def shingles(text):
    w = (text or "").encode().lower().split()
    k = min(3, len(w))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()


def brute(docs, percent=90):
    sets = [shingles(t) for _, t in docs]
    group = list(range(len(docs)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    found = Counter()
    for i, (doc_id, _) in enumerate(docs):
        ids = [d for g, (d, _) in zip(group, docs, strict=True) if g == group[i]]
        found[(doc_id, len(sets[i]), min((d for d in ids if d is not None), default=None))] += 1
    return found


def made(seed, n=90):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    bases = [[draw.choice(vocabulary) for _ in range(draw.choice([1, 2, 3, 12, 14, 40, 200, 400]))] for _ in range(12)]
    docs = []
    for i in range(n):
        words = list(draw.choice(bases))
        for _ in range(draw.choice([0, 0, 1, 1, 2, 5])):
            words[draw.randrange(len(words))] = draw.choice(vocabulary)
        if draw.random() < 0.3:
            words = words[: -max(1, len(words) // 30)] or words
        docs.append((i, draw.choice([" ", "\n", "  "]).join(words).upper() if draw.random() < 0.2 else " ".join(words)))
    return docs


@pytest.mark.parametrize("seed,tile,percent", [(1, 2_000_000, 90), (2, 300, 90), (3, 300, 75), (4, 2_000_000, 100)])
def test_equal_to_brute_force(spark, monkeypatch, seed, tile, percent):
    monkeypatch.setattr(ngram_join, "TILE_SHINGLES", tile)
    docs = made(seed) + ([] if seed > 1 else [d for d in TEXTS])
    table = spark.createDataFrame([(*d, 1, "k") for d in docs], "doc_id long, text string, n long, keys string")
    rows = jaccard_components(table, percent=percent).collect()
    assert Counter(tuple(r) for r in rows) == brute(docs, percent)


def test_without_broadcasts(spark, monkeypatch):
    from corpusloom.llm import tables

    monkeypatch.setattr(ngram_join, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(tables, "BROADCAST_ROWS", 0)
    docs = made(5)
    table = spark.createDataFrame(docs, "doc_id long, text string")
    assert Counter(tuple(r) for r in jaccard_components(table).collect()) == brute(docs)


def test_empty_and_messy(spark):
    assert jaccard_components(empty(spark)).count() == 0
    assert Counter(tuple(r) for r in jaccard_components(messy(spark)).collect()) == brute(TEXTS)


def test_linked_sets_share_a_key():
    draw = np.random.default_rng(3)
    for _ in range(400):
        size = int(draw.integers(1, 300))
        a = np.unique(draw.integers(0, 1 << 63, size).astype("uint64") * np.uint64(2))
        changes = int(draw.integers(0, max(1, size // 9) + 1))
        b = np.unique(np.concatenate([a[draw.permutation(len(a))[changes // 2 :]], draw.integers(0, 1 << 63, changes - changes // 2).astype("uint64") * np.uint64(2)]))
        common = len(np.intersect1d(a, b))
        if len(b) and 100 * common >= 90 * (len(a) + len(b) - common):
            assert np.intersect1d(tile_keys(a, 90), tile_keys(b, 90)).size


def test_links_connect_what_is_linked_without_all_pairs():
    base = np.arange(0, 2_000, 2, dtype="uint64") * np.uint64(0x9E3779B97F4A7C15)
    sets = [np.unique(np.append(base, np.uint64(i))) for i in range(1, 60)]
    assert len(tile_links(sets, np.full(59, 2), 90)) == 58
    assert len(tile_links(sets, np.arange(59) % 2, 90)) == 58
    assert tile_links(sets[:2], np.array([0, 0]), 90) == []


def near(draw, a, percent):
    changes = int(draw.integers(0, max(1, len(a) * (100 - percent) // 100) + 1))
    new = draw.integers(0, 1 << 63, changes - changes // 2).astype("uint64") * np.uint64(2)
    return np.unique(np.concatenate([a[draw.permutation(len(a))[changes // 2 :]], new]))


@pytest.mark.parametrize("percent,cuts", [(90, 6), (90, 1), (90, 2), (80, 3), (60, 2), (100, 6)])
def test_linked_sets_share_a_key_however_often_they_are_cut(monkeypatch, percent, cuts):
    monkeypatch.setattr(ngram_join, "CUTS", cuts)
    draw = np.random.default_rng(percent + cuts)
    linked = 0
    for _ in range(1_500):
        a = np.unique(draw.integers(0, 1 << 63, int(draw.integers(1, 130))).astype("uint64") * np.uint64(2))
        b = near(draw, a, percent)
        common = len(np.intersect1d(a, b))
        if len(b) and 100 * common >= percent * (len(a) + len(b) - common):
            linked += 1
            assert np.intersect1d(tile_keys(a, percent), tile_keys(b, percent)).size
    assert linked > 300


def test_unrelated_sets_share_no_more_tiles_as_they_grow_in_number():
    draw = np.random.default_rng(9)
    shares = []
    for n in (4_000, 16_000):
        seen = Counter()
        keys = []
        for size in draw.integers(20, 90, n):
            keys.append(tile_keys(np.unique(draw.integers(0, 1 << 64, int(size), dtype="uint64")), 90))
            seen.update(keys[-1].tolist())
        shares.append(1_000 * sum(any(seen[k] > 1 for k in one.tolist()) for one in keys) / n)
    assert max(shares) < 1.0


def test_a_chain_of_tiles_is_one_cluster(spark):
    # Labels whose least neighbours differ take several rounds.
    rows = [(i, [i // 2 * 2 + 1_000, (i + 1) // 2 * 2 + 5_001]) for i in range(40)] + [(i, [9_000 + i % 3]) for i in range(100, 140)]
    table = spark.createDataFrame(rows, "d1 long, keys array<long>")
    found = Counter(r.component for r in ngram_join._clusters(table).collect())
    assert found == {0: 40, 100: 14, 101: 13, 102: 13}
