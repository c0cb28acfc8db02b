import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from corpusloom.llm import phrases as module
from corpusloom.llm.phrases import MisraGries, frequent_ngrams, phrases, word_blocks

from .messy import empty, messy


def pieces(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall("[^\x20\x09]+", piece) for piece in re.split("[.,;:!?\x0a-\x0d]", low)]


def counts(rows):
    found, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            n[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    found[lang][tuple(words[i : i + k])] += 1
    return found, n


def brute(rows, least=30, share=80, top=2000):
    found, n = counts(rows)
    out = []
    for lang, f in found.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        longer = Counter()
        for p, a in candidates.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    longer[p[i : i + k]] = max(longer[p[i : i + k]], a)
        kept = []
        for p, a in candidates.items():
            if 100 * longer[p] < share * a:
                score, _, l, r = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(kept)[:top], start=1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def random_rows(n, seed):
    rng = random.Random(seed)
    words = ["a", "B", "the", "of", "Of", "é", "x-y", "\x1c", "ab", "\0", "en", "de"]
    ends = [" ", " ", " ", "  ", "\t", ". ", ",", ";\n", "\x0b", "\r", "! ?"]
    rows = []
    for _ in range(n):
        text = "".join(rng.choice(words) + rng.choice(ends) for _ in range(rng.randint(0, 60)))
        rows.append((rng.choice([text, text, text, None, "of the end"]), rng.choice(["en", "de", None, "und"])))
    return rows


@pytest.mark.parametrize("least,top", [(3, 2_000), (30, 20)])
def test_equals_brute_force(spark, least, top):
    rows = random_rows(400, least)
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    assert found(phrases(docs, least=least, top=top)) == brute(rows, least, top=top)


def test_slices_and_blocks_change_nothing(monkeypatch):
    rows = random_rows(60, 1)
    rows.append((" ".join(f"w{i % 7}" for i in range(500)) + "y" * 300, "en"))
    monkeypatch.setattr(module, "SLICE_BYTES", 40)
    batch = pa.RecordBatch.from_arrays([pa.array([g or "und" for _, g in rows]), pa.array([t for t, _ in rows])], ["g", "t"])
    seen = defaultdict(Counter)
    for block in word_blocks([batch], 4, size=50):
        for k, at, _ in block.ngrams(4):
            for i in at.tolist():
                seen[block.group(i)][tuple(w.decode() for w in block.words[i : i + k])] += 1
    assert seen == {g: c for g, c in counts(rows)[0].items() if c}


def test_a_summary_keeps_all_that_is_frequent():
    rng = np.random.default_rng(5)
    for least in (2, 5, 30):
        truth, summary = Counter(), MisraGries(1, least)
        keys = np.concatenate([rng.zipf(1.3, 20_000) % 5_000, rng.integers(0, 5_000, 20_000)]).astype("uint32")
        summary = MisraGries(len(keys) // least + 1, least)
        for part in np.array_split(keys, 40):
            some, n = np.unique(part, return_counts=True)
            summary.add(some, n)
            truth.update(part.tolist())
        assert {k for k, n in truth.items() if n >= least} <= set(summary.survivors().tolist())
        assert summary.lost < least
        # A capacity below the plan grows rather than lose a key.
        small = MisraGries(1, least)
        for part in np.array_split(keys, 40):
            small.add(*np.unique(part, return_counts=True))
        assert {k for k, n in truth.items() if n >= least} <= set(small.survivors().tolist())


def test_a_full_table_changes_nothing(spark, monkeypatch):
    rows = random_rows(200, 2)
    docs = spark.createDataFrame(rows, "text string, lang string")
    right = sorted(tuple(r) for r in frequent_ngrams(docs, least=5).collect())
    monkeypatch.setattr(module, "TABLE_BITS", 9)
    monkeypatch.setattr(module, "LEAST_PARTS", 2)
    assert sorted(tuple(r) for r in frequent_ngrams(docs, least=5).collect()) == right


def test_many_parts_and_a_hot_phrase(spark, monkeypatch):
    monkeypatch.setattr(module, "PART_MASS", 8)
    rows = [("new york city", "en")] * 500 + random_rows(100, 3)
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(7)
    assert found(phrases(docs, least=10)) == brute(rows, 10)


def test_messy_and_empty_tables(spark):
    rows = [(r["text"], r["lang"]) for r in messy(spark).collect()]
    assert found(phrases(messy(spark), least=2)) == brute(rows, 2)
    assert phrases(empty(spark)).count() == 0
