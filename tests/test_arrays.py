"""Encoding and reading along, for the words and ids of many rows in one array."""

import random
from types import SimpleNamespace

import pyarrow as pa
import pytest

from corpusloom.functions.text import BYTE_BPE, CHAR_BPE, shown_bytes
from corpusloom.operators import decode
from corpusloom.operators.encode import _segmenter


def one_by_one(ids, merges):
    while True:
        found = [(merges[pair][0], at) for at, pair in enumerate(zip(ids, ids[1:])) if pair in merges]
        if not found:
            return ids
        at = min(found)[1]
        ids = [*ids[:at], merges[ids[at], ids[at + 1]][1], *ids[at + 2 :]]


def test_words_of_a_batch_are_merged_like_words_alone():
    rng = random.Random(3)
    for _ in range(40):
        tokens = ["a", "b", "é", "a</w>", "b</w>", "é</w>", *(f"new{i}" for i in range(14))]
        ids = {t: i for i, t in enumerate(tokens)}
        # Results may be letters, so a later merge can make a pair that comes earlier.
        merges = {(rng.randrange(20), rng.randrange(20)): (rank, rng.randrange(20)) for rank in rng.sample(range(90), 60)}
        rows = [
            None if rng.random() < 0.1 else ["".join(rng.choices("abé", k=rng.choice([1, 2, 5, 9, 63, 64, 90]))) for _ in range(rng.randint(0, 6))]
            for _ in range(12)
        ]
        rows[3] = ["<s>", "ab", "<s>"]
        rules = SimpleNamespace(value=(ids, {"<s>": [19]}, merges, None))
        found = _segmenter(rules, "</w>", None)(iter([pa.array(rows[:7], pa.list_(pa.string())), pa.array(rows[7:], pa.list_(pa.string()))]))
        spelled = [[[*word[:-1], word[-1] + "</w>"] for word in row or []] for row in rows]
        expected = [
            [i for word in row for i in ([19] if word == [*"<s", "></w>"] else one_by_one([ids[c] for c in word], merges))] for row in spelled
        ]
        assert [ids for batch in found for ids in batch.to_pylist()] == expected


@pytest.mark.parametrize("suffix, letter", [("</w>", "'x</w>' of 'abx'"), ("", "'x' of 'abx'")])
def test_a_letter_that_is_not_there_is_named(suffix, letter):
    rules = SimpleNamespace(value=({"a": 0, "b": 1, f"b{suffix}": 2}, {}, {}, None))
    with pytest.raises(ValueError, match=letter):
        list(_segmenter(rules, suffix, None)(iter([pa.array([["ab", "abx"]])])))
    rules.value = (*rules.value[:3], 7)
    assert next(_segmenter(rules, suffix, None)(iter([pa.array([["abx", "x"], []])]))).to_pylist() == [[0, rules.value[0]["b"], 7, 7], []]


@pytest.mark.parametrize("kind", [CHAR_BPE, BYTE_BPE])
def test_pieces_of_many_rows_are_those_of_one(kind):
    rng, shown = random.Random(4), shown_bytes()
    if kind == CHAR_BPE:
        tokens = [None, "a", "b</w>", "c</w>", "</w>", "d</w>e", None, "f"]
    else:
        parts = ["a", " b", "é", "中", "é中", "\n"]
        pieces = [p.encode() for p in parts] + [b"\xc3", b"\xa9", b"\xe4\xb8", b"\xad", b"\xe4", b"a\xc3", b"\xa9b", b"\xff"]
        tokens = [None, *("".join(shown[b] for b in raw) for raw in pieces), None]
    rows = [
        None if rng.random() < 0.1 else [rng.choice([None, -3, len(tokens) + 2, *range(len(tokens)), *range(len(tokens))]) for _ in range(rng.randint(0, 9))]
        for _ in range(3_000)
    ]
    expected = []
    for row in rows:
        settling = decode.Settling(kind)
        found = [settling.push(tokens[i] if i is not None and 0 <= i < len(tokens) else None) for i in row or []]
        if found:
            found[-1] += settling.end()
        expected.append(None if row is None else found)
    settle = decode._settler(SimpleNamespace(value=tokens), kind, {c: b for b, c in enumerate(shown)})
    batches = [pa.array(part, pa.list_(pa.int32())) for part in (rows[:1_000], rows[1_000:1_000], rows[1_000:])]
    assert [row for batch in settle(iter(batches)) for row in batch.to_pylist()] == expected
