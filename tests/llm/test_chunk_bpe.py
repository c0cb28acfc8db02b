import json
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from corpusloom.llm import chunk_bpe as module
from corpusloom.llm.chunk_bpe import ChunkedBpe, check_tokenizer, chunked_digests, chunks_of, encode_chunked, shared_chunks

from .messy import TEXTS, empty, messy

PATH = public_tokenizers.path("word_bpe_49k.json")
JSON = open(PATH).read()

PARTS = [
    "a", "B", " ", " ", "  ", "\n", "\t", "\r", "\x0b", "\x0c", " ", "\u0085", " ", "é", "é", "́", "İ", "İ", "ß", "Σ",
    "'s", "'", "n't", "!", "1", "²", "ñ", "中", "文", "🙂", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "the ", "The", "ing", "\x1c",
    "‍", "ﬁ", "\0", "한", "x" * 70, ".", ",", "...", "K", "5.5", "don't. ", "﻿",
]


def library():
    return Tokenizer.from_file(PATH)


def right(tokenizer, text):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    return np.array(ids, "<u4").tobytes(), tokenizer.decode(ids, skip_special_tokens=False)


def mixed(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.choice([0, 3, 20, 300]))) for _ in range(n)]


def check(texts):
    tokenizer, encoder = library(), ChunkedBpe(JSON)
    for text, ids in zip(texts, encoder.encode_all(texts), strict=True):
        assert (ids, encoder.decode(ids).decode()) == right(tokenizer, text), repr(text)


def test_mixed_texts_equal_the_library():
    check(mixed(4_000, 1))


def test_short_chunks_and_small_memories(monkeypatch):
    for name, value in [("CUT_BITS", 2), ("LEAST_CHUNK", 3), ("MOST_CHUNK", 12), ("MEMORY_BYTES", 500), ("MEMORY_WORDS", 50), ("MARKED_WORDS", 3), ("BLOCK_BYTES", 300)]:
        monkeypatch.setattr(module, name, value)
    check(mixed(2_000, 2))


def test_joins_take_more_words_until_they_agree(monkeypatch):
    """Chunk ids that do not end as their last word does are repaired by taking more words."""
    tokenizer, encoder = library(), ChunkedBpe(JSON)
    encode = encoder.encoded
    text = b"alpha beta gam" + b"ma delta epsilon"
    monkeypatch.setattr(module, "chunks_of", lambda texts: iter([[text[:14], text[14:]] for _ in texts]))
    wrong = {b"gam": encode([b"zebra"])[0]}
    encoder.encoded = lambda texts: [wrong.get(t) or i for t, i in zip(texts, encode(texts), strict=True)]
    assert next(encoder.encode_all([text.decode()])) == right(tokenizer, text.decode())[0]


def test_chunks_are_whole_and_alike():
    rng = random.Random(3)
    passage = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(2_000)).encode()
    texts = [passage, b"other words before " * 7 + passage, "é ".encode() * 3_000, b"x" * 10_000, b"", passage[:50]]
    cut = list(chunks_of(texts))
    assert [b"".join(c) for c in cut] == texts
    assert len(set(cut[0]) & set(cut[1])) > 0.9 * len(cut[0])
    assert all(c.decode() for chunks in cut for c in chunks) and len(cut[3]) == 1 and cut[4] == []


def test_shared_chunks_are_encoded_once(spark, monkeypatch):
    text = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").orderBy("doc_id").first().text
    rows = spark.createDataFrame([(i, text) for i in range(20)], "id long, text string").repartition(4)
    shared = shared_chunks(rows, JSON)
    cut = next(chunks_of([text.encode()]))
    assert set(shared) == set(cut)
    assert all(ids == right(library(), c.decode())[0] for c, ids in shared.items())
    monkeypatch.setattr(module, "SHARED_CHUNKS", 2)
    assert len(shared_chunks(rows, JSON)) == min(2, len(set(cut)))
    found = {(bytes(r.ids), r.decoded) for r in encode_chunked(rows, PATH, key="id").collect()}
    assert found == {right(library(), text)}


def test_documents_equal_the_library(spark):
    import hashlib

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    tokenizer = library()
    expected = []
    for r in docs.collect():
        ids, decoded = right(tokenizer, r.text)
        expected.append((r.doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert sorted(tuple(r) for r in chunked_digests(docs, PATH).collect()) == sorted(expected)


def test_messy_and_empty_tables(spark):
    tokenizer = library()
    found = sorted(((r.doc_id, bytes(r.ids), r.decoded) for r in encode_chunked(messy(spark), PATH).collect()), key=str)
    assert found == sorted(((i, *right(tokenizer, t)) for i, t in TEXTS), key=str)
    assert encode_chunked(empty(spark), PATH).count() == 0


@pytest.mark.parametrize("change", [
    {"decoder": {"type": "ByteLevel"}}, {"normalizer": {"type": "NFKC"}}, {"pre_tokenizer": {"type": "ByteLevel"}},
    {"added_tokens": [{"content": "a b", "lstrip": False, "rstrip": False, "single_word": False}]}, {"model": {"type": "Unigram"}},
])
def test_other_tokenizers_are_refused(change):
    with pytest.raises(ValueError, match="drop white space"):
        check_tokenizer(json.dumps(json.loads(JSON) | change))
