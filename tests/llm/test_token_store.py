import random
import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpusloom.llm.token_store import ChunkEncoder, id_digests, read_ids, read_index, train_dictionary, write_ids
from corpusloom.shared import new_path

from .messy import TEXTS, empty, messy

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_chunks_equal_whole_texts():
    encoder = ChunkEncoder(open(PATH).read())
    draw = random.Random(1)
    parts = [" ", "  ", "\n", " \n", "\n ", "\t", "a", "it's", "Ñ", "1", "!", "<|endoftext|>", " ", "日本", "🎉", "'s", " '", "\r\n", "　"]
    for _ in range(3_000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 12)))
        assert encoder.encode(text) == encoder.whole(text)


def test_spaces_inside_other_white_space():
    content = open(PATH).read()
    tokenizer, encoder = Tokenizer.from_str(content), ChunkEncoder(content)
    draw = random.Random(2)
    parts = ["a", "B7", " ", " ", "  ", "\n", "\t", "\u00a0", "\u0085", "\u2003", "\u3000", "\x1c", "\x0b", "é", "\u0301", "'s", " 's", "!", ".", ",",
             "...", "5.5", "1", "²", "中", "🙂", "<|endoftext|>", "the ", "\0", "\r\n", "\u200b", "\ufeff"]
    texts = ["x \xa0 \xa0 y", "x\n \xa0 \xa0\nz", "a\xa0 \xa0 \xa0 b", " ", "x ", " .", ".a", "a. b"]
    texts += ["".join(draw.choice(parts) for _ in range(draw.choice([2, 5, 20, 100]))) for _ in range(20_000)]
    for text, ids in zip(texts, encoder.encode_all(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_words_go_to_the_model_and_marks_are_cut_off(monkeypatch):
    content = open(PATH).read()
    tokenizer, encoder = Tokenizer.from_str(content), ChunkEncoder(content)
    draw, whole = random.Random(3), encoder.whole
    parts = ["ab", "Éß", "ȡ", "ªº", "×", "1", "٣", "Ω", "***", "!!", "$", "?\n", ".\n", ",\nÑa", "\nB", "'s", "!'s", ":", " ", " ", "\u00a0", "<|endoftext|>", "\0"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 12))) for _ in range(10_000)]
    for text, ids in zip(texts, encoder.encode_all(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)
    # Each word once, without the pre-tokenizer; the mark is one chunk for all of them.
    asked = []
    monkeypatch.setattr(encoder, "whole", lambda text: asked.append(text) or whole(text))
    spelled = ["".join(draw.choice("abcdeé") for _ in range(12)) for _ in range(200)]
    encoder.encode(" ".join(f"{word}%%%" for word in spelled))
    assert set(asked) <= {"%%%"}


def test_added_tokens_that_are_words():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.add_tokens(["bcd"])
    encoder = ChunkEncoder(tokenizer.to_str())
    for text in ("abcde bcd", "a\nbcd", "abcd!! x.bcd"):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_one_repeated_key_goes_to_several_files(spark):
    docs = spark.createDataFrame([(None if i % 2 else 7, f"text number {i} " * 40) for i in range(4_000)], "doc_id long, text string")
    path = new_path(spark, "ids")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small parts would be put together again
    write_ids(docs, PATH, path)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert read_index(spark, path).select("file").distinct().count() > 2
    starts = [(r.doc_id is not None, r.start) for r in id_digests(read_index(spark, path), path).collect()]
    assert [i for i, _ in sorted(starts, key=lambda r: r[1])] == [False] * 2_000 + [True] * 2_000


def expected():
    tokenizer = Tokenizer.from_file(PATH)
    order = sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0))
    return [(i, np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], "<u4").tobytes()) for i, t in order]


def test_files_hold_all_ids_in_order(spark):
    path = new_path(spark, "ids")
    write_ids(messy(spark), PATH, path)
    rows = sorted(id_digests(read_index(spark, path), path).collect(), key=lambda r: r.start)
    want = expected()
    assert [r.doc_id for r in rows] == [i for i, _ in want]
    ahead = 0
    for r in rows:
        assert r.start == ahead
        ahead += r.n_tokens
    # Rows with the same key come in some order of their own.
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in rows) == sorted((str(i), len(b) // 4, zlib.crc32(b)) for i, b in want)


def test_a_few_documents_can_be_read_alone(spark, documents):
    path = new_path(spark, "ids")
    write_ids(documents, PATH, path)
    tokenizer = Tokenizer.from_file(PATH)
    some = read_ids(read_index(spark, path).where(F.col("id") % 50 == 0), path).collect()
    texts = {r.doc_id: r.text for r in documents.collect()}
    assert len(some) == 4
    for r in some:
        assert np.frombuffer(r.ids, "<u4").tolist() == tokenizer.encode(texts[r.id], add_special_tokens=False).ids + [0]
    dictionary = spark.read.parquet(f"{path}/dictionary").first()
    assert len(dictionary.dictionary) > 1_000 and len(dictionary.hash) == 64


def test_empty_table_and_few_samples(spark):
    path = new_path(spark, "ids")
    write_ids(empty(spark), PATH, path)
    assert id_digests(read_index(spark, path), path).count() == 0
    assert train_dictionary([]) == b"" and train_dictionary([b"abcd"]) == b"abcd"
