import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from corpusloom.functions.text import BYTE_BPE, CHAR_BPE, SPECIAL_TOKENS
from corpusloom.operators.bpe import train_bpe
from corpusloom.operators.decode import decode, eot_id, round_trip, special_entries, token_ids, with_text
from corpusloom.operators.encode import encode, with_ids
from corpusloom.sources.tokenizers import Tokenizer

SAMPLE = "The heron waits, still as a post.<|end_of_text|> <|pad|>A fish<|unk|> <|pad|><|pad|>"


@pytest.fixture(scope="module")
def trained(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return {kind: train_bpe(documents, kind, 220) for kind in (CHAR_BPE, BYTE_BPE)}


def library(tokenizer):
    tokenizers = pytest.importorskip("tokenizers")
    vocab = {r.token: r.id for r in tokenizer.vocab.collect()}
    merges = [(r.left, r.right) for r in tokenizer.merges.orderBy("rank").collect()]
    if tokenizer.kind == CHAR_BPE:
        made = tokenizers.CharBPETokenizer(vocab, merges, unk_token="<|unk|>")
    else:
        made = tokenizers.Tokenizer(tokenizers.models.BPE(vocab, merges, unk_token="<|unk|>"))
        made.pre_tokenizer = tokenizers.pre_tokenizers.ByteLevel()
        made.decoder = tokenizers.decoders.ByteLevel()
    made.add_special_tokens(list(SPECIAL_TOKENS))
    return made


def ids_of(df):
    return {r.doc_id: r.raw_ids for r in df.collect()}


@pytest.mark.parametrize("kind", [CHAR_BPE, BYTE_BPE])
def test_ids_and_texts_equal_the_public_library(spark, documents, trained, kind):
    made = library(trained[kind])
    odd = ["", " ", SAMPLE, "zzz中文 ½", "x" * 5000, "a<|pad|> b", "naïve café"]
    extra = spark.createDataFrame([(-1 - i, t) for i, t in enumerate(odd)], "doc_id long, text string")
    texts = documents.select("doc_id", "text").unionByName(extra)
    raw_ids = encode(texts, trained[kind], "doc_id", on_unknown="unk")
    rows = texts.collect()
    expected = {r.doc_id: made.encode(r.text).ids for r in rows}
    assert ids_of(raw_ids) == expected
    decoded = {r.doc_id: r.decoded for r in decode(raw_ids, trained[kind], "doc_id").collect()}
    assert decoded == {k: made.decode(ids) for k, ids in expected.items()}


def test_unknown_characters(spark, trained):
    texts = spark.createDataFrame([(1, "a 中")], "doc_id long, text string")
    with pytest.raises(PythonException, match="not in the vocabulary"):
        encode(texts, trained[CHAR_BPE], "doc_id").collect()
    assert ids_of(encode(texts, trained[CHAR_BPE], "doc_id", on_unknown="unk"))[1][-1] == 3
    bytes_never_seen = spark.createDataFrame([(1, "\x01\x02")], "doc_id long, text string")
    assert ids_of(encode(bytes_never_seen, trained[BYTE_BPE], "doc_id"))[1][1:] == [3, 3]
    with pytest.raises(ValueError):
        encode(texts, trained[CHAR_BPE], "doc_id", on_unknown="drop")


def test_keys_of_several_columns(spark, trained):
    turns = spark.createDataFrame([(1, 1, "a b"), (1, 2, "")], "conv_id long, turn long, text string")
    got = {(r.conv_id, r.turn): r.raw_ids for r in encode(turns, trained[CHAR_BPE], ["conv_id", "turn"], on_unknown="unk").collect()}
    assert len(got[1, 1]) == 2 and got[1, 2] == []


def small(spark, rows, kind=CHAR_BPE, merges=()):
    vocab = spark.createDataFrame(rows, "token string, id int, is_special boolean")
    return Tokenizer(kind, vocab, spark.createDataFrame(merges, "rank int, left string, right string, new_token string"))


def test_long_and_short_words_merge_alike(spark):
    tokens = ["a", "b", "b</w>", "ab", "abab", "aba", "ba"]
    merges = [(0, "a", "b", "ab"), (1, "ab", "ab", "abab"), (2, "ab", "a", "aba"), (3, "b", "a", "ba")]
    made = small(spark, [(t, i, False) for i, t in enumerate(tokens)], merges=merges)
    words = {n: "ab" * n + "aab" * (n % 3) + "bb" for n in (1, 5, 29, 40, 90)}
    texts = spark.createDataFrame(list(words.items()), "doc_id long, text string")
    reference = pytest.importorskip("tokenizers").CharBPETokenizer(
        {t: i for i, t in enumerate(tokens)}, [m[1:3] for m in merges], unk_token="<|unk|>"
    )
    assert ids_of(encode(texts, made, "doc_id")) == {n: reference.encode(w).ids for n, w in words.items()}


def test_eot_rule(spark):
    def found(*tokens):
        return eot_id(small(spark, [(t, i, True) for t, i in tokens])).first().eot_id

    assert found(("<|end_of_text|>", 7), ("</s>", 5)) == 7
    assert found(("</s>", 5)) == 5
    assert found(("x", 9)) == 2


def test_special_lookups(spark):
    made = small(spark, [("<|pad|>", 0, True), ("<x", 5, False), ("y", 6, False)])
    assert {r.token for r in special_entries(made).collect()} == {"<|pad|>", "<x"}
    assert tuple(token_ids(made, ["<|pad|>", "<unk>"]).first()) == (0, None)


def test_round_trip_strips_only_the_decoded_text(spark):
    rows = [("train", "a b", "a b "), ("train", " a", " a"), ("validation", "x", "y")]
    checked = round_trip(spark.createDataFrame(rows, "split string, text string, decoded string"))
    got = {r.split: (r.n_texts, r.n_same, r.share_same) for r in checked.collect()}
    assert got == {"train": (2, 1, 0.5), "validation": (1, 0, 0.0)}


def test_decode_skips_special_and_absent_ids(spark, trained):
    rows = spark.createDataFrame([(1, [0, 3, 99999]), (2, [])], "doc_id long, raw_ids array<int>")
    got = {r.doc_id: r.decoded for r in decode(rows, trained[CHAR_BPE], "doc_id").collect()}
    assert got == {1: "", 2: ""}


@pytest.mark.parametrize("kind", [CHAR_BPE, BYTE_BPE])
def test_nothing_is_moved(documents, trained, kind):
    rows = with_text(with_ids(documents, trained[kind]), trained[kind])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


@pytest.mark.parametrize("name", ["id", "word", "pos", "ids", "token", "rank", "n", "raw"])
def test_null_and_repeated_keys_of_any_name_keep_every_row(spark, trained, name):
    rows = [(1, "the cat"), (1, "a cat"), (None, "the cat"), (None, None), (2, "")]
    texts = spark.createDataFrame(rows, f"{name} long, text string")
    ids = encode(texts, trained[BYTE_BPE], name)
    decoded = decode(ids, trained[BYTE_BPE], name).collect()
    expected = [(i, " " + t if t else "") for i, t in rows]
    assert sorted(map(str, map(tuple, decoded))) == sorted(map(str, expected))
    kept = with_ids(texts, trained[BYTE_BPE])
    assert kept.columns == [name, "text", "raw_ids"] and kept.count() == 5


def test_a_text_of_many_characters_trains_and_encodes_itself(spark):
    texts = spark.createDataFrame([(1, "".join(chr(0x4E00 + i) for i in range(1_100)))], "doc_id long, text string")
    made = train_bpe(texts, CHAR_BPE)
    assert len(ids_of(encode(texts, made, "doc_id"))[1]) == 1_100
