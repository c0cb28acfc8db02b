import pytest
from pyspark.sql import functions as F

from corpusloom.functions.text import (
    BYTE_BPE,
    CHAR_BPE,
    SPECIAL_TOKENS,
    byte_words,
    byte_words_by_line,
    bytes_to_characters,
    char_words,
    characters_to_text,
    encoding_words,
    strip_spaces,
)

TEXTS = [
    "", " ", "Hello, world!", "  two  spaces ", "a\tb\nc\r\nd", "it's we're I'd 'tis", "tab\t\tx  \n\n y",
    "nb sp em　id", "zero​width \u0085nel\x0bvt\x0cff", "中文 and 日本語。カナ", "naïve café ÷ ×",
    "3.14 x² ½ ٣", "€100 ©®™ «q» “q” ¿?", "�bad\x00nul", "emoji 🦆🦆 𝒜", " og ᠎mv",
]


def applied(spark, text, column):
    return spark.createDataFrame([(text,)], "text string").select(column.alias("x")).first().x


@pytest.mark.parametrize("text", TEXTS)
def test_char_words_equal_the_public_library(spark, text):
    tokenizers = pytest.importorskip("tokenizers")
    made = tokenizers.CharBPETokenizer()
    normal = made.normalizer.normalize_str(text)
    expected = [w for w, _ in made.pre_tokenizer.pre_tokenize_str(normal)]
    assert applied(spark, text, char_words(F.col("text"))) == expected


@pytest.mark.parametrize("text", TEXTS)
def test_byte_words_equal_the_public_library(spark, text):
    tokenizers = pytest.importorskip("tokenizers")
    split = tokenizers.pre_tokenizers.ByteLevel()
    words = F.transform(byte_words(F.col("text")), bytes_to_characters)
    assert applied(spark, text, words) == [w for w, _ in split.pre_tokenize_str(text)]


@pytest.mark.parametrize("text", [*TEXTS, "a\n\nb", "\n", "one \n two\n\n\n  three\n", "\tx\n \ny"])
def test_words_by_line_equal_the_public_library(spark, text):
    tokenizers = pytest.importorskip("tokenizers")
    split = tokenizers.pre_tokenizers.ByteLevel()
    lines = [line + "\n" for line in text.split("\n")]
    expected = [w for line in lines for w, _ in split.pre_tokenize_str(line)]
    words = F.transform(byte_words_by_line(F.col("text")), bytes_to_characters)
    assert applied(spark, text, words) == expected


def test_special_tokens_are_cut_out_first(spark):
    text = "the cat<|pad|>the <|unk|><|pad|>"
    char = applied(spark, text, encoding_words(F.col("text"), CHAR_BPE, SPECIAL_TOKENS))
    assert char == ["the", "cat", "<|pad|>", "the", "<|unk|>", "<|pad|>"]
    byte = applied(spark, text, encoding_words(F.col("text"), BYTE_BPE, SPECIAL_TOKENS))
    assert byte == [" the", " cat", "<|pad|>", " the", " ", "<|unk|>", "<|pad|>"]


def test_every_byte_has_its_character(spark):
    text = "".join(chr(c) for c in [*range(0x100), 0x3B1, 0x4E2D, 0x1F986])
    shown = applied(spark, text, bytes_to_characters(F.col("text")))
    assert len(shown) == len(text.encode()) and not any(c.isspace() for c in shown)
    assert applied(spark, shown, characters_to_text(F.col("text"))) == text


def test_invalid_bytes_are_replaced(spark):
    shown = applied(spark, "é", bytes_to_characters(F.col("text")))
    assert applied(spark, shown[:1] + "a", characters_to_text(F.col("text"))) == "�a"


def test_strip_equals_python(spark):
    text = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0       　x y　 "
    assert applied(spark, text, strip_spaces(F.col("text"))) == text.strip() == "x y"
