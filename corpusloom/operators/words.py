"""Word and pair counts of a table of texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusloom.functions.text import (
    CHAR_BPE,
    WORD_SUFFIX,
    check_kind,
    training_words,
    word_symbols,
)

# Characters of a part between spaces that is counted as it is.
_SHORT_PART = 64


def word_counts(df: DataFrame, kind: str = CHAR_BPE, text_column: str = "text") -> DataFrame:
    """Rows ``(word, n)``. Counting starts before the shuffle, so a hot word costs one row a task.

    Byte-level words are shown with one printable character for each byte. For the character kind, what stands between
    two spaces is counted first, and words are cut out of it once, however often it occurs; no word holds a space.
    """
    if check_kind(kind) == CHAR_BPE:
        parts = df.select(F.explode(F.split(text_column, " ")).alias("part"))
        # Long parts hardly occur again: their words are counted instead.
        short = F.length("part") <= _SHORT_PART
        parts = parts.select(F.explode(F.when(short, F.array("part")).otherwise(training_words(F.col("part"), kind))).alias("part"))
        counted = parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
        words = counted.select("n", F.explode(training_words(F.col("part"), kind)).alias("word"))
        counts = words.groupBy("word").agg(F.sum("n").alias("n"))
    else:
        words = df.select(F.explode(training_words(F.col(text_column), kind)).alias("word"))
        counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.select(word_symbols(F.col("word"), kind).alias("word"), "n")


def pair_counts(counts: DataFrame, kind: str = CHAR_BPE) -> DataFrame:
    """Rows ``(left, right, n)``: pairs of adjacent characters, weighted by word count.

    These are the pairs a training starts from. For the character kind, the last
    character of a word carries the word suffix.
    """
    letters = F.split("word", "")
    if check_kind(kind) == CHAR_BPE:
        last = F.concat(F.element_at(letters, -1), F.lit(WORD_SUFFIX))
        letters = F.concat(F.slice(letters, F.lit(1), F.size(letters) - 1), F.array(last))
    spelled = counts.where(F.length("word") > 1).select("n", letters.alias("letters"))
    head = F.size("letters") - 1
    pairs = F.arrays_zip(
        F.slice("letters", F.lit(1), head).alias("left"),
        F.slice("letters", F.lit(2), head).alias("right"),
    )
    return (
        spelled.select("n", F.explode(pairs).alias("pair"))
        .groupBy("pair.left", "pair.right")
        .agg(F.sum("n").alias("n"))
    )
