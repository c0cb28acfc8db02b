from collections import Counter

from pyspark.sql import functions as F

from corpusloom.functions.text import CHAR_BPE, char_words
from corpusloom.operators.words import _SHORT_PART, word_counts

TEXTS = [
    "a b  a", " a, b.", "x\u00a0y\tz\nx", "a\u200bb c\x0bd \x85 e\ufffdf", "中文 ab中c。", "", " ", None, "it's (it's) -", "\u3000a\u2003b",
    "word," * _SHORT_PART, "é" * (_SHORT_PART + 1) + " é", "中" * 100 + "\u200b x", "🎉a 🎉a", "l1\r\nl2",
]


def test_counts_of_parts_give_counts_of_words(spark):
    docs = spark.createDataFrame([(t,) for t in TEXTS * 3], "text string")
    rows = docs.select(F.explode(char_words(F.col("text"))).alias("word")).collect()
    counts = word_counts(docs, CHAR_BPE).collect()
    assert {r.word: r.n for r in counts} == Counter(r.word for r in rows)
    assert len(counts) == len({r.word for r in rows})


def test_words_are_cut_out_of_a_repeated_part_once(spark):
    docs = spark.createDataFrame([("same, same " * 50,)] * 40, "text string")
    plan = word_counts(docs, CHAR_BPE)._jdf.queryExecution().optimizedPlan().toString()
    # From the top: sums of words, the cut, counts of parts.
    below = plan.split("Aggregate [part")
    assert len(below) == 2 and "regexp_extract_all" in below[0]
