import hashlib
import math

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.ranking import with_rank
from corpusloom.operators.splits import (
    cap_splits,
    combine_splits,
    filter_length,
    quick_sample,
    random_example,
    split_train_validation,
)
from corpusloom.operators.stats import corpus_characters, split_counts
from corpusloom.plans.prepare import prepare_corpus


def shuffled(ids, *seeds):
    prefix = "|".join(str(s) for s in seeds)
    return sorted(ids, key=lambda i: (hashlib.md5(f"{prefix}|{i}".encode()).hexdigest(), i))


def ids(spark, n, parts=4):
    return spark.range(n, numPartitions=parts).withColumnRenamed("id", "doc_id")


def test_length_is_strict_and_null_is_dropped(spark):
    texts = spark.createDataFrame([("a" * 1499,), ("a" * 1500,), ("a" * 1501,), (None,)], "text string")
    assert [len(r.text) for r in filter_length(texts).collect()] == [1499]


def test_length_counts_code_points(spark):
    texts = spark.createDataFrame([("a🦆",)], "text string")
    assert filter_length(texts, 3).count() == 1
    assert filter_length(texts, 2).count() == 0


def test_filter_honours_text_column(spark):
    texts = spark.createDataFrame([("abc", "a")], "text string, body string")
    assert filter_length(texts, 2, "body").count() == 1


@pytest.mark.parametrize("rows", [1, 2, 7, 10, 333])
@pytest.mark.parametrize("share", [0.0, 0.2, 0.5, 1.0])
def test_split_is_exact(spark, rows, share):
    got = split_train_validation(ids(spark, rows), "doc_id", share, seed=5).collect()
    order = shuffled(range(rows), 5)
    expected = set(order[: math.ceil(rows * share)])
    assert {r.doc_id for r in got if r.split == "validation"} == expected
    assert len(got) == rows


def test_split_does_not_depend_on_partitions(spark):
    one = split_train_validation(ids(spark, 500, 1), "doc_id").orderBy("doc_id").collect()
    many = split_train_validation(ids(spark, 500, 8), "doc_id").orderBy("doc_id").collect()
    assert one == many


def test_cap(spark):
    rows = ids(spark, 40).withColumn("split", F.when(F.col("doc_id") < 30, "train").otherwise("validation"))
    got = cap_splits(rows, "doc_id", {"train": 7, "validation": 10}, seed=1).collect()
    assert {r.doc_id for r in got if r.split == "train"} == set(shuffled(range(30), 1)[:7])
    assert {r.doc_id for r in got if r.split == "validation"} == set(range(30, 40))


def test_cap_equal_to_rows_cuts_nothing_and_other_splits_pass(spark):
    rows = ids(spark, 5).withColumn("split", F.when(F.col("doc_id") < 3, "train").otherwise("extra"))
    assert cap_splits(rows, "doc_id", {"train": 3}).count() == 5
    assert cap_splits(rows, "doc_id", {"train": 0}).count() == 2


def test_rank_is_dense_and_shuffled(spark):
    ranked = with_rank(ids(spark, 300), "doc_id", [9, 2]).orderBy("rank").collect()
    assert [r["rank"] for r in ranked] == list(range(1, 301))
    assert [r.doc_id for r in ranked] == shuffled(range(300), 9, 2)


def test_rank_with_full_buckets(spark, monkeypatch):
    monkeypatch.setattr("corpusloom.functions.ordering.BUCKET_DIGITS", 1)
    ranked = with_rank(ids(spark, 300), "doc_id", [9]).orderBy("rank").collect()
    assert [r.doc_id for r in ranked] == shuffled(range(300), 9)
    got = split_train_validation(ids(spark, 300), "doc_id", 0.2, seed=9).where("split = 'validation'")
    assert {r.doc_id for r in got.collect()} == set(shuffled(range(300), 9)[:60])


def test_quick_sample_returns_what_is_there(spark):
    rows = ids(spark, 5).withColumn("split", F.when(F.col("doc_id") < 4, "train").otherwise("validation"))
    assert quick_sample(rows, "doc_id").count() == 5


def test_random_example_is_one_row(spark):
    assert random_example(ids(spark, 50), "doc_id", 3).first().doc_id == shuffled(range(50), 3)[0]


def test_combine_keeps_duplicates(spark):
    part = spark.createDataFrame([(1,), (1,)], "doc_id long")
    assert combine_splits({"train": part, "validation": part}).count() == 4


def test_counts_and_characters(spark):
    rows = spark.createDataFrame([("train", "abc"), ("train", None), ("validation", "abcdef")],
                                 "split string, text string")
    got = {r.split: (r.n_rows, r.n_null, r.n_kept) for r in split_counts(rows, 4).collect()}
    assert got == {"train": (2, 1, 1), "validation": (1, 0, 0)}
    capped = split_counts(rows, 4, caps={"train": 0}).collect()
    assert {r.split: r.n_capped for r in capped} == {"train": 0, "validation": 0}
    assert {r.split: r.n_capped for r in split_counts(rows, 9, caps={"train": 5}).collect()} == {"train": 1, "validation": 1}
    assert corpus_characters(rows).first().n_chars == 3 + 6 + 1


def test_prepare_splits_before_the_filter(documents):
    got = prepare_corpus(documents, "doc_id", max_length=1500, caps={"train": 20, "validation": 5}).collect()
    rows = {r.doc_id: len(r.text) for r in documents.collect()}
    order = shuffled(rows, 123)
    n = math.ceil(len(rows) * 0.2)
    short = [[d for d in part if rows[d] < 1500] for part in (order[:n], order[n:])]
    assert {r.doc_id for r in got if r.split == "validation"} == set(short[0][:5])
    assert {r.doc_id for r in got if r.split == "train"} == set(short[1][:20])
    assert set(got[0].asDict()) == {"doc_id", "text", "lang", "source", "n_chars", "split"}
