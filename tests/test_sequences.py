import math

from pyspark.sql import functions as F

from corpusloom.operators.sequences import model_sequences, padded_batches
from corpusloom.operators.stats import (
    batch_counts,
    evaluate_tokenizer,
    token_budget,
    token_length_range,
)

ROWS = "split string, doc_id long, raw_ids array<int>"


def sequences(spark, rows):
    return model_sequences(spark.createDataFrame(rows, ROWS))


def test_shift(spark):
    got = {r.doc_id: r for r in sequences(spark, [("train", 1, [5, 6]), ("train", 2, [])]).collect()}
    assert (got[1].ids, got[1].input_ids, got[1].output_ids) == ([5, 6, 2], [5, 6], [6, 2])
    assert (got[2].ids, got[2].input_ids, got[2].output_ids) == ([2], [], [])


def test_pad(spark):
    batches = padded_batches(sequences(spark, [("train", 1, [5, 6, 7]), ("train", 2, [8])]), "doc_id", 2)
    got = {r.doc_id: (r.x, r.y) for r in batches.collect()}
    assert got == {1: ([5, 6, 7], [6, 7, 2]), 2: ([8, 2, 0], [2, 0, 0])}


def test_no_end_mark_without_room(spark):
    batches = padded_batches(sequences(spark, [("train", 1, [5]), ("train", 2, [8])]), "doc_id", 2)
    assert sorted(r.x for r in batches.collect()) == [[5], [8]]


def many(spark, n):
    ids = F.transform(F.sequence(F.lit(0), F.col("doc_id") % 13), lambda i: (i + 4).cast("int"))
    split = F.when(F.col("doc_id") % 5 == 0, "validation").otherwise("train")
    rows = spark.range(n).withColumnRenamed("id", "doc_id").withColumn("split", split)
    return model_sequences(rows.withColumn("raw_ids", ids))


def check_batches(rows, df, size):
    lengths = {r.doc_id: len(r.input_ids) for r in df.collect()}
    groups = {}
    for r in rows:
        groups.setdefault((r.split, r.batch_id), []).append(r)
    for (split, number), members in groups.items():
        width = max(lengths[r.doc_id] for r in members)
        assert {len(r.x) for r in members} == {len(r.y) for r in members} == {width}
    for split in ("train", "validation"):
        sizes = [len(groups[g]) for g in sorted(groups) if g[0] == split]
        assert all(s == size for s in sizes[:-1]) and 0 < sizes[-1] <= size


def test_batches_are_whole_and_even(spark):
    df = many(spark, 203)
    rows = padded_batches(df, "doc_id", 8).collect()
    assert len({r.doc_id for r in rows}) == len(rows) == 203
    check_batches(rows, df, 8)
    counts = {r.split: r.n_batches for r in batch_counts(df, 8).collect()}
    assert counts == {"train": math.ceil(162 / 8), "validation": math.ceil(41 / 8)}


def test_batches_inside_and_across_buckets(spark, monkeypatch):
    monkeypatch.setattr("corpusloom.functions.ordering.BUCKET_DIGITS", 1)
    df = many(spark, 400)
    check_batches(padded_batches(df, "doc_id", 4).collect(), df, 4)


def test_each_epoch_is_shuffled_anew(spark):
    df = many(spark, 60)
    first, second, again = (
        {r.doc_id: r.batch_id for r in padded_batches(df, "doc_id", 4, epoch).collect()} for epoch in (0, 1, 0)
    )
    assert first == again != second


def test_budget_and_lengths(spark):
    df = sequences(spark, [("train", 1, [5, 6]), ("train", 2, []), ("validation", 3, [1] * 9)])
    budget = token_budget(df, 2).first()
    assert (budget.total_tokens, budget.budget_tokens) == (4, 8)
    assert (budget.budget_millions, budget.parameters_millions) == (8e-6, 4e-7)
    assert tuple(token_length_range(df).first()) == (3, 1)


def test_evaluation(spark):
    df = spark.createDataFrame([("train", "abcd", [1, 2]), ("train", "ab", [3]), ("validation", "x", [])],
                               "split string, text string, raw_ids array<int>")
    got = {r.split: tuple(r)[1:] for r in evaluate_tokenizer(df).collect()}
    assert got == {"train": (1.5, 3.0, 2.0), "validation": (0.0, 1.0, 0.0)}
    assert evaluate_tokenizer(df.where("false")).count() == 0
