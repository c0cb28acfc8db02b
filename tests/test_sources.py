import os

import pytest
from pyspark.sql import functions as F

from corpusloom.functions.text import BYTE_BPE
from corpusloom.operators.bpe import train_bpe
from corpusloom.operators.stats import split_counts
from corpusloom.plans.build import build_dataset
from corpusloom.plans.prepare import prepare_corpus
from corpusloom.plans.train import train_on_corpus
from corpusloom.shared import shared_folder, through_table
from corpusloom.sources.texts import (
    dataset_name,
    read_dataset,
    read_texts,
    require_splits,
    spread,
    write_dataset,
    write_text,
)
from corpusloom.sources.tokenizers import load_tokenizer, save_tokenizer, tokenizer_name
from corpusloom.streaming.tokenize import tokenize_stream


def test_missing_text_column(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "t"))
    with pytest.raises(ValueError, match="no column 'text'"):
        read_texts(spark, str(tmp_path / "t"))


def test_missing_split(spark):
    rows = spark.createDataFrame([("train", 1)], "split string, doc_id long")
    with pytest.raises(ValueError, match="no rows in split validation"):
        require_splits(rows)


def test_names():
    assert tokenizer_name(17783, "char_bpe", "v1") == "vb-17783-char_bpe-v1"
    assert dataset_name("base", "v2", 300) == "base-300-v2"
    assert dataset_name("base", "v2") == "base-v2"


def test_dataset_read_back(spark, tmp_path):
    rows = spark.createDataFrame([("train", 1, [1, 2]), ("train", 1, [1, 2]), ("validation", 3, [])],
                                 "split string, doc_id long, ids array<int>")
    path = str(tmp_path / "d")
    write_dataset(rows, path)
    back = read_dataset(spark, path)
    assert sorted(back.select(*rows.columns).collect()) == sorted(rows.collect())
    plan = back.where("split = 'train'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_text_export(spark, tmp_path):
    rows = spark.createDataFrame([("a\nb",), (None,), ("",)], "text string")
    write_text(rows, str(tmp_path / "t"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "t"), lineSep="\n").collect()]
    assert sorted(lines) == ["", "a", "b"]


def test_spread_leaves_a_wide_input_alone(spark):
    wide = spark.range(10, numPartitions=9)
    assert spread(wide) is wide
    assert spread(spark.range(10, numPartitions=1)).rdd.getNumPartitions() == 8


def test_shared_folder_is_the_named_one(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_folder(spark) == named.rstrip("/")
    assert shared_folder(spark) == shared_folder(spark)
    assert through_table(spark.range(3), "t").count() == 3


def test_tokenizer_read_back(spark, documents, tmp_path):
    made = train_bpe(documents, BYTE_BPE, 200)
    save_tokenizer(made, str(tmp_path / "t"))
    back = load_tokenizer(spark, str(tmp_path / "t"))
    assert back.kind == BYTE_BPE
    assert sorted(back.vocab.collect()) == sorted(made.vocab.collect())
    assert sorted(back.merges.collect()) == sorted(made.merges.collect())


def test_train_and_build(spark, documents, tmp_path):
    trained = train_on_corpus(documents, "doc_id", str(tmp_path), "v1", vocab_size=250, on_unknown="unk")
    assert trained.path.endswith("vb-250-char_bpe-v1")
    assert {r.split for r in trained.metrics.collect()} == {"train", "validation"}
    assert all(r.compression_ratio > 1 for r in trained.metrics.collect())
    tokenizer = load_tokenizer(spark, trained.path)
    path = build_dataset(documents, tokenizer, "doc_id", str(tmp_path), "set", on_unknown="unk")
    assert path.endswith("set-250-v1")
    rows = read_dataset(spark, path)
    assert {"doc_id", "text", "lang", "raw_ids", "ids", "input_ids", "output_ids", "split"} <= set(rows.columns)
    wrong = rows.where(
        (F.col("input_ids") != F.col("raw_ids")) | (F.element_at("output_ids", -1) != 2)
        | (F.slice("input_ids", 2, 10**6) != F.slice("output_ids", F.lit(1), F.size("output_ids") - 1))
    )
    assert wrong.count() == 0 and rows.count() == documents.count() == split_counts(rows).agg(F.sum("n_rows")).first()[0]

    stream = spark.readStream.schema(documents.schema).option("pathGlobFilter", "documents.parquet")
    query = tokenize_stream(stream.parquet("/root/testdata/sf0.001"), tokenizer,
                            str(tmp_path / "s"), str(tmp_path / "c"), on_unknown="unk")
    query.awaitTermination()
    streamed = {r.doc_id: r.raw_ids for r in spark.read.parquet(str(tmp_path / "s")).collect()}
    assert len(streamed) == documents.count()
    assert all(streamed[r.doc_id] == r.raw_ids for r in rows.collect())


def test_jobs_leave_no_tables_behind(spark, documents, tmp_path):
    def left():
        folder = os.path.join(shared_folder(spark).removeprefix("file:"), "corpusloom")
        return set(os.listdir(folder)) if os.path.isdir(folder) else set()

    before = left()
    trained = train_on_corpus(documents, "doc_id", str(tmp_path), "v1", vocab_size=200, on_unknown="unk")
    build_dataset(documents, trained.tokenizer, "doc_id", str(tmp_path), "set", on_unknown="unk")
    assert left() == before


def test_caps_and_length_only_where_asked_for(documents):
    assert prepare_corpus(documents, "doc_id").count() == documents.count()
    assert prepare_corpus(documents, "doc_id", max_length=1500).count() == documents.where("length(text) < 1500").count()
    capped = prepare_corpus(documents, "doc_id", caps={"train": 7, "validation": 3})
    assert {r.split: r["count"] for r in capped.groupBy("split").count().collect()} == {"train": 7, "validation": 3}


def test_a_cluster_must_name_its_folder(spark, monkeypatch):
    class Somewhere:
        conf = type("C", (), {"get": staticmethod(lambda key, default: None)})

    for master, fine in (("local", True), ("local[3]", True), ("local-cluster[2,1,512]", False), ("yarn", False)):
        session = Somewhere()
        session.sparkContext = type("S", (), {"master": master, "applicationId": "app"})
        if fine:
            assert shared_folder(session).endswith("app")
        else:
            with pytest.raises(RuntimeError):
                shared_folder(session)
