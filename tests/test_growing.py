"""Datasets that grow, epochs entered anywhere, logs that keep arriving, texts token by token, lines that do not fit."""

import json
import random

import pytest
from pyspark.sql import functions as F

from checks.queries import documents as read_documents, tokenizer
from corpusloom.functions.text import BYTE_BPE, CHAR_BPE, characters_to_text, shown_bytes
from corpusloom.operators import decode, encode, losses, sequences, splits
from corpusloom.plans.append import append_dataset, history, read_appended
from corpusloom.plans.epochs import store_epoch, stored_batches
from corpusloom.sources.texts import read_json_lines, read_text_lines
from corpusloom.streaming.losses import epoch_losses_stream, running_loss_stream

SF_DIR = "/root/testdata/sf0.001"


def test_added_rows_leave_earlier_ones_where_they_are(spark, documents, tmp_path):
    made, path, rows = tokenizer(spark, SF_DIR), str(tmp_path / "set"), documents.count()
    assert history(spark, path) is None
    with pytest.raises(ValueError, match="no dataset"):
        read_appended(spark, path)
    sides = {}
    for part in (0.3, 0.31, 0.9, 1.0):
        some = documents.where(F.col("doc_id") < int(part * rows))
        added = append_dataset(some, made, "doc_id", path)
        found = {r.doc_id: r.split for r in read_appended(spark, path).select("doc_id", "split").collect()}
        assert len(found) == len(sides) + added == some.count()
        assert sides.items() <= found.items()
        assert sum(s == "validation" for s in found.values()) == -(-len(found) // 5)
        sides = found
    assert append_dataset(documents, made, "doc_id", path) == 0
    first = documents.where(F.col("doc_id") < int(0.3 * rows))
    want = {r.doc_id: r.split for r in splits.split_train_validation(first, "doc_id").collect()}
    assert want.items() <= sides.items()
    # What a broken addition left is not read, and is written again.
    read_appended(spark, path).where("added = 1").drop("added").write.parquet(f"{path}/rows/added=5")
    assert read_appended(spark, path).count() == rows
    more = documents.limit(3).withColumn("doc_id", F.col("doc_id") + 1_000_000)
    assert append_dataset(more, made, "doc_id", path) == 3
    assert read_appended(spark, path).count() == rows + 3


def test_added_null_keys_and_clashing_names(spark, tmp_path):
    made, path = tokenizer(spark, SF_DIR), str(tmp_path / "set")
    rows = spark.createDataFrame([(None, "a"), (1, None), (2, "")], "doc_id long, text string")
    assert append_dataset(rows.where("false"), made, "doc_id", path, on_unknown="unk") == 0
    assert append_dataset(rows, made, "doc_id", path, on_unknown="unk") == 3
    assert append_dataset(rows, made, "doc_id", path, on_unknown="unk") == 0
    with pytest.raises(ValueError, match="added"):
        append_dataset(rows.withColumn("added", F.lit(1)), made, "doc_id", path)


def test_epochs_are_entered_anywhere(spark, documents, tmp_path):
    split = splits.split_train_validation(documents, "doc_id").withColumn("raw_ids", F.transform(F.split("text", " "), lambda w: F.length(w)))
    rows, path = sequences.model_sequences(split), str(tmp_path / "epoch")
    store_epoch(rows, "doc_id", path, epoch=3, rows_per_file=10)
    whole = sequences.padded_batches(rows, "doc_id", 7, epoch=3)
    for side, first, last in (("train", 0, None), ("train", 2, 4), ("train", 5, 5), ("validation", 1, None), ("train", 10**6, None), ("none", 0, None)):
        want = whole.where(F.col("split") == side).where(F.col("batch_id").between(first, 10**9 if last is None else last))
        got = stored_batches(spark, path, "doc_id", side, first, last, 7)
        assert sorted(got.collect()) == sorted(want.collect())
    few = stored_batches(spark, path, "doc_id", "train", 2, 2, 7).inputFiles()
    assert 0 < len(few) <= 2 < len(spark.read.parquet(f"{path}/rows").inputFiles())


LOG = "run string, epoch int, split string, batch_num long, loss double"


def run_stream(spark, made, tmp_path, mode="append"):
    """Each list of rows arrives after the last one was done, and the query is started anew."""
    found = None
    for part in made:
        spark.createDataFrame(part, LOG).write.mode("append").parquet(str(tmp_path / "in"))
        arriving = running_loss_stream(spark.readStream.schema(LOG).parquet(str(tmp_path / "in")))
        query = arriving.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "at"))
        query.outputMode(mode).trigger(availableNow=True).start().awaitTermination()
        found = spark.read.parquet(str(tmp_path / "out"))
    return found


def test_running_loss_of_a_stream(spark, tmp_path):
    draw = random.Random(5)
    rows = [(r, e, s, b, draw.choice([None, draw.random()])) for r in ("a", None) for e in (1, None) for s in ("train", "validation") for b in range(30)]
    parts = [[r for r in rows if low <= r[3] < low + 10] for low in (0, 10, 20)]
    for part in parts:
        draw.shuffle(part)
    got = run_stream(spark, parts, tmp_path)
    assert got.where("late").count() == 0
    want = losses.running_loss(spark.createDataFrame(rows, LOG)).withColumn("avg_so_far", F.round("avg_so_far", 9))
    columns = [*LOG.replace(",", "").split()[::2], "avg_so_far"]
    rounded = got.withColumn("avg_so_far", F.round("avg_so_far", 9)).select(columns)
    assert sorted(map(str, rounded.collect())) == sorted(map(str, want.select(columns).collect()))


def test_late_and_repeated_batches(spark, tmp_path):
    one = lambda b, loss: ("a", 1, "train", b, loss)
    parts = [[one(1, 1.0), one(3, 3.0), one(3, 2.0)], [one(2, 9.0), one(3, 9.0), one(None, 9.0)], [one(4, None), one(5, 6.0)]]
    got = {(r.batch_num, r.loss): (r.avg_so_far, r.late) for r in run_stream(spark, parts, tmp_path).collect()}
    assert got == {
        (1, 1.0): (1.0, False), (3, 2.0): (1.5, False), (3, 3.0): (None, True), (2, 9.0): (None, True), (3, 9.0): (None, True),
        (None, 9.0): (None, True), (4, None): (1.5, False), (5, 6.0): (3.0, False),
    }


def test_epoch_losses_of_a_stream(spark):
    draw = random.Random(6)
    rows = [("ab"[b % 2], 1 + b % 3, draw.choice(["train", "validation"]), b, draw.random()) for b in range(200)]
    log = spark.createDataFrame(rows, LOG)
    rounded = lambda df: sorted(tuple(x if i < 2 else round(x, 9) for i, x in enumerate(r)) for r in df.collect())
    assert rounded(epoch_losses_stream(log)) == rounded(losses.epoch_losses(log))


@pytest.mark.parametrize("kind", [CHAR_BPE, BYTE_BPE])
def test_pieces_joined_are_the_decoded_text(spark, kind):
    made = tokenizer(spark, SF_DIR, kind)
    ids = encode.with_ids(read_documents(spark, SF_DIR), made)
    # Ids in any order: broken characters, special and unknown ids among them.
    draw = random.Random(1)
    mixed = [[draw.choice([draw.randrange(300), draw.randrange(2_000), -1, 10**6, None]) for _ in range(draw.randrange(30))] for _ in range(500)]
    rows = ids.select("raw_ids").unionByName(spark.createDataFrame([(m,) for m in [*mixed, None]], "raw_ids array<int>"))
    found = decode.with_text(decode.with_pieces(rows, made), made).collect()
    for r in found:
        assert (r.pieces is None) == (r.raw_ids is None)
        if r.raw_ids is not None:
            assert len(r.pieces) == len(r.raw_ids) and "".join(r.pieces) == r.decoded


def test_bytes_settle_as_spark_reads_them(spark):
    draw, shown = random.Random(2), shown_bytes()
    texts = ["".join(shown[draw.choice([65, 0xC3, 0xA9, 0xE2, 0x82, 0xAC, 0xF0, 0x9F, 0x98, 0x80, 0xFF, draw.randrange(256)])] for _ in range(12)) for _ in range(2_000)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", characters_to_text(F.col("t")).alias("d"))
    for r in rows.collect():
        settling = decode.Settling(BYTE_BPE)
        assert "".join(settling.push(c) for c in r.t) + settling.end() == r.d


def test_settled_text_is_never_taken_back():
    settling = decode.Settling(CHAR_BPE)
    assert [settling.push(t) for t in ("a", "b</w>", None, "c</w>")] == ["a", "b", "", " c"] and settling.end() == ""
    settling, shown = decode.Settling(BYTE_BPE), shown_bytes()
    assert [settling.push(shown[b]) for b in "é".encode()] == ["", "é"]
    assert settling.push(shown[0xE2]) == "" and settling.end() == "�"


def test_json_lines_that_do_not_fit(spark, tmp_path):
    good = [{"doc_id": i, "text": f"text {i} é", "other": [i]} for i in range(200)]
    bad = {5: '{"doc_id": 5, "te', 50: '{"doc_id": "x", "text": "t"}', 51: "[1]", 52: '[{"doc_id": 1}]', 120: "plain", 199: "7"}
    blank = {60, 61}
    lines = [bad.get(i, "  " if i in blank else json.dumps(g)) for i, g in enumerate(good)]
    (tmp_path / "a.jsonl").write_text("\n".join(lines) + "\n")
    (tmp_path / "b.jsonl").write_bytes(b'{"doc_id": 1000}\n{"text": "\xff"}\n')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        rows, aside = read_json_lines(spark, str(tmp_path), "doc_id long, text string")
        assert rows.rdd.getNumPartitions() > 5
        got, wrong = rows.collect(), aside.collect()
        texts, broken = (x.collect() for x in read_text_lines(spark, str(tmp_path)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = {(g["doc_id"], g["text"]) for i, g in enumerate(good) if i not in bad and i not in blank}
    assert {tuple(r) for r in got} == want | {(1000, None)}
    placed = {(r.file.rsplit("/", 1)[1], r.line): r.raw for r in wrong}
    assert {k for k in placed if k[0] == "b.jsonl"} == {("b.jsonl", 2)} and len(wrong) == 7
    assert {k[1]: v for k, v in placed.items() if k[0] == "a.jsonl"} == {i + 1: v for i, v in bad.items()}
    assert {(r.line, r.text) for r in texts if r.file.endswith("a.jsonl")} == set(enumerate(lines, 1))
    assert [(r.file[-7:], r.line) for r in broken] == [("b.jsonl", 2)]


def test_json_lines_need_the_text_and_may_be_empty(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text("")
    with pytest.raises(ValueError, match="no column 'text'"):
        read_json_lines(spark, str(tmp_path), "doc_id long")
    rows, aside = read_json_lines(spark, str(tmp_path), "text string")
    assert rows.count() == aside.count() == 0
