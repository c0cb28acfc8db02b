"""Every operator over whole test tables."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from checks.sql import LARGE_VOCAB_SIZE, VOCAB_SIZE
from corpusloom.functions.sequences import INTS
from corpusloom.functions.text import BYTE_BPE, CHAR_BPE, char_words
from corpusloom.operators import decode as decoding
from corpusloom.operators import losses, scores, scores_long, sequences, splits, stats, user_functions, words
from corpusloom.operators.bpe import train_bpe
from corpusloom.operators.encode import encode, with_ids
from corpusloom.plans.append import append_dataset, read_appended
from corpusloom.plans.build import model_ready
from corpusloom.plans.epochs import store_epoch, stored_batches
from corpusloom.plans.prepare import prepare_corpus
from corpusloom.plans.train import train_on_corpus
from corpusloom.shared import new_path
from corpusloom.sources import texts as sources
from corpusloom.sources.tokenizer_json import read_tokenizer_json, write_tokenizer_json
from corpusloom.sources.tokenizers import Tokenizer, load_tokenizer, save_tokenizer, tokenizer_name
from corpusloom.streaming.losses import running_loss_stream as losses_of_stream
from corpusloom.streaming.tokenize import tokenize_stream

Query = Callable[[SparkSession, str], DataFrame]

# Only for the query whose feature they are, and its counts.
CAPS = {"train": 300, "validation": 80}
BATCH = 32

_stored: dict[tuple[str, str, str, int], str] = {}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.spread(sources.read_texts(spark, f"{sf_dir}/documents.parquet"))


def split_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.split_train_validation(documents(spark, sf_dir), "doc_id")


def tokenizer(spark: SparkSession, sf_dir: str, kind: str = CHAR_BPE, size: int = LARGE_VOCAB_SIZE) -> Tokenizer:
    """Trained on all documents, once for each session and folder."""
    at = (spark.sparkContext.applicationId, sf_dir, kind, size)
    if at not in _stored:
        path = new_path(spark, "tokenizer")
        save_tokenizer(train_bpe(documents(spark, sf_dir), kind, size), path)
        _stored[at] = path
    return load_tokenizer(spark, _stored[at])


def _text(ids: str) -> Column:
    return F.array_join(F.col(ids).cast("array<string>"), " ").alias(ids)


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _stand_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word lengths for token ids, so that SQL can make the same ids."""
    lengths = F.transform(char_words(F.col("text")), lambda w: F.length(w)).cast(INTS)
    return split_documents(spark, sf_dir).withColumn("raw_ids", lengths)


def _sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.model_sequences(_stand_in(spark, sf_dir))


def split_counts(spark, sf_dir):
    return stats.split_counts(split_documents(spark, sf_dir))


def filter_length(spark, sf_dir):
    return splits.filter_length(documents(spark, sf_dir)).select("doc_id", "text")


def split_exact(spark, sf_dir):
    return split_documents(spark, sf_dir).select("doc_id", "split")


def split_conversations(spark, sf_dir):
    turns = sources.read_texts(spark, f"{sf_dir}/conversations.parquet")
    key = ["conv_id", "turn"]
    return splits.split_train_validation(turns, key).select(*key, "split")


def sample_capped(spark, sf_dir):
    prepared = prepare_corpus(documents(spark, sf_dir), "doc_id", max_length=splits.MAX_TEXT_LENGTH, caps=CAPS)
    return prepared.select("split", "doc_id")


def split_counts_capped(spark, sf_dir):
    return stats.split_counts(split_documents(spark, sf_dir), caps=CAPS)


def quick_sample(spark, sf_dir):
    return splits.quick_sample(split_documents(spark, sf_dir), "doc_id").select("split", "doc_id")


def random_example(spark, sf_dir):
    train = split_documents(spark, sf_dir).where("split = 'train'")
    return splits.random_example(train, "doc_id", seed=7).select("doc_id", "text")


def model_sequences(spark, sf_dir):
    columns = sequences.select_model_columns(_sequences(spark, sf_dir), "doc_id")
    return columns.select("split", "doc_id", _text("input_ids"), _text("output_ids"))


def batches_padded(spark, sf_dir):
    path = new_path(spark, "dataset")
    sources.write_dataset(_sequences(spark, sf_dir), path)
    batches = sequences.padded_batches(sources.read_dataset(spark, path), "doc_id", BATCH)
    return batches.select("split", "batch_id", "doc_id", _text("x"), _text("y"))


def batch_counts(spark, sf_dir):
    return stats.batch_counts(split_documents(spark, sf_dir), BATCH)


def token_budget(spark, sf_dir):
    budget = stats.token_budget(_sequences(spark, sf_dir), epochs=3)
    return _rounded(budget, "budget_millions", "parameters_millions")


def token_length_stats(spark, sf_dir):
    return stats.token_length_range(_sequences(spark, sf_dir))


_METRICS = ("avg_tokens_per_sentence", "avg_chars_per_sentence", "compression_ratio")


def tokenizer_eval(spark, sf_dir):
    return _rounded(stats.evaluate_tokenizer(_stand_in(spark, sf_dir)), *_METRICS)


def corpus_chars(spark, sf_dir):
    return stats.corpus_characters(documents(spark, sf_dir))


def write_read_back(spark, sf_dir):
    rows = _sequences(spark, sf_dir)
    parts = {s: rows.where(F.col("split") == s).drop("split") for s in splits.SPLITS}
    path = new_path(spark, "dataset")
    sources.write_dataset(splits.combine_splits(parts), path)
    return sources.read_dataset(spark, path).select("split", "doc_id", _text("ids"))


def text_export(spark, sf_dir):
    path = new_path(spark, "text")
    sources.write_text(documents(spark, sf_dir), path)
    return spark.read.text(path, lineSep="\n").select(F.col("value").alias("line"))


def word_counts_char(spark, sf_dir):
    return words.word_counts(documents(spark, sf_dir), CHAR_BPE)


def word_counts_byte(spark, sf_dir):
    return words.word_counts(documents(spark, sf_dir), BYTE_BPE)


def bpe_pair_counts(spark, sf_dir):
    return words.pair_counts(word_counts_char(spark, sf_dir), CHAR_BPE)


def bpe_pair_counts_byte(spark, sf_dir):
    return words.pair_counts(word_counts_byte(spark, sf_dir), BYTE_BPE)


def bpe_train(spark, sf_dir):
    return tokenizer(spark, sf_dir, CHAR_BPE, VOCAB_SIZE).merges


def bpe_train_byte(spark, sf_dir):
    return tokenizer(spark, sf_dir, BYTE_BPE, VOCAB_SIZE).merges


def bpe_train_2000(spark, sf_dir):
    return tokenizer(spark, sf_dir, CHAR_BPE).merges


def bpe_train_byte_2000(spark, sf_dir):
    return tokenizer(spark, sf_dir, BYTE_BPE).merges


def bpe_vocab(spark, sf_dir):
    return tokenizer(spark, sf_dir, CHAR_BPE).vocab


def bpe_vocab_byte(spark, sf_dir):
    return tokenizer(spark, sf_dir, BYTE_BPE).vocab


def vocab_specials(spark, sf_dir):
    trained = tokenizer(spark, sf_dir)
    size = F.lit(decoding.vocabulary_size(trained)).cast("long")
    return decoding.special_entries(trained).withColumn("vocab_size", size)


def special_ids(spark, sf_dir):
    found = decoding.token_ids(tokenizer(spark, sf_dir), ["<|pad|>", "<|end_of_text|>", "<unk>"])
    return found.toDF("pad_id", "eot_id", "unk_id")


def eot_id(spark, sf_dir):
    return decoding.eot_id(tokenizer(spark, sf_dir))


def tokenizer_saved(spark, sf_dir):
    path = new_path(spark, "tokenizer")
    save_tokenizer(tokenizer(spark, sf_dir, BYTE_BPE), path)
    return load_tokenizer(spark, path).merges


def tokenizer_json(spark, sf_dir):
    path = new_path(spark, "tokenizer-json")
    write_tokenizer_json(tokenizer(spark, sf_dir), path)
    return read_tokenizer_json(spark, path).merges


def _encoded(spark, sf_dir, kind):
    return encode(documents(spark, sf_dir), tokenizer(spark, sf_dir, kind), "doc_id")


def encode_char(spark, sf_dir):
    return _encoded(spark, sf_dir, CHAR_BPE).select("doc_id", _text("raw_ids"))


def encode_byte(spark, sf_dir):
    return _encoded(spark, sf_dir, BYTE_BPE).select("doc_id", _text("raw_ids"))


def encode_benchmark(spark, sf_dir):
    held_out = sources.read_texts(spark, f"{sf_dir}/benchmark.parquet")
    held_out = held_out.withColumnRenamed("item_id", "doc_id")
    ids = encode(held_out, tokenizer(spark, sf_dir), "doc_id", on_unknown="unk")
    return ids.select("doc_id", _text("raw_ids"))


def encode_stream(spark, sf_dir):
    schema = spark.read.parquet(f"{sf_dir}/documents.parquet").schema
    # One file or a folder of files: a stream reads a single file by a pattern only.
    arriving = spark.readStream.schema(schema).parquet(f"{sf_dir}/documents.parque[t]")
    path = new_path(spark, "stream")
    query = tokenize_stream(arriving, tokenizer(spark, sf_dir), path, new_path(spark, "progress"))
    query.awaitTermination()
    return spark.read.parquet(path).select("doc_id", _text("raw_ids"))


def _decoded(spark, sf_dir, kind):
    ids = _encoded(spark, sf_dir, kind)
    return decoding.decode(ids, tokenizer(spark, sf_dir, kind), "doc_id")


def decode_char(spark, sf_dir):
    return _decoded(spark, sf_dir, CHAR_BPE)


def decode_byte(spark, sf_dir):
    return _decoded(spark, sf_dir, BYTE_BPE)


def _round_trip(spark, sf_dir, kind):
    made = tokenizer(spark, sf_dir, kind)
    decoded = decoding.with_text(with_ids(split_documents(spark, sf_dir), made), made)
    return _rounded(decoding.round_trip(decoded), "share_same")


def encode_specials(spark, sf_dir):
    """Special tokens inside texts stay whole."""
    marked = F.concat(F.lit("<|start_of_text|>"), "text", F.lit("<|end_of_text|>"))
    texts = documents(spark, sf_dir).withColumn("text", marked)
    made = tokenizer(spark, sf_dir)
    decoded = decoding.with_text(with_ids(texts, made), made)
    return decoded.select("doc_id", _text("raw_ids"), "decoded")


def stored_names(spark, sf_dir):
    size = decoding.vocabulary_size(tokenizer(spark, sf_dir))
    names = (tokenizer_name(size, CHAR_BPE, "v1"), sources.dataset_name("corpus", "v1", size))
    return spark.createDataFrame([names], "tokenizer string, dataset string")


def round_trip(spark, sf_dir):
    return _round_trip(spark, sf_dir, CHAR_BPE)


def round_trip_byte(spark, sf_dir):
    return _round_trip(spark, sf_dir, BYTE_BPE)


def train_metrics(spark, sf_dir):
    trained = train_on_corpus(
        documents(spark, sf_dir), "doc_id", new_path(spark, "trained"), "v1",
        vocab_size=LARGE_VOCAB_SIZE, on_unknown="unk",
    )
    return _rounded(trained.metrics, *_METRICS)


def model_ready_dataset(spark, sf_dir):
    rows = model_ready(documents(spark, sf_dir), tokenizer(spark, sf_dir), "doc_id")
    return rows.select(
        "split", "doc_id", "lang", "source", _text("input_ids"), _text("output_ids")
    )


def _scores(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return rows.select(
        "vec_id", F.col("embedding").cast("array<double>").alias("scores"),
        F.col("label").alias("target"),
    )


def softmax_scores(spark, sf_dir):
    return _rounded(scores.candidates(_scores(spark, sf_dir), "vec_id", 0.7), "prob")


def topk_candidates(spark, sf_dir):
    kept = scores.candidates(_scores(spark, sf_dir), "vec_id", 0.2, top_k=5, top_p=0.9)
    return _rounded(kept, "prob")


def topp_candidates(spark, sf_dir):
    return _rounded(scores.candidates(_scores(spark, sf_dir), "vec_id", 0.2, top_p=0.9), "prob")


def seeded_draw(spark, sf_dir):
    return scores.seeded_draw(_scores(spark, sf_dir), "vec_id", 0.2, top_p=0.9)


def cross_entropy(spark, sf_dir):
    return _rounded(scores.cross_entropy(_scores(spark, sf_dir)), "loss")


def _long_scores(spark, sf_dir):
    return _scores(spark, sf_dir).select("vec_id", F.posexplode("scores").alias("token_id", "score"))


def softmax_long(spark, sf_dir):
    return _rounded(scores_long.candidates_long(_long_scores(spark, sf_dir), "vec_id", 0.7), "prob")


def topk_long(spark, sf_dir):
    return _rounded(scores_long.candidates_long(_long_scores(spark, sf_dir), "vec_id", 0.2, top_k=5, top_p=0.9), "prob")


def topp_long(spark, sf_dir):
    return _rounded(scores_long.candidates_long(_long_scores(spark, sf_dir), "vec_id", 0.2, top_p=0.9), "prob")


def draw_long(spark, sf_dir):
    return scores_long.seeded_draw_long(_long_scores(spark, sf_dir), "vec_id", 0.2, top_p=0.9)


def cross_entropy_long(spark, sf_dir):
    targets = _scores(spark, sf_dir).select("vec_id", "target")
    return _rounded(scores_long.cross_entropy_long(_long_scores(spark, sf_dir), targets, "vec_id"), "loss")


def _lines(row: dict) -> dict:
    return {"first_line": row["text"].split("\n")[0], "n_lines": row["text"].count("\n") + 1}


def user_map_rows(spark, sf_dir):
    found = user_functions.map_rows(documents(spark, sf_dir), _lines, ["text"], "first_line string, n_lines int", "doc_id")
    return found.select("doc_id", "first_line", "n_lines")


def _is_short(texts: pa.Array) -> pa.Array:
    return pc.less(pc.utf8_length(texts), splits.MAX_TEXT_LENGTH)


def user_filter_columns(spark, sf_dir):
    return user_functions.filter_columns(documents(spark, sf_dir), _is_short, ["text"]).select("doc_id", "text")


def _pad(batch: pa.Table) -> pa.Table:
    """One end mark if there is room, then 0; outputs only 0."""
    inputs, outputs = batch.column("input_ids").to_pylist(), batch.column("output_ids").to_pylist()
    width = max(map(len, inputs))
    x = [(i + [2] + [0] * width)[:width] for i in inputs]
    y = [o + [0] * (width - len(o)) for o in outputs]
    return pa.table({"doc_id": batch.column("doc_id"), "x": x, "y": y})


def user_map_batches(spark, sf_dir):
    rows = sequences.select_model_columns(_sequences(spark, sf_dir), "doc_id")
    found = user_functions.map_batches(rows, _pad, "doc_id", "doc_id long, x array<int>, y array<int>", BATCH)
    return found.select("split", "batch_id", "doc_id", _text("x"), _text("y"))


def loss_log(spark, sf_dir):
    """Events as a loss log: batch numbers grow with time."""
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.col("event_type").alias("run"),
        F.day("ts").alias("epoch"),
        F.when(F.col("user_id") % 5 == 0, "validation").otherwise("train").alias("split"),
        F.col("event_id").alias("batch_num"),
        F.col("value").alias("loss"),
    )


def _rounded_means(df: DataFrame, *columns: str) -> DataFrame:
    """Losses have two decimals, so a mean can lie exactly between two rounded values."""
    return df.withColumns({c: F.round(F.col(c) + 1e-9, 6) for c in columns})


def epoch_losses(spark, sf_dir):
    means = losses.epoch_losses(loss_log(spark, sf_dir))
    return _rounded_means(means, "train_loss", "val_loss", "val_train_difference")


def running_loss(spark, sf_dir):
    running = losses.running_loss(loss_log(spark, sf_dir), chunk=100)
    return _rounded_means(running, "avg_so_far").drop("loss")


def global_step(spark, sf_dir):
    log = loss_log(spark, sf_dir)
    sizes = log.groupBy("run", "epoch", "split").agg(F.count(F.lit(1)).alias("n"))
    batches = sizes.groupBy("run", "split").agg(F.max("n").alias("n_batches"))
    return losses.with_global_step(log, batches).drop("loss")


def running_loss_stream(spark, sf_dir):
    """The log arrives in three parts; the query goes on from its checkpoint after each."""
    log, arriving, path, progress = loss_log(spark, sf_dir), *(new_path(spark, n) for n in ("log", "running", "progress"))
    last = log.agg(F.max("batch_num")).first()[0] or 0
    third = F.floor(F.col("batch_num") * 3 / F.lit(last + 1))
    for part in range(3):
        log.where(third == part).write.mode("append").parquet(arriving)
        running = losses_of_stream(spark.readStream.schema(log.schema).parquet(arriving))
        writer = running.writeStream.format("parquet").option("path", path).option("checkpointLocation", progress)
        writer.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    found = spark.read.parquet(path).where("not late")
    return _rounded_means(found, "avg_so_far").drop("loss", "late")


def split_appended(spark, sf_dir):
    """The documents come in three loads, each with all before it."""
    path = new_path(spark, "growing")
    for load in range(3):
        so_far = documents(spark, sf_dir).where(F.col("doc_id") % 3 <= load)
        append_dataset(so_far, tokenizer(spark, sf_dir), "doc_id", path)
    decoded = decoding.with_text(read_appended(spark, path), tokenizer(spark, sf_dir))
    return decoded.select("doc_id", "added", "split", "decoded")


def batches_entered(spark, sf_dir):
    """The training epoch from its second batch on."""
    path = new_path(spark, "epoch")
    store_epoch(_sequences(spark, sf_dir), "doc_id", path, rows_per_file=BATCH * 8)
    batches = stored_batches(spark, path, "doc_id", splits.TRAIN, first=1, batch_size=BATCH)
    return batches.select("split", "batch_id", "doc_id", _text("x"), _text("y"))


def _pieces(spark, sf_dir, kind):
    made = tokenizer(spark, sf_dir, kind)
    found = decoding.with_pieces(_encoded(spark, sf_dir, kind), made)
    return found.select("doc_id", F.array_join("pieces", "").alias("decoded"))


def decode_pieces(spark, sf_dir):
    return _pieces(spark, sf_dir, CHAR_BPE)


def decode_pieces_byte(spark, sf_dir):
    return _pieces(spark, sf_dir, BYTE_BPE)


def json_lines(spark, sf_dir):
    """The documents as JSON lines, some cut off and some with a word for a number; those come back as they are."""
    path = new_path(spark, "json")
    cut = F.concat(F.lit('{"doc_id":'), "doc_id", F.lit(',"te'))
    misfit = F.concat(F.lit('{"doc_id":"x'), "doc_id", F.lit('"}'))
    line = F.to_json(F.struct("doc_id", "lang", "text"))
    line = F.when(F.col("doc_id") % 7 == 0, cut).when(F.col("doc_id") % 11 == 0, misfit).otherwise(line)
    documents(spark, sf_dir).select(line.alias("value")).write.text(path, lineSep="\n")
    rows, aside = sources.read_json_lines(spark, path, "doc_id long, lang string, text string")
    return rows.unionByName(aside.select("raw"), allowMissingColumns=True)


def all_queries() -> dict[str, Query]:
    return {
        "split_counts": split_counts,
        "filter_length": filter_length,
        "split_exact": split_exact,
        "split_conversations": split_conversations,
        "sample_capped": sample_capped,
        "split_counts_capped": split_counts_capped,
        "quick_sample": quick_sample,
        "random_example": random_example,
        "model_sequences": model_sequences,
        "batches_padded": batches_padded,
        "batch_counts": batch_counts,
        "token_budget": token_budget,
        "token_length_stats": token_length_stats,
        "tokenizer_eval": tokenizer_eval,
        "corpus_chars": corpus_chars,
        "write_read_back": write_read_back,
        "text_export": text_export,
        "word_counts_char": word_counts_char,
        "word_counts_byte": word_counts_byte,
        "bpe_pair_counts": bpe_pair_counts,
        "bpe_pair_counts_byte": bpe_pair_counts_byte,
        "bpe_train": bpe_train,
        "bpe_train_byte": bpe_train_byte,
        "bpe_train_2000": bpe_train_2000,
        "bpe_train_byte_2000": bpe_train_byte_2000,
        "bpe_vocab": bpe_vocab,
        "bpe_vocab_byte": bpe_vocab_byte,
        "vocab_specials": vocab_specials,
        "special_ids": special_ids,
        "eot_id": eot_id,
        "tokenizer_saved": tokenizer_saved,
        "tokenizer_json": tokenizer_json,
        "encode": encode_char,
        "encode_byte": encode_byte,
        "encode_benchmark": encode_benchmark,
        "encode_stream": encode_stream,
        "encode_specials": encode_specials,
        "stored_names": stored_names,
        "decode": decode_char,
        "decode_byte": decode_byte,
        "round_trip": round_trip,
        "round_trip_byte": round_trip_byte,
        "train_metrics": train_metrics,
        "model_ready": model_ready_dataset,
        "softmax_scores": softmax_scores,
        "topk_candidates": topk_candidates,
        "topp_candidates": topp_candidates,
        "seeded_draw": seeded_draw,
        "cross_entropy": cross_entropy,
        "softmax_long": softmax_long,
        "topk_long": topk_long,
        "topp_long": topp_long,
        "draw_long": draw_long,
        "cross_entropy_long": cross_entropy_long,
        "user_map_rows": user_map_rows,
        "user_filter_columns": user_filter_columns,
        "user_map_batches": user_map_batches,
        "epoch_losses": epoch_losses,
        "running_loss": running_loss,
        "global_step": global_step,
        "running_loss_stream": running_loss_stream,
        "split_appended": split_appended,
        "batches_entered": batches_entered,
        "decode_pieces": decode_pieces,
        "decode_pieces_byte": decode_pieces_byte,
        "json_lines": json_lines,
    }
