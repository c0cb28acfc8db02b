"""Tokenizers as JSON text, in the published format of the public library."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusloom.functions.text import BYTE_BPE, CHAR_BPE, WORD_SUFFIX
from corpusloom.sources.tokenizers import Tokenizer

_SCHEMA = (
    "added_tokens array<struct<id: int, content: string, special: boolean>>,"
    "model struct<end_of_word_suffix: string, vocab: map<string, int>, merges: array<string>>"
)

# How the format describes each kind.
_BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": True}
_STEPS = {
    CHAR_BPE: {
        "normalizer": {
            "type": "BertNormalizer",
            "clean_text": True,
            "handle_chinese_chars": True,
            "strip_accents": None,
            "lowercase": False,
        },
        "pre_tokenizer": {"type": "BertPreTokenizer"},
        "decoder": {"type": "BPEDecoder", "suffix": WORD_SUFFIX},
    },
    BYTE_BPE: {"normalizer": None, "pre_tokenizer": _BYTE_LEVEL, "decoder": _BYTE_LEVEL},
}


# What must be said, or left out, for the ids to be those of the file's own library.
_PLAIN_MODEL = {"dropout": None, "continuing_subword_prefix": None, "fuse_unk": False, "byte_fallback": False, "ignore_merges": False}
_UNKNOWN = (None, "<unk>", "<|unk|>")


def _refuse(what: str, found: object) -> None:
    raise ValueError(f"tokenizer file: {what} is {found!r}, which is not supported")


def _supported_kind(spec: dict[str, object]) -> str:
    """The kind that a file describes; a clear error for anything that would give other ids."""
    model, suffix = spec["model"], spec["model"].get("end_of_word_suffix")
    if model.get("type") not in (None, "BPE"):
        _refuse("model.type", model["type"])
    if suffix not in (None, "", WORD_SUFFIX):
        _refuse("model.end_of_word_suffix", suffix)
    for name, plain in _PLAIN_MODEL.items():
        if (model.get(name) or None) != (plain or None):
            _refuse(f"model.{name}", model[name])
    if model.get("unk_token") not in _UNKNOWN:
        _refuse("model.unk_token", model["unk_token"])
    kind = CHAR_BPE if suffix else BYTE_BPE
    for step in ("normalizer", "pre_tokenizer"):
        wanted, found = _STEPS[kind][step], spec[step]
        if wanted is None and found is None:
            continue
        if wanted is None or found is None or found.get("type") != wanted["type"]:
            _refuse(step, found and found.get("type"))
        for name, value in wanted.items():
            # Where offsets are trimmed, ids stay the same; options left out have these values.
            if name != "trim_offsets" and (found.get(name, value) or None) != (value or None):
                _refuse(f"{step}.{name}", found[name])
    return kind


def _described(files: DataFrame) -> dict[str, object]:
    """The file's steps and its model's options, without the vocabulary."""
    options = ["type", "end_of_word_suffix", "unk_token", *_PLAIN_MODEL]
    paths = ["$.normalizer", "$.pre_tokenizer", *[f"$.model.{name}" for name in options]]
    row = files.select(*[F.get_json_object("value", p).alias(f"c{i}") for i, p in enumerate(paths)]).first()
    if row is None:
        raise ValueError("tokenizer file: nothing to read")

    def plain(text: str | None) -> object:
        return {"true": True, "false": False}.get(text, text)

    model = {name: plain(text) for name, text in zip(options, row[2:], strict=True)}
    return {"normalizer": row[0] and json.loads(row[0]), "pre_tokenizer": row[1] and json.loads(row[1]), "model": model}


def read_tokenizer_json(spark: SparkSession, path: str) -> Tokenizer:
    """A tokenizer file; its merges are pairs or, in older files, words with a space.

    Files of the two kinds that this library trains are read: byte-level with a leading space, and
    characters with a word suffix. Any other model, normaliser, pre-tokenizer or unknown token is refused.
    """
    files = spark.read.text(path, wholetext=True)
    kind = _supported_kind(_described(files))
    parsed = files.select(F.from_json("value", _SCHEMA).alias("t"))
    added = parsed.select(F.explode("t.added_tokens").alias("a")).select(
        F.col("a.content").alias("token"), F.col("a.id").alias("id"), F.col("a.special").alias("s")
    )
    known = parsed.select(F.explode("t.model.vocab").alias("token", "id"), F.lit(False).alias("s"))
    vocab = (
        known.unionByName(added)
        .groupBy("token", "id")
        .agg(F.max("s").alias("is_special"))
    )
    written = F.col("written")
    pair = F.when(written.startswith('["'), F.from_json(written, "array<string>")).otherwise(
        F.split(written, " ")
    )
    merges = (
        parsed.select(F.posexplode("t.model.merges").alias("rank", "written"))
        .select("rank", pair.alias("pair"))
        .select(
            "rank",
            F.col("pair")[0].alias("left"),
            F.col("pair")[1].alias("right"),
            F.concat(F.col("pair")[0], F.col("pair")[1]).alias("new_token"),
        )
    )
    return Tokenizer(kind, vocab, merges)


def tokenizer_json(tokenizer: Tokenizer) -> DataFrame:
    """One row ``value``: the tokenizer as JSON text. Its size is that of the vocabulary."""
    entry = F.struct("id", "token")
    tokens = tokenizer.vocab.agg(
        F.array_sort(F.collect_list(entry)).alias("vocab"),
        F.array_sort(F.collect_list(F.when(F.col("is_special"), entry))).alias("special"),
    )
    merges = tokenizer.merges.agg(
        F.array_sort(F.collect_list(F.struct("rank", "left", "right"))).alias("merges")
    )

    def added(token: Column) -> Column:
        plain = {"single_word": False, "lstrip": False, "rstrip": False, "normalized": False}
        flags = [F.lit(v).alias(k) for k, v in plain.items()]
        return F.struct(
            token["id"].alias("id"), token["token"].alias("content"), *flags, F.lit(True).alias("special")
        )

    model = F.struct(
        F.lit("BPE").alias("type"),
        F.lit("<unk>" if tokenizer.kind == CHAR_BPE else "<|unk|>").alias("unk_token"),
        F.lit(WORD_SUFFIX if tokenizer.kind == CHAR_BPE else None).alias("end_of_word_suffix"),
        F.map_from_entries(
            F.transform("vocab", lambda t: F.struct(t["token"], t["id"]))
        ).alias("vocab"),
        F.transform("merges", lambda m: F.array(m["left"], m["right"])).alias("merges"),
    )
    # One row on either side.
    row = tokens.withColumn("one", F.lit(1)).join(merges.withColumn("one", F.lit(1)), "one")
    parts = row.select(
        F.to_json(F.transform("special", added)).alias("added"), F.to_json(model).alias("model")
    )
    steps = json.dumps({"version": "1.0", "truncation": None, "padding": None, **_STEPS[tokenizer.kind],
                        "post_processor": None})
    return parts.select(
        F.concat(
            F.lit(steps[:-1] + ', "added_tokens": '), "added", F.lit(', "model": '), "model", F.lit("}")
        ).alias("value")
    )


def write_tokenizer_json(tokenizer: Tokenizer, path: str, mode: str = "error") -> None:
    """One text file in the folder ``path``."""
    tokenizer_json(tokenizer).coalesce(1).write.mode(mode).text(path)
