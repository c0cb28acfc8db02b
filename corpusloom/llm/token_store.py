"""Token ids in binary files: one compressed frame for each document, one dictionary for all, an offset index."""

from __future__ import annotations

import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from tokenizers import Tokenizer

from corpusloom.functions.text import shown_bytes
from corpusloom.llm.tables import input_columns

MAGIC = b"CLIDS\x00\x00\x01"
HEADER = len(MAGIC) + 32
# The dictionary is trained on up to so many documents, and so many bytes of each.
SAMPLE_DOCUMENTS, SAMPLE_BYTES, DICTIONARY_BYTES = 1_000, 16_384, 65_536
LEVEL = 3
# Chunks a worker remembers, of some 200 bytes each, twice over; characters of texts encoded together.
CACHE_CHUNKS, GROUP_CHARACTERS = 300_000, 1 << 20
# Neighbouring frames are read together up to this size.
READ_BYTES = 8 << 20

# The pattern of byte-level pre-tokenizers cuts before a space that a visible character follows (not before one inside
# other white space), and between a letter or digit and one of these marks. `\\s` here is no narrower than there.
_CUT, _UNCUT = re.compile(r" (?=\S)"), re.compile(r" (?:\s|$)")
_MARKS = ".,:;!?*#$%&"
# Letters that every version of Unicode in use has as such.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_WORD_END = re.compile(f"[{_MARKS}](?<=[{_LETTERS}0-9][{_MARKS}])")
# Stands before a chunk that no space precedes; texts that hold it are encoded whole.
_BARE = "\0"
# A word, which is one piece to the pattern; a line end before it is one, too, and so is the mark before that.
_WORD = re.compile(f"[{_LETTERS}]+")
_LINE_END = re.compile(r"[.,]?\n|")


class ChunkEncoder:
    """Ids of texts, chunk by chunk, as little-endian unsigned 32-bit integers.

    A byte-level pre-tokenizer always cuts at the places above, so the library can encode chunks apart
    from their text; those seen before are remembered. A chunk that is one word of letters is one piece to the
    pre-tokenizer, so it goes to the library's model at once. Where a tokenizer or a text
    is not like that, whole texts are encoded.
    """

    def __init__(self, tokenizer_json: str):
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        spec = json.loads(tokenizer_json)
        cuts = spec.get("pre_tokenizer") or {}
        self.by_chunk = (
            cuts.get("type") == "ByteLevel" and not cuts.get("add_prefix_space") and cuts.get("use_regex", True)
            and not spec.get("normalizer") and not any(re.search(rf"[\s{_MARKS}]", t["content"]) for t in spec.get("added_tokens") or [])
        )
        # An added token is cut out of a word, too.
        self.by_word = self.by_chunk and not any(_WORD.fullmatch(t["content"]) for t in spec.get("added_tokens") or [])
        self.model = self.tokenizer.model
        self.shown = str.maketrans({chr(byte): mark for byte, mark in enumerate(shown_bytes())})
        self.bytes_of = [i.to_bytes(4, "little") for i in range(max(self.tokenizer.get_vocab().values(), default=-1) + 1)]
        self.begins = lru_cache(maxsize=8)(self.whole)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4").tobytes()

    def _word(self, word: str, space: str) -> bytes:
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.shown)
        return b"".join([self.bytes_of[token.id] for token in self.model.tokenize(space + word)])

    def _chunk(self, chunk: str) -> bytes:
        """Ids of a chunk that is not known, from the library."""
        if chunk[0] != _BARE:
            if self.by_word and (chunk.isascii() and chunk.isalpha() or _WORD.fullmatch(chunk)):
                return self._word(chunk, "\u0120")  # the space, as tokens show it
            return self.whole(" " + chunk)
        begin = _LINE_END.match(chunk, 1).end()
        if self.by_word and _WORD.fullmatch(chunk, begin):
            return self.begins(chunk[1:begin]) + self._word(chunk[begin:], "")
        return self.whole(chunk[1:])

    def _learn(self, missed: set[str]) -> dict[str, bytes]:
        """Ids of chunks that are not known: from the older memory, or from the library."""
        older, find = self.older.get, self._chunk
        # No chunk is without ids.
        fresh = {chunk: older(chunk) or find(chunk) for chunk in missed}
        if len(self.known) > CACHE_CHUNKS:
            # Chunks met again since the last change stay known, others go.
            self.older, self.known = self.known, {}
        self.known.update((chunk, ids) for chunk, ids in fresh.items() if len(chunk) <= 64)
        return fresh

    def _group(self, texts: list[str]) -> list[bytes]:
        whole: list[bytes | None] = []
        flat: list[str] = []
        sizes: list[int] = []
        for text in texts:
            if not text or not self.by_chunk or _BARE in text:
                whole.append(self.whole(text) if text else b"")
                continue
            marked = _WORD_END.sub(" " + _BARE + r"\g<0>", text)
            chunks = _CUT.split(marked) if _UNCUT.search(marked) else marked.split(" ")
            # Nothing, or no space, precedes the first.
            if chunks[0]:
                chunks[0] = _BARE + chunks[0]
            else:
                del chunks[0]
            whole.append(None)
            sizes.append(len(chunks))
            flat += chunks
        ids = list(map(self.known.get, flat))
        missed = [at for at, i in enumerate(ids) if i is None]
        if missed:
            fresh = self._learn({flat[at] for at in missed})
            for at in missed:
                ids[at] = fresh[flat[at]]
        out, low, of = [], 0, iter(sizes)
        for done in whole:
            if done is None:
                high = low + next(of)
                done, low = b"".join(ids[low:high]), high
            out.append(done)
        return out

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Ids of each text, in order; null as empty. A group of texts at a time is held as chunks."""
        group, size = [], 0
        for text in texts:
            group.append(text or "")
            size += len(group[-1])
            if size > GROUP_CHARACTERS:
                yield from self._group(group)
                group, size = [], 0
        yield from self._group(group)

    def encode(self, text: str | None) -> bytes:
        return next(self.encode_all([text]))


@lru_cache(maxsize=1)
def _encoder(tokenizer_json: str) -> ChunkEncoder:
    return ChunkEncoder(tokenizer_json)


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A zstandard dictionary; where samples are too few to train one, their last bytes; empty for none."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes() if samples else b""
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _dictionary(content: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(content) if content else None


def _samples(rows: DataFrame, tokenizer_json: str, end_id: int) -> list[bytes]:
    """Serialized ids of a bounded sample: the documents whose hashed keys are smallest."""
    chosen = rows.select("id").orderBy(F.xxhash64("id"), "id").limit(SAMPLE_DOCUMENTS)
    chosen = chosen.distinct().withColumnRenamed("id", "s_id")
    texts = rows.join(F.broadcast(chosen), F.col("id").eqNullSafe(F.col("s_id"))).select("text").limit(SAMPLE_DOCUMENTS)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, end = _encoder(tokenizer_json), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            yield pd.DataFrame({"ids": [(ids + end)[:SAMPLE_BYTES] for ids in encoder.encode_all(batch["text"])]})

    return sorted(bytes(r.ids) for r in texts.mapInPandas(run, "ids binary").collect())


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


def write_ids(docs: DataFrame, tokenizer_path: str, path: str, key: str = "doc_id", text: str = "text", end_id: int = 0) -> None:
    """Encode all texts and write their ids, in ascending order of the key, under ``path``.

    ``files/*.ids``: the magic bytes, the SHA-256 of the dictionary, then a zstandard frame for each
    document, of its ids and ``end_id`` as little-endian unsigned 32-bit integers. ``index`` (Parquet): key,
    part, file, offset and length of the frame, number of ids, and ids before it in the file. ``parts``: ids before
    each file. ``dictionary``: the dictionary and its hash. ``path`` is a folder that all executors reach, local or
    in any store pyarrow opens.

    A task that runs again writes a new file; the index names only files of tasks that ended. Null texts are
    empty; null keys come first; equal keys are ordered by a hash of the text and dealt to several files by it. An empty
    table gives an index without rows. Texts of any length are encoded whole, one frame each. The dictionary is fitted on a
    bounded sample: ``SAMPLE_DOCUMENTS`` documents, ``SAMPLE_BYTES`` of the ids of each. Only the two named columns are read,
    whatever others are called.
    """
    spark, tokenizer_json = docs.sparkSession, Path(tokenizer_path).read_text()
    rows = input_columns(docs, id=key, text=text)
    content = train_dictionary(_samples(rows, tokenizer_json, end_id))
    digest = hashlib.sha256(content).digest()
    spark.createDataFrame([(digest.hex(), bytearray(content))], "hash string, dictionary binary").write.parquet(f"{path}/dictionary")

    schema = T.StructType([
        T.StructField("id", rows.schema["id"].dataType), T.StructField("part", T.IntegerType()), T.StructField("file", T.StringType()),
        T.StructField("offset", T.LongType()), T.StructField("n_bytes", T.LongType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("before", T.LongType()),
    ])
    folder = f"{path}/files"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, end = _encoder(tokenizer_json), np.array([end_id], "<u4").tobytes()
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(content))
        part = TaskContext.get().partitionId()
        name, file, offset, before = f"{part:06d}-{uuid.uuid4().hex}.ids", None, HEADER, 0
        try:
            for batch in batches:
                if file is None and len(batch):
                    system, at = _filesystem(folder)
                    system.create_dir(at, recursive=True)
                    file = system.open_output_stream(f"{at}/{name}")
                    file.write(MAGIC + digest)
                out = []
                for ids in encoder.encode_all(batch["text"]):
                    ids += end
                    frame = compressor.compress(ids)
                    file.write(frame)
                    out.append((part, name, offset, len(frame), len(ids) // 4, before))
                    offset, before = offset + len(frame), before + len(ids) // 4
                found = pd.DataFrame(out, columns=schema.names[1:])
                found.insert(0, "id", batch["id"].to_numpy())
                yield found
        finally:
            if file is not None:
                file.close()

    ordered = rows.withColumn("h", F.xxhash64("text")).repartitionByRange("id", "h").sortWithinPartitions("id", "h").drop("h")
    ordered.mapInPandas(run, schema).write.parquet(f"{path}/index")
    index = spark.read.schema(schema).parquet(f"{path}/index")
    # One row for each file.
    files = sorted(tuple(r) for r in index.groupBy("part", "file").agg(F.sum("n_tokens")).collect())
    ahead = np.concatenate([[0], np.cumsum([n for _, _, n in files], dtype="int64")])
    parts = [(part, file, int(start)) for (part, file, _), start in zip(files, ahead, strict=False)]
    spark.createDataFrame(parts, "part int, file string, start long").coalesce(1).write.parquet(f"{path}/parts")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """``id, file, offset, n_bytes, n_tokens, start`` for each document; ``start`` counts all ids before it."""
    index, parts = spark.read.parquet(f"{path}/index"), spark.read.parquet(f"{path}/parts")
    joined = index.join(F.broadcast(parts.select("file", "start")), "file")  # one short row a file
    return joined.withColumn("start", F.col("start") + F.col("before")).drop("part", "before")


def read_ids(index: DataFrame, path: str) -> DataFrame:
    """``id, start, ids`` of the documents in ``index``: all of :func:`read_index`, or some of its rows.

    ``ids`` is binary, as stored. Only frames of these documents are read, neighbours together. A file
    of another dictionary is an error.
    """
    spark = index.sparkSession
    row = spark.read.parquet(f"{path}/dictionary").first()
    content, digest = bytes(row.dictionary), bytes.fromhex(row.hash)
    if hashlib.sha256(content).digest() != digest:
        raise ValueError("the dictionary does not have its hash")
    schema = T.StructType([index.schema["id"], T.StructField("start", T.LongType()), T.StructField("ids", T.BinaryType())])
    folder = f"{path}/files"

    def frames(of_file: pd.DataFrame, file) -> Iterator[tuple[int, bytes]]:
        """Row labels and frames; one read for frames that lie side by side."""
        span: list[tuple[int, int, int]] = []

        def flush() -> Iterator[tuple[int, bytes]]:
            low = span[0][1]
            data = file.read_at(span[-1][1] + span[-1][2] - low, low)
            for label, offset, n in span:
                yield label, data[offset - low : offset - low + n]

        for label, offset, n in zip(of_file.index, of_file["offset"], of_file["n_bytes"], strict=True):
            if span and (span[-1][1] + span[-1][2] != offset or offset + n - span[0][1] > READ_BYTES):
                yield from flush()
                span = []
            span.append((label, int(offset), int(n)))
        if span:
            yield from flush()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, at = _filesystem(folder)
        decompressor = zstandard.ZstdDecompressor(dict_data=_dictionary(content))
        for batch in batches:
            for name, of_file in batch.sort_values("offset").groupby("file"):
                with system.open_input_file(f"{at}/{name}") as file:
                    if file.read_at(HEADER, 0) != MAGIC + digest:
                        raise ValueError(f"{name} was not written with this dictionary")
                    size, some = 0, []
                    for label, frame in frames(of_file, file):
                        ids = decompressor.decompress(frame)
                        some.append((label, ids))
                        size += len(ids)
                        if size > 8 * READ_BYTES:
                            yield _found(batch, some)
                            size, some = 0, []
                    yield _found(batch, some)

    return index.select("id", "start", "file", "offset", "n_bytes").mapInPandas(run, schema)


def _found(batch: pd.DataFrame, some: list[tuple[int, bytes]]) -> pd.DataFrame:
    labels = [label for label, _ in some]
    return batch.loc[labels, ["id", "start"]].assign(ids=[ids for _, ids in some])


def id_digests(index: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """Key, ``start``, ``n_tokens`` and ``ids_crc32`` of each document, from the files."""
    found = read_ids(index, path)
    return found.select(
        F.col("id").alias(key), "start", F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )
