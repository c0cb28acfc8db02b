"""SentencePiece encoding and decoding: Viterbi over pieces, in a window that moves along the text."""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cached_property, lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, types as T

from corpusloom.llm.tables import blocks, input_columns, released

SPACE = "▁"
# Runs and their parts that a worker remembers (some 200 bytes each), and the length up to which it does.
CACHE_RUNS = 300_000
CACHED_LENGTH = 64
# Characters of texts worked on together.
BLOCK = 1 << 20
# Score under the lowest piece's for a character that no piece covers, as the library has it.
UNKNOWN_PENALTY = 10.0
# Types of pieces in a model file.
NORMAL, UNKNOWN, USER_DEFINED, UNUSED, BYTE = 1, 2, 4, 5, 6


@dataclass
class Pieces:
    """A model's pieces with their scores, read once by each worker."""

    # Characters to nodes: further characters, and score and id if a piece ends here.
    trie: list
    bytes_of: list[bytes]
    byte_id: dict[int, int]
    unknown: int
    unknown_score: float
    longest: int
    dummy_prefix: bool
    # Characters that some piece has side by side.
    pairs: set[str]
    known: dict[str, bytes] = field(default_factory=dict)

    @cached_property
    def spanning(self) -> bool:
        return any(pair[1] == SPACE != pair[0] for pair in self.pairs)


def _trie(score: dict[str, tuple[float, int]]) -> list:
    root: list = [{}, None, -1]
    for piece, (value, number) in score.items():
        node = root
        for char in piece:
            node = node[0].setdefault(char, [{}, None, -1])
        node[1], node[2] = value, number
    # Nine nodes in ten lead nowhere: they share one empty table.
    nothing: dict = {}
    todo = [root]
    while todo:
        node = todo.pop()
        todo += node[0].values()
        node[0] = node[0] or nothing
    return root


@lru_cache(maxsize=1)
def read_pieces(content: bytes) -> Pieces:
    """Read a ``.model`` file's content; only identity normalisation, which changes no text, is supported."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    model.ParseFromString(content)
    rules = model.normalizer_spec
    if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
        raise ValueError("only models without normalisation are supported")
    score, bytes_of, byte_id, unknown = {}, [], {}, 0
    for i, piece in enumerate(model.pieces):
        if piece.type in (NORMAL, USER_DEFINED):
            score[piece.piece] = (piece.score, i)
            bytes_of.append(piece.piece.replace(SPACE, " ").encode())
        elif piece.type == BYTE:
            byte_id[int(piece.piece[1:-1], 16)] = i
            bytes_of.append(bytes([int(piece.piece[1:-1], 16)]))
        else:
            unknown = i if piece.type == UNKNOWN else unknown
            bytes_of.append(b" \xe2\x81\x87 " if piece.type == UNKNOWN else b"")
    lowest = min(s for s, _ in score.values())
    return Pieces(
        _trie(score), bytes_of, byte_id if len(byte_id) == 256 else {}, unknown, lowest - UNKNOWN_PENALTY,
        max(map(len, score)), rules.add_dummy_prefix,
        {p[i : i + 2] for p in score for i in range(len(p) - 1)},
    )


def stream_viterbi(text: str, pieces: Pieces) -> Iterator[tuple[int, str]]:
    """The best path through a text, given out as (id, characters) as soon as it is certain.

    Kept are only places that a piece can still reach back to. Best paths to the places ahead
    lead back through nodes they share; once all go through one node, what lies before it is
    certain, is given out and forgotten. Of equal scores the earlier start wins.
    """
    longest, trie, unknown, unknown_score = pieces.longest, pieces.trie, pieces.unknown, pieces.unknown_score
    size, none = len(text), -math.inf
    # From place `base` on: best score, where the best piece to it starts, and its id.
    base = 0
    ahead = min(size, 2 * longest)
    best, start, with_ = [0.0] + [none] * ahead, [-1] * (ahead + 1), [-1] * (ahead + 1)

    def path(end: int) -> list[tuple[int, str]]:
        found = []
        while end > base:
            begin = start[end - base]
            found.append((with_[end - base], text[begin:end]))
            end = begin
        return found[::-1]

    for begin in range(size):
        at = begin - base
        here = best[at]
        node = trie
        for char in text[begin : begin + longest]:
            at += 1
            node = node[0].get(char)
            if node is None:
                break
            if (score := node[1]) is not None and here + score > best[at]:
                best[at], start[at], with_[at] = here + score, begin, node[2]
        first = trie[0].get(text[begin])
        if first is None or first[1] is None:
            at = begin - base + 1
            if here + unknown_score > best[at]:
                best[at], start[at], with_[at] = here + unknown_score, begin, unknown
        if begin + 1 + longest - base >= len(best) and base + len(best) <= size:
            # Follow the places ahead back, furthest first, until one node is left.
            live = {i + base for i in range(begin + 1 - base, len(best)) if best[i] > none}
            while len(live) > 1:
                furthest = max(live)
                live.remove(furthest)
                live.add(start[furthest - base])
            meet = live.pop()
            if meet > base:
                yield from path(meet)
                cut = meet - base
                low = best[cut]
                best[:] = [total - low for total in best[cut:]]
                del start[:cut], with_[:cut]
                base = meet
            more = min(2 * longest, size + 1 - base - len(best))
            best += [none] * more
            start += [-1] * more
            with_ += [-1] * more
    yield from path(size)


def _ids_of(path: Iterable[tuple[int, str]], pieces: Pieces) -> bytes:
    ids: list[int] = []
    before_unknown = False
    for piece, characters in path:
        if piece != pieces.unknown:
            ids.append(piece)
        elif pieces.byte_id:
            ids.extend(pieces.byte_id[b] for b in characters.encode())
        elif not before_unknown:
            ids.append(piece)
        before_unknown = piece == pieces.unknown
    return struct.pack(f"<{len(ids)}I", *ids)


def _path_ids(text: str, pieces: Pieces) -> bytes:
    """Ids of the best path. A text that fits the window needs no forgetting, so its loop is plain."""
    size = len(text)
    if size > 2 * pieces.longest:
        return _ids_of(stream_viterbi(text, pieces), pieces)
    root = pieces.trie[0]
    best, start, with_ = [-math.inf] * (size + 1), [0] * (size + 1), [0] * (size + 1)
    best[0] = 0.0
    for begin in range(size):
        here, at, nodes = best[begin], begin, root
        for char in text[begin:] if begin else text:
            at += 1
            node = nodes.get(char)
            if node is None:
                break
            nodes, score, piece = node
            if score is not None and here + score > best[at]:
                best[at], start[at], with_[at] = here + score, begin, piece
        first = root.get(text[begin])
        if first is None or first[1] is None:
            at = begin + 1
            if here + pieces.unknown_score > best[at]:
                best[at], start[at], with_[at] = here + pieces.unknown_score, begin, pieces.unknown
    ids, end = [], size
    while end:
        ids.append(with_[end])
        end = start[end]
    if pieces.unknown not in ids:
        return struct.pack(f"<{len(ids)}I", *reversed(ids))
    path, end = [], size
    while end:
        path.append((with_[end], text[start[end] : end]))
        end = start[end]
    return _ids_of(reversed(path), pieces)


def _keep(cache: dict[str, bytes], text: str, ids: bytes) -> bytes:
    if len(text) <= CACHED_LENGTH:
        if len(cache) >= CACHE_RUNS:
            cache.clear()
        cache[text] = ids
    return ids


def _run_ids(run: str, pieces: Pieces) -> bytes:
    """Ids of a run, cut where no piece holds the two characters side by side: every path ends a piece there."""
    if not pieces.byte_id:
        return _path_ids(run, pieces)  # unknown characters side by side are one id
    known, pairs, ids, start = pieces.known, pieces.pairs, [], 0
    for i in range(1, len(run) + 1):
        if i == len(run) or run[i - 1 : i + 1] not in pairs:
            part = run[start:i]
            ids.append(known.get(part) or _keep(known, part, _path_ids(part, pieces)))
            start = i
    return b"".join(ids)


def _runs(text: str, spanning: bool) -> Iterator[str]:
    """Cut where every path has a boundary, as no piece goes on from other characters to a space mark."""
    if spanning or not text:
        return iter([text] if text else [])
    words = text.split(SPACE)
    if "" not in words[1:]:
        return iter(([words[0]] if words[0] else []) + [SPACE + w for w in words[1:]])

    def joined() -> Iterator[str]:
        marks = 0
        if words[0]:
            yield words[0]
        for word in words[1:]:
            marks += 1
            if word:
                yield SPACE * marks + word
                marks = 0
        if marks:
            yield SPACE * marks

    return joined()


def encode_bytes(text: str | None, pieces: Pieces) -> bytes:
    """Ids, as little-endian unsigned 32-bit integers, of the path with the highest sum of scores.

    Null and empty texts have none.
    """
    if not text:
        return b""
    text = text.replace(" ", SPACE)
    known, found = pieces.known, []
    for run in _runs(SPACE + text if pieces.dummy_prefix else text, pieces.spanning):
        found.append(known.get(run) or _keep(known, run, _run_ids(run, pieces)))
    return b"".join(found)


def encode_text(text: str | None, pieces: Pieces) -> list[int]:
    return np.frombuffer(encode_bytes(text, pieces), "<u4").tolist()


def decode_ids(ids: list[int], pieces: Pieces) -> str:
    """The text of the ids; bytes that are not UTF-8 become U+FFFD."""
    text = b"".join(map(pieces.bytes_of.__getitem__, ids)).decode("utf-8", "replace")
    return text[1:] if pieces.dummy_prefix and text.startswith(" ") else text


def encode_pieces(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and ``ids``, in one pass over the texts: no shuffle, and each row on its own.

    The ids are those of the path whose pieces have the highest sum of scores in the model.
    Characters without a piece become bytes, if the model has byte pieces, else the unknown id, once
    for a stretch. Null and empty texts have no ids; null keys and repeated rows are rows like
    others; texts of any length are encoded whole; an empty table gives no rows; only the two named columns are
    read. The model file is read on the driver and goes out with the tasks (half a megabyte).
    """
    rows, content = input_columns(docs, id=key, text=text), Path(model_path).read_bytes()
    schema = T.StructType([T.StructField(key, rows.schema["id"].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = read_pieces(content)
        for batch in (part for whole in batches for part in blocks(whole, "text", BLOCK)):
            yield pd.DataFrame({key: batch["id"], "ids": [np.frombuffer(encode_bytes(t, pieces), "<i4") for t in batch["text"]]})

    return rows.mapInPandas(released(run, lambda: read_pieces(content).known.clear()), schema)


def decode_pieces(rows: DataFrame, model_path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Key and ``text`` of each row's ids; null for null ids. An id outside the model is an error."""
    rows, content = input_columns(rows, id=key, ids=ids), Path(model_path).read_bytes()
    schema = T.StructType([T.StructField(key, rows.schema["id"].dataType), T.StructField("text", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = read_pieces(content)
        for batch in batches:
            texts = [None if i is None else decode_ids(i, pieces) for i in batch["ids"]]
            yield pd.DataFrame({key: batch["id"], "text": pd.Series(texts, dtype=object, index=batch.index)})

    return rows.mapInPandas(released(run, lambda: read_pieces(content).known.clear()), schema)


def round_trip_pieces(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode each whole text and decode the ids, in one pass.

    Returns key, ``n_ids``, ``ids_crc32`` (of the ids as little-endian unsigned 32-bit integers), ``same`` (the
    decoded text is the text; null counts as empty) and ``decoded``; nothing for an empty table. ``same`` is false where a text
    holds the space mark itself, which decodes to a space, as in the library.
    """
    rows, content = input_columns(docs, id=key, text=text), Path(model_path).read_bytes()
    kind = rows.schema["id"].dataType
    schema = T.StructType([
        T.StructField(key, kind), T.StructField("n_ids", T.LongType()), T.StructField("ids_crc32", T.LongType()),
        T.StructField("same", T.BooleanType()), T.StructField("decoded", T.StringType()),
    ])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = read_pieces(content)
        for batch in (part for whole in batches for part in blocks(whole, "text", BLOCK)):
            out = []
            for one, text_of in zip(batch["id"], batch["text"], strict=True):
                ids = encode_bytes(text_of, pieces)
                decoded = decode_ids(np.frombuffer(ids, "<u4").tolist(), pieces)
                out.append((one, len(ids) // 4, zlib.crc32(ids), decoded == (text_of or ""), decoded))
            found = pd.DataFrame(out, columns=schema.names)
            found[key] = batch["id"].to_numpy()
            yield found

    return rows.mapInPandas(released(run, lambda: read_pieces(content).known.clear()), schema)
