"""BPE of whole texts from chunks that documents share: each is encoded once, and the joins between chunks are repaired."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from corpusloom.llm.tables import input_columns

# A chunk ends where the hash of the last 32 bytes has this many leading zero bits; least and most bytes.
CUT_BITS, LEAST_CHUNK, MOST_CHUNK = 9, 64, 2_048
# Chunks that are encoded once for the whole corpus and sent to all tasks: those that save most. 2 KB each at most.
SHARED_CHUNKS, SHARED_BYTES = 16_384, 2_048
# Hashes of chunks that a task remembers while it counts.
SEEN_CHUNKS = 500_000
# Bytes of chunks, and words between white space, that a worker remembers besides; longer words are not remembered.
MEMORY_BYTES, MEMORY_WORDS, LONG_WORD = 16 << 20, 300_000, 64
# Words that go to the library as one text.
MARKED_WORDS = 4_096
BLOCK_BYTES = 1 << 21

_WINDOW = 32
_GEAR = np.random.default_rng(20_240_229).integers(0, 1 << 32, 256, dtype="uint32")
_SPACE = re.compile(rb"[ \t\n\r]")
# Between an ASCII letter or digit and a stop or comma these tokenizers always cut, as if there were a space.
_WORD_END = re.compile(rb"(?<=[a-zA-Z0-9])(?=[.,])")


def rolling_hash(data: np.ndarray) -> np.ndarray:
    """A hash of the last 32 bytes at each place, built from windows of 1, 2, 4, ... bytes."""
    h = _GEAR[data]
    width = 1
    while width < _WINDOW:
        wider = h.copy()
        wider[width:] += h[:-width] << np.uint32(width)
        h, width = wider, 2 * width
    return h


def chunks_of(texts: list[bytes]) -> Iterator[list[bytes]]:
    """Each text cut where its own bytes say so, between characters; equal passages are cut alike.

    A cut is passed over while the chunk before it holds no white space.
    """
    # Zeros between texts: the hash at the start of one does not depend on the one before.
    data = np.frombuffer((b"\0" * _WINDOW).join(texts) + b"\0", "uint8")
    # Not before a byte that continues a character.
    may_cut = np.flatnonzero(rolling_hash(data) >> np.uint32(32 - CUT_BITS) == 0) + 1
    low = 0
    for text in texts:
        cuts = may_cut[np.searchsorted(may_cut, low) : np.searchsorted(may_cut, low + len(text))] - low
        low += len(text) + _WINDOW
        found: list[bytes] = []
        start = 0
        while start < len(text):
            i = int(np.searchsorted(cuts, start + LEAST_CHUNK))
            end = min(int(cuts[i]) if i < len(cuts) else len(text), start + MOST_CHUNK, len(text))
            while end < len(text) and text[end] & 0xC0 == 0x80:
                end += 1
            if end < len(text) and not _SPACE.search(text, start, end):
                space = _SPACE.search(text, end)
                end = space.end() if space else len(text)
            found.append(text[start:end])
            start = end
        yield found


def _last_space(chunk: bytes, end: int) -> int:
    return max(chunk.rfind(b" ", 0, end), chunk.rfind(b"\n", 0, end), chunk.rfind(b"\t", 0, end), chunk.rfind(b"\r", 0, end))


def _tail(chunk: bytes, words: int) -> bytes:
    """The end of a chunk from the white space before its last ``words`` words; all if it has no more."""
    at = len(chunk)
    for _ in range(words):
        at = _last_space(chunk, at)
        if at < 0:
            return chunk
    return chunk[at + 1 :]


def _head(chunk: bytes, words: int) -> bytes:
    """The start of a chunk up to the white space after its first ``words`` words; all if it has no more."""
    at = -1
    for _ in range(words):
        space = _SPACE.search(chunk, at + 1)
        if space is None:
            return chunk
        at = space.start()
    return chunk[:at]


class ChunkedBpe:
    """Ids of texts from ids of chunks, equal to those of the whole text.

    The tokenizers taken drop white space and never look across it, so between two spaces a chunk's ids are the
    text's own, and words seen before need not go to the library again. At each join the words that touch it are encoded on their own and together; if the chunks end and
    begin with just the ids of their parts, those are replaced by the ids of the whole, else more words are taken.
    """

    def __init__(self, tokenizer_json: str, shared: dict[bytes, bytes] | None = None):
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.shared = shared or {}
        self.chunks: dict[bytes, bytes] = {}
        self.size = 0
        self.words: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        spec = json.loads(tokenizer_json)
        self.lowers = any(s["type"] == "Lowercase" for s in _steps(spec))
        marks = [t for t in spec.get("added_tokens") or [] if t.get("special") and not t.get("normalized")]
        self.mark = (marks[0]["content"].encode(), marks[0]["id"]) if marks else None
        self.raw = [t["content"].encode() for t in spec.get("added_tokens") or []]
        self.written = [t["content"].encode().lower() for t in spec.get("added_tokens") or []]
        n = max(self.tokenizer.get_vocab(with_added_tokens=True).values(), default=-1) + 1
        self.names = [(self.tokenizer.id_to_token(i) or "").encode() for i in range(n)]

    def library(self, texts: list[bytes]) -> list[bytes]:
        encodings = self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in encodings]

    def decode(self, ids: bytes) -> bytes:
        """What the library's ``decode(ids, skip_special_tokens=False)`` gives where a tokenizer names no decoder."""
        names = self.names
        return b" ".join([names[i] for i in np.frombuffer(ids, "<u4").tolist()])

    def plain(self, text: bytes) -> bytes:
        """A text with the same ids and fewer different words."""
        if self.lowers and text.isascii():
            low = text.lower()
            if not any(t in low for t in self.written):
                text = low
        return _WORD_END.sub(b" ", text)

    def encoded(self, texts: list[bytes]) -> list[bytes]:
        """Ids of chunks or parts of them, word by word; words not seen before go to the library together."""
        split = [self.plain(text).split() for text in texts]
        flat = list(chain.from_iterable(split))
        ids = list(map(self.words.get, flat))
        missed = {w for w, i in zip(flat, ids, strict=True) if i is None}
        if missed:
            fresh = {w: self.older[w] for w in missed if w in self.older}
            new = [w for w in missed if w not in fresh]
            fresh.update(zip(new, self.new_words(new), strict=True))
            ids = [fresh[w] if i is None else i for w, i in zip(flat, ids, strict=True)]
            if len(self.words) > MEMORY_WORDS:
                # Words met again since the last change stay known, others go.
                self.older, self.words = self.words, {}
            self.words.update((w, i) for w, i in fresh.items() if len(w) <= LONG_WORD)
        out, low = [], 0
        for some in split:
            out.append(b"".join(ids[low : low + len(some)]))
            low += len(some)
        return out

    def new_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of words: many as one text, between marks that the tokenizer takes out of a text before all else."""
        if self.mark is None:
            return self.library(words)
        mark, number = self.mark
        odd = {w: self.library([w])[0] for w in words if any(t in w for t in self.raw)}
        plain = [w for w in words if w not in odd]
        found: list[bytes] = []
        for low in range(0, len(plain), MARKED_WORDS):
            part = plain[low : low + MARKED_WORDS]
            [data] = self.library([mark.join(part)])
            at = np.flatnonzero(np.frombuffer(data, "<u4") == number) * 4
            if len(at) != len(part) - 1:
                raise RuntimeError("marks between words were not found again")
            found += [data[i:j] for i, j in zip([0, *(at + 4).tolist()], [*at.tolist(), len(data)], strict=True)]
        if not odd:
            return found
        others = iter(found)
        return [odd[w] if w in odd else next(others) for w in words]

    def block(self, texts: list[bytes]) -> Iterator[bytes]:
        """Ids of some texts; their new chunks go to the library together."""
        cut = list(chunks_of(texts))
        new = list(dict.fromkeys(c for chunks in cut for c in chunks if c not in self.shared and c not in self.chunks))
        if self.size > MEMORY_BYTES:
            self.chunks, self.size = {}, 0
            new = list(dict.fromkeys(c for chunks in cut for c in chunks if c not in self.shared))
        self.chunks.update(zip(new, self.encoded(new), strict=True))
        self.size += sum(map(len, new))
        sides: dict[tuple[bytes, bytes], tuple[bytes, bytes]] = {}
        for chunks in cut:
            for a, b in zip(chunks, chunks[1:], strict=False):
                sides[a, b] = _tail(a, 1), _head(b, 1)
        joins = list(dict.fromkeys(w for left, right in sides.values() if left and right for w in (left, right, left + right)))
        pieces = dict(zip(joins, self.encoded(joins), strict=True))
        for chunks in cut:
            yield self._joined(chunks, sides, pieces)

    def _ids(self, chunk: bytes) -> bytes:
        found = self.shared.get(chunk)
        return self.chunks[chunk] if found is None else found

    def _joined(self, chunks: list[bytes], sides: dict[tuple[bytes, bytes], tuple[bytes, bytes]], pieces: dict[bytes, bytes]) -> bytes:
        if not chunks:
            return b""
        out: list[bytes] = []
        last, ids = chunks[0], self._ids(chunks[0])
        for chunk in chunks[1:]:
            here = self._ids(chunk)
            left, right = sides[last, chunk]
            words = 1
            # A join at white space is right as it is.
            while left and right:
                a, b, both = (pieces[w] for w in (left, right, left + right))
                if ids.endswith(a) and here.startswith(b):
                    ids, here = ids[: len(ids) - len(a)] + both, here[len(b) :]
                    break
                if left == last and right == chunk:
                    raise RuntimeError("a chunk's ids are not those of its own text")
                words *= 2
                left, right = _tail(last, words), _head(chunk, words)
                joins = [left, right, left + right]
                pieces.update(zip(joins, self.encoded(joins), strict=True))
            out.append(ids)
            last, ids = chunk, here
        out.append(ids)
        return b"".join(out)

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers, in order; null as empty."""
        group, size = [], 0
        for text in texts:
            group.append((text or "").encode())
            size += len(group[-1])
            if size > BLOCK_BYTES:
                yield from self.block(group)
                group, size = [], 0
        yield from self.block(group)


def _steps(spec: dict) -> list[dict]:
    """The normalizers of a tokenizer, in order."""
    normalizer = spec.get("normalizer") or {}
    return normalizer.get("normalizers") or ([normalizer] if normalizer else [])


def check_tokenizer(tokenizer_json: str) -> None:
    """Refuse tokenizers that keep or cross white space, or decode otherwise, for which joins could not be repaired word by word."""
    spec = json.loads(tokenizer_json)
    cuts = spec.get("pre_tokenizer") or {}
    first = (cuts.get("pretokenizers") or [cuts])[0]
    pattern = (first.get("pattern") or {}).get("Regex", "")
    drops = (
        first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") is True
        # No part of the pattern takes white space, or a letter or digit beside anything else.
        and all(re.fullmatch(r"'[a-z]+|\[\\p\{[LN]\}\]\+?|\[\^\\s\\p\{L\}\\p\{N\}\]\+", part) for part in pattern.split("|"))
    )
    steps = _steps(spec)
    plain = all(s["type"] in ("NFC", "Lowercase") or s["type"] == "Replace" and s["content"] == " " and s["pattern"] == {"Regex": "\\s+"} for s in steps)
    added = all(not t.get("lstrip") and not t.get("rstrip") and not t.get("single_word") and not re.search(r"[\s.,]", t["content"])
                for t in spec.get("added_tokens") or [])
    if (spec.get("model") or {}).get("type") != "BPE" or not (drops and plain and added) or spec.get("decoder") or spec.get("post_processor"):
        raise ValueError("only BPE tokenizers that drop white space and name no decoder are encoded by chunks")


def _limited(batches: Iterator[pd.DataFrame]) -> Iterator[list[bytes]]:
    """Texts of some batches, about ``BLOCK_BYTES`` at a time."""
    group, size = [], 0
    for batch in batches:
        for text in batch["text"]:
            group.append((text or "").encode())
            size += len(group[-1])
            if size > BLOCK_BYTES:
                yield group
                group, size = [], 0
    if group:
        yield group


def _chunk_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Chunks of each block by hash, with their text where a task has met one twice."""
    seen: set[int] = set()
    given: set[int] = set()
    for texts in _limited(batches):
        some = [c for chunks in chunks_of(texts) for c in chunks if len(c) <= SHARED_BYTES]
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, some), "uint64", len(some)).view("int64")
        found, at, n = np.unique(hashes, return_index=True, return_counts=True)
        keys = found.tolist()
        twice = [(k in seen or m > 1) and k not in given for k, m in zip(keys, n.tolist(), strict=True)]
        given.update(k for k, t in zip(keys, twice, strict=True) if t)
        seen.update(keys)
        if len(seen) > SEEN_CHUNKS:
            seen.clear()
            given.clear()
        text = [some[i] if t else None for i, t in zip(at.tolist(), twice, strict=True)]
        size = np.fromiter(map(len, some), "int64", len(some))[at]
        yield pd.DataFrame({"h": found, "n": n, "size": size, "chunk": text})


def shared_chunks(rows: DataFrame, tokenizer_json: str) -> dict[bytes, bytes]:
    """Ids of the chunks that occur more than once and save most, at most ``SHARED_CHUNKS``, each encoded once.

    Chunks are counted over the whole corpus by hash; the text comes from a task that met the chunk twice. All
    others are encoded by the workers that meet them.
    """
    counts = rows.select("text").mapInPandas(_chunk_counts, "h long, n long, size long, chunk binary")
    counts = counts.groupBy("h").agg(F.sum("n").alias("n"), F.max("size").alias("size"), F.max("chunk").alias("chunk"))
    best = counts.where(F.col("chunk").isNotNull()).orderBy(F.desc(F.expr("(n - 1) * size")), "h").limit(SHARED_CHUNKS)

    def ids(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = ChunkedBpe(tokenizer_json)
        for batch in batches:
            yield pd.DataFrame({"chunk": batch["chunk"], "ids": encoder.encoded(list(batch["chunk"]))})

    found = best.select("chunk").mapInPandas(ids, "chunk binary, ids binary").collect()
    return {bytes(r.chunk): bytes(r.ids) for r in found}


def encode_chunked(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, ``ids`` (little-endian unsigned 32-bit integers, binary) and ``decoded`` of each text.

    Ids are those of the tokenizers library for the whole text, without special tokens of its own, truncation or padding; special
    tokens written out in a text count, as in the library. ``decoded`` is its ``decode(ids, skip_special_tokens=False)``.

    Texts are cut by a rolling hash, so passages that documents share give the same chunks. Those that occur most are
    encoded once for all (``SHARED_CHUNKS``), others once by each worker that meets them while it remembers them. Null
    texts are empty; null and repeated keys and rows are rows like others; an unbroken run of characters is one chunk,
    however long; texts are cut whole. An empty table gives none. Of other columns none is read.
    """
    tokenizer_json = Path(tokenizer_path).read_text()
    check_tokenizer(tokenizer_json)
    rows = input_columns(docs, id=key, text=text)
    kind = dict(rows.dtypes)["id"]
    shared = rows.sparkSession.sparkContext.broadcast(shared_chunks(rows, tokenizer_json))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = ChunkedBpe(tokenizer_json, shared.value)
        for batch in batches:
            low = 0
            for block in _split(batch["text"]):
                ids = list(encoder.encode_all(block))
                out = batch.iloc[low : low + len(ids)][["id"]].assign(ids=ids, decoded=[encoder.decode(i).decode() for i in ids])
                low += len(ids)
                yield out

    return rows.mapInPandas(run, f"id {kind}, ids binary, decoded string").withColumnRenamed("id", key)


def _split(texts: pd.Series) -> Iterator[list[str | None]]:
    """Texts in lists of about ``BLOCK_BYTES`` characters."""
    group: list[str | None] = []
    size = 0
    for text in texts:
        group.append(text)
        size += len(text or "")
        if size > BLOCK_BYTES:
            yield group
            group, size = [], 0
    if group:
        yield group


def chunked_digests(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` (lowercase hex) of each text; see :func:`encode_chunked`."""
    found = encode_chunked(docs, tokenizer_path, key, text)
    return found.select(
        key, F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
