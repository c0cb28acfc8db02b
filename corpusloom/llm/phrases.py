"""Phrases whose words stand together more often than apart: Misra-Gries summaries find candidates, a second pass counts them."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusloom.llm.shingles import CACHE_WORDS, mix
from corpusloom.llm.tables import input_columns, stored

LONGEST, LEAST, SCALE, SHARE, TOP = 4, 30, 2_000_000, 80, 2_000
# Words worked on together, and bytes of a text cut into words at once.
BLOCK_WORDS, SLICE_BYTES = 1 << 20, 1 << 22
# N-grams a partition of the hashes is planned for; bytes of text that stand for one word in that plan.
PART_MASS, WORD_BYTES, LEAST_PARTS = 1 << 24, 6, 64
# Bits of the table of hashes that may be frequent: 16 MB, whatever the corpus.
TABLE_BITS = 27

_SEPARATOR = b"."
_ENDS = b".,;:!?\n\x0b\x0c\r"
_UPPER, _LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
_PLAIN = bytes.maketrans(_ENDS + b"\t" + _UPPER, _SEPARATOR * len(_ENDS) + b" " + _LOWER)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
# Counts beyond this are as good as this one: a summary only tells what may be frequent.
_MANY = 1 << 30


class _WordHashes(dict):
    """Hashes of words, 0 only for the separator of pieces."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = 0 if word == _SEPARATOR else xxhash.xxh3_64_intdigest(word) | 1
        return value


def _slices(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text and separators of its pieces, a slice of the text at a time."""
    low = 0
    while low < len(text):
        high = low + SLICE_BYTES
        if high < len(text):
            # A word is never cut, however long it is.
            space, end = text.find(b" ", high), text.find(_SEPARATOR, high)
            high = min(at for at in (space, end, len(text)) if at >= 0)
        yield text[low:high].replace(_SEPARATOR, b" . ").split()
        low = high


class Block:
    """Words of some texts with the group each belongs to; the first ``seen`` are there for context only."""

    def __init__(self, words: list[bytes], groups: list[tuple[int, str]], seen: int, hashes: _WordHashes):
        self.words, self.seen = words, seen
        self.hash = np.fromiter(map(hashes.__getitem__, words), "uint64", len(words))
        starts = np.array([at for at, _ in groups] + [len(words)])
        salts = np.array([xxhash.xxh3_64_intdigest(g.encode(), 1) for _, g in groups], "uint64")
        self.salt = np.repeat(salts, np.diff(starts))
        self.starts, self.names = starts[:-1], [g for _, g in groups]

    def group(self, at: int) -> str:
        return self.names[int(np.searchsorted(self.starts, at, "right")) - 1]

    def ngrams(self, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """``k``, places and hashes of the n-grams of ``k`` words that end after the context, none across pieces."""
        n = len(self.hash)
        is_word = self.hash != 0
        whole, value = is_word.copy(), mix(self.hash + self.salt)
        for k in range(1, min(longest, n) + 1):
            if k > 1:
                whole = whole[:-1] & is_word[k - 1 :]
                value = mix(value[:-1] * _FACTOR + self.hash[k - 1 :])
            at = np.flatnonzero(whole)
            at = at[at >= self.seen - k + 1] if self.seen else at
            yield k, at, value[at]


def word_blocks(batches: Iterable[pa.RecordBatch], longest: int, size: int = BLOCK_WORDS) -> Iterator[Block]:
    """Blocks of about ``size`` words; a text goes on in the next one with its last words as context."""
    hashes = _WordHashes()
    words: list[bytes] = []
    groups: list[tuple[int, str]] = []
    seen = 0
    for batch in batches:
        names = batch.column("g").to_pylist()
        for name, text in zip(names, batch.column("t").cast(pa.binary()), strict=True):
            groups.append((len(words), name))
            for some in _slices((text.as_py() or b"").translate(_PLAIN)):
                words += some
                if len(words) >= size:
                    yield Block(words, groups, seen, hashes)
                    words = words[max(len(words) - longest + 1, 0) :] if longest > 1 else []
                    groups, seen = [(0, name)], len(words)
            words.append(_SEPARATOR)
    if len(words) > seen:
        yield Block(words, groups, seen, hashes)


def _summaries(longest: int, part_bits: int):
    """Exact counts of a block, dealt to partitions of the hashes: the first bits name the partition, the next 32 the key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in word_blocks(batches, longest):
            keys = np.concatenate([h for _, _, h in block.ngrams(longest)] or [np.empty(0, "uint64")])
            keys = np.sort(keys >> np.uint64(32 - part_bits))
            if not len(keys):
                continue
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            counts = np.minimum(np.diff(np.append(starts, len(keys))), _MANY).astype("uint32")
            keys = keys[starts]
            parts = (keys >> np.uint64(32)).astype("int64")
            low = keys.astype("uint32")
            firsts = np.flatnonzero(np.concatenate([[True], parts[1:] != parts[:-1]]))
            rows: list[tuple[int, bytes, bytes, bytes]] = []
            for i, j in zip(firsts, np.append(firsts[1:], len(keys)), strict=True):
                once = counts[i:j] == 1
                rows.append((
                    int(parts[i]), low[i:j][once].tobytes(), low[i:j][~once].tobytes(), counts[i:j][~once].tobytes()
                ))
            for i in range(0, len(rows), 1024):
                part, ones, more, n = zip(*rows[i : i + 1024], strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part, "int32"), pa.array(ones, pa.binary()), pa.array(more, pa.binary()), pa.array(n, pa.binary())],
                    ["part", "ones", "more", "counts"],
                )

    return run


class MisraGries:
    """Counts of the most frequent keys, each too low by at most ``lost``, which stays under ``least``.

    With a capacity over mass / ``least`` that is so by itself: lowering all of ``capacity`` + 1 counts by
    one takes that much of the mass away. Where the mass turns out larger than planned, the summary
    grows instead. So every key that occurs ``least`` times or more survives.
    """

    def __init__(self, capacity: int, least: int):
        self.capacity, self.least, self.lost = capacity, least, 0
        self.keys, self.counts = np.empty(0, "uint32"), np.empty(0, "int64")
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.n_waiting = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Counts of another summary, or of a part of the data."""
        self.waiting.append((keys, counts))
        self.n_waiting += len(keys)
        if self.n_waiting > self.capacity:
            self.merge()

    def merge(self) -> None:
        keys = np.concatenate([self.keys, *(k for k, _ in self.waiting)])
        counts = np.concatenate([self.counts, *(c for _, c in self.waiting)])
        self.waiting, self.n_waiting = [], 0
        if not len(keys):
            return
        packed = np.sort(keys.astype("uint64") << np.uint64(32) | np.minimum(counts, _MANY).astype("uint64"))
        keys = (packed >> np.uint64(32)).astype("uint32")
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        counts = np.add.reduceat((packed & np.uint64(0xFFFFFFFF)).astype("int64"), starts)
        keys = keys[starts]
        if len(keys) > self.capacity:
            down = int(np.partition(counts, len(counts) - self.capacity - 1)[len(counts) - self.capacity - 1])
            down = min(down, self.least - 1 - self.lost)
            self.lost += down
            keys, counts = keys[counts > down], counts[counts > down] - down
            self.capacity = max(self.capacity, len(keys))
        self.keys, self.counts = keys, counts

    def survivors(self) -> np.ndarray:
        """Keys that can have ``least`` occurrences."""
        self.merge()
        return self.keys[self.counts + self.lost >= self.least]


def _merged(capacity: int, least: int, part_bits: int, table_bits: int):
    """The piece of the table that belongs to a partition: a bit for each hash that may be frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary, part = MisraGries(capacity, least), None
        for batch in batches:
            for i in range(batch.num_rows):
                part = batch.column("part")[i].as_py()
                ones, more, n = (np.frombuffer(batch.column(c)[i].as_py(), "uint32") for c in ("ones", "more", "counts"))
                summary.add(ones, np.ones(len(ones), "int64"))
                summary.add(more, n.astype("int64"))
        # Wide enough for a byte, so that pieces are whole bytes.
        within = table_bits - part_bits
        bits = np.zeros(1 << within, bool)
        bits[summary.survivors() >> np.uint32(32 - within)] = True
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], "int32"), pa.array([np.packbits(bits).tobytes()], pa.binary())], ["part", "bits"]
        )

    return run


def _counts(table, longest: int, table_bits: int):
    """Exact counts, in each block, of the n-grams that may be frequent; and of all words, as those of length 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(table.value, "uint8")
        for block in word_blocks(batches, longest):
            rows: list[tuple[str, bytes, int, int]] = []
            same = np.unique(block.hash, return_inverse=True)[1] if len(block.hash) else block.hash
            for k, at, h in block.ngrams(longest):
                if k == 1:
                    ends = np.searchsorted(at, np.append(block.starts[1:], len(block.words)))
                    for name, n in zip(block.names, np.diff(np.concatenate([[0], ends])), strict=True):
                        if n:
                            rows.append((name, b"", 0, int(n)))
                place = h >> np.uint64(64 - table_bits)
                hit = bits[place >> np.uint64(3)] >> (np.uint8(7) - (place & np.uint64(7)).astype("uint8")) & np.uint8(1)
                at, h = at[hit == 1], h[hit == 1]
                if not len(at):
                    continue
                order = np.argsort(h, kind="stable")
                at, h = at[order], h[order]
                first = np.concatenate([[True], h[1:] != h[:-1]])
                number = np.cumsum(first) - 1
                example = at[first]
                for j in range(k):
                    if (same[at + j] != same[example[number] + j]).any():
                        raise RuntimeError("different phrases share a hash of 64 bits")
                for i, n in zip(example.tolist(), np.bincount(number).tolist(), strict=True):
                    rows.append((block.group(i), b" ".join(block.words[i : i + k]), k, n))
            for i in range(0, len(rows), 1 << 16):
                name, phrase, k, n = zip(*rows[i : i + (1 << 16)], strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(name, "string"), pa.array(phrase, pa.binary()).cast("string"), pa.array(k, "int32"), pa.array(n, "int64")],
                    ["lang", "phrase", "k", "f"],
                )

    return run


def frequent_ngrams(docs: DataFrame, group: str = "lang", text: str = "text", longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """``lang, phrase, k, f``: n-grams of ``k`` words with ``f >= least`` occurrences in a group, and in rows of ``k`` = 0 all its words.

    First pass: blocks of words are counted and dealt to partitions by hash; a Misra-Gries summary for
    each keeps every n-gram that can be frequent. Second pass: those are counted exactly, by their words.
    What goes to the driver and to all tasks is a table of 16 MB, whatever the corpus; where it fills up,
    the second pass counts more, with the same result.
    """
    spark = docs.sparkSession
    rows = input_columns(docs, g=group, t=text).select(F.coalesce(F.col("g").cast("string"), F.lit("und")).alias("g"), "t")
    n_bytes = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    mass = longest * n_bytes // WORD_BYTES
    parts = max(LEAST_PARTS, mass // PART_MASS + 1)
    part_bits = min(int(parts - 1).bit_length(), TABLE_BITS - 3)
    capacity = mass // (least << part_bits) + 1
    summaries = rows.mapInArrow(_summaries(longest, part_bits), "part int, ones binary, more binary, counts binary")
    pieces = summaries.groupBy("part").applyInArrow(_merged(capacity, least, part_bits, TABLE_BITS), "part int, bits binary")
    content = bytearray(1 << TABLE_BITS - 3)
    width = len(content) >> part_bits
    for piece in pieces.collect():
        content[piece.part * width : (piece.part + 1) * width] = piece.bits
    table = spark.sparkContext.broadcast(bytes(content))
    counted = rows.mapInArrow(_counts(table, longest, TABLE_BITS), "lang string, phrase string, k int, f long")
    total = counted.groupBy("lang", "phrase", "k").agg(F.sum("f").alias("f"))
    return total.where(F.col("f") >= F.when(F.col("k") == 0, 1).otherwise(least))


def _part_of(words: Column, first: Column | int, n: Column | int) -> Column:
    return F.array_join(F.slice(words, first, n), " ")


def phrases(
    docs: DataFrame, group: str = "lang", text: str = "text", longest: int = LONGEST, least: int = LEAST,
    share: int = SHARE, top: int = TOP,
) -> DataFrame:
    """The best ``top`` phrases of 2 to ``longest`` words of each group: ``lang, rank, phrase, a, l, r, n, score``.

    A-Z are lower-cased; ``.,;:!?`` and line ends cut a text into pieces, spaces and tabs those into words.
    A candidate occurs ``a >= least`` times within pieces. Cut in two, with ``l`` and ``r`` occurrences of its
    halves, it has the score ``floor(2000000 a / (l + r))``; the lowest cut counts, the first of equal ones. A candidate
    whose words stand inside a longer one with ``share`` percent of its occurrences goes. ``n`` counts all words of the group.

    A null group is ``und``, a null text is empty; repeated rows count again; ties in score are ordered by ``a``, then by
    the phrase's bytes. Texts of any length go through in slices. An empty table gives no rows. Of other
    columns none is read.
    """
    found = stored(frequent_ngrams(docs, group, text, longest, least), "ngrams")
    counts = found.where("k > 0").select("lang", "phrase", "f")
    candidates = found.where("k > 1").select("lang", "phrase", "k", F.col("f").alias("a"))
    words = F.split("phrase", " ")

    cuts = candidates.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cuts = cuts.select(
        "*", _part_of(words, 1, F.col("cut")).alias("first"), _part_of(words, F.col("cut") + 1, F.col("k") - F.col("cut")).alias("rest")
    )
    left = counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    cuts = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    score = F.call_function("div", wide("a") * F.lit(SCALE).cast("decimal(10,0)"), wide("l") + wide("r")).alias("score")
    lowest = cuts.groupBy("lang", "phrase", "k", "a").agg(F.min(F.struct(score, "cut", "l", "r")).alias("best"))

    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.col("k") - 1), lambda n: F.transform(
        F.sequence(F.lit(1), F.col("k") - n + 1), lambda i: _part_of(words, i, n))))
    inside = candidates.where("k > 2").select("lang", F.explode(spans).alias("phrase"), F.col("a").alias("longer"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = lowest.join(inside, ["lang", "phrase"], "left")
    kept = kept.where(F.col("longer").isNull() | (100 * wide("longer") < share * wide("a")))

    rows = kept.select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = rows.withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= top)
    n = found.where("k = 0").select("lang", F.col("f").alias("n"))
    # One short row a group, of at most ``top`` rows each.
    return ranked.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
