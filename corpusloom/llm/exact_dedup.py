"""Exact duplicates through an extendible-hash index kept on shared files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusloom.llm.tables import HOT_SHARE, input_columns, join_hot, repeated, stored
from corpusloom.shared import new_path

# Leading hex digits of a key that the directory can tell apart: 65,536 cells at most.
CELL_DIGITS = 4
KEY_DIGITS = 16
CAPACITY = 8_192


def normalised(text: Column) -> Column:
    """Null as empty; each run of ASCII white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def grow_directory(cells: dict[str, int], capacity: int, max_bits: int = 4 * CELL_DIGITS) -> list[int]:
    """The directory: for each of ``2 ** depth`` leading bits, the number of its bucket.

    ``cells`` counts entries by their first four hex digits. One bucket holds all at first.
    An overfull bucket is split by its next bit; the directory doubles if the bucket already
    uses all its bits. Buckets that use ``max_bits`` stay as large as they are.
    """
    width = 1 << max_bits
    ahead = [0] * (width + 1)
    for cell, n in cells.items():
        ahead[(int(cell, 16) >> (4 * CELL_DIGITS - max_bits)) + 1] += n
    for i in range(width):
        ahead[i + 1] += ahead[i]

    depth, buckets, waiting = 0, [], [(0, 0)]
    while waiting:
        bits, local = waiting.pop()
        span = width >> local
        low = bits * span
        if ahead[low + span] - ahead[low] > capacity and local < max_bits:
            depth = max(depth, local + 1)
            waiting += [(2 * bits + 1, local + 1), (2 * bits, local + 1)]
        else:
            buckets.append((bits, local))
    directory = []
    for number, (bits, local) in enumerate(buckets):
        directory += [number] * (1 << (depth - local))
    return directory


def _bucket(key: Column, directory: list[int]) -> Column:
    """The directory entry that the leading bits of a key point to."""
    depth = (len(directory) - 1).bit_length()
    cell = F.conv(F.substring(key, 1, CELL_DIGITS), 16, 10).cast("int")
    entries = F.split(F.lit(",".join(map(str, directory))), ",").cast("array<int>")
    return F.get(entries, F.shiftright(cell, 4 * CELL_DIGITS - depth))


def build_index(docs: DataFrame, key: str, text: str, capacity: int = CAPACITY, key_digits: int = KEY_DIGITS) -> tuple[DataFrame, DataFrame]:
    """Index all texts; returns the distinct (id, text) rows by digest, and the index.

    A key is the first ``key_digits`` hex digits of the SHA-256 of the normalised text. Keys
    are counted by cell, at most 65,536 figures, from which the directory grows on the driver.
    Each bucket's rows go to its owner task, which compares the texts of equal keys byte by byte. A
    key that many rows share is dealt to several tasks first; what they find, a few texts, is
    compared again. Entries of one key form a chain, numbered by ``chain``.

    The index is a table on the shared folder with one directory for each bucket: ``bucket,
    key, chain, text_sha256, keep_id, group_size``.
    """
    texts = input_columns(docs, id=key, text=text)
    texts = texts.select("id", normalised(F.col("text")).alias("text"))
    texts = texts.withColumn("text_sha256", F.sha2(F.col("text").cast("binary"), 256))
    texts = texts.withColumn("key", F.substring("text_sha256", 1, key_digits))
    rows = texts.groupBy("id", "key", "text_sha256").agg(F.count(F.lit(1)).alias("copies"))
    rows = stored(rows, "keys")

    keys = stored(rows.groupBy("key").agg(F.sum("copies").alias("n")), "key-counts")
    cells = keys.groupBy(F.rpad(F.substring("key", 1, CELL_DIGITS), CELL_DIGITS, "0").alias("cell")).agg(
        F.count(F.lit(1)).alias("entries"), F.sum("n").alias("n")
    ).collect()
    directory = grow_directory({r.cell: r.entries for r in cells}, capacity)
    total = sum(r.n for r in cells)
    hot = [r.key for r in keys.where(F.col("n") * HOT_SHARE > total).collect()] if total > HOT_SHARE else []

    salt = F.when(F.col("key").isin(hot), F.pmod(F.xxhash64("id"), F.lit(64)) + 1).otherwise(0)
    texts = texts.withColumns({"bucket": _bucket(F.rpad("key", CELL_DIGITS, "0"), directory), "salt": salt})
    owned = texts.repartition("bucket", "salt").groupBy("bucket", "salt", "key", "text").agg(
        F.first("text_sha256").alias("text_sha256"), F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("n")
    )
    again = F.when(F.col("salt") > 0, F.col("text"))
    entries = owned.groupBy("bucket", "key", "text_sha256", again.alias("again")).agg(
        F.min("keep_id").alias("keep_id"), F.sum("n").alias("group_size"),
        F.count(F.when(F.col("salt") == 0, 1)).alias("texts"),
    )
    one_text = F.when(F.col("texts") > 1, F.raise_error(F.lit("different texts share a SHA-256"))).otherwise(F.col("key"))
    chain = F.row_number().over(Window.partitionBy("bucket", "key").orderBy("text_sha256"))
    entries = entries.repartition("bucket").withColumn("chain", chain).select(
        "bucket", one_text.alias("key"), "chain", "text_sha256", "keep_id", "group_size"
    )
    path = new_path(docs.sparkSession, "hash-index")
    entries.write.partitionBy("bucket").parquet(path)
    return rows, docs.sparkSession.read.schema(entries.schema).parquet(path)


def exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, key_digits: int = KEY_DIGITS) -> DataFrame:
    """For each row, the row with the same text that stays.

    Texts are equal if they are the same bytes after each run of ASCII white space has become one
    space; null counts as empty. Of equal texts the row with the smallest key stays; a null key
    comes last. Rows that repeat key and text count each, but only one of them is kept.

    Returns key, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256`` for each row of ``docs``,
    dropped ones too; of other columns none is read. An empty table gives an empty one.
    """
    rows, index = build_index(docs, key, text, capacity, key_digits)
    found = repeated(join_hot(rows, index, ["key", "text_sha256"], "group_size"))
    kept = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return found.select(
        F.col("id").alias(key), "keep_id", "group_size", kept.alias("kept"), "text_sha256"
    )
