"""Benchmark passages in documents: a prefix-filtered join over item-sized windows of words."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.llm.tables import ascii_lower, input_columns, left_null_safe, repeated, stored, with_copies

WINDOW = 13
# A word, before A-Z are lower-cased: ASCII letters and digits, and everything beyond ASCII. Java matches named
# classes about ten times as fast as the same class with ranges left out.
WORD = r"[\p{Alnum}\P{ASCII}]+"
# Words of benchmark items in one block; what a block broadcasts is about 100 bytes a word.
BLOCK_WORDS = 200_000


def words(text: Column) -> Column:
    """The words of a text as they stand; null has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def _token(word: Column) -> Column:
    """Words that are equal once A-Z are lower-cased have the same token."""
    return F.xxhash64(F.lower(word))


def _joined(of: Column, start: Column, length: Column) -> Column:
    return ascii_lower(F.array_join(F.slice(of, start, length), " "))


def _blocks(items: DataFrame) -> Iterator[DataFrame]:
    """Items in blocks of bounded size: each is broadcast once and meets all documents."""
    total = items.agg(F.sum("n")).first()[0] or 0
    n_blocks = -(-total // BLOCK_WORDS)
    block = F.pmod(F.xxhash64("item", "words"), F.lit(n_blocks))
    for i in range(n_blocks):
        yield items.where(block == i) if n_blocks > 1 else items


def _windows(items: DataFrame, window: int) -> DataFrame:
    """Each item's windows: ``window`` words, or the whole of a shorter item."""
    size = F.least("n", F.lit(window))
    starts = F.sequence(F.lit(1), F.col("n") - size + 1)
    return items.withColumn("size", size).withColumn("start", F.explode(starts)).select(
        "item", "size", F.slice("words", F.col("start"), F.col("size")).alias("words"),
        _joined(F.col("words"), F.col("start"), F.col("size")).alias("window"),
    )


def _rarest(windows: DataFrame, docs: DataFrame) -> DataFrame:
    """For each distinct window its rarest token, by count over all documents, and where it is.

    All tokens of a window must be in a document that holds it, so the necessary prefix in
    order of rarity is a single token.
    """
    distinct = windows.groupBy("window").agg(F.first("size").alias("size"), F.first("words").alias("words"))
    tokens = distinct.select("window", "size", F.posexplode("words").alias("offset", "word"))
    tokens = stored(tokens.select("window", "size", "offset", _token(F.col("word")).alias("token")), "window-tokens")
    seen = docs.select(F.explode(words(F.col("text"))).alias("word")).select(_token(F.col("word")).alias("token"))
    known = tokens.select("token").distinct()
    counts = seen.join(F.broadcast(known), "token").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    ranked = tokens.join(counts, "token")  # a window with a token that no document has is out
    first = F.min(F.struct("n", "token", "offset")).alias("rarest")
    ranked = ranked.groupBy("window").agg(first, F.first("size").alias("size"), F.count(F.lit(1)).alias("found"))
    return ranked.where(F.col("found") == F.col("size")).select(
        "window", "size", F.col("rarest.token").alias("token"), F.col("rarest.offset").alias("offset")
    )


def _hits(docs: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Every occurrence of a window: ``id, h, window, size, start``.

    Tokens join on the prefix; the position says where the window would start, which must
    leave room for all its words; then the words are compared.
    """
    rows = docs.select("id", "h", words(F.col("text")).alias("words"))
    rows = rows.select("id", "h", "words", F.posexplode("words").alias("pos", "word"))
    rows = rows.withColumn("token", _token(F.col("word"))).drop("word")
    start = F.col("pos") - F.col("offset") + 1
    fits = (start >= 1) & (start + F.col("size") - 1 <= F.size("words"))
    same = _joined(F.col("words"), start, F.col("size")) == F.col("window")
    prefixes = prefixes.withColumnRenamed("token", "w_token")
    found = rows.join(F.broadcast(prefixes), (F.col("token") == F.col("w_token")) & fits & same)
    return found.select("id", "h", "window", "size", start.alias("start"))


def _of_document(hits: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Hit positions, and items with hits, of each document; each once."""
    ends = F.col("start") + F.col("size") - 1
    positions = hits.select("id", "h", F.explode(F.sequence("start", ends)).alias("pos")).distinct()
    found = hits.select("id", "h", "window").distinct().join(F.broadcast(items), "window")
    return positions, found.select("id", "h", "item").distinct()


def contamination(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text", window: int = WINDOW, share: int = 20,
) -> DataFrame:
    """How many words of each document lie in a window of a benchmark item.

    A window is ``window`` consecutive words of an item, or all words of a shorter one. A
    document is contaminated if it has hit words and they are one in ``share`` or more.

    Returns key, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256`` (of the sorted ids of items with hits,
    joined by commas; a null id is empty) and ``contaminated`` for each row. Null and empty texts have no
    words; null keys and repeated rows are rows like others. Items without words, and an empty benchmark, hit
    nothing. Items with the same id are one item. Only the named columns are read.

    Texts are never shuffled. The benchmark is broadcast in blocks of about ``BLOCK_WORDS`` words,
    each of which meets all documents.
    """
    rows = input_columns(docs, id=key, text=text).withColumn("h", F.xxhash64("text"))
    lengths = with_copies(rows.select("id", "h", F.size(words(F.col("text"))).cast("long").alias("n_words")), ["id", "h"], "n_words")
    items = input_columns(benchmark, item=item, text=item_text)
    items = items.select(F.coalesce(F.col("item").cast("string"), F.lit("")).alias("item"), words(F.col("text")).alias("words"))
    items = stored(items.distinct().withColumn("n", F.size("words")).where("n > 0"), "items")

    parts = []
    for block in _blocks(items):
        windows = stored(_windows(block, window), "windows")
        hits = stored(_hits(rows, _rarest(windows, rows)), "window-hits")
        parts.append(_of_document(hits, windows.select("window", "item").distinct()))
    if not parts:
        empty = items.sparkSession.createDataFrame([], f"id {dict(rows.dtypes)['id']}, h long, pos int, item string")
        parts.append((empty.drop("item"), empty.drop("pos")))
    positions, found = (reduce(DataFrame.unionByName, side) for side in zip(*parts, strict=True))
    if len(parts) > 1:
        positions, found = positions.distinct(), found.distinct()
    n_hit = positions.groupBy("id", "h").agg(F.count(F.lit(1)).alias("n_hit"))
    listed = F.array_join(F.sort_array(F.collect_list("item")), ",")
    n_items = found.groupBy("id", "h").agg(F.count(F.lit(1)).alias("n_items"), listed.alias("items"))

    joined = left_null_safe(left_null_safe(lengths, n_hit, ["id", "h"]), n_items, ["id", "h"])
    hit, words_in = F.coalesce("n_hit", F.lit(0)), F.col("n_words")
    joined = joined.select(
        "id", "n_words", hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.sha2(F.coalesce("items", F.lit("")).cast("binary"), 256).alias("items_sha256"),
        ((hit > 0) & (hit * share >= words_in)).alias("contaminated"), "copies",
    )
    return repeated(joined).select(
        F.col("id").alias(key), "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    )
