"""N-gram Jaccard join: size-banded tiles, bitmap signatures, exact intersections."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from corpusloom.llm.components import connected_components
from corpusloom.llm.shingles import WordHashes, mix, shingle_set
from corpusloom.llm.tables import BROADCAST_ROWS, blocks, input_columns, join_hot, released, small_broadcast, stored

NGRAM = 3
PERCENT = 90
# Ratio of the sizes at the ends of a band.
BAND = 1.5
# Ways to cut a set into parts.
CUTS = 6
# Shingles of one tile: 16 MB of hashes.
TILE_SHINGLES = 2_000_000


def _bands(size: int, percent: int) -> list[tuple[int, int]]:
    """Bands in which a set of ``size`` may meet a larger one: (number, largest size in it)."""
    bands, number, low = [], 0, 1
    while low * percent <= size * 100:
        high = max(int(low * BAND), low + 1)
        # Sets down to percent of the band's least size meet the band's own.
        if size < high:
            bands.append((number, high - 1))
        number, low = number + 1, high
    return bands


def _most_differences(largest: int, percent: int) -> int:
    """Elements in which two linked sets of at most this size can differ."""
    return 2 * largest * (100 - percent) // (100 + percent)


def _parts(shingles: np.ndarray, parts: int, cut: int) -> tuple[np.ndarray, np.ndarray]:
    """What each of the parts of a set holds, as one number, and which hold fewer than two elements."""
    place = mix(shingles ^ np.uint64(cut * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) if cut else shingles
    scrambled = mix(shingles + np.uint64(1))
    if cut:
        order = np.argsort(place)
        place, scrambled = place[order], scrambled[order]
    ends = np.searchsorted((place >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32), np.arange(parts + 1))
    total = np.concatenate([[np.uint64(0)], np.cumsum(scrambled, dtype="uint64")])
    return total[ends[1:]] - total[ends[:-1]], np.diff(ends) < 2


def tile_keys(shingles: np.ndarray, percent: int) -> np.ndarray:
    """Keys of the tiles a set belongs to; sets that are linked share at least one.

    In a band, hash ranges cut a set into ``differences + spare`` parts, of which linked sets have
    ``spare`` or more in common. A key stands for band, cut, part and all that the part holds. Parts of fewer than
    two elements, which unrelated sets share by chance, give no key; where fewer than ``spare`` are that small, linked
    sets still share a larger one. Where more are, the set is cut another way as well, and so on; only a set that is
    short of larger parts in all ``CUTS`` gives the keys of small parts, of the first cut. Two linked sets that are
    both short in a cut both go on to the next, so they meet in the first cut in which one of them is not short.
    """
    keys = [np.empty(0, "uint64")]
    for band, largest in _bands(len(shingles), percent):
        differences = _most_differences(largest, percent)
        spare = 1 + differences // 12
        parts = differences + spare
        for cut in range(CUTS + 1):
            content, small = _parts(shingles, parts, cut % CUTS)
            label = np.arange(parts, dtype="uint64") * np.uint64(4_096) + np.uint64(cut % CUTS * 512 + band)
            of_cut = mix(content + mix(label + np.uint64(1)))
            if cut == CUTS:
                keys.append(of_cut[small])
                break
            keys.append(of_cut[~small])
            if small.sum() < spare:
                break
    return np.concatenate(keys)


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view("int64")


def _signatures(n: int, percent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in (part for whole in batches for part in blocks(whole, "text", 1 << 20)):
            sets = [shingle_set(t, n, hashes) for t in batch["text"]]
            rows = batch[["id", "h"]].copy()
            rows["n"] = [len(s) for s in sets]
            rows["d1"] = np.array([mix(s).sum(dtype="uint64") for s in sets], "uint64").view("int64")
            rows["d2"] = np.array([mix(s + np.uint64(7)).sum(dtype="uint64") for s in sets], "uint64").view("int64")
            rows["keys"] = [_signed(tile_keys(s, percent)) for s in sets]
            yield rows

    return released(run)


def _bitmaps(sets: list[np.ndarray]) -> np.ndarray:
    """A row of bits for each set: twice as many as elements in the largest, up to a power of two."""
    width = 1 << int(np.clip(np.ceil(np.log2(2 * max(map(len, sets)))), 8, 14))
    bits = np.zeros((len(sets), width // 64), "uint64")
    for row, s in zip(bits, sets, strict=True):
        at = s & np.uint64(width - 1)
        np.bitwise_or.at(row, at >> np.uint64(6), np.uint64(1) << (at & np.uint64(63)))
    return bits


def tile_links(sets: list[np.ndarray], sides: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that connect all linked sets of a tile; none between sets connected already.

    ``sides``: 0 or 1 if only sets of different sides are compared, 2 for a tile in itself.
    """
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    sets = [sets[i] for i in order]
    side = np.asarray(sides)[order]
    size = np.array([len(s) for s in sets])
    bits = _bitmaps(sets)
    component = np.arange(len(sets))
    links = []
    for i in range(len(sets)):
        last = int(np.searchsorted(size, size[i] * 100 // percent, "right"))
        others = np.arange(i + 1, last)
        others = others[(component[others] != component[i]) & ((side[others] != side[i]) | (side[i] == 2))]
        if not len(others):
            continue
        only_i = np.bitwise_count(bits[i] & ~bits[others]).sum(axis=1, dtype="int64")
        only_j = np.bitwise_count(bits[others] & ~bits[i]).sum(axis=1, dtype="int64")
        most = np.minimum(size[i] - only_i, size[others] - only_j)
        others = others[most * (100 + percent) >= percent * (size[i] + size[others])]
        for j in others:
            if component[i] == component[j]:
                continue
            common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * common >= percent * (size[i] + size[j] - common):
                component[component == component[j]] = component[i]
                links.append((order[i], order[j]))
    return links


def _tile(n: int, percent: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        hashes = WordHashes()
        sets = [shingle_set(t, n, hashes) for t in rows["text"]]
        links = tile_links(sets, rows["side"].to_numpy(), percent)
        node = rows["d1"].to_numpy()
        return pd.DataFrame({"u": [node[i] for i, _ in links], "v": [node[j] for _, j in links]}, dtype="int64")

    return run


def _clusters(signatures: DataFrame) -> DataFrame:
    """``node, component``: classes that share tiles, directly or over others.

    Each class has one edge, to the least of all classes in its tiles; then classes are replaced by what
    these edges connect, and only tiles that still hold different ones go on. A tile whose members
    agree has nothing left to connect. So no round has more edges than classes.
    """
    members = signatures.select(F.explode("keys").alias("key"), "d1")
    shared = members.groupBy("key").agg(F.min("d1").alias("u"), F.max("d1").alias("high"), F.count(F.lit(1)).alias("rows"))
    shared = stored(shared.where("u <> high").select("key", "u", "rows"), "shared-tiles")
    if shared.count() <= BROADCAST_ROWS:
        members = members.join(F.broadcast(shared.select("key", "u")), "key")
    else:
        members = join_hot(members, shared, ["key"], "rows").drop("rows")
    members = stored(members.select("key", F.col("d1").alias("label"), "u").distinct(), "members")
    # A class that is the least of its tiles has no edge yet if their other members found a lesser one elsewhere.
    names = members.select(F.col("label").alias("node"), F.col("label").alias("component")).distinct()
    while True:
        edges = members.groupBy(F.col("label").alias("v")).agg(F.min("u").alias("u")).where("u <> v")
        found = connected_components(edges)
        further = found.select(F.col("node").alias("component"), F.col("component").alias("further"))
        names = names.join(further, "component", "left")
        names = stored(names.select("node", F.coalesce("further", "component").alias("component")), "clusters")
        joined = members.select("key", "label").join(found, F.col("label") == F.col("node"), "left")
        joined = joined.select("key", F.coalesce("component", "label").alias("label")).distinct()
        ends = joined.groupBy("key").agg(F.min("label").alias("u"), F.max("label").alias("high"), F.count(F.lit(1)).alias("rows"))
        joined, ends = stored(joined, "members"), stored(ends.where("u <> high").drop("high"), "open-tiles")
        if ends.limit(1).count() == 0:
            return names
        members = stored(join_hot(joined, ends, ["key"], "rows").drop("rows"), "members")


def _tiles(nodes: DataFrame, percent: int) -> DataFrame:
    """Rows of each cluster dealt to tiles, and to each pair of tiles whose sizes can be linked.

    A cluster of up to ``TILE_SHINGLES`` is one tile. A larger one is cut into bands of sizes, so
    that only neighbouring bands can be linked, and a band into tiles by hash.
    """
    log = float(np.log(100 / percent)) if percent < 100 else 1.0
    whole = nodes.groupBy("component").agg(F.sum("n").alias("total"))
    big = whole.where(F.col("total") > TILE_SHINGLES).select("component")
    small = nodes.join(whole.where(F.col("total") <= TILE_SHINGLES).select("component"), "component")
    small = small.select("component", "d1", "id", "h", F.lit("0").alias("tile"), F.lit(2).alias("side"))

    large = nodes.join(big, "component").withColumn("band", F.floor(F.log(F.col("n")) / log).cast("int"))
    tiles = F.ceil(F.sum("n") / TILE_SHINGLES).cast("int")
    counts = large.groupBy("component", "band").agg(tiles.alias("tiles"))
    of = F.map_from_entries(F.collect_list(F.struct("band", "tiles"))).alias("of")
    large = large.join(counts.groupBy("component").agg(of), "component")
    band = F.col("band")
    own = F.pmod(F.xxhash64("d1"), F.col("of")[band]).cast("int")
    large = large.withColumn("own", own)

    def to(other_band, as_first: bool):
        numbers = F.sequence(F.lit(0), F.coalesce(F.col("of")[other_band], F.lit(0)) - 1)
        numbers = F.when(F.col("of")[other_band].isNull(), F.array().cast("array<int>")).otherwise(numbers)
        name = lambda b, i: F.concat_ws("/", b, i)
        me = name(band, F.col("own"))
        return F.transform(numbers, lambda j: F.struct(
            (F.concat_ws("-", me, name(other_band, j)) if as_first else F.concat_ws("-", name(other_band, j), me)).alias("tile"),
            F.lit(0 if as_first else 1).alias("side"),
        ))

    mine = F.sequence(F.lit(0), F.col("of")[band] - 1)
    inside = F.transform(mine, lambda j: F.struct(
        F.concat_ws("-", F.concat_ws("/", band, F.least(j, F.col("own"))), F.concat_ws("/", band, F.greatest(j, F.col("own")))).alias("tile"),
        F.when(j == F.col("own"), 2).when(F.col("own") < j, 0).otherwise(1).alias("side"),
    ))
    places = F.concat(inside, to(band + 1, True), to(band - 1, False))
    large = large.withColumn("place", F.explode(places))
    large = large.select("component", "d1", "id", "h", F.col("place.tile").alias("tile"), F.col("place.side").alias("side"))
    return small.unionByName(large)


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = NGRAM, percent: int = PERCENT) -> DataFrame:
    """Link documents whose ``n``-word shingle sets have a Jaccard similarity of ``percent`` or more.

    A-Z are lower-cased; words are what ASCII white space separates; a text of fewer words is one
    shingle of all of them; a text without words, or null, is linked with nothing. Sets are compared
    as 64-bit hashes. Equal sets are one class first. Classes that share a tile key form clusters;
    in a cluster's tiles bit counts bound each overlap and exact intersections decide, except
    between sets that are connected already, which changes no component.

    Returns key, ``n_shingles`` and ``component_id``, the smallest key reachable by links, itself
    included, for each row; a null key counts as none, and is returned only if no other is reachable.
    Repeated rows are rows like others; texts of any length are read whole; an empty table gives no rows. Of other
    columns none is read.
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent must be between 50 and 100")
    rows = input_columns(docs, id=key, text=text).withColumn("h", F.xxhash64("text"))
    kind = dict(rows.dtypes)["id"]
    signatures = stored(
        rows.mapInPandas(_signatures(n, percent), f"id {kind}, h long, n long, d1 long, d2 long, keys array<long>"), "signatures"
    )
    some = signatures.where("n > 0")
    least = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "h")).alias("least")
    classes = some.groupBy("d1").agg(
        least, F.first("n").alias("n"), F.count(F.lit(1)).alias("rows"), F.min("d2").alias("low"), F.max("d2").alias("high")
    )
    one_set = F.when(F.col("low") != F.col("high"), F.raise_error(F.lit("different sets share a hash"))).otherwise(F.col("d1"))
    classes = stored(classes.select(one_set.alias("d1"), "least.id", "least.h", "n", "rows"), "classes")

    clusters = _clusters(some)
    nodes = clusters.join(classes.withColumnRenamed("d1", "node"), "node").withColumnRenamed("node", "d1")
    nodes = stored(nodes.select("d1", "component", "id", "h", "n"), "candidates")
    tiles = _tiles(nodes, percent)
    wanted = small_broadcast(nodes).select(F.col("id").alias("w_id"), F.col("h").alias("w_h"), "d1")
    texts = rows.join(wanted, F.col("id").eqNullSafe(F.col("w_id")) & (F.col("h") == F.col("w_h")))
    texts = texts.groupBy("d1").agg(F.first("text").alias("text"))
    filled = tiles.select("component", "tile", "side", "d1").join(texts, "d1")
    links = stored(filled.groupBy("component", "tile").applyInPandas(_tile(n, percent), "u long, v long"), "links")

    found = connected_components(links).join(classes, F.col("node") == F.col("d1"))
    names = found.groupBy("component").agg(F.min("id").alias("component_id"))
    found = found.join(names, "component").select("d1", "component_id")
    named = classes.join(found, "d1", "left").select("d1", "rows", F.coalesce("component_id", "id").alias("component_id"))
    joined = join_hot(some.select("id", "d1", "n"), stored(named, "class-names"), ["d1"], "rows")
    alone = signatures.where("n = 0").select("id", "n", F.col("id").alias("component_id"))
    result = joined.select("id", "n", "component_id").unionByName(alone)
    return result.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), "component_id")
