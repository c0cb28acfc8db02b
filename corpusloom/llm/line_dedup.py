"""Lines that repeat, or nearly: a deletion-neighbourhood join over distinct lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusloom.llm.tables import BROADCAST_ROWS, input_columns, join_hot, left_null_safe, small_broadcast, stored

MAX_EDITS = 1
# Parts of a line, of which a single edit changes one; first few, then more for lines that are left.
COARSE, FINE = 2, 8


def _is_line(line: Column) -> Column:
    return F.trim(F.translate(line, "\t\r\x0b\x0c", "    ")) != ""


def _line_id(line: Column) -> list[Column]:
    """128 bits that stand for a line."""
    return [F.xxhash64(line).alias("a"), F.xxhash64(F.lit(7), line).alias("b")]


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    rows = input_columns(docs, id=key, text=text)
    return rows.select("id", F.xxhash64("text").alias("h"), F.split("text", "\n", -1).alias("lines"))


def _occurrences(docs: DataFrame, key: str, text: str) -> DataFrame:
    rows = _rows(docs, key, text).select("id", "h", F.posexplode("lines").alias("pos", "line"))
    return rows.where(_is_line(F.col("line")))


def _hole(roles: DataFrame, parts: int) -> DataFrame:
    """Where the part of a line begins and ends, and 128 bits of the line without it.

    Two lines one edit apart agree outside one part. Parts are laid out by the length of the
    shorter line, ``base``: a line of that length has role 0; one longer by a character has role 1
    and that character more in the part.
    """
    base = F.length("line") - F.col("role")
    n = F.least(F.lit(parts), base)
    left = F.floor((F.col("part") - 1) * base / n).cast("int")
    right = (base - F.floor(F.col("part") * base / n)).cast("int")
    roles = roles.withColumns({"left": left, "right": right})
    before = F.substring(F.col("line"), F.lit(1), F.col("left"))
    after = F.substring(F.col("line"), F.length("line") - F.col("right") + 1, F.col("right"))
    outside = (base, F.col("part"), before, after)
    return roles.withColumns({"o1": F.xxhash64(*outside), "o2": F.xxhash64(F.lit(7), *outside)})


def _holes(lines: DataFrame, parts: int) -> DataFrame:
    """A row for each line, role and part."""
    roles = lines.withColumn("role", F.explode(F.array(F.lit(0), F.lit(1))))
    base = F.length("line") - F.col("role")
    roles = roles.where(base > 0).withColumn("part", F.explode(F.sequence(F.lit(1), F.least(F.lit(parts), base))))
    return _hole(roles, parts)


def _coarse_holes(line: Column) -> list[Column]:
    """The keys of :func:`_holes` with ``COARSE`` parts, in one row."""
    keys = []
    for role in (0, 1):
        base = F.length(line) - role
        for part in range(1, COARSE + 1):
            left = F.floor(base * (part - 1) / COARSE).cast("int")
            right = (base - F.floor(base * part / COARSE)).cast("int")
            outside = (F.lit(part), base, F.substring(line, F.lit(1), left), F.substring(line, F.length(line) - right + 1, right))
            keys.append(F.when(base > 0, F.xxhash64(*outside)))
    return keys


def _sharing(holes: DataFrame) -> DataFrame:
    """Rows of a stored table of hole keys ``o1`` for which another line has the same key."""
    shared = holes.groupBy("o1").agg(F.min("a").alias("low"), F.max("a").alias("high"), F.count(F.lit(1)).alias("n"))
    shared = stored(shared.where("low <> high").select("o1", "n"), "shared-holes")
    if shared.count() <= BROADCAST_ROWS:
        return holes.join(F.broadcast(shared.select("o1")), "o1")
    return join_hot(holes, shared, ["o1"], "n")


def _candidates(docs: DataFrame, key: str, text: str, lines: DataFrame) -> DataFrame:
    """Lines that share a half with another line, with their text: only these are read a second time."""
    halves = lines.select("a", "b", F.explode("halves").alias("o1")).where("o1 IS NOT NULL")
    wanted = stored(_sharing(halves).select("a", "b").distinct(), "lines-sharing-halves")
    again = _occurrences(docs, key, text).select(*_line_id(F.col("line")), "line")
    found = again.join(small_broadcast(wanted), ["a", "b"], "left_semi")
    found = found.groupBy("a", "b").agg(F.first("line").alias("line"))
    return stored(found.join(lines.select("a", "b", "first"), ["a", "b"]), "candidate-lines")


def _neighbours(lines: DataFrame) -> DataFrame:
    """For each line the earliest of the lines exactly one edit away, if there is one.

    Variants delete one character of the part in which the lines differ. Lines of one length that
    agree after deleting the same place differ only there; a longer line whose variant is another
    line is that line with one character more. Both make groups of which any two that count are one edit
    apart, so each line needs only the earliest, found without listing pairs. Such a group has at most
    as many lines as there are characters, times the length.
    """
    holes = stored(_holes(lines, FINE).select("a", "b", "role", "part", "o1"), "line-holes")
    fine = _sharing(holes).groupBy("a", "b").agg(F.collect_set(F.struct("role", "part")).alias("parts"))
    rows = lines.join(fine, ["a", "b"]).withColumn("in", F.explode("parts"))
    rows = _hole(rows.select("a", "b", "line", "first", "in.role", "in.part"), FINE)
    hole = F.substring(F.col("line"), F.col("left") + 1, F.length("line") - F.col("left") - F.col("right"))
    rows = rows.select("a", "b", "role", "first", "o1", "o2", hole.alias("hole"))
    # Place 0: the part as it is, the base that a longer line's variant may meet.
    places = F.sequence(F.when(F.col("role") == 0, 0).otherwise(1), F.length("hole"))
    rows = rows.withColumn("place", F.explode(places))
    variant = F.concat(
        F.substring(F.col("hole"), F.lit(1), F.col("place") - 1),
        F.substring(F.col("hole"), F.col("place") + 1, F.length("hole")),
    )
    variant = F.when(F.col("place") == 0, F.col("hole")).otherwise(variant)
    place = F.when(F.col("role") == 0, F.col("place")).otherwise(0)
    rows = rows.withColumn("variant", variant).withColumn("place", place)
    key = ("o1", "o2", "place", "variant")
    rows = rows.select(
        "a", "b", "role", "place", F.xxhash64(*key).alias("k1"), F.xxhash64(F.lit(7), *key).alias("k2"),
        F.struct("first", "a", "b").alias("me"),
    )
    same = Window.partitionBy("k1", "k2")
    base = F.min(F.when(F.col("role") == 0, F.col("me"))).over(same)
    longer = F.min(F.when(F.col("role") == 1, F.col("me"))).over(same)
    near = F.when((F.col("place") == 0) & (F.col("role") == 0), longer).otherwise(base)
    rows = rows.withColumn("near", near).where("near IS NOT NULL AND (near.a <> a OR near.b <> b)")
    return rows.groupBy("a", "b").agg(F.min("near").alias("near"))


def line_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", max_edits: int = MAX_EDITS) -> DataFrame:
    """Each distinct line, as 128 bits ``a, b``, with its first occurrence, its count, and its neighbour.

    ``a, b, first, n, near``, where ``near`` is the first occurrence of the earliest line
    within ``max_edits`` (0 or 1) that comes before, else null. Texts of lines are moved only for
    those that share half of themselves with another line.
    """
    if max_edits not in (0, 1):
        raise ValueError("max_edits must be 0 or 1")
    at = F.struct(F.col("id").isNull().alias("no_id"), "id", "h", "pos").alias("first")
    rows = _occurrences(docs, key, text).select(*_line_id(F.col("line")), at, *[c.alias(f"c{i}") for i, c in enumerate(_coarse_holes(F.col("line")))])
    halves = [F.first(f"c{i}").alias(f"c{i}") for i in range(2 * COARSE)]
    lines = rows.groupBy("a", "b").agg(F.min("first").alias("first"), F.count(F.lit(1)).alias("n"), *halves)
    lines = stored(lines.select("a", "b", "first", "n", F.array(*[f"c{i}" for i in range(2 * COARSE)]).alias("halves")), "lines")
    if max_edits == 0:
        return lines.select("a", "b", "first", "n", F.lit(None).cast(lines.schema["first"].dataType).alias("near"))
    texts = _candidates(docs, key, text, lines)
    near = texts.join(_neighbours(texts), ["a", "b"]).where("near.first < first")
    near = stored(near.select("a", "b", "line", "near"), "neighbours")
    other = texts.select(F.col("a").alias("n_a"), F.col("b").alias("n_b"), F.col("line").alias("n_line"))
    checked = near.join(other, (F.col("near.a") == F.col("n_a")) & (F.col("near.b") == F.col("n_b")))
    checked = checked.where(F.levenshtein("line", "n_line", max_edits) >= 0)
    checked = checked.select("a", "b", F.col("near.first").alias("near"))
    return lines.select("a", "b", "first", "n").join(checked, ["a", "b"], "left")


def _mask(gone: Column) -> Column:
    """A byte for each line up to the last that goes, 1 for those that do, from their sorted numbers: as long as the text has lines."""
    run = F.transform(gone, lambda p, i: F.concat(
        F.repeat(F.lit("0"), p - F.when(i == 0, -1).otherwise(F.get(gone, i - 1)) - 1), F.lit("1")))
    return F.array_join(run, "").cast("binary")


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", max_edits: int = MAX_EDITS) -> DataFrame:
    """Each text without the lines that came before, or nearly.

    Lines end at line feeds. Occurrences are ordered by key (null last), then line number. A line
    goes if an equal one, or one within ``max_edits`` single-character insertions, deletions or
    replacements, comes before it, kept or not. Blank lines stay and are never compared.

    Returns key, ``n_lines`` (blank ones too), ``n_dropped`` and ``text`` for each row. A null text stays null, with
    no lines. Rows that repeat key and text are one document and get the same result. Of
    rows with the same key the order between texts is that of a hash. A text of any length and number of lines is one
    row, whose lines that go are taken out in one walk; an empty table gives no rows. Of other columns none is read.
    """
    classes = stored(line_classes(docs, key, text, max_edits), "line-classes")
    touched = stored(classes.where("n > 1 OR near IS NOT NULL").select("a", "b", "first", "n", "near"), "touched-lines")
    at = _occurrences(docs, key, text).select("id", "h", "pos", *_line_id(F.col("line")))
    if touched.count() <= BROADCAST_ROWS:
        hits = at.join(F.broadcast(touched), ["a", "b"])
    else:
        hits = join_hot(at, touched, ["a", "b"], "n")
    is_first = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("h") == F.col("first.h")) & (F.col("pos") == F.col("first.pos"))
    gone = hits.where(F.col("near").isNotNull() | ~is_first).groupBy("id", "h").agg(F.sort_array(F.collect_set("pos")).alias("gone"))
    gone = stored(gone.select("id", "h", F.size("gone").alias("n_gone"), _mask(F.col("gone")).alias("mask")), "gone-lines")
    rows = left_null_safe(_rows(docs, key, text), small_broadcast(gone, 1 + F.octet_length("mask") / 8), ["id", "h"])
    # One byte of the mask for each line, found at once; none beyond the last line that goes.
    goes = lambda i: F.coalesce(F.substring(F.col("mask"), i + 1, F.lit(1)) == F.lit(bytearray(b"1")), F.lit(False))
    kept = F.filter("lines", lambda line, i: ~goes(i))
    return rows.select(
        F.col("id").alias(key), F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines")).cast("long").alias("n_lines"),
        F.coalesce("n_gone", F.lit(0)).cast("long").alias("n_dropped"), F.array_join(kept, "\n").alias("text"),
    )
