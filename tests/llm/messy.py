"""Rows that go wrong easily, and names that clash."""

LONG = "word " * 5_000 + "end"

TEXTS = [
    (1, "one two three four five"), (2, "one two  three\nfour five"), (3, None), (4, ""), (5, "   "),
    (6, "one two three four five"), (7, LONG), (8, LONG), (9, "Ünï cödé ñ"), (10, "x"), (None, "one two three four five"),
    (None, None), (11, "tie"), (11, "tie"), (11, "other text of the same id"), (12, "\n\n"), (13, "end\n"),
]

COLUMNS = "doc_id long, text string, id long, h string, n int, copies int, part string, `a.b` int, lang string"


def messy(spark):
    """The texts with columns named like those that operators use inside."""
    rows = [(i, t, 7, "h", None, 2, None, 1, None) for i, t in TEXTS]
    return spark.createDataFrame(rows, COLUMNS)


def empty(spark):
    return spark.createDataFrame([], COLUMNS)
