import random
from collections import Counter

import pytest

from corpusloom.llm.line_dedup import dedup_lines, line_classes

from .messy import TEXTS, empty, messy


def near(a, b, edits):
    if a == b:
        return True
    if not edits or abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] or a[i + 1 :] == b[i:] or a[i:] == b[i + 1 :]


def brute(docs, edits):
    seen, found = [], {}
    for doc_id, text in sorted(docs, key=lambda d: d[0]):
        kept, gone = [], 0
        lines = text.split("\n")
        for line in lines:
            if line.strip(" \t\r\x0b\x0c") == "":
                kept.append(line)
            elif any(near(line, s, edits) for s in seen):
                gone += 1
            else:
                kept.append(line)
            if line.strip(" \t\r\x0b\x0c"):
                seen.append(line)
        found[doc_id] = (len(lines), gone, "\n".join(kept))
    return found


def made(seed):
    draw = random.Random(seed)
    line = lambda: "".join(draw.choice("abñ ") for _ in range(draw.randint(0, 9)))
    long = ["".join(draw.choice("abcdefgh ñ") for _ in range(80)) for _ in range(4)]

    def changed(s):
        i = draw.randrange(len(s))
        return draw.choice([s[:i] + s[i + 1 :], s[:i] + "z" + s[i:], s[:i] + "z" + s[i + 1 :], s[:i] + "zz" + s[i + 2 :]])

    return [(i, "\n".join(draw.choice([line, line, lambda: changed(draw.choice(long))])() for _ in range(6))) for i in range(40)]


@pytest.mark.parametrize("seed,edits", [(1, 1), (2, 1), (3, 0)])
def test_equal_to_brute_force(spark, seed, edits):
    docs = made(seed)
    table = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, pos int, line string")
    rows = dedup_lines(table, max_edits=edits).collect()
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in rows} == brute(docs, edits)


def test_messy_rows(spark):
    rows = dedup_lines(messy(spark)).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in TEXTS)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[3].text is None and by_id[3].n_lines == 0 and by_id[4].text == "" and by_id[5].text == "   "
    assert by_id[8].text == "" and by_id[8].n_dropped == 1 and by_id[7].n_dropped == 0
    ties = [r for r in rows if r.doc_id == 11 and r.text == "tie"]
    assert len(ties) == 2  # a repeated row is one document
    assert all(r.n_dropped == 1 for r in rows if r.doc_id is None and r.text is not None)  # null ids come last


def test_other_bounds_are_refused_and_empty_tables_stay_empty(spark):
    assert dedup_lines(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        line_classes(empty(spark), max_edits=2)


def test_many_lines_of_one_text_go_in_linear_time(spark):
    import time

    def seconds(n):
        text = "\n".join(["the same line again"] * n + [chr(97 + i) * 9 for i in range(20)])
        start = time.perf_counter()
        [row] = dedup_lines(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
        assert (row.n_lines, row.n_dropped) == (n + 20, n - 1)
        assert row.text.split("\n")[:2] == ["the same line again", "a" * 9]
        return time.perf_counter() - start

    seconds(1_000)
    # 16 times the lines; a walk for each dropped line would take 256 times as long.
    assert seconds(320_000) < 16 * seconds(20_000) + 20
