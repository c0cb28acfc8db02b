import sys

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark import cloudpickle

from corpusloom.operators.user_functions import filter_columns, filter_rows, map_batches, map_columns, map_rows

# Workers cannot import the tests.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROWS = [(1, "a b", 2), (2, None, 3), (None, "c", None), (4, "", 5), (4, "", 5)]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, `n.x` int").repartition(3)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def words(row):
    return {"words": row["text"].split(), "size": len(row["text"])}


def test_map_rows(docs):
    found = map_rows(docs, words, ["text"], "words array<string>, size int", "doc_id")
    assert found.columns == ["doc_id", "text", "n.x", "words", "size"]
    want = [(*r, None, None) if r[1] is None else (*r, r[1].split(), len(r[1])) for r in ROWS]
    assert rows(found) == sorted(want, key=str)


def test_a_new_column_takes_the_place_of_an_old_one(docs):
    found = map_rows(docs, lambda row: {"text": row["text"].upper()}, ["text"], "text string", "doc_id")
    assert found.columns == ["doc_id", "n.x", "text"]
    assert rows(found.select("text")) == sorted([(t and t.upper(),) for _, t, _ in ROWS], key=str)


def test_nulls_are_given_where_asked_for(docs):
    found = map_rows(docs, lambda row: {"none": [k for k, v in row.items() if v is None]}, ["text", "n.x"], "none array<string>", "doc_id", nulls="give")
    assert rows(found.select("none")) == sorted([([],), (["text"],), (["n.x"],), ([],), ([],)], key=str)
    with pytest.raises(ValueError, match="skip"):
        map_rows(docs, words, ["text"], "words array<string>, size int", "doc_id", nulls="drop")
    with pytest.raises(ValueError, match="name the columns"):
        map_rows(docs, words, [], "words array<string>, size int", "doc_id")


@pytest.mark.parametrize("function,message", [
    (lambda row: {"size": 1 // len(row["text"])}, "doc_id=4: ZeroDivisionError"),
    (lambda row: {"size": "x"}, "failed for doc_id="),
    (lambda row: {"other": 1}, r"gave \['other'\], not \['size'\]"),
    (lambda row: None, "TypeError"),
])
def test_errors_name_the_row(docs, function, message):
    with pytest.raises(Exception, match=message):
        map_rows(docs, function, ["text"], "size int", "doc_id").collect()


def test_map_columns(docs):
    found = map_columns(docs, pc.utf8_length, ["text"], "size long")
    assert rows(found.select("size")) == sorted([(None if t is None else len(t),) for _, t, _ in ROWS], key=str)
    both = map_columns(docs, lambda t, n: {"a": pc.utf8_upper(t), "b": pc.add(n, 1)}, ["text", "n.x"], "b int, a string")
    want = [(None, None) if t is None or n is None else (n + 1, t.upper()) for _, t, n in ROWS]
    assert rows(both.select("b", "a")) == sorted(want, key=str)
    with pytest.raises(Exception, match="1 values for"):
        map_columns(docs.coalesce(1), lambda t: pa.array([1]), ["text"], "size long").collect()
    with pytest.raises(Exception, match="is string, not int32"):
        map_columns(docs, pc.utf8_upper, ["text"], "size int").collect()
    with pytest.raises(Exception, match="no Arrow array"):
        map_columns(docs, lambda t: [1] * len(t), ["text"], "size int").collect()


def test_filters(docs):
    assert rows(filter_rows(docs, lambda row: "a" in row["text"], ["text"], "doc_id")) == [(1, "a b", 2)]
    assert rows(filter_rows(docs, lambda row: row["text"] is None, ["text"], "doc_id", nulls="give")) == [(2, None, 3)]
    assert rows(filter_columns(docs, lambda n: pc.greater(n, 2), ["n.x"])) == sorted([r for r in ROWS if r[2] and r[2] > 2], key=str)


def test_empty_tables(docs):
    none = docs.limit(0)
    assert map_rows(none, words, ["text"], "words array<string>, size int", "doc_id").count() == 0
    assert filter_columns(none, lambda n: pc.greater(n, 2), ["n.x"]).count() == 0
    assert map_batches(none.selectExpr("doc_id", "text", "'train' split"), lambda t: t, "doc_id", "doc_id long, text string").count() == 0


def counted(table):
    ids = table.column("doc_id")
    return pa.table({"first": ids[:1], "n": pa.array([len(ids)])})


def test_batches_are_whole_and_in_order(spark):
    from corpusloom.operators.ranking import with_rank

    docs = spark.range(103).selectExpr("id doc_id", "if(id % 4 = 0, null, if(id % 4 = 1, 'validation', 'train')) split", "'x' text").repartition(7)
    found = map_batches(docs, counted, "doc_id", "first long, n int", batch_size=10, epoch=2).collect()
    order = {}
    for r in with_rank(docs, "doc_id", [123, 2], by=["split"]).collect():
        order.setdefault(r.split, {})[r["rank"]] = r.doc_id
    want = set()
    for split, ids in order.items():
        for b in range(-(-len(ids) // 10)):
            want.add((split, b, ids[b * 10 + 1], min(10, len(ids) - b * 10)))
    assert {(r.split, r.batch_id, r.first, r.n) for r in found} == want and len(found) == len(want)


def test_errors_name_the_batch(spark):
    docs = spark.range(5).selectExpr("id doc_id", "'train' split")
    with pytest.raises(Exception, match="failed for batch 0 of split 'train': KeyError"):
        map_batches(docs, lambda t: t.column("nothing"), "doc_id", "n int").collect()
    with pytest.raises(Exception, match=r"gave \['doc_id'\], not \['n'\]"):
        map_batches(docs, lambda t: t, "doc_id", "n int").collect()
