import re

import pytest

import corpus_pipeline
from corpus_pipeline import STAGES
from corpusloom.llm.decontaminate import contamination
from corpusloom.llm.pieces import encode_text, read_pieces

from .messy import TEXTS, empty, messy
from .test_decontaminate import brute as contaminated

from .test_ngram_join import brute as components

SF_DIR = "/root/testdata/sf0.001"


def test_run_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    docs = [d for d in docs if re.search(r"[^\W\d_]", d[1])]  # every language is known here
    first = {}
    for doc_id, text in sorted(docs):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text), (doc_id, text))
    docs = list(first.values())
    docs = _kept(docs)
    bad = {c[0] for c in contaminated(docs, items) if c[5]}
    docs = [d for d in docs if d[0] not in bad]
    pieces = read_pieces(open(corpus_pipeline.public_tokenizers.path(corpus_pipeline.MODEL), "rb").read())
    found = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, SF_DIR).collect()}
    assert found == {i: encode_text(t, pieces) for i, t in docs}


def _kept(docs):
    keep = {c[0] for c in components(docs) if c[0] == c[2]}
    return [d for d in docs if d[0] in keep]


@pytest.mark.parametrize("name,stage", STAGES)
def test_stages_take_messy_and_empty_tables(spark, name, stage):
    docs = messy(spark)
    kept = stage(spark, docs, SF_DIR)
    assert name == STAGES[-1][0] or kept.columns == docs.columns
    assert 0 < kept.count() <= len(TEXTS)
    assert stage(spark, empty(spark), SF_DIR).count() == 0


def test_what_stages_drop(spark):
    stages = dict(STAGES)
    texts = lambda name: sorted(((r.doc_id, r.text) for r in stages[name](spark, messy(spark), SF_DIR).collect()), key=str)
    kept = texts("exact dedup")
    assert len(kept) == len({re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in TEXTS})
    assert (1, "one two three four five") in kept and (None, "one two three four five") not in kept
    assert {i for i, _ in texts("language ID")} == {i for i, t in TEXTS if re.search(r"[^\W\d_]", t or "")}


def test_contaminated_documents_go(spark):
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    text = items.orderBy("item_id").first().text
    docs = spark.createDataFrame([(1, text, "en", "s", 1), (2, "clean words only", "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    assert contamination(docs, items).where("contaminated").first().doc_id == 1
    assert [r.doc_id for r in dict(STAGES)["benchmark decontamination"](spark, docs, SF_DIR).collect()] == [2]
