import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm.language_id import FEATURES, best_temperature, counts, held_out, ngram_ids, predict_language, train_ftrl, train_language_model
from corpusloom.llm import language_id

from .messy import TEXTS, empty, messy


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = train_language_model(docs.where(~held_out(F.col("doc_id"))), per_language=100)
    found = predict_language(docs, model).join(docs, "doc_id").where(held_out(F.col("doc_id"))).toPandas()
    assert (found["lang_pred"] == found["lang"]).mean() > 0.98
    assert found["score"].between(0, 1).all() and model.languages == ["de", "en", "es", "fr"]
    assert (model.weights == 0).mean() > 0.5  # the L1 penalty
    rows = predict_language(messy(spark), model).collect()
    assert len(rows) == len(TEXTS)
    assert {r.lang_pred for r in rows if r.doc_id in (3, 4, 5, 12)} == {"und"}
    assert all(r.lang_pred != "und" for r in rows if r.doc_id in (1, 7, 9, 10))


def test_nothing_to_learn(spark):
    model = train_language_model(messy(spark))
    assert {(r.lang_pred, r.score) for r in predict_language(messy(spark), model).collect()} == {("und", 0.0)}
    assert predict_language(empty(spark), model).count() == 0


def test_prediction_sees_only_text(spark):
    docs = spark.createDataFrame([(i, t, lang, "s") for i, (t, lang) in enumerate([("aba abab", "x"), ("kiki ikik", "y")] * 20)], "doc_id int, text string, lang string, source string")
    model = train_language_model(docs)
    rows = predict_language(docs.withColumn("lang", F.lit("y")), model).collect()
    assert [r.lang_pred for r in sorted(rows, key=lambda r: r.doc_id)][:2] == ["x", "y"]


def test_long_texts_in_pieces(monkeypatch):
    text = "Ab cñ. " * 50
    whole = counts(text)
    monkeypatch.setattr(language_id, "PIECE", 70)
    assert sum(len(x) for x in ngram_ids(text)) > 0 and abs(int(counts(text).sum()) - int(whole.sum())) < 12 * len(language_id.ORDERS)
    assert list(ngram_ids("12 .;")) == [] == list(ngram_ids(None))


def test_ftrl_learns_and_leaves_useless_weights_zero():
    draw = np.random.default_rng(1)
    labels = draw.integers(0, 2, 300)
    rows = [(np.array([label, 5, 6]), np.array([1.0, draw.random() * 0.01, 0.01])) for label in labels]
    w, bias = train_ftrl(rows, labels, 2)
    assert w.shape == (FEATURES, 2) and w[0, 0] > 0 > w[0, 1] and not w[5:7].any()


def test_temperature_calibrates():
    draw = np.random.default_rng(2)
    labels = draw.integers(0, 3, 4_000)
    right = draw.random(4_000) < 0.8
    top = np.where(right, labels, (labels + 1) % 3)
    scores = np.eye(3)[top] * 9.0
    t = best_temperature(scores, labels)
    p = np.exp(9 / t) / (np.exp(9 / t) + 2)
    assert abs(p - 0.8) < 0.03


def test_repeated_rows_leave_each_language_its_sample(spark, monkeypatch):
    learned = []
    train = language_id.train_ftrl
    monkeypatch.setattr(language_id, "train_ftrl", lambda rows, labels, n: learned.append(np.bincount(labels)) or train(rows, labels, n))
    texts = {"de": "der hund und die katze", "en": "the dog and a cat", "es": "el perro y los gatos"}
    rows = [(i, f"{text} {chr(97 + i % 26) * (1 + i // 26)}", lang) for lang, text in texts.items() for i in range(40)]
    rows += [(7, "ein hund", "de")] * 500 + [(None, "eine katze", "de")] * 500
    model = train_language_model(spark.createDataFrame(rows, "doc_id long, text string, lang string"), per_language=20)
    assert model.languages == ["de", "en", "es"] and learned[0].tolist() == [16, 16, 16]
    # One cell that holds more than all languages may: the hashes of a language are cut, not the cell.
    monkeypatch.setattr(language_id.F, "shiftright", lambda column, bits: F.col(column) * 0)
    learned.clear()
    model = train_language_model(spark.createDataFrame(rows, "doc_id long, text string, lang string"), per_language=5)
    assert model.languages == ["de", "en", "es"] and learned[0].tolist() == [4, 4, 4]


def test_no_ngram_is_lost_between_pieces(monkeypatch):
    texts = ["a", " a", "a ", "abcdefg hij  12 klm", "  12 3 abc", "abc 12 3  ", "a 1 2 3 4 b", "ß日本 x" * 9, "12 34 56", "", None]
    found = lambda t: np.sort(np.concatenate([np.zeros(0, "int64"), *ngram_ids(t)])).tolist()
    whole = [found(t) for t in texts]
    for piece in range(1, 9):
        monkeypatch.setattr(language_id, "PIECE", piece)
        assert [found(t) for t in texts] == whole, piece


def test_prediction_equals_a_plain_recomputation(spark):
    """Scores from n-grams counted one by one in Python, and the model's weights."""
    import math
    from collections import Counter

    from corpusloom.llm import language_id as module

    def features(text):
        letters = "".join(c if c.isalpha() else " " for c in (text or "").lower())
        words = letters.split()
        if not words:
            return Counter()
        line = " " + " ".join(words) + " "
        found = Counter()
        for n in module.ORDERS:
            for i in range(len(line) - n + 1):
                total = n
                for c in line[i : i + n]:
                    total = (total + ord(c)) * 0x9E3779B97F4A7C15 % (1 << 64)
                    total ^= total >> 29
                found[total % module.FEATURES] += 1
        return found

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = train_language_model(docs.where(~held_out(docs.doc_id)))
    rows = [(r.doc_id, r.text) for r in docs.limit(60).collect()] + [(-1, None), (-2, "12 34"), (-3, "Ünï 1 cödé"), (-4, "x" * 70_000)]
    found = {r.doc_id: (r.lang_pred, r.score) for r in predict_language(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    for i, text in rows:
        counts = features(text)
        if not counts:
            assert found[i] == ("und", 0.0)
            continue
        n = sum(counts.values())
        scores = [sum(float(model.weights[f, k]) * m for f, m in counts.items()) / n + model.bias[k] for k in range(len(model.languages))]
        scaled = [s / model.temperature for s in scores]
        total = sum(math.exp(s - max(scaled)) for s in scaled)
        best = max(range(len(scaled)), key=lambda k: scaled[k])
        assert found[i][0] == model.languages[best] and abs(found[i][1] - math.exp(scaled[best] - max(scaled)) / total) < 1e-6


def test_languages_and_bytes_of_the_sample_are_bounded(spark, monkeypatch):
    from corpusloom.llm import language_id as module

    rows = [(i, f"word{'abc'[i % 3]} text {i}" * 5, ["en", "de", "fr"][i % 3]) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    monkeypatch.setattr(module, "SAMPLE_BYTES", 6_000)
    assert train_language_model(docs).languages == ["de", "en", "fr"]
    monkeypatch.setattr(module, "MAX_LANGUAGES", 2)
    with pytest.raises(ValueError, match="at most 2 languages"):
        train_language_model(docs)
