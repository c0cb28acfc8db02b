import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from corpusloom.llm import pseudo_likelihood as pl
from corpusloom.llm.tables import input_columns

from .messy import TEXTS, empty, messy


def brute(classes, network, sizes):
    total = 0.0
    for i, c in enumerate(classes):
        h = network.bias.astype("float64").copy()
        for k, offset in enumerate(pl.OFFSETS):
            j = i + offset
            h += network.tables[k][pl.ROW_OF[classes[j] if 0 <= j < len(classes) else 0]]
        h = np.tanh(h)
        groups, members = np.exp(h @ network.groups + network.groups_bias), np.exp(h @ network.members[c // 64] + network.members_bias[c // 64])
        total += math.log(groups[c // 64] / groups.sum()) + math.log(members[c % 64] / members.sum()) - math.log(max(sizes[c], 1))
    return total


def test_probabilities_of_all_classes_sum_to_one():
    draw = np.random.default_rng(3)
    network = pl.Network.fresh(draw.integers(0, 50, pl.CLASSES))
    # Every class in the middle of the same four neighbours.
    texts = [np.array([5, 900, c, 2, 4_000], "<u2").tobytes() for c in range(1, pl.CLASSES)]
    padded, at, _ = pl.padded_texts(texts)
    each = np.exp(network.log_probabilities(padded, at[2::5]))
    zero = math.exp(brute([5, 900, 0, 2, 4_000], network, np.ones(pl.CLASSES)) - brute_rest(network))
    assert abs(each.sum() + zero - 1) < 1e-4


def brute_rest(network):
    """The four words around a class 0, which are scored with it."""
    padded = np.array([0, 0, 5, 900, 0, 2, 4_000, 0, 0])
    return float(network.log_probabilities(padded, np.array([2, 3, 5, 6])).sum())


def test_scores_equal_brute_force(spark):
    rows = input_columns(messy(spark), id="doc_id", text="text")
    vocabulary = pl.build_vocabulary(rows)
    network = pl.Network.fresh(vocabulary.counts)
    texts = pl._classes(rows, vocabulary)
    class_of = pl.ClassOf(vocabulary.frequent)
    short = [t for _, t in TEXTS if len(t or "") < 100]
    got = sorted(r.log_likelihood for r in pl.score_texts(texts, network, vocabulary).collect() if r.n_tokens < 100)
    want = sorted(brute([class_of[w] for w in pl.words(t)], network, vocabulary.sizes) for t in short)
    assert np.allclose(got, want, rtol=1e-4, atol=1e-4)


def test_counts_and_classes(spark, documents):
    rows = input_columns(documents, id="doc_id", text="text")
    vocabulary = pl.build_vocabulary(rows)
    from collections import Counter

    counted = Counter(w for r in documents.collect() for w in pl.words(r.text))
    top = sorted(counted, key=lambda w: (-counted[w], w))[: pl.FREQUENT]
    assert vocabulary.frequent == {w: i + 1 for i, w in enumerate(top)}
    class_of = pl.ClassOf(vocabulary.frequent)
    sizes, counts = np.zeros(pl.CLASSES), np.zeros(pl.CLASSES)
    for w, n in counted.items():
        sizes[class_of[w]] += 1
        counts[class_of[w]] += n
    assert (sizes == vocabulary.sizes).all() and (counts == vocabulary.counts).all()


def test_gradient():
    draw = np.random.default_rng(1)
    padded, at, _ = pl.padded_texts([draw.integers(1, pl.CLASSES, 9).astype("<u2").tobytes() for _ in range(3)])
    network = pl.Network.fresh(np.ones(pl.CLASSES))
    network = pl.Network(*[p.astype("float64") for p in network.parts()])
    loss = lambda: -network.log_probabilities(padded, at).mean()
    for p, g in zip(network.parts(), network.gradient(padded, at), strict=True):
        i = int(np.abs(g).argmax())
        p.flat[i] += 1e-5
        high = loss()
        p.flat[i] -= 2e-5
        low = loss()
        p.flat[i] += 1e-5
        assert abs((high - low) / 2e-5 - g.flat[i]) < 1e-4


def test_training_beats_word_frequencies_on_other_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = input_columns(docs, id="doc_id", text="text").repartition(2, "id")
    vocabulary = pl.build_vocabulary(rows)
    texts = pl.stored(pl._classes(rows, vocabulary), "classes")
    seen, other = texts.where("id % 5 > 0"), texts.where("id % 5 = 0")
    mean = lambda n: pl.score_texts(other, n, vocabulary).agg(F.sum("log_likelihood") / F.sum("n_tokens")).first()[0]
    assert mean(pl.train_network(seen, vocabulary)) > mean(pl.Network.fresh(vocabulary.counts)) + 0.1


def test_messy_and_empty(spark):
    rows = pl.pseudo_likelihood(messy(spark)).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        assert (r.n_tokens == 0) == (r.mean_log_likelihood is None) and r.log_likelihood <= 0
    assert pl.pseudo_likelihood(empty(spark)).count() == 0


def test_words_of_a_class_count_as_often_as_they_occur(spark, monkeypatch):
    from collections import Counter

    monkeypatch.setattr(pl, "train_network", lambda texts, vocabulary: pl.Network.fresh(vocabulary.counts))
    common = [f"w{i}" for i in range(pl.FREQUENT)] * 40
    rare = [f"r{i}" for i in range(500) for _ in range(1 + i % 30)]
    texts = [" ".join(common), " ".join(rare), "r29 r0 r29 w5 r30", None, "r29 r0 r29 w5 r30", "r59"]
    docs = spark.createDataFrame([(None if i > 2 else 7, t) for i, t in enumerate(texts)], "doc_id long, text string")
    counted = Counter(w for t in texts for w in pl.words(t))
    for known in (0, 100, 100_000):
        monkeypatch.setattr(pl, "KNOWN_WORDS", known)
        vocabulary = pl.build_vocabulary(input_columns(docs, id="doc_id", text="text"))
        assert len(vocabulary.known) - pl.FREQUENT <= known and len(vocabulary.known) + vocabulary.others.count() == len(counted)
        class_of = pl.ClassOf(vocabulary.frequent)
        network = pl.Network.fresh(vocabulary.counts)

        def want(text):
            found = pl.words(text)
            of_class = brute([class_of[w] for w in found], network, np.ones(pl.CLASSES))
            return of_class + sum(math.log(counted[w] / vocabulary.counts[class_of[w]]) for w in found)

        got = sorted(r.log_likelihood for r in pl.pseudo_likelihood(docs).collect())
        assert np.allclose(got, sorted(map(want, texts)), rtol=1e-4, atol=1e-4)


def test_rounds_together_mask_each_word_once(spark, monkeypatch):
    rows = input_columns(spark.createDataFrame([(1, "a b c d e f g h i j k l m"), (2, "n o")], "doc_id long, text string"), id="doc_id", text="text")
    vocabulary = pl.build_vocabulary(rows)
    texts = pl.stored(pl._classes(rows.coalesce(1), vocabulary), "classes")
    padded, places, _ = pl.padded_texts([r.classes for r in texts.collect()])
    masked = []
    monkeypatch.setattr(pl.Adam, "learn", lambda self, padded, at: masked.extend(at.tolist()))

    # The rounds in this process, over all texts side by side.
    class Local:
        def select(self, _):
            return self

        def mapInPandas(self, run, _):
            list(run(iter([pd.DataFrame({"classes": [r.classes for r in texts.collect()]})])))
            raise StopIteration

    for number in range(pl.ROUNDS):
        try:
            pl._train_round(Local(), pl.Network.fresh(vocabulary.counts), number)
        except StopIteration:
            pass
    assert sorted(masked) == places.tolist()
