"""Language of a text: sparse multinomial regression on TF-IDF character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from corpusloom.llm.tables import input_columns, released, stored

UNKNOWN = "und"
ORDERS = (1, 2, 3, 4)
FEATURES = 1 << 16
# Labelled documents of each language that are learned from, and texts read in pieces of so many characters.
SAMPLE_OF_LANGUAGE = 1_000
PIECE = 1 << 16
# Languages that can be learned (a megabyte of weights each on the driver while they are), and bytes of the sample there.
MAX_LANGUAGES, SAMPLE_BYTES = 200, 256 << 20
# Follow the regularised leader: learning rate, and the elastic net's two penalties.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.05, 0.5
EPOCHS = 3
# TF-IDF values are frequencies; times this they are of the order of 1.
SCALE = 10.0


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def ngram_ids(text: str | None) -> Iterator[np.ndarray]:
    """Hashed n-grams of the lower-cased letters, anything else being one space; a long text in pieces, none lost between them."""
    text = (text or "").lower()
    space, after_letter, tail = np.array([32], "uint64"), False, None
    for start in range(0, len(text), PIECE):
        codes = np.frombuffer(text[start : start + PIECE].encode("utf-32-le", "replace"), "<u4").astype("uint64")
        letter = _letters()[codes]
        keep = letter.copy()
        keep[1:] |= letter[:-1]
        keep[0] |= after_letter
        after_letter = letter[-1]
        codes = np.where(letter, codes, np.uint64(32))[keep]
        if tail is None:
            if not letter.any():
                continue
            codes, tail = np.concatenate([space, codes]), codes[:0]
        if start + PIECE >= len(text):
            codes = np.concatenate([codes, space])
        if not len(codes):
            continue
        found = []
        for n in ORDERS:
            # Those that end in this piece.
            near = np.concatenate([tail[max(len(tail) - n + 1, 0) :], codes])
            size = max(len(near) - n + 1, 0)
            total = np.full(size, n, "uint64")
            for i in range(n):
                total = (total + near[i : size + i]) * np.uint64(0x9E3779B97F4A7C15)
                total ^= total >> np.uint64(29)
            found.append(total)
        tail = np.concatenate([tail, codes])[-max(ORDERS) + 1 :]
        yield (np.concatenate(found) % np.uint64(FEATURES)).astype("int64")


def counts(text: str | None) -> np.ndarray:
    """How often each feature occurs in the whole text."""
    total = np.zeros(FEATURES, "int64")
    for ids in ngram_ids(text):
        total += np.bincount(ids, minlength=FEATURES)
    return total


@dataclass
class Model:
    """Weights already times IDF: a text's scores are the mean of its n-grams' rows, plus bias."""

    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        total, n = np.zeros(len(self.languages)), 0
        for ids in ngram_ids(text):
            total += self.weights[ids].sum(axis=0, dtype="float64")
            n += len(ids)
        if n == 0 or not self.languages:
            return UNKNOWN, 0.0
        p = _softmax((total / n + self.bias) / self.temperature)
        best = int(np.argmax(p))
        return self.languages[best], float(p[best])


def _softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train_ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, n_classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias by FTRL-proximal over sparse rows (features, values); the L1 penalty leaves most weights 0."""
    z, n = np.zeros((FEATURES + 1, n_classes)), np.zeros((FEATURES + 1, n_classes))

    def weights(at: np.ndarray) -> np.ndarray:
        zs, ns = z[at], n[at]
        one = L1 * (at < FEATURES)[:, None]  # the bias is not penalised
        return np.where(np.abs(zs) <= one, 0.0, (np.sign(zs) * one - zs) / ((BETA + np.sqrt(ns)) / ALPHA + L2))

    order = np.random.default_rng(0)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            at, values = np.append(rows[i][0], FEATURES), np.append(rows[i][1], 1.0)
            w = weights(at)
            error = _softmax(values @ w)
            error[labels[i]] -= 1.0
            g = values[:, None] * error
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    w = weights(np.arange(FEATURES + 1))
    return w[:-1], w[-1]


def best_temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss on rows that were not trained on."""
    if not len(labels):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 121))
    loss = [-np.log(np.maximum(_softmax(scores / t)[np.arange(len(labels)), labels], 1e-300)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def _document_frequencies(rows: DataFrame) -> tuple[np.ndarray, int]:
    """In how many documents each feature occurs, over all of them; tasks add up their own first."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros(FEATURES, "int64"), 0
        for batch in batches:
            for text in batch["text"]:
                seen = np.zeros(FEATURES, bool)
                for ids in ngram_ids(text):
                    seen[ids] = True
                total += seen
                n += 1
        at = np.flatnonzero(total)
        yield pd.DataFrame({"feature": np.append(at, -1), "n": np.append(total[at], n)})

    found = rows.select("text").mapInPandas(released(run), "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    frequencies, n = np.zeros(FEATURES, "int64"), 0
    for r in found.collect():  # at most FEATURES + 1 rows
        if r.feature < 0:
            n = r.n
        else:
            frequencies[r.feature] = r.n
    return frequencies, n


def train_language_model(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = SAMPLE_OF_LANGUAGE) -> Model:
    """Learn from the labelled rows of ``docs``.

    Document frequencies are counted over all rows. The regression is fitted on up to ``per_language``
    documents of each language, those whose hashes of key and text are smallest, repeated rows counting once;
    every fifth of them is held back to fit the temperature. Rows with a null text or language teach nothing; without any
    nothing is learned. More than ``MAX_LANGUAGES`` languages are an error, and of a language whose sample takes more than its
    share of ``SAMPLE_BYTES`` the last rows are left out. Rows are taken in the order of language and hash, so neither
    partitions nor ties change the result; texts of any length are counted whole, in pieces.
    """
    rows = input_columns(docs, id=key, text=text, lang=lang).where("text IS NOT NULL AND lang IS NOT NULL")
    frequencies, n = _document_frequencies(rows)
    idf = np.log((1 + n) / (1 + frequencies)) + 1.0

    # The least hashes of each language, counted by leading bits: no language passes through one task.
    hashed = rows.withColumn("order", F.xxhash64("id", "text"))
    orders = stored(hashed.select("lang", "order").distinct(), "sample-orders")
    high = F.shiftright("order", 48)
    n_languages = orders.select("lang").distinct().limit(MAX_LANGUAGES + 1).count()
    if n_languages > MAX_LANGUAGES:
        raise ValueError(f"at most {MAX_LANGUAGES} languages can be learned")
    # At most 65,536 rows a language.
    cells = orders.groupBy("lang", high.alias("cell")).agg(F.count(F.lit(1)).alias("n")).toPandas().sort_values(["lang", "cell"])
    ahead = cells.groupby("lang")["n"].cumsum() - cells["n"]
    edge = cells[ahead < per_language].groupby("lang")["cell"].max().to_dict()
    if not edge:
        return Model([], np.zeros((FEATURES, 0), "float32"), np.zeros(0), 1.0)
    # In those cells, which hold few rows beyond the sample, each language is cut on its own.
    near = F.lit(False)
    for name, cut in edge.items():
        near = near | ((F.col("lang") == name) & (high <= int(cut)))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("order"))
    ranked = orders.where(near).withColumn("rank", rank).where(F.col("rank") <= per_language)
    last = {r.lang: r.last for r in ranked.groupBy("lang").agg(F.max("order").alias("last")).collect()}
    inside = F.lit(False)
    for name, cut in last.items():
        inside = inside | ((F.col("lang") == name) & (F.col("order") <= cut))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for order, name, one in zip(batch["order"], batch["lang"], batch["text"], strict=True):
                total = counts(one)
                at = np.flatnonzero(total)
                if len(at):
                    yield pd.DataFrame({"order": [order], "lang": [name], "at": [at.astype("<u2").tobytes()], "n": [total[at].astype("<i4").tobytes()]})

    once = hashed.where(inside).groupBy("lang", "order").agg(F.first("text").alias("text"))
    sample = stored(once.mapInPandas(released(run), "order long, lang string, at binary, n binary"), "sample")
    # Six bytes a feature, mostly a few kilobytes a row; of each language only as many rows as fit its share of the bytes.
    size = F.octet_length("at") + F.octet_length("n")
    earlier = Window.partitionBy("lang").orderBy("order").rowsBetween(Window.unboundedPreceding, -1)
    sample = sample.withColumn("before", F.coalesce(F.sum(size).over(earlier), F.lit(0)))
    sample = sample.where(F.col("before") + size <= SAMPLE_BYTES // len(edge)).drop("before")
    found = sorted(sample.collect(), key=lambda r: (r.lang, r.order))
    languages = sorted({r.lang for r in found})
    labels = np.array([languages.index(r.lang) for r in found], "int64")
    vectors = []
    for r in found:
        at, n_at = np.frombuffer(r.at, "<u2").astype("int32"), np.frombuffer(r.n, "<i4")
        vectors.append((at, (SCALE * n_at / n_at.sum() * idf[at]).astype("float32")))
    del found
    held = np.arange(len(vectors)) % 5 == 4
    w, bias = train_ftrl([v for v, h in zip(vectors, held, strict=True) if not h], labels[~held], len(languages))
    scores = np.array([values @ w[at] + bias for (at, values), h in zip(vectors, held, strict=True) if h])
    weights = (SCALE * w * idf[:, None]).astype("float32")
    return Model(languages, weights, bias, best_temperature(scores, labels[held]))


def predict_language(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, ``lang_pred`` and ``score`` (calibrated probability) of each whole text; one pass, no shuffle.

    A text that is null or has no letter is ``und`` with score 0, and so is every text if nothing was
    learned. Only the text is an input. Null keys and repeated rows are rows like others; an empty table gives none; long
    texts are read whole, in pieces.
    """
    rows = input_columns(docs, id=key, text=text)
    schema = T.StructType([
        T.StructField(key, rows.schema["id"].dataType), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
    ])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [model.predict(t) for t in batch["text"]]
            yield pd.DataFrame({key: batch["id"], "lang_pred": [f[0] for f in found], "score": [f[1] for f in found]})

    return rows.mapInPandas(released(run), schema)


def recognised(text: Column, model: Model, min_score: float) -> Column:
    """Whether a text has a language with at least this score; for filters, without a join."""

    @F.pandas_udf("boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            found = [model.predict(t) for t in batch]
            yield pd.Series([lang != UNKNOWN and score >= min_score for lang, score in found], dtype=bool)

    return run(text)


def held_out(key: Column) -> Column:
    """Every third document, by the CRC-32 of its key as text; a null key is as an empty one."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 3 == 1
