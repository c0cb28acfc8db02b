"""Masked pseudo-likelihood: a small network predicts each word from the words on both sides."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from corpusloom.llm.tables import blocks, input_columns, stored

# Classes: 0 beyond the ends of a text, then frequent words of their own, then classes by hash.
CLASSES, FREQUENT = 4_096, 3_071
HASHED = CLASSES - 1 - FREQUENT
# A class is predicted in two steps: its group, then the member of the group; groups hold words about as frequent.
GROUPS, MEMBERS = 64, 64
# As a neighbour, a class has a row of its own if it is among the first, else it shares one.
OWN_ROWS, SHARED_ROWS = 768, 256
ROW_OF = np.concatenate([np.arange(OWN_ROWS), OWN_ROWS + np.arange(OWN_ROWS, CLASSES) % SHARED_ROWS])
WINDOW, HIDDEN = 2, 24
OFFSETS = [o for o in range(-WINDOW, WINDOW + 1) if o]
# Training: rounds over the corpus, which together mask each word once, and Adam's settings.
ROUNDS, BATCH, RATE = 2, 4_096, 0.015
BLOCK = 8_192
# Parameters that travel together when networks are averaged.
PART = 512
CACHE_WORDS = 200_000
# Frequent words whose counts go out with the tasks, at most; those of all others are joined.
KNOWN_WORDS = 100_000

_NOT_WORD = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    """Words in UTF-8: A-Z lower-cased, cut at ASCII characters that are neither letters nor digits."""
    return (text or "").encode().lower().translate(_NOT_WORD).split()


@dataclass
class Vocabulary:
    """Frequent words with their classes; how many distinct words each class has; how often it occurs.

    ``known`` has the log-share of frequent words, ``others`` (``word``, ``share``) that of the rest.
    """

    frequent: dict[bytes, int]
    sizes: np.ndarray
    counts: np.ndarray
    known: dict[bytes, float]
    others: DataFrame


class ClassOf(dict):
    """Class of each word; frequent ones are given, others get one by hash."""

    def __init__(self, frequent: dict[bytes, int]):
        super().__init__(frequent)
        self.frequent = frequent

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
            self.update(self.frequent)
        # Spark's xxhash64 of the same bytes.
        value = xxhash.xxh64_intdigest(word, seed=42)
        signed = value - (1 << 64) if value >> 63 else value
        self[word] = found = 1 + FREQUENT + signed % HASHED
        return found


def word_counts(docs: DataFrame) -> DataFrame:
    """``word`` (binary) and ``n`` over all texts, counted in each batch first."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in (part for whole in batches for part in blocks(whole, "text", 1 << 24)):
            found: Counter[bytes] = Counter()
            for text in batch["text"]:
                found.update(words(text))
            yield pd.DataFrame({"word": list(found.keys()), "n": list(found.values())})

    return docs.select("text").mapInPandas(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def build_vocabulary(docs: DataFrame) -> Vocabulary:
    counted = stored(word_counts(docs), "word-counts")
    top = counted.orderBy(F.desc("n"), "word").limit(FREQUENT).collect()
    frequent = {bytes(r.word): i + 1 for i, r in enumerate(top)}
    sizes, counts = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in top:
        sizes[frequent[bytes(r.word)]], counts[frequent[bytes(r.word)]] = 1, r.n
    by_hash = counted.join(F.broadcast(counted.sparkSession.createDataFrame(top, counted.schema).select("word")), "word", "left_anti")
    of = F.pmod(F.xxhash64("word"), F.lit(HASHED)).cast("int").alias("c")
    for r in by_hash.groupBy(of).agg(F.count(F.lit(1)).alias("s"), F.sum("n").alias("n")).collect():
        sizes[1 + FREQUENT + r.c], counts[1 + FREQUENT + r.c] = r.s, r.n
    # Log of a word's part of its class, over that of equal parts: 0 for words with a class of their own.
    equal = F.lit((sizes / np.maximum(counts, 1))[1 + FREQUENT :].tolist())
    shared = by_hash.select("word", "n", F.log(F.col("n") * F.get(equal, of)).alias("share"))
    least = _least_known(by_hash)
    known = {bytes(r.word): r.share for r in shared.where(F.col("n") >= least).select("word", "share").collect()}
    return Vocabulary(frequent, sizes, counts, known | dict.fromkeys(frequent, 0.0), shared.where(F.col("n") < least).select("word", "share"))


def _least_known(counted: DataFrame) -> int:
    """The count from which on words are known to each task: they are no more than ``KNOWN_WORDS``."""
    # Counts in steps of a sixteenth of a power of two: at most a thousand rows.
    step = F.floor(F.log2("n") * 16).alias("step")
    steps = counted.groupBy(step).agg(F.min("n").alias("least"), F.count(F.lit(1)).alias("words")).orderBy(F.desc("step")).collect()
    least, words_ahead = (1 << 63) - 1, 0
    for r in steps:
        words_ahead += r.words
        if words_ahead > KNOWN_WORDS:
            break
        least = r.least
    return least


def neighbours(padded: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """For each offset the rows of the classes beside the places ``at``; ``WINDOW`` zeros are around each text."""
    return [ROW_OF[padded[at + offset]] for offset in OFFSETS]


def _largest(scores: np.ndarray) -> np.ndarray:
    """Largest figure of each row. Halves are compared as wholes, which is faster than row by row."""
    while (width := scores.shape[1]) > 1 and width % 2 == 0:
        scores = np.maximum(scores[:, : width // 2], scores[:, width // 2 :])
    return scores.max(axis=1, keepdims=True)


def _softmax(scores: np.ndarray) -> np.ndarray:
    """In place."""
    scores -= _largest(scores)
    np.exp(scores, out=scores)
    scores /= scores.sum(axis=1, keepdims=True)
    return scores


def _log_chosen(scores: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Log-probability of one column in each row; the scores are used up."""
    scores -= _largest(scores)
    target = scores[np.arange(len(chosen)), chosen]
    np.exp(scores, out=scores)
    return target - np.log(scores.sum(axis=1))


@dataclass
class Network:
    """Window of classes, a hidden layer, a distribution over groups and one over the members of each."""

    tables: np.ndarray  # offset, row of class, hidden: the first layer for one-hot input
    bias: np.ndarray
    groups: np.ndarray  # hidden, group
    groups_bias: np.ndarray
    members: np.ndarray  # group, hidden, member
    members_bias: np.ndarray  # group, member

    @staticmethod
    def fresh(counts: np.ndarray) -> Network:
        """Random first layer; the output starts from how often each class occurs."""
        draw = np.random.default_rng(0)
        tables = draw.normal(0, 0.3, (len(OFFSETS), OWN_ROWS + SHARED_ROWS, HIDDEN))
        groups, members = draw.normal(0, 0.05, (HIDDEN, GROUPS)), draw.normal(0, 0.05, (GROUPS, HIDDEN, MEMBERS))
        each = (counts + 0.1).reshape(GROUPS, MEMBERS)
        whole = each.sum(axis=1, keepdims=True)
        shares = np.log(whole[:, 0] / whole.sum()), np.log(each / whole)
        return Network(*[x.astype("float32") for x in (tables, np.zeros(HIDDEN), groups, shares[0], members, shares[1])])

    def parts(self) -> list[np.ndarray]:
        return [self.tables, self.bias, self.groups, self.groups_bias, self.members, self.members_bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    def filled(self, values: np.ndarray) -> Network:
        ends = np.cumsum([p.size for p in self.parts()])[:-1]
        pieces = np.split(np.asarray(values, "float32"), ends)
        return Network(*[v.reshape(p.shape) for v, p in zip(pieces, self.parts(), strict=True)])

    def hidden(self, near: list[np.ndarray]) -> np.ndarray:
        """``near``: for each offset the rows of the neighbours."""
        total = self.tables[0][near[0]]
        for table, rows in zip(self.tables[1:], near[1:], strict=True):
            total += table[rows]
        total += self.bias
        return np.tanh(total, out=total)

    def member_scores(self, h: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, list[tuple[int, slice]]]:
        """Scores of the members of each place's own group, places in order of groups; which places each group has."""
        ends = np.searchsorted(group, np.arange(GROUPS + 1)).tolist()
        spans = [(g, slice(ends[g], ends[g + 1])) for g in range(GROUPS) if ends[g] < ends[g + 1]]
        scores = self.members_bias[group]
        for g, span in spans:
            scores[span] += h[span] @ self.members[g]
        return scores, spans

    def log_probabilities(self, padded: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Log-probability of the class at each place, given those around it."""
        found = np.empty(len(at))
        for start in range(0, len(at), BLOCK):
            block = at[start : start + BLOCK]
            order = np.argsort(padded[block] // MEMBERS, kind="stable")
            block = block[order]
            group, member = padded[block] // MEMBERS, padded[block] % MEMBERS
            h = self.hidden(neighbours(padded, block))
            scores = h @ self.groups
            scores += self.groups_bias
            each = _log_chosen(scores, group) + _log_chosen(self.member_scores(h, group)[0], member)
            found[start + order] = each
        return found

    def gradient(self, padded: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
        at = at[np.argsort(padded[at] // MEMBERS, kind="stable")]
        group, member = padded[at] // MEMBERS, padded[at] % MEMBERS
        near, places = neighbours(padded, at), np.arange(len(at))
        h = self.hidden(near)
        p = h @ self.groups
        p += self.groups_bias
        _softmax(p)[places, group] -= 1
        p /= len(at)
        q, spans = self.member_scores(h, group)
        _softmax(q)[places, member] -= 1
        q /= len(at)
        back = p @ self.groups.T
        members, members_bias = np.zeros_like(self.members), np.zeros_like(self.members_bias)
        for g, span in spans:
            back[span] += q[span] @ self.members[g].T
            members[g] = h[span].T @ q[span]
        members_bias[[g for g, _ in spans]] = np.add.reduceat(q, [span.start for _, span in spans])
        back *= 1 - h * h
        tables, cells, of_cell = np.empty_like(self.tables), np.arange(HIDDEN), back.ravel().astype("float64")
        for table, rows in zip(tables, near, strict=True):
            hit = rows[:, None] * HIDDEN + cells
            table[:] = np.bincount(hit.ravel(), of_cell, table.size).reshape(table.shape)
        return [tables, back.sum(axis=0), h.T @ p, p.sum(axis=0), members, members_bias]


class Adam:
    def __init__(self, network: Network):
        self.network, self.step = network, 0
        self.mean = [np.zeros_like(p) for p in network.parts()]
        self.square = [np.zeros_like(p) for p in network.parts()]
        # Room for figures in between; the step itself is worked out in double precision.
        self.room = [(np.empty_like(p), np.empty(p.shape)) for p in network.parts()]

    def learn(self, padded: np.ndarray, at: np.ndarray) -> None:
        self.step += 1
        rate = RATE * np.sqrt(1 - 0.999**self.step) / (1 - 0.9**self.step)
        gradient = self.network.gradient(padded, at)
        for p, m, s, g, (t, u) in zip(self.network.parts(), self.mean, self.square, gradient, self.room, strict=True):
            np.subtract(g, m, out=t)
            t *= 0.1
            m += t
            np.multiply(g, g, out=t)
            t -= s
            t *= 0.001
            s += t
            np.sqrt(s, out=t)
            t += 1e-8
            np.multiply(m, rate, out=u)
            u /= t
            p -= u


def padded_texts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts of two bytes a word, side by side with zeros between; the places of words; words of each text."""
    gap = bytes(2 * WINDOW)
    padded = np.frombuffer(gap + b"".join(t + gap for t in texts), "<u2").astype("int64")
    lengths = np.array([len(t) // 2 for t in texts], "int64")
    return padded, np.flatnonzero(padded), lengths


def _classes(rows: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Each text as a string of bytes, two for the class of each word.

    Also a number for the row, to be kept by writing the table, the sum of known words' shares, and the other words with
    how often the text has them.
    """
    frequent, known = vocabulary.frequent, vocabulary.known
    schema = T.StructType([
        rows.schema["id"], T.StructField("row", T.LongType()), T.StructField("classes", T.BinaryType()),
        T.StructField("shares", T.DoubleType()),
        T.StructField("words", T.ArrayType(T.BinaryType())), T.StructField("times", T.ArrayType(T.LongType())),
    ])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        class_of = ClassOf(frequent)
        # One look-up a word: the place of a known one in these two arrays, the last place for all others.
        place = {word: i for i, word in enumerate(known)}
        class_at = np.array([class_of[word] for word in known] + [0], "<u2")
        share_at = np.array([*known.values(), 0.0])
        other = len(known)
        for batch in (part for whole in batches for part in blocks(whole, "text")):
            classes, shares, others = [], [], []
            for text in batch["text"]:
                found = words(text)
                places = np.fromiter((place.get(w, other) for w in found), "int64", len(found))
                each, rest = class_at[places], np.flatnonzero(places == other).tolist()
                unknown = [found[i] for i in rest]
                each[rest] = [class_of[w] for w in unknown]
                classes.append(each.tobytes())
                others.append(Counter(unknown))
                shares.append(share_at[places].sum())
            yield pd.DataFrame({
                "id": batch["id"].to_numpy(), "row": batch["row"].to_numpy(), "classes": classes, "shares": np.array(shares, "float64"),
                "words": [list(o.keys()) for o in others], "times": [list(o.values()) for o in others],
            })

    return rows.withColumn("row", F.monotonically_increasing_id()).mapInPandas(run, schema)


def _train_round(texts: DataFrame, network: Network, number: int) -> Network:
    """Each task learns from all its texts, from the same start; the mean, by words seen, is the result."""
    start = network.flat()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        learner, seen = Adam(network.filled(start.copy())), 0
        for batch in (part for whole in batches for part in blocks(whole, "classes")):
            padded, at, _ = padded_texts(batch["classes"].tolist())
            at = at[number::ROUNDS]
            at = at[np.random.default_rng(number).permutation(len(at))]
            for low in range(0, len(at), BATCH):
                learner.learn(padded, at[low : low + BATCH])
            seen += len(at)
        if seen:
            values = learner.network.flat().astype("float64")
            weighed = np.append(1.0, values) * seen
            parts = [weighed[low : low + PART].tobytes() for low in range(0, len(weighed), PART)]
            yield pd.DataFrame({"part": range(len(parts)), "sums": parts})

    def added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, values in zip(batch["part"], batch["sums"], strict=True):
                sums[part] = sums.get(part, 0.0) + np.frombuffer(values)
        yield pd.DataFrame({"part": list(sums), "sums": [v.tobytes() for v in sums.values()]})

    # A task holds one sum for each of its parts, however many networks there are; the driver one figure a parameter.
    schema = "part int, sums binary"
    total = texts.select("classes").mapInPandas(run, schema).repartition("part").mapInPandas(added, schema)
    found = [r.sums for r in sorted(total.collect(), key=lambda r: r.part)]
    if not found:
        return network
    figures = np.frombuffer(b"".join(found))
    return network.filled(figures[1:] / figures[0])


def train_network(texts: DataFrame, vocabulary: Vocabulary) -> Network:
    network = Network.fresh(vocabulary.counts)
    for number in range(ROUNDS):
        network = _train_round(texts, network, number)
    return network


def score_texts(texts: DataFrame, network: Network, vocabulary: Vocabulary) -> DataFrame:
    """``id, row, n_tokens, log_likelihood`` of texts given as classes, whose words are taken to be equally likely."""
    inside = np.log(np.maximum(vocabulary.sizes, 1))
    schema = T.StructType([texts.schema["id"], texts.schema["row"], T.StructField("n_tokens", T.LongType()), T.StructField("log_likelihood", T.DoubleType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in (part for whole in batches for part in blocks(whole, "classes", 1 << 20)):
            padded, at, lengths = padded_texts(batch["classes"].tolist())
            each = np.concatenate([[0.0], np.cumsum(network.log_probabilities(padded, at) - inside[padded[at]])])
            ends = np.cumsum(lengths)
            yield pd.DataFrame({"id": batch["id"], "row": batch["row"], "n_tokens": lengths, "log_likelihood": each[ends] - each[ends - lengths]})

    return texts.select("id", "row", "classes").mapInPandas(run, schema)


def word_shares(texts: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``row`` and ``shares``: what the counts of its words add to a text's score, if that is not 0.

    No word of the join is frequent, so its rows are dealt evenly.
    """
    others = texts.select("row", F.explode(F.arrays_zip("words", "times")).alias("of")).select("row", "of.words", "of.times")
    joined = others.join(vocabulary.others, F.col("words") == F.col("word"))
    parts = joined.select("row", (F.col("times") * F.col("share")).alias("shares"))
    return parts.unionByName(texts.where("shares <> 0").select("row", "shares")).groupBy("row").agg(F.sum("shares").alias("shares"))


def pseudo_likelihood(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Score each document by how well its words are predicted from their neighbours.

    Words are counted over the whole corpus. The ``FREQUENT`` most frequent have a class each, others share
    classes by hash; the network predicts the group of a word's class, then the class in the group. It is trained on every word
    of every document, one in ``ROUNDS`` masked in each round, by tasks side by side whose networks are averaged. A word's log-probability is that of its class
    given two words on either side, plus the logarithm of the word's part of all occurrences of the class.
    The driver and each task hold the counts of at most ``KNOWN_WORDS`` words; those of others are joined.

    Returns key, ``n_tokens``, ``log_likelihood`` (the sum) and ``mean_log_likelihood`` (null without words). Null
    and empty texts have no words and sum 0. Null keys and repeated rows are rows like others; of other
    columns none is read. An empty table gives an empty one. Very long texts are whole: a task holds the classes of some
    at a time, two bytes a word.
    """
    rows = input_columns(docs, id=key, text=text)
    vocabulary = build_vocabulary(rows)
    texts = stored(_classes(rows, vocabulary), "word-classes")
    found = score_texts(texts, train_network(texts, vocabulary), vocabulary).join(word_shares(texts, vocabulary), "row", "left")
    found = found.withColumn("log_likelihood", F.col("log_likelihood") + F.coalesce("shares", F.lit(0.0)))
    mean = F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens"))
    return found.select(F.col("id").alias(key), "n_tokens", "log_likelihood", mean.alias("mean_log_likelihood"))
