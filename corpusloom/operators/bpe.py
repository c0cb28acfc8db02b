"""Byte-pair training in rounds of Spark jobs.

A word is a string in which one character stands for one symbol, so applying a
merge is ``replace(word, pair, new_symbol)`` and counting pairs is counting
two-character substrings; tasks do so in arrays of many words. In a round the tasks try the next merges as guessed, hundreds of them, on all words, and add up how each
changes the counts of pairs. From these exact sums every merge whose turn is certain is taken, in its right order, which need
not be that of the guess. A guess only decides how many merges a round takes: a wrong one ends it early, at the merge that is due.

Words are cut where two symbols meet that are side by side less often than any merge still to come, and equal parts are counted
as one: what stands at such a place later is no more frequent, so no merge reaches across it. The bound is a guess, too; where
merges become rarer than it, training goes back to the whole words.
"""

from __future__ import annotations

import heapq
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row, functions as F

from corpusloom.functions.text import CHAR_BPE, SPECIAL_TOKENS, WORD_SUFFIX, check_kind
from corpusloom.operators.words import word_counts
from corpusloom.shared import new_path, remove_path, temporary_tables, through_table
from corpusloom.sources.tokenizers import MERGES_SCHEMA, VOCAB_SCHEMA, Tokenizer

# Vocabulary size, and least count of a pair for the character kind, if none is given.
VOCAB_SIZE = 30_000
MIN_FREQUENCY = 2

# Each needs a code point; none is 0.
_MOST_TOKENS = 1_112_063
# Pairs in a list for ``_certain_merges``.
_LISTED = 256
# Merges tried in a round, at most, and pairs that come back to judge them.
_TRIED = 512
_JUDGED = 8_192
# Rounds after which the words are written anew.
_ROUNDS = 4
# Symbols of the words on which merges are guessed, about; longer words are left out.
_GUESS_SYMBOLS = 3_000_000
_GUESS_LENGTH = 200
# Words in a partition of the word table, at most.
_WORDS_A_TASK = 250_000
# Rounds after which words are cut, merges guessed ahead, at most, to find how frequent those to come are, and the part of that count below which words
# are cut.
_CUT_ROUNDS = 2
_AHEAD = 4_096
_CUT_BELOW = 0.75
# Pairs that are sent to the tasks as those at which words are not cut, at most.
_KEPT = 200_000


def symbol(token_id: int) -> str:
    """The character that stands for a token: code points from 1 on, without the surrogates."""
    point = token_id + 1
    if point >= 0xD800:
        point += 0x800
    if point > 0x10FFFF:
        raise ValueError(f"a vocabulary holds at most {_MOST_TOKENS:,} tokens")
    return chr(point)


@dataclass
class Vocabulary:
    """Tokens and merges learnt so far; its size is the vocabulary size."""

    tokens: list[str] = field(default_factory=list)
    ids: dict[str, int] = field(default_factory=dict)
    by_symbol: dict[str, str] = field(default_factory=dict)
    merges: list[tuple[str, str, str]] = field(default_factory=list)

    def add(self, token: str) -> str:
        """The symbol of a token; a known token keeps its id."""
        if token not in self.ids:
            self.ids[token] = len(self.tokens)
            self.tokens.append(token)
            self.by_symbol[symbol(self.ids[token])] = token
        return symbol(self.ids[token])

    def joined(self, pair: str) -> str:
        return self.by_symbol[pair[0]] + self.by_symbol[pair[1]]

    def merge(self, pair: str) -> str:
        """Learn a merge; returns the symbol that replaces the pair."""
        token = self.joined(pair)
        self.merges.append((self.by_symbol[pair[0]], self.by_symbol[pair[1]], token))
        return self.add(token)


def _alphabet(counts: DataFrame, limit: int | None) -> tuple[list[str], list[str]]:
    """Characters to keep and characters to drop, in code point order.

    There are at most as many rows as Unicode has characters.
    """
    letters = counts.select("n", F.explode(F.split("word", "")).alias("letter"))
    rows = letters.where("letter != ''").groupBy("letter").agg(F.sum("n").alias("n")).collect()
    ranked = sorted(rows, key=lambda r: (-r["n"], r["letter"]))
    kept = ranked if limit is None else ranked[:limit]
    dropped = [] if limit is None else ranked[limit:]
    return sorted(r["letter"] for r in kept), sorted(r["letter"] for r in dropped)


def _spell(word: Column, kind: str, kept: list[str], dropped: list[str], vocab: Vocabulary,
           endings: Iterable[str]) -> Column:
    """A word in symbols. Dropped characters vanish."""
    gone = "".join(dropped)
    plain = F.translate(word, "".join(kept) + gone, "".join(vocab.add(c) for c in kept))
    if kind != CHAR_BPE:
        return plain
    ends = sorted(endings)
    head = F.translate(
        F.expr("substring(word, 1, length(word) - 1)"),
        "".join(kept) + gone,
        "".join(vocab.add(c) for c in kept),
    )
    tail = F.translate(
        F.right(word, F.lit(1)),
        "".join(ends) + gone,
        "".join(vocab.add(c + WORD_SUFFIX) for c in ends),
    )
    return F.concat(head, tail)


def _spelling() -> tuple[Callable, Callable]:
    """The rules for one word by itself, which the tests hold; training does the same to many words in one array."""

    def spell(word: str, merges: list[tuple[str, str]], ranks: dict[str, int], note: Callable | None = None) -> str:
        """A word after merges, oldest first; no pair is in ``merges`` twice, and only the last may give a known symbol."""
        if len(word) >= 256:
            for at, (pair, new) in enumerate(merges):
                if pair in word:
                    if note is not None:
                        note(at, word, pair, new)
                    word = word.replace(pair, new)
            return word
        last = -1
        while True:
            found = [at for at in map(ranks.get, map(str.__add__, word, word[1:])) if at is not None and at > last]
            if not found:
                return word
            last = min(found)
            pair, new = merges[last]
            if note is not None:
                note(last, word, pair, new)
            word = word.replace(pair, new)

    def changes(word: str, pair: str, new: str) -> Iterator[tuple[str, int]]:
        """The pairs that a word loses and gains by a merge."""
        left, right = pair
        parts = word.split(pair)
        last = len(parts) - 1
        yield pair, -last
        for at, part in enumerate(parts):
            if part:
                if at > 0:
                    yield right + part[0], -1
                    yield new + part[0], 1
                if at < last:
                    yield part[-1] + left, -1
                    yield part[-1] + new, 1
            elif 0 < at < last:
                yield right + left, -1
                yield new + new, 1

    return spell, changes


def _blocks() -> tuple[Callable, ...]:
    """Functions for tasks, which hold many words in one array; nested, so that they travel without this package."""

    def blocks(batches: Iterable[pd.DataFrame]) -> Iterator[tuple[np.ndarray, list[str]]]:
        """Counts and words, so many at a time that their symbols fit an array; only a longer word is more."""
        counts, words, size = [], [], 0
        for batch in batches:
            if len(batch):
                counts.append(batch["n"].to_numpy(dtype=np.int64))
                words += batch["word"].tolist()
                size += int(batch["word"].str.len().sum()) + len(batch)
            if size >= 2_000_000:
                yield np.concatenate(counts), words
                counts, words, size = [], [], 0
        if words:
            yield np.concatenate(counts), words

    def laid_out(words: list[str]) -> np.ndarray:
        """The symbols of words, with a 0 before, between and after them."""
        return np.frombuffer(f"\0{chr(0).join(words)}\0".encode("utf-32-le"), dtype="<i4").copy()

    def linked(symbols: np.ndarray) -> tuple[np.ndarray, Callable, Callable]:
        """A copy of the symbols, the codes of the pairs at places of it, and a function that takes one merge there."""
        symbols, places = symbols.copy(), np.arange(len(symbols), dtype=np.int64)
        after, before = places + 1, places - 1
        marked = np.zeros(len(symbols), dtype=bool)

        def pairs(at: np.ndarray) -> np.ndarray:
            return symbols[at].astype(np.int64) << 21 | symbols[after[at]]

        def take(at: np.ndarray, left: int, right: int, new: int, step: int,
                 note: Callable | None) -> tuple[np.ndarray, np.ndarray] | None:
            """Merge where the pair still is, of the rising places ``at``; returns places and codes of the pairs made."""
            at = at[symbols[at] == left]
            at = at[symbols[after[at]] == right]
            if left == right and len(at):
                # In a run of one symbol, every other place.
                number = np.arange(len(at))
                begins = np.concatenate(([True], after[at[:-1]] != at[1:]))
                at = at[(number - np.maximum.accumulate(np.where(begins, number, 0))) % 2 == 0]
            if not len(at):
                return None
            gone, near = after[at], before[at]
            if note is not None:
                marked[gone] = True
                lost = np.concatenate((at, gone, near[~marked[near]]))
                marked[gone] = False
                note(step, lost, pairs(lost), -1)
            follows = after[gone]
            symbols[at], symbols[gone] = new, -1
            after[at], before[follows] = follows, at
            marked[at] = True
            near = before[at]
            made = np.concatenate((at, near[~marked[near]]))
            marked[at] = False
            found = pairs(made)
            if note is not None:
                note(step, made, found, 1)
            return made, found

        return symbols, pairs, take

    def merge(symbols: np.ndarray, merges: Sequence[tuple[str, str]], note: Callable | None = None) -> np.ndarray:
        """The symbols after merges, one after the other, each from left to right.

        ``note`` gets the step, the places and the codes of the pairs that a merge takes away (-1) and makes (1).
        """
        n = len(merges)
        if not n:
            return symbols
        symbols, pairs, take = linked(symbols)
        triples = [(ord(pair[0]), ord(pair[1]), ord(new)) for pair, new in merges]
        codes = np.array([left << 21 | right for left, right, _ in triples], dtype=np.int64)
        order = np.argsort(codes)
        codes = codes[order]
        waiting: list[list[np.ndarray]] = [[] for _ in merges]

        def wait(at: np.ndarray, found: np.ndarray, done: int) -> None:
            """Hand the places of pairs to the merges that come later."""
            hit = np.minimum(np.searchsorted(codes, found), n - 1)
            step = np.where(codes[hit] == found, order[hit], -1)
            later = step > done
            at, step = at[later], step[later]
            if len(at):
                by_step = np.argsort(step, kind="stable")
                at, step = at[by_step], step[by_step]
                cuts = np.flatnonzero(np.diff(step)) + 1
                for k, part in zip(step[np.concatenate(([0], cuts))].tolist(), np.split(at, cuts)):
                    waiting[k].append(part)

        top = max(int(symbols.max()), *(max(t) for t in triples)) + 1
        lefts, rights = np.zeros(top, dtype=bool), np.zeros(top, dtype=bool)
        lefts[[t[0] for t in triples]] = rights[[t[1] for t in triples]] = True
        first = np.flatnonzero(lefts[symbols[:-1]] & rights[symbols[1:]])
        wait(first, pairs(first), -1)
        for step, triple in enumerate(triples):
            if waiting[step]:
                made = take(np.unique(np.concatenate(waiting[step])), *triple, step, note)
                waiting[step] = []
                if made is not None:
                    wait(*made, step)
        return symbols[symbols >= 0]

    def weighed(symbols: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """For each place the count of its word."""
        return np.concatenate((np.repeat(counts, np.diff(np.flatnonzero(symbols == 0))), [0]))

    return blocks, laid_out, linked, merge, weighed


def _ranks(merges: Sequence[tuple[str, str]]) -> dict[str, int]:
    return {pair: at for at, (pair, _) in enumerate(merges)}


def _trial(rounds: list[list[tuple[str, str]]], guess: list[tuple[str, str]]) -> Callable:
    """Counts of pairs after ``rounds`` (step -1), and how each merge of ``guess`` changes them, for the words of a task."""
    blocks, laid_out, _, merge, weighed = _blocks()
    last, symbol_of = len(guess), (1 << 21) - 1

    def summed(keys: list[np.ndarray], amounts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        group, key = pd.factorize(np.concatenate(keys))
        # Sums of doubles are exact up to 2^53 words.
        total = np.bincount(group, np.concatenate(amounts), len(key)).astype(np.int64)
        return key[total != 0], total[total != 0]

    def rows(key: np.ndarray, total: np.ndarray) -> pd.DataFrame:
        # The counts are kept last, which is step -1.
        step = (key >> 42).astype(np.int32)
        pair = [chr(a) + chr(b) for a, b in zip((key >> 21 & symbol_of).tolist(), (key & symbol_of).tolist())]
        step[step == last] = -1
        return pd.DataFrame({"step": step, "pair": pd.Series(pair, dtype=object), "count": total})

    def trial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, total = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        for counts, words in blocks(batches):
            symbols = laid_out(words)
            for merges in rounds:
                symbols = merge(symbols, merges)
            weights = weighed(symbols, counts)
            keys, amounts = [key], [total]

            def note(step: int, at: np.ndarray, pairs: np.ndarray, sign: int) -> None:
                inside = (pairs >> 21 > 0) & (pairs & symbol_of > 0)
                keys.append(pairs[inside] | step << 42)
                amounts.append(sign * weights[at[inside]])

            note(last, np.arange(len(symbols) - 1), symbols[:-1].astype(np.int64) << 21 | symbols[1:], 1)
            merge(symbols, guess, note)
            key, total = summed(keys, amounts)
            if len(key) > 1_000_000:
                yield rows(key, total)
                key, total = key[:0], total[:0]
        yield rows(key, total)

    return trial


def _merged(rounds: list[list[tuple[str, str]]]) -> Callable:
    """The words of a task after ``rounds``; a word of one symbol has no pairs left and goes."""
    blocks, laid_out, _, merge, _ = _blocks()

    def merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for counts, words in blocks(batches):
            symbols = laid_out(words)
            for merges in rounds:
                symbols = merge(symbols, merges)
            left = symbols[1:-1].astype("<i4").tobytes().decode("utf-32-le").split("\0")
            long = np.diff(np.flatnonzero(symbols == 0)) > 2
            yield pd.DataFrame({"n": counts[long], "word": pd.Series([w for w in left if len(w) > 1], dtype=object)})

    return merged


def _cut(rounds: list[list[tuple[str, str]]], kept: Sequence[str]) -> Callable:
    """The parts of a task's words after ``rounds``, cut inside any pair but those ``kept``; parts of one symbol go.

    Equal parts of a block are one row.
    """
    blocks, laid_out, _, merge, weighed = _blocks()
    codes = np.array(sorted(ord(pair[0]) << 21 | ord(pair[1]) for pair in kept), dtype=np.int64)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for counts, words in blocks(batches):
            symbols = laid_out(words)
            for merges in rounds:
                symbols = merge(symbols, merges)
            weights = weighed(symbols, counts)
            found = symbols[:-1].astype(np.int64) << 21 | symbols[1:]
            whole = codes[np.minimum(np.searchsorted(codes, found), len(codes) - 1)] == found
            # Symbols with no kept pair on either side go, and a 0 stands before each part.
            begins = np.concatenate(([False], whole)) < np.concatenate((whole, [False]))
            stays = np.concatenate(([False], whole)) | begins
            parts, first = symbols[stays], begins[stays]
            if not len(parts):
                continue
            text = np.insert(parts, np.flatnonzero(first), 0)[1:].astype("<i4").tobytes().decode("utf-32-le").split("\0")
            group, part = pd.factorize(np.array(text, dtype=object))
            # Sums of doubles are exact up to 2^53 words.
            total = np.bincount(group, weights[begins], len(part)).astype(np.int64)
            yield pd.DataFrame({"n": total, "word": pd.Series(part, dtype=object)})

    return cut


def _parts(words: DataFrame, rounds: list[list[tuple[str, str]]], kept: Sequence[str], tasks: int) -> DataFrame:
    """The parts of words, each once, with the sum of its counts; blocks have summed up before the shuffle."""
    parts = words.mapInPandas(_cut(rounds, kept), words.schema).repartition(tasks, "word")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).select("n", "word")


def _frequent(pairs: DataFrame, least: int) -> tuple[list[str], int]:
    """The pairs with a count of ``least``, and that bound, which is higher where they are more than ``_KEPT``."""
    rows = pairs.where(F.col("count") >= least).select("pair", "count").orderBy(F.desc("count")).limit(_KEPT + 1).collect()
    if len(rows) > _KEPT:
        least = rows[-1]["count"] + 1
    return [r["pair"] for r in rows if r["count"] >= least], least


def _tried(words: DataFrame, rounds: list[list[tuple[str, str]]], guess: list[tuple[str, str]]) -> DataFrame:
    """One row a pair: its ``count``, its ``changes`` by step, and the ``most`` it can come to."""
    found = words.mapInPandas(_trial(rounds, guess), "step int, pair string, count long")
    found = found.groupBy("pair", "step").agg(F.sum("count").alias("count")).where("count <> 0")
    return found.groupBy("pair").agg(
        F.coalesce(F.sum(F.expr("if(step < 0, count, 0)")), F.lit(0)).alias("count"),
        F.coalesce(F.sum(F.expr("if(step < 0 or count > 0, count, 0)")), F.lit(0)).alias("most"),
        F.collect_list(F.expr("if(step < 0, null, struct(step, count))")).alias("changes"),
    )


class _Doubts:
    """Pairs whose counts are not exact while a merge of the guess is taken before an earlier one that stands beside it.

    Where merges ``early`` and ``late`` of the guess make neighbours and only ``late`` is taken, the pair of
    both as it was before still counts there, and that of the new symbol and the old neighbour does not.
    """

    def __init__(self, near: Iterable[tuple[str, dict[int, int]]], guess: Sequence[tuple[str, str]]):
        self.guess = guess
        made = {new: at for at, (_, new) in enumerate(guess)}
        # By early and late merge: the words that have them side by side, early one left or right.
        self.beside: dict[int, Counter] = defaultdict(Counter)
        for pair, changes in near:
            left, right = made[pair[0]], made[pair[1]]
            n = changes.get(max(left, right), 0)
            if left == right or n <= 0:
                continue
            early, late, edge = (left, right, 1) if left < right else (right, left, 0)
            # What the early symbol was made of at this edge came before it.
            while early is not None:
                self.beside[late][early, edge] += n
                early = made.get(guess[early][0][edge])
        self.open: Counter = Counter()
        self.missing: Counter = Counter()

    def _pairs(self, early: int, late: int, edge: int) -> tuple[str, str]:
        old = self.guess[early][0][edge]
        of_late, new = self.guess[late]
        return (old + of_late[0], old + new) if edge == 1 else (of_late[1] + old, new + old)

    def take(self, at: int, skipped: set[int], taken: set[int]) -> None:
        """A merge is taken while ``skipped`` ones before it are not, after ``taken`` ones."""
        for (early, edge), n in self.beside[at].items():
            if early in skipped:
                self._count(early, at, edge, n)
        for late in taken:
            if late > at:
                for edge in (0, 1):
                    n = self.beside[late].get((at, edge), 0)
                    if n:
                        self._count(at, late, edge, -n)

    def _count(self, early: int, late: int, edge: int, n: int) -> None:
        there, not_there = self._pairs(early, late, edge)
        self.open[there] += n
        self.open[not_there] += n
        self.missing[not_there] += n

    def about(self, pair: str) -> bool:
        return self.open[pair] > 0


def _judged_merges(best: list[Row], near: list[Row], guess: Sequence[tuple[str, str]], vocab: Vocabulary, room: int,
                   least: int) -> tuple[list[tuple[str, str]], dict[str, int], bool]:
    """The merges of this round in order; counts of pairs after them; whether these lack the last merge.

    ``best`` has the pairs with the largest ``most``, ``near`` all pairs of two symbols that the guess makes. Counts are those of the
    words with the merges taken so far, as long as these are the first of the guess. A merge ahead of skipped ones gives
    the same words if none of these ever uses up its pair; in between, only counts that ``_Doubts`` names are not exact. The next
    merge is certain if its pair is not one of them and ranks before whatever they and the pairs that are not listed can come to.
    """
    step_of, made = _ranks(guess), {new: at for at, (_, new) in enumerate(guess)}
    pairs = [r["pair"] for r in best]
    index = {p: i for i, p in enumerate(pairs)}
    changes = {r["pair"]: {c["step"]: c["count"] for c in r["changes"]} for r in best}
    counts = np.array([r["count"] for r in best], dtype=np.int64)
    floor = best[-1]["most"] if len(best) >= _JUDGED else 0
    of_step: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for p, by_step in changes.items():
        for at, n in by_step.items():
            of_step[at].append((index[p], n))
    # A pair of a symbol that is not made yet is none.
    waiting = np.array([len({c for c in p if c in made}) for p in pairs], dtype=np.int64)
    holds: dict[str, list[int]] = defaultdict(list)
    for i, p in enumerate(pairs):
        for c in set(p):
            if c in made:
                holds[c].append(i)
    doubts = _Doubts(((r["pair"], {c["step"]: c["count"] for c in r["changes"]}) for r in near), guess)
    real: dict[str, str] = {}
    taken: list[tuple[str, str]] = []
    steps: set[int] = set()
    unsure_end = False

    def named(pair: str) -> str:
        return "".join(real.get(c, c) for c in pair)

    def is_made(pair: str) -> bool:
        return all(c not in made or c in real for c in pair)

    while len(taken) < room and len(pairs):
        there = np.where(waiting == 0, counts, -1)
        top = int(there.max())
        # Without a guess, equal counts are listed in the order of the pairs.
        if top < max(least, 1) or top < floor or top == floor and guess:
            break
        pair = min((pairs[i] for i in np.flatnonzero(there == top)), key=named)
        if doubts.about(pair):
            break
        limits = ((p, (int(counts[index[p]]) if p in index else floor) + n) for p, n in doubts.missing.items() if n > 0 and is_made(p))
        if any(most > top or most == top and named(p) < named(pair) for p, most in limits):
            break
        known = vocab.joined(named(pair)) in vocab.ids
        merge = named(pair)
        new = vocab.merge(merge)
        taken.append((merge, new))
        at = step_of.get(pair)
        skipped = set() if at is None else {u for u in range(at) if u not in steps}
        used_up = any(u in changes[pair] for u in skipped)
        # In a run of one symbol it depends on the order which of them are merged.
        runs = any(set(pair) & set(guess[u][0]) and (pair[0] == pair[1] or guess[u][0][0] == guess[u][0][1]) for u in skipped)
        if at is None or known or used_up or runs:
            unsure_end = True
            break
        for i, n in of_step[at]:
            counts[i] += n
        doubts.take(at, skipped, steps)
        steps.add(at)
        symbol_of = guess[at][1]
        real[symbol_of] = new
        waiting[holds[symbol_of]] -= 1
    after = {named(p): int(n) for p, n, w in zip(pairs, counts, waiting) if w == 0}
    return taken, after, unsure_end


class _Forecast:
    """Guesses the next merges on a bounded part of the words, with the counts of pairs that are known of all of them."""

    def __init__(self, words: list[tuple[str, float]]):
        _, laid_out, self.linked, self.merge, self.weighed = _blocks()
        self.symbols = laid_out([w for w, _ in words]) if words else np.zeros(1, dtype=np.int32)
        self.counts = np.array([n for _, n in words], dtype=np.float64)
        self.known: dict[str, float] = {}
        self.others = float("inf")

    @staticmethod
    def _sums(pairs: np.ndarray, amounts: np.ndarray) -> Iterator[tuple[str, float]]:
        """Pairs inside words, by their codes, and their counts."""
        inside = (pairs >> 21 > 0) & (pairs & (1 << 21) - 1 > 0)
        group, key = pd.factorize(pairs[inside])
        for p, c in zip(key.tolist(), np.bincount(group, amounts[inside], len(key)).tolist()):
            yield chr(p >> 21) + chr(p & (1 << 21) - 1), c

    def learn(self, taken: list[tuple[str, str]], after: dict[str, int], lacks_last: bool, others: float) -> None:
        """The merges of a round and the counts that it found; any other pair has ``others`` at most."""
        known: dict[str, float] = dict(after)
        self.symbols = self.merge(self.symbols, taken[:-1] if lacks_last else taken)
        if lacks_last:
            weights = self.weighed(self.symbols, self.counts)

            def note(_: int, at: np.ndarray, pairs: np.ndarray, sign: int) -> None:
                for p, c in self._sums(pairs, weights[at]):
                    known[p] = known.get(p, 0) + sign * c

            self.symbols = self.merge(self.symbols, taken[-1:], note)
        self.known, self.others = known, others

    def guess(self, vocab: Vocabulary, room: int, least: int) -> list[tuple[str, str]]:
        """The next merges, and in ``last_count`` how frequent the last of them may be."""
        self.last_count = 0.0
        symbols, pairs, take = self.linked(self.symbols)
        weights = self.weighed(symbols, self.counts)
        # The last place, which ends the last word, has no pair.
        counts = dict(self._sums(pairs(np.arange(len(symbols) - 1)), weights[:-1])) if len(symbols) > 1 else {}
        counts = {p: min(n, self.others) for p, n in counts.items()} | self.known
        heap = [(-n, p) for p, n in counts.items()]
        heapq.heapify(heap)
        texts, guess, offset = dict(vocab.by_symbol), [], len(vocab.tokens)
        tokens = set(vocab.ids)

        def note(_: int, at: np.ndarray, found: np.ndarray, sign: int) -> None:
            for p, c in self._sums(found, weights[at]):
                counts[p] = counts.get(p, 0) + sign * c
                if sign > 0:
                    heapq.heappush(heap, (-counts[p], p))

        while heap and len(guess) < room:
            down, pair = heapq.heappop(heap)
            n = counts.get(pair, 0)
            if -down != n:
                if n > 0 and -down > n:
                    heapq.heappush(heap, (-n, pair))
                continue
            text = texts[pair[0]] + texts[pair[1]]
            if n < max(least, 1) or text in tokens:
                break
            new = symbol(offset + len(guess))
            guess.append((pair, new))
            self.last_count = n
            texts[new] = text
            tokens.add(text)
            take(np.flatnonzero(symbols == ord(pair[0])), ord(pair[0]), ord(pair[1]), ord(new), 0, note)
            counts.pop(pair, None)
        return guess


def _forecast(words: DataFrame) -> _Forecast:
    """From the frequent words and, by chances as their counts, some of the others; results do not hang on it."""
    short = words.where(F.length("word") <= _GUESS_LENGTH)
    sizes = short.groupBy(F.floor(F.log2("n")).alias("power")).agg(F.avg("n").alias("n"), F.sum(F.length("word") + 1).alias("size"))
    # A row for each power of two.
    sizes = sizes.collect()
    rare = 1.0
    while sum(r["size"] * min(1.0, r["n"] / rare) for r in sizes) > _GUESS_SYMBOLS:
        rare *= 1.1
    chance = F.expr("(xxhash64(word) & 9223372036854775807) / 9223372036854775807D")
    some = short.where((F.col("n") >= rare) | (chance < F.col("n") / F.lit(rare))).collect()
    return _Forecast([(r["word"], max(r["n"], rare)) for r in some])


class _Queue:
    """Pairs by count down, then symbols up. An unsure pair has no more than its count here."""

    def __init__(self, count: dict[str, int]):
        self.count, self.unsure, self.made = dict(count), set(), set()
        self.heap = [(-n, pair) for pair, n in count.items()]
        heapq.heapify(self.heap)

    def add(self, pair: str, n: int, sure: bool) -> None:
        """A pair that a merge has made."""
        self.count[pair] = n
        self.made.add(pair)
        if not sure:
            self.unsure.add(pair)
        heapq.heappush(self.heap, (-n, pair))

    def first(self) -> tuple[int, str] | None:
        """Take the first pair out."""
        while self.heap:
            down, pair = heapq.heappop(self.heap)
            if -down == self.count.get(pair):
                return down, pair
            if pair in self.count and -down > self.count[pair]:
                heapq.heappush(self.heap, (-self.count[pair], pair))
        return None


def _certain_merges(best: list[Row], around: list[Row], vocab: Vocabulary, room: int,
                    least: int) -> list[tuple[str, str]]:
    """The merges that are certain from lists of pairs and of their neighbours alone, in order.

    Training does without it now, as ``_judged_merges`` sees further; its tests hold the rules. A merge lowers the counts of the pairs it overlaps and makes new ones, each as frequent as the three symbols it
    comes from. Such a count is exact while no earlier merge of the round has used the outer two symbols from the other
    side; else it is an upper bound, and the pair is unsure. A made pair can be merged in turn; what stands next to
    it is not known, so all pairs that may overlap it become unsure, and they bound those it makes. The next
    merge is certain while it ranks before every unsure pair and every pair that is not listed.
    """
    sides = {(r["pair"], r["side"]): r for r in around}
    floor = (-best[-1]["count"], best[-1]["pair"]) if len(best) == _LISTED else None
    queue = _Queue({r["pair"]: r["count"] for r in best})
    # Second symbols and first symbols of the merges so far.
    ended: set[str] = set()
    begun: set[str] = set()
    touched: dict[str, str] = {}
    taken: list[tuple[str, str]] = []
    merged: set[str] = set()
    while len(taken) < room and (first := queue.first()) is not None:
        down, pair = first
        if -down < max(least, 1) or pair in queue.unsure or floor is not None and first > floor:
            break
        known = vocab.joined(pair) in vocab.ids
        new = vocab.merge(pair)
        taken.append((pair, new))
        merged.add(pair)
        del queue.count[pair]
        if known or pair[0] == pair[1]:
            break
        left, right = pair
        for side, hit in (("left", "right"), ("right", "left")):
            for overlap in sides[pair, side]["shared"] if (pair, side) in sides else ():
                other = overlap["other"]
                if other in merged:
                    continue
                exact = other[0] not in ended and right not in begun if side == "left" else left not in ended and other[1] not in begun
                if not exact or touched.setdefault(other, hit) != hit or other[0] == other[1]:
                    queue.unsure.add(other)
                else:
                    queue.count[other] -= overlap["count"]
        ended.add(right)
        begun.add(left)
        # Of pairs beside a made one, or made ones beside this, it is not known how often they stand there.
        some = queue.count if pair in queue.made else queue.made
        queue.unsure.update(p for p in some if p[1] == left or p[0] == right)
        for side in ("left", "right"):
            for near in sides[pair, side]["near"] if (pair, side) in sides else ():
                symbol_of = near["next"]
                if side == "left" and symbol_of + left not in merged:
                    queue.add(symbol_of + new, -near["down"], symbol_of not in ended and right not in begun)
                if side == "right" and right + symbol_of not in merged:
                    queue.add(new + symbol_of, -near["down"], left not in ended and symbol_of not in begun)
    return taken


def _stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """A written table, and its path, to remove it once there is a newer one."""
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def train_bpe(
    df: DataFrame,
    kind: str = CHAR_BPE,
    vocab_size: int | None = None,
    min_frequency: int | None = 2,
    special_tokens: Sequence[str] = SPECIAL_TOKENS,
    text_column: str = "text",
    limit_alphabet: int | None = None,
) -> Tokenizer:
    """Learn a vocabulary and its merges from a table of texts.

    Merges are taken by count, then left id, then right id, until the vocabulary
    is full or no pair reaches ``min_frequency``; None stands for 2 for the character kind, and for any
    count for the byte-level kind. With ``limit_alphabet`` only so many characters are kept, the
    most frequent, and others vanish; unlike in the public library, the default keeps all, so that
    every trained text can be encoded. A vocabulary holds at most 1,112,063 tokens.
    """
    check_kind(kind)
    least = min_frequency
    if least is None:
        least = MIN_FREQUENCY if kind == CHAR_BPE else 0
    with temporary_tables(df.sparkSession):
        return _train(df, kind, VOCAB_SIZE if vocab_size is None else vocab_size, least, special_tokens,
                      text_column, limit_alphabet)


def _train(df: DataFrame, kind: str, size: int, least: int, special_tokens: Sequence[str], text_column: str,
           limit_alphabet: int | None) -> Tokenizer:
    spark = df.sparkSession
    counts = through_table(word_counts(df, kind, text_column), "words")

    vocab = Vocabulary()
    for token in special_tokens:
        vocab.add(token)
    kept, dropped = _alphabet(counts, limit_alphabet if kind == CHAR_BPE else None)
    for letter in kept:
        vocab.add(letter)
    endings: list[str] = []
    if kind == CHAR_BPE:
        ends = counts.select(F.right("word", F.lit(1)).alias("end")).distinct().collect()
        endings = sorted({r["end"] for r in ends} & set(kept))
    spelled = _spell(F.col("word"), kind, kept, dropped, vocab, endings)

    def tasks_for(table: DataFrame) -> int:
        return max(spark.sparkContext.defaultParallelism, -(-table.count() // _WORDS_A_TASK))

    words = counts.repartition(tasks_for(counts)).select("n", spelled.alias("word"))
    words, words_path = _stored(words.where(F.length("word") > 1), "symbols")
    forecast = _forecast(words)
    rounds: list[list[tuple[str, str]]] = []
    # The words as they were written last without a cut, and the merges since then.
    whole, whole_path, whole_rounds = words, words_path, list(rounds)
    # Words are cut inside pairs that are less frequent; 0 while they are whole.
    cut_below = 0
    # The first round counts; without a guess, a round takes one merge.
    guess: list[tuple[str, str]] = []
    while len(vocab.tokens) < size:
        pairs, pairs_path = _stored(_tried(words, rounds, guess), "pairs")
        best = pairs.orderBy(F.desc("most"), "pair").limit(_JUDGED).collect()
        # Symbols from here on are made by the guess: no more pairs of them than its length squared.
        made = F.lit(symbol(len(vocab.tokens)))
        near = pairs.where((F.left("pair", F.lit(1)) >= made) & (F.right("pair", F.lit(1)) >= made)).collect() if guess else []
        n_tokens = len(vocab.tokens)
        taken, after, lacks_last = _judged_merges(best, near, guess, vocab, size - n_tokens, max(least, cut_below))
        if not taken and not guess and cut_below <= max(least, 1):
            break
        others = best[-1]["most"] if len(best) >= _JUDGED else 0
        if taken:
            whole_rounds.append(taken)
            forecast.learn(taken, after, lacks_last, others)
        # A symbol that was there before has new neighbours, which the cuts did not reckon with.
        known = len(vocab.tokens) < n_tokens + len(taken)
        if cut_below and (known or not taken and not guess):
            old, (whole, whole_path) = whole_path, _stored(whole.mapInPandas(_merged(whole_rounds), whole.schema), "symbols")
            remove_path(spark, old)
            remove_path(spark, words_path)
            words, words_path, rounds, whole_rounds, cut_below = whole, whole_path, [], [], 0
            forecast = _forecast(words)
        elif taken:
            kept: list[str] = []
            # Single letters stand side by side often enough, so words are cut once the first long guess is taken.
            if not known and len(rounds) >= _CUT_ROUNDS and len(vocab.tokens) < size:
                bound = cut_below
                if not bound:
                    forecast.guess(vocab, min(_AHEAD, size - len(vocab.tokens)), least)
                    bound = max(int(_CUT_BELOW * forecast.last_count), least)
                # With a bound of 1 there is nothing to cut.
                kept, bound = _frequent(pairs, bound) if bound > 1 else ([], 0)
            old = words_path
            if kept:
                # These are the counts before the merges of this round.
                cut_below = bound
                words, words_path = _stored(_parts(words, rounds, kept, tasks_for(words)), "symbols")
                rounds = [taken]
                forecast = _forecast(words)
                forecast.learn(taken, after, lacks_last, others)
            else:
                rounds.append(taken)
                if len(rounds) >= _ROUNDS:
                    words, words_path = _stored(words.mapInPandas(_merged(rounds), words.schema), "symbols")
                    rounds = []
            if not cut_below:
                whole, whole_path, whole_rounds = words, words_path, list(rounds)
            if old not in (words_path, whole_path):
                remove_path(spark, old)
        remove_path(spark, pairs_path)
        # Wrong guesses take places, so there may be more of them than merges are wanted.
        guess = forecast.guess(vocab, min(_TRIED, _MOST_TOKENS - len(vocab.tokens)), max(least, cut_below)) if taken else []

    vocab_rows = [(t, i, t in special_tokens) for i, t in enumerate(vocab.tokens)]
    merge_rows = [(i, *m) for i, m in enumerate(vocab.merges)]
    return Tokenizer(
        kind,
        spark.createDataFrame(vocab_rows, VOCAB_SCHEMA),
        spark.createDataFrame(merge_rows, MERGES_SCHEMA),
    )
