"""Encode texts in one pass, without moving them.

Words are cut out by Spark's own functions. The ids of a batch's words are worked out next to
the rows: each distinct word once, many words in one array, by merge rules that every executor has. No key, no
join and no shuffle, so null and repeated keys do no harm, and a stream is encoded like a table.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.functions.ordering import as_keys
from corpusloom.functions.text import BYTE_BPE, CHAR_BPE, WORD_SUFFIX, encoding_words, shown_bytes
from corpusloom.sources.tokenizers import Tokenizer

# Fixed value: the token for what the vocabulary lacks.
UNKNOWN_TOKEN = "<|unk|>"

# Merges and tokens sent to every executor, at most; a tokenizer has no more than 1,112,063 tokens.
MAX_RULES = 2_000_000
# Distinct words that a worker remembers; with those of the 500,000 words at hand there may be twice as many.
_REMEMBERED = 500_000


def _small(df: DataFrame, what: str) -> list:
    """Rows of a tokenizer table, whose size is checked first."""
    rows = df.count()
    if rows > MAX_RULES:
        raise ValueError(f"{rows} {what}: a tokenizer holds at most {MAX_RULES}")
    return df.collect()


def _segmenter(rules: Broadcast, suffix: str, shown: list[str] | None) -> Callable:
    """The function that runs in the tasks; nested, so that it travels without this package."""

    class Rules:
        """The rules as arrays: ids by letter, and codes of pairs with the order and the results of their merges."""

        def __init__(self):
            self.ids, self.special, self.merges, self.unknown = rules.value
            missing = -1 if self.unknown is None else self.unknown
            if shown is not None:
                self.plain = np.array([self.ids.get(c, missing) for c in shown], dtype=np.int64)
            else:
                top = max((ord(t[0]) for t in self.ids if t), default=0) + 1
                # The last place is that of any character further up.
                self.plain, self.ending = np.full(top + 1, missing, dtype=np.int64), np.full(top + 1, missing, dtype=np.int64)
                for token, token_id in self.ids.items():
                    if len(token) == 1:
                        self.plain[ord(token)] = token_id
                    if len(token) == 1 + len(suffix) and token.endswith(suffix):
                        self.ending[ord(token[0])] = token_id
            self.base = max(self.ids.values(), default=0) + 1
            ordered = sorted(self.merges.items(), key=lambda merge: merge[1][0])
            codes = np.array([left * self.base + right for (left, right), _ in ordered], dtype=np.int64)
            self.made = np.array([new for _, (_, new) in ordered], dtype=np.int64)
            self.turn = np.argsort(codes)
            self.codes = codes[self.turn]

        def turns(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
            """When each pair is merged; the number of merges if it never is."""
            code = left * self.base + right
            hit = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            return np.where(self.codes[hit] == code, self.turn[hit], len(self.codes))

    def merge_short(rule: Rules, ids: np.ndarray, lens: np.ndarray, number: np.ndarray) -> Iterator[tuple]:
        """Merge adjacent ids of many words, in each the lowest rank first and leftmost first among equals.

        Gives numbers, lengths and ids of the words that are done.
        """
        never, place = len(rule.codes), (1 << 32) - 1
        turns = np.full(len(ids), never, dtype=np.int64)
        if never and len(ids) > 1:
            turns[:-1] = rule.turns(ids[:-1], ids[1:])
            turns[np.cumsum(lens) - 1] = never
        while len(lens):
            starts = np.cumsum(lens) - lens
            first = np.minimum.reduceat(turns << 32 | np.arange(len(ids)), starts)
            goes_on = first >> 32 < never
            if not goes_on.all():
                of_word = np.repeat(goes_on, lens)
                yield number[~goes_on], lens[~goes_on], ids[~of_word]
                at = (first & place) - starts
                ids, turns, number, lens, at, first = ids[of_word], turns[of_word], number[goes_on], lens[goes_on], at[goes_on], first[goes_on]
                if not len(lens):
                    return
                at += np.cumsum(lens) - lens
            else:
                at = first & place
            ids[at] = rule.made[first >> 32]
            stays = np.ones(len(ids), dtype=bool)
            stays[at + 1] = False
            ids, turns, lens = ids[stays], turns[stays], lens - 1
            at -= np.arange(len(at))
            ends = np.cumsum(lens)
            turns[at] = never
            inner = at[at < ends - 1]
            turns[inner] = rule.turns(ids[inner], ids[inner + 1])
            inner = at[at > ends - lens]
            turns[inner - 1] = rule.turns(ids[inner - 1], ids[inner])

    def merge_long(ids: list[int], merges: dict) -> list[int]:
        """The same with a queue of pairs, for words of any length."""
        end = len(ids)
        after = list(range(1, end + 1))
        before = list(range(-1, end - 1))
        queue: list[tuple[int, int, int, int]] = []

        def offer(at: int) -> None:
            if at >= 0 and after[at] < end:
                pair = ids[at], ids[after[at]]
                if pair in merges:
                    heapq.heappush(queue, (merges[pair][0], at, *pair))

        for at in range(end - 1):
            offer(at)
        while queue:
            _, at, left, right = heapq.heappop(queue)
            mate = after[at]
            if mate >= end or ids[at] != left or ids[mate] != right:
                continue
            ids[at] = merges[left, right][1]
            ids[mate] = None
            after[at] = after[mate]
            if after[at] < end:
                before[after[at]] = at
            offer(before[at])
            offer(at)
        return [i for i in ids if i is not None]

    def letters_of(rule: Rules, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the letters of all words, and how many each word has."""
        if shown is not None:
            raw = [word.encode() for word in words]
            lens = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
            ids = rule.plain[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        else:
            lens = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
            points = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4")
            points = np.minimum(points, len(rule.plain) - 1)
            ids, ends = rule.plain[points], np.cumsum(lens) - 1
            ids[ends] = rule.ending[points[ends]]
        if rule.unknown is None and (ids < 0).any():
            ends, lost = np.cumsum(lens), int(np.argmax(ids < 0))
            at = int(np.searchsorted(ends, lost, side="right"))
            word = words[at]
            letters = list(word) if shown is None else [shown[b] for b in word.encode()]
            letters[-1] += suffix
            raise ValueError(f"not in the vocabulary: {letters[lost - ends[at]]!r} of {word!r}")
        return ids, lens

    def pieces(rule: Rules, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all words in one array, and where those of each word start and how many they are."""
        ids, lens = letters_of(rule, words)
        short = lens < 64
        done = list(merge_short(rule, ids[np.repeat(short, lens)], lens[short], np.flatnonzero(short)))
        ends = np.cumsum(lens)
        for at in np.flatnonzero(~short).tolist():
            found = merge_long(ids[ends[at] - lens[at] : ends[at]].tolist(), rule.merges)
            done.append((np.array([at]), np.array([len(found)]), np.array(found, dtype=np.int64)))
        number, lens, ids = (np.concatenate(parts) for parts in zip(*done))
        back = np.argsort(number)
        return ids.astype(np.int32), (np.cumsum(lens) - lens)[back], lens[back]

    def segment(batches):
        rule = Rules()
        known: dict[str, int] = {}
        values, starts, lens = np.empty(0, dtype=np.int32), np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)

        def remember(words: list[str], new: tuple) -> np.ndarray:
            nonlocal values, starts, lens
            number = np.arange(len(starts), len(starts) + len(words))
            known.update(zip(words, number.tolist()))
            starts = np.concatenate((starts, new[1] + len(values)))
            values, lens = np.concatenate((values, new[0])), np.concatenate((lens, new[2]))
            return number

        for batch in batches:
            # A null text has no words.
            sizes = pc.fill_null(pc.list_value_length(batch), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat, ids, of_word = batch.flatten(), [values[:0]], [lens[:0]]
            for begin in range(0, len(flat), 500_000):
                if not known or len(known) >= _REMEMBERED:
                    known.clear()
                    values, starts, lens = values[:0], starts[:0], lens[:0]
                    for word, special in rule.special.items():
                        remember([word], (np.array(special, dtype=np.int32), np.array([0]), np.array([len(special)])))
                part = flat.slice(begin, 500_000).dictionary_encode()
                words = part.dictionary.to_pylist()
                number = np.fromiter((known.get(word, -1) for word in words), dtype=np.int64, count=len(words))
                unseen = np.flatnonzero(number < 0)
                if len(unseen):
                    new = [words[at] for at in unseen.tolist()]
                    number[unseen] = remember(new, pieces(rule, new))
                which = number[part.indices.to_numpy()]
                n_ids = lens[which]
                shift = starts[which] - (np.cumsum(n_ids) - n_ids)
                ids.append(values[np.arange(n_ids.sum()) + np.repeat(shift, n_ids)])
                of_word.append(n_ids)
            so_far = np.concatenate(([0], np.cumsum(np.concatenate(of_word))))
            offsets = so_far[np.concatenate(([0], np.cumsum(sizes)))]
            yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(ids), pa.int32()))

    # Where annotations are strings, as here, Spark would not know what they mean.
    segment.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return segment


def encoder(tokenizer: Tokenizer, on_unknown: str | None = None) -> Callable[[Column], Column]:
    """A function from a text column to its ids; the tokenizer's tables are read at once.

    ``on_unknown`` is ``"error"`` or ``"unk"``; the default is an error for the
    character kind and the unknown token for the byte-level kind. A null text has no ids. A
    tokenizer of more than ``MAX_RULES`` merges or tokens is refused.
    """
    kind = tokenizer.kind
    on_unknown = on_unknown or ("error" if kind == CHAR_BPE else "unk")
    if on_unknown not in ("error", "unk"):
        raise ValueError("on_unknown is 'error' or 'unk'")
    vocab = _small(tokenizer.vocab, "tokens")
    ids = {r["token"]: r["id"] for r in vocab}
    special = {r["token"]: [r["id"]] for r in vocab if r["is_special"]}
    merges = {
        (ids[r["left"]], ids[r["right"]]): (r["rank"], ids[r["new_token"]])
        for r in sorted(_small(tokenizer.merges, "merges"), key=lambda r: r["rank"])
    }
    unknown = ids.get(UNKNOWN_TOKEN) if on_unknown == "unk" else None
    rules = tokenizer.vocab.sparkSession.sparkContext.broadcast((ids, special, merges, unknown))
    suffix = WORD_SUFFIX if kind == CHAR_BPE else ""
    shown = shown_bytes() if kind == BYTE_BPE else None
    segment = F.arrow_udf(_segmenter(rules, suffix, shown), "array<int>")

    def of(text: Column) -> Column:
        return segment(encoding_words(text, kind, list(special)))

    return of


def with_ids(
    df: DataFrame, tokenizer: Tokenizer, text_column: str = "text", on_unknown: str | None = None
) -> DataFrame:
    """All columns, and ``raw_ids``. ``df`` may be a stream."""
    return df.withColumn("raw_ids", encoder(tokenizer, on_unknown)(F.col(text_column)))


def encode(
    df: DataFrame,
    tokenizer: Tokenizer,
    key: str | Sequence[str],
    text_column: str = "text",
    on_unknown: str | None = None,
) -> DataFrame:
    """Rows ``(*key, raw_ids)``, one for each row of ``df``; keys may be null or repeated."""
    ids = encoder(tokenizer, on_unknown)(F.col(text_column))
    return df.select(*as_keys(key), ids.alias("raw_ids"))
