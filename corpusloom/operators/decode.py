"""Decode token ids, and check that texts survive the round trip."""

from __future__ import annotations

import codecs
import json
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.functions.ordering import as_keys
from corpusloom.functions.text import CHAR_BPE, WORD_SUFFIX, shown_bytes, strip_spaces, tokens_to_text
from corpusloom.sources.tokenizers import Tokenizer

# Tokens sent to every executor, at most: no vocabulary can be larger.
MAX_TOKENS = 1_112_063


def _ordinary_tokens(tokenizer: Tokenizer) -> list[str | None]:
    """The token of each id, null for special ones; more than ``MAX_TOKENS`` are refused."""
    ordinary = tokenizer.vocab.where("not is_special").select("id", "token")
    if ordinary.count() > MAX_TOKENS or (ordinary.agg(F.max("id")).first()[0] or 0) > MAX_TOKENS:
        raise ValueError(f"a vocabulary holds at most {MAX_TOKENS} tokens")
    by_id = {r["id"]: r["token"] for r in ordinary.collect()}
    return [by_id.get(i) for i in range(max(by_id, default=-1) + 1)]


def decoder(tokenizer: Tokenizer) -> Callable[[Column], Column]:
    """A function from a column of ids to texts; special tokens and unknown ids are left out.

    Tokens are looked up in one array, which is sent to every executor once; a vocabulary of more than
    ``MAX_TOKENS`` tokens is refused. Null ids give a null text.
    """
    tokens = _ordinary_tokens(tokenizer)
    # One literal, made from one string: far cheaper than a literal for each token.
    listed = F.from_json(F.lit(json.dumps(tokens)), F.lit("array<string>"))

    def of(ids: Column) -> Column:
        known = F.transform(ids, lambda i: F.when(i >= 0, F.get(listed, i)))
        return tokens_to_text(F.filter(known, lambda t: t.isNotNull()), tokenizer.kind)

    return of


def with_text(df: DataFrame, tokenizer: Tokenizer, ids_column: str = "raw_ids") -> DataFrame:
    """All columns, and ``decoded``; nothing is moved."""
    return df.withColumn("decoded", decoder(tokenizer)(F.col(ids_column)))


def decode(
    df: DataFrame,
    tokenizer: Tokenizer,
    key: str | Sequence[str],
    ids_column: str = "raw_ids",
) -> DataFrame:
    """Rows ``(*key, decoded)``, one for each row of ``df``; keys may be null or repeated."""
    text = decoder(tokenizer)(F.col(ids_column))
    return df.select(*as_keys(key), text.alias("decoded"))


class Settling:
    """The text that each token of a sequence settles, as the tokens come.

    What a later token can still change is held back: the bytes of an unfinished character, or the space
    after a word, which the end of the text does without.
    """

    def __init__(self, kind: str):
        self.word_ended = False
        self.characters = None if kind == CHAR_BPE else codecs.getincrementaldecoder("utf-8")("replace")
        self.byte_of = {c: b for b, c in enumerate(shown_bytes())}

    def push(self, token: str | None) -> str:
        if token is None:
            return ""
        if self.characters is not None:
            return self.characters.decode(bytes(self.byte_of[c] for c in token))
        before = " " if self.word_ended else ""
        self.word_ended = token.endswith(WORD_SUFFIX)
        return before + (token.removesuffix(WORD_SUFFIX)).replace(WORD_SUFFIX, " ")

    def end(self) -> str:
        return "" if self.characters is None else self.characters.decode(b"", final=True)


def _settler(shared: Broadcast, kind: str, byte_of: dict[str, int]) -> Callable:
    """What ``Settling`` does, for the ids of many rows in one array; nested, so that it travels without this package.

    A token's text is looked up, but for byte-level tokens that hold unfinished characters, up to the place where all are finished.
    """
    by_character, suffix = kind == CHAR_BPE, WORD_SUFFIX

    def raw(token: str) -> bytes:
        return bytes(byte_of[c] for c in token)

    def alone(token: str | None) -> str | None:
        """The text of a token by itself; None if others have a say in it."""
        if token is None:
            return ""
        if by_character:
            return token.removesuffix(suffix).replace(suffix, " ")
        try:
            return raw(token).decode()
        except (KeyError, UnicodeDecodeError):
            return None

    def settle(batches):
        # Unknown ids stand at the end, with special tokens' texts.
        tokens = [*shared.value, None]
        unknown = len(tokens) - 1
        texts = [alone(t) for t in tokens]
        whole = np.array([t is not None for t in texts])
        real = np.array([t is not None for t in tokens])
        ends_word = np.array([t is not None and t.endswith(suffix) for t in tokens])
        listed = [t or "" for t in texts]
        spaced = [f" {t}" for t in listed] if by_character else []

        def after_words(picks: np.ndarray, ends: np.ndarray) -> np.ndarray:
            """A token after one that ends a word, in the same row, comes with the space between them."""
            at = np.flatnonzero(real[picks])
            row = np.searchsorted(ends, at, side="right")
            after = at[1:][ends_word[picks[at[:-1]]] & (row[1:] == row[:-1])]
            picks[after] += len(listed)
            return picks

        def unfinished(picks: np.ndarray, ends: np.ndarray) -> list[str]:
            """Put texts of their own where characters are unfinished; returns these."""
            found: list[str] = []

            def own(at: int, text: str) -> None:
                picks[at] = len(listed) + len(found)
                found.append(text)

            done = 0
            for begin in np.flatnonzero(~whole[picks]).tolist():
                if begin < done:
                    continue
                decoder = codecs.getincrementaldecoder("utf-8")("replace")
                end, done, text = int(ends[np.searchsorted(ends, begin, side="right")]), begin, ""
                while done < end:
                    token = tokens[picks[done]]
                    text = "" if token is None else decoder.decode(raw(token))
                    own(done, text)
                    done += 1
                    if not decoder.getstate()[0]:
                        break
                else:
                    own(end - 1, text + decoder.decode(b"", final=True))
            return found

        for batch in batches:
            sizes = pc.fill_null(pc.list_value_length(batch), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            ids = pc.fill_null(batch.flatten(), -1).to_numpy(zero_copy_only=False)
            # What is not a number is no id either; others are cut to whole ones.
            ids = np.nan_to_num(ids, nan=-1, posinf=unknown, neginf=-1)
            ids = np.where(ids <= -1, -1, ids).astype(np.int64)
            picks, ends = np.where((ids >= 0) & (ids < unknown), ids, unknown), np.cumsum(sizes)
            if by_character:
                own_texts, picks = spaced, after_words(picks, ends)
            else:
                own_texts = unfinished(picks, ends)
            text = pa.array(listed + own_texts, pa.string()).take(pa.array(picks))
            offsets = pa.array(np.concatenate(([0], ends)), pa.int32())
            yield pa.ListArray.from_arrays(offsets, text, mask=batch.is_null())

    settle.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return settle


def with_pieces(df: DataFrame, tokenizer: Tokenizer, ids_column: str = "raw_ids") -> DataFrame:
    """All columns, and ``pieces``: for each id the text that it settles, as one who reads along would see it.

    The pieces of a row joined are its decoded text. Special and unknown ids settle nothing; what is still held
    back at the end belongs to the last piece. Null ids give null, no ids no pieces. Nothing is moved; of the
    vocabulary each executor gets one copy.
    """
    shared = df.sparkSession.sparkContext.broadcast(_ordinary_tokens(tokenizer))
    byte_of = {c: b for b, c in enumerate(shown_bytes())}
    pieces = F.arrow_udf(_settler(shared, tokenizer.kind, byte_of), "array<string>")
    return df.withColumn("pieces", pieces(F.col(ids_column)))


def round_trip(df: DataFrame, text_column: str = "text") -> DataFrame:
    """For each split: texts, texts equal to their stripped ``decoded`` text, and the share."""
    same = F.count_if(strip_spaces(F.col("decoded")) == F.col(text_column))
    rows = F.count(F.lit(1))
    return df.groupBy("split").agg(
        rows.alias("n_texts"), same.alias("n_same"), (same / rows).alias("share_same")
    )


def special_entries(tokenizer: Tokenizer) -> DataFrame:
    """Vocabulary entries that start with ``<``; ordinary merged tokens can be among them."""
    return tokenizer.vocab.where(F.col("token").startswith("<"))


def token_ids(tokenizer: Tokenizer, tokens: list[str]) -> DataFrame:
    """One row with one column ``id_1, id_2, ...`` for each token; null where it is absent."""
    return tokenizer.vocab.agg(
        *[
            F.max(F.when(F.col("token") == token, F.col("id"))).alias(f"id_{n}")
            for n, token in enumerate(tokens, 1)
        ]
    )


def eot_id(tokenizer: Tokenizer) -> DataFrame:
    """The end mark: ``<|end_of_text|>``, else ``</s>``, else 2."""
    found = token_ids(tokenizer, ["<|end_of_text|>", "</s>"])
    return found.select(F.coalesce("id_1", "id_2", F.lit(2)).alias("eot_id"))


def vocabulary_size(tokenizer: Tokenizer) -> int:
    return tokenizer.vocab.count()
