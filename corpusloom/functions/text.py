"""Words of a text, as the two tokenizer kinds see them."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

from corpusloom.functions.binding import once

# Tokenizer kinds, word suffix and special tokens (ids 0 to 3).
CHAR_BPE = "char_bpe"
BYTE_BPE = "byte_level_bpe"
KINDS = (CHAR_BPE, BYTE_BPE)
WORD_SUFFIX = "</w>"
SPECIAL_TOKENS = ("<|pad|>", "<|start_of_text|>", "<|end_of_text|>", "<|unk|>")

# Unicode blocks whose characters are words of their own.
CJK = (
    r"\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}\x{20000}-\x{2A6DF}\x{2A700}-\x{2B73F}"
    r"\x{2B740}-\x{2B81F}\x{2B920}-\x{2CEAF}\x{F900}-\x{FAFF}\x{2F800}-\x{2FA1F}"
)
# Punctuation (ASCII marks and symbols, Unicode category P).
PUNCTUATION = r"!-/:-@\[-`{-~\p{P}"

# The spaces between words; other control characters vanish.
BLANK = r" \t\n\r\p{Z}"
CONTROL = r"[\x{FFFD}\p{C}&&[^\t\n\r]]"

CHAR_WORD = rf"[^{BLANK}{PUNCTUATION}]+|[{PUNCTUATION}]"
CHAR_WORD_CJK = rf"[^{BLANK}{PUNCTUATION}{CJK}]+|[{PUNCTUATION}{CJK}]"
# A quick test for texts that may hold such characters.
MAY_BE_CJK = r"[^\x{0}-\x{33FF}]"

# The published GPT-2 word pattern.
BYTE_WORD = r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The same for a text of many lines, where a line end closes a run of spaces.
BYTE_WORD_BY_LINE = (
    r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
    r"|[^\S\n]*\n|[^\S\n]+(?!\S)|[^\S\n]+"
)


# What counts as a space around a decoded text.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def check_kind(kind: str) -> str:
    if kind not in KINDS:
        raise ValueError(f"no such kind of tokenizer: {kind!r}; there are {', '.join(KINDS)}")
    return kind


def _extract(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def char_words(text: Column) -> Column:
    """Words and single punctuation marks, without control characters."""
    visible = F.when(text.rlike(CONTROL), F.regexp_replace(text, CONTROL, "")).otherwise(text)
    return F.when(text.rlike(MAY_BE_CJK), _extract(visible, CHAR_WORD_CJK)).otherwise(
        _extract(visible, CHAR_WORD)
    )


def byte_words(text: Column) -> Column:
    """Words with their leading space; the text gets one if it has none."""
    spaced = F.when(text.startswith(" ") | (text == ""), text).otherwise(F.concat(F.lit(" "), text))
    return _extract(spaced, BYTE_WORD)


def byte_words_by_line(text: Column) -> Column:
    """Words for training: each line ends with a line end and gets its own leading space."""
    spaced = F.regexp_replace(F.concat(text, F.lit("\n")), r"(?dm)^(?! )", " ")
    return _extract(spaced, BYTE_WORD_BY_LINE)


def training_words(text: Column, kind: str) -> Column:
    return char_words(text) if check_kind(kind) == CHAR_BPE else byte_words_by_line(text)


def encoding_words(text: Column, kind: str, special_tokens: Sequence[str] = ()) -> Column:
    """Words to encode; special tokens are cut out first and stay whole."""
    split_up = char_words if check_kind(kind) == CHAR_BPE else byte_words
    if not special_tokens:
        return split_up(text)
    longest_first = sorted(special_tokens, key=lambda t: (-len(t), t))
    special = "|".join(re.escape(t) for t in longest_first)
    pieces = F.split(text, f"(?<={special})|(?={special})")
    cut = F.flatten(
        F.transform(
            pieces,
            lambda p: F.when(p.isin(*special_tokens), F.array(p)).otherwise(split_up(p)),
        )
    )
    # Plain byte searches, far cheaper than a pattern over every text.
    has_special = reduce(lambda a, b: a | b, [F.contains(text, F.lit(t)) for t in longest_first])
    return F.when(has_special, cut).otherwise(split_up(text))


def _byte_characters() -> list[int]:
    """Code point that shows each byte: printable bytes stay, the others follow from 256 on."""
    stays = [33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255 for b in range(256)]
    moved = iter(range(256, 512))
    return [b if stays[b] else next(moved) for b in range(256)]


def shown_bytes() -> list[str]:
    """The printable character for each byte."""
    return [chr(c) for c in _byte_characters()]


_MOVED = [(chr(b), chr(c)) for b, c in enumerate(_byte_characters()) if b != c]
_RAW = "".join(raw for raw, _ in _MOVED)
_SHOWN = "".join(shown for _, shown in _MOVED)


def bytes_to_characters(text: Column) -> Column:
    """One printable character for each UTF-8 byte of the text."""
    return F.translate(F.decode(F.encode(text, "UTF-8"), "ISO-8859-1"), _RAW, _SHOWN)


def characters_to_text(shown: Column) -> Column:
    """Back to text; bytes that are not valid UTF-8 become replacement characters."""
    # Byte 0 is put back by itself: to translate() it would mean "drop".
    raw = F.replace(F.translate(shown, _SHOWN[1:], _RAW[1:]), F.lit(_SHOWN[0]), F.lit(_RAW[0]))
    return F.make_valid_utf8(F.encode(raw, "ISO-8859-1").cast("string"))


def tokens_to_text(tokens: Column, kind: str) -> Column:
    """The text of a token sequence. A word suffix is a space, but nothing at the end."""
    if check_kind(kind) != CHAR_BPE:
        return characters_to_text(F.array_join(tokens, ""))

    def spaced(given: Column) -> Column:
        words = F.transform(given, lambda t: F.replace(t, F.lit(WORD_SUFFIX), F.lit(" ")))
        text = F.array_join(words, "")
        ends_word = F.get(given, F.size(given) - 1).endswith(WORD_SUFFIX)
        return F.when(ends_word, F.substr(text, F.lit(1), F.length(text) - 1)).otherwise(text)

    return once(tokens, spaced)


def strip_spaces(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def word_symbols(word: Column, kind: str) -> Column:
    """A word in the characters its tokenizer works on."""
    return word if kind == CHAR_BPE else bytes_to_characters(word)
