import random
from collections import Counter

import pytest

from corpusloom.functions.text import BYTE_BPE, CHAR_BPE, SPECIAL_TOKENS
from corpusloom.operators import bpe
from corpusloom.operators.bpe import Vocabulary, symbol, train_bpe
from corpusloom.operators.words import pair_counts, word_counts


def merge(word, pair, new):
    return word.replace(pair, new)


def one_by_one(words, vocab, room, least):
    """One merge a round, counted anew each time."""
    taken = []
    while len(taken) < room:
        counts = Counter()
        for word, n in words:
            for a, b in zip(word, word[1:]):
                counts[a + b] += n
        if not counts:
            break
        pair, n = min(counts.items(), key=lambda kv: (-kv[1], kv[0]))
        if n < max(least, 1):
            break
        new = vocab.merge(pair)
        taken.append((pair, new))
        words = [(merge(w, pair, new), n) for w, n in words]
    return taken


def listed(words, limit):
    counts = Counter()
    for word, n in words:
        for a, b in zip(word, word[1:]):
            counts[a + b] += n
    best = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:limit]
    return [{"pair": p, "count": n} for p, n in best]


def surroundings(words, pairs, least=1):
    threes = Counter()
    for word, n in words:
        for a, b, c in zip(word, word[1:], word[2:]):
            threes[a + b + c] += n
    rows = {}
    for three, n in threes.items():
        for pair, side, other, near in (
            (three[:2], "right", three[1:], three[2]),
            (three[1:], "left", three[:2], three[0]),
        ):
            if pair in pairs:
                row = rows.setdefault((pair, side), {"pair": pair, "side": side, "all": [], "shared": []})
                row["all"].append((-n, near))
                if other in pairs:
                    row["shared"].append({"other": other, "count": n})
    for row in rows.values():
        row["near"] = [{"down": down, "next": near} for down, near in row["all"] if -down >= least]
    return list(rows.values())


@pytest.mark.parametrize("limit", [3, 8, 256])
def test_merges_of_a_round_equal_one_by_one(monkeypatch, limit):
    monkeypatch.setattr(bpe, "_LISTED", limit)
    rng = random.Random(limit)
    several = 0
    for _ in range(1500):
        letters = "abcdef"[: rng.randint(1, 6)]
        texts = Counter(
            "".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(1, 25))
        )
        start = [(t, n * rng.randint(1, 3)) for t, n in texts.items()]
        vocabs = [Vocabulary(), Vocabulary()]
        for vocab in vocabs:
            for c in letters:
                vocab.add(c)
        spelled = [("".join(vocabs[0].add(c) for c in t), n) for t, n in start]
        room, least = rng.randint(1, 40), rng.choice([0, 2, 3])
        expected = one_by_one(spelled, vocabs[0], room, least)
        words, got = spelled, []
        while len(got) < room:
            best = listed(words, limit)
            if not best or best[0]["count"] < max(least, 1):
                break
            lowest = best[-1]["count"] if len(best) == limit else max(least, 1)
            around = surroundings(words, {r["pair"] for r in best}, lowest)
            taken = bpe._certain_merges(best, around, vocabs[1], room - len(got), least)
            assert taken
            several += len(taken) > 1
            got += taken
            for pair, new in taken:
                words = [(merge(w, pair, new), n) for w, n in words]
        assert got == expected
        assert vocabs[0].merges == vocabs[1].merges and vocabs[0].tokens == vocabs[1].tokens
    assert several > 100


def texts(spark, *rows):
    return spark.createDataFrame([(r,) for r in rows], "text string")


def merges_of(tokenizer):
    return [(r.left, r.right) for r in tokenizer.merges.orderBy("rank").collect()]


TOY = ["ab ab cd cd ba ba aaaa aaaa abab abab", "the  cat\tthe dog\n\n it's the cats' aaaa", "ééé naïve ééé 中文中文", ""]


def test_byte_level_equals_the_public_library(spark, tmp_path):
    tokenizers = pytest.importorskip("tokenizers")
    path = tmp_path / "toy.txt"
    path.write_bytes("".join(t + "\n" for t in TOY).encode())
    made = tokenizers.Tokenizer(tokenizers.models.BPE(unk_token="<|unk|>"))
    made.pre_tokenizer = tokenizers.pre_tokenizers.ByteLevel()
    trainer = tokenizers.trainers.BpeTrainer(
        min_frequency=2, special_tokens=list(SPECIAL_TOKENS), show_progress=False
    )
    made.train([str(path)], trainer=trainer)
    ours = train_bpe(texts(spark, *TOY), BYTE_BPE)
    assert {r.token: r.id for r in ours.vocab.collect()} == made.get_vocab()


def test_char_kind_equals_one_by_one(spark, documents):
    ours = train_bpe(documents, CHAR_BPE, vocab_size=240)
    counts = word_counts(documents, CHAR_BPE).collect()
    vocab = Vocabulary()
    for token in SPECIAL_TOKENS:
        vocab.add(token)
    for c in sorted({c for r in counts for c in r.word}):
        vocab.add(c)
    for c in sorted({r.word[-1] for r in counts}):
        vocab.add(c + "</w>")
    spelled = [
        ("".join(vocab.add(c) for c in r.word[:-1]) + vocab.add(r.word[-1] + "</w>"), r.n) for r in counts
    ]
    one_by_one(spelled, vocab, 240 - len(vocab.tokens), 2)
    rows = ours.vocab.orderBy("id").collect()
    assert [r.token for r in rows] == vocab.tokens and len(rows) == 240
    assert [r.is_special for r in rows[:5]] == [True] * 4 + [False]
    assert merges_of(ours) == [m[:2] for m in vocab.merges]


def test_special_tokens_take_the_first_ids_and_can_be_replaced(spark):
    ours = train_bpe(texts(spark, "ab ab"), CHAR_BPE, special_tokens=["<s>", "</s>"])
    rows = {r.token: (r.id, r.is_special) for r in ours.vocab.collect()}
    assert rows == {"<s>": (0, True), "</s>": (1, True), "a": (2, False), "b": (3, False),
                    "b</w>": (4, False), "ab</w>": (5, False)}


def test_min_frequency_and_vocab_size_stop_the_training(spark):
    corpus = texts(spark, "abc abc abc xy")
    assert merges_of(train_bpe(corpus, CHAR_BPE, min_frequency=4)) == []
    assert merges_of(train_bpe(corpus, CHAR_BPE)) == [("a", "b"), ("ab", "c</w>")]
    assert merges_of(train_bpe(corpus, CHAR_BPE, min_frequency=None)) == [("a", "b"), ("ab", "c</w>")]
    assert ("x", "y</w>") in merges_of(train_bpe(corpus, CHAR_BPE, min_frequency=0))
    size = 4 + 5 + 2 + 1
    assert len(merges_of(train_bpe(corpus, CHAR_BPE, vocab_size=size))) == 1


def test_rare_characters_leave_the_alphabet(spark):
    ours = train_bpe(texts(spark, "aab aab acb"), CHAR_BPE, limit_alphabet=2)
    tokens = {r.token for r in ours.vocab.collect()}
    assert "c" not in tokens and {"a", "b", "b</w>", "ab</w>"} <= tokens


def test_unsupported_kind(spark):
    for kind in ("bpe", "word_level"):
        with pytest.raises(ValueError, match="no such kind of tokenizer"):
            train_bpe(texts(spark, "a"), kind)


def test_symbols_skip_surrogates():
    points = [ord(symbol(i)) for i in (0, 0xD7FE, 0xD7FF, 1_112_062)]
    assert points == [1, 0xD7FF, 0xE000, 0x10FFFF]
    with pytest.raises(ValueError):
        symbol(1_112_063)


def test_pair_counts(spark):
    counts = spark.createDataFrame([("aaa", 2), ("ab", 3), ("x", 9)], "word string, n long")
    got = {(r.left, r.right): r.n for r in pair_counts(counts, CHAR_BPE).collect()}
    assert got == {("a", "a"): 2, ("a", "a</w>"): 2, ("a", "b</w>"): 3}
    got = {(r.left, r.right): r.n for r in pair_counts(counts, BYTE_BPE).collect()}
    assert got == {("a", "a"): 4, ("a", "b"): 3}
