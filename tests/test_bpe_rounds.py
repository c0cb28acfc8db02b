"""Rounds of training that try many guessed merges at once."""

import random
from collections import Counter

import pandas as pd
import pytest

from corpusloom.functions.text import BYTE_BPE, SPECIAL_TOKENS
from corpusloom.operators import bpe
from corpusloom.operators.bpe import Vocabulary, symbol, train_bpe
from tests.test_bpe import one_by_one


def tried(words, rounds, guess):
    """What ``_tried`` gives, without Spark."""
    batch = pd.DataFrame(words, columns=["word", "n"])
    rows = {}
    for found in bpe._trial(rounds, guess)(iter([batch])):
        for step, pair, n in found.itertuples(index=False):
            row = rows.setdefault(pair, {"pair": pair, "count": 0, "most": 0, "changes": []})
            if step < 0:
                row["count"] += n
            else:
                row["changes"].append({"step": step, "count": n})
            if step < 0 or n > 0:
                row["most"] += n
    return sorted(rows.values(), key=lambda r: (-r["most"], r["pair"]))


def swapped(rng, guess):
    """Two neighbours change places, if the second does not need the first."""
    if len(guess) < 2:
        return guess
    at = rng.randrange(len(guess) - 1)
    (p, x), (q, y) = guess[at], guess[at + 1]
    if x in q:
        return guess
    later = [("".join({x: y, y: x}.get(c, c) for c in pair), new) for pair, new in guess[at + 2 :]]
    return [*guess[:at], (q, x), (p, y), *later]


@pytest.mark.parametrize("judged", [3, 30, 8192])
def test_rounds_equal_one_by_one(monkeypatch, judged):
    monkeypatch.setattr(bpe, "_JUDGED", judged)
    rng = random.Random(judged)
    seen = Counter()
    for _ in range(500):
        letters = "abcdef"[: rng.randint(1, 6)]
        parts = ["".join(rng.choices(letters, k=rng.randint(1, 3))) for _ in range(rng.randint(2, 8))]
        texts = Counter("".join(rng.choices(parts, k=rng.randint(1, 6))) for _ in range(rng.randint(1, 40)))
        vocabs = [Vocabulary(), Vocabulary()]
        for vocab in vocabs:
            for c in letters:
                vocab.add(c)
        words = [("".join(vocabs[0].add(c) for c in t), n * rng.randint(1, 3)) for t, n in texts.items()]
        room, least, swaps = rng.randint(1, 60), rng.choice([0, 2, 3]), rng.choice([0, 2, 5])
        expected = one_by_one(words, vocabs[0], room, least)
        # The guess does not know all words.
        forecast = bpe._Forecast([(w, n * rng.uniform(0.7, 1.4)) for w, n in words if rng.random() < 0.8])
        got, rounds, guess = [], [], []
        while len(got) < room:
            table = tried(words, rounds, guess)
            best, made = table[:judged], symbol(len(vocabs[1].tokens))
            near = [r for r in table if min(r["pair"]) >= made] if guess else []
            taken, after, lacks_last = bpe._judged_merges(best, near, guess, vocabs[1], room - len(got), least)
            if not taken and not guess:
                break
            seen["several"] += len(taken) > 1
            seen["another order"] += len(taken) > 2 and [p for p, _ in guess[: len(taken)]] != [p for p, _ in taken]
            if taken:
                rounds.append(taken)
                got += taken
                forecast.learn(taken, after, lacks_last, best[-1]["most"] if len(best) == judged else 0)
                guess = forecast.guess(vocabs[1], rng.choice([5, 40]), least)
                for _ in range(swaps):
                    guess = swapped(rng, guess)
            else:
                guess = []
        assert got == expected
        assert vocabs[0].merges == vocabs[1].merges and vocabs[0].tokens == vocabs[1].tokens
    assert seen["several"] > 100 and (judged == 3 or seen["another order"] > 30)


def test_long_words_are_spelled_and_counted_like_short_ones():
    merges = [("ab", "x"), ("aa", "y"), ("xc", "z"), ("yx", "w"), ("zz", "v")]
    spell, changes = bpe._spelling()
    rng = random.Random(1)
    for _ in range(50):
        word = "".join(rng.choices("abc", k=rng.randint(250, 900)))
        expected = word
        for pair, new in merges:
            expected = expected.replace(pair, new)
        lost = Counter()
        spell(word, merges, bpe._ranks(merges), lambda at, w, pair, new: lost.update(dict_of(changes(w, pair, new))))
        assert spell(word, merges, bpe._ranks(merges)) == expected
        found = Counter(map(str.__add__, word, word[1:]))
        for pair, n in lost.items():
            found[pair] += n
        assert +found == Counter(map(str.__add__, expected, expected[1:])) and min(found.values()) == 0


def dict_of(changes):
    sums = Counter()
    for pair, n in changes:
        sums[pair] += n
    return sums


def test_few_rounds_for_many_merges(spark, documents, monkeypatch):
    written, stored = [], bpe._stored
    monkeypatch.setattr(bpe, "_stored", lambda df, name: written.append(name) or stored(df, name))
    merges = train_bpe(documents, vocab_size=900).merges
    assert merges.count() > 500 and len(written) <= 20


def test_words_in_one_array_are_merged_and_counted_like_words_alone():
    """Blocks of many words: merges, the pairs they take away and make, and the words that are left."""
    rng = random.Random(5)
    for _ in range(60):
        words = ["".join(rng.choices("abc", k=rng.randint(2, rng.choice([4, 9, 400])))) for _ in range(rng.randint(1, 20))]
        counts = [rng.randint(1, 9) for _ in words]
        known, merges = "abc", []
        for new in "defghijkl":
            pair = rng.choice(known) + rng.choice(known)
            if pair not in dict(merges):
                merges.append((pair, new))
                known += new
        done, guess = merges[:4], merges[4:]
        spelled = list(words)
        for pair, new in done:
            spelled = [w.replace(pair, new) for w in spelled]
        before = pairs_of(spelled, counts)
        expected = {(-1, p): n for p, n in before.items()}
        for step, (pair, new) in enumerate(guess):
            spelled = [w.replace(pair, new) for w in spelled]
            found = pairs_of(spelled, counts)
            expected |= {(step, p): found[p] - before[p] for p in found | before if found[p] != before[p]}
            before = found
        batch = pd.DataFrame({"n": counts, "word": words})
        rows = pd.concat(bpe._trial([done], guess)(iter([batch[:5], batch[5:]])))
        assert dict(zip(zip(rows["step"], rows["pair"]), rows["count"])) == expected
        left = pd.concat(bpe._merged([done, guess])(iter([batch])))
        assert list(zip(left["n"], left["word"])) == [(n, w) for n, w in zip(counts, spelled) if len(w) > 1]


def pairs_of(words, counts):
    sums = Counter()
    for word, n in zip(words, counts):
        for pair in map(str.__add__, word, word[1:]):
            sums[pair] += n
    return sums


def test_words_are_cut_inside_rare_pairs():
    rng = random.Random(8)
    for _ in range(60):
        words = ["".join(rng.choices("abcd", k=rng.randint(2, rng.choice([4, 9, 300])))) for _ in range(rng.randint(1, 20))]
        counts = [rng.randint(1, 9) for _ in words]
        rounds = [[("ab", "x")], [("xc", "y"), ("dd", "z")]]
        kept = {a + b for a in "abcdxyz" for b in "abcdxyz" if rng.random() < 0.4} | {"aa"}
        expected = Counter()
        for word, n in zip(words, counts):
            for pair, new in sum(rounds, []):
                word = word.replace(pair, new)
            parts = word[0] + "".join(b if a + b in kept else f" {b}" for a, b in zip(word, word[1:]))
            for part in parts.split(" "):
                expected[part] += n * (len(part) > 1)
        batch = pd.DataFrame({"n": counts, "word": words})
        found = [row for part in bpe._cut(rounds, list(kept))(iter([batch[:3], batch[3:]])) for row in zip(part["word"], part["n"])]
        assert dict(found) == +expected and len(found) == len(dict(found))


# The bound on what is cut: about right, too high at once, and found by few merges ahead.
@pytest.mark.parametrize("ahead, below, kept", [(4_096, 0.75, 200_000), (4_096, 1.3, 200_000), (2, 0.9, 12)])
def test_cut_words_give_the_same_merges(spark, monkeypatch, ahead, below, kept):
    rng = random.Random(ahead + kept)
    parts = ["".join(rng.choices("abc", k=rng.randint(1, 4))) for _ in range(9)]
    rows = [(" ".join("".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(30)),) for _ in range(12)]
    texts = spark.createDataFrame(rows, "text string").coalesce(1)
    monkeypatch.setattr(bpe, "_TRIED", 9)
    monkeypatch.setattr(bpe, "_CUT_ROUNDS", 1)
    merges, there = {}, [a + b + c for a in "abc" for b in "abc" for c in ("", "a", "b</w>")]
    for cut in (True, False):
        with monkeypatch.context() as patch:
            cuts = []
            if cut:
                for name, value in (("_AHEAD", ahead), ("_CUT_BELOW", below), ("_KEPT", kept)):
                    patch.setattr(bpe, name, value)
                patch.setattr(bpe, "_parts", lambda *given, real=bpe._parts: cuts.append(1) or real(*given))
            else:
                patch.setattr(bpe, "_frequent", lambda pairs, least: ([], 0))
            # Some merges give a token that is there.
            trained = train_bpe(texts, vocab_size=90, special_tokens=(*SPECIAL_TOKENS, *there))
            merges[cut] = [tuple(r) for r in trained.merges.orderBy("rank").collect()]
            assert bool(cuts) == cut
    assert merges[True] == merges[False] and len(merges[True]) > 30
    assert 2 < len({new for *_, new in merges[True]} & set(there))


def test_later_rounds_go_over_parts_of_words(spark, documents, monkeypatch):
    symbols = []
    real = bpe._tried

    def tried_on(words, rounds, guess):
        symbols.append(words.agg({"n": "count"}).first()[0])
        return real(words, rounds, guess)

    monkeypatch.setattr(bpe, "_tried", tried_on)
    train_bpe(documents, BYTE_BPE, vocab_size=1_200)
    assert symbols[-1] < symbols[0] / 3


def test_guesses_hear_all_words_as_long_as_they_fit(spark, monkeypatch):
    words = spark.range(120_000).selectExpr("id % 7 + 1 as n", "concat('w', cast(id as string)) as word")
    assert len(bpe._forecast(words).counts) == 120_000
    monkeypatch.setattr(bpe, "_GUESS_SYMBOLS", 60_000)
    few = bpe._forecast(words).counts
    assert 4_000 < len(few) < 20_000 and abs(few.sum() / 480_000 - 1) < 0.1
