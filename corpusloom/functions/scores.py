"""Distributions over a vocabulary, one row of scores at a time.

A candidate is ``struct(token_id, score, prob)``. Everything stays inside the
row, so no score leaves its partition.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from corpusloom.functions.binding import once

# Fixed value: the least temperature.
MIN_TEMPERATURE = 1e-5


def scaled(scores: Column, temperature: float = 1.0) -> Column:
    """Scores divided by the temperature, as doubles."""
    t = max(float(temperature), MIN_TEMPERATURE)
    return F.transform(scores, lambda s: s.cast("double") / F.lit(t))


def as_candidates(scores: Column) -> Column:
    return F.transform(
        scores, lambda s, i: F.struct(i.cast("int").alias("token_id"), s.alias("score"))
    )


def best_first(candidates: Column) -> Column:
    """Highest score first; the lower token id wins a tie."""
    keyed = F.transform(
        candidates,
        lambda c: F.struct((-c["score"]).alias("down"), c["token_id"].alias("token_id")),
    )
    return F.transform(
        F.array_sort(keyed),
        lambda k: F.struct(k["token_id"].alias("token_id"), (-k["down"]).alias("score")),
    )


def _weights_total(candidates: Column, top: Column) -> Column:
    return F.aggregate(
        candidates, F.lit(0.0), lambda acc, c: acc + F.exp(c["score"] - top)
    )


def _softmax(candidates: Column) -> Column:
    def share(c: Column, top: Column, total: Column) -> Column:
        return F.struct(
            c["token_id"].alias("token_id"),
            c["score"].alias("score"),
            (F.exp(c["score"] - top) / total).alias("prob"),
        )

    top = F.array_max(F.transform(candidates, lambda c: c["score"]))
    return once(
        top,
        lambda t: once(
            _weights_total(candidates, t),
            lambda total: F.transform(candidates, lambda c: share(c, t, total)),
        ),
    )


def with_probabilities(candidates: Column) -> Column:
    """Softmax over the candidates at hand."""
    return once(candidates, _softmax)


def keep_top_k(candidates: Column, k: int) -> Column:
    """The ``k`` best, or all if there are fewer; probabilities over these only."""
    return F.slice(best_first(candidates), 1, k)


def keep_top_p(candidates: Column, p: float) -> Column:
    """The best until the mass before a token exceeds ``p``; at least one token."""
    start = F.struct(F.lit(0.0).alias("mass"), F.lit(0).alias("kept"))

    def count_in(acc: Column, c: Column) -> Column:
        wider = F.struct((acc["mass"] + c["prob"]).alias("mass"), (acc["kept"] + 1).alias("kept"))
        return F.when((acc["kept"] == 0) | (acc["mass"] <= p), wider).otherwise(acc)

    def head(ranked: Column) -> Column:
        kept = F.slice(ranked, F.lit(1), F.aggregate(ranked, start, count_in)["kept"])
        return F.transform(kept, lambda c: F.struct(c["token_id"], c["score"]))

    return once(with_probabilities(best_first(candidates)), head)


def draw(candidates: Column, u: Column) -> Column:
    """First token whose running mass reaches ``u``; the last one if rounding leaves a gap."""
    start = F.struct(F.lit(0.0).alias("mass"), F.lit(None).cast("int").alias("token_id"))

    def step(acc: Column, c: Column) -> Column:
        mass = acc["mass"] + c["prob"]
        here = F.when(acc["token_id"].isNull() & (mass >= u), c["token_id"])
        return F.struct(
            mass.alias("mass"), F.coalesce(acc["token_id"], here).alias("token_id")
        )

    def pick(given: Column) -> Column:
        return F.coalesce(
            F.aggregate(given, start, step)["token_id"], F.element_at(given, -1)["token_id"]
        )

    return once(candidates, pick)


def negative_log_likelihood(scores: Column, target: Column) -> Column:
    """``logsumexp(scores) - scores[target]`` for one position; a target that is no token is an error."""

    def loss(given: Column) -> Column:
        return once(
            F.array_max(given),
            lambda top: top
            + F.log(F.aggregate(given, F.lit(0.0), lambda acc, s: acc + F.exp(s - top)))
            - F.when((target >= 0) & (target < F.size(given)), F.get(given, target)).otherwise(
                F.raise_error(F.concat(F.lit("not a token: "), F.coalesce(target.cast("string"), F.lit("null")))).cast("double")
            ),
        )

    return once(scaled(scores), loss)
