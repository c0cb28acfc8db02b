"""Sampling and loss over a table of scores ``(*, scores array<double>)``.

Each row holds all scores of one position, so nothing here is shuffled before
the final average.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.functions.ordering import as_keys, unit_interval
from corpusloom.functions.scores import (
    as_candidates,
    draw,
    keep_top_k,
    keep_top_p,
    negative_log_likelihood,
    scaled,
    with_probabilities,
)
from corpusloom.operators.splits import SEED


def _kept(temperature: float, top_k: int | None, top_p: float | None) -> Column:
    candidates = as_candidates(scaled(F.col("scores"), temperature))
    if top_k is not None:
        return with_probabilities(keep_top_k(candidates, top_k))
    if top_p is not None:
        return with_probabilities(keep_top_p(candidates, top_p))
    return with_probabilities(candidates)


def candidates(
    df: DataFrame,
    key: str | Sequence[str],
    temperature: float = 1.0,
    top_k: int | None = None,
    top_p: float | None = None,
) -> DataFrame:
    """Rows ``(*key, token_id, prob)`` of the tokens that can be drawn.

    ``top_k`` wins over ``top_p``; with neither, all tokens. The lower token id
    wins a tie. The temperature is at least 1e-5.
    """
    kept = df.select(*as_keys(key), F.explode(_kept(temperature, top_k, top_p)).alias("c"))
    return kept.select(*as_keys(key), "c.token_id", "c.prob")


def seeded_draw(
    df: DataFrame,
    key: str | Sequence[str],
    temperature: float = 1.0,
    top_k: int | None = None,
    top_p: float | None = None,
    seed: object = SEED,
) -> DataFrame:
    """Rows ``(*key, token_id)``: one draw for each row, repeatable by the seed."""
    drawn = draw(_kept(temperature, top_k, top_p), unit_interval(key, seed))
    return df.select(*as_keys(key), drawn.alias("token_id"))


def cross_entropy(df: DataFrame, target: str = "target", ignore_id: int | None = None) -> DataFrame:
    """Mean loss over all positions. Padding counts, unless ``ignore_id`` names it."""
    counted = df if ignore_id is None else df.where(F.col(target) != ignore_id)
    return counted.agg(F.avg(negative_log_likelihood(F.col("scores"), F.col(target))).alias("loss"))


