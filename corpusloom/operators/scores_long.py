"""Sampling and loss over scores in long form, rows ``(*key, token_id, score)``: no sequence has to fit in one row or task.

The same results as :mod:`corpusloom.operators.scores`, where each row holds a whole vocabulary. Totals are sums
that merge; places in the order of a sequence are found by histograms, each narrower than the one before. A token occurs
once in a sequence, in which null is a key like any other; rows with a null token or score are no candidates. Sums are added in
another order than there, so a running sum that equals its bound to the last bits may fall on its other side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusloom.functions.ordering import as_keys, unit_interval
from corpusloom.functions.scores import MIN_TEMPERATURE
from corpusloom.operators.ranking import join_null_safe
from corpusloom.operators.splits import SEED
from corpusloom.shared import through_table

# Scores are summed relative to a multiple of this, so that sums of different tasks merge and none overflows.
SPAN = 512
# Parts of a sequence in which the best are looked for first.
PARTS = 64
# Bins of a histogram; rows of a sequence that are few enough to be ordered as they are.
BINS, FEW = 256, 4_096
# Sequences whose totals or bounds are broadcast at most; beyond, the same join shuffles.
BROADCAST_KEYS = 500_000

_REAL = "score > double('-Infinity')"


def _scaled(df: DataFrame, keys: list[str], temperature: float) -> DataFrame:
    t = max(float(temperature), MIN_TEMPERATURE)
    rows = df.select(*keys, F.col("token_id").cast("int").alias("token_id"), (F.col("score").cast("double") / t).alias("score"))
    return rows.where("token_id is not null and score is not null")


def _join_state(rows: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with their sequence's state, a stored table with one row for each; the rows do not move if these are few."""
    few = state.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    return join_null_safe(rows, F.broadcast(state) if few else state, keys)


def log_totals(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``(*key, log_total)``: the logarithm of the sum of ``exp(score)``.

    Scores between two multiples of ``SPAN`` are summed relative to the lower one, before and after the shuffle; of these
    sums the highest and the one right below it tell the total, as others are too small to show.
    """
    base = F.floor(F.col("score") / SPAN)
    sums = rows.where(_REAL).groupBy(*keys, base.alias("_base")).agg(F.sum(F.exp(F.col("score") - base * SPAN)).alias("_sum"))
    # One row for each multiple that a sequence has scores at.
    down = Window.partitionBy(*keys).orderBy(F.desc("_base"))
    sums = sums.select("*", F.row_number().over(down).alias("_row"), F.lead("_base").over(down).alias("_next"), F.lead("_sum").over(down).alias("_low"))
    low = F.when(F.col("_next") == F.col("_base") - 1, F.col("_low") * F.exp(F.lit(-float(SPAN)))).otherwise(0.0)
    return sums.where("_row = 1").select(*keys, (F.col("_base") * SPAN + F.log(F.col("_sum") + low)).alias("log_total"))


def _with_probabilities(rows: DataFrame, keys: list[str]) -> DataFrame:
    totals = through_table(log_totals(rows, keys), "log-totals")
    prob = F.exp(F.col("score") - F.col("log_total"))
    return _join_state(rows, totals, keys).select(*keys, "token_id", "score", prob.alias("prob"))


def _top_k(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The ``k`` best of each part of a sequence, then of these the ``k`` best; the lower token id wins a tie."""
    order = [F.desc("score"), F.asc("token_id")]
    part = F.pmod(F.xxhash64("token_id"), F.lit(PARTS))
    first = Window.partitionBy(*keys, "_part").orderBy(*order)
    best = rows.withColumn("_part", part).withColumn("_row", F.row_number().over(first)).where(F.col("_row") <= k)
    return best.withColumn("_row", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_row") <= k).drop("_part", "_row")


def _picked(hit: Column, place: Column, of: Sequence[str]) -> list[Column]:
    """The first place with a hit, else the last one, as a struct with what belongs to it."""
    whole = F.struct(place.alias("place"), *of)
    return [F.min(F.when(hit, whole)).alias("_hit"), F.max(whole).alias("_last")]


def crossing(rows: DataFrame, targets: DataFrame, keys: list[str], reaches: bool) -> DataFrame:
    """``(*key, _score, _token)``: the token at which the running sum of ``prob``, best first, passes ``_target``.

    With ``reaches``, or is equal to it; the last token if none does. A histogram over the open range of scores of
    each sequence names the bin in which that happens, which is the next range, until ``FEW`` rows are left; among equal
    scores, the same over the token ids.
    """
    rows = rows.where(_REAL)
    bounds = rows.groupBy(*keys).agg(F.min("score").alias("_lo"), F.max("score").alias("_hi"), F.count(F.lit(1)).alias("_n"))
    state = join_null_safe(bounds, targets, keys).select(
        *keys, F.lit(False).alias("_tied"), F.lit(0.0).alias("_at"), "_lo", "_hi", F.lit(0.0).alias("_before"), "_n", "_target"
    )
    state = through_table(state, "crossing")
    place = F.when(F.col("_tied"), -F.col("token_id").cast("double")).otherwise(F.col("score"))
    inside = (~F.col("_tied") | (F.col("score") == F.col("_at"))) & F.col("_place").between(F.col("_lo"), F.col("_hi"))
    passes = F.col("_run") >= F.col("_target") if reaches else F.col("_run") > F.col("_target")
    kept = [*keys, "_tied", "_at", "_lo", "_hi", "_before", "_n", "_target"]
    is_open = (F.col("_n") > FEW) & ((F.col("_hi") > F.col("_lo")) | ~F.col("_tied"))
    while state.where(is_open).limit(1).count():
        # Equal scores: on to their token ids.
        equal = ~F.col("_tied") & (F.col("_hi") == F.col("_lo"))
        wide = state.where(is_open).select(
            *keys, (F.col("_tied") | equal).alias("_tied"), F.when(equal, F.col("_lo")).otherwise(F.col("_at")).alias("_at"),
            F.when(equal, F.lit(-float(1 << 31))).otherwise(F.col("_lo")).alias("_lo"),
            F.when(equal, F.lit(float(1 << 31))).otherwise(F.col("_hi")).alias("_hi"), "_before", "_n", "_target",
        )
        wide = through_table(wide, "crossing")
        within = _join_state(rows, wide, keys).withColumn("_place", place).where(inside)
        share = (F.col("_place") - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))
        # Bins from the best down.
        bin_ = F.lit(BINS - 1) - F.least(F.lit(BINS - 1), F.floor(share * BINS)).cast("int")
        of = [*keys, "_tied", "_at", "_before", "_target"]
        bins = within.withColumn("_bin", bin_).groupBy(*of, "_bin").agg(
            F.sum("prob").alias("_mass"), F.min("_place").alias("_lo"), F.max("_place").alias("_hi"), F.count(F.lit(1)).alias("_n")
        )
        # At most ``BINS`` rows for each sequence.
        best_first = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        bins = bins.withColumn("_run", F.col("_before") + F.sum("_mass").over(best_first))
        found = bins.groupBy(*of).agg(*_picked(passes, F.col("_bin"), ["_lo", "_hi", "_n", "_run", "_mass"]))
        found = found.withColumn("_p", F.coalesce("_hit", "_last"))
        narrow = found.select(
            *keys, "_tied", "_at", "_p._lo", "_p._hi", (F.col("_p._run") - F.col("_p._mass")).alias("_before"), "_p._n", "_target"
        )
        state = through_table(state.where(~is_open).select(kept).unionByName(narrow.select(kept)), "crossing")
    last = _join_state(rows, state, keys).withColumn("_place", place).where(inside)
    # At most ``FEW`` rows for each sequence.
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc("token_id")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = last.withColumn("_run", F.col("_before") + F.sum("prob").over(order))
    found = last.groupBy(*keys).agg(*_picked(passes, F.struct((-F.col("score")).alias("down"), "token_id"), []))
    at = F.coalesce("_hit", "_last").getField("place")
    return found.select(*keys, (-at["down"]).alias("_score"), at["token_id"].alias("_token"))


def _top_p(rows: DataFrame, keys: list[str], p: float) -> DataFrame:
    """The best until the mass before a token exceeds ``p``; at least one token."""
    rows = through_table(_with_probabilities(rows, keys), "probabilities")
    targets = rows.select(*keys).distinct().withColumn("_target", F.lit(float(p)))
    ends = through_table(crossing(rows, targets, keys, reaches=False), "ends")
    stays = (F.col("score") > F.col("_score")) | ((F.col("score") == F.col("_score")) & (F.col("token_id") <= F.col("_token")))
    return _join_state(rows, ends, keys).where(stays).select(*keys, "token_id", "score")


def _kept(df: DataFrame, keys: list[str], temperature: float, top_k: int | None, top_p: float | None) -> DataFrame:
    rows = _scaled(df, keys, temperature)
    if top_k is not None:
        rows = through_table(_top_k(rows, keys, top_k), "top-k")
    elif top_p is not None:
        rows = through_table(_top_p(rows, keys, top_p), "top-p")
    return _with_probabilities(rows, keys)


def candidates_long(
    df: DataFrame, key: str | Sequence[str], temperature: float = 1.0, top_k: int | None = None, top_p: float | None = None
) -> DataFrame:
    """Rows ``(*key, token_id, prob)`` of the tokens that can be drawn; see :func:`corpusloom.operators.scores.candidates`."""
    keys = as_keys(key)
    return _kept(df, keys, temperature, top_k, top_p).select(*keys, "token_id", "prob")


def seeded_draw_long(
    df: DataFrame, key: str | Sequence[str], temperature: float = 1.0, top_k: int | None = None, top_p: float | None = None,
    seed: object = SEED,
) -> DataFrame:
    """Rows ``(*key, token_id)``: one draw for each sequence, repeatable by the seed."""
    keys = as_keys(key)
    rows = through_table(_kept(df, keys, temperature, top_k, top_p), "probabilities")
    targets = rows.select(*keys).distinct().withColumn("_target", unit_interval(key, seed))
    if top_k is None and top_p is None:
        # Nothing was ordered by score: tokens follow one another by id.
        rows = rows.where(_REAL).withColumn("score", F.lit(0.0))
    return crossing(rows, targets, keys, reaches=True).select(*keys, F.col("_token").alias("token_id"))


def cross_entropy_long(df: DataFrame, targets: DataFrame, key: str | Sequence[str], target: str = "target", ignore_id: int | None = None) -> DataFrame:
    """Mean loss over all sequences of ``targets``, rows ``(*key, target)``; a target without a score is an error.

    Padding counts, unless ``ignore_id`` names it. Without sequences the loss is null.
    """
    keys = as_keys(key)
    wanted = targets.select(*keys, F.col(target).cast("int").alias("_target"))
    wanted = through_table(wanted if ignore_id is None else wanted.where(~F.col("_target").eqNullSafe(ignore_id)), "targets")
    rows = _scaled(df, keys, 1.0)
    # Only the rows of targets are brought together with them.
    mine = _join_state(rows, wanted, keys).where("token_id = _target").select(*keys, F.col("score").alias("_score"))
    both = join_null_safe(mine, log_totals(rows, keys), keys)
    loss = join_null_safe(wanted, both.select(*keys, (F.col("log_total") - F.col("_score")).alias("_loss")), keys, "left")
    no_token = F.raise_error(F.concat(F.lit("not a token: "), F.coalesce(F.col("_target").cast("string"), F.lit("null")))).cast("double")
    return loss.agg(F.avg(F.coalesce("_loss", no_token)).alias("loss"))
