import math
import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import scores, scores_long
from corpusloom.operators.scores_long import candidates_long, cross_entropy_long, log_totals, seeded_draw_long


def tables(spark, rows):
    """The same scores as arrays and in long form."""
    arrays = spark.createDataFrame(rows, "seq_id long, scores array<double>, target int")
    long = arrays.select("seq_id", F.posexplode("scores").alias("token_id", "score")).repartition(5)
    return arrays, long


def made(seed, n=30, width=40):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        size = rng.choice([1, 2, 5, width])
        spread = rng.choice([0.0, 1.0, 30.0, 3_000.0])
        values = [round(rng.uniform(-spread, spread), rng.choice([0, 1, 6])) for _ in range(size)]
        rows.append((i if i else None, values, rng.randrange(size)))
    return rows


def as_dict(df, digits=9):
    return {(r.seq_id, r.token_id): round(r.prob, digits) for r in df.collect()}


@pytest.mark.parametrize("few,bins", [(4_096, 256), (3, 4)])
@pytest.mark.parametrize("kept", [{}, {"top_k": 3}, {"top_p": 0.51}, {"top_p": 0.96, "temperature": 3.0}, {"top_k": 2, "top_p": 0.1}])
def test_equal_to_the_array_form(spark, monkeypatch, few, bins, kept):
    if few < 4_096 and "top_p" not in kept:
        pytest.skip("nothing is searched")
    monkeypatch.setattr(scores_long, "FEW", few)
    monkeypatch.setattr(scores_long, "BINS", bins)
    arrays, long = tables(spark, made(7, 12 if few < 4_096 else 30))
    assert as_dict(candidates_long(long, "seq_id", **kept)) == as_dict(scores.candidates(arrays, "seq_id", **kept))
    drawn = {(r.seq_id, r.token_id) for r in seeded_draw_long(long, "seq_id", **kept).collect()}
    assert drawn == {(r.seq_id, r.token_id) for r in scores.seeded_draw(arrays, "seq_id", **kept).collect()}


def test_one_long_sequence_with_many_equal_scores(spark, monkeypatch):
    monkeypatch.setattr(scores_long, "FEW", 50)
    monkeypatch.setattr(scores_long, "BROADCAST_KEYS", 0)
    values = [0.0] * 3_000 + [1.0] * 2_000 + [5.0]
    arrays, long = tables(spark, [(1, values, 3)])
    want = as_dict(scores.candidates(arrays, "seq_id", top_p=0.6))
    assert as_dict(candidates_long(long, "seq_id", top_p=0.6)) == want and 100 < len(want) < 5_000


def test_totals_merge_whatever_the_scale(spark):
    values = {1: [-1e6, -1e6 + 1], 2: [1e5, 1e5 - 800, 0.0], 3: [511.9, 512.1], 4: [float("-inf"), 2.0], 5: [-0.5]}
    _, long = tables(spark, [(i, v, 0) for i, v in values.items()])
    found = {r.seq_id: r.log_total for r in log_totals(long, ["seq_id"]).collect()}
    for i, v in values.items():
        top = max(v)
        assert math.isclose(found[i], top + math.log(sum(math.exp(x - top) for x in v)), rel_tol=1e-14)


def test_cross_entropy(spark):
    arrays, long = tables(spark, made(3))
    targets = arrays.select("seq_id", "target")
    for ignore in (None, 0):
        want = scores.cross_entropy(arrays, ignore_id=ignore).first().loss
        assert math.isclose(cross_entropy_long(long, targets, "seq_id", ignore_id=ignore).first().loss, want, rel_tol=1e-12)
    with pytest.raises(Exception, match="not a token: 99"):
        cross_entropy_long(long, targets.withColumn("target", F.lit(99)), "seq_id").collect()
    assert cross_entropy_long(long, targets.limit(0), "seq_id").first().loss is None


def test_null_scores_are_no_candidates_and_empty_tables_stay_empty(spark):
    long = spark.createDataFrame([(1, 0, None, 9), (1, 1, 2.0, 9), (1, None, 2.0, 9)], "seq_id long, token_id int, score double, prob int")
    assert as_dict(candidates_long(long, "seq_id", top_p=0.9)) == {(1, 1): 1.0}
    assert candidates_long(long.limit(0), "seq_id", top_p=0.9).count() == 0
    assert seeded_draw_long(long.limit(0), "seq_id").count() == 0
