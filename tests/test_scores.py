import math

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.losses import epoch_losses, running_loss, with_global_step
from corpusloom.operators.scores import candidates, cross_entropy, seeded_draw


def scores(spark, *rows):
    return spark.createDataFrame([(i, list(map(float, r))) for i, r in enumerate(rows)], "seq_id long, scores array<double>")


def kept(df):
    return {(r.seq_id, r.token_id): r.prob for r in df.collect()}


PROBS = [math.log(p) for p in (0.2, 0.5, 0.3)]


def test_softmax(spark):
    got = kept(candidates(scores(spark, PROBS, [1000.0, 1000.0]), "seq_id"))
    assert got == pytest.approx({(0, 0): 0.2, (0, 1): 0.5, (0, 2): 0.3, (1, 0): 0.5, (1, 1): 0.5})


def test_temperature_zero_is_clamped(spark):
    got = kept(candidates(scores(spark, [1.0, 2.0]), "seq_id", temperature=0))
    assert got == pytest.approx({(0, 0): 0.0, (0, 1): 1.0})


def test_top_p_keeps_the_token_that_crosses(spark):
    got = kept(candidates(scores(spark, PROBS), "seq_id", top_p=0.6))
    assert got == pytest.approx({(0, 1): 0.625, (0, 2): 0.375})
    assert set(kept(candidates(scores(spark, PROBS), "seq_id", top_p=0.0))) == {(0, 1)}
    assert len(kept(candidates(scores(spark, PROBS), "seq_id", top_p=1.0))) == 3


def test_top_k_wins_over_top_p(spark):
    assert kept(candidates(scores(spark, PROBS), "seq_id", top_k=1, top_p=0.9)) == {(0, 1): 1.0}
    assert len(kept(candidates(scores(spark, PROBS), "seq_id", top_k=50))) == 3


def test_lower_id_wins_a_tie(spark):
    assert set(kept(candidates(scores(spark, [1, 3, 3, 3]), "seq_id", top_k=2))) == {(0, 1), (0, 2)}


def test_draw_is_repeatable_and_follows_the_distribution(spark):
    many = spark.range(4000).select(F.col("id").alias("seq_id"), F.array(*map(F.lit, PROBS)).alias("scores"))
    drawn = seeded_draw(many, "seq_id", seed=4)
    shares = {r.token_id: r["count"] / 4000 for r in drawn.groupBy("token_id").count().collect()}
    assert shares == pytest.approx({0: 0.2, 1: 0.5, 2: 0.3}, abs=0.03)
    assert drawn.collect() == seeded_draw(many.repartition(3), "seq_id", seed=4).orderBy("seq_id").collect()
    assert {r.token_id for r in seeded_draw(many, "seq_id", top_k=1).collect()} == {1}


def test_cross_entropy_counts_padding_unless_told(spark):
    rows = scores(spark, PROBS, PROBS).withColumn("target", F.col("seq_id").cast("int"))
    assert cross_entropy(rows).first().loss == pytest.approx(-(math.log(0.2) + math.log(0.5)) / 2)
    assert cross_entropy(rows, ignore_id=0).first().loss == pytest.approx(-math.log(0.5))


def test_scores_stay_in_their_partition(spark):
    plan = candidates(scores(spark, PROBS), "seq_id", top_p=0.5)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


LOG = "run string, epoch int, split string, batch_num long, loss double"


def test_epoch_losses_are_means_of_batch_means(spark):
    log = spark.createDataFrame([("r", 1, "train", 1, 4.0), ("r", 1, "train", 2, 2.0), ("r", 1, "validation", 1, 5.0)], LOG)
    assert [tuple(r) for r in epoch_losses(log).collect()] == [("r", 1, 3.0, 5.0, 2.0)]


@pytest.mark.parametrize("chunk", [1, 3, 1000])
def test_running_loss(spark, chunk):
    log = spark.createDataFrame([("r", 1, "train", i, float(i * i)) for i in range(1, 12)], LOG)
    got = {r.batch_num: r.avg_so_far for r in running_loss(log, chunk).collect()}
    assert got == pytest.approx({i: sum(k * k for k in range(1, i + 1)) / i for i in range(1, 12)})


def test_global_step(spark):
    log = spark.createDataFrame([("r", 1, "train", 2, 0.0), ("r", 3, "train", 1, 0.0)], LOG)
    batches = spark.createDataFrame([("r", "train", 10)], "run string, split string, n_batches long")
    assert sorted(r.step for r in with_global_step(log, batches).collect()) == [2, 21]


def test_global_step_keeps_rows_without_batches(spark):
    log = spark.createDataFrame([("r", 1, "train", 2, 0.0), ("r", 1, "test", 1, 0.0), (None, 1, "train", 1, 0.0)], LOG)
    batches = spark.createDataFrame([("r", "train", 10)], "run string, split string, n_batches long")
    rows = with_global_step(log, batches).collect()
    assert sorted(((r.split, r.step) for r in rows), key=str) == [("test", None), ("train", 2), ("train", None)]


@pytest.mark.parametrize("target", [5, -1, None])
def test_a_target_that_is_no_token_is_an_error(spark, target):
    rows = spark.createDataFrame([(1, [0.1, 0.2], 0), (2, [0.1, 0.2], target)], "seq_id int, scores array<double>, target int")
    with pytest.raises(Exception, match="not a token"):
        cross_entropy(rows).collect()
