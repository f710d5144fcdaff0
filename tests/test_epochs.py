import math
import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from ledgerloom.operators.epochs import _dealt, fit_epochs, margins, steps

SHAPE = "id long, func string, target int"


def samples(spark, seed, n=400):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        target = int(rng.random() < 0.3)
        words = [rng.choice(["alpha", "beta", "gamma", "delta"] + (["bug"] * 2 if target else ["fine"] * 2)) for _ in range(rng.randint(0, 12))]
        rows.append((i, " ".join(words) if i % 50 else None, target))
    rows.append((n, "no label", None))
    return spark.createDataFrame(rows, SHAPE)


def losses(model):
    return {r["epoch"]: round(r["loss"], 9) for r in model.losses.collect()}


def test_a_resumed_run_equals_an_unbroken_one(spark, tmp_path):
    train, validation = samples(spark, 1), samples(spark, 2, 150)
    options = {"part_rows": 150, "buckets": 1 << 10, "batch": 16}
    whole = fit_epochs(train, validation, str(tmp_path / "a"), 4, **options)
    fit_epochs(train, validation, str(tmp_path / "b"), 2, **options)
    resumed = fit_epochs(train.repartition(5), validation, str(tmp_path / "b"), 4, **options)
    assert losses(whole) == losses(resumed) and whole.epoch == resumed.epoch > 0
    assert np.allclose(whole.weights, resumed.weights, atol=1e-12)
    assert losses(whole)[whole.epoch] == min(losses(whole).values()) < losses(whole)[0]
    scored = whole.classify(samples(spark, 3).where("target IS NOT NULL"))
    right = scored.selectExpr("avg(int(prediction = target)) AS a", "avg(target) AS t").first()
    assert right["a"] > max(1 - right["t"], 0.85) and scored.where("probability < 0 OR probability > 1").count() == 0


def test_the_best_epoch_may_be_none(spark, tmp_path):
    """Validation rows that say the opposite: the shares alone are best."""
    train = samples(spark, 1, 120)
    model = fit_epochs(train, train.selectExpr("id", "func", "1 - target AS target"), str(tmp_path), 2, buckets=64, rate=50.0)
    assert model.epoch == 0 and set(losses(model)) == {0, 1, 2}
    assert model.classify(train).selectExpr("count(DISTINCT round(probability, 9))").first()[0] == 1
    with pytest.raises(ValueError):
        fit_epochs(train.where("id < 0"), train, str(tmp_path / "none"))


def test_steps_follow_the_gradient():
    rng = np.random.default_rng(0)
    places = [rng.integers(0, 8, n) for n in (3, 0, 5, 1)]
    target, weights = np.array([1, 0, 0, 1]), rng.normal(size=9)

    def loss(w):
        return np.mean([math.log1p(math.exp(-m if t else m)) for m, t in zip(margins(places, w), target, strict=True)])

    after = weights.copy()
    steps(places, target, after, 1.0, 4)
    for i in range(9):
        nudge = np.zeros(9)
        nudge[i] = 1e-6
        assert weights[i] - after[i] == pytest.approx((loss(weights + nudge) - loss(weights - nudge)) / 2e-6, abs=1e-7)


def test_each_part_is_a_task(spark):
    rows = spark.range(700).select((F.col("id") % 7).cast("int").alias("_part"), F.array(F.lit(1)).alias("_places"))
    found = _dealt(rows, 7).groupBy(F.spark_partition_id().alias("task")).agg(F.count_distinct("_part").alias("parts"), F.count("*").alias("n"))
    assert sorted((r["task"], r["parts"], r["n"]) for r in found.collect()) == [(k, 1, 100) for k in range(7)]
