import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.deep_forest import DeepForest, _shares, fit_deep_forest, grow
from ledgerloom.operators.scoring import fit_forest, score_rows

NAMES = ("feature", "threshold", "below", "above", "share", "levels", "mixed")


def stripes(spark, n=1500):
    """A label that changes 60 times along one feature, beside two that tell nothing."""
    x = F.xxhash64("id", F.lit(1))
    return spark.range(n).select(
        "id", (F.pmod(x, F.lit(60_000)) / 1000).alias("a"), (F.pmod(F.xxhash64("id", F.lit(2)), F.lit(100)) / 1.0).alias("b"),
        F.pmod(F.xxhash64("id", F.lit(3)), F.lit(3)).cast("double").alias("c"),
        (F.floor(F.pmod(x, F.lit(60_000)) / 1000) % 2 == 1).alias("is_fraud"),
    )


def accuracy(scored):
    return scored.agg(F.avg((F.col("fraud_predicted") == F.col("is_fraud")).cast("int"))).first()[0]


def test_a_grown_tree_tells_all_rows_apart():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 9, (400, 3)).astype(float)
    y = rng.integers(0, 2, 400).astype(float)
    weight = rng.integers(1, 4, 400).astype(float)
    tree = dict(zip(NAMES, grow(x, y, weight, rng), strict=True))
    got = _shares(x, tree)
    for row in np.unique(x, axis=0):
        same = (x == row).all(axis=1)
        assert np.allclose(got[same], (weight * y)[same].sum() / weight[same].sum())
    assert tree["mixed"] == sum(len(set(y[(x == row).all(axis=1)])) > 1 for row in np.unique(x, axis=0))


def test_awkward_nodes():
    one = grow(np.ones((3, 2)), np.array([0.0, 1, 1]), np.ones(3), np.random.default_rng(0))
    assert one[0] == [-1] and one[4] == [2 / 3] and one[6] == 1
    close = np.array([[1.0], [np.nextafter(1.0, 2)]])  # no number lies between
    tree = dict(zip(NAMES, grow(close, np.array([0.0, 1]), np.ones(2), np.random.default_rng(0)), strict=True))
    assert _shares(close, tree).tolist() == [0, 1]


@pytest.mark.parametrize("node_rows", [10_000, 300])
def test_deep_trees_beat_ten_levels(spark, tmp_path, node_rows):
    rows, columns = stripes(spark), ("a", "b", "c")
    held_out = F.col("id") % 5 == 0
    deep = fit_deep_forest(rows.where(~held_out), trees=12, columns=columns, node_rows=node_rows)
    deep.save(str(tmp_path))
    scored = DeepForest.load(spark, str(tmp_path), columns).score(rows, threshold=0.5)
    assert deep.nodes.agg(F.max("levels")).first()[0] > 5
    assert scored.count() == rows.count() and scored.where("fraud_score < 0 OR fraud_score > 1").count() == 0
    shallow = score_rows(rows, fit_forest(rows.where(~held_out), trees=12, columns=columns), threshold=0.5, columns=columns)
    assert accuracy(scored.where(held_out)) > accuracy(shallow.where(held_out))


def test_one_class_only(spark):
    rows = stripes(spark, 50).withColumn("is_fraud", F.lit(True))
    scored = fit_deep_forest(rows, trees=3, columns=("a", "b")).score(rows)
    assert [r["fraud_score"] for r in scored.collect()] == [1.0] * 50


def test_nodes_within_a_bin_are_bounded(spark):
    """With 32 bins leaves would have a hundred rows and more, whatever the levels, and Spark would be asked for 30 of them."""
    rows = spark.range(4000).select("id", F.rand(1).alias("a"), (F.rand(2) > 0.5).alias("is_fraud"))
    forest = fit_deep_forest(rows, trees=2, columns=("a",), node_rows=50)
    top = forest.top.stages[-1]
    assert top.getMaxBins() == 160 and top.getMaxDepth() < 30
