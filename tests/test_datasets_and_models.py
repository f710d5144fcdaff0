import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerloom.functions.hashing import seeded_hash
from ledgerloom.operators.datasets import (
    label_to_int,
    merge_sources,
    merge_summary,
    split_analysis,
    split_shares,
    split_statistics,
    statistics_totals,
    validate_dataset,
)
from ledgerloom.operators.metrics import (
    binary_metrics,
    class_report,
    compare_models,
    majority_class,
    metric_value,
    predict_majority,
    verdict,
)
from ledgerloom.operators.splitting import (
    group_split,
    content_key,
    number_rows,
    proportional_quota,
    random_split,
    sample_rows,
    shuffle_rows,
    stratified_split,
)
from ledgerloom.operators.text_model import classify, fit_classifier, model_inputs, tokenized_inputs
from ledgerloom.plans.code_data import evaluate, merge_and_split, train_classifier
from ledgerloom.sources.writers import load_model, write_predictions


def labelled(spark, n, positive, key="k"):
    return spark.range(n).select(F.col("id").alias(key), (F.col("id") < positive).cast("int").alias("target"))


def seeded_hash_order(key, seed=42):
    return F.shiftrightunsigned(seeded_hash(seed, F.col(key)), 1)


def sizes(df, *columns):
    return {tuple(r[c] for c in columns): r["count"] for r in df.groupBy(*columns).count().collect()}


# --- validation and merge ---


def test_validation(spark):
    good = spark.createDataFrame([("x", 1)], "func string, target int")
    assert validate_dataset(good) is True
    with pytest.raises(ValueError, match="Missing required column: target"):
        validate_dataset(good.drop("target"))
    with pytest.raises(ValueError, match="Dataset is empty"):
        validate_dataset(good.where("target = 0"))


def test_labels(spark):
    df = spark.createDataFrame([("1",), ("True",), (" false ",), ("0.0",), (None,)], "t string")
    assert [r[0] for r in df.select(label_to_int(F.col("t"))).collect()] == [1, 1, 0, 0, None]
    with pytest.raises(PySparkException, match="not a 0/1 label"):
        spark.createDataFrame([("2",)], "t string").select(label_to_int(F.col("t"))).collect()


def sources(spark):
    base = spark.createDataFrame([("a", 0, "x"), ("a", 0, "x"), ("b", 1, "y")], "func string, target int, other string")
    synthetic = spark.createDataFrame(
        [("c", 1, "synthetic_llm", 1), ("c", 1, "synthetic_llm", 2), ("p", 1, "synthetic_llm_failed", 3)],
        "func string, target int, source string, sample_id int",
    )
    return base, synthetic


def test_merge_is_a_bag_union_without_placeholders(spark):
    base, synthetic = sources(spark)
    merged = merge_sources(base, synthetic)
    assert merged.columns == ["func", "target", "source"]
    assert sizes(merged, "func", "source") == {("a", "codexglue"): 2, ("b", "codexglue"): 1, ("c", "synthetic_llm"): 2}
    assert tuple(merge_summary(merged).first()) == (5, 3, 2, 3, 2)
    assert merge_sources(base, synthetic, keep_failed=True).count() == 6
    for left, right in ((base.drop("func"), synthetic), (base, synthetic.drop("target"))):
        with pytest.raises(ValueError, match="missing required columns"):
            merge_sources(left, right)


def test_statistics(spark):
    df = spark.createDataFrame(
        [("train", "abc", 1, "synthetic_llm")] + [("train", "ab", 0, "codexglue")] * 15 + [("test", "x", 1, "synthetic_llm_failed")],
        "split string, func string, target int, source string",
    )
    stats = split_statistics(df)
    rows = {r["split"]: r for r in stats.collect()}
    # 1/16 = 0.0625 rounds half to even.
    assert tuple(rows["train"])[1:] == (16, 1, 15, 0.062, 1, 6.25)
    assert tuple(rows["test"])[1:] == (1, 1, 0, 1.0, 0, 0.0)
    assert tuple(statistics_totals(stats).first()) == (17, 1, 5.88, 16)
    shares = {r["split"]: tuple(r)[1:] for r in split_shares(stats).collect()}
    assert shares["train"] == (16, 94.1, 1, 6.2, 15)
    analysis = {r["split"]: tuple(r)[1:] for r in split_analysis(df).collect()}
    assert analysis["train"] == (16, 1, 15, 0.062, 2.06)


def test_statistics_of_nothing(spark):
    df = spark.createDataFrame([], "split string, func string, target int, source string")
    assert tuple(merge_summary(df.select("func", "target", "source")).first()) == (0, 0, 0, 0, 0)
    assert tuple(statistics_totals(split_statistics(df)).first()) == (0, 0, 0.0, 0)


# --- splits and samples ---


@pytest.mark.parametrize("seed", range(8))
def test_quota_properties(spark, seed):
    rng = random.Random(seed)
    counts = {c: rng.choice([0, 1, rng.randrange(50), rng.randrange(10**15)]) for c in range(rng.randint(1, 9))}
    total = sum(counts.values())
    draws = rng.choice([0, total, rng.randint(0, total)])
    df = spark.createDataFrame(list(counts.items()), "_class int, n long")
    quota = {r["_class"]: r.q for r in proportional_quota(df, F.lit(draws).cast("long")).collect()}
    assert sum(quota.values()) == draws
    assert all(0 <= quota[c] <= counts[c] for c in counts)
    assert all(abs(quota[c] * total - counts[c] * draws) < total for c in counts if total)


def test_stratified_sizes(spark):
    split = stratified_split(labelled(spark, 100, 30), "target", "k")
    assert sizes(split, "split", "target") == {
        ("train", 1): 24, ("train", 0): 56, ("validation", 1): 3, ("validation", 0): 7, ("test", 1): 3, ("test", 0): 7,
    }


@pytest.mark.parametrize("n, positive", [(1, 0), (2, 1), (7, 3), (101, 1), (10_007, 3_333)])
def test_split_is_exact_for_any_size(spark, n, positive):
    held = math.ceil(n * 0.2 - 1e-9)
    found = sizes(stratified_split(labelled(spark, n, positive), "target", "k"), "split")
    assert found.get(("train",), 0) == n - held
    assert found.get(("test",), 0) == math.ceil(held / 2)
    assert sum(found.values()) == n


def test_split_is_reproducible_and_ignores_order(spark):
    df = labelled(spark, 1000, 200)
    first = sorted(stratified_split(df, "target", "k").collect())
    assert first == sorted(stratified_split(df.orderBy(F.desc("k")).repartition(5), "target", "k").collect())
    assert first != sorted(stratified_split(df, "target", "k", seed=1).collect())


def test_split_handles_string_keys_and_missing_labels(spark):
    df = spark.range(50).select(
        F.concat(F.lit("key-"), "id").alias("k"), F.when(F.col("id") % 5 > 0, (F.col("id") % 2).cast("int")).alias("target")
    )
    split = stratified_split(df, "target", "k")
    assert sizes(split, "split") == {("train",): 40, ("validation",): 5, ("test",): 5}


def test_many_classes(spark):
    df = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") % 300).alias("target"))
    found = sizes(stratified_split(df, "target", "k"), "split", "target")
    assert {n for (split, _), n in found.items() if split == "train"} == {8}
    assert sum(n for (split, _), n in found.items() if split == "test") == 300


def test_thousands_of_classes(spark):
    df = spark.range(9000).select(F.col("id").alias("k"), (F.col("id") % 3000).alias("target"))
    found = sizes(stratified_split(df, "target", "k"), "split")
    assert found == {("train",): 7200, ("validation",): 900, ("test",): 900}


def test_rows_of_one_key_stay_together(spark):
    df = spark.range(100).select(F.lit("copy").alias("k"), F.lit(1).alias("target"))
    assert len(sizes(stratified_split(df, "target", "k"), "split")) == 1


def test_split_adds_no_shuffle_to_the_rows(spark):
    plan = stratified_split(labelled(spark, 100, 30), "target", "k")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SinglePartition" not in plan and "Window" not in plan


@pytest.mark.parametrize("n", [0, 1, 5, 999, 1000])
def test_random_split(spark, n):
    found = sizes(random_split(spark.range(n), "id"), "split")
    test = math.ceil(n * 0.2 - 1e-9)
    assert found.get(("test",), 0) == test and found.get(("train",), 0) == n - test


def test_group_split_keeps_groups_whole(spark):
    df = spark.range(5000).withColumn("g", F.col("id") % 500)
    split = group_split(df, "g")
    assert split.groupBy("g").agg(F.count_distinct("split").alias("n")).where("n > 1").count() == 0
    assert 0.1 < split.where("split = 'test'").count() / 5000 < 0.3


def test_samples(spark):
    df = spark.range(300)
    in_order = [r.id for r in df.orderBy(seeded_hash_order("id"), "id").collect()]
    for n in (0, 1, 20, 299, 300, 500):
        found = sample_rows(df.repartition(3), n, "id").collect()
        assert sorted(r.id for r in found) == sorted(in_order[:n])
    with pytest.raises(ValueError):
        sample_rows(df, -1, "id")


def test_split_equals_ranking_all_rows(spark):
    """The cut points against a plain rank over each class."""
    df = labelled(spark, 2_003, 777)
    rank = F.row_number().over(Window.partitionBy("target").orderBy(seeded_hash_order("k"), "k"))
    split = stratified_split(df, "target", "k").withColumn("r", rank).collect()
    names = ["train", "validation", "test"]
    for target in (0, 1):
        in_rank_order = [r["split"] for r in sorted((r for r in split if r.target == target), key=lambda r: r.r)]
        assert in_rank_order == sorted(in_rank_order, key=names.index)


def test_shuffle_keeps_all_rows(spark):
    ids = [r.id for r in shuffle_rows(spark.range(100), "id").collect()]
    assert sorted(ids) == list(range(100)) != ids
    assert ids == [r.id for r in shuffle_rows(spark.range(100).repartition(4), "id").collect()]


def test_numbering_is_dense_and_follows_the_shuffle(spark):
    numbered = number_rows(spark.range(200), "id")
    by_index = {r.sample_idx: r.id for r in numbered.collect()}
    in_order = [r.id for r in shuffle_rows(spark.range(200), "id").collect()]
    assert [by_index[i] for i in range(200)] == in_order and len(by_index) == 200
    assert by_index == {r.sample_idx: r.id for r in number_rows(spark.range(200).repartition(9), "id").collect()}


def test_content_keys_tell_copies_apart(spark):
    df = spark.range(1000).select(F.lit("copy").alias("func"), (F.col("id") % 2).alias("target")).repartition(4)
    keys = {r.row_key for r in content_key(df, ("func", "target")).collect()}
    assert len(keys) == 1000
    assert keys == {r.row_key for r in content_key(df.repartition(7), ("func", "target")).collect()}


def test_split_follows_content_and_seed(spark):
    """The same rows in another order, in other files and with copies come out the same."""
    base, synthetic = sources(spark)
    many = base.crossJoin(spark.range(7)).drop("id")
    first = sorted(merge_and_split(many, synthetic)[0].drop("row_key").collect(), key=repr)
    again = merge_and_split(many.repartition(5), synthetic.orderBy(F.desc("func")))[0].drop("row_key").collect()
    assert first == sorted(again, key=repr)


def test_merge_and_split_with_copies(spark):
    base, synthetic = sources(spark)
    many = base.crossJoin(spark.range(20)).drop("id")
    split, summary, stats, totals = merge_and_split(many, synthetic)
    assert summary.first().total_samples == split.count() == totals.first().total_samples == 62
    assert sum(r.total_samples for r in stats.collect()) == 62
    assert sizes(split, "split") == {("train",): 49, ("validation",): 6, ("test",): 7}


# --- metrics ---


def judged(spark, pairs):
    return spark.createDataFrame(pairs, "true_label int, prediction int")


def scores(df):
    return {r.metric: r.score for r in df.collect()}


def test_binary_metrics(spark):
    found = scores(binary_metrics(judged(spark, [(1, 1)] * 3 + [(0, 1)] + [(1, 0)] * 2 + [(0, 0)] * 4)))
    assert found == pytest.approx({"accuracy": 0.7, "precision": 0.75, "recall": 0.6, "f1_score": 2 / 3})


@pytest.mark.parametrize("pairs", [[(1, 0), (0, 0)], [(0, 0)], []])
def test_undefined_metrics_are_zero(spark, pairs):
    found = scores(binary_metrics(judged(spark, pairs)))
    assert found["precision"] == found["recall"] == found["f1_score"] == 0.0


def test_class_report_against_plain_counts(spark):
    rng = random.Random(4)
    pairs = [(rng.randrange(3), rng.choice([0, 0, 1, 3])) for _ in range(500)]
    report = {r["class"]: r for r in class_report(judged(spark, pairs)).collect()}
    lines = {}
    for c in range(4):
        hits = sum(y == p == c for y, p in pairs)
        predicted, support = sum(p == c for _, p in pairs), sum(y == c for y, _ in pairs)
        precision, recall = hits / predicted if predicted else 0.0, hits / support if support else 0.0
        f1 = 2 * precision * recall / (precision + recall) if precision + recall else 0.0
        lines[str(c)] = (precision, recall, f1, support)
        assert tuple(report[str(c)])[1:] == pytest.approx(lines[str(c)])
    for i, name in enumerate(("precision", "recall", "f1_score")):
        assert report["macro avg"][name] == pytest.approx(sum(v[i] for v in lines.values()) / 4)
        assert report["weighted avg"][name] == pytest.approx(sum(v[i] * v[3] for v in lines.values()) / 500)
    assert report["accuracy"].f1_score == pytest.approx(sum(y == p for y, p in pairs) / 500)


def test_majority_takes_the_smallest_on_a_tie(spark):
    df = spark.createDataFrame([(1,), (0,), (1,), (0,), (2,)], "target int")
    assert majority_class(df).first().prediction == 0
    assert {r.prediction for r in predict_majority(df).collect()} == {0}


def test_comparison_and_verdict(spark):
    def table(values):
        return spark.createDataFrame(list(values.items()), "metric string, score double")

    comparison = compare_models(table({"accuracy": 0.9, "f1_score": 0.5}), table({"accuracy": 0.8, "f1_score": 0.0}))
    rows = {r.metric: r for r in comparison.collect()}
    assert rows["accuracy"].improvement_pct == 12.5 and rows["f1_score"].improvement_pct is None
    assert metric_value(comparison, "accuracy").count() == 1
    for gain, word in ((0.0501, "significant"), (0.05, "modest"), (0.001, "modest"), (0.0, "similar"), (-0.1, "similar")):
        one = spark.createDataFrame([("f1_score", gain)], "metric string, improvement double")
        assert verdict(one).first().verdict == word


# --- text model ---


def test_tokenized_inputs(spark):
    df = spark.createDataFrame([("a b(c)\n", 1), ("x " * 600, 0), (None, 1), ("", 0)], "func string, target int")
    rows = tokenized_inputs(df).collect()
    assert all(len(r.input_ids) == len(r.attention_mask) == 512 for r in rows)
    assert [sum(r.attention_mask) for r in rows] == [5, 512, 0, 0]
    assert all((i == 0) == (m == 0) for r in rows for i, m in zip(r.input_ids, r.attention_mask))
    assert len(set(rows[1].input_ids)) == 1
    assert model_inputs(df).columns == ["input_ids", "attention_mask", "labels"]


def corpus(spark, n=120):
    rows = [(i, "def f():\n    return " + ("bug = None" if i % 3 == 0 else "ok + 1") + f"  # {i % 7}", int(i % 3 == 0)) for i in range(n)]
    return spark.createDataFrame(rows, "k long, func string, target int")


def test_classifier_learns_saves_and_evaluates(spark, tmp_path):
    split = stratified_split(corpus(spark), "target", "k")
    train_classifier(split, f"{tmp_path}/model")
    model = load_model(f"{tmp_path}/model")
    test = split.where("split = 'test'")
    scored = classify(test, model)
    assert set(scored.columns) == {*test.columns, "prediction", "probability"}
    assert scored.where("prediction = target").count() == test.count()
    trained, baseline, comparison, judgement = evaluate(test, f"{tmp_path}/model", f"{tmp_path}/ck", "k", sample=10)
    assert scores(trained)["f1_score"] == 1.0 and scores(baseline)["f1_score"] == 0.0
    assert comparison.count() == 4 and judgement.first().verdict == "significant"
    assert spark.read.parquet(f"{tmp_path}/ck").select("batch_num").distinct().count() == 2


def test_classifier_on_missing_text(spark):
    df = corpus(spark, 30)
    model = fit_classifier(df, df, regularizations=(0.1,), iterations=5)
    row = classify(spark.createDataFrame([(None, 1)], "func string, target int"), model).first()
    assert row.func is None and row.prediction in (0, 1)


def test_predictions_resume(spark, tmp_path):
    df, path, seen = corpus(spark, 23), f"{tmp_path}/p", []

    def predict(rows, limit=None):
        rows = rows if limit is None else rows.where(F.col("sample_idx") < limit)
        seen.append(rows.count())
        return rows.withColumn("prediction", F.col("target"))

    write_predictions(df, lambda r: predict(r, 7), path, "k")
    done = write_predictions(df, predict, path, "k")
    write_predictions(df, predict, path, "k")
    assert seen == [7, 16, 0]
    rows = done.collect()
    assert sorted(r.sample_idx for r in rows) == list(range(23))
    assert all(r.batch_num == r.sample_idx // 5 + 1 and r.prediction == r.true_label for r in rows)
