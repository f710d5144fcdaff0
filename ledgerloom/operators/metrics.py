"""Binary metrics, class report, baseline and comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.numeric import ratio_or_zero, round_even

# Names of the metrics, and the gains that count as modest and significant.
MODEST, SIGNIFICANT = 0, 0.05
METRICS = ("accuracy", "precision", "recall", "f1_score")


def confusion_counts(df: DataFrame, label: str = "true_label", prediction: str = "prediction") -> DataFrame:
    """Rows per (label, prediction): everything the metrics need."""
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _f1(precision: Column, recall: Column) -> Column:
    return ratio_or_zero(2 * precision * recall, precision + recall)


def binary_metrics(df: DataFrame, label: str = "true_label", prediction: str = "prediction") -> DataFrame:
    """Long form: accuracy, precision, recall and F1 of class 1; 0 where undefined."""
    y, p = F.col(label), F.col(prediction)
    counts = df.agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y != 1) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p != 1)).alias("fn"),
        F.count_if(y == p).alias("hits"),
        F.count(F.lit(1)).alias("n"),
    )
    scores = counts.select(
        ratio_or_zero(F.col("hits"), F.col("n")).alias("accuracy"),
        ratio_or_zero(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        ratio_or_zero(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
        ratio_or_zero(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1_score"),
    )
    return scores.unpivot([], list(METRICS), "metric", "score")


def class_report(df: DataFrame, label: str = "true_label", prediction: str = "prediction") -> DataFrame:
    """Per class precision, recall, F1 and support, then accuracy, macro and weighted averages.

    Works on the counts per (label, prediction), never again on the rows.
    """
    counts = confusion_counts(df, label, prediction)
    per_class = (
        counts.select(
            F.explode(
                F.array(
                    F.struct(F.col("label").alias("c"), F.col("n").alias("support"), F.lit(0).alias("predicted")),
                    F.struct(F.col("prediction").alias("c"), F.lit(0).alias("support"), F.col("n").alias("predicted")),
                )
            ).alias("s"),
            F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hits"),
        )
        .groupBy(F.col("s.c").alias("class"))
        .agg(
            F.sum("s.support").alias("support"),
            F.sum("s.predicted").alias("predicted"),
            # Each correct count is seen once as label and once as prediction.
            (F.sum("hits") / 2).alias("hits"),
        )
        .withColumn("precision", ratio_or_zero(F.col("hits"), F.col("predicted")))
        .withColumn("recall", ratio_or_zero(F.col("hits"), F.col("support")))
        .withColumn("f1_score", _f1(F.col("precision"), F.col("recall")))
    )
    scores = ("precision", "recall", "f1_score")
    rows = per_class.select(F.col("class").cast("string").alias("class"), *scores, "support")
    overall = per_class.agg(
        F.sum("support").alias("support"),
        ratio_or_zero(F.sum("hits"), F.sum("support")).alias("accuracy"),
        *[F.avg(s).alias(f"macro_{s}") for s in scores],
        *[ratio_or_zero(F.sum(F.col(s) * F.col("support")), F.sum("support")).alias(f"weighted_{s}") for s in scores],
    )
    nothing = F.lit(None).cast("double")
    lines = overall.select(
        F.inline(
            F.array(
                _line("accuracy", nothing, nothing, F.col("accuracy")),
                _line("macro avg", *[F.col(f"macro_{s}") for s in scores]),
                _line("weighted avg", *[F.col(f"weighted_{s}") for s in scores]),
            )
        )
    )
    return rows.unionByName(lines)


def _line(name: str, precision: Column, recall: Column, f1: Column) -> Column:
    return F.struct(
        F.lit(name).alias("class"),
        precision.alias("precision"),
        recall.alias("recall"),
        f1.alias("f1_score"),
        F.col("support").alias("support"),
    )


def majority_class(df: DataFrame, label: str = "target") -> DataFrame:
    """One row: the most frequent label, the smallest on a tie.

    Counts per label are combined before the shuffle; no list of labels is held.
    """
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    return counts.orderBy(F.desc("_n"), F.asc(label)).limit(1).select(F.col(label).alias("prediction"))


def predict_majority(df: DataFrame, label: str = "target") -> DataFrame:
    """Every row with the majority class as its prediction."""
    return df.withColumn("prediction", majority_class(df, label).scalar())


def compare_models(model: DataFrame, baseline: DataFrame) -> DataFrame:
    """Per metric: both scores, their difference, and the difference in percent of the baseline."""
    left = model.select("metric", F.col("score").alias("trained_model"))
    right = baseline.select("metric", F.col("score").alias("baseline"))
    gain = F.col("trained_model") - F.col("baseline")
    return left.join(right, "metric").select(
        "metric",
        "trained_model",
        "baseline",
        gain.alias("improvement"),
        round_even(F.try_divide(gain, F.col("baseline")) * 100, 2).alias("improvement_pct"),
    )


def metric_value(scores: DataFrame, metric: str) -> DataFrame:
    """The rows of one metric."""
    return scores.where(F.col("metric") == metric)


def verdict(comparison: DataFrame, metric: str = "f1_score") -> DataFrame:
    """Judgement on the gain of one metric: significant, modest, or similar."""
    gain = F.col("improvement")
    return metric_value(comparison, metric).select(
        "metric",
        "improvement",
        F.when(gain > SIGNIFICANT, F.lit("significant")).when(gain > MODEST, F.lit("modest")).otherwise(F.lit("similar")).alias("verdict"),
    )
