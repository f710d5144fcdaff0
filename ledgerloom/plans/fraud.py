"""Batch jobs over transactions: train a scorer, and score, route and write."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.times import iso_instant
from ledgerloom.operators.datasets import label_rate
from ledgerloom.operators.metrics import class_report
from ledgerloom.operators.parsing import DEAD_LETTER, VALID, parse_transactions
from ledgerloom.operators.scoring import THRESHOLD, fill_features, fit_forest, score_rows, with_route
from ledgerloom.operators.sessions import (
    SESSION_FEATURES,
    SESSION_GAP_SECONDS,
    EventColumns,
    enrich_with_sessions,
    enrich_with_user_features,
    user_features,
)
from ledgerloom.operators.splitting import group_split, random_split
from ledgerloom.session import empty_path, materialize, scratch_path
from ledgerloom.sources.readers import read_lines, read_transactions
from ledgerloom.sources.writers import json_rows, save_model, write_text_branches

DEAD_LETTERS = "dead_letters"


@dataclass
class Training:
    """Outcome of a training run."""

    model: PipelineModel
    report: DataFrame
    label_rate: DataFrame


def training_rows(transactions: DataFrame, grain: str = "session", cols: EventColumns = EventColumns()) -> DataFrame:
    """Rows with features over their session, as served, or over all rows of their user."""
    if grain == "session":
        return enrich_with_sessions(transactions, cols)
    if grain == "user":
        return enrich_with_user_features(transactions, user_features(transactions, cols), cols.key)
    raise ValueError("grain must be 'session' or 'user'")


def train(
    transactions: DataFrame,
    label: str = "is_fraud",
    grain: str = "session",
    by_user: bool = False,
    cols: EventColumns = EventColumns(),
    trees: int = 100,
    depth: int = 10,
    seed: int = 42,
) -> Training:
    """Fit on 80 % of the rows and report on the rest.

    Trees stop at ``depth`` 10: Spark grows trees by level, and what lies deeper hardly differs for ten features.

    ``by_user`` keeps all rows of a user on one side. The feature table is written once, since
    the split and every level of the trees read it again.
    """
    rows = materialize(training_rows(transactions, grain, cols), "training")
    if by_user:
        parts = group_split(rows, cols.key, seed)
    else:
        parts = random_split(rows, cols.row_id, seed)
    fit_on = parts.where(F.col("split") == "train").drop("split")
    test = parts.where((F.col("split") == "test") & F.col(label).isNotNull()).drop("split")
    model = fit_forest(fit_on, label, trees, depth, seed)
    predicted = model.transform(fill_features(test)).select(
        F.col(label).cast("int").alias("true_label"), F.col("_prediction").cast("int").alias("prediction")
    )
    return Training(model, class_report(predicted), label_rate(rows, label))


def run_training(spark: SparkSession, path: str, model_path: str, **options) -> Training:
    """Train from a JSON-lines file and save the model."""
    typed = read_transactions(spark, path).withColumn("event_time", iso_instant(F.col("timestamp")))
    # Written once: sessions, the rows they go back to and the changes of location each read it.
    transactions = materialize(typed, "typed")
    result = train(transactions, **options)
    save_model(result.model, model_path)
    return result


def parse_to_table(lines: DataFrame, path: str) -> DataFrame:
    """Parse once into a table with one directory per ``parse_status``.

    All later steps read columns of it: the text is neither read nor parsed again.
    """
    parsed = parse_transactions(lines)
    # The raw line is only needed where it is the payload.
    raw = F.when(F.col("parse_status") != VALID, F.col("value"))
    parsed.withColumn("value", raw).write.mode("overwrite").partitionBy("parse_status").parquet(path)
    return lines.sparkSession.read.schema(parsed.schema).parquet(path)


def routed_lines(transactions: DataFrame, model: PipelineModel, threshold: float = THRESHOLD) -> DataFrame:
    """Transactions with features as JSON lines, and the branch each belongs to."""
    scored = with_route(score_rows(transactions, model, threshold))
    added = [*SESSION_FEATURES, "fraud_score", "fraud_predicted"]
    return json_rows(scored.select("members", *added, "route"), keep=["route"])


def score_and_route(
    transactions: DataFrame,
    model: PipelineModel,
    gap_seconds: float = SESSION_GAP_SECONDS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Sessions, features, score and route of parsed transactions, as JSON lines."""
    return routed_lines(enrich_with_sessions(transactions, gap_seconds=gap_seconds), model, threshold)


def run_batch(
    spark: SparkSession,
    input_path: str,
    model: PipelineModel,
    output_path: str,
    gap_seconds: float = SESSION_GAP_SECONDS,
    threshold: float = THRESHOLD,
) -> None:
    """Parse, sessionise, score and write the branches flagged, clean and dead_letters."""
    staging = scratch_path(spark, "parsed")
    parsed = parse_to_table(read_lines(spark, input_path), staging)
    valid = parsed.where(F.col("parse_status") == VALID).drop("value", "parse_status", "reason")
    dead = parsed.where(F.col("parse_status") == DEAD_LETTER).select(
        "value", F.lit(DEAD_LETTERS).alias("route")
    )
    scored = score_and_route(valid, model, gap_seconds, threshold)
    write_text_branches(scored.unionByName(dead), output_path)
    empty_path(spark, staging)
