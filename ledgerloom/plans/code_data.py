"""Jobs over labelled code: analyse, plan, filter, merge and split, train, evaluate."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.datasets import (
    analysis_totals,
    merge_sources,
    merge_summary,
    split_analysis,
    split_statistics,
    statistics_totals,
)
from ledgerloom.operators.generation import collect_samples, sample_plan
from ledgerloom.operators.metrics import binary_metrics, compare_models, predict_majority, verdict
from ledgerloom.operators.quality import code_statistics, keep_passing, quality_flags, quality_report
from ledgerloom.operators.splitting import content_key, sample_rows, stratified_split
from ledgerloom.operators.text_model import classify, fit_classifier
from ledgerloom.session import materialize
from ledgerloom.sources.readers import read_dataset, read_splits, read_synthetic_batches
from ledgerloom.sources.writers import (
    load_model,
    save_model,
    write_batches,
    write_csv,
    write_predictions,
    write_splits,
    write_table,
)


def analyse(spark: SparkSession, paths: dict[str, str], base_dir: str, report_path: str, fmt: str = "parquet"):
    """Load and validate the splits, save them, and report on what was saved."""
    write_splits(read_dataset(spark, paths, fmt).select("func", "target", "split"), base_dir)
    report = materialize(split_analysis(read_splits(spark, base_dir)), "report")
    write_csv(report, report_path)
    return report, analysis_totals(report)


def ingest_responses(
    spark: SparkSession, responses: DataFrame, out_dir: str, batches: int = 5, samples_per_batch: int = 10, fmt: str = "parquet"
) -> DataFrame:
    """Write the samples of a plan, one batch directory each."""
    samples = collect_samples(sample_plan(spark, batches, samples_per_batch), responses).drop("needs_retry")
    write_batches(samples, out_dir, fmt=fmt)
    return samples


def filter_samples(spark: SparkSession, batch_dir: str, filtered_path: str, report_path: str, fmt: str = "parquet"):
    """Flag all samples once, keep the passing ones, and report on all.

    The flagged table is written once: the parser runs over every sample a single time, though
    both the kept rows and the report need it.
    """
    flagged = materialize(quality_flags(read_synthetic_batches(spark, batch_dir, fmt)), "flagged")
    kept = keep_passing(flagged)
    write_table(kept, filtered_path, fmt)
    report = quality_report(flagged)
    write_csv(report, report_path)
    return kept, report, code_statistics(flagged)


def merge_and_split(
    base: DataFrame, synthetic: DataFrame, key: str | None = None, seed: int = 42, keep_failed: bool = False
):
    """Merged table with ``split``, its summary, statistics per split, and overall statistics.

    Without a unique ``key`` rows are known by what they hold, so the same rows with the same
    seed are split the same way, wherever they were read from. The keyed rows are written once.
    """
    merged = merge_sources(base, synthetic, keep_failed=keep_failed)
    if key is None:
        table = materialize(content_key(merged, ("func", "target", "source")), "merged")
    else:
        table = merged
    split = stratified_split(table, "target", key or "row_key", seed=seed)
    stats = split_statistics(split)
    return split, merge_summary(table), stats, statistics_totals(stats)


def train_classifier(split: DataFrame, model_path: str) -> PipelineModel:
    """Fit on the train split, choose on the validation split, save."""
    model = fit_classifier(
        split.where(F.col("split") == "train"), split.where(F.col("split") == "validation")
    )
    save_model(model, model_path)
    return model


def evaluate(
    test: DataFrame,
    model_path: str,
    checkpoint_path: str,
    key: str,
    sample: int | None = 20,
    batch_size: int = 5,
    seed: int = 42,
):
    """Model and majority baseline on the same seeded sample: both scores, comparison, verdict."""
    rows = test if sample is None else sample_rows(test, sample, key, seed)
    model = load_model(model_path)
    predictions = write_predictions(
        rows, lambda df: classify(df, model), checkpoint_path, key, batch_size=batch_size, seed=seed
    )
    trained = binary_metrics(predictions)
    baseline = binary_metrics(predict_majority(rows.select("target")), label="target")
    comparison = compare_models(trained, baseline)
    return trained, baseline, comparison, verdict(comparison)
