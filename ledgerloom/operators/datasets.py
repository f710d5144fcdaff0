"""Validation, merging and description of labelled code tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.numeric import percent_or_zero, ratio_or_zero, round_even
from ledgerloom.functions.text import code_length
from ledgerloom.operators.generation import SOURCE_FAILED, SOURCE_OK

# Name of the base source, and the columns every data set has.
BASE_SOURCE = "codexglue"
REQUIRED_COLUMNS = ("func", "target")

# The messages of refused data sets.
MISSING_COLUMN = "Missing required column: {column}"
EMPTY = "Dataset is empty"
MISSING_COLUMNS = "{name} dataset missing required columns: func, target"


def validate_dataset(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> bool:
    """Raise ``ValueError`` on a missing column or an empty table."""
    for column in required:
        if column not in df.columns:
            raise ValueError(MISSING_COLUMN.format(column=column))
    if df.isEmpty():
        raise ValueError(EMPTY)
    return True


def label_to_int(label: Column) -> Column:
    """0 or 1 from ``0/1/true/false`` in any case or numeric form; anything else raises."""
    text = F.lower(F.trim(label.cast("string")))
    return (
        F.when(text.isin("1", "1.0", "true"), F.lit(1))
        .when(text.isin("0", "0.0", "false"), F.lit(0))
        .when(label.isNotNull(), F.raise_error(F.concat(F.lit("not a 0/1 label: "), text)).cast("int"))
    )


def merge_sources(
    base: DataFrame, synthetic: DataFrame, base_source: str = BASE_SOURCE, keep_failed: bool = False
) -> DataFrame:
    """Bag union of base and synthetic samples on ``func, target, source``.

    Placeholders of failed generations are dropped unless ``keep_failed``.
    """
    for name, df in (("Base", base), ("Synthetic", synthetic)):
        if any(c not in df.columns for c in REQUIRED_COLUMNS):
            raise ValueError(MISSING_COLUMNS.format(name=name))
    if not keep_failed:
        synthetic = synthetic.where(~F.col("source").eqNullSafe(F.lit(SOURCE_FAILED)))
    left = base.select("func", "target").withColumn("source", F.lit(base_source))
    return left.unionByName(synthetic.select("func", "target", "source"))


def merge_summary(merged: DataFrame, base_source: str = BASE_SOURCE) -> DataFrame:
    """One row: total, base, synthetic, buggy and clean samples."""
    return merged.agg(
        F.count(F.lit(1)).alias("total_samples"),
        F.count_if(F.col("source") == base_source).alias("base_samples"),
        F.count_if(F.col("source") != base_source).alias("synthetic_samples"),
        _total("target").alias("buggy_samples"),
    ).withColumn("clean_samples", F.col("total_samples") - F.col("buggy_samples"))


def _total(column: str) -> Column:
    return F.coalesce(F.sum(F.col(column).cast("long")), F.lit(0).cast("long"))


def split_analysis(df: DataFrame) -> DataFrame:
    """Per split: rows, buggy, clean, balance ratio and mean code length."""
    return (
        df.groupBy("split")
        .agg(
            F.count(F.lit(1)).alias("total_samples"),
            _total("target").alias("buggy_samples"),
            round_even(F.avg(code_length(F.col("func"))), 2).alias("avg_code_length"),
        )
        .select(
            "split",
            "total_samples",
            "buggy_samples",
            (F.col("total_samples") - F.col("buggy_samples")).alias("clean_samples"),
            round_even(ratio_or_zero(F.col("buggy_samples"), F.col("total_samples")), 3).alias("balance_ratio"),
            "avg_code_length",
        )
    )


def analysis_totals(analysis: DataFrame) -> DataFrame:
    """One row of sums over the splits."""
    return analysis.agg(*[_total(c).alias(c) for c in ("total_samples", "buggy_samples", "clean_samples")])


def split_statistics(df: DataFrame, synthetic_source: str = SOURCE_OK) -> DataFrame:
    """Per split: rows, labels and synthetic share."""
    return (
        df.groupBy("split")
        .agg(
            F.count(F.lit(1)).alias("total_samples"),
            _total("target").alias("buggy_samples"),
            F.count_if(F.col("source") == synthetic_source).alias("synthetic_samples"),
        )
        .select(
            "split",
            "total_samples",
            "buggy_samples",
            (F.col("total_samples") - F.col("buggy_samples")).alias("clean_samples"),
            round_even(ratio_or_zero(F.col("buggy_samples"), F.col("total_samples")), 3).alias("bug_ratio"),
            "synthetic_samples",
            round_even(percent_or_zero(F.col("synthetic_samples"), F.col("total_samples")), 2).alias(
                "synthetic_percentage"
            ),
        )
    )


def statistics_totals(stats: DataFrame) -> DataFrame:
    """One row over all splits: rows, synthetic rows and share, base rows."""
    return stats.agg(
        _total("total_samples").alias("total_samples"),
        _total("synthetic_samples").alias("synthetic_samples"),
    ).select(
        "total_samples",
        "synthetic_samples",
        round_even(percent_or_zero(F.col("synthetic_samples"), F.col("total_samples")), 2).alias(
            "synthetic_percentage"
        ),
        (F.col("total_samples") - F.col("synthetic_samples")).alias("base_samples"),
    )


def split_shares(stats: DataFrame) -> DataFrame:
    """Per split: share of all rows and share of buggy rows, in percent."""
    total = stats.agg(_total("total_samples")).scalar()
    return stats.select(
        "split",
        "total_samples",
        round_even(percent_or_zero(F.col("total_samples"), total), 1).alias("percent_of_total"),
        "buggy_samples",
        round_even(percent_or_zero(F.col("buggy_samples"), F.col("total_samples")), 1).alias("percent_buggy"),
        "clean_samples",
    )


def label_rate(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """One row: rows and mean of a boolean label."""
    return df.agg(
        F.count(F.lit(1)).alias("transactions"),
        F.avg(F.col(label).cast("int")).alias("positive_rate"),
    )
