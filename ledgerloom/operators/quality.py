"""Quality filters over code samples, and their reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.numeric import percent_or_zero, round_even
from ledgerloom.functions.syntax import is_valid_python
from ledgerloom.functions.text import code_length, has_docstring, has_function, has_min_length

MIN_LENGTH = 50
FLAGS = ("syntax_valid", "min_length", "is_function", "has_docstring", "passes_filter")


def text_flags(df: DataFrame, code: str = "func", minimum: int = MIN_LENGTH) -> DataFrame:
    """The flags that need no Python: length, function, docstring."""
    return df.withColumns(
        {
            "min_length": has_min_length(F.col(code), minimum),
            "is_function": has_function(F.col(code)),
            "has_docstring": has_docstring(F.col(code)),
        }
    )


def quality_flags(df: DataFrame, code: str = "func", minimum: int = MIN_LENGTH) -> DataFrame:
    """All flags for every row, as the report needs them."""
    flagged = text_flags(df.withColumn("syntax_valid", is_valid_python(F.col(code))), code, minimum)
    passes = F.col("syntax_valid") & F.col("min_length") & F.col("is_function")
    return flagged.withColumn("passes_filter", passes)


def keep_passing(flagged: DataFrame) -> DataFrame:
    """Passing rows of a flagged table, without the flag columns."""
    return flagged.where(F.col("passes_filter")).drop(*FLAGS)


def passing_samples(df: DataFrame, code: str = "func", minimum: int = MIN_LENGTH) -> DataFrame:
    """Passing rows only. The cheap tests run first, so Python parses just their survivors."""
    cheap = df.where(has_min_length(F.col(code), minimum) & has_function(F.col(code)))
    return cheap.where(is_valid_python(F.col(code)))


def _passed_percent(passed: Column, total: Column) -> Column:
    return percent_or_zero(passed, total)


def filter_counts(flagged: DataFrame) -> DataFrame:
    """One row: total, rows per flag, pass rate in percent."""
    return flagged.agg(
        F.count(F.lit(1)).alias("total"), *[F.count_if(f).alias(f) for f in FLAGS]
    ).withColumn("pass_rate", _passed_percent(F.col("passes_filter"), F.col("total")))


def quality_report(flagged: DataFrame) -> DataFrame:
    """Long form: metric and count, seven rows."""
    counts = filter_counts(flagged)
    # Report labels.
    labels = {
        "Total Generated": F.col("total"),
        "Syntax Valid": F.col("syntax_valid"),
        "Meets Min Length": F.col("min_length"),
        "Is Function": F.col("is_function"),
        "Has Docstring": F.col("has_docstring"),
        "Passed All Filters": F.col("passes_filter"),
        "Pass Rate (%)": round_even(F.col("pass_rate"), 2),
    }
    pairs = [c for name, value in labels.items() for c in (F.lit(name), value.cast("double"))]
    return counts.select(F.stack(F.lit(len(labels)), *pairs).alias("metric", "count"))


def code_statistics(df: DataFrame, code: str = "func") -> DataFrame:
    """One row of length statistics; docstrings are counted where the flag is present."""
    length = code_length(F.col(code))
    flagged = F.count_if("has_docstring") if "has_docstring" in df.columns else F.lit(0).cast("long")
    return df.agg(
        F.count(F.lit(1)).alias("total_samples"),
        F.avg(length).alias("avg_code_length"),
        F.min(length).alias("min_code_length"),
        F.max(length).alias("max_code_length"),
        flagged.alias("samples_with_docstring"),
    )
