"""Sinks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.splitting import batch_number, number_rows
from ledgerloom.schemas import PREDICTION
from ledgerloom.session import materialize
from ledgerloom.sources.readers import CSV_OPTIONS

MAX_CSV_BYTES = 256 << 20
#: Predictions of so many samples lie in one directory.
ROWS_PER_PART = 1_000_000


def json_rows(df: DataFrame, keep: Sequence[str] = (), members: str = "members") -> DataFrame:
    """One JSON text per row in ``value``, nulls kept, next to the columns in ``keep``.

    Where there is a map column ``members``, its keys come first, in their order and with their values, and the
    columns follow. A key that is also a column was computed by this job, and the column wins.
    """
    options = {"ignoreNullFields": "false"}
    columns = [c for c in df.columns if c != members and c not in keep]
    if members not in df.columns:
        return df.select(F.to_json(F.struct(*columns), options).alias("value"), *keep)

    def inside(value: Column) -> Column:
        text = F.to_json(value, options)
        return F.substring(text, F.lit(2), F.length(text) - 2)

    others = F.map_filter(F.col(members), lambda k, v: ~k.isin(*columns)) if columns else F.col(members)
    parts = [F.when(F.size(others) > 0, inside(others))]
    if columns:
        parts.append(inside(F.struct(*columns)))
    return df.select(F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}")).alias("value"), *keep)


def write_text_branches(df: DataFrame, path: str, branch: str = "route") -> None:
    """Text lines of all branches in one job, one ``branch=`` directory each."""
    df.select("value", branch).write.mode("overwrite").partitionBy(branch).text(path)


def _as_text(df: DataFrame) -> DataFrame:
    """Labels are kept as text, as in the declared schemas."""
    return df.withColumn("target", F.col("target").cast("string")) if "target" in df.columns else df


def _write(df: DataFrame, path: str, fmt: str, max_bytes: int, partition: str | None = None) -> None:
    """Parquet as it comes. CSV files cannot be split by readers, so their bytes are bounded: the table is written once to
    learn how large its largest row is, and as many rows go to a file as fit if all were so large."""
    options = {}
    if fmt == "csv":
        df = materialize(df, "export")
        size = F.octet_length(F.to_json(F.struct(*df.columns)))
        largest = df.agg(F.max(size)).first()[0] or 1
        options = {k: v for k, v in CSV_OPTIONS.items() if k != "multiLine"}
        options["maxRecordsPerFile"] = str(max(1, max_bytes // largest))
    writer = df.write.mode("overwrite").format(fmt).options(**options)
    (writer.partitionBy(partition) if partition else writer).save(path)


def write_csv(df: DataFrame, path: str, max_bytes: int = MAX_CSV_BYTES) -> None:
    """CSV table with a header, in files of bounded size."""
    _write(df, path, "csv", max_bytes)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", max_bytes: int = MAX_CSV_BYTES) -> None:
    """A table of code samples between two stages."""
    _write(_as_text(df), path, fmt, max_bytes)


def write_batches(
    df: DataFrame, directory: str, batch: str = "batch_id", fmt: str = "parquet", max_bytes: int = MAX_CSV_BYTES
) -> None:
    """All batches in one job, each in its own directory ``synthetic_batch=<n>``."""
    _write(_as_text(df.withColumn("synthetic_batch", F.col(batch))), directory, fmt, max_bytes, "synthetic_batch")


def write_splits(df: DataFrame, path: str, fmt: str = "parquet", max_bytes: int = MAX_CSV_BYTES) -> None:
    """One directory per split, in one job and without a shuffle."""
    _write(_as_text(df), path, fmt, max_bytes, "split")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table, or an empty one where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_predictions(
    samples: DataFrame,
    predict: Callable[[DataFrame], DataFrame],
    path: str,
    key: str,
    label: str = "target",
    batch_size: int = 5,
    seed: int = 42,
) -> DataFrame:
    """Score ``samples`` and keep the predictions by batch; a second run scores only the rest.

    ``predict`` maps rows to rows with a ``prediction`` column. Samples are numbered in seeded
    order, so a repeated run gives every sample the number it had before, and whatever part of
    the predictions an interrupted run left behind is completed. The batch is a column; directories
    hold ``ROWS_PER_PART`` samples each, however small a batch is.
    """
    spark = samples.sparkSession
    numbered = number_rows(samples, key, seed).withColumn(
        "batch_num", batch_number(F.col("sample_idx"), batch_size)
    )
    done = read_or_empty(spark, path, PREDICTION).select("sample_idx")
    left = numbered.join(done, "sample_idx", "left_anti")
    scored = predict(left).select(
        "sample_idx",
        F.col("prediction").cast("int").alias("prediction"),
        F.col(label).cast("int").alias("true_label"),
        "batch_num",
        F.floor(F.col("sample_idx") / ROWS_PER_PART).cast("long").alias("part"),
    )
    scored.write.mode("append").partitionBy("part").parquet(path)
    return read_or_empty(spark, path, PREDICTION)
