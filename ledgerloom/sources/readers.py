"""Sources, all with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.datasets import label_to_int, validate_dataset
from ledgerloom.schemas import BASE_CODE, SYNTHETIC_CODE, TRANSACTION

SPLITS = ("train", "validation", "test")
# Single files synthetic_batch_<n>.csv as well as directories synthetic_batch=<n>.
BATCH_GLOB = "synthetic_batch[_=]*"

# Code holds quotes and line breaks, so quotes are doubled and records may span lines; the
# white space around it is part of it.
CSV_OPTIONS = {
    "header": "true",
    "multiLine": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per text line in ``value``; blank lines are kept."""
    return spark.read.text(path)


def stream_lines(spark: SparkSession, directory: str, files_per_batch: int | None = None) -> DataFrame:
    """The same for a directory that files keep arriving in."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(directory)


def read_transactions(spark: SparkSession, path: str) -> DataFrame:
    """Typed JSON lines."""
    return spark.read.schema(TRANSACTION).json(path)


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """CSV with a header and multi-line code. Such files cannot be split, so they are for export (the
    writer bounds their bytes); Parquet lies between internal stages."""
    return spark.read.schema(schema).options(**CSV_OPTIONS).csv(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """A table that one of the writers wrote."""
    options = CSV_OPTIONS if fmt == "csv" else {}
    return spark.read.schema(schema).options(**options).format(fmt).load(path)


def read_synthetic_batches(spark: SparkSession, directory: str, fmt: str = "parquet") -> DataFrame:
    """All batches as one table with ``source_file``; raises when there is none."""
    table = read_table(spark, f"{directory.rstrip('/')}/{BATCH_GLOB}", SYNTHETIC_CODE, fmt)
    return table.withColumn("target", label_to_int(F.col("target"))).withColumn(
        "source_file", F.regexp_extract("_metadata.file_path", r"synthetic_batch[_=][^/]*", 0)
    )


def batch_sizes(batches: DataFrame) -> DataFrame:
    """Rows per batch file."""
    return batches.groupBy("source_file").agg(F.count(F.lit(1)).alias("samples"))


def read_dataset(
    spark: SparkSession, paths: dict[str, str], fmt: str = "parquet", schema: T.StructType = BASE_CODE
) -> DataFrame:
    """A data set held as one path per split, as one table with a ``split`` column.

    Every split is validated: required columns present, not empty.
    """
    union = None
    for split, path in paths.items():
        if fmt == "csv":
            part = read_csv(spark, path, schema)
        else:
            part = spark.read.format(fmt).load(path)
        validate_dataset(part)
        part = part.withColumn("target", label_to_int(F.col("target"))).withColumn("split", F.lit(split))
        union = part if union is None else union.unionByName(part)
    if union is None:
        raise ValueError("no splits given")
    return union


def read_splits(
    spark: SparkSession, directory: str, fmt: str = "parquet", schema: T.StructType = BASE_CODE, splits=SPLITS
) -> DataFrame:
    """Splits written by ``write_splits``; naming some of them prunes the other directories."""
    with_split = T.StructType([*schema.fields, T.StructField("split", T.StringType())])
    table = read_table(spark, directory, with_split, fmt)
    table = table.where(F.col("split").isin(*splits))
    return table.withColumn("target", label_to_int(F.col("target"))) if "target" in table.columns else table
