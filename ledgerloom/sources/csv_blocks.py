"""CSV with multi-line records, read by as many tasks as a file has blocks.

Spark's own reader gives a file with multi-line records to one task. Here the file is read as lines, which splits it into
blocks, and the lines are put together again. A quote inside a quoted field is doubled, so a line break lies inside a field
just where the number of quotes before it, in the whole file, is odd:

1. Inside each block, in order of its lines, the running parity of quotes is taken as if the block began outside fields.
2. A row per block, its parity and how many lines begin with an even or an odd count, gives by a running sum over the blocks of a
   file what each block really begins with, and which record its first lines continue.
3. Lines of a record are joined within the block. Only the last record of a block and the lines that continue it in
   later blocks are shuffled once more.
4. Records are parsed by Spark's ``from_csv``.

No list is longer than the lines of one record, and nothing is gathered per file but a row per block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.session import materialize
from ledgerloom.sources.readers import CSV_OPTIONS


def _joined(order: str) -> Column:
    """The texts of a group in order, with the line breaks between them."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, "value"))), lambda line: line["value"]), "\n")


def csv_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file, first, value``: the text of every record that is not empty; ``first`` marks the first one of a file.

    Files are UTF-8; their line breaks are line feeds or, if the first one is, pairs of carriage return and line feed, which
    become line feeds; quotes inside quoted fields are doubled, and fields without quotes hold none.
    """
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), "value", (quotes % 2).cast("long").alias("odd"),
        F.col("value").endswith("\r").alias("returns"),
    )
    in_block = Window.partitionBy("file", "block").orderBy("at")
    before = F.coalesce(F.sum("odd").over(in_block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2
    marked = lines.withColumn("before", before)

    blocks = marked.groupBy("file", "block").agg(
        (F.sum("odd") % 2).alias("odd"), F.count_if(F.col("before") == 0).alias("even_lines"), F.count_if(F.col("before") == 1).alias("odd_lines"),
        F.min_by("returns", "at").alias("returns"),
    )
    in_file = Window.partitionBy("file").orderBy("block")
    earlier = in_file.rowsBetween(Window.unboundedPreceding, -1)
    begins = F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2
    records = F.when(F.col("begins") == 0, F.col("even_lines")).otherwise(F.col("odd_lines"))
    # The record that is open where a block begins: the last one of the nearest block before that has any.
    open_record = F.last(F.when(F.col("records") > 0, F.struct("block", "records")), ignorenulls=True).over(earlier)
    blocks = (
        blocks.withColumn("begins", begins).withColumn("records", records).withColumn("opened", open_record)
        .select(
            "file", "block", "begins", "records", "opened",
            F.min(F.struct("block", "returns")).over(Window.partitionBy("file")).alias("opening"),
        )
    )

    starts = (F.col("before") == F.col("begins")).cast("long")
    parts = (
        marked.join(blocks, ["file", "block"])
        .withColumn("record", F.sum(starts).over(in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .groupBy("file", "block", "record")
        .agg(*[F.first(c).alias(c) for c in ("records", "opened", "opening")], _joined("at").alias("value"))
    )
    parts = materialize(parts, "csv-parts")  # both kinds of parts are taken from here, so that the file is not read for each
    first = ((F.col("home") == F.col("opening.block")) & (F.col("record") == 1)).alias("first")
    at_border = (F.col("record") == 0) | (F.col("record") == F.col("records"))
    whole = parts.where(~at_border).withColumn("home", F.col("block")).select("file", first, "opening.returns", "value")
    glued = (
        parts.where(at_border)
        .select(
            "file", "block", "value", "opening",
            F.when(F.col("record") == 0, F.col("opened.block")).otherwise(F.col("block")).alias("home"),
            F.when(F.col("record") == 0, F.col("opened.records")).otherwise(F.col("record")).alias("record"),
        )
        .groupBy("file", "home", "record")
        .agg(F.first("opening").alias("opening"), _joined("block").alias("value"))
        .select("file", first, "opening.returns", "value")
    )
    # As for Spark's reader, the first line break of a file tells whether its line breaks are pairs.
    single = F.regexp_replace("value", r"\r(\n|\z)", "$1")
    value = F.when(F.col("returns"), single).otherwise(F.col("value")).alias("value")
    return whole.unionByName(glued).select("file", "first", value).where("value <> ''")


def read_csv_blocks(spark: SparkSession, path: str | list[str], schema: T.StructType, header: bool = True) -> DataFrame:
    """What ``read_csv`` gives, in any order, with every file read by as many tasks as it has blocks of
    ``spark.sql.files.maxPartitionBytes``. Columns go by position; with ``header`` the first record of a file is not data."""
    records = csv_records(spark, path)
    if header:
        records = records.where(~F.col("first"))
    options = {k: v for k, v in CSV_OPTIONS.items() if k != "header"}
    return records.select(F.from_csv("value", F.lit(schema.simpleString()), options).alias("row")).select("row.*")
