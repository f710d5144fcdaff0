"""Session construction and the shared scratch folder."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN_ROOT = "ledgerloom.scratch.dir"
#: Rows in a batch between Spark and Python where a row holds a whole text.
TEXT_ROWS = 500


def local_session(cpus: int = 8, app: str = "ledgerloom", memory: str = "16g") -> SparkSession:
    """A single-machine session for tests and benchmarks; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def small_batches(spark: SparkSession) -> None:
    """Let this session send texts to Python a few at a time, unless it has its own setting.

    Spark counts rows, not bytes, and sends 10,000 by default, which is a gigabyte of long texts for each task. It is a
    setting of the session, so the operators leave it alone; the queries and the stages of the pipeline call this.
    """
    option = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(option)) == 10_000:
        spark.conf.set(option, str(TEXT_ROWS))


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    A local session without one, in which driver and executors are one process, takes a new
    temporary folder, writes it into its configuration, and deletes it when Python ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(_OWN_ROOT, None)
    if root:
        return root
    if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    own = tempfile.TemporaryDirectory(prefix="ledgerloom-", ignore_cleanup_errors=True)
    atexit.register(own.cleanup)
    spark.conf.set(_OWN_ROOT, own.name)
    return own.name


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{scratch_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder once and continue from the written table.

    Later branches prune columns from Parquet instead of running the lineage again, and a
    lost executor costs no recomputation of what is already written.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def empty_path(spark: SparkSession, path: str) -> None:
    """Delete the rows of a table this package wrote, on whatever file system it lies.

    What stays is an empty table: Spark has no public way to delete a folder.
    """
    spark.createDataFrame([], "value string").write.mode("overwrite").text(path)
