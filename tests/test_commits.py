"""The sink with commits: all lines or none, each once."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerloom.sources.commits import committed_rows, read_committed, remove_unnamed, stream_committed, write_committed

SHAPE = "value string, route string"


def lines(spark, n=60, parts=6):
    """Lines of three branches, one of them without a name."""
    route = F.element_at(F.array(F.lit("flagged"), F.lit(None).cast("string"), F.lit("a b/c=é")), (F.col("id") % 3 + 1).cast("int"))
    return spark.range(0, n, 1, parts).select(F.concat(F.lit("line "), F.col("id").cast("string")).alias("value"), route.alias("route"))


def failing(df):
    """Fails in the last partition, when others have been written."""
    return df.withColumn("value", F.when(F.spark_partition_id() == 5, F.raise_error(F.lit("no disk"))).otherwise(F.col("value")))


def rows_of(df):
    return sorted((tuple(r) for r in df.select("value", "route").collect()), key=repr)


def files_in(path):
    return sorted(f for _, _, names in os.walk(path) for f in names if f.endswith(".txt"))


def test_a_failed_job_shows_nothing_and_is_run_again(spark, tmp_path):
    path = str(tmp_path / "out")
    with pytest.raises(Exception, match="no disk"):
        write_committed(failing(lines(spark)), path, job="today")
    assert read_committed(spark, path).count() == 0
    remove_unnamed(path)  # a killed task may have been writing still
    assert files_in(path) == []
    for _ in range(2):  # run again, and once more
        write_committed(lines(spark), path, job="today")
        assert rows_of(read_committed(spark, path)) == rows_of(lines(spark))
    assert {r["route"]: r["n"] for r in committed_rows(spark, path).collect()} == {"flagged": 20, None: 20, "a b/c=é": 20}


def test_jobs_add_up_and_overwrite_replaces(spark, tmp_path):
    path = str(tmp_path / "out")
    one, two = (spark.createDataFrame([(v, "x"), (None, "x")], SHAPE) for v in ("a", "b"))
    write_committed(one, path)
    write_committed(two, path)
    assert rows_of(read_committed(spark, path)) == [("", "x"), ("", "x"), ("a", "x"), ("b", "x")]
    with pytest.raises(Exception, match="no disk"):
        write_committed(failing(lines(spark)), path, overwrite=True)
    assert read_committed(spark, path).count() == 4  # what was there stays until the commit
    write_committed(spark.createDataFrame([], SHAPE), path, overwrite=True)
    remove_unnamed(path)
    assert read_committed(spark, path).count() == 0 and files_in(path) == [] and committed_rows(spark, path).count() == 0


def test_a_stream_that_fails_and_goes_on(spark, tmp_path):
    source, path, state = (str(tmp_path / p) for p in ("in", "out", "state"))
    for k in range(3):
        lines(spark).where(F.col("value").endswith(str(k))).coalesce(1).write.mode("append").parquet(source)
    arriving = spark.readStream.schema(SHAPE).option("maxFilesPerTrigger", 1).parquet(source)
    poisoned = arriving.withColumn("value", F.when(F.col("value") == "line 31", F.raise_error(F.lit("no disk"))).otherwise(F.col("value")))
    with pytest.raises(Exception, match="no disk"):
        stream_committed(poisoned, path, state).trigger(availableNow=True).start().awaitTermination()
    wanted = lines(spark).where(F.substring("value", -1, 1).isin("0", "1", "2"))
    assert rows_of(read_committed(spark, path)) == rows_of(wanted.where("value LIKE '%0'"))
    stream_committed(arriving, path, state).trigger(availableNow=True).start().awaitTermination()
    assert rows_of(read_committed(spark, path)) == rows_of(wanted)


def test_a_micro_batch_done_again_replaces_its_files(spark, tmp_path):
    from ledgerloom.sources.commits import StreamBranches

    import pyarrow as pa

    path = str(tmp_path / "out")
    writer = StreamBranches(path, "route")

    def batch(*values):
        return pa.record_batch({"value": list(values), "route": ["r"] * len(values)})

    writer.commit([writer.write(iter([batch("a"), batch("b", "c")])), None], 4)
    writer.commit([writer.write(iter([batch("d")]))], 5)
    writer.commit([writer.write(iter([batch("a", "b", "c")]))], 4)
    assert [r[0] for r in rows_of(read_committed(spark, path))] == ["a", "b", "c", "d"] and len(files_in(path)) == 2
