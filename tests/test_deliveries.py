"""Input of the streams is put in place by as many tasks as there are, and joins of sessions never go through the driver."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from ledgerloom.catalog.events import _arriving, _deliver
from ledgerloom.catalog.inputs import code_samples
from ledgerloom.operators.sessions import enrich_with_sessions

START = datetime(2024, 3, 1)


def _events(spark, path, n=400):
    rows = [(i, START + timedelta(minutes=30 * i), i % 7, "view", float(i), '{"k": 1}') for i in range(n)]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).repartition(4).write.parquet(f"{path}/events.parquet")


def _files(path):
    return [f for f in path.iterdir() if f.name.startswith("part-")]


def test_lines_are_delivered_by_many_tasks(spark, tmp_path):
    _events(spark, tmp_path)
    lines, quarter = _arriving(spark, str(tmp_path), late=True)
    assert round(quarter) == round(399 * 1800 / 4)
    assert {r["part"]: r["count"] for r in lines.groupBy("part").count().collect()} == {0: 98, 1: 100, 2: 100, 3: 102}
    _deliver(lines.where("part = 0").repartition(3), str(tmp_path / "lines"))
    assert len(_files(tmp_path / "lines")) == 3
    assert spark.read.text(str(tmp_path / "lines")).count() == 98


def test_sessions_are_not_broadcast(spark, tmp_path):
    rows = spark.range(1000).select(
        F.col("id").alias("transaction_id"), (F.col("id") % 9).alias("user_id"), F.lit(1.0).alias("amount"), F.lit("c").alias("merchant_category"),
        F.lit("l").alias("location"), F.timestamp_seconds(F.col("id") * 600).alias("event_time"),
    )
    rows.write.parquet(str(tmp_path / "rows"))
    plan = enrich_with_sessions(spark.read.parquet(str(tmp_path / "rows")))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_code_goes_to_python_in_small_batches(spark, tmp_path):
    option = "spark.sql.execution.arrow.maxRecordsPerBatch"
    session = spark.newSession()
    spark.createDataFrame([(1, "a", "s")], "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    assert int(session.conf.get(option)) == 10_000
    assert code_samples(session, str(tmp_path)).count() == 1
    assert int(session.conf.get(option)) == 500
    session.conf.set(option, "77")
    code_samples(session, str(tmp_path))
    assert int(session.conf.get(option)) == 77
