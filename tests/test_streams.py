"""Streams against the same operators on tables."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.sessions import SESSION_FEATURES, session_features
from ledgerloom.streaming.stateful import repeats, session_feature_stream, use_rocksdb, without_repeats

SHAPE = "user_id string, transaction_id {}, amount double, merchant_category string, location string, event_time timestamp"
START = datetime(2024, 3, 1)


def events(seed, n, first_hour, last_hour, numbered):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # Whole minutes, so that there are ties in time and exact gaps.
        at = START + timedelta(minutes=rng.randrange(first_hour * 60, last_hour * 60))
        number = seed * 1000 + i
        rows.append((
            rng.choice(["a", "b", "c", None]), number if numbered else f"t{number}", rng.choice([None, 5.0, 999.5, 1000.5, 20000.0]),
            rng.choice(["x", "y", None, ""]), rng.choice(["u", "v", None, ""]), at,
        ))
    return rows


def rounded(df):
    columns = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    return sorted((tuple(r) for r in df.select(columns).select("user_id", "session_start", "session_end", *SESSION_FEATURES).collect()), key=repr)


@pytest.mark.parametrize("numbered", [True, False])
def test_all_features_from_keyed_state(spark, tmp_path, numbered):
    use_rocksdb(spark)
    shape = SHAPE.format("long" if numbered else "string")
    first = events(1, 150, 0, 30, numbered)
    second = events(2, 150, 25, 60, numbered)  # overlaps the first, within the delay
    too_late = [("a", 1 if numbered else "t1", 7e9, "x", "u", START)]
    ahead = [("end", 2 if numbered else "t2", 1.0, "x", "u", START + timedelta(days=30))]
    source, out, state = (str(tmp_path / p) for p in ("in", "out", "state"))

    def run(*parts):
        for rows in parts:
            spark.createDataFrame(rows, shape).coalesce(1).write.mode("append").parquet(source)
        arriving = spark.readStream.schema(shape).option("maxFilesPerTrigger", 1).parquet(source)
        closed = session_feature_stream(arriving, "6 hours").writeStream.format("parquet").option("path", out)
        closed.option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()

    run(first, second)
    run(too_late, ahead)  # goes on from the checkpoint
    found = rounded(spark.read.parquet(out).where("user_id IS NULL OR user_id <> 'end'"))
    assert found == rounded(session_features(spark.createDataFrame(first + second, shape)))
    assert len(found) > 50


def test_the_gap_must_be_positive(spark):
    with pytest.raises(ValueError):
        session_feature_stream(spark.createDataFrame([], SHAPE.format("long")), "1 hour", gap_seconds=0)


def test_events_delivered_again(spark, tmp_path):
    use_rocksdb(spark)
    shape = SHAPE.format("long")
    rows = events(4, 80, 0, 20, True)
    ahead = [("end", -1, 1.0, "x", "u", START + timedelta(days=30))]
    source = str(tmp_path / "in")
    for some in (rows[:50], rows[30:] + rows[40:45], ahead):  # 30 to 49 twice, of these 40 to 44 a third time
        spark.createDataFrame(some, shape).coalesce(1).write.mode("append").parquet(source)
    for name, stream in (("once", without_repeats), ("again", repeats)):
        arriving = spark.readStream.schema(shape).option("maxFilesPerTrigger", 1).parquet(source)
        writer = stream(arriving, "1 day").writeStream.format("parquet").option("path", str(tmp_path / name))
        writer.option("checkpointLocation", str(tmp_path / f"state-{name}")).trigger(availableNow=True).start().awaitTermination()
    once = spark.read.parquet(str(tmp_path / "once"))
    assert sorted(map(repr, once.collect())) == sorted(map(repr, spark.createDataFrame(rows + ahead, shape).collect()))
    found = {r["transaction_id"]: r["n_repeats"] for r in spark.read.parquet(str(tmp_path / "again")).collect()}
    assert found == {rows[i][1]: 2 if 40 <= i < 45 else 1 for i in range(30, 50)}
