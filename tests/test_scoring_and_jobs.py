import json
import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from fixtures import line
from ledgerloom.operators import scoring
from ledgerloom.operators.scoring import (
    FEATURES,
    apply_threshold,
    assembler,
    class_weights,
    fill_features,
    fit_forest,
    routed,
    score_rows,
    score_with,
    with_class_weight,
)
from ledgerloom.operators.datasets import label_rate
from ledgerloom.operators.sessions import SESSION_FEATURES
from ledgerloom.plans.fraud import run_batch, run_training, train
from ledgerloom.sources.readers import read_transactions, stream_lines
from ledgerloom.sources.writers import load_model, save_model
from ledgerloom.streaming.fraud import FINAL, LATE, FraudStream
from ledgerloom.streaming.sessions import session_totals


def simulated(n_users=40, seed=1):
    """Normal users spend little in one place; every fourth turns to large sums elsewhere."""
    rng = random.Random(seed)
    rows = []
    for u in range(n_users):
        start = datetime(2026, 1, 1) + timedelta(minutes=rng.randrange(300))
        n = rng.randrange(3, 9)
        for i in range(n):
            fraud = u % 4 == 0 and i >= n - 3
            rows.append(
                {
                    "transaction_id": f"{u}-{i}",
                    "user_id": f"user_{u}",
                    "amount": round(rng.uniform(1500, 5000) if fraud else rng.uniform(5, 300), 2),
                    "merchant_category": rng.choice(["luxury", "travel"] if fraud else ["grocery", "pharmacy"]),
                    "location": rng.choice(["Miami", "Chicago"]) if fraud else "Boston",
                    "timestamp": (start + timedelta(minutes=i * rng.randrange(2, 21))).isoformat(),
                    "is_fraud": fraud,
                }
            )
    rng.shuffle(rows)
    return rows


def write_lines(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("train"))
    write_lines(f"{folder}/in/all.jsonl", [json.dumps(r) for r in simulated()])
    result = run_training(spark, f"{folder}/in", f"{folder}/model", trees=15, depth=4)
    return result, f"{folder}/model"


def test_threshold_is_strict_and_unrounded(spark):
    df = spark.createDataFrame([(0.7,), (0.70001,), (0.69999,), (0.12345,), (0.00005,)], "p double")
    found = {r.p: (r.fraud_score, r.fraud_predicted) for r in apply_threshold(df, "p").collect()}
    assert found[0.7] == (0.7, False)
    assert found[0.70001] == (0.7, True)
    assert found[0.69999] == (0.7, False)
    assert found[0.12345] == (0.1234, False)


def test_routes_are_complementary(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, False)], "i int, fraud_predicted boolean")
    assert routed(df, "flagged").count() == 1 and routed(df, "clean").count() == 2


def test_missing_features_become_zero(spark):
    df = spark.createDataFrame([(None, float("nan"), 3)], "amount double, total_amount double, session_txn_count int")
    values = assembler().transform(fill_features(df)).select(vector_to_array("_features")).first()[0]
    assert values == [0.0, 3.0] + [0.0] * (len(FEATURES) - 2)
    assert FEATURES == ("amount", *SESSION_FEATURES)


def test_balanced_weights(spark):
    df = spark.createDataFrame([(1,)] * 2 + [(0,)] * 6, "y int")
    assert {r.y: r.weight for r in class_weights(df, "y").collect()} == {1: 2.0, 0: 8 / 12}
    weighted = with_class_weight(df, "y")
    assert weighted.agg(F.sum("weight")).first()[0] == pytest.approx(8)
    assert "Exchange hashpartitioning" not in weighted._jdf.queryExecution().executedPlan().toString()


def test_label_rate(spark):
    df = spark.createDataFrame([(True,), (False,), (False,), (False,)], "is_fraud boolean")
    assert tuple(label_rate(df).first()) == (4, 0.25)


def test_training_separates_and_reports(trained):
    result, _ = trained
    report = {r["class"]: r for r in result.report.collect()}
    assert set(report) == {"0", "1", "accuracy", "macro avg", "weighted avg"}
    assert report["accuracy"].f1_score > 0.85
    assert 0 < result.label_rate.first().positive_rate < 0.5


@pytest.mark.parametrize("grain, by_user", [("user", False), ("session", True)])
def test_training_options(spark, tmp_path, grain, by_user):
    write_lines(f"{tmp_path}/in/all.jsonl", [json.dumps(r) for r in simulated(20)])
    result = run_training(spark, f"{tmp_path}/in", f"{tmp_path}/model", grain=grain, by_user=by_user, trees=3, depth=3)
    assert {"accuracy", "macro avg", "weighted avg"} < {r["class"] for r in result.report.collect()}
    with pytest.raises(ValueError):
        train(read_transactions(spark, f"{tmp_path}/in"), grain="day")


def test_saved_model_scores_the_same(spark, trained, tmp_path):
    result, path = trained
    df = spark.createDataFrame([(2000.0, 3), (20.0, 5)], "amount double, session_txn_count int")
    rows = score_rows(df, result.model).collect()
    assert all(0 <= r.fraud_score <= 1 for r in rows)
    assert score_rows(df, load_model(path)).collect() == rows
    save_model(result.model, f"{tmp_path}/again")
    save_model(result.model, f"{tmp_path}/again")
    assert score_rows(df, load_model(f"{tmp_path}/again")).collect() == rows


def test_loaded_model_is_applied_per_batch(spark):
    def load():
        class Model:
            def predict_proba(self, frame):
                assert list(frame.columns) == ["amount", "absent"]
                return [(1 - a, a) for a in frame["amount"] + frame["absent"]]

        return Model()

    df = spark.createDataFrame([(0.7,), (0.71,), (None,)], "amount double")
    rows = score_with(df, load, columns=("amount", "absent")).collect()
    assert [tuple(r)[1:] for r in rows] == [(0.7, False), (0.71, True), (0.0, False)]


def test_absent_label_is_not_trained_on(spark):
    df = spark.createDataFrame([(1.0, True), (2.0, None), (3.0, False)], "amount double, is_fraud boolean")
    assert fit_forest(df, trees=1, depth=1).transform(fill_features(df)).count() == 3


BROKEN = ["not json", "", line()[:-1]]


def test_forest_is_fitted_on_even_parts(spark, monkeypatch):
    """Rows of one large part are dealt to all cores, narrow, and nothing stays kept afterwards."""
    seen = []

    class Recorder:
        def __init__(self, stages):
            pass

        def fit(self, rows):
            seen.append((rows, [len(p) for p in rows.rdd.glom().collect()], rows.columns))

    monkeypatch.setattr(scoring, "Pipeline", Recorder)
    rows = spark.range(4_000).select((F.col("id") % 2 == 0).alias("is_fraud"), F.col("id").alias("amount"), F.lit("x" * 50).alias("note"))
    fit_forest(rows.coalesce(1))
    ((training, sizes, columns),) = seen
    assert len(sizes) == spark.sparkContext.defaultParallelism and sum(sizes) == 4_000
    assert max(sizes) <= 2 * min(sizes) and "note" not in columns
    assert not training.is_cached


def test_batch_job_writes_three_branches(spark, trained, tmp_path):
    rows = simulated(seed=2)
    write_lines(f"{tmp_path}/in/a.jsonl", [json.dumps({**r, "channel": {"n": 1}}) for r in rows] + BROKEN)
    for _ in range(2):  # a second run replaces the first
        run_batch(spark, f"{tmp_path}/in", trained[0].model, f"{tmp_path}/out")
    out = spark.read.text(f"{tmp_path}/out").collect()
    assert sorted(r.value for r in out if r.route == "dead_letters") == sorted(BROKEN)
    scored = [(json.loads(r.value), r.route) for r in out if r.route != "dead_letters"]
    assert len(scored) == len(rows)
    for row, route in scored:
        assert list(row) == [*rows[0], "channel", *SESSION_FEATURES, "fraud_score", "fraud_predicted"]
        assert (route == "flagged") == row["fraud_predicted"] and row["channel"] == {"n": 1}
        assert row["fraud_predicted"] == (row["fraud_score"] > 0.7) or row["fraud_score"] == 0.7
    originals = {r["transaction_id"]: r for r in rows}
    assert all(row[k] == v for row, _ in scored for k, v in originals[row["transaction_id"]].items())


def batches_in_time_order(folder, rows, parts=4):
    lines = [json.dumps(r) for r in sorted(rows, key=lambda r: r["timestamp"])]
    size = -(-len(lines) // parts)
    for i in range(parts):
        path = f"{folder}/{i}.jsonl"
        write_lines(path, lines[i * size : (i + 1) * size] + (BROKEN if i == 1 else []))
        os.utime(path, (1000 + i, 1000 + i))
    return lines


def comparable(lines):
    """Sums of doubles depend on the order of addition in their last digits."""
    rows = [(r.value if r.route == "dead_letters" else json.loads(r.value), r.route) for r in lines.collect()]
    return sorted(
        (str(v if isinstance(v, str) else {k: round(x, 6) if isinstance(x, float) else x for k, x in v.items()}), route) for v, route in rows
    )


def read_stream(spark, path):
    return spark.read.option("basePath", path).text(path)


def test_stream_equals_batch(spark, trained, tmp_path):
    rows = simulated(seed=3)
    batches_in_time_order(f"{tmp_path}/in", rows)
    model = trained[0].model
    run_batch(spark, f"{tmp_path}/in", model, f"{tmp_path}/batch")
    job = FraudStream(model, f"{tmp_path}/stream", f"{tmp_path}/state", delay_seconds=0)
    running = job.start(stream_lines(spark, f"{tmp_path}/in", 1), availableNow=True)
    running.awaitTermination()
    before = read_stream(spark, f"{tmp_path}/stream").where(F.col("route") != "dead_letters").count()
    assert 0 < before < len(rows)
    job.finish(spark, 3)
    batch = spark.read.text(f"{tmp_path}/batch").select("value", "route")
    stream = read_stream(spark, f"{tmp_path}/stream").select("value", "route")
    assert comparable(stream) == comparable(batch)


def test_replayed_micro_batch_gives_the_same(spark, trained, tmp_path):
    parts = [spark.createDataFrame([(x,) for x in p], "value string") for p in (
        [line("a", ts="2026-01-01T00:00:00"), line("b", ts="2026-01-01T00:10:00")],
        [line("c", ts="2026-01-01T00:20:00"), line("d", ts="2026-01-01T05:00:00")],
    )]
    job = FraudStream(trained[0].model, f"{tmp_path}/out", f"{tmp_path}/state", delay_seconds=60)
    job.process(parts[0], 0)
    job.process(parts[1], 1)
    first = sorted(read_stream(spark, f"{tmp_path}/out").collect())
    job.process(parts[1], 1)
    assert sorted(read_stream(spark, f"{tmp_path}/out").collect()) == first
    ids = {json.loads(r.value)["transaction_id"]: json.loads(r.value)["session_txn_count"] for r in first}
    assert ids == {"a": 3, "b": 3, "c": 3}


def test_late_rows_are_set_aside_and_counted(spark, trained, tmp_path):
    job = FraudStream(trained[0].model, f"{tmp_path}/out", f"{tmp_path}/state", delay_seconds=600)
    first = [line("a", ts="2026-01-01T00:00:00"), line("z", ts="2026-01-01T06:00:00")]
    second = [line("late", ts="2026-01-01T00:05:00"), line("ok", user="v", ts="2026-01-01T05:45:00")]
    for i, lines in enumerate((first, second)):
        job.process(spark.createDataFrame([(x,) for x in lines], "value string"), i)
    job.finish(spark, 1)
    out = read_stream(spark, f"{tmp_path}/out").collect()
    found = {json.loads(r.value)["transaction_id"]: (r.route, str(r.batch_id)) for r in out}
    assert found["late"] == (LATE, "1")
    assert found["a"] == ("clean", "0") and found["z"][1] == FINAL and found["ok"][1] == FINAL


def logged(state):
    return {
        int(name.split("=")[1]) for name in os.listdir(f"{state}/rows")
        if any(f.endswith(".parquet") for f in os.listdir(f"{state}/rows/{name}"))
    }


def test_old_state_is_emptied(spark, trained, tmp_path):
    """Every batch closes the session of the one before; two versions stay for a replay."""
    job = FraudStream(trained[0].model, f"{tmp_path}/out", f"{tmp_path}/state", delay_seconds=0)
    for i in range(6):
        job.process(spark.createDataFrame([(line(f"t{i}", ts=f"2026-01-01T{i:02d}:00:00"),)], "value string"), i)
    assert logged(f"{tmp_path}/state") == {4, 5, 3} or logged(f"{tmp_path}/state") == {4, 5}
    assert not any(f.endswith(".parquet") for f in os.listdir(f"{tmp_path}/state/sessions/batch_id=3"))


def test_a_session_that_stays_open_is_logged_once(spark, trained, tmp_path):
    """A user who never pauses keeps rows in the log, which later batches neither read nor write again."""
    job = FraudStream(trained[0].model, f"{tmp_path}/out", f"{tmp_path}/state", delay_seconds=0)
    seen = {}
    for i in range(5):
        lines = [line(f"b{i}", user="busy", ts=f"2026-01-01T0{i // 3}:{20 * (i % 3):02d}:00")]
        lines.append(line(f"o{i}", user=f"once{i}", ts=f"2026-01-01T0{i // 3}:{20 * (i % 3):02d}:00"))
        job.process(spark.createDataFrame([(x,) for x in lines], "value string"), i)
        for b in range(i + 1):
            folder = f"{tmp_path}/state/rows/batch_id={b}"
            assert seen.setdefault(b, sorted(os.listdir(folder))) == sorted(os.listdir(folder))
    assert logged(f"{tmp_path}/state") == {0, 1, 2, 3, 4}
    job.finish(spark, 4)
    out = [json.loads(r.value) for r in read_stream(spark, f"{tmp_path}/out").collect()]
    assert {r["transaction_id"]: r["session_txn_count"] for r in out} == {
        **{f"b{i}": 5 for i in range(5)}, **{f"o{i}": 1 for i in range(5)}
    }


def test_only_dead_letters(spark, trained, tmp_path):
    job = FraudStream(trained[0].model, f"{tmp_path}/out", f"{tmp_path}/state")
    for i in range(3):
        job.process(spark.createDataFrame([(x,) for x in BROKEN], "value string"), i)
    job.finish(spark, 2)
    assert {r.route for r in read_stream(spark, f"{tmp_path}/out").collect()} == {"dead_letters"}


def test_empty_micro_batches(spark, trained, tmp_path):
    job = FraudStream(trained[0].model, f"{tmp_path}/out", f"{tmp_path}/state")
    nothing = spark.createDataFrame([], "value string")
    job.process(nothing, 0)
    job.process(spark.createDataFrame([(line("a"),)], "value string"), 1)
    job.process(nothing, 2)
    job.finish(spark, 2)
    out = read_stream(spark, f"{tmp_path}/out").collect()
    assert [json.loads(r.value)["transaction_id"] for r in out] == ["a"]


def test_streamed_totals_equal_batch_for_closed_sessions(spark, tmp_path):
    rows = [r for r in simulated(seed=4)]
    newest = max(r["timestamp"] for r in rows)
    sentinel = {**rows[0], "user_id": "sentinel", "timestamp": (datetime.fromisoformat(newest) + timedelta(days=1)).isoformat()}
    batches_in_time_order(f"{tmp_path}/in", [*rows, sentinel], parts=3)
    parsed = stream_lines(spark, f"{tmp_path}/in", 1).select(
        F.from_json("value", "user_id string, amount double, timestamp string").alias("r")
    ).select("r.user_id", "r.amount", F.to_timestamp("r.timestamp").alias("event_time")).where("event_time IS NOT NULL")
    out = f"{tmp_path}/closed"
    query = (
        session_totals(parsed, delay="5 minutes").writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    table = read_transactions(spark, f"{tmp_path}/in").where("user_id != 'sentinel'")
    batch = session_totals(table.select("user_id", "amount", F.to_timestamp("timestamp").alias("event_time")))
    columns = ["user_id", "session_start", "session_end", "session_txn_count", "max_amount"]
    streamed = sorted(map(str, spark.read.parquet(out).select(*columns).collect()))
    assert streamed == sorted(map(str, batch.select(*columns).collect()))
