import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fixtures import G1, G1_SESSIONS, G2, G2_SESSIONS, golden_rows
from ledgerloom.functions.times import iso_instant
from ledgerloom.operators.sessions import (
    SESSION_FEATURES,
    assign_sessions,
    enrich_with_sessions,
    enrich_with_user_features,
    session_features,
    user_features,
)
from ledgerloom.streaming.sessions import session_totals

SCHEMA = "transaction_id string, user_id string, amount double, merchant_category string, location string, timestamp string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("event_time", iso_instant(F.col("timestamp")))


def random_rows(seed, users=6, n=240, gap=1800):
    """Times on a coarse grid, so that exact gaps and ties are common; one user has a third."""
    rng = random.Random(seed)
    start = datetime(2026, 1, 1)
    rows = []
    for i in range(n):
        user = "hot" if rng.random() < 1 / 3 else (None if rng.random() < 0.05 else f"u{rng.randrange(users)}")
        moment = start + timedelta(seconds=rng.randrange(0, 60) * gap // 2, microseconds=rng.choice([0, 0, 0, 1]))
        rows.append(
            (
                f"t{i:04d}",
                user,
                rng.choice([5.25, 999.5, 1000.0, 1000.01, 4000.75]),
                rng.choice(["a", "b", "c", None]),
                rng.choice(["x", "y", None]),
                moment.isoformat(timespec="microseconds"),
            )
        )
    rng.shuffle(rows)
    return rows


def brute_sessions(rows, gap=1800):
    """Sessions in plain Python: sort per user, split where the gap is reached."""
    by_user = {}
    for r in rows:
        by_user.setdefault(r[1], []).append((datetime.fromisoformat(r[5]), r[0], r))
    sessions = []
    for user, events in by_user.items():
        events.sort(key=lambda e: e[:2])
        current = []
        for event in events:
            if current and event[0] - current[-1][0] >= timedelta(seconds=gap):
                sessions.append((user, current))
                current = []
            current.append(event)
        sessions.append((user, current))
    return sessions


def features_of(events, sample=False):
    rows = [e[2] for e in events]
    amounts, places = [r[2] for r in rows], [r[4] for r in rows]
    n, mean = len(rows), sum(amounts) / len(rows)
    spread = sum((a - mean) ** 2 for a in amounts)
    deviation = math.sqrt(spread / (n - 1) if sample and n > 1 else spread / n)

    def distinct(values):
        return len({v for v in values if v is not None} if sample else set(values))

    return (
        n,
        sum(amounts),
        mean,
        max(amounts),
        0.0 if sample and n == 1 else deviation,
        distinct(r[3] for r in rows),
        distinct(places),
        sum(a != b for a, b in zip(places, places[1:])),
        sum(a > 1000 for a in amounts) / n,
    )


def close(left, right):
    return all(a == pytest.approx(b, abs=1e-6) for a, b in zip(left, right, strict=True))


def check_sessions(found, expected):
    found = {(r.user_id, r.session_start.replace(tzinfo=None)): tuple(r[c] for c in SESSION_FEATURES) for r in found}
    wanted = {(user, events[0][0]): features_of(events) for user, events in expected}
    assert found.keys() == wanted.keys()
    for key, values in wanted.items():
        assert close(found[key], values), (key, found[key], values)


@pytest.fixture(autouse=True)
def utc(monkeypatch):
    import time

    monkeypatch.setenv("TZ", "UTC")
    time.tzset()


def test_golden_exact_gap(spark):
    rows = enrich_with_sessions(frame(spark, golden_rows("user_198", G1))).collect()
    found = {r.transaction_id: (r.session_txn_count, r.total_amount, r.amount_std) for r in rows}
    for i, *_, session in G1:
        assert close(found[i], G1_SESSIONS[session])


def test_golden_three_sessions(spark):
    rows = enrich_with_sessions(frame(spark, golden_rows("user_125", G2))).collect()
    columns = [c for c in SESSION_FEATURES if c not in ("avg_amount", "max_amount")]
    found = {r.transaction_id: tuple(r[c] for c in columns) for r in rows}
    for i, *_, session in G2:
        assert close(found[i], G2_SESSIONS[session])


@pytest.mark.parametrize("seed", range(4))
def test_sessions_equal_brute_force(spark, seed):
    rows = random_rows(seed)
    check_sessions(session_features(frame(spark, rows)).collect(), brute_sessions(rows))


@pytest.mark.parametrize("slices", [1, 3, 150])
def test_cutting_ranges_anywhere_changes_nothing(spark, slices):
    rows = random_rows(11, users=2, n=300)
    df = frame(spark, rows)
    check_sessions(session_features(df, slices=slices).collect(), brute_sessions(rows))
    users = {r.user_id: tuple(r[c] for c in SESSION_FEATURES) for r in user_features(df, slices=slices).collect()}
    for user, events in brute_sessions(rows, gap=10**9):
        assert close(users[user], features_of(events, sample=True))


def test_one_moment_holds_everything(spark):
    """All rows of one user at one instant: order falls to the id, slices cut inside the tie."""
    rows = [(f"t{i:03d}", "u", 1.0 + i, "a", "xy"[i % 2], "2026-01-01T00:00:00") for i in range(200)]
    found = session_features(frame(spark, rows), slices=29).collect()
    check_sessions(found, brute_sessions(rows))
    assert found[0].location_switches == 199


def test_row_order_and_partitioning_change_nothing(spark):
    rows = random_rows(5)
    first = sorted(map(str, session_features(frame(spark, rows)).drop("avg_amount", "amount_std").collect()))
    again = frame(spark, sorted(rows, key=lambda r: r[2])).repartition(7)
    assert first == sorted(map(str, session_features(again).drop("avg_amount", "amount_std").collect()))


def test_assignment_equals_running_sum(spark):
    """The cell-based assignment against the plain window form over rows."""
    df = frame(spark, random_rows(3))
    order = Window.partitionBy("user_id").orderBy("event_time", "transaction_id")
    gap = F.unix_micros("event_time") - F.lag(F.unix_micros("event_time")).over(order)
    plain = df.withColumn("s", (gap.isNull() | (gap >= 1_800_000_000)).cast("int")).withColumn(
        "session_no", F.sum("s").over(order.rowsBetween(Window.unboundedPreceding, 0))
    )
    expected = {r.transaction_id: r.session_no for r in plain.collect()}
    assigned = assign_sessions(df).collect()
    assert {r.transaction_id: r.session_no for r in assigned} == expected
    assert all(r.session_start <= r.event_time < r.session_end for r in assigned)


def test_built_in_window_agrees(spark):
    df = frame(spark, random_rows(8))
    columns = ["user_id", "session_start", "session_end", "session_txn_count", "max_amount"]
    mine = session_features(df).select(*columns)
    built_in = session_totals(df.where("user_id IS NOT NULL")).select(*columns)
    assert sorted(map(str, mine.where("user_id IS NOT NULL").collect())) == sorted(map(str, built_in.collect()))


@pytest.mark.parametrize("micros, sessions", [(1_800_000_000, 2), (1_799_999_999, 1)])
def test_gap_boundary(spark, micros, sessions):
    start = datetime(2026, 1, 1)
    rows = [
        ("a", "u", 1.0, "c", "l", start.isoformat(timespec="microseconds")),
        ("b", "u", 1.0, "c", "l", (start + timedelta(microseconds=micros)).isoformat(timespec="microseconds")),
    ]
    assert session_features(frame(spark, rows)).count() == sessions
    assert session_totals(frame(spark, rows)).count() == sessions


def test_enrichment_keeps_every_row_and_wins_on_clash(spark):
    rows = random_rows(2)
    df = frame(spark, rows).withColumn("total_amount", F.lit("theirs"))
    out = enrich_with_sessions(df)
    assert out.count() == len(rows)
    assert dict(out.dtypes)["total_amount"] == "double"
    expected = {e[1]: features_of(events) for _, events in brute_sessions(rows) for e in events}
    for r in out.collect():
        assert close([r[c] for c in SESSION_FEATURES], expected[r.transaction_id])


def test_user_features_and_join_back(spark):
    rows = [r for r in random_rows(9) if r[1] is not None] + [("one", "single", 7.0, "a", "x", "2026-01-01T00:00:00")]
    df = frame(spark, rows)
    features = user_features(df)
    found = {r.user_id: tuple(r[c] for c in SESSION_FEATURES) for r in features.collect()}
    for user, events in brute_sessions(rows, gap=10**9):
        assert close(found[user], features_of(events, sample=True))
    assert found["single"][4] == 0.0
    joined = enrich_with_user_features(df.withColumn("max_amount", F.lit(-1.0)), features)
    assert joined.count() == len(rows)
    assert {"max_amount", "max_amount_session"} <= set(joined.columns)
    assert joined.select("max_amount").distinct().first()[0] == -1.0


def test_missing_amounts_of_a_user(spark):
    rows = [
        ("a", "u", None, "c", "l", "2026-01-01T00:00:00"),
        ("b", "u", 2000.0, "c", "l", "2026-01-02T00:00:00"),
        ("c", "u", 4.0, "c", "l", "2026-01-03T00:00:00"),
        ("d", "v", None, "c", "l", "2026-01-01T00:00:00"),
    ]
    found = {r.user_id: r for r in user_features(frame(spark, rows)).collect()}
    u, v = found["u"], found["v"]
    assert (u.session_txn_count, u.avg_amount, u.high_value_txn_ratio) == (2, 1002.0, pytest.approx(1 / 3))
    assert u.amount_std == pytest.approx(1996 / math.sqrt(2))
    assert (v.session_txn_count, v.total_amount, v.avg_amount, v.amount_std) == (0, 0.0, None, 0.0)


def test_empty_input(spark):
    df = frame(spark, [])
    assert session_features(df).count() == 0
    assert enrich_with_sessions(df).count() == 0
    assert user_features(df).count() == 0


def test_bad_gap(spark):
    with pytest.raises(ValueError):
        session_features(frame(spark, []), gap_seconds=0)


def test_no_lists_are_built(spark):
    df = frame(spark, random_rows(1))
    for features in (session_features(df), user_features(df)):
        plan = features._jdf.queryExecution().optimizedPlan().toString()
        assert "collect_" not in plan and "Cartesian" not in plan


def test_missing_amounts_of_a_session(spark):
    """Mean and deviation over known amounts only, as on a stream."""
    rows = [(f"t{i}", "u", a, "c", "l", f"2026-01-01T00:0{i}:00") for i, a in enumerate((10.0, None, 30.0))]
    rows.append(("t9", "v", None, "c", "l", "2026-01-01T00:00:00"))
    found = {r.user_id: r for r in session_totals(frame(spark, rows)).collect()}
    assert close(found["u"][3:], (3, 40.0, 20.0, 30.0, 10.0, 0.0))
    assert tuple(found["v"][3:]) == (1, 0.0, None, None, None, 0.0)
