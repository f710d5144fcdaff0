"""Keys share the state of sessions by groups, and deliveries are micro-batches written by many tasks."""

import math
from collections import Counter

import pandas as pd
from pyspark.sql import functions as F

from ledgerloom.catalog.events import _deliver_each
from ledgerloom.session import scratch_path
from ledgerloom.streaming.stateful import SessionProcessor

COLUMNS = ["session_key", "no_key", "at_us", "row_id", "amount", "category", "location"]
SECOND = 1_000_000


class Held:
    """State and timers of one group in memory; counts what Spark would be asked."""

    def __init__(self):
        self.calls, self.timers, self.tables = Counter(), set(), {}

    def getMapState(self, name, key, value):
        calls, table = self.calls, self.tables.setdefault(name, {})

        class Table:
            def __getattr__(self, method):
                calls[method] += 1
                return {
                    "getValue": table.get, "containsKey": table.__contains__, "updateValue": table.__setitem__, "removeKey": table.pop,
                    "keys": lambda: list(table), "iterator": lambda: list(table.items()),
                }[method]

        return Table()

    def getValueState(self, name, value):
        calls, table = self.calls, self.tables

        class Value:
            def get(self):
                calls["get"] += 1
                return table.get(name)

            def update(self, value):
                calls["update"] += 1
                table[name] = value

        return Value()

    def listTimers(self):
        return iter(sorted(self.timers))

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.discard(at)


class At:
    def __init__(self, us):
        self.ms = us // 1000

    def getCurrentWatermarkInMs(self):
        return self.ms


def run(processor, held, rows, watermark):
    """One micro-batch; closed sessions as (key, first, last, rows, sum, categories)."""
    found = []
    if rows:
        list(processor.handleInputRows((0,), iter([pd.DataFrame(rows, columns=COLUMNS)]), At(watermark)))
    assert len(held.timers) <= 1
    for at in [t for t in held.timers if t <= watermark // 1000]:
        for frame in processor.handleExpiredTimer((0,), At(watermark), None):
            found += [(None if pd.isna(r.key) else r.key, r.first, r.last, r.session_txn_count, r.total_amount, r.unique_categories)
                      for r in frame.itertuples(index=False)]
        held.timers.discard(at)
    return sorted(found, key=repr)


def row(key, second, amount=1.0, category="x"):
    return (key or 0, key is None, second * SECOND, second, amount, category, "l")


def test_many_keys_take_few_calls():
    held = Held()
    processor = SessionProcessor(100 * SECOND, "bigint", "long")
    processor.init(held)
    rows = [row(key, 10 * n) for key in range(300) for n in range(5)]
    assert run(processor, held, rows, -SECOND) == [] and sum(held.calls.values()) < 20
    found = run(processor, held, [row(-1, 10_000)], 9_000 * SECOND)
    assert found == sorted(((key, 0, 40 * SECOND, 5, 5.0, 1) for key in range(300)), key=repr)
    assert sum(held.calls.values()) < 60
    run(processor, held, [], 20_000 * SECOND)
    assert not held.timers and not any(held.tables[name] for name in ("open", "seen", "pending"))


def test_sessions_go_on_over_micro_batches():
    """Numbers beside a missing key stay exact, distinct values are known again, and those of a closed session are not."""
    held, big = Held(), (1 << 60) + 1
    processor = SessionProcessor(100 * SECOND, "bigint", "long")
    processor.init(held)
    assert run(processor, held, [row(big, 0), row(None, 10, math.nan), row(big, 90, 2.0, "y"), row(big, 500)], 95 * SECOND) == []
    assert {k[0] for k in held.tables["open"]} == {big, None}
    found = run(processor, held, [row(big, 180, 4.0, "x"), row(big, 340, 8.0, "z")], 345 * SECOND)
    assert found == sorted([(big, 0, 180 * SECOND, 3, 7.0, 2), (None, 10 * SECOND, 10 * SECOND, 1, 0.0, 1)], key=repr)
    assert {k[3] for k in held.tables["seen"]} == {"z", "l"}
    found = run(processor, held, [], 1_000 * SECOND)
    assert found == [(big, 340 * SECOND, 340 * SECOND, 1, 8.0, 1), (big, 500 * SECOND, 500 * SECOND, 1, 1.0, 1)]
    assert not held.timers and not any(held.tables[name] for name in ("open", "seen", "pending"))


def test_each_delivery_is_a_micro_batch_written_by_many_tasks(spark):
    parts = [spark.range(30 * k, 30 * (k + 1), numPartitions=3).withColumn("part", F.lit(k)) for k in range(2)]
    out, state = scratch_path(spark, "out"), scratch_path(spark, "state")
    _deliver_each(lambda rows: rows.withColumn("file", F.input_file_name()), parts, out, state)
    found = spark.read.parquet(out)
    assert found.count() == 60 and found.select("file").distinct().count() == 6
    assert spark.read.text(f"{state}/offsets/*").select(F.input_file_name()).distinct().count() == 2
