"""All nine session features on an unbounded stream, by keyed state and event-time timers.

Rows of a key wait until the watermark has passed them: from then on no earlier row of the key can arrive, so they are
taken in order of time. What has been taken is kept as the numbers of the one session that is open, its last event, and its
distinct values, a row of state each; what waits are the rows of at most the watermark's delay. A session that is closed leaves
no state behind.

Every call of the state goes from Python to the JVM and back, and costs more than a row does. So keys share state by a hash of
them, many to a group. Rows of a group wait in blocks of columns, cut by time, of which only those are read that
the watermark has reached; the open sessions of a group are read together. A timer wakes the group when its next waiting
row, or the end of a session, comes under the watermark.

Spark keeps the state with its checkpoint, so a query that is stopped and started again goes on where it was. The state
store must be RocksDB, which ``use_rocksdb`` sets for a session.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ledgerloom.operators.sessions import HIGH_VALUE, MICROS, SESSION_FEATURES, SESSION_GAP_SECONDS, EventColumns

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_OPEN = (
    "first long, last long, n long, known long, total double, mean double, spread double, most double, high long, "
    "categories long, locations long, switches long, location string"
)
_OPEN_NAMES = [c.split()[0] for c in _OPEN.split(", ")]
#: A distinct value of the open session; no value is a value of its own.
_VALUE = "kind string, missing boolean, value string"
_BLOCK_ROWS, _CUTS, _OUT_ROWS = 10_000, 8, 10_000


def use_rocksdb(spark: SparkSession, provider: str = _ROCKSDB) -> str:
    """Let the session's streaming queries that start from now on keep their state in RocksDB, which keyed state in Python needs.
    Returns the provider that was set before."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, provider)
    return before


class SessionProcessor(StatefulProcessor):
    """The sessions of one group of keys after the other."""

    def __init__(self, gap: int, key_type: str, id_type: str) -> None:
        self.gap, self.key_type, self.id_type = gap, key_type, id_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", f"key {self.key_type}", _OPEN)
        self.seen = handle.getMapState("seen", f"key {self.key_type}, {_VALUE}", "at long")
        self.pending = handle.getMapState(
            "pending", "least long, number long", f"key array<{self.key_type}>, us array<long>, id array<{self.id_type}>, "
            "amount array<double>, category array<string>, location array<string>",
        )
        self.blocks = handle.getValueState("blocks", "made long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        least = min(self._wait(self._rows(frame)) for frame in rows if len(frame))
        wake = next(iter(self.handle.listTimers()), None)
        if wake is None or least < wake:
            if wake is not None:
                self.handle.deleteTimer(wake)
            self.handle.registerTimer(least)
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = sorted(tuple(k) for k in self.pending.keys())
        due = [k for k in waiting if k[0] <= passed]
        marks = [_ms(least) for least, _ in waiting[len(due) : len(due) + 1]]
        sessions = {k[0]: dict(zip(_OPEN_NAMES, s, strict=True)) for k, s in self.open.iterator()}
        carried = set(sessions)  # began in an earlier call and have their values in the state
        ended, touched, closed = set(), set(), []
        met: dict[Any, dict[tuple, bool]] = {}  # distinct values of sessions met in this call: whether they are new to it

        def close(user: Any) -> None:
            closed.append(self._closed(user, sessions.pop(user)))
            met.pop(user, None)
            if user in carried:
                carried.discard(user)
                ended.add(user)

        held: list[tuple] = []
        for i, place in enumerate(due):
            held += zip(*self.pending.getValue(place), strict=True)
            self.pending.removeKey(place)
            # Later blocks have no row before their first.
            bound = min(passed, due[i + 1][0] - 1) if i + 1 < len(due) else passed
            held.sort(key=_by_time)
            ready = bisect.bisect_right(held, bound, key=lambda r: r[1])
            for row in held[:ready]:
                user = row[0]
                session = sessions.get(user)
                if session is not None and row[1] - session["last"] >= self.gap:
                    close(user)
                    session = None
                sessions[user] = self._taken(session, row, met.setdefault(user, {}), user in carried)
                touched.add(user)
            held = held[ready:]
            while len(closed) >= _OUT_ROWS:
                yield _frame(closed[:_OUT_ROWS])
                closed = closed[_OUT_ROWS:]
        if held:
            marks.append(self._wait(held))
        for user in [u for u, s in sessions.items() if s["last"] + self.gap <= passed]:
            close(user)
        if ended:
            for value in [v for v in self.seen.keys() if v[0] in ended]:
                self.seen.removeKey(tuple(value))
        for user in ended.difference(sessions):
            self.open.removeKey((user,))
        for user in touched.intersection(sessions):
            session = sessions[user]
            self.open.updateValue((user,), tuple(session[c] for c in _OPEN_NAMES))
            for value, new in met[user].items():
                if new:
                    self.seen.updateValue((user, *value), (session["last"],))
        if sessions:
            marks.append(_ms(min(s["last"] for s in sessions.values()) + self.gap))
        if marks:
            self.handle.registerTimer(min(marks))
        if closed:
            yield _frame(closed)

    def close(self) -> None:
        pass

    def _rows(self, frame: pd.DataFrame) -> list[tuple]:
        columns = [frame[c].tolist() for c in ("session_key", "no_key", "at_us", "row_id", "amount", "category", "location")]
        return [
            (
                None if no_key else key, us, None if i is None or i != i else int(i) if self.id_type == "long" else i,
                None if amount is None or amount != amount else float(amount),
                category if isinstance(category, str) else None, location if isinstance(location, str) else None,
            )
            for key, no_key, us, i, amount, category, location in zip(*columns, strict=True)
        ]

    def _wait(self, rows: list[tuple]) -> int:
        """Put rows into blocks of state, each with a part of their time span. Returns when the first is due, in milliseconds."""
        rows.sort(key=_by_time)
        (made,) = self.blocks.get() or (0,)
        size = min(_BLOCK_ROWS, max(100, -(-len(rows) // _CUTS)))
        for i in range(0, len(rows), size):
            some = rows[i : i + size]
            self.pending.updateValue((some[0][1], made), tuple(map(list, zip(*some, strict=True))))
            made += 1
        self.blocks.update((made,))
        return _ms(rows[0][1])

    def _taken(self, session: dict | None, row: tuple, met: dict[tuple, bool], carried: bool) -> dict:
        key, us, _, amount, category, location = row
        if session is None:
            session = dict.fromkeys(_OPEN_NAMES, 0) | {"first": us, "total": 0.0, "mean": 0.0, "spread": 0.0, "most": None}
        else:
            session["switches"] += session["location"] != location
        session["last"], session["location"] = us, location
        session["n"] += 1
        if amount is not None:
            session["known"] += 1
            session["total"] += amount
            apart = amount - session["mean"]
            session["mean"] += apart / session["known"]
            session["spread"] += apart * (amount - session["mean"])
            session["most"] = amount if session["most"] is None else max(session["most"], amount)
            session["high"] += amount > HIGH_VALUE
        for kind, value in (("categories", category), ("locations", location)):
            place = (kind, value is None, value or "")
            if place not in met:
                met[place] = not (carried and self.seen.containsKey((key, *place)))
                session[kind] += met[place]
        return session

    def _closed(self, key: Any, s: dict) -> tuple:
        n = s["known"]
        return (
            key, s["first"], s["last"], s["n"], s["total"], s["total"] / n if n else None, s["most"],
            math.sqrt(max(0.0, s["spread"]) / n) if n else None, s["categories"], s["locations"], s["switches"], s["high"] / s["n"],
        )


def _by_time(row: tuple) -> tuple:
    return row[1], row[2] is not None, 0 if row[2] is None else row[2]


def _ms(us: int) -> int:
    return -(-us // 1000)


def _frame(closed: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(closed, columns=["key", "first", "last", *SESSION_FEATURES])
    # Numbers beside a missing one stay numbers.
    frame["key"] = pd.Series([c[0] for c in closed], dtype=object)
    return frame


def session_feature_stream(
    df: DataFrame, delay: str | None, cols: EventColumns = EventColumns(), gap_seconds: float = SESSION_GAP_SECONDS, groups: int = 1024
) -> DataFrame:
    """Key, ``session_start``, ``session_end`` and the nine features of every session of a stream, once it is closed.

    Equal to ``session_features`` of the same rows as a table, in whatever order they arrive within ``delay``; rows that
    are later are dropped by Spark. A session is closed when the watermark is a gap behind its last event. ``delay`` is None
    for a stream that has its watermark, as one from ``without_repeats``. ``groups`` is how many groups the keys share state in:
    with more the state is read in smaller pieces, with fewer in fewer calls. It must not change while a checkpoint is in use.
    """
    gap = round(gap_seconds * MICROS)
    if gap <= 0:
        raise ValueError("the session gap must be positive")
    # Ties in time go by id, so numbers must stay numbers.
    id_type = "long" if isinstance(df.schema[cols.row_id].dataType, T.IntegralType) else "string"
    key, key_type = F.col(cols.key), df.schema[cols.key].dataType
    # In pandas, numbers beside a missing one would become doubles.
    known = F.coalesce(key, F.lit(0).cast(key_type)) if isinstance(key_type, T.IntegralType) else key
    rows = (df if delay is None else df.withWatermark(cols.time, delay)).select(
        F.pmod(F.xxhash64(key), F.lit(groups)).cast("int").alias("session_group"),
        known.alias("session_key"), key.isNull().alias("no_key"), F.col(cols.time).alias("at_time"), F.unix_micros(cols.time).alias("at_us"),
        F.col(cols.row_id).cast(id_type).alias("row_id"), F.col(cols.amount).cast("double").alias("amount"),
        F.col(cols.category).cast("string").alias("category"), F.col(cols.location).cast("string").alias("location"),
    )
    whole = {"session_txn_count", "unique_categories", "unique_locations", "location_switches"}
    out = T.StructType([
        T.StructField("key", key_type), T.StructField("first", T.LongType()), T.StructField("last", T.LongType()),
        *[T.StructField(f, T.LongType() if f in whole else T.DoubleType()) for f in SESSION_FEATURES],
    ])
    processor = SessionProcessor(gap, key_type.simpleString(), id_type)
    closed = rows.groupBy("session_group").transformWithStateInPandas(processor, out, "append", "eventTime")
    return closed.select(
        F.col("key").alias(cols.key), F.timestamp_micros("first").alias("session_start"),
        F.timestamp_micros(F.col("last") + gap).alias("session_end"), *SESSION_FEATURES,
    )


def without_repeats(df: DataFrame, delay: str, row_id: str = "transaction_id", time: str = "event_time") -> DataFrame:
    """A stream with each event once, however often it is delivered within ``delay``: of the rows with one id the first to
    come. The state is an id and a time, for as long. Rows without id count as one event."""
    return df.withWatermark(time, delay).dropDuplicatesWithinWatermark([row_id])


def repeats(df: DataFrame, delay: str, row_id: str = "transaction_id", time: str = "event_time") -> DataFrame:
    """The branch beside it: the id, first and last time, and ``n_repeats`` of each event that is delivered more than once, when
    the watermark is ``delay`` behind its last delivery. Spark's session windows keep a row per id."""
    deliveries = df.withWatermark(time, delay).groupBy(row_id, F.session_window(time, delay).alias("w"))
    counted = deliveries.agg(F.count(F.lit(1)).alias("n"), F.min(time).alias("first"), F.max(time).alias("last"))
    return counted.where("n > 1").select(row_id, "first", "last", (F.col("n") - 1).alias("n_repeats"))
