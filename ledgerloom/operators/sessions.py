"""Event-time sessions per key, their features, and the way back to the rows.

Sessions of one key split where two neighbouring events are ``gap`` or more apart. Time is
cut into cells as wide as the gap. Two events of a key in the same cell are always less than
a gap apart, so a cell never holds more than one session of that key, and everything a
session needs can first be reduced per (key, cell):

* numbers are summed up per cell before they are shuffled, so a key with a large share of the
  rows arrives as its cells, of which it has at most time span / gap;
* sessions are then found on the cells, and the cells of a session are merged;
* distinct values are counted by grouping on (key, session, value), never as a list;
* only changes from one event to the next need rows in order. For them narrow rows are
  range-partitioned by (key, time, id), which cuts any key and any cell anywhere. Comparisons
  inside a range, and between the ends of neighbouring ranges, add up to the exact result;
* rows find their session again by joining on (key, cell).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.times import micros_of

MICROS = 1_000_000
SESSION_GAP_SECONDS = 1800
HIGH_VALUE = 1000.0

SESSION_FEATURES = (
    "session_txn_count",
    "total_amount",
    "avg_amount",
    "max_amount",
    "amount_std",
    "unique_categories",
    "unique_locations",
    "location_switches",
    "high_value_txn_ratio",
)


@dataclass(frozen=True)
class EventColumns:
    """Names of the columns that play each part."""

    key: str = "user_id"
    time: str = "event_time"
    row_id: str = "transaction_id"
    amount: str = "amount"
    category: str = "merchant_category"
    location: str = "location"


def _gap_micros(gap_seconds: float) -> int:
    gap = round(gap_seconds * MICROS)
    if gap <= 0:
        raise ValueError("the session gap must be positive")
    return gap


def _with_cell(df: DataFrame, cols: EventColumns, gap: int) -> DataFrame:
    """Add the event time in microseconds and the start of its cell."""
    df = df.withColumn("_us", micros_of(df, cols.time))
    return df.withColumn("_cell", F.col("_us") - F.pmod(F.col("_us"), F.lit(gap)))


def _same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def _narrow(df: DataFrame, cols: EventColumns, gap: int) -> DataFrame:
    return _with_cell(df, cols, gap).select(
        F.col(cols.key).alias("_key"),
        "_cell",
        "_us",
        F.col(cols.row_id).alias("_id"),
        F.col(cols.amount).cast("double").alias("_amount"),
        # A struct around the value tells "no value" from "no neighbour", and keeps NULL
        # as a value of its own when distinct values are counted.
        F.struct(F.col(cols.category).cast("string").alias("v")).alias("_category"),
        F.struct(F.col(cols.location).cast("string").alias("v")).alias("_location"),
    )


def _cells(events: DataFrame) -> DataFrame:
    """The numbers of each (key, cell), partly summed up before the shuffle."""
    return events.groupBy("_key", "_cell").agg(
        F.count(F.lit(1)).alias("_n"),
        F.count("_amount").alias("_known"),
        F.coalesce(F.sum("_amount"), F.lit(0.0)).alias("_total"),
        F.max("_amount").alias("_max"),
        F.coalesce(F.var_pop("_amount"), F.lit(0.0)).alias("_variance"),
        F.count_if(F.col("_amount") > HIGH_VALUE).alias("_high"),
        F.min("_us").alias("_first"),
        F.max("_us").alias("_last"),
    )


def _with_session(cells: DataFrame, gap: int) -> DataFrame:
    """Number the sessions of each key. ``cells`` has ``_key, _cell, _first, _last``."""
    order = Window.partitionBy("_key").orderBy("_cell")
    before = F.lag("_last").over(order)
    starts = (before.isNull() | (F.col("_first") - before >= gap)).cast("int")
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return cells.withColumn("_starts", starts).withColumn("_session", F.sum("_starts").over(running)).drop("_starts")


def _changes(events: DataFrame, gap: int | None, slices: int | None) -> DataFrame:
    """``_key, _cell, _switches``: events whose location differs from that of the event before, if that
    is less than ``gap`` earlier (None: however long ago). A cell may have several rows."""
    narrow = events.select("_key", "_cell", "_us", "_id", "_location")
    by = ("_key", "_us", "_id")
    ranges = narrow.repartitionByRange(slices, *by) if slices else narrow.repartitionByRange(*by)
    inside = Window.partitionBy("_key", "_slice").orderBy("_us", "_id")

    def changed(before: str, before_us: str) -> Column:
        differs = F.col(before).isNotNull() & ~_same(F.col(before), F.col("_location"))
        return differs if gap is None else differs & (F.col("_us") - F.col(before_us) < gap)

    edge = F.struct("_us", "_id", "_location")
    rows = (
        ranges.withColumn("_slice", F.spark_partition_id())
        .withColumns(
            {
                "_before": F.lag("_location").over(inside),
                "_before_us": F.lag("_us").over(inside),
                "_after_us": F.lead("_us").over(inside),
            }
        )
        .withColumns(
            {
                "_switches": changed("_before", "_before_us").cast("long"),
                "_opens": F.col("_before").isNull(),
                "_edge": F.when(F.col("_before").isNull() | F.col("_after_us").isNull(), edge),
            }
        )
        # The first and the last row of a key in a range stay; the others are summed up per cell.
        .groupBy("_key", "_slice", "_cell", "_opens", "_edge")
        .agg(F.sum("_switches").alias("_switches"))
    )
    # Edges of a key meet in order, two for each range it lies in. All else keeps to its range.
    meets = Window.partitionBy("_key", F.when(F.col("_edge").isNull(), F.col("_slice"))).orderBy("_us", "_id", F.desc("_opens"))
    return (
        rows.select("*", "_edge._us", "_edge._id", "_edge._location")
        .withColumns({"_before": F.lag("_location").over(meets), "_before_us": F.lag("_us").over(meets)})
        .withColumn("_crossed", (F.col("_opens") & F.col("_edge").isNotNull() & changed("_before", "_before_us")).cast("long"))
        .select("_key", "_cell", (F.col("_switches") + F.coalesce("_crossed", F.lit(0))).alias("_switches"))
    )


def _distinct_values(events: DataFrame) -> DataFrame:
    """The distinct categories and locations of each (key, cell)."""
    kinds = F.array(
        *[F.struct(F.lit(k).alias("kind"), F.col(c).alias("value")) for k, c in (("c", "_category"), ("l", "_location"))]
    )
    return events.select("_key", "_cell", F.explode(kinds).alias("_value")).distinct()


def _feature_columns(count: str, deviation: Column, categories: str, locations: str) -> list[Column]:
    return [
        F.col(count).alias("session_txn_count"),
        F.col("_total").alias("total_amount"),
        F.try_divide(F.col("_total"), F.col("_known")).alias("avg_amount"),
        F.col("_max").alias("max_amount"),
        deviation.alias("amount_std"),
        F.col(categories).alias("unique_categories"),
        F.col(locations).alias("unique_locations"),
        F.col("_switches").alias("location_switches"),
        (F.col("_high") / F.col("_n")).alias("high_value_txn_ratio"),
    ]


def session_features(
    df: DataFrame,
    cols: EventColumns = EventColumns(),
    gap_seconds: float = SESSION_GAP_SECONDS,
    slices: int | None = None,
) -> DataFrame:
    """One row per session: key, ``session_start``, ``session_end`` and the nine features.

    ``session_end`` is the last event plus the gap. The deviation is that of the population;
    missing amounts count as events but have no part in sum, mean and deviation. ``slices`` is the
    number of ranges rows are put in order by; by default Spark's number of shuffle partitions.
    """
    gap = _gap_micros(gap_seconds)
    events = _narrow(df, cols, gap)
    cells = _with_session(_cells(events), gap)
    group = ["_key", "_session"]
    all_cells = Window.partitionBy(*group)
    mean = F.try_divide(F.sum("_total").over(all_cells), F.sum("_known").over(all_cells))
    # Squared deviations around the session's mean, from those around the mean of each cell.
    apart = F.coalesce(F.try_divide(F.col("_total"), F.col("_known")) - F.col("_mean"), F.lit(0.0))
    numbers = (
        cells.withColumn("_mean", mean)
        .groupBy(*group)
        .agg(
            *[F.sum(c).alias(c) for c in ("_n", "_known", "_total", "_high")],
            F.max("_max").alias("_max"),
            F.sum(F.col("_known") * (F.col("_variance") + apart * apart)).alias("_spread"),
            F.min("_first").alias("_start"),
            F.max("_last").alias("_end"),
        )
    )
    place = cells.select(F.col("_key").alias("_k"), F.col("_cell").alias("_c"), "_session")

    def placed(rows: DataFrame) -> DataFrame:
        return rows.join(place.hint("merge"), _same(F.col("_key"), F.col("_k")) & (F.col("_cell") == F.col("_c"))).drop("_k", "_c")

    kind = F.col("_value.kind")
    values = (
        placed(_distinct_values(events))
        .select(*group, "_value")
        .distinct()
        .select(*group, *[(kind == k).cast("long").alias(c) for k, c in (("c", "_categories"), ("l", "_locations"))])
    )
    switches = placed(_changes(events, gap, slices).where(F.col("_switches") > 0)).select(*group, "_switches")
    parts = numbers.unionByName(values, allowMissingColumns=True).unionByName(switches, allowMissingColumns=True)
    sums = ("_categories", "_locations", "_switches")
    merged = parts.groupBy(*group).agg(
        *[F.max(c).alias(c) for c in numbers.columns if c not in group],
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums],
    )
    deviation = F.sqrt(F.try_divide(F.col("_spread"), F.col("_known")))
    return merged.select(
        F.col("_key").alias(cols.key),
        F.timestamp_micros("_start").alias("session_start"),
        F.timestamp_micros(F.col("_end") + gap).alias("session_end"),
        *_feature_columns("_n", deviation, "_categories", "_locations"),
    )


def _join_on_cell(df: DataFrame, sessions: DataFrame, cols: EventColumns, gap: int) -> DataFrame:
    """Give every row of ``df`` the columns of its session.

    Neighbouring events of a session are less than a cell apart, so its cells are contiguous
    and follow from its bounds. The join key is (key, cell): a hot key is spread over its
    cells, and an oversized cell is an ordinary skewed join partition that AQE splits. The hint keeps either
    side from a broadcast: a few megabytes of Parquet may be millions of rows, and their cells more.
    """
    start = F.unix_micros("session_start")
    last = F.unix_micros("session_end") - gap
    width = F.lit(gap)
    cells = F.sequence(start - F.pmod(start, width), last - F.pmod(last, width), width)
    by_cell = sessions.withColumn("_cell", F.explode(cells)).withColumnsRenamed(
        {cols.key: "_skey", "_cell": "_scell"}
    )
    rows = _with_cell(df, cols, gap)
    on_cell = _same(F.col(cols.key), F.col("_skey")) & (F.col("_cell") == F.col("_scell"))
    return rows.join(by_cell.hint("merge"), on_cell).drop("_us", "_cell", "_skey", "_scell")


def rows_in_sessions(
    df: DataFrame, sessions: DataFrame, cols: EventColumns = EventColumns(), gap_seconds: float = SESSION_GAP_SECONDS
) -> DataFrame:
    """The rows of ``df`` that lie in one of ``sessions`` (key, ``session_start``, ``session_end``), with its columns.

    Unlike the sessions of ``df`` itself, given ones need not cover its rows, and a cell may hold more than one.
    """
    gap = _gap_micros(gap_seconds)
    joined = _join_on_cell(df, sessions, cols, gap)
    us = micros_of(joined, cols.time)
    return joined.where((us >= F.unix_micros("session_start")) & (us <= F.unix_micros("session_end") - gap))


def assign_sessions(
    df: DataFrame,
    cols: EventColumns = EventColumns(),
    gap_seconds: float = SESSION_GAP_SECONDS,
) -> DataFrame:
    """Every row with the bounds and the ordinal of its session within the key.

    Only needs the first and last event of each cell, which are reduced before the shuffle.
    """
    gap = _gap_micros(gap_seconds)
    cells = (
        _with_cell(df, cols, gap)
        .groupBy(F.col(cols.key).alias("_key"), "_cell")
        .agg(F.min("_us").alias("_first"), F.max("_us").alias("_last"))
    )
    sessions = (
        _with_session(cells, gap)
        .withColumnRenamed("_session", "session_no")
        .groupBy("_key", "session_no")
        .agg(
            F.timestamp_micros(F.min("_first")).alias("session_start"),
            F.timestamp_micros(F.max("_last") + gap).alias("session_end"),
        )
        .withColumnRenamed("_key", cols.key)
    )
    return _join_on_cell(df, sessions, cols, gap)


def enrich_with_sessions(
    df: DataFrame,
    cols: EventColumns = EventColumns(),
    gap_seconds: float = SESSION_GAP_SECONDS,
    slices: int | None = None,
    keep_bounds: bool = False,
) -> DataFrame:
    """Every row again with the features of its session; features win over equal names."""
    features = session_features(df, cols, gap_seconds, slices)
    clash = [c for c in df.columns if c in (*SESSION_FEATURES, "session_start", "session_end")]
    out = _join_on_cell(df.drop(*clash), features, cols, _gap_micros(gap_seconds))
    return out if keep_bounds else out.drop("session_start", "session_end")


def user_features(df: DataFrame, cols: EventColumns = EventColumns(), slices: int | None = None) -> DataFrame:
    """The nine features over all rows of a key, regardless of sessions.

    The deviation is that of a sample, 0 for a single row. Missing amounts are not counted, and missing
    values are not distinct ones. All but the changes of location come from one grouping.
    """
    events = _narrow(df, cols, _gap_micros(SESSION_GAP_SECONDS))
    numbers = events.groupBy("_key").agg(
        F.count(F.lit(1)).alias("_n"),
        F.count("_amount").alias("_known"),
        F.coalesce(F.sum("_amount"), F.lit(0.0)).alias("_total"),
        F.max("_amount").alias("_max"),
        F.coalesce(F.stddev_samp("_amount"), F.lit(0.0)).alias("_deviation"),
        F.count_if(F.col("_amount") > HIGH_VALUE).alias("_high"),
        F.count_distinct("_category.v").alias("_categories"),
        F.count_distinct("_location.v").alias("_locations"),
    )
    switches = (
        _changes(events, None, slices)
        .groupBy(F.col("_key").alias("_k"))
        .agg(F.sum("_switches").alias("_switches"))
    )
    return numbers.join(switches, _same(F.col("_key"), F.col("_k"))).select(
        F.col("_key").alias(cols.key),
        *_feature_columns("_known", F.col("_deviation"), "_categories", "_locations"),
    )


def enrich_with_user_features(
    df: DataFrame, features: DataFrame, key: str = "user_id", suffix: str = "_session"
) -> DataFrame:
    """Inner join of user features to their rows; equal names get a suffix on the feature side.

    A hot key is a skewed join partition, which AQE splits; the feature side has one row per
    key and is broadcast by Spark when it is small enough.
    """
    clash = {c: c + suffix for c in features.columns if c in df.columns and c != key}
    return df.join(features.withColumnsRenamed(clash), key, "inner")
