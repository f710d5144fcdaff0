"""Session windows by Spark's own window function on streams, and the same totals of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.sessions import HIGH_VALUE, MICROS, SESSION_GAP_SECONDS, EventColumns, session_features

TOTALS = (
    "session_txn_count",
    "total_amount",
    "avg_amount",
    "max_amount",
    "amount_std",
    "high_value_txn_ratio",
)


def session_totals(
    df: DataFrame,
    delay: str | None = None,
    cols: EventColumns = EventColumns(),
    gap_seconds: float = SESSION_GAP_SECONDS,
) -> DataFrame:
    """Count, sum, mean, maximum, deviation and high-value share per session.

    Works on a stream, with ``delay`` as its watermark, and on a table; missing amounts are treated
    alike: they count as events and have no part in sum, mean, maximum and deviation. The state of an
    open session is a few numbers, however many events it has. A session is emitted once the watermark
    has passed its end; events later than the watermark are dropped by Spark. With a hot key set
    ``spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition`` for the session: every
    task then merges its own events first.
    """
    if not df.isStreaming:
        known = {name: F.lit(None).cast("string") for name in (cols.category, cols.location) if name not in df.columns}
        rows = df.withColumns(known)
        if cols.row_id not in df.columns:
            rows = rows.withColumn(cols.row_id, F.lit(None).cast("string"))
        return session_features(rows, cols, gap_seconds).select(cols.key, "session_start", "session_end", *TOTALS)
    amount, gap = F.col(cols.amount), round(gap_seconds * MICROS)
    # The built-in window still merges at exactly its gap, so its gap is a microsecond shorter. It is a
    # constant, since a computed one would be evaluated and sorted by for every event.
    window = F.session_window(cols.time, f"{gap - 1} microseconds")
    return (
        df.withWatermark(cols.time, delay or "0 seconds")
        .groupBy(cols.key, window.alias("w"))
        .agg(
            F.count(F.lit(1)).alias("session_txn_count"),
            F.coalesce(F.sum(amount), F.lit(0.0)).alias("total_amount"),
            F.avg(amount).alias("avg_amount"),
            F.max(amount).alias("max_amount"),
            F.stddev_pop(amount).alias("amount_std"),
            (F.count_if(amount > HIGH_VALUE) / F.count(F.lit(1))).alias("high_value_txn_ratio"),
        )
        .select(
            cols.key,
            F.col("w.start").alias("session_start"),
            F.timestamp_micros(F.unix_micros("w.end") + 1).alias("session_end"),
            *TOTALS,
        )
    )
