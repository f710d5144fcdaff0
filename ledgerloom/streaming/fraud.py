"""The transaction job on a stream of JSON lines.

Each micro-batch is handled by the operators of the batch job. What is kept between micro-batches
lies next to the checkpoint:

* ``sessions``: first and last event of every session that may still grow, a row each;
* ``rows``: a log of the rows of each micro-batch, written once and never again. A session that closes
  takes its rows from the parts of the log that overlap it in time. A part without rows of open
  sessions is emptied;
* ``control``: the watermark, and which parts of the log are still needed.

So a micro-batch costs its own rows, the open sessions and the rows of sessions it closes, whatever
waits beside them. It reads only the version before its own and replaces only its own directories,
so a replay after a failure gives the same result.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.functions.times import micros_of
from ledgerloom.operators.parsing import DEAD_LETTER, PARSED_ROW, VALID
from ledgerloom.operators.scoring import THRESHOLD
from ledgerloom.operators.sessions import MICROS, SESSION_GAP_SECONDS, rows_in_sessions
from ledgerloom.plans.fraud import DEAD_LETTERS, parse_to_table, score_and_route
from ledgerloom.session import empty_path
from ledgerloom.sources.writers import write_text_branches

FINAL = "final"
LATE = "late"

_SESSIONS = "user_id string, first long, last long, closed boolean"
_PART = "batch_id long, oldest long, newest long"
_CONTROL = f"watermark long, parts array<struct<{_PART.replace(' long', ': long')}>>"


class FraudStream:
    """Parameters of one streaming run and its micro-batch function.

    ``state_path`` belongs to this run alone. ``delay_seconds`` is how far behind the newest
    event an event may arrive; a row whose own session window the watermark has already passed
    is written to the branch ``late`` instead of being joined to a session.
    """

    def __init__(
        self,
        model: PipelineModel,
        output_path: str,
        state_path: str,
        delay_seconds: float = 3600,
        gap_seconds: float = SESSION_GAP_SECONDS,
        threshold: float = THRESHOLD,
    ):
        self.model = model
        self.output_path = output_path.rstrip("/")
        self.state_path = state_path.rstrip("/")
        self.delay = round(delay_seconds * MICROS)
        self.gap = round(gap_seconds * MICROS)
        self.gap_seconds = gap_seconds
        self.threshold = threshold

    def start(self, lines: DataFrame, **trigger) -> StreamingQuery:
        """Start the query; ``trigger`` as for ``DataStreamWriter.trigger``."""
        writer = lines.writeStream.option("checkpointLocation", f"{self.state_path}/checkpoint")
        return writer.foreachBatch(self.process).trigger(**trigger).start()

    def process(self, lines: DataFrame, batch_id: int) -> None:
        spark = lines.sparkSession
        parsed = parse_to_table(lines, self._state("parsed", batch_id))
        valid = parsed.where(F.col("parse_status") == VALID).drop("value", "parse_status", "reason")
        us = micros_of(valid, "event_time")
        previous, parts = self._control(spark, batch_id - 1)
        expired = F.lit(False) if previous is None else us + self.gap <= previous
        valid.where(~expired).write.mode("overwrite").parquet(self._state("rows", batch_id))
        rows = self._log(spark, [batch_id])
        # One row of numbers about the micro-batch.
        span = valid.agg(
            F.max(us).alias("newest"), F.min(F.when(~expired, us)).alias("first"), F.max(F.when(~expired, us)).alias("last")
        ).first()
        reached = [w for w in (previous, None if span["newest"] is None else span["newest"] - self.delay) if w is not None]
        watermark = max(reached) if reached else None
        if span["first"] is not None:
            parts = [*parts, (batch_id, span["first"], span["last"])]

        self._merged_sessions(spark, rows, batch_id, watermark).write.mode("overwrite").parquet(self._state("sessions", batch_id))
        done = self._rows_of(spark, self._sessions(spark, batch_id, closed=True), parts)
        dead = parsed.where(F.col("parse_status") == DEAD_LETTER)
        late = valid.where(expired).select(F.to_json(F.col("members")).alias("value"))
        out = (
            self._scored(done)
            .unionByName(dead.select("value", F.lit(DEAD_LETTERS).alias("route")))
            .unionByName(late.withColumn("route", F.lit(LATE)))
        )
        write_text_branches(out, f"{self.output_path}/batch_id={batch_id}")

        oldest = self._sessions(spark, batch_id, closed=False).agg(F.min("first")).first()[0]
        needed = [p for p in parts if oldest is not None and p[2] >= oldest]
        spark.createDataFrame([(watermark, needed)], _CONTROL).coalesce(1).write.mode("overwrite").parquet(
            self._state("control", batch_id)
        )
        # What no replay can ask for any more: a replay of this micro-batch starts from the one before.
        started_with = {p[0] for p in self._control(spark, batch_id - 1)[1]}
        for old in {p[0] for p in self._control(spark, batch_id - 2)[1]} - started_with:
            empty_path(spark, self._state("rows", old))
        if batch_id >= 2:
            for kind in ("parsed", "sessions"):
                empty_path(spark, self._state(kind, batch_id - 2))

    def finish(self, spark: SparkSession, last_batch_id: int) -> None:
        """Close every session still open after the last micro-batch of a finite input."""
        left = self._sessions(spark, last_batch_id, closed=False)
        rows = self._rows_of(spark, left, self._control(spark, last_batch_id)[1])
        write_text_branches(self._scored(rows), f"{self.output_path}/batch_id={FINAL}")

    def _merged_sessions(self, spark: SparkSession, rows: DataFrame, batch_id: int, watermark: int | None) -> DataFrame:
        """Sessions of the new rows and of those still open, merged where they are less than a gap apart."""
        us = micros_of(rows, "event_time")
        spans = rows.groupBy("user_id", F.floor(us / self.gap).alias("cell")).agg(F.min(us).alias("first"), F.max(us).alias("last"))
        spans = spans.drop("cell")
        if batch_id > 0:
            spans = spans.unionByName(self._sessions(spark, batch_id - 1, closed=False))
        order = Window.partitionBy("user_id").orderBy("first", "last")
        before = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
        starts = (before.isNull() | (F.col("first") - before >= self.gap)).cast("int")
        running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        closed = F.lit(False) if watermark is None else F.col("last") + self.gap <= watermark
        return (
            spans.withColumn("_starts", starts)
            .withColumn("_session", F.sum("_starts").over(running))
            .groupBy("user_id", "_session")
            .agg(F.min("first").alias("first"), F.max("last").alias("last"))
            .select("user_id", "first", "last", closed.alias("closed"))
        )

    def _rows_of(self, spark: SparkSession, sessions: DataFrame, parts: list[tuple[int, int, int]]) -> DataFrame:
        """The logged rows of these sessions, from the parts of the log that overlap them."""
        span = sessions.agg(F.min("first").alias("first"), F.max("last").alias("last")).first()
        overlap = [p[0] for p in parts if span["first"] is not None and p[1] <= span["last"] and p[2] >= span["first"]]
        if not overlap:
            return spark.createDataFrame([], PARSED_ROW)
        bounds = sessions.select(
            "user_id", F.timestamp_micros("first").alias("session_start"), F.timestamp_micros(F.col("last") + self.gap).alias("session_end")
        )
        return rows_in_sessions(self._log(spark, overlap), bounds, gap_seconds=self.gap_seconds).select(*PARSED_ROW.fieldNames())

    def _scored(self, rows: DataFrame) -> DataFrame:
        return score_and_route(rows, self.model, self.gap_seconds, self.threshold)

    def _state(self, kind: str, batch_id: int) -> str:
        return f"{self.state_path}/{kind}/batch_id={batch_id}"

    def _log(self, spark: SparkSession, batch_ids: list[int]) -> DataFrame:
        return spark.read.schema(PARSED_ROW).parquet(*[self._state("rows", b) for b in batch_ids])

    def _sessions(self, spark: SparkSession, batch_id: int, closed: bool) -> DataFrame:
        table = spark.read.schema(_SESSIONS).parquet(self._state("sessions", batch_id))
        return table.where(F.col("closed") == F.lit(closed)).drop("closed")

    def _control(self, spark: SparkSession, batch_id: int) -> tuple[int | None, list[tuple[int, int, int]]]:
        if batch_id < 0:
            return None, []
        row = spark.read.schema(_CONTROL).parquet(self._state("control", batch_id)).first()
        return row["watermark"], [tuple(p) for p in row["parts"]]
