"""Queries over the event stream."""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.catalog.inputs import (
    FEATURE_DOUBLES,
    FEATURES_SQL,
    LINES_SQL,
    TRANSACTIONS_SQL,
    VALID_SQL,
    sessions_sql,
    table,
    transaction_lines,
    transactions,
)
from ledgerloom.catalog.registry import micros, query, rounded
from ledgerloom.operators.datasets import label_rate
from ledgerloom.operators.deep_forest import fit_deep_forest
from ledgerloom.operators.parsing import copy_event_time, dead_letters, parse_transactions, valid_rows
from ledgerloom.operators.scoring import (
    THRESHOLD,
    apply_threshold,
    assembler,
    class_weights,
    fill_features,
    fit_forest,
    score_rows,
    score_with,
    with_route,
)
from ledgerloom.operators.sessions import (
    SESSION_FEATURES,
    assign_sessions,
    enrich_with_sessions,
    enrich_with_user_features,
    session_features,
    user_features,
)
from ledgerloom.operators.splitting import group_split, random_split
from ledgerloom.plans.fraud import run_batch, run_training, train
from ledgerloom.schemas import TRANSACTION
from ledgerloom.session import materialize, scratch_path
from ledgerloom.sources.commits import read_committed, stream_committed, write_committed
from ledgerloom.sources.readers import read_lines, read_transactions, stream_lines
from ledgerloom.sources.writers import json_rows, load_model
from ledgerloom.streaming.fraud import FraudStream
from ledgerloom.streaming.sessions import TOTALS, session_totals
from ledgerloom.streaming.stateful import session_feature_stream, use_rocksdb, without_repeats

HALF_HOUR, SIX_HOURS = 1800, 21_600
DAY_MICROS = 86_400_000_000


def _sessions(df: DataFrame) -> DataFrame:
    return rounded(df, *FEATURE_DOUBLES).select(
        "user_id", micros("session_start"), micros("session_end"), *SESSION_FEATURES
    )


def _sessions_oracle(gap: int, source: str = TRANSACTIONS_SQL) -> str:
    return f"""
    WITH {sessions_sql(source, gap)}
    SELECT user_id, epoch_us(min(event_time)) AS session_start_us,
           epoch_us(max(event_time)) + {gap * 1_000_000} AS session_end_us, {FEATURES_SQL}
    FROM marked GROUP BY user_id, session_no"""


@query("session_features", _sessions_oracle(HALF_HOUR))
def _(spark, sf_dir):
    return _sessions(session_features(transactions(spark, sf_dir)))


@query("session_features_long_gap", _sessions_oracle(SIX_HOURS))
def _(spark, sf_dir):
    return _sessions(session_features(transactions(spark, sf_dir), gap_seconds=SIX_HOURS))


MINUTES_SQL = f"SELECT * REPLACE (date_trunc('minute', event_time) AS event_time) FROM ({TRANSACTIONS_SQL})"


@query("session_exact_gap", _sessions_oracle(HALF_HOUR, MINUTES_SQL))
def _(spark, sf_dir):
    """On whole minutes many gaps are exactly half an hour, and many times are tied."""
    rows = transactions(spark, sf_dir)
    rows = rows.withColumn("event_time", F.date_trunc("minute", "event_time"))
    return _sessions(session_features(rows))


HOT_SQL = f"SELECT * REPLACE (CASE WHEN transaction_id % 3 = 0 THEN -1 ELSE user_id END AS user_id) FROM ({TRANSACTIONS_SQL})"


@query("session_hot_user", _sessions_oracle(SIX_HOURS, HOT_SQL))
def _(spark, sf_dir):
    """One user holds a third of all rows, and its cells are cut by many ranges."""
    rows = transactions(spark, sf_dir)
    hot = F.when(F.col("transaction_id") % 3 == 0, F.lit(-1).cast("long")).otherwise(F.col("user_id"))
    return _sessions(session_features(rows.withColumn("user_id", hot), gap_seconds=SIX_HOURS, slices=64))


CROWDED_SQL = f"""
    SELECT * REPLACE (CAST(transaction_id AS VARCHAR) AS location,
                      CASE WHEN transaction_id % 3 = 0 THEN -1 ELSE user_id END AS user_id,
                      CASE WHEN transaction_id % 3 = 0 AND transaction_id % 30 <> 0
                           THEN TIMESTAMP '2024-01-01' + to_seconds(transaction_id % 1700) ELSE event_time END AS event_time)
    FROM ({TRANSACTIONS_SQL})"""


@query("session_many_locations", _sessions_oracle(HALF_HOUR, CROWDED_SQL))
def _(spark, sf_dir):
    """One user holds a third of all rows, most of them within half an hour, and each is at a place of its own."""
    hot = F.col("transaction_id") % 3 == 0
    crowded = F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, transaction_id % 1700)")
    rows = transactions(spark, sf_dir).withColumns(
        {
            "location": F.col("transaction_id").cast("string"),
            "user_id": F.when(hot, F.lit(-1).cast("long")).otherwise(F.col("user_id")),
            "event_time": F.when(hot & (F.col("transaction_id") % 30 != 0), crowded).otherwise(F.col("event_time")),
        }
    )
    return _sessions(session_features(rows))


@query(
    "session_assignment",
    f"""WITH {sessions_sql(TRANSACTIONS_SQL, SIX_HOURS)}
    SELECT transaction_id, user_id, CAST(session_no AS BIGINT) AS session_no,
           epoch_us(min(event_time) OVER w) AS session_start_us,
           epoch_us(max(event_time) OVER w) + {SIX_HOURS * 1_000_000} AS session_end_us
    FROM tagged WINDOW w AS (PARTITION BY user_id, session_no)""",
)
def _(spark, sf_dir):
    rows = assign_sessions(transactions(spark, sf_dir), gap_seconds=SIX_HOURS)
    return rows.select("transaction_id", "user_id", "session_no", micros("session_start"), micros("session_end"))


def _enriched_oracle(source: str, gap: int, extra: str = "") -> str:
    return f"""
    WITH {sessions_sql(source, gap)},
    features AS (SELECT user_id, session_no, {FEATURES_SQL} FROM marked GROUP BY user_id, session_no)
    SELECT transaction_id, user_id, amount, merchant_category, location, {extra}
           {", ".join(SESSION_FEATURES)}
    FROM tagged JOIN features USING (user_id, session_no)"""


@query("session_enriched", _enriched_oracle(TRANSACTIONS_SQL, SIX_HOURS, "is_fraud,"))
def _(spark, sf_dir):
    rows = enrich_with_sessions(transactions(spark, sf_dir), gap_seconds=SIX_HOURS)
    return rounded(rows, *FEATURE_DOUBLES).drop("event_time")


# Every eleventh amount is missing.
GAPS_SQL = f"SELECT * REPLACE (CASE WHEN transaction_id % 11 > 0 THEN amount END AS amount) FROM ({TRANSACTIONS_SQL})"
TOTALS_SQL = f"""
    WITH {sessions_sql(GAPS_SQL, HALF_HOUR)}
    SELECT user_id, epoch_us(min(event_time)) AS session_start_us,
           epoch_us(max(event_time)) + {HALF_HOUR * 1_000_000} AS session_end_us,
           count(*) AS session_txn_count, round(coalesce(sum(amount), 0.0), 6) AS total_amount,
           round(avg(amount), 6) AS avg_amount, max(amount) AS max_amount,
           round(stddev_pop(amount), 6) AS amount_std,
           round(count(*) FILTER (amount > 1000) / count(*), 6) AS high_value_txn_ratio
    FROM tagged GROUP BY user_id, session_no"""


def _with_gaps(rows: DataFrame) -> DataFrame:
    return rows.withColumn("amount", F.when(F.col("transaction_id") % 11 > 0, F.col("amount")))


def _totals(sessions: DataFrame) -> DataFrame:
    return rounded(sessions, *FEATURE_DOUBLES).select("user_id", micros("session_start"), micros("session_end"), *TOTALS)


@query("session_window_totals", TOTALS_SQL)
def _(spark, sf_dir):
    return _totals(session_totals(_with_gaps(transactions(spark, sf_dir))))


USER_FEATURES_SQL = f"""
    rows AS ({TRANSACTIONS_SQL}),
    marked AS (
        SELECT *, CASE WHEN row_number() OVER w > 1 AND lag(location) OVER w IS DISTINCT FROM location
                       THEN 1 ELSE 0 END AS switched
        FROM rows WINDOW w AS (PARTITION BY user_id ORDER BY event_time, transaction_id)),
    features AS (
        SELECT user_id, count(amount) AS session_txn_count, round(sum(amount), 6) AS total_amount,
               round(avg(amount), 6) AS avg_amount, max(amount) AS max_amount,
               round(coalesce(stddev_samp(amount), 0.0), 6) AS amount_std,
               count(DISTINCT merchant_category) AS unique_categories,
               count(DISTINCT location) AS unique_locations,
               CAST(sum(switched) AS BIGINT) AS location_switches,
               round(avg(CASE WHEN amount > 1000 THEN 1.0 ELSE 0.0 END), 6) AS high_value_txn_ratio
        FROM marked GROUP BY user_id)"""


@query("user_features", f"WITH {USER_FEATURES_SQL} SELECT * FROM features")
def _(spark, sf_dir):
    return rounded(user_features(transactions(spark, sf_dir)), *FEATURE_DOUBLES)


@query("location_switches", f"WITH {USER_FEATURES_SQL} SELECT user_id, location_switches FROM features")
def _(spark, sf_dir):
    return user_features(transactions(spark, sf_dir)).select("user_id", "location_switches")


@query(
    "user_enriched",
    f"""WITH {USER_FEATURES_SQL}
    SELECT r.transaction_id, r.user_id, r.amount AS total_amount, f.total_amount AS total_amount_session,
           {", ".join(f"f.{c}" for c in SESSION_FEATURES if c != "total_amount")}
    FROM rows r JOIN features f USING (user_id)""",
)
def _(spark, sf_dir):
    """A column of the rows already has the name of a feature, so the feature gets the suffix."""
    rows = transactions(spark, sf_dir)
    left = rows.select("transaction_id", "user_id", F.col("amount").alias("total_amount"))
    joined = enrich_with_user_features(left, user_features(rows))
    return rounded(joined, "total_amount_session", *FEATURE_DOUBLES[1:])


@query(
    "parse_dead_letter",
    f"""WITH lines AS ({LINES_SQL})
    SELECT value, CASE kind WHEN 1 THEN 'missing required key' WHEN 3 THEN 'amount is not a number'
                            ELSE 'not a JSON object' END AS reason
    FROM lines WHERE kind <= 3""",
)
def _(spark, sf_dir):
    return dead_letters(parse_transactions(transaction_lines(spark, sf_dir)))


@query(
    "parse_valid",
    f"""SELECT transaction_id, user_id, amount, merchant_category, location, CASE WHEN kind = 7 THEN true END AS is_fraud,
               strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp", epoch_us(event_time) AS event_time_us,
               '{{"props":' || props || CASE kind WHEN 6 THEN ',"note":"last"' WHEN 8 THEN ',"note":"NaN"' ELSE '' END || '}}' AS extra
        FROM ({VALID_SQL})""",
)
def _(spark, sf_dir):
    rows = valid_rows(parse_transactions(transaction_lines(spark, sf_dir)))
    known = [f.name for f in TRANSACTION.fields]
    extra = F.to_json(F.map_filter("members", lambda k, v: ~k.isin(*known)))
    return rows.select(*known, F.unix_micros("event_time").alias("event_time_us"), extra.alias("extra"))


@query(
    "parse_status_drop_missing",
    f"""WITH lines AS ({LINES_SQL})
    SELECT CASE WHEN kind = 1 THEN 'dropped' WHEN kind <= 3 THEN 'dead_letter' ELSE 'valid' END AS parse_status,
           count(*) AS n
    FROM lines GROUP BY ALL""",
)
def _(spark, sf_dir):
    parsed = parse_transactions(transaction_lines(spark, sf_dir), on_missing="drop")
    return parsed.groupBy("parse_status").agg(F.count(F.lit(1)).alias("n"))


@query(
    "event_time_copied",
    f"""SELECT transaction_id, strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp",
               strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') AS event_time FROM ({VALID_SQL})""",
)
def _(spark, sf_dir):
    rows = valid_rows(parse_transactions(transaction_lines(spark, sf_dir)))
    return copy_event_time(rows.select("transaction_id", "timestamp"))


@query(
    "transactions_as_json",
    f"""SELECT '{{"transaction_id":"' || transaction_id || '","user_id":"' || user_id || '","amount":' ||
        regexp_replace(CAST(amount AS VARCHAR), '\\.0$', '') ||
        ',"merchant_category":"' || merchant_category || '","location":"' || location || '","timestamp":"' ||
        strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') || '","props":' || props ||
        CASE kind WHEN 4 THEN ',"is_fraud":1' WHEN 5 THEN ',"is_fraud":"yes"' WHEN 6 THEN ',"note":"last"'
                  WHEN 7 THEN ',"is_fraud":true' WHEN 8 THEN ',"note":"NaN"' ELSE '' END || ',"flagged":false}}' AS value
    FROM ({VALID_SQL})""",
)
def _(spark, sf_dir):
    """All members as they came: fields of another type with their value, absent ones absent."""
    rows = valid_rows(parse_transactions(transaction_lines(spark, sf_dir)))
    return json_rows(rows.select("members", F.lit(False).alias("flagged")))


@query(
    "transactions_typed_source",
    f"""SELECT CAST(transaction_id AS VARCHAR) AS transaction_id, CAST(user_id AS VARCHAR) AS user_id, amount,
               merchant_category, location, strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp", is_fraud
        FROM ({TRANSACTIONS_SQL})""",
)
def _(spark, sf_dir):
    path = scratch_path(spark, "transactions")
    _as_text_fields(spark, sf_dir).write.json(path)
    return read_transactions(spark, path)


def _as_text_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions(spark, sf_dir).select(
        F.col("transaction_id").cast("string").alias("transaction_id"),
        F.col("user_id").cast("string").alias("user_id"),
        "amount",
        "merchant_category",
        "location",
        F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        "is_fraud",
    )


@query("text_lines_source", f"SELECT value FROM ({LINES_SQL})")
def _(spark, sf_dir):
    path = scratch_path(spark, "lines")
    transaction_lines(spark, sf_dir).write.text(path)
    return read_lines(spark, path)


@query(
    "route_threshold",
    """WITH p AS (SELECT event_id, value / 137 AS p FROM events)
    SELECT event_id, round_even(p, 4) AS fraud_score, p > 0.7 AS fraud_predicted,
           CASE WHEN p > 0.7 THEN 'flagged' ELSE 'clean' END AS route FROM p""",
)
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", (F.col("value") / 137).alias("p"))
    return with_route(apply_threshold(rows, "p")).drop("p")


@query(
    "class_weights",
    """WITH n AS (SELECT event_type, count(*) AS n FROM events GROUP BY event_type)
    SELECT event_type, n, round(sum(n) OVER () / (count(*) OVER () * n), 9) AS weight FROM n""",
)
def _(spark, sf_dir):
    weights = class_weights(table(spark, sf_dir, "events"), "event_type")
    return rounded(weights, "weight", digits=9)


@query(
    "feature_vector",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN 0.0 ELSE value END AS amount,
              CAST(user_id AS DOUBLE) AS session_txn_count, CAST(0 AS DOUBLE) AS total_amount FROM events""",
)
def _(spark, sf_dir):
    """A missing value and an absent column both become 0 in the vector."""
    columns = ("amount", "session_txn_count", "total_amount")
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") != "error", F.col("value")).alias("amount"),
        F.col("user_id").alias("session_txn_count"),
    )
    vector = assembler(columns).transform(fill_features(rows, columns))
    values = vector_to_array("_features")
    return vector.select("event_id", *[values[i].alias(c) for i, c in enumerate(columns)])


@query(
    "label_rate",
    f"SELECT count(*) AS transactions, round(avg(CAST(is_fraud AS INT)), 9) AS positive_rate FROM ({TRANSACTIONS_SQL})",
)
def _(spark, sf_dir):
    return rounded(label_rate(transactions(spark, sf_dir)), "positive_rate", digits=9)


@query(
    "random_split_sizes",
    """WITH t AS (SELECT count(*) AS n, CAST(ceil(count(*) * 0.2 - 1e-9) AS BIGINT) AS test FROM events)
    SELECT 'train' AS split, n - test AS n FROM t UNION ALL SELECT 'test', test FROM t""",
)
def _(spark, sf_dir):
    split = random_split(table(spark, sf_dir, "events").select("event_id"), "event_id")
    return split.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query(
    "user_split_integrity",
    "SELECT user_id, 1::BIGINT AS sides, count(*) AS n FROM events GROUP BY user_id",
)
def _(spark, sf_dir):
    split = group_split(table(spark, sf_dir, "events").select("user_id"), "user_id")
    return split.groupBy("user_id").agg(
        F.count_distinct("split").alias("sides"), F.count(F.lit(1)).alias("n")
    )


def _report_checks(report: DataFrame) -> DataFrame:
    """What holds for any forest: one row of checks over the class report."""
    line = F.col("class")
    own, score = line.isin("0", "1"), ("precision", "recall", "f1_score")
    between = [F.min(F.when(F.col(c).isNull(), F.lit(True)).otherwise(F.col(c).between(0, 1))) for c in score]
    weighted = F.max(F.when(line == "weighted avg", F.col("recall")))
    accuracy = F.max(F.when(line == "accuracy", F.col("f1_score")))
    return report.agg(
        F.max(F.when(line == "accuracy", F.col("support"))).alias("support"),
        F.sum(F.when(own, F.col("support"))).alias("support_of_classes"),
        (F.abs(weighted - accuracy) < 1e-9).alias("recall_is_accuracy"),
        (between[0] & between[1] & between[2]).alias("in_range"),
        (accuracy > 0.5).alias("learns"),
    )


_REPORT_SQL = "true AS recall_is_accuracy, true AS in_range, true AS learns"


@query(
    "forest_report",
    f"""SELECT CAST(ceil(count(*) * 0.2 - 1e-9) AS BIGINT) AS support,
               CAST(ceil(count(*) * 0.2 - 1e-9) AS BIGINT) AS support_of_classes, {_REPORT_SQL} FROM events""",
)
def _(spark, sf_dir):
    """Forest on session features: the class report on the held-out fifth of the rows adds up."""
    return _report_checks(train(transactions(spark, sf_dir)).report)


@query("forest_report_user_grain", f"SELECT true AS same_support, {_REPORT_SQL}")
def _(spark, sf_dir):
    """Forest on user features with all rows of a user on one side."""
    checks = _report_checks(train(transactions(spark, sf_dir), grain="user", by_user=True).report)
    return checks.withColumn("same_support", F.col("support") == F.col("support_of_classes")).drop("support", "support_of_classes")


@query("deep_forest", """
    SELECT count(*) AS scored, true AS told_apart, true AS deeper, true AS at_least_as_good
    FROM events WHERE event_id % 5 = 0""")
def _(spark, sf_dir):
    """Trees grown to the end on a label that alternates along the amount: each leaf has one class or rows that are alike,
    trees are deeper than ten levels, and held-out rows are told at least as well as by ten levels."""
    alternating = F.col("rank") % 2 == 1
    ranked = transactions(spark, sf_dir).withColumn("rank", F.floor(F.log1p("amount") * 8).cast("long"))
    rows = materialize(enrich_with_sessions(ranked.withColumn("is_fraud", alternating)), "training")
    held_out = F.col("transaction_id") % 5 == 0
    learning = materialize(rows.where(~held_out), "learning")
    forest = fit_deep_forest(learning, trees=10, node_rows=5_000)
    shallow = fit_forest(learning, trees=10)

    tested = rows.where(held_out)
    right = F.count_if(F.col("fraud_predicted") == F.col("is_fraud"))
    mixed_leaves = F.expr("size(filter(arrays_zip(feature, share), n -> n.feature < 0 AND n.share > 0 AND n.share < 1))")
    parts = (
        forest.score(tested, 0.5).agg(F.count(F.lit(1)).alias("scored"), right.alias("deep"))
        .unionByName(score_rows(tested, shallow, 0.5).agg(right.alias("ten")), allowMissingColumns=True)
        .unionByName(
            forest.nodes.agg(F.every(mixed_leaves == F.col("mixed")).alias("told_apart"), (F.max("levels") > 10).alias("deeper")),
            allowMissingColumns=True,
        )
    )
    return parts.agg(
        F.max("scored").alias("scored"), F.every("told_apart").alias("told_apart"), F.every("deeper").alias("deeper"),
        (F.max("deep") >= F.max("ten")).alias("at_least_as_good"),
    )


@query(
    "scored_transactions",
    """SELECT event_id AS transaction_id, true AS in_range, true AS four_digits, true AS flag_agrees, true AS route_agrees
       FROM events""",
)
def _(spark, sf_dir):
    """Every transaction with its session features, score, flag and route, held against each other."""
    rows = materialize(enrich_with_sessions(transactions(spark, sf_dir)), "training")
    scored = with_route(score_rows(rows, fit_forest(rows)))
    score, flag = F.col("fraud_score"), F.col("fraud_predicted")
    return scored.select(
        "transaction_id",
        score.between(0, 1).alias("in_range"),
        (F.round(score, 4) == score).alias("four_digits"),
        F.when(flag, score >= THRESHOLD).otherwise(score <= THRESHOLD).alias("flag_agrees"),
        (F.col("route") == F.when(flag, "flagged").otherwise("clean")).alias("route_agrees"),
    )


@query(
    "scored_by_loaded_model",
    """WITH p AS (SELECT event_id, value / (value + 100) AS p FROM events)
    SELECT event_id AS transaction_id, round_even(p, 4) AS fraud_score, p > 0.7 AS fraud_predicted FROM p""",
)
def _(spark, sf_dir):
    """A model of another library, loaded once per task: here, the amount over itself plus 100."""

    def load():
        class Share:
            def predict_proba(self, frame):
                share = frame["amount"] / (frame["amount"] + 100)
                return list(zip(1 - share, share))

        return Share()

    scored = score_with(transactions(spark, sf_dir), load)
    return scored.select("transaction_id", "fraud_score", "fraud_predicted")


def _read_branches(spark: SparkSession, path: str, prefix: str = "") -> DataFrame:
    """Scored lines as typed columns; the sum of scores depends on the forest and is left out."""
    doubles = ", ".join(f"{c} double" for c in ("amount", *FEATURE_DOUBLES, "max_amount"))
    longs = ", ".join(f"{c} long" for c in SESSION_FEATURES if c not in (*FEATURE_DOUBLES, "max_amount"))
    schema = f"transaction_id string, user_id string, merchant_category string, location string, {doubles}, {longs}"
    lines = spark.read.option("basePath", path).text(f"{path}{prefix}")
    scored = lines.where(F.col("route").isin("flagged", "clean"))
    rows = scored.select(F.from_json("value", schema).alias("r")).select("r.*")
    return rounded(rows, *FEATURE_DOUBLES).select(
        "transaction_id", "user_id", "amount", "merchant_category", "location", *SESSION_FEATURES
    )


def _forest(spark: SparkSession, sf_dir: str):
    return fit_forest(materialize(enrich_with_sessions(transactions(spark, sf_dir)), "training"))


@query("fraud_batch_job", _enriched_oracle(VALID_SQL, HALF_HOUR))
def _(spark, sf_dir):
    """Text lines to files of flagged, clean and dead rows, read back without the scores."""
    lines, out = scratch_path(spark, "lines"), scratch_path(spark, "routed")
    transaction_lines(spark, sf_dir).write.text(lines)
    run_batch(spark, lines, _forest(spark, sf_dir), out)
    return _read_branches(spark, out)


@query("fraud_batch_branches", f"""
    WITH lines AS ({LINES_SQL})
    SELECT CASE WHEN kind <= 3 THEN 'dead_letters' ELSE 'scored' END AS branch, count(*) AS n FROM lines GROUP BY ALL""")
def _(spark, sf_dir):
    """Rows per branch of the batch job, with a model trained, saved and loaded again."""
    typed, model = scratch_path(spark, "typed"), scratch_path(spark, "model")
    lines, out = scratch_path(spark, "lines"), scratch_path(spark, "routed")
    _as_text_fields(spark, sf_dir).write.json(typed)
    run_training(spark, typed, model)
    transaction_lines(spark, sf_dir).write.text(lines)
    run_batch(spark, lines, load_model(model), out)
    branch = F.when(F.col("route") == "dead_letters", F.col("route")).otherwise("scored")
    return read_lines(spark, out).groupBy(branch.alias("branch")).agg(F.count(F.lit(1)).alias("n"))


def _parted(df: DataFrame, part: Column) -> DataFrame:
    """``value`` and ``part``, computed once and written by part."""
    path = scratch_path(df.sparkSession, "parted")
    df.select("value", part.cast("int").alias("part")).write.partitionBy("part").parquet(path)
    return df.sparkSession.read.schema("value string, part int").parquet(path)


def _deliver(lines: DataFrame, path: str) -> None:
    """Add lines to a folder that a stream reads, by as many tasks as there are."""
    lines.select("value").write.mode("append").text(path)


def _arriving(spark: SparkSession, sf_dir: str, late: bool) -> tuple[DataFrame, float]:
    """The lines with ``part``, the quarter of the time span with which they come, and a quarter in seconds. ``late``: every
    fiftieth line of the first quarter comes with the last."""
    rows = transaction_lines(spark, sf_dir).withColumn("t", F.regexp_extract("value", '"timestamp":"([^"]*)"', 1))
    first, last = table(spark, sf_dir, "events").agg(F.min("ts"), F.max("ts")).first()
    quarter = (last - first) / 4
    part = sum((F.col("t") >= (first + k * quarter).isoformat()).cast("int") for k in (1, 2, 3))
    if late:
        number = F.regexp_extract("value", '"transaction_id":"([^"]*)"', 1).cast("long")
        part = F.when((part == 0) & (number % 50 == 49), F.lit(3)).otherwise(part)
    return _parted(rows, part), quarter.total_seconds()


def _streamed(spark: SparkSession, sf_dir: str, late: bool, delay: float | None = None) -> str:
    """Each quarter is a micro-batch of all files that were delivered; the stream goes on from its checkpoint with the next."""
    out, state, source = (scratch_path(spark, p) for p in ("routed", "state", "lines"))
    lines, quarter = _arriving(spark, sf_dir, late)
    job = FraudStream(_forest(spark, sf_dir), out, state, delay_seconds=quarter if delay is None else delay)
    for k in range(4):
        _deliver(lines.where(F.col("part") == k), source)
        running = job.start(stream_lines(spark, source), availableNow=True)
        running.awaitTermination()
    job.finish(spark, running.lastProgress["batchId"])
    return out


@query("fraud_stream_job", _enriched_oracle(VALID_SQL, HALF_HOUR))
def _(spark, sf_dir):
    """The batch job as a stream of four micro-batches in order of time, drained at the end."""
    return _read_branches(spark, _streamed(spark, sf_dir, late=False))


@query("fraud_stream_branches", f"""
    WITH lines AS ({LINES_SQL}),
    span AS (SELECT min(ts) AS first, (max(ts) - min(ts)) / 4 AS quarter FROM events),
    timed AS (
        SELECT kind, ts, ts < first + quarter AND event_id % 50 = 49 AS delayed, ts < first + 3 * quarter AS early
        FROM lines JOIN events USING (event_id), span),
    reached AS (SELECT max(ts) - INTERVAL 1 HOUR AS mark FROM timed WHERE kind > 3 AND early AND NOT delayed),
    routed AS (
        SELECT CASE WHEN kind <= 3 THEN 'dead_letters' WHEN delayed AND ts + INTERVAL 30 MINUTE <= mark THEN 'late'
                    ELSE 'scored' END AS branch
        FROM timed, reached)
    SELECT branch, count(*) AS n FROM routed GROUP BY branch""")
def _(spark, sf_dir):
    """Rows per branch of the stream, with a watermark an hour behind and lines that come far too late."""
    lines = read_lines(spark, _streamed(spark, sf_dir, late=True, delay=3600))
    branch = F.when(F.col("route").isin("dead_letters", "late"), F.col("route")).otherwise("scored")
    return lines.groupBy(branch.alias("branch")).agg(F.count(F.lit(1)).alias("n"))


@query("stream_session_totals", TOTALS_SQL)
def _(spark, sf_dir):
    """Sessions of a stream of four micro-batches in order of time; a last event far ahead closes them all."""
    out, state = (scratch_path(spark, p) for p in ("closed", "state"))
    events = _with_gaps(transactions(spark, sf_dir)).select(
        "user_id", F.col("event_time").cast("timestamp").alias("event_time"), "amount"
    )
    first, last = events.agg(F.unix_micros(F.min("event_time")), F.unix_micros(F.max("event_time"))).first()
    part = F.least(F.lit(3), F.floor((F.unix_micros("event_time") - first) / ((last - first) / 4)))
    ahead = F.timestamp_micros(F.lit(last + 86_400_000_000)).alias("event_time")
    closing = spark.range(1).select(F.lit(-1).cast("long").alias("user_id"), ahead, F.lit(0.0).alias("amount"))
    deliveries = [*(events.where(part == k) for k in range(4)), closing]
    _deliver_each(lambda rows: session_totals(rows, delay="10 minutes"), deliveries, out, state, keyed=False)
    return _totals(spark.read.parquet(out).where("user_id >= 0"))


def _in_files(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, int, int]:
    """Events with ``part``, the quarter of the time span that they lie in, a row far ahead that closes all sessions, the beginning
    of the time span and the length of a quarter, both in microseconds."""
    events = transactions(spark, sf_dir).drop("is_fraud").withColumn("event_time", F.col("event_time").cast("timestamp"))
    first, last = events.agg(F.unix_micros(F.min("event_time")), F.unix_micros(F.max("event_time"))).first()
    quarter = (last - first) // 4 + 1
    ahead = events.limit(1).withColumns({
        "user_id": F.lit(-1).cast("long"), "transaction_id": F.lit(-1).cast("long"),
        "event_time": F.timestamp_micros(F.lit(last + 3 * quarter + 2 * DAY_MICROS)),
    })
    return events.withColumn("part", F.floor((F.unix_micros("event_time") - first) / quarter)), ahead, first, quarter


def _drain(stream: DataFrame, out: str, state: str, last: bool, keyed: bool) -> None:
    """Take what has arrived as one micro-batch; behind the last one, another closes what the watermark has passed by then.
    ``keyed``: the stream has keyed state in Python."""
    spark = stream.sparkSession
    more = "spark.sql.streaming.noDataMicroBatches.enabled"
    before, closing = use_rocksdb(spark) if keyed else None, spark.conf.get(more)
    spark.conf.set(more, str(last).lower())
    try:
        writer = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state)
        writer.trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(more, closing)
        if keyed:
            use_rocksdb(spark, before)


def _deliver_each(
    streamed: Callable[[DataFrame], DataFrame], deliveries: list[DataFrame], out: str, state: str, keyed: bool = True
) -> None:
    """Deliver events part after part, each by as many tasks as there are. Each is a micro-batch, behind which the query stops
    and goes on from its checkpoint with the next."""
    spark = deliveries[0].sparkSession
    source = scratch_path(spark, "events")
    for k, some in enumerate(deliveries, 1):
        rows = some.drop("part")
        rows.write.mode("append").parquet(source)
        _drain(streamed(spark.readStream.schema(rows.schema).parquet(source)), out, state, k == len(deliveries), keyed)


@query("stream_session_features", _sessions_oracle(HALF_HOUR))
def _(spark, sf_dir):
    """All nine features from keyed state: four deliveries of events, every fiftieth of which comes a delivery later, and with the
    last one events that are too late to count. The query is stopped after each and goes on from its checkpoint."""
    out, state = (scratch_path(spark, p) for p in ("closed", "state"))
    events, ahead, first, quarter = _in_files(spark, sf_dir)
    part = F.least(F.lit(3), F.when(F.col("transaction_id") % 50 == 49, F.col("part") + 1).otherwise(F.col("part")))
    parts = [events.where(part == k) for k in range(4)]
    too_late = events.where(F.unix_micros("event_time") < first + quarter // 2).withColumn("amount", F.lit(1e9))
    parts[3] = parts[3].unionByName(too_late)
    _deliver_each(lambda rows: session_feature_stream(rows, f"{quarter} microseconds"), [*parts, ahead], out, state)
    return _sessions(spark.read.parquet(out).where("user_id >= 0"))


@query("stream_deduplicated", _sessions_oracle(HALF_HOUR))
def _(spark, sf_dir):
    """Each event delivered twice, the second time with the next delivery: the sessions are those of events delivered once."""
    out, state = (scratch_path(spark, p) for p in ("closed", "state"))
    events, ahead, _, quarter = _in_files(spark, sf_dir)
    parts = [events.where(F.col("part").isin(k, k - 1)) for k in range(5)]

    def streamed(rows: DataFrame) -> DataFrame:
        return session_feature_stream(without_repeats(rows, f"{2 * quarter} microseconds"), None)

    _deliver_each(streamed, [*parts, ahead], out, state)
    return _sessions(spark.read.parquet(out).where("user_id >= 0"))


@query("branch_sink_commit", f"""
    WITH lines AS ({LINES_SQL})
    SELECT value, CASE WHEN kind <= 3 THEN 'dead_letter' ELSE 'valid' END AS route FROM lines""")
def _(spark, sf_dir):
    """Lines through the sink with commits. A batch job writes those of even events: it fails half-way, shows nothing, and is
    run again. A stream adds the others: it fails in its second micro-batch and goes on from its checkpoint."""
    source, out, state = (scratch_path(spark, p) for p in ("lines", "committed", "state"))
    lines = transaction_lines(spark, sf_dir).withColumn("id", F.regexp_extract("value", '"transaction_id":"([^"]*)"', 1).cast("long"))
    # 0 to 2: what comes in each micro-batch; 3: the batch job.
    lines = _parted(lines, F.when(F.col("id") % 2 == 0, F.lit(3)).when(F.col("id") % 2 == 1, F.col("id") % 3))

    def routed_lines(some: DataFrame) -> DataFrame:
        return parse_transactions(some.select("value")).select("value", F.col("parse_status").alias("route"))

    def fails(some: DataFrame, marked) -> DataFrame:
        return some.withColumn("value", F.when(marked, F.raise_error(F.lit("half-way"))).otherwise(F.col("value")))

    def attempt(action: Callable[[], object]) -> None:
        try:
            action()
        except (PySparkException, Py4JJavaError) as failure:
            if "half-way" not in str(failure):
                raise
        else:
            raise AssertionError("the job was to fail")

    even = routed_lines(lines.where("part = 3")).repartition(8)
    attempt(lambda: write_committed(fails(even, F.spark_partition_id() == 7), out, job="even"))
    if not read_committed(spark, out).isEmpty():
        raise AssertionError("lines of a failed job are shown")
    write_committed(even, out, job="even")

    _deliver(lines.where("part = 0"), source)
    odd = routed_lines(stream_lines(spark, source))
    second = F.regexp_extract("value", '"transaction_id":"([^"]*)"', 1).cast("long") % 3 == 1

    def drain(some: DataFrame) -> None:
        stream_committed(some, out, state).trigger(availableNow=True).start().awaitTermination()

    drain(fails(odd, second))
    _deliver(lines.where("part = 1"), source)
    attempt(lambda: drain(fails(odd, second)))
    _deliver(lines.where("part = 2"), source)
    drain(odd)
    return read_committed(spark, out)
