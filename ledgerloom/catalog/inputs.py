"""The supplied tables in the shape the operators expect, and the same shapes as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import small_batches


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as transactions."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("transaction_id"),
        "user_id",
        F.col("value").alias("amount"),
        F.col("event_type").alias("merchant_category"),
        F.get_json_object("props", "$.k").alias("location"),
        F.col("ts").alias("event_time"),
        (F.col("value") > 100).alias("is_fraud"),
    )


TRANSACTIONS_SQL = """
    SELECT event_id AS transaction_id, user_id, value AS amount, event_type AS merchant_category,
           props->>'$.k' AS location, ts AS event_time, value > 100 AS is_fraud
    FROM events"""


def sessions_sql(source: str, gap_seconds: int) -> str:
    """CTEs ``tagged`` (rows with session number) and ``marked`` (plus the switch flag)."""
    return f"""
    source AS ({source}),
    gaps AS (
        SELECT *, lag(event_time) OVER (PARTITION BY user_id ORDER BY event_time, transaction_id) AS before
        FROM source),
    tagged AS (
        SELECT *, sum(CASE WHEN before IS NULL OR epoch_us(event_time) - epoch_us(before) >= {gap_seconds * 1_000_000}
                           THEN 1 ELSE 0 END)
                  OVER (PARTITION BY user_id ORDER BY event_time, transaction_id ROWS UNBOUNDED PRECEDING) AS session_no
        FROM gaps),
    marked AS (
        SELECT *, CASE WHEN row_number() OVER w > 1 AND lag(location) OVER w IS DISTINCT FROM location
                       THEN 1 ELSE 0 END AS switched
        FROM tagged
        WINDOW w AS (PARTITION BY user_id, session_no ORDER BY event_time, transaction_id))"""


FEATURES_SQL = """
        count(*) AS session_txn_count,
        round(sum(amount), 6) AS total_amount,
        round(sum(amount) / count(*), 6) AS avg_amount,
        max(amount) AS max_amount,
        round(stddev_pop(amount), 6) AS amount_std,
        count(DISTINCT merchant_category) AS unique_categories,
        count(DISTINCT location) AS unique_locations,
        CAST(sum(switched) AS BIGINT) AS location_switches,
        round(avg(CASE WHEN amount > 1000 THEN 1.0 ELSE 0.0 END), 6) AS high_value_txn_ratio"""

FEATURE_DOUBLES = ("total_amount", "avg_amount", "amount_std", "high_value_txn_ratio")


def _quoted(column: Column) -> Column:
    return F.concat(F.lit('"'), column.cast("string"), F.lit('"'))


def transaction_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a line of text. By ``event_id % 28``, 0 cuts the line off, 1 leaves the amount out, 2 appends a
    second object, and 3 has an amount in quotes; 4, 5 and 7 have a label, of a wrong type but for the last; 6
    repeats a key, and 8 has a value that JSON does not know."""
    events = table(spark, sf_dir, "events")
    kind = F.col("event_id") % 28
    number = F.col("value").cast("string")
    amount = (
        F.when(kind == 1, F.lit(""))
        .when(kind == 3, F.concat(F.lit('"amount":"'), number, F.lit('",')))
        .otherwise(F.concat(F.lit('"amount":'), number, F.lit(",")))
    )
    more = (
        F.when(kind == 4, F.lit(',"is_fraud":1'))
        .when(kind == 5, F.lit(',"is_fraud":"yes"'))
        .when(kind == 6, F.lit(',"note":1,"note":"last"'))
        .when(kind == 7, F.lit(',"is_fraud":true'))
        .when(kind == 8, F.lit(',"note":NaN'))
        .otherwise(F.lit(""))
    )
    ending = F.when(kind == 0, F.lit("")).when(kind == 2, F.lit('}{"a":1}')).otherwise(F.lit("}"))
    line = F.concat(
        F.lit('{"transaction_id":'), _quoted(F.col("event_id")),
        F.lit(',"user_id":'), _quoted(F.col("user_id")), F.lit(","),
        amount,
        F.lit('"merchant_category":'), _quoted(F.col("event_type")),
        F.lit(',"location":'), _quoted(F.get_json_object("props", "$.k")),
        F.lit(',"timestamp":'), _quoted(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")),
        F.lit(',"props":'), F.col("props"),
        more,
        ending,
    )
    return events.select(line.alias("value"))


LINES_SQL = """
    SELECT event_id, event_id % 28 AS kind,
        '{"transaction_id":"' || event_id || '","user_id":"' || user_id || '",' ||
        CASE event_id % 28 WHEN 1 THEN '' WHEN 3 THEN '"amount":"' || value || '",'
                           ELSE '"amount":' || value || ',' END ||
        '"merchant_category":"' || event_type || '","location":"' || (props->>'$.k') ||
        '","timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '","props":' || props ||
        CASE event_id % 28 WHEN 4 THEN ',"is_fraud":1' WHEN 5 THEN ',"is_fraud":"yes"'
                           WHEN 6 THEN ',"note":1,"note":"last"' WHEN 7 THEN ',"is_fraud":true'
                           WHEN 8 THEN ',"note":NaN' ELSE '' END ||
        CASE event_id % 28 WHEN 0 THEN '' WHEN 2 THEN '}{"a":1}' ELSE '}' END AS value
    FROM events"""


# Valid rows of the lines above, as transactions.
VALID_SQL = """
    SELECT CAST(event_id AS VARCHAR) AS transaction_id, CAST(user_id AS VARCHAR) AS user_id, value AS amount,
           event_type AS merchant_category, props->>'$.k' AS location, ts AS event_time, event_id % 28 AS kind,
           replace(props, ' ', '') AS props
    FROM events WHERE event_id % 28 > 3"""


def code_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as code, its whole text behind ``#``. By ``doc_id % 4``: 0 is a function,
    1 has a broken header, 2 is no function, 3 is a function with a docstring. Their syntax is checked in Python, so
    the session sends few of them at a time."""
    small_batches(spark)
    documents = table(spark, sf_dir, "documents")
    kind, name = F.col("doc_id") % 4, F.col("doc_id").cast("string")
    head = (
        F.when(kind == 0, F.concat(F.lit("def f"), name, F.lit("():\n    return "), name))
        .when(kind == 1, F.concat(F.lit("def f"), name, F.lit("(:\n    return "), name))
        .when(kind == 2, F.concat(F.lit("v"), name, F.lit(" = "), name))
        .otherwise(F.concat(F.lit("def f"), name, F.lit('():\n    """Doc."""\n    return '), name))
    )
    commented = F.regexp_replace("text", "[\\r\\n]+", "\n# ")
    return documents.select(
        "doc_id", F.concat(head, F.lit("\n# "), commented).alias("func"), "source", (kind == 1).cast("int").alias("target")
    )


CODE_SQL = """
    SELECT doc_id, source, CASE WHEN doc_id % 4 = 1 THEN 1 ELSE 0 END AS target, doc_id % 4 <> 1 AS syntax_valid,
        CASE doc_id % 4
            WHEN 0 THEN 'def f' || doc_id || '():' || chr(10) || '    return ' || doc_id
            WHEN 1 THEN 'def f' || doc_id || '(:' || chr(10) || '    return ' || doc_id
            WHEN 2 THEN 'v' || doc_id || ' = ' || doc_id
            ELSE 'def f' || doc_id || '():' || chr(10) || '    ' || repeat('"', 3) || 'Doc.' || repeat('"', 3) || chr(10) || '    return ' || doc_id
        END || chr(10) || '# ' || regexp_replace(text, '[\\r\\n]+', chr(10) || '# ', 'g') AS func
    FROM documents"""

# The characters a Unicode-aware strip removes, as code points.
SPACE_CODES = (
    9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760,
    8192, 8193, 8194, 8195, 8196, 8197, 8198, 8199, 8200, 8201, 8202,
    8232, 8233, 8239, 8287, 12288,
)
SPACES_SQL = " || ".join(f"chr({c})" for c in SPACE_CODES)


def flags_sql() -> str:
    return f"""
    code AS ({CODE_SQL}),
    flags AS (
        SELECT doc_id, func, syntax_valid, length(trim(func, {SPACES_SQL})) >= 50 AS min_length,
               contains(func, 'def ') AS is_function,
               contains(func, repeat('"', 3)) OR contains(func, repeat(chr(39), 3)) AS has_docstring
        FROM code),
    judged AS (SELECT *, syntax_valid AND min_length AND is_function AS passes_filter FROM flags)"""


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a quality label; a rule on the id stands for a split that was given."""
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", F.col("text").alias("func"), "source", "n_chars"
    )
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("target"))
    return documents.join(labels, "doc_id").withColumn("split", _split(F.col("doc_id")))


def _split(doc_id: Column) -> Column:
    part = doc_id % 10
    return F.when(part == 0, "test").when(part == 1, "validation").otherwise("train")


LABELLED_SQL = """
    SELECT doc_id, text AS func, source, n_chars, quality AS target,
           CASE doc_id % 10 WHEN 0 THEN 'test' WHEN 1 THEN 'validation' ELSE 'train' END AS split
    FROM documents JOIN labels USING (doc_id)"""


def merged(spark: SparkSession, sf_dir: str):
    """Labelled documents as the base; the rest as synthetic samples, every fifth of them failed."""
    base = labelled(spark, sf_dir).select("doc_id", "func", "target")
    labels = table(spark, sf_dir, "labels").select("doc_id")
    synthetic = (
        table(spark, sf_dir, "documents")
        .join(labels, "doc_id", "left_anti")
        .select(
            "doc_id",
            F.col("text").alias("func"),
            F.lit(1).alias("target"),
            F.when(F.col("doc_id") % 5 == 0, "synthetic_llm_failed").otherwise("synthetic_llm").alias("source"),
        )
    )
    return base, synthetic


MERGED_SQL = """
    SELECT doc_id, text AS func, quality AS target, 'codexglue' AS source FROM documents JOIN labels USING (doc_id)
    UNION ALL
    SELECT doc_id, text, 1, 'synthetic_llm' FROM documents
    WHERE doc_id NOT IN (SELECT doc_id FROM labels) AND doc_id % 5 <> 0"""
