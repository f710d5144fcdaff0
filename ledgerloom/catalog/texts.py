"""Queries over labelled text and code samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.catalog.inputs import (
    CODE_SQL,
    LABELLED_SQL,
    MERGED_SQL,
    SPACES_SQL,
    code_samples,
    flags_sql,
    labelled,
    merged,
    table,
)
from ledgerloom.catalog.registry import query, rounded
from ledgerloom.functions.hashing import seeded_hash
from ledgerloom.functions.syntax import is_valid_python
from ledgerloom.operators.epochs import fit_epochs
from ledgerloom.operators.datasets import (
    analysis_totals,
    label_to_int,
    merge_sources,
    merge_summary,
    split_analysis,
    split_shares,
    split_statistics,
    statistics_totals,
)
from ledgerloom.operators.generation import (
    BUG_TYPES,
    SYSTEM_PROMPT,
    USER_PROMPT,
    collect_samples,
    parse_responses,
    plan_samples,
)
from ledgerloom.operators.metrics import (
    binary_metrics,
    class_report,
    compare_models,
    majority_class,
    predict_majority,
    verdict,
)
from ledgerloom.operators.quality import (
    code_statistics,
    filter_counts,
    keep_passing,
    passing_samples,
    quality_flags,
    quality_report,
    text_flags,
)
from ledgerloom.operators.splitting import (
    batch_number,
    content_key,
    number_rows,
    sample_rows,
    shuffle_rows,
    stratified_split,
)
from ledgerloom.operators.text_model import TOKEN_PATTERN, classify, fit_classifier, tokenized_inputs, tokens
from ledgerloom.plans.code_data import analyse, filter_samples, merge_and_split
from ledgerloom.session import materialize, scratch_path
from ledgerloom.sources.csv_blocks import read_csv_blocks
from ledgerloom.sources.readers import batch_sizes, read_csv, read_splits, read_synthetic_batches, read_table
from ledgerloom.sources.writers import write_batches, write_csv, write_predictions, write_splits

# --- quality filters ---


@query("syntax_valid", f"SELECT doc_id, syntax_valid FROM ({CODE_SQL})")
def _(spark, sf_dir):
    return code_samples(spark, sf_dir).select("doc_id", is_valid_python(F.col("func")).alias("syntax_valid"))


@query(
    "quality_flags_text",
    """SELECT doc_id, length(trim(text, """ + SPACES_SQL + """)) >= 50 AS min_length,
              contains(text, 'def ') AS is_function,
              contains(text, repeat('"', 3)) OR contains(text, repeat(chr(39), 3)) AS has_docstring
       FROM documents""",
)
def _(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("func"))
    return text_flags(documents).drop("func")


@query("quality_flags", f"WITH {flags_sql()} SELECT * EXCLUDE (func) FROM judged")
def _(spark, sf_dir):
    return quality_flags(code_samples(spark, sf_dir).select("doc_id", "func")).drop("func")


@query("quality_kept", f"WITH {flags_sql()} SELECT doc_id, func FROM judged WHERE passes_filter")
def _(spark, sf_dir):
    return keep_passing(quality_flags(code_samples(spark, sf_dir).select("doc_id", "func")))


@query("passing_samples", f"WITH {flags_sql()} SELECT doc_id, func FROM judged WHERE passes_filter")
def _(spark, sf_dir):
    return passing_samples(code_samples(spark, sf_dir).select("doc_id", "func"))


COUNTS_SQL = f"""
    WITH {flags_sql()},
    counts AS (
        SELECT count(*) AS total, count(*) FILTER (syntax_valid) AS syntax_valid,
               count(*) FILTER (min_length) AS min_length, count(*) FILTER (is_function) AS is_function,
               count(*) FILTER (has_docstring) AS has_docstring, count(*) FILTER (passes_filter) AS passes_filter
        FROM judged)"""


@query("filter_counts", f"{COUNTS_SQL} SELECT *, round(passes_filter / total * 100, 6) AS pass_rate FROM counts")
def _(spark, sf_dir):
    return rounded(filter_counts(quality_flags(code_samples(spark, sf_dir))), "pass_rate")


@query(
    "quality_report",
    f"""{COUNTS_SQL}
    SELECT 'Total Generated' AS metric, CAST(total AS DOUBLE) AS count FROM counts
    UNION ALL SELECT 'Syntax Valid', syntax_valid FROM counts
    UNION ALL SELECT 'Meets Min Length', min_length FROM counts
    UNION ALL SELECT 'Is Function', is_function FROM counts
    UNION ALL SELECT 'Has Docstring', has_docstring FROM counts
    UNION ALL SELECT 'Passed All Filters', passes_filter FROM counts
    UNION ALL SELECT 'Pass Rate (%)', round_even(passes_filter / total * 100, 2) FROM counts""",
)
def _(spark, sf_dir):
    return quality_report(quality_flags(code_samples(spark, sf_dir)))


@query(
    "code_statistics",
    f"""WITH {flags_sql()}
    SELECT count(*) AS total_samples, round(avg(length(func)), 6) AS avg_code_length,
           CAST(min(length(func)) AS INT) AS min_code_length, CAST(max(length(func)) AS INT) AS max_code_length,
           count(*) FILTER (has_docstring) AS samples_with_docstring
    FROM flags""",
)
def _(spark, sf_dir):
    return rounded(code_statistics(text_flags(code_samples(spark, sf_dir))), "avg_code_length")


# --- sources and sinks ---


@query("csv_round_trip", "SELECT doc_id, text, lang FROM documents")
def _(spark, sf_dir):
    path = scratch_path(spark, "csv")
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    write_csv(documents, path)
    return read_csv(spark, path, documents.schema)


@query("csv_parallel_read", "SELECT doc_id, text, lang FROM documents")
def _(spark, sf_dir):
    """Files of multi-line records, read in blocks of 256 KB by a task each."""
    path, setting = scratch_path(spark, "csv"), "spark.sql.files.maxPartitionBytes"
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    write_csv(documents, path)
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(1 << 18))
    try:
        return read_csv_blocks(spark, path, documents.schema)
    finally:
        spark.conf.set(setting, before)


@query("splits_round_trip", f"SELECT func, target, split FROM ({LABELLED_SQL})")
def _(spark, sf_dir):
    path = scratch_path(spark, "splits")
    write_splits(labelled(spark, sf_dir).select("func", "target", "split"), path)
    return read_splits(spark, path)


@query("csv_splits_round_trip", f"SELECT func, target, split FROM ({LABELLED_SQL})")
def _(spark, sf_dir):
    """The same as an export, in files of at most a megabyte."""
    path = scratch_path(spark, "splits")
    write_splits(labelled(spark, sf_dir).select("func", "target", "split"), path, "csv", max_bytes=1 << 20)
    return read_splits(spark, path, "csv")


@query(
    "synthetic_batches",
    """SELECT 'synthetic_batch=' || (doc_id % 5) AS source_file, count(*) AS samples FROM documents GROUP BY ALL""",
)
def _(spark, sf_dir):
    return batch_sizes(_written_batches(spark, sf_dir)[0])


def _written_batches(spark, sf_dir):
    path = scratch_path(spark, "batches")
    samples = code_samples(spark, sf_dir).select(
        "func",
        "target",
        F.lit("logic error").alias("bug_type"),
        F.lit("synthetic_llm").alias("source"),
        F.col("doc_id").alias("sample_id"),
        (F.col("doc_id") % 5).alias("batch_id"),
    )
    write_batches(samples, path)
    return read_synthetic_batches(spark, path), path


@query(
    "synthetic_batches_union",
    f"""SELECT func, target, 'logic error' AS bug_type, 'synthetic_llm' AS source, doc_id AS sample_id,
               doc_id % 5 AS batch_id, 'synthetic_batch=' || (doc_id % 5) AS source_file FROM ({CODE_SQL})""",
)
def _(spark, sf_dir):
    return _written_batches(spark, sf_dir)[0]


@query("filter_job", f"WITH {flags_sql()} SELECT doc_id AS sample_id, func FROM judged WHERE passes_filter")
def _(spark, sf_dir):
    """Batch files in, filtered file out, read back."""
    batches, path = _written_batches(spark, sf_dir)
    kept, report = scratch_path(spark, "kept"), scratch_path(spark, "report")
    filter_samples(spark, path, kept, report)
    return read_table(spark, kept, batches.select("sample_id", "func").schema)


# --- description, merge, split ---

ANALYSIS_SQL = f"""
    SELECT split, count(*) AS total_samples, CAST(sum(target) AS BIGINT) AS buggy_samples,
           count(*) - CAST(sum(target) AS BIGINT) AS clean_samples,
           round_even(sum(target) / count(*), 3) AS balance_ratio,
           round_even(avg(length(func)), 2) AS avg_code_length
    FROM ({LABELLED_SQL}) GROUP BY split"""


@query("split_analysis", ANALYSIS_SQL)
def _(spark, sf_dir):
    return split_analysis(labelled(spark, sf_dir))


@query(
    "analysis_totals",
    f"""SELECT CAST(sum(total_samples) AS BIGINT) AS total_samples, CAST(sum(buggy_samples) AS BIGINT) AS buggy_samples,
               CAST(sum(clean_samples) AS BIGINT) AS clean_samples FROM ({ANALYSIS_SQL})""",
)
def _(spark, sf_dir):
    return analysis_totals(split_analysis(labelled(spark, sf_dir)))


@query("analysis_job", ANALYSIS_SQL)
def _(spark, sf_dir):
    """Splits held as Parquet in, saved splits and report out."""
    source, base, report = (scratch_path(spark, p) for p in ("given", "base", "report"))
    labelled(spark, sf_dir).select("func", "target", "split").write.partitionBy("split").parquet(source)
    paths = {s: f"{source}/split={s}" for s in ("train", "validation", "test")}
    shape = analyse(spark, paths, base, report)[0].schema
    return read_csv(spark, report, shape)


@query("merge_union", f"SELECT func, target, source FROM ({MERGED_SQL})")
def _(spark, sf_dir):
    return merge_sources(*merged(spark, sf_dir))


@query(
    "merge_summary",
    f"""SELECT count(*) AS total_samples, count(*) FILTER (source = 'codexglue') AS base_samples,
               count(*) FILTER (source <> 'codexglue') AS synthetic_samples,
               CAST(sum(target) AS BIGINT) AS buggy_samples,
               count(*) - CAST(sum(target) AS BIGINT) AS clean_samples
        FROM ({MERGED_SQL})""",
)
def _(spark, sf_dir):
    return merge_summary(merge_sources(*merged(spark, sf_dir)))


def _with_given_split(spark, sf_dir) -> DataFrame:
    base, synthetic = merged(spark, sf_dir)
    rows = base.withColumn("source", F.lit("codexglue")).unionByName(
        synthetic.where(F.col("source") != "synthetic_llm_failed")
    )
    part = F.col("doc_id") % 10
    return rows.withColumn("split", F.when(part == 0, "test").when(part == 1, "validation").otherwise("train"))


STATS_SQL = f"""
    SELECT split, count(*) AS total_samples, CAST(sum(target) AS BIGINT) AS buggy_samples,
           count(*) - CAST(sum(target) AS BIGINT) AS clean_samples,
           round_even(sum(target) / count(*), 3) AS bug_ratio,
           count(*) FILTER (source = 'synthetic_llm') AS synthetic_samples,
           round_even(count(*) FILTER (source = 'synthetic_llm') / count(*) * 100, 2) AS synthetic_percentage
    FROM (SELECT *, CASE doc_id % 10 WHEN 0 THEN 'test' WHEN 1 THEN 'validation' ELSE 'train' END AS split
          FROM ({MERGED_SQL}))
    GROUP BY split"""


@query("split_statistics", STATS_SQL)
def _(spark, sf_dir):
    return split_statistics(_with_given_split(spark, sf_dir))


@query(
    "statistics_totals",
    f"""SELECT CAST(sum(total_samples) AS BIGINT) AS total_samples,
               CAST(sum(synthetic_samples) AS BIGINT) AS synthetic_samples,
               round_even(sum(synthetic_samples) / sum(total_samples) * 100, 2) AS synthetic_percentage,
               CAST(sum(total_samples) - sum(synthetic_samples) AS BIGINT) AS base_samples
        FROM ({STATS_SQL})""",
)
def _(spark, sf_dir):
    return statistics_totals(split_statistics(_with_given_split(spark, sf_dir)))


@query(
    "split_shares",
    f"""SELECT split, total_samples,
               round_even(total_samples / sum(total_samples) OVER () * 100, 1) AS percent_of_total, buggy_samples,
               round_even(buggy_samples / total_samples * 100, 1) AS percent_buggy, clean_samples
        FROM ({STATS_SQL})""",
)
def _(spark, sf_dir):
    return split_shares(split_statistics(_with_given_split(spark, sf_dir)))


def _quota_sql(counts: str, draws: str) -> str:
    """Largest-remainder shares of ``draws`` among the classes of ``counts`` (target, n)."""
    return f"""
        SELECT target, n, n * d // t + CASE WHEN row_number() OVER (ORDER BY n * d % t DESC, target)
                   <= d - sum(n * d // t) OVER () THEN 1 ELSE 0 END AS q
        FROM (SELECT target, n, CAST(sum(n) OVER () AS BIGINT) AS t, {draws} AS d FROM {counts})"""


SPLIT_SIZES_SQL = f"""
    WITH counts AS (SELECT target, count(*) AS n FROM ({MERGED_SQL}) GROUP BY target),
    total AS (SELECT CAST(sum(n) AS BIGINT) AS n, CAST(ceil(sum(n) * 0.2 - 1e-9) AS BIGINT) AS held FROM counts),
    train AS ({_quota_sql("counts", "(SELECT n - held FROM total)")}),
    rest AS (SELECT target, CAST(n - q AS BIGINT) AS n FROM train),
    validation AS ({_quota_sql("rest", "(SELECT held - (held + 1) // 2 FROM total)")})
    SELECT 'train' AS split, target, CAST(q AS BIGINT) AS n FROM train
    UNION ALL SELECT 'validation', target, CAST(q AS BIGINT) FROM validation
    UNION ALL SELECT 'test', target, CAST(n - q AS BIGINT) FROM validation"""


def _sizes(split: DataFrame) -> DataFrame:
    return split.groupBy("split", "target").agg(F.count(F.lit(1)).alias("n"))


@query("stratified_split_sizes", SPLIT_SIZES_SQL)
def _(spark, sf_dir):
    base, synthetic = merged(spark, sf_dir)
    rows = base.withColumn("source", F.lit("codexglue")).unionByName(
        synthetic.where(F.col("source") != "synthetic_llm_failed")
    )
    return _sizes(stratified_split(rows, "target", "doc_id"))


@query("merge_and_split_job", SPLIT_SIZES_SQL)
def _(spark, sf_dir):
    """Rows are known by what they hold, and copies by a number."""
    return _sizes(merge_and_split(*merged(spark, sf_dir))[0])


@query("row_keys", "SELECT count(*) AS n, count(*) AS keys FROM documents")
def _(spark, sf_dir):
    keyed = content_key(table(spark, sf_dir, "documents").select("text"), ["text"])
    return keyed.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("row_key").alias("keys"))


def _moved(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows, and how many of them are on another side in the second split."""
    sides = [df.groupBy(F.sha2("func", 256).alias("f"), "target", "source", "split").count() for df in (first, second)]
    both = sides[0].withColumnRenamed("count", "a").join(sides[1].withColumnRenamed("count", "b"), ["f", "target", "source", "split"], "full")
    a, b = F.coalesce("a", F.lit(0)), F.coalesce("b", F.lit(0))
    return both.agg(F.sum(a).alias("n"), F.sum(F.greatest(a - b, F.lit(0))).alias("moved"))


@query("split_is_repeatable", f"SELECT count(*) AS n, CAST(0 AS BIGINT) AS moved FROM ({MERGED_SQL})")
def _(spark, sf_dir):
    """The same rows, read from files written in another order: the seed alone decides."""
    base, synthetic = merged(spark, sf_dir)
    again = [materialize(df.orderBy(F.desc("doc_id")).repartition(3), "again") for df in (base, synthetic)]
    return _moved(merge_and_split(base, synthetic)[0], merge_and_split(*again)[0])


@query(
    "split_of_copies_is_repeatable",
    f"""SELECT count(*) AS n, CAST(0 AS BIGINT) AS moved
        FROM (SELECT unnest(range(0, 3)) FROM ({MERGED_SQL}) WHERE source = 'codexglue'
              UNION ALL SELECT 0 FROM ({MERGED_SQL}) WHERE source <> 'codexglue')""",
)
def _(spark, sf_dir):
    """Three copies of every base row, half of which hold one and the same text."""
    base, synthetic = merged(spark, sf_dir)
    text = F.when(F.col("doc_id") % 2 == 0, F.lit("def f():\n    pass")).otherwise(F.col("func"))
    base = base.withColumn("func", text).withColumn("copy", F.explode(F.array(*map(F.lit, range(3))))).drop("copy")
    again = materialize(base.orderBy(F.desc("doc_id")).repartition(5), "again")
    return _moved(merge_and_split(base, synthetic)[0], merge_and_split(again, synthetic)[0])


MANY_SQL = "SELECT event_id, user_id * 20 + event_id % 20 AS target FROM events"


@query("stratified_split_many_classes", f"""
    WITH counts AS (SELECT target, count(*) AS n FROM ({MANY_SQL}) GROUP BY target),
    total AS (SELECT CAST(sum(n) AS BIGINT) AS n, CAST(ceil(sum(n) * 0.2 - 1e-9) AS BIGINT) AS held FROM counts),
    train AS ({_quota_sql("counts", "(SELECT n - held FROM total)")}),
    rest AS (SELECT target, CAST(n - q AS BIGINT) AS n FROM train),
    validation AS ({_quota_sql("rest", "(SELECT held // 2 FROM total)")}),
    sizes AS (
        SELECT 'train' AS split, target, CAST(q AS BIGINT) AS n FROM train
        UNION ALL SELECT 'validation', target, CAST(q AS BIGINT) FROM validation
        UNION ALL SELECT 'test', target, CAST(n - q AS BIGINT) FROM validation)
    SELECT * FROM sizes WHERE n > 0""")
def _(spark, sf_dir):
    """A class for every user and remainder, far over a thousand."""
    rows = table(spark, sf_dir, "events").select("event_id", (F.col("user_id") * 20 + F.col("event_id") % 20).alias("target"))
    return _sizes(stratified_split(rows, "target", "event_id"))


@query(
    "sample_sizes",
    """WITH t AS (SELECT count(*) AS n FROM documents)
    SELECT 'few' AS sample, least(20, n) AS n, least(20, n) AS ids, least(20, n) AS again FROM t
    UNION ALL SELECT 'third', (n + 2) // 3, (n + 2) // 3, (n + 2) // 3 FROM t""",
)
def _(spark, sf_dir):
    """A fixed number of rows, and a third of them; the same rows again from the same rows in another order."""
    documents = table(spark, sf_dir, "documents").select("doc_id")
    third = -(-documents.count() // 3)
    samples = None
    for name, n in (("few", 20), ("third", third)):
        other = sample_rows(documents.orderBy(F.desc("doc_id")).repartition(3), n, "doc_id").withColumn("_again", F.lit(1))
        one = sample_rows(documents, n, "doc_id").join(other, "doc_id", "left").withColumn("sample", F.lit(name))
        samples = one if samples is None else samples.unionByName(one)
    return samples.groupBy("sample").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("ids"), F.count("_again").alias("again")
    )


@query("shuffled_rows", "SELECT doc_id, lang, true AS in_order FROM documents")
def _(spark, sf_dir):
    """Every row, and whether its seeded hash is at least that of the row before it."""
    shuffled = shuffle_rows(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")
    placed = materialize(
        shuffled.withColumns({
            "_part": F.spark_partition_id(), "_place": F.monotonically_increasing_id(),
            "_h": F.shiftrightunsigned(seeded_hash(42, F.col("doc_id")), 1),
        }),
        "shuffled",
    )
    # Neighbours are compared inside their partition; between partitions, of which there is a row each, only the edges.
    edges = placed.groupBy("_part").agg(F.max("_h").alias("_last"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    edges = edges.select("_part", F.max("_last").over(earlier).alias("_before"))
    before = F.coalesce(F.lag("_h").over(Window.partitionBy("_part").orderBy("_place")), F.col("_before"))
    return placed.join(edges, "_part").select("doc_id", "lang", F.coalesce(before <= F.col("_h"), F.lit(True)).alias("in_order"))


@query(
    "numbered_batches",
    """SELECT i // 50 + 1 AS batch_num, count(*) AS n, min(i) AS first_idx, max(i) AS last_idx
       FROM (SELECT unnest(range(0, (SELECT count(*) FROM documents))) AS i) GROUP BY ALL""",
)
def _(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id")
    numbered = number_rows(documents, "doc_id")
    return numbered.groupBy(batch_number(F.col("sample_idx"), 50).alias("batch_num")).agg(
        F.count(F.lit(1)).alias("n"), F.min("sample_idx").alias("first_idx"), F.max("sample_idx").alias("last_idx")
    )


# --- metrics ---

JUDGED_SQL = f"SELECT doc_id, target, CASE WHEN n_chars > 1500 THEN 1 ELSE 0 END AS prediction FROM ({LABELLED_SQL})"


def _judged(spark, sf_dir) -> DataFrame:
    """Labels against a rule on the length of the text."""
    rows = labelled(spark, sf_dir)
    return rows.select("doc_id", "target", (F.col("n_chars") > 1500).cast("int").alias("prediction"))


def _metrics_sql(source: str) -> str:
    return f"""
    SELECT unnest(['accuracy', 'precision', 'recall', 'f1_score']) AS metric,
           unnest([(tp + tn) / n, coalesce(tp / nullif(tp + fp, 0), 0), coalesce(tp / nullif(tp + fn, 0), 0),
                   coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)]) AS score
    FROM (SELECT count(*) AS n,
                 count(*) FILTER (target = 1 AND prediction = 1) AS tp,
                 count(*) FILTER (target = 0 AND prediction = 0) AS tn,
                 count(*) FILTER (target = 0 AND prediction = 1) AS fp,
                 count(*) FILTER (target = 1 AND prediction = 0) AS fn
          FROM ({source}))"""


MAJORITY_SQL = f"""
    SELECT target, (SELECT target FROM ({LABELLED_SQL}) GROUP BY target ORDER BY count(*) DESC, target LIMIT 1) AS prediction
    FROM ({LABELLED_SQL})"""


def _rounded_sql(sql: str, *columns: str) -> str:
    return f"SELECT * REPLACE ({', '.join(f'round({c}, 9) AS {c}' for c in columns)}) FROM ({sql})"


@query("binary_metrics", _rounded_sql(_metrics_sql(JUDGED_SQL), "score"))
def _(spark, sf_dir):
    return rounded(binary_metrics(_judged(spark, sf_dir), "target"), "score", digits=9)


@query("majority_class", f"SELECT target AS prediction FROM ({LABELLED_SQL}) GROUP BY target ORDER BY count(*) DESC, target LIMIT 1")
def _(spark, sf_dir):
    return majority_class(labelled(spark, sf_dir))


@query("majority_baseline", _rounded_sql(_metrics_sql(MAJORITY_SQL), "score"))
def _(spark, sf_dir):
    rows = labelled(spark, sf_dir).select("target")
    return rounded(binary_metrics(predict_majority(rows), "target"), "score", digits=9)


COMPARISON_SQL = f"""
    SELECT metric, m.score AS trained_model, b.score AS baseline, m.score - b.score AS improvement,
           round_even((m.score - b.score) / nullif(b.score, 0) * 100, 2) AS improvement_pct
    FROM ({_metrics_sql(JUDGED_SQL)}) m JOIN ({_metrics_sql(MAJORITY_SQL)}) b USING (metric)"""


def _comparison(spark, sf_dir) -> DataFrame:
    rows = _judged(spark, sf_dir)
    baseline = binary_metrics(predict_majority(rows.select("target")), "target")
    return compare_models(binary_metrics(rows, "target"), baseline)


@query("model_comparison", _rounded_sql(COMPARISON_SQL, "trained_model", "baseline", "improvement"))
def _(spark, sf_dir):
    return rounded(_comparison(spark, sf_dir), "trained_model", "baseline", "improvement", digits=9)


@query(
    "verdict",
    f"""SELECT metric, round(improvement, 9) AS improvement,
               CASE WHEN improvement > 0.05 THEN 'significant' WHEN improvement > 0 THEN 'modest'
                    ELSE 'similar' END AS verdict
        FROM ({COMPARISON_SQL}) WHERE metric IN ('f1_score', 'accuracy')""",
)
def _(spark, sf_dir):
    comparison = _comparison(spark, sf_dir)
    both = verdict(comparison).unionByName(verdict(comparison, "accuracy"))
    return rounded(both, "improvement", digits=9)


@query(
    "class_report",
    f"""WITH judged AS ({JUDGED_SQL}),
    per_class AS (
        SELECT c, count(*) FILTER (target = c) AS support,
               coalesce(count(*) FILTER (target = c AND prediction = c) / nullif(count(*) FILTER (prediction = c), 0), 0) AS p,
               coalesce(count(*) FILTER (target = c AND prediction = c) / nullif(count(*) FILTER (target = c), 0), 0) AS r
        FROM judged, (VALUES (0), (1)) v(c) GROUP BY c),
    scored AS (SELECT *, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f FROM per_class)
    SELECT CAST(c AS VARCHAR) AS class, round(p, 9) AS precision, round(r, 9) AS recall, round(f, 9) AS f1_score, support FROM scored
    UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(r * support) / sum(support), 9), CAST(sum(support) AS BIGINT) FROM scored
    UNION ALL SELECT 'macro avg', round(avg(p), 9), round(avg(r), 9), round(avg(f), 9), CAST(sum(support) AS BIGINT) FROM scored
    UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 9), round(sum(r * support) / sum(support), 9),
        round(sum(f * support) / sum(support), 9), CAST(sum(support) AS BIGINT) FROM scored""",
)
def _(spark, sf_dir):
    report = class_report(_judged(spark, sf_dir), "target")
    return rounded(report, "precision", "recall", "f1_score", digits=9)


# --- sample plan and responses ---


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


@query(
    "sample_plan",
    f"""SELECT doc_id // 10 * 100 + doc_id % 10 AS sample_id, doc_id // 10 AS batch_id, true AS known_type,
               {_sql_text(SYSTEM_PROMPT)} AS system_prompt, {_sql_text(USER_PROMPT)} AS template
        FROM documents""",
)
def _(spark, sf_dir):
    """A sample for every document. The bug type is drawn by hash; without it the prompt is the template."""
    plan = plan_samples(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 10)
    return plan.select(
        "sample_id",
        "batch_id",
        F.col("bug_type").isin(*BUG_TYPES).alias("known_type"),
        "system_prompt",
        F.replace("user_prompt", "bug_type", F.lit("{bug_type}")).alias("template"),
    )


def _responses(spark, sf_dir) -> DataFrame:
    """A response per document around its whole text, in each of the forms that occur."""
    text, kind = F.col("text"), F.col("doc_id") % 6
    response = (
        F.when(kind == 0, F.concat(F.lit("CODE:\n"), text, F.lit("\n\nBUG_TYPE: type error")))
        .when(kind == 1, F.concat(F.lit("CODE:\n"), text))
        .when(kind == 2, text)
        .when(kind == 3, F.concat(F.lit("CODE:\n```python\n"), text, F.lit("\n```")))
        .when(kind == 4, F.concat(F.lit("BUG_TYPE: a\nCODE: "), text))
    )
    sample_id = F.floor(F.col("doc_id") / 10) * 100 + F.col("doc_id") % 10
    return table(spark, sf_dir, "documents").select(sample_id.alias("sample_id"), response.alias("response"))


RESPONSES_SQL = """
    SELECT doc_id // 10 * 100 + doc_id % 10 AS sample_id, doc_id // 10 AS batch_id,
        CASE doc_id % 6 WHEN 0 THEN 'CODE:' || chr(10) || text || chr(10) || chr(10) || 'BUG_TYPE: type error'
            WHEN 1 THEN 'CODE:' || chr(10) || text WHEN 2 THEN text
            WHEN 3 THEN 'CODE:' || chr(10) || '```python' || chr(10) || text || chr(10) || '```'
            WHEN 4 THEN 'BUG_TYPE: a' || chr(10) || 'CODE: ' || text END AS response
    FROM documents"""

PARSED_SQL = f"""
    SELECT sample_id, batch_id, response,
        trim(replace(replace(CASE WHEN contains(response, 'CODE:')
                                  THEN split_part(split_part(response, 'CODE:', 2), 'BUG_TYPE:', 1)
                                  ELSE response END, '```python', ''), '```', ''), {SPACES_SQL}) AS code,
        CASE WHEN contains(response, 'CODE:') AND contains(split_part(response, 'CODE:', 2), 'BUG_TYPE:')
             THEN trim(split_part(split_part(response, 'CODE:', 2), 'BUG_TYPE:', 2), {SPACES_SQL})
             WHEN response IS NOT NULL THEN 'unknown' END AS bug_type
    FROM ({RESPONSES_SQL})"""


@query(
    "responses_parsed",
    f"""SELECT sample_id, code, bug_type, coalesce(length(code) < 50, false) AS needs_retry FROM ({PARSED_SQL})""",
)
def _(spark, sf_dir):
    return parse_responses(_responses(spark, sf_dir)).drop("response")


@query(
    "samples_collected",
    f"""SELECT CASE WHEN response IS NULL THEN '# Failed to generate sample ' || sample_id || chr(10) ||
                    'def placeholder():' || chr(10) || '    pass' ELSE code END AS func,
               1 AS target, CASE WHEN response IS NULL THEN 'generation_failed' ELSE bug_type END AS bug_type,
               CASE WHEN response IS NULL THEN 'synthetic_llm_failed' ELSE 'synthetic_llm' END AS source,
               sample_id, batch_id, coalesce(length(code) < 50, false) AS needs_retry
        FROM ({PARSED_SQL})""",
)
def _(spark, sf_dir):
    plan = plan_samples(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 10)
    return collect_samples(plan, _responses(spark, sf_dir))


# --- text model ---


@query(
    "tokenized_inputs",
    f"""WITH t AS (SELECT doc_id, regexp_extract_all(text, '{TOKEN_PATTERN}')[:512] AS tokens FROM documents)
    SELECT doc_id, 512 AS length, CAST(len(tokens) AS INT) AS used, repeat('1', len(tokens)) || repeat('0', 512 - len(tokens)) AS mask,
           true AS ids_where_masked, true AS equal_tokens_equal_ids
    FROM t""",
)
def _(spark, sf_dir):
    """Lengths, the place of the padding, and ids that follow from the tokens."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = tokenized_inputs(documents, "text").withColumn("_tokens", F.slice(tokens(F.col("text")), 1, 512))
    ids, mask = F.col("input_ids"), F.col("attention_mask")
    used = F.aggregate(mask, F.lit(0), lambda total, x: total + x)
    # As strings, since distinct structs are found by comparing all pairs.
    pairs = F.zip_with("_tokens", F.slice(ids, F.lit(1), F.size("_tokens")), lambda t, i: F.concat(i.cast("string"), F.lit(" "), t))
    return rows.select(
        "doc_id",
        F.size(ids).alias("length"),
        used.alias("used"),
        F.array_join(F.transform(mask, lambda m: m.cast("string")), "").alias("mask"),
        F.forall(F.zip_with(ids, mask, lambda i, m: (i > 0) == (m == 1)), lambda ok: ok).alias("ids_where_masked"),
        (F.size(F.array_distinct(pairs)) == F.size(F.array_distinct("_tokens"))).alias("equal_tokens_equal_ids"),
    )


@query(
    "text_classifier",
    f"SELECT doc_id, target, true AS in_range, true AS likelier_class, CAST((SELECT count(*) FROM ({LABELLED_SQL})) AS BIGINT) AS n FROM ({LABELLED_SQL})",
)
def _(spark, sf_dir):
    """Fit on the train split, choose by validation loss, classify every labelled document."""
    rows = materialize(labelled(spark, sf_dir), "labelled")
    model = fit_classifier(rows.where(F.col("split") == "train"), rows.where(F.col("split") == "validation"))
    p = F.col("probability")
    return classify(rows.select("doc_id", "func", "target"), model).select(
        "doc_id",
        "target",
        p.between(0, 1).alias("in_range"),
        (F.col("prediction") == (p > 0.5).cast("int")).alias("likelier_class"),
        rows.agg(F.count(F.lit(1))).scalar().alias("n"),
    )


@query(
    "classifier_epochs",
    f"""SELECT split, count(*) AS n, true AS no_worse_than_the_share, true AS resumed_as_unbroken, true AS better_than_the_majority
        FROM ({LABELLED_SQL}) GROUP BY split""",
)
def _(spark, sf_dir):
    """Five epochs at once, and three with two more later, on rows dealt to other tasks: the same weights, and better than the
    share of the classes."""
    rows = materialize(labelled(spark, sf_dir).select("doc_id", "func", "target", "split"), "labelled")
    train, validation = (rows.where(F.col("split") == s) for s in ("train", "validation"))
    whole, broken = scratch_path(spark, "epochs"), scratch_path(spark, "epochs")
    model = fit_epochs(train, validation, whole, 5)
    fit_epochs(train, validation, broken, 3)
    resumed = fit_epochs(train.repartition("doc_id"), validation, broken, 5)
    loss = {r["epoch"]: r["loss"] for r in model.losses.collect()}
    same = model.epoch == resumed.epoch and bool(abs(model.weights - resumed.weights).max() < 1e-9)
    right = F.avg((F.col("prediction") == F.col("target")).cast("int"))
    majority = F.greatest(F.avg("target"), 1 - F.avg("target"))
    tested = model.classify(rows.where(F.col("split") == "test")).agg((right > majority).alias("better")).scalar()
    return rows.groupBy("split").agg(F.count(F.lit(1)).alias("n")).select(
        "split", "n", F.lit(loss[model.epoch] <= loss[0]).alias("no_worse_than_the_share"), F.lit(same).alias("resumed_as_unbroken"),
        tested.alias("better_than_the_majority"),
    )


@query(
    "resumed_predictions",
    f"SELECT target AS true_label, prediction, count(*) AS n, true AS in_batches_of_5 FROM ({JUDGED_SQL}) GROUP BY ALL",
)
def _(spark, sf_dir):
    """A first run over half of the rows, a second over all: nothing is scored twice or missed."""
    rows, path = _judged(spark, sf_dir).select("doc_id", "target"), scratch_path(spark, "predictions")
    texts = table(spark, sf_dir, "documents").select("doc_id", "n_chars")

    def predict(df: DataFrame) -> DataFrame:
        return df.join(texts, "doc_id").withColumn("prediction", (F.col("n_chars") > 1500).cast("int"))

    def interrupted(df: DataFrame) -> DataFrame:
        return predict(df).where(F.col("sample_idx") < total // 2)

    total = rows.count()
    write_predictions(rows, interrupted, path, "doc_id")
    done = write_predictions(rows, predict, path, "doc_id")
    place = F.col("batch_num") == F.floor(F.col("sample_idx") / 5) + 1
    return done.groupBy("true_label", "prediction").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("in_batches_of_5"))


@query("labels_normalised", "SELECT doc_id, quality FROM labels")
def _(spark, sf_dir):
    """Labels written as 0, 1, true and false are read as integers."""
    label = F.col("quality")
    text = F.when(F.col("doc_id") % 2 == 0, label.cast("string")).otherwise((label == 1).cast("string"))
    labels = table(spark, sf_dir, "labels")
    return labels.select("doc_id", label_to_int(text).alias("quality"))
