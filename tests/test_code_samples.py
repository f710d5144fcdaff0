import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ledgerloom.functions.text import SPACE_CHARS, code_length, strip_unicode
from ledgerloom.operators.generation import (
    BUG_TYPES,
    PLACEHOLDER,
    collect_samples,
    parse_responses,
    sample_plan,
)
from ledgerloom.operators.quality import (
    FLAGS,
    code_statistics,
    filter_counts,
    keep_passing,
    passing_samples,
    quality_flags,
    quality_report,
)
from ledgerloom.plans.code_data import analyse, filter_samples, ingest_responses
from ledgerloom.schemas import BASE_CODE, MERGED_CODE
from ledgerloom.sources.readers import batch_sizes, read_csv, read_dataset, read_splits, read_synthetic_batches
from ledgerloom.sources.writers import write_csv, write_splits

DOC = 'def add(a, b):\n    """Add two numbers."""\n    return a + b  #'.ljust(80, "x")
EXACT = "def f(x):\n    return x  #".ljust(50, "x")
SHORT = "def f(x):\n    return x  #".ljust(49, "x") + "\n" * 10 + "　"
BROKEN = "def f(:  #".ljust(60, "x")
ASSIGN = "value = 1  #".ljust(60, "x")
FAILED = PLACEHOLDER.format(sample_id=7)
NUL = DOC[:-1] + "\0"

# func -> syntax, min_length, is_function, docstring, passes
CASES = {
    DOC: (True, True, True, True, True),
    EXACT: (True, True, True, False, True),
    BROKEN: (False, True, True, False, False),
    ASSIGN: (True, True, False, False, False),
    FAILED: (True, True, True, False, True),
    NUL: (False, True, True, True, False),
    None: (False, False, False, False, False),
    "": (True, False, False, False, False),
    "(" * 5000: (False, True, False, False, False),
}


def code(spark, samples):
    return spark.createDataFrame([(s,) for s in samples], "func string")


def test_flags(spark):
    rows = quality_flags(code(spark, CASES)).collect()
    assert {r.func: tuple(r[f] for f in FLAGS) for r in rows} == CASES


def test_length_counts_after_a_unicode_strip(spark):
    assert quality_flags(code(spark, [SHORT])).first().min_length is False
    everything = "".join(chr(c) for c in range(0x110000) if chr(c).isspace())
    assert sorted(everything) == sorted(SPACE_CHARS)
    row = code(spark, [everything + "a ​ b" + everything]).select(strip_unicode(F.col("func"))).first()
    assert row[0] == "a ​ b"


def test_length_is_in_code_points(spark):
    assert code(spark, ["a😀é"]).select(code_length(F.col("func"))).first()[0] == 3


def test_kept_rows_are_the_same_either_way(spark):
    df = code(spark, CASES)
    kept = sorted(r.func for r in keep_passing(quality_flags(df)).collect())
    assert kept == sorted(r.func for r in passing_samples(df).collect()) == sorted([DOC, EXACT, FAILED])
    assert keep_passing(quality_flags(df)).columns == ["func"]


def test_python_sees_only_survivors_of_the_cheap_tests(spark, tmp_path):
    code(spark, CASES).write.parquet(f"{tmp_path}/c")
    plan = passing_samples(spark.read.parquet(f"{tmp_path}/c"))._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("ArrowEvalPython") :]
    assert "Contains(func" in below or "contains(func" in below.lower()


def test_report_and_statistics(spark):
    flagged = quality_flags(code(spark, [DOC, EXACT, BROKEN]))
    report = {r.metric: r["count"] for r in quality_report(flagged).collect()}
    assert report == {
        "Total Generated": 3.0,
        "Syntax Valid": 2.0,
        "Meets Min Length": 3.0,
        "Is Function": 3.0,
        "Has Docstring": 1.0,
        "Passed All Filters": 2.0,
        "Pass Rate (%)": 66.67,
    }
    assert filter_counts(flagged).first().pass_rate == pytest.approx(200 / 3)
    stats = code_statistics(flagged).first()
    assert tuple(stats) == (3, pytest.approx(190 / 3), 50, 80, 1)
    assert code_statistics(code(spark, [DOC])).first().samples_with_docstring == 0


def test_report_on_nothing_is_zero(spark):
    report = quality_report(quality_flags(code(spark, []))).collect()
    assert len(report) == 7 and all(r["count"] == 0 for r in report)


RESPONSES = [
    ("CODE:\nX\n\nBUG_TYPE: type error", "X", "type error"),
    ("CODE:\nX", "X", "unknown"),
    ("X", "X", "unknown"),
    ("CODE:\n```python\nX\n```", "X", "unknown"),
    ("```\nX```", "X", "unknown"),
    ("CODE: A CODE: B BUG_TYPE: t", "A", "unknown"),
    ("CODE: A BUG_TYPE: t CODE: B", "A", "t"),
    ("CODE: A BUG_TYPE: t BUG_TYPE: u", "A", "t"),
    ("BUG_TYPE: a\nCODE: X", "X", "unknown"),
    ("BUG_TYPE: a", "BUG_TYPE: a", "unknown"),
    ("CODE:", "", "unknown"),
    ("", "", "unknown"),
]


def test_responses(spark):
    df = spark.createDataFrame([(r[0],) for r in RESPONSES], "response string")
    found = {r.response: (r.code, r.bug_type) for r in parse_responses(df).collect()}
    assert found == {r: (c, t) for r, c, t in RESPONSES}


def test_short_code_is_marked_for_retry(spark):
    df = spark.createDataFrame([("CODE:" + "x" * n,) for n in (0, 49, 50)], "response string")
    assert {len(r.code): r.needs_retry for r in parse_responses(df).collect()} == {0: True, 49: True, 50: False}


def test_plan(spark):
    rows = sample_plan(spark).collect()
    assert sorted(r.sample_id for r in rows) == [b * 100 + i for b in range(5) for i in range(10)]
    assert {r.batch_id for r in rows} == set(range(5)) and {r.bug_type for r in rows} <= set(BUG_TYPES)
    assert all(r.user_prompt.count(r.bug_type) >= 2 and "{" not in r.user_prompt for r in rows)
    assert rows == sample_plan(spark).collect() != sample_plan(spark, seed=7).collect()
    many = sample_plan(spark, 100, 100)
    assert many.select("sample_id").distinct().count() == 10_000
    assert many.select("bug_type").distinct().count() == len(BUG_TYPES)
    with pytest.raises(ValueError):
        sample_plan(spark, 1, 101)


def test_samples_from_responses(spark):
    plan = sample_plan(spark, 1, 3)
    responses = spark.createDataFrame([(0, f"CODE:\n{DOC}\nBUG_TYPE: logic error"), (1, None)], "sample_id long, response string")
    rows = {r.sample_id: r for r in collect_samples(plan, responses).collect()}
    assert (rows[0].func, rows[0].bug_type, rows[0].source) == (DOC, "logic error", "synthetic_llm")
    for i in (1, 2):
        assert rows[i].func == f"# Failed to generate sample {i}\ndef placeholder():\n    pass"
        assert (rows[i].bug_type, rows[i].source, rows[i].target) == ("generation_failed", "synthetic_llm_failed", 1)


TRICKY = ['a\n"b",\r\nc', '"""doc"""', "back\\slash", "tab\t, comma", "ünï code", "'", "  kept  ", "\n lines \n\n", "a\rb", "a,\r"]


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(t, 1, "s") for t in TRICKY], MERGED_CODE)
    write_csv(df, f"{tmp_path}/t")
    assert sorted(r.func for r in read_csv(spark, f"{tmp_path}/t", MERGED_CODE).collect()) == sorted(TRICKY)


def test_exports_are_bounded_by_bytes(spark, tmp_path):
    df = spark.range(40).select(F.repeat(F.lit("x"), F.when(F.col("id") == 7, 900).otherwise(90).cast("int")).alias("func"))
    write_csv(df.coalesce(1), f"{tmp_path}/t", max_bytes=2000)
    sizes = [f.stat().st_size for f in (tmp_path / "t").glob("*.csv")]
    assert len(sizes) >= 20 and max(sizes) <= 2000


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_splits_on_disk(spark, tmp_path, fmt):
    df = spark.createDataFrame([(t, i % 2, s) for i, t in enumerate(TRICKY) for s in ("train", "test")], "func string, target int, split string")
    write_splits(df, f"{tmp_path}/s", fmt)
    assert read_splits(spark, f"{tmp_path}/s", fmt).count() == 2 * len(TRICKY)
    test = read_splits(spark, f"{tmp_path}/s", fmt, splits=["test"])
    assert sorted(r.func for r in test.collect()) == sorted(TRICKY)
    plan = test._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_batches(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_synthetic_batches(spark, f"{tmp_path}/none").count()
    responses = spark.createDataFrame([(0, f"CODE:\n{DOC}")], "sample_id long, response string")
    samples = ingest_responses(spark, responses, f"{tmp_path}/b", batches=3, samples_per_batch=4)
    back = read_synthetic_batches(spark, f"{tmp_path}/b")
    assert back.count() == samples.count() == 12
    assert {r.source_file: r.samples for r in batch_sizes(back).collect()} == {f"synthetic_batch={i}": 4 for i in range(3)}
    with open(tmp_path / "single.csv", "w") as f:
        f.write("func,target,bug_type,source,sample_id,batch_id\n\"x\ny\",true,t,s,1,9\n")
    (tmp_path / "files").mkdir()
    (tmp_path / "single.csv").rename(tmp_path / "files" / "synthetic_batch_9.csv")
    row = read_synthetic_batches(spark, f"{tmp_path}/files", "csv").first()
    assert (row.func, row.target, row.source_file) == ("x\ny", 1, "synthetic_batch_9.csv")


def test_filter_job(spark, tmp_path):
    responses = spark.createDataFrame([(0, f"CODE:\n{DOC}"), (1, f"CODE:\n{BROKEN}")], "sample_id long, response string")
    ingest_responses(spark, responses, f"{tmp_path}/b", batches=1, samples_per_batch=2)
    kept, report, stats = filter_samples(spark, f"{tmp_path}/b", f"{tmp_path}/kept", f"{tmp_path}/report")
    assert [r.sample_id for r in kept.collect()] == [0]
    assert {r.metric: r["count"] for r in report.collect()}["Pass Rate (%)"] == 50.0
    assert stats.first().total_samples == 2
    assert spark.read.option("header", True).csv(f"{tmp_path}/report").count() == 7


def test_analysis_job(spark, tmp_path):
    for split, n in (("train", 6), ("validation", 2), ("test", 3)):
        spark.createDataFrame([(DOC, str(i % 2)) for i in range(n)], BASE_CODE).write.parquet(f"{tmp_path}/{split}")
    paths = {s: f"{tmp_path}/{s}" for s in ("train", "validation", "test")}
    report, totals = analyse(spark, paths, f"{tmp_path}/base", f"{tmp_path}/report")
    rows = {r["split"]: r for r in report.collect()}
    assert tuple(rows["test"])[1:] == (3, 1, 2, 0.333, 80.0)
    assert tuple(totals.first()) == (11, 5, 6)
    assert read_splits(spark, f"{tmp_path}/base").count() == 11
    spark.createDataFrame([], BASE_CODE).write.parquet(f"{tmp_path}/empty")
    with pytest.raises(ValueError, match="Dataset is empty"):
        read_dataset(spark, {"train": f"{tmp_path}/empty"})
