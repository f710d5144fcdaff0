"""Plan of samples to request, and ingestion of the responses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.hashing import seeded_choice
from ledgerloom.functions.text import fill_template, response_code, response_type

# Bug types that can be asked for.
BUG_TYPES = (
    "off-by-one error",
    "null pointer / None reference",
    "type error",
    "logic error",
    "infinite loop",
    "index out of bounds",
)

# Prompt texts.
SYSTEM_PROMPT = """You are an expert Python programmer who generates code samples for educational purposes.
Your task is to create Python functions that contain subtle bugs for training bug detection models."""
USER_PROMPT = """Generate a Python function with exactly ONE subtle bug.

Bug type to include: {bug_type}

Requirements:
1. The function should be 10-30 lines long
2. Include ONE subtle bug of the specified type
3. The bug should be realistic (something a programmer might actually write)
4. Use clear variable names
5. Add a docstring

Format your response EXACTLY as:
CODE:
<your python function here>

BUG_TYPE: {bug_type}

Do not include any other text or explanations."""

# Ids per batch, the text of a failed sample, and the names of the sources.
IDS_PER_BATCH = 100
PLACEHOLDER = "# Failed to generate sample {sample_id}\ndef placeholder():\n    pass"
FAILED_TYPE = "generation_failed"
SOURCE_OK = "synthetic_llm"
SOURCE_FAILED = "synthetic_llm_failed"
MIN_RESPONSE_LENGTH = 50


def sample_plan(
    spark: SparkSession, batches: int = 5, samples_per_batch: int = 10, seed: int = 42
) -> DataFrame:
    """One row per sample to request: ids, bug type and prompts."""
    return plan_samples(spark.range(batches * samples_per_batch), "id", samples_per_batch, seed)


def plan_samples(rows: DataFrame, number: str, samples_per_batch: int = 10, seed: int = 42) -> DataFrame:
    """The same for a table that asks for a sample per row, numbered from 0 in column ``number``."""
    if not 1 <= samples_per_batch <= IDS_PER_BATCH:
        raise ValueError(f"samples_per_batch must be between 1 and {IDS_PER_BATCH}")
    batch = F.floor(F.col(number) / samples_per_batch)
    return (
        rows.select(
            (batch * IDS_PER_BATCH + F.col(number) % samples_per_batch).cast("long").alias("sample_id"),
            batch.cast("long").alias("batch_id"),
        )
        .withColumn("bug_type", seeded_choice(BUG_TYPES, seed, F.col("sample_id")))
        .withColumn("system_prompt", F.lit(SYSTEM_PROMPT))
        .withColumn("user_prompt", fill_template(USER_PROMPT, bug_type=F.col("bug_type")))
    )


def parse_responses(responses: DataFrame, response: str = "response") -> DataFrame:
    """Add ``code``, ``bug_type`` and ``needs_retry`` (no code, or too little of it)."""
    short = F.length("code") < MIN_RESPONSE_LENGTH
    return responses.withColumns(
        {"code": response_code(F.col(response)), "bug_type": response_type(F.col(response))}
    ).withColumn("needs_retry", F.coalesce(short, F.lit(False)))


def collect_samples(plan: DataFrame, responses: DataFrame) -> DataFrame:
    """Samples of a plan from the responses received; a missing response gives a placeholder.

    ``responses`` has one row per ``sample_id``.
    """
    received = plan.select("sample_id", "batch_id").join(responses, "sample_id", "left")
    parsed = parse_responses(received)
    failed = F.col("response").isNull()
    return parsed.select(
        F.when(failed, fill_template(PLACEHOLDER, sample_id=F.col("sample_id")))
        .otherwise(F.col("code"))
        .alias("func"),
        F.lit(1).alias("target"),
        F.when(failed, F.lit(FAILED_TYPE)).otherwise(F.col("bug_type")).alias("bug_type"),
        F.when(failed, F.lit(SOURCE_FAILED)).otherwise(F.lit(SOURCE_OK)).alias("source"),
        "sample_id",
        "batch_id",
        "needs_retry",
    )
