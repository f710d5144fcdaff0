"""Tokenised inputs, text classifier, and scoring that resumes where it stopped."""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed pattern: identifiers and numbers, or single other visible characters.
TOKEN_PATTERN = r"[A-Za-z0-9_]+|[^ \t\r\nA-Za-z0-9_]"
MAX_LENGTH = 512
VOCABULARY = 50_000
PAD_ID = 0


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), F.lit(0))


def tokenized_inputs(
    df: DataFrame, text: str = "func", max_length: int = MAX_LENGTH, vocabulary: int = VOCABULARY
) -> DataFrame:
    """Model inputs of a fixed length: token ids and mask, truncated and padded.

    Ids are hash buckets from 1 up; 0 is padding.
    """
    ids = F.transform(
        F.slice(tokens(F.coalesce(F.col(text), F.lit(""))), 1, max_length),
        lambda t: (F.pmod(F.xxhash64(t), F.lit(vocabulary - 1)) + 1).cast("int"),
    )

    def padded(values: Column, length: Column) -> Column:
        return F.concat(values, F.array_repeat(F.lit(PAD_ID), (max_length - length).cast("int")))

    used = F.size("_ids")
    return (
        df.withColumn("_ids", ids)
        .withColumn("input_ids", padded(F.col("_ids"), used))
        .withColumn("attention_mask", padded(F.array_repeat(F.lit(1), used), used))
        .drop("_ids")
    )


def model_inputs(df: DataFrame, text: str = "func", label: str = "target", max_length: int = MAX_LENGTH) -> DataFrame:
    """Just the columns a trainer reads, with the label under the name it expects."""
    return tokenized_inputs(df, text, max_length).withColumnRenamed(label, "labels").select(
        "input_ids", "attention_mask", "labels"
    )


def _pipeline(text: str, label: str, features: int, iterations: int) -> Pipeline:
    tokenizer = RegexTokenizer(
        inputCol=text, outputCol="_tokens", pattern=TOKEN_PATTERN, gaps=False, toLowercase=False
    )
    return Pipeline(
        stages=[
            tokenizer,
            HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=features),
            IDF(inputCol="_tf", outputCol="_features"),
            LogisticRegression(
                featuresCol="_features", labelCol=label, maxIter=iterations,
                probabilityCol="_probability", rawPredictionCol="_raw", predictionCol="_prediction",
            ),
        ]
    )


def log_loss(df: DataFrame, probability: Column, label: str) -> float:
    """Mean negative log-likelihood, by one aggregate."""
    p = F.greatest(F.lit(1e-15), F.least(probability, F.lit(1 - 1e-15)))
    loss = F.when(F.col(label) == 1, -F.log(p)).otherwise(-F.log(1 - p))
    return df.agg(F.avg(loss).alias("loss")).first()["loss"]


def fit_classifier(
    train: DataFrame,
    validation: DataFrame,
    text: str = "func",
    label: str = "target",
    features: int = 1 << 18,
    regularizations: Sequence[float] = (0.001, 0.01, 0.1),
    iterations: int = 30,
    parallelism: int = 4,
) -> PipelineModel:
    """Text classifier; the regularisation with the least validation loss wins.

    Token counts are the same for every candidate, so they are computed once per split.
    """
    def usable(df: DataFrame) -> DataFrame:
        rows = df.where(F.col(text).isNotNull() & F.col(label).isNotNull()).select(text, label)
        return rows.withColumn(label, F.col(label).cast("double"))

    stages = _pipeline(text, label, features, iterations).getStages()
    vectors = Pipeline(stages=stages[:-1]).fit(usable(train))
    seen = vectors.transform(usable(train)).select("_features", label).persist()
    held = vectors.transform(usable(validation)).select("_features", label).persist()

    def candidate(value: float) -> tuple[float, object]:
        fitted = stages[-1].copy({stages[-1].regParam: value}).fit(seen)
        loss = log_loss(fitted.transform(held), vector_to_array("_probability")[1], label)
        return float("inf") if loss is None else loss, fitted

    try:
        # Candidates share the executors: each is a row of short jobs that leaves them idle.
        with ThreadPool(min(parallelism, len(regularizations))) as pool:
            results = pool.map(inheritable_thread_target(train.sparkSession)(candidate), regularizations)
    finally:
        seen.unpersist()
        held.unpersist()
    best = min(results, key=lambda r: r[0])[1]
    return PipelineModel(stages=[*vectors.stages, best])


def classify(df: DataFrame, model: PipelineModel, text: str = "func") -> DataFrame:
    """Add ``prediction`` (the more likely class) and ``probability`` of class 1."""
    keep = [F.col(c) for c in df.columns]
    ready = df.withColumn("_text", F.col(text)).withColumn(text, F.coalesce(F.col(text), F.lit("")))
    scored = model.transform(ready).drop(text).withColumnRenamed("_text", text)
    return scored.select(
        *keep,
        F.col("_prediction").cast("int").alias("prediction"),
        vector_to_array("_probability")[1].alias("probability"),
    )
