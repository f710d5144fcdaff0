"""Feature vector, random forest, score, threshold and route."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.numeric import round_even
from ledgerloom.operators.sessions import SESSION_FEATURES
from ledgerloom.session import materialize

# The order of the model's inputs, and the flag threshold.
FEATURES = ("amount", *SESSION_FEATURES)
THRESHOLD = 0.7

FLAGGED = "flagged"
CLEAN = "clean"


def fill_features(df: DataFrame, columns=FEATURES) -> DataFrame:
    """Every feature as a double; an absent column or a missing value counts as 0."""
    def value(name: str) -> Column:
        if name not in df.columns:
            return F.lit(0.0)
        number = F.col(name).cast("double")
        return F.coalesce(F.nanvl(number, F.lit(0.0)), F.lit(0.0))

    return df.withColumns({f"_f_{c}": value(c) for c in columns})


def assembler(columns=FEATURES) -> VectorAssembler:
    return VectorAssembler(inputCols=[f"_f_{c}" for c in columns], outputCol="_features")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Rows and balanced weight per class: all rows / (classes * rows of the class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    rows = counts.agg(F.sum("n")).scalar()
    classes = counts.agg(F.count(F.lit(1))).scalar()
    return counts.select(label, "n", (rows / (classes * F.col("n"))).alias("weight"))


def with_class_weight(df: DataFrame, label: str) -> DataFrame:
    """Rows with the balanced weight of their class.

    The weights are written first, so that Spark knows how few they are and broadcasts them; with very
    many classes it joins on the label instead.
    """
    weights = materialize(class_weights(df, label).select(F.col(label).alias("_wl"), "weight"), "weights")
    return df.join(weights, F.col(label).eqNullSafe(F.col("_wl"))).drop("_wl")


def fit_forest(
    df: DataFrame, label: str = "is_fraud", trees: int = 100, depth: int = 10, seed: int = 42, columns=FEATURES, bins: int = 32
) -> PipelineModel:
    """Balanced random forest on the feature columns of ``df``: 100 trees of at most 10 levels, each feature cut into ``bins``.

    A forest of fully grown trees has no bound on its size; ten features are told apart well before.

    Training reads ``df`` several times, so hand in a written table, not a long lineage. Its narrow rows are dealt evenly to as
    many parts as there are cores and kept on the executors' disks meanwhile: a file's rows may be many times another's, and
    every part sends the counts of all nodes of a level.
    """
    labelled = df.where(F.col(label).isNotNull()).withColumn("_label", F.col(label).cast("int").cast("double"))
    weighted = with_class_weight(fill_features(labelled, columns), "_label")
    narrow = weighted.select("_label", "weight", *[f"_f_{c}" for c in columns])
    training = narrow.repartition(df.sparkSession.sparkContext.defaultParallelism).persist(StorageLevel.DISK_ONLY)
    forest = RandomForestClassifier(
        featuresCol="_features",
        labelCol="_label",
        weightCol="weight",
        numTrees=trees,
        maxDepth=depth,
        maxBins=bins,
        seed=seed,
        probabilityCol="_probability",
        rawPredictionCol="_raw",
        predictionCol="_prediction",
    )
    try:
        return Pipeline(stages=[assembler(columns), forest]).fit(training)
    finally:
        training.unpersist()


def score_rows(df: DataFrame, model: PipelineModel, threshold: float = THRESHOLD, columns=FEATURES) -> DataFrame:
    """Add ``fraud_score`` and ``fraud_predicted``; the model is broadcast once by Spark."""
    scored = model.transform(fill_features(df, columns))
    return apply_threshold(
        scored.withColumn("_p", vector_to_array("_probability")[1]), "_p", threshold
    ).select(*df.columns, "fraud_score", "fraud_predicted")


def score_with(
    df: DataFrame, load: Callable[[], object], threshold: float = THRESHOLD, columns=FEATURES
) -> DataFrame:
    """Score with a model of another library.

    ``load`` returns an object with ``predict_proba`` over a pandas frame of ``columns``. It is
    called once per task, and the model is applied to whole Arrow batches.
    """
    columns = list(columns)

    def probabilities(batches):
        import pandas as pd

        model = load()
        for batch in batches:
            frame = pd.DataFrame(dict(zip(columns, batch)))
            yield pd.Series([float(p[1]) for p in model.predict_proba(frame)])

    probabilities.__annotations__ = {
        "batches": Iterator[tuple[pd.Series, ...]],
        "return": Iterator[pd.Series],
    }
    probability = F.pandas_udf(probabilities, returnType=T.DoubleType())
    scored = fill_features(df, columns).withColumn("_p", probability(*[f"_f_{c}" for c in columns]))
    return apply_threshold(scored, "_p", threshold).select(*df.columns, "fraud_score", "fraud_predicted")


def apply_threshold(df: DataFrame, probability: str, threshold: float = THRESHOLD) -> DataFrame:
    """Flag on the unrounded probability, strictly above the threshold; round only what is shown."""
    return df.withColumns(
        {
            "fraud_score": round_even(F.col(probability), 4),
            "fraud_predicted": F.col(probability) > F.lit(threshold),
        }
    )


def with_route(scored: DataFrame) -> DataFrame:
    """Name the branch of every row."""
    return scored.withColumn("route", F.when(F.col("fraud_predicted"), FLAGGED).otherwise(CLEAN))


def routed(scored: DataFrame, route: str) -> DataFrame:
    """One branch."""
    return with_route(scored).where(F.col("route") == route).drop("route")
