"""A text classifier trained epoch by epoch, with a checkpoint after each and the best one kept.

Words are hashed to ``buckets`` weights of a logistic model. In an epoch each part of the training rows, of about
``part_rows`` rows, goes in seeded order through mini-batches of gradient steps, from the same weights; the parts' steps are
averaged by their rows. A part tells only of the weights it moved, and Spark sums these up, so what comes to the driver is
at most one row per weight, whatever the number of rows. Then the loss on the validation rows is taken and both are written.
A run that finds epochs under its path goes on behind the last complete one. Which rows form a part, and in which order
they are met, follows from the rows and the seed alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import materialize
from ledgerloom.sources.writers import read_or_empty

BUCKETS = 1 << 18
_WEIGHTS, _LOSSES = "place int, weight double", "epoch int, loss double, n long, accuracy double"


def _schema(spark: SparkSession, ddl: str):
    return spark.createDataFrame([], ddl).schema


def hashed_words(df: DataFrame, text: str, buckets: int) -> DataFrame:
    """``df`` with ``_places``: the bucket of every word and run of signs, as code has many, of the text in lower case; null and
    empty texts have none."""
    words = F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(r"(\w+|[^\w\s]+)"), 1)
    return df.withColumn("_places", F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(buckets)).cast("int")))


def _flat(places: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of some rows one behind the other, their row, and their value: rows have length one by the root of their words."""
    sizes = np.array([len(p) for p in places])
    flat = np.concatenate([np.asarray(p, dtype=np.int64) for p in places]) if sizes.sum() else np.zeros(0, dtype=np.int64)
    return flat, np.repeat(np.arange(len(places)), sizes), np.repeat(1 / np.sqrt(np.maximum(sizes, 1)), sizes)


def margins(places: list[np.ndarray], weights: np.ndarray) -> np.ndarray:
    """The last weight is the constant."""
    flat, row, value = _flat(places)
    return np.bincount(row, weights[flat] * value, minlength=len(places)) + weights[-1]


def probabilities(margin: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * margin))


def steps(places: list[np.ndarray], target: np.ndarray, weights: np.ndarray, rate: float, batch: int) -> None:
    """Gradient steps over mini-batches, in place."""
    for i in range(0, len(places), batch):
        some = places[i : i + batch]
        flat, row, value = _flat(some)
        off = probabilities(margins(some, weights)) - target[i : i + batch]
        np.subtract.at(weights, flat, rate * off[row] * value / len(some))
        weights[-1] -= rate * off.mean()


@dataclass
class EpochClassifier:
    """``weights`` of the best epoch, that epoch, and the ``losses`` of all: ``epoch, loss, n, accuracy``."""

    weights: np.ndarray
    epoch: int
    losses: DataFrame

    def classify(self, df: DataFrame, text: str = "func") -> DataFrame:
        """Add ``probability`` of class 1 and ``prediction``."""
        weights = self.weights

        @F.pandas_udf("double")
        def score(places: pd.Series) -> pd.Series:
            return pd.Series(probabilities(margins(list(places), weights)))

        scored = hashed_words(df, text, len(weights) - 1).withColumn("probability", score("_places")).drop("_places")
        return scored.withColumn("prediction", (F.col("probability") > 0.5).cast("int"))


def _dealt(rows: DataFrame, parts: int) -> DataFrame:
    """Each part in a task of its own: by a hash some tasks would have several parts and others none, and small ones would be joined."""
    return rows.repartitionById(parts, F.col("_part"))


def _epoch(rows: DataFrame, weights: np.ndarray, n_rows: int, parts: int, epoch: int, seed: int, rate: float, batch: int) -> np.ndarray:
    """The weights behind one epoch over all parts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, own, held, n = None, weights.copy(), [], 0

        def moved() -> pd.DataFrame:
            places = np.flatnonzero(own != weights)
            return pd.DataFrame({"place": places, "moved": (own[places] - weights[places]) * n})

        def take(whole: bool) -> None:
            """Mini-batches do not follow the batches that Spark sends."""
            nonlocal held
            cut = len(held) if whole else len(held) // batch * batch
            if cut:
                steps([p for p, _ in held[:cut]], np.array([t for _, t in held[:cut]]), own, rate, batch)
                held = held[cut:]

        for frame in batches:
            for number, rows_of in frame.groupby("_part", sort=False):
                if number != part:
                    if part is not None:
                        take(True)
                        yield moved()
                    part, own, n = number, weights.copy(), 0
                held += list(zip(rows_of["_places"], rows_of["_target"], strict=True))
                n += len(rows_of)
                take(False)
        if part is not None:
            take(True)
            yield moved()

    order = F.xxhash64(F.lit(seed), F.lit(epoch), "_row")
    dealt = _dealt(rows, parts).sortWithinPartitions("_part", order, "_row").select("_part", "_places", "_target")
    sums = dealt.mapInPandas(run, "place int, moved double").groupBy("place").agg(F.sum("moved").alias("moved")).toPandas()
    out = weights.copy()
    out[sums["place"].to_numpy()] += sums["moved"].to_numpy() / n_rows
    return out


def _loss(rows: DataFrame, weights: np.ndarray) -> tuple[float, int, float]:
    """Mean log loss, rows and accuracy."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            margin, target = margins(list(frame["_places"]), weights), frame["_target"].to_numpy()
            loss = np.logaddexp(0, np.where(target == 1, -margin, margin))
            yield pd.DataFrame({"loss": [loss.sum()], "n": [len(frame)], "right": [int(((margin > 0) == (target == 1)).sum())]})

    found = rows.select("_places", "_target").mapInPandas(run, "loss double, n long, right long")
    row = found.agg(F.sum("loss").alias("loss"), F.sum("n").alias("n"), F.sum("right").alias("right")).first()
    return (row["loss"] / row["n"], row["n"], row["right"] / row["n"]) if row["n"] else (math.inf, 0, 0.0)


def fit_epochs(
    train: DataFrame, validation: DataFrame, path: str, epochs: int = 5, *, text: str = "func", label: str = "target",
    rate: float = 4.0, batch: int = 32, part_rows: int = 20_000, buckets: int = BUCKETS, seed: int = 42,
) -> EpochClassifier:
    """Train up to ``epochs`` epochs, going on from those under ``path``, and take the one of the least validation loss.

    Epoch 0 is the share of class 1 alone, so the chosen loss is never above that of the majority's share. The step falls
    with the root of the epoch. Rows without a label are left out. With no training rows ValueError is raised.
    """
    spark = train.sparkSession

    def prepared(df: DataFrame, name: str) -> DataFrame:
        rows = hashed_words(df.where(F.col(label).isNotNull()), text, buckets)
        rows = rows.select("_places", F.col(label).cast("int").alias("_target"), F.xxhash64(text, label).alias("_row"))
        return materialize(rows, name)

    rows, tests = prepared(train, "epoch-train"), prepared(validation, "epoch-validation")
    n, ones = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("_target"), F.lit(0))).first()
    if not n:
        raise ValueError("no training rows")
    parts = -(-n // part_rows)
    rows = rows.withColumn("_part", F.pmod(F.xxhash64(F.lit(seed), "_row"), F.lit(parts)).cast("int"))

    def written() -> dict[int, float]:
        return {r["epoch"]: r["loss"] for r in read_or_empty(spark, f"{path}/losses", _schema(spark, _LOSSES)).collect()}

    def load(epoch: int) -> np.ndarray:
        found = spark.read.schema(_WEIGHTS).parquet(f"{path}/weights/epoch={epoch}").toPandas()
        out = np.zeros(buckets + 1)
        out[found["place"].to_numpy()] = found["weight"].to_numpy()
        return out

    done = written()
    weights = load(max(done)) if done else np.zeros(buckets + 1)
    for epoch in range(max(done, default=-1) + 1, epochs + 1):
        if epoch == 0:
            weights[-1] = math.log((ones + 0.5) / (n - ones + 0.5))
        else:
            weights = _epoch(rows, weights, n, parts, epoch, seed, rate / math.sqrt(epoch), batch)
        places = np.flatnonzero(weights)
        table = spark.createDataFrame(pd.DataFrame({"place": places.astype(np.int32), "weight": weights[places]}), _WEIGHTS)
        table.coalesce(1).write.mode("overwrite").parquet(f"{path}/weights/epoch={epoch}")
        # An epoch is complete when its loss is written.
        loss = [(epoch, *_loss(tests, weights))]
        spark.createDataFrame(loss, _LOSSES).coalesce(1).write.mode("append").parquet(f"{path}/losses")
    losses = {e: loss for e, loss in written().items() if e <= epochs}
    best = min(losses, key=lambda e: (losses[e], e))
    return EpochClassifier(load(best), best, spark.read.schema(_LOSSES).parquet(f"{path}/losses"))
