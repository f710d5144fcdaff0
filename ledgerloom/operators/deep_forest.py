"""A balanced random forest of fully grown trees.

The top of every tree is grown level by level by Spark's forest, as deep as it takes for a node to hold at most about
``node_rows`` rows. Spark cuts each feature into bins once for all nodes, so what lies in one bin stays together: the number of
bins grows with the rows, up to ``MOST_BINS``, and a node may have twice the rows of a bin. Then each node that has more than one class, and rows that differ, is finished in a task of its own on
its rows alone: split by split, until a leaf has one class or rows that are all alike. A tree finishes its nodes on a
sample of their rows with replacement (a Poisson count by row and tree) and looks at the square root of the features for a
split, at more if these are constant. Class weights count in both parts.

What the tasks return, a row of arrays for each node that was open, is the model, beside Spark's own. Scoring sends rows to the
nodes that they reach, in ``salts`` parts, so neither all of the model nor all rows of a node need lie in one task.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.scoring import FEATURES, THRESHOLD, apply_threshold, fill_features, fit_forest, with_class_weight
from ledgerloom.session import materialize

NODE_ROWS = 50_000
#: Rows that a part of a node is scored with.
SCORED_ROWS = 500_000
#: Levels that Spark's forest allows.
MOST_LEVELS = 30
#: Bins of a feature; Spark draws their square of rows to find them.
MOST_BINS = 256

_NODE = (
    "tree int, leaf long, feature array<int>, threshold array<double>, below array<int>, above array<int>, share array<double>, "
    "levels int, mixed int"
)


def _best_split(x: np.ndarray, positive: np.ndarray, weight: np.ndarray) -> tuple[float, float] | None:
    """Impurity (weighted Gini) and threshold of the best split of one feature; None where it is constant."""
    order = np.argsort(x, kind="stable")
    x, positive, weight = x[order], positive[order], weight[order]
    ends = np.flatnonzero(x[1:] > x[:-1])
    if not len(ends):
        return None
    w, p = np.cumsum(weight), np.cumsum(positive)
    left, left_p = w[ends], p[ends]
    right, right_p = w[-1] - left, p[-1] - left_p
    impurity = left_p * (left - left_p) / left + right_p * (right - right_p) / right
    best = int(np.argmin(impurity))
    low, high = x[ends[best]], x[ends[best] + 1]
    middle = low + (high - low) / 2
    return float(impurity[best]), float(middle if low <= middle < high else low)


def grow(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rng: np.random.Generator) -> tuple[list, list, list, list, list, int, int]:
    """A tree to the end: feature (-1: a leaf), threshold, node below (at most the threshold) and above, share of the positive
    class, levels, and how many leaves have both classes (of rows that are all alike)."""
    feature, threshold, below, above, share = [], [], [], [], []
    tried = max(1, round(math.sqrt(x.shape[1])))
    levels = mixed = 0
    positive = weight * y
    todo = [(np.arange(len(y)), 0, -1, below)]
    while todo:
        rows, level, parent, side = todo.pop()
        node = len(feature)
        if parent >= 0:
            side[parent] = node
        total = weight[rows].sum()
        feature.append(-1)
        threshold.append(0.0)
        below.append(-1)
        above.append(-1)
        share.append(float(positive[rows].sum() / total))
        levels = max(levels, level)
        if y[rows].min() == y[rows].max():
            continue
        best = None
        for n, f in enumerate(rng.permutation(x.shape[1]).tolist()):
            if n >= tried and best is not None:
                break
            found = _best_split(x[rows, f], positive[rows], weight[rows])
            if found is not None and (best is None or found[0] < best[0]):
                best = (*found, f)
        if best is None:
            mixed += 1
            continue
        _, threshold[node], feature[node] = best
        under = x[rows, feature[node]] <= threshold[node]
        todo += [(rows[~under], level + 1, node, above), (rows[under], level + 1, node, below)]
    return feature, threshold, below, above, share, levels, mixed


def _shares(x: np.ndarray, node: dict) -> np.ndarray:
    """The share at the leaf that each row ends in."""
    feature, threshold, below, above, share = (np.asarray(node[k]) for k in ("feature", "threshold", "below", "above", "share"))
    at = np.zeros(len(x), dtype=np.int64)
    going = np.flatnonzero(feature[at] >= 0)
    while len(going):
        f = feature[at[going]]
        under = x[going, f] <= threshold[at[going]]
        at[going] = np.where(under, below[at[going]], above[at[going]])
        going = going[feature[at[going]] >= 0]
    return share[at]


@dataclass
class DeepForest:
    """``top``: Spark's model; ``nodes``: how each leaf of its trees goes on; ``columns``: the features."""

    top: PipelineModel
    nodes: DataFrame
    columns: tuple[str, ...] = FEATURES

    def probabilities(self, rows: DataFrame) -> DataFrame:
        """``_row`` and ``_p``, the mean share over all trees, for rows numbered ``_row``."""
        parts = max(1, -(-rows.count() // SCORED_ROWS))
        reached = _reached(self.top, rows.withColumn("_salt", F.pmod(F.xxhash64("_row"), F.lit(parts))), self.columns, "_row", "_salt")
        nodes = self.nodes.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
        names, x = ["tree", "leaf", "_salt"], _names(self.columns)

        def score(rows: pd.DataFrame, node: pd.DataFrame) -> pd.DataFrame:
            if not len(rows):
                return pd.DataFrame({"_row": [], "_p": []})
            return pd.DataFrame({"_row": rows["_row"], "_p": _shares(rows[x].to_numpy(), node.iloc[0])})

        each = reached.groupBy(*names).cogroup(nodes.groupBy(*names)).applyInPandas(score, "_row long, _p double")
        return each.groupBy("_row").agg(F.avg("_p").alias("_p"))

    def score(self, df: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
        """Add ``fraud_score`` and ``fraud_predicted``, as ``score_rows`` does."""
        rows = materialize(df.withColumn("_row", F.monotonically_increasing_id()), "to-score")
        scored = rows.join(self.probabilities(rows), "_row")
        return apply_threshold(scored, "_p", threshold).select(*df.columns, "fraud_score", "fraud_predicted")

    def save(self, path: str) -> None:
        self.top.write().overwrite().save(f"{path}/top")
        self.nodes.write.mode("overwrite").parquet(f"{path}/nodes")

    @classmethod
    def load(cls, spark: SparkSession, path: str, columns: tuple[str, ...] = FEATURES) -> DeepForest:
        return cls(PipelineModel.load(f"{path}/top"), spark.read.parquet(f"{path}/nodes"), columns)


def _names(columns: tuple[str, ...]) -> list[str]:
    return [f"_x{i}" for i in range(len(columns))]


def _reached(top: PipelineModel, rows: DataFrame, columns: tuple[str, ...], *keep: str) -> DataFrame:
    """For every row and tree: the leaf of the top that it reaches, its features as ``_x0``, ``_x1`` and so on, since an array
    for each row would be an object of its own in Python, and the columns ``keep``."""
    top.stages[-1].setLeafCol("_leaves")
    x = [F.col(f"_f_{c}").alias(name) for c, name in zip(columns, _names(columns), strict=True)]
    return (
        top.transform(fill_features(rows, columns))
        .select(*x, *keep, F.posexplode(vector_to_array("_leaves")).alias("tree", "leaf"))
        .withColumn("leaf", F.col("leaf").cast("long"))
    )


def _poisson(seed: int) -> F.Column:
    """A count with mean 1 from a seeded draw for each row and tree, by its distribution function."""
    draw = F.pmod(F.xxhash64(F.lit(seed), "_row", "tree"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    upto, term, out = 0.0, math.exp(-1), F.lit(0)
    for k in range(8):
        upto += term
        term /= k + 1
        out = F.when(draw >= upto, F.lit(k + 1)).otherwise(out)
    return out


def fit_deep_forest(
    df: DataFrame, label: str = "is_fraud", trees: int = 100, seed: int = 42, columns: tuple[str, ...] = FEATURES, node_rows: int = NODE_ROWS
) -> DeepForest:
    """Fit on the rows of ``df`` that have a label.

    Spark's forest is made deeper until every open node has at most ``node_rows`` rows, or twice those of a bin if that is
    more; a node that still has more at 30 levels, or where more levels do not part it, is finished all the same, by a task
    that holds its rows.
    """
    columns = tuple(columns)
    x = _names(columns)
    rows = df.where(F.col(label).isNotNull()).withColumn("_label", F.col(label).cast("int").cast("double"))
    rows = materialize(with_class_weight(rows, "_label").withColumn("_row", F.monotonically_increasing_id()), "deep-training")
    n = rows.count()
    bins = min(MOST_BINS, max(32, math.ceil(2 * n / node_rows)))
    bound, before = max(node_rows, math.ceil(2 * n / bins)), math.inf
    depth = max(0, math.ceil(math.log2(max(1, n / bound))))
    while True:
        top = fit_forest(rows.drop("weight", "_label"), label, trees, depth, seed, columns, bins)
        reached = materialize(_reached(top, rows, columns, "_row", "_label", "weight"), "reached")
        varied = sum(((F.max(c) > F.min(c)).cast("int") for c in x), F.lit(0))
        found = reached.groupBy("tree", "leaf").agg(
            F.count(F.lit(1)).alias("n"), (F.sum(F.col("weight") * F.col("_label")) / F.sum("weight")).alias("share"),
            ((F.min("_label") < F.max("_label")) & (varied > 0)).alias("open"), (F.min("_label") < F.max("_label")).cast("int").alias("mixed"),
        )
        found = materialize(found, "tops")
        largest = found.where("open").agg(F.max("n")).first()[0] or 0
        if largest <= bound or largest >= before or depth >= MOST_LEVELS:
            break
        before = largest
        depth = min(MOST_LEVELS, depth + max(1, math.ceil(math.log2(largest / bound))))

    def finish(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_row")  # whatever order the shuffle brought
        weight = rows["weight"].to_numpy() * rows["_times"].to_numpy()
        out = grow(rows[x].to_numpy(), rows["_label"].to_numpy(), weight, np.random.default_rng((seed, *key)))
        names = ["feature", "threshold", "below", "above", "share", "levels", "mixed"]
        return pd.DataFrame({"tree": [key[0]], "leaf": [key[1]], **{name: [v] for name, v in zip(names, out, strict=True)}})

    open_nodes = found.where("open").select("tree", "leaf")
    drawn = reached.join(open_nodes, ["tree", "leaf"]).withColumn("_times", _poisson(seed)).where("_times > 0")
    grown = materialize(drawn.groupBy("tree", "leaf").applyInPandas(finish, _NODE), "grown")
    # Leaves that need no growing, and those of which no row was drawn, are one node.
    alone = found.join(grown.select("tree", "leaf"), ["tree", "leaf"], "left_anti").select(
        "tree", "leaf", F.array(F.lit(-1)).alias("feature"), F.array(F.lit(0.0)).alias("threshold"), F.array(F.lit(-1)).alias("below"),
        F.array(F.lit(-1)).alias("above"), F.array("share").alias("share"), F.lit(0).alias("levels"), "mixed",
    )
    nodes = grown.unionByName(alone).withColumn("levels", F.col("levels") + depth)
    return DeepForest(top, materialize(nodes, "forest"), columns)
