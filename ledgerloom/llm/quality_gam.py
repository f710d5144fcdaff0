"""Quality classifier: a generalised additive model with pairwise interactions.

Every feature has a table with one value per bin; some pairs of features have a table over two.
The tables are learnt by boosting shallow trees in turn: in each round every feature gets a tree of
at most four leaves on its own bins, fitted to the current gradients, and adds its leaf values to its
table. Pairs follow, on what the single features leave over. A score is the sum of the looked-up
values through the logistic function, so a document is scored with additions only.

The fit uses a bounded sample of labelled rows (``sample_rows``); scoring covers every whole text.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import by_chunk, codepoints, held_out, labelled_ids, one_text_each, sample_ids

FEATURES = (
    "log_words", "mean_word", "longest_word", "short_words", "letters", "uppercase", "digits", "sentence_marks",
    "exclamations", "symbols", "other_marks", "spaces", "non_ascii", "distinct_words", "adjacent_repeats",
    "top_word", "marked_words", "repeated_lines", "line_words", "sentence_words", "char_entropy",
)

SENTENCE, EXCLAIM, SYMBOL = ".,;:?'\"()-", "!", "#*$%&|<>@^~=+_\\/{}[]`"
_LETTER, _UPPER, _DIGIT, _SPACE, _SENTENCE, _EXCLAIM, _SYMBOL, _OTHER = range(8)


def _class_table() -> np.ndarray:
    """The class of each code point of the basic plane; the last entry stands for all beyond."""
    table = np.full(0x10001, _OTHER, dtype=np.uint8)
    for i in range(0x10000):
        c = chr(i)
        if c.isalpha():
            table[i] = _UPPER if c.isupper() else _LETTER
        elif c.isdigit():
            table[i] = _DIGIT
        elif c.isspace():
            table[i] = _SPACE
    for chars, kind in ((SENTENCE, _SENTENCE), (EXCLAIM, _EXCLAIM), (SYMBOL, _SYMBOL)):
        table[[ord(c) for c in chars]] = kind
    return table


_TABLE: list[np.ndarray] = []
_ENDS = set(EXCLAIM + SYMBOL)


def text_features(text: str) -> list[float]:
    """The features of one text, all finite; an empty text has zeros."""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    if not _TABLE:
        _TABLE.append(_class_table())
    cp = np.minimum(codepoints(text), 0x10000)
    kinds = np.bincount(_TABLE[0][cp], minlength=8).astype(float)
    n, filled = len(words), max(1.0, float(len(cp) - kinds[_SPACE]))
    letters = kinds[_LETTER] + kinds[_UPPER]
    counts = Counter(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
    lines = [line for line in text.split("\n") if line.strip()]
    chars = np.bincount(np.minimum(cp, 1023))
    share = chars[chars > 0] / len(cp)
    return [
        np.log1p(n), lengths.mean(), np.log1p(lengths.max()), (lengths <= 3).mean(),
        letters / filled, kinds[_UPPER] / max(1.0, letters), kinds[_DIGIT] / filled, kinds[_SENTENCE] / n,
        kinds[_EXCLAIM] / n, kinds[_SYMBOL] / n, kinds[_OTHER] / filled, kinds[_SPACE] / len(cp),
        float((cp > 127).sum()) / filled, len(counts) / n, sum(map(str.__eq__, words, words[1:])) / n,
        max(counts.values()) / n, sum(c for w, c in counts.items() if w[-1] in _ENDS) / n,
        1 - len(set(lines)) / len(lines), np.log1p(n / len(lines)), np.log1p(n / (1 + text.count("."))),
        float(-(share * np.log2(share)).sum()),
    ]


def feature_matrix(texts: list[str]) -> np.ndarray:
    return np.array([text_features(t) for t in texts], dtype=np.float64).reshape(len(texts), len(FEATURES))


@dataclass
class AdditiveModel:
    """Bin edges, one table per feature and one per pair, and the intercept."""

    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)
    intercept: float = 0.0

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1)

    def margin(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        out = np.full(len(x), self.intercept)
        for j, values in enumerate(self.tables):
            out += values[b[:, j]]
        for (j, k), values in self.pairs.items():
            out += values[b[:, j], b[:, k]]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return logistic(self.margin(x)) if len(x) else np.zeros(0)


def logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def _gain(g, h, smooth):
    return g * g / (h + smooth)


def _best_cut(g: np.ndarray, h: np.ndarray, least: float, smooth: float) -> tuple[float, int]:
    """The cut of a run of bins that lowers the loss most; (0, 0) if none does. ``least``: hessian of a side."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    if not len(left_g):
        return 0.0, 0
    all_g, all_h = g.sum(), h.sum()
    gain = _gain(left_g, left_h, smooth) + _gain(all_g - left_g, all_h - left_h, smooth) - _gain(all_g, all_h, smooth)
    gain = np.where((left_h >= least) & (all_h - left_h >= least), gain, 0.0)
    i = int(np.argmax(gain))
    return (float(gain[i]), i + 1) if gain[i] > 1e-12 else (0.0, 0)


def _tree(g: np.ndarray, h: np.ndarray, least: float, smooth: float) -> np.ndarray:
    """Leaf values of a tree of depth two on one feature, by bin."""
    out = np.zeros(len(g))
    _, middle = _best_cut(g, h, least, smooth)
    for lo, hi in ((0, middle), (middle, len(g))) if middle else ():
        _, cut = _best_cut(g[lo:hi], h[lo:hi], least, smooth)
        for a, b in ((lo, lo + cut), (lo + cut, hi)) if cut else ((lo, hi),):
            out[a:b] = -g[a:b].sum() / (h[a:b].sum() + smooth)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray, least: float, smooth: float) -> tuple[np.ndarray, float]:
    """Leaf values of a tree that cuts one feature, then each side by the other; and its gain."""
    best, out = 0.0, np.zeros_like(g)
    for turn in (False, True):
        gg, hh = (g.T, h.T) if turn else (g, h)
        _, middle = _best_cut(gg.sum(1), hh.sum(1), 0.0, smooth)
        tries = {middle, gg.shape[0] // 2} - {0}
        for m in tries:
            total, values = 0.0, np.zeros_like(gg)
            for rows in (slice(0, m), slice(m, None)):
                side_g, side_h = gg[rows].sum(0), hh[rows].sum(0)
                gain, cut = _best_cut(side_g, side_h, least, smooth)
                total += gain
                for cols in (slice(0, cut), slice(cut, None)) if cut else (slice(None),):
                    values[rows, cols] = -side_g[cols].sum() / (side_h[cols].sum() + smooth)
            if total > best:
                best, out = total, values.T if turn else values
    return out, best


def fit(
    x: np.ndarray, y: np.ndarray, *, rounds: int = 120, pair_rounds: int = 40, n_pairs: int = 8,
    max_bins: int = 32, rate: float = 0.15, smooth: float = 1.0, least: float = 2.0,
) -> AdditiveModel:
    """Boost the tables. One class only, or no rows: the intercept says so and the tables are empty."""
    n, width = (len(x), x.shape[1]) if len(x) else (0, len(FEATURES))
    edges = [
        np.unique(np.quantile(x[:, j], np.arange(1, max_bins) / max_bins)) if n else np.zeros(0) for j in range(width)
    ]
    model = AdditiveModel(edges, [np.zeros(len(e) + 1) for e in edges])
    rate_of_ones = (y.sum() + 0.5) / (n + 1)
    model.intercept = float(np.log(rate_of_ones / (1 - rate_of_ones)))
    if n == 0 or y.min() == y.max():
        return model
    b = model.bins(x)
    margin = np.full(n, model.intercept)

    def slopes():
        p = logistic(margin)
        return p - y, np.maximum(p * (1 - p), 1e-9)

    for _ in range(rounds):
        for j, values in enumerate(model.tables):
            if len(values) < 2:
                continue
            g, h = slopes()
            step = rate * _tree(
                np.bincount(b[:, j], g, len(values)), np.bincount(b[:, j], h, len(values)), least, smooth
            )
            values += step
            margin += step[b[:, j]]

    def grid(j, k):
        shape = len(model.tables[j]), len(model.tables[k])
        cell = b[:, j] * shape[1] + b[:, k]
        g, h = slopes()
        return cell, *(np.bincount(cell, v, shape[0] * shape[1]).reshape(shape) for v in (g, h))

    found = []
    for j in range(width):
        for k in range(j + 1, width):
            if min(len(model.tables[j]), len(model.tables[k])) > 1:
                found.append((_pair_tree(*grid(j, k)[1:], least, smooth)[1], j, k))
    for gain, j, k in sorted(found, key=lambda f: (-f[0], f[1:]))[:n_pairs]:
        if gain > 0:
            model.pairs[j, k] = np.zeros((len(model.tables[j]), len(model.tables[k])))
    for _ in range(pair_rounds):
        for (j, k), values in model.pairs.items():
            cell, g, h = grid(j, k)
            step = rate * _pair_tree(g, h, least, smooth)[0]
            values += step
            margin += step.ravel()[cell]
    return model


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", *, sample_rows: int = 16_000, seed: int = 1):
    """Fit on at most ``sample_rows`` labelled documents that are not held out.

    The features are computed on the executors; the driver receives one row of numbers per sampled document.
    """
    sampled = sample_ids(labelled_ids(docs, labels, label), sample_rows, seed)

    @F.pandas_udf("array<double>")
    def features(texts: pd.Series) -> pd.Series:
        return pd.Series([text_features(t if isinstance(t, str) else "") for t in texts])

    rows = one_text_each(docs, sampled).select("doc_id", "label", features("text").alias("x")).toPandas()
    rows = rows.sort_values("doc_id")
    x = np.array(rows["x"].tolist(), dtype=np.float64).reshape(len(rows), len(FEATURES))
    return fit(x, rows["label"].to_numpy(dtype=np.float64))


def scored(docs: DataFrame, model: AdditiveModel, *keep: str, threshold: float = 0.3) -> DataFrame:
    """``keep`` columns (default ``doc_id``) with ``score`` and ``predicted`` for every row.

    Null and empty texts have features of zero and are scored like any other; equal texts get equal scores;
    rows that repeat are scored each; an empty table gives an empty table. Other columns of ``docs`` are not
    looked at, whatever their names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        def some(part: list[str]) -> pd.DataFrame:
            return pd.DataFrame({"score": shared.value.probability(feature_matrix(part))})

        return by_chunk(some)(texts)["score"]

    columns = keep or ("doc_id",)
    return docs.select(*columns, score("text").alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )


def classify(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Train on the labelled rows, then ``doc_id, held_out, score, predicted`` for every document."""
    return scored(docs, train(docs, labels, **options)).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.3, **options) -> DataFrame:
    """The rows of ``docs`` that the model does not reject, with the columns they came with."""
    model = train(docs, labels, **options)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def good(texts: pd.Series) -> pd.Series:
        def some(part: list[str]) -> pd.DataFrame:
            return pd.DataFrame({"good": shared.value.probability(feature_matrix(part)) >= threshold})

        return by_chunk(some)(texts)["good"].astype(bool)

    return docs.where(good("text"))
