"""Quality rules: base counts of a text, and a likelihood ratio of its hashed n-grams.

Two multinomials over hashed unigrams and bigrams are counted: one over a trusted target, one over the whole
raw corpus. A document's verdict is the mean, over all its n-grams, of log p(target) - log p(raw): above a
fixed threshold it is kept. Counts cover every whole text; nothing is random, so equal texts have equal
verdicts.

N-grams are over tokens: runs of word characters, and runs of other marks, as written. A bucket that the
target lacks has the smoothed probability of ``SMOOTH`` counts.
"""

from __future__ import annotations

import re
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import constants, mix

BITS = 14
BUCKETS = 1 << BITS
SMOOTH = 1.0
RUN = 8
#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\v\f\r"
_TOKENS = re.compile(r"\w+|[^\w\s]+")
_FACTORS = constants(RUN, 8)


def ngram_buckets(text: str) -> np.ndarray:
    """The buckets of a text's unigrams and bigrams; empty if it has no token."""
    tokens = _TOKENS.findall(text)
    h = np.fromiter(map(crc32, [t.encode() for t in tokens]), dtype=np.uint64, count=len(tokens))
    pair = mix(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]) if len(h) > 1 else h[:0]
    return (np.concatenate((mix(h), pair)) >> np.uint64(64 - BITS)).astype(np.int64)


def repeated_words(words: list[bytes], run: int = RUN) -> int:
    """Words inside windows of ``run`` words that occur at least twice in the text, the first occurrence included."""
    n = len(words) - run + 1
    if n < 2:
        return 0
    ids = mix(np.fromiter(map(crc32, words), dtype=np.uint64, count=len(words)))
    h = np.zeros(n, dtype=np.uint64)
    for k in range(run):
        h += ids[k : k + n] * _FACTORS[k]
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    if not same.any():
        return 0
    first_of: dict[tuple, int] = {}
    hit = np.zeros(len(words) + 1, dtype=np.int64)
    grouped = np.zeros(n, dtype=bool)
    grouped[order[1:][same]] = True
    grouped[order[:-1][same]] = True
    for i in np.flatnonzero(grouped).tolist():  # the windows themselves decide, not their hashes
        window = tuple(words[i : i + run])
        first = first_of.setdefault(window, i)
        if first != i:
            for j in (first, i):
                hit[j] += 1
                hit[j + run] -= 1
    return int((np.cumsum(hit) > 0).sum())


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of a text."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes split at the six ASCII white spaces only
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text) - sum(map(text.count, _SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def count_ngrams(docs: DataFrame) -> np.ndarray:
    """How many n-grams of the texts fall into each bucket. Tasks add up first; ``BUCKETS`` sums reach the driver."""

    def count(batches):
        total = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for text in batch["text"]:
                if isinstance(text, str):
                    total += np.bincount(ngram_buckets(text), minlength=BUCKETS)
        used = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": used, "n": total[used]})

    out = np.zeros(BUCKETS, dtype=np.int64)
    sums = docs.select("text").mapInPandas(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for row in sums.collect():
        out[row["bucket"]] = row["n"]
    return out


def log_ratios(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """For each bucket log p(target) - log p(raw), smoothed; zeros if the target has no n-gram."""
    if not target.sum():
        return np.zeros(BUCKETS)
    both = [np.log((c + SMOOTH) / (c.sum() + SMOOTH * BUCKETS)) for c in (target, raw)]
    return both[0] - both[1]


def train(docs: DataFrame, trusted: DataFrame) -> np.ndarray:
    """The log ratio of each bucket from all texts of the corpus and all texts of the trusted target."""
    return log_ratios(count_ngrams(trusted), count_ngrams(docs))


def trusted_by_label(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are labelled as good. A label that is null or repeated with 0 does not count.

    The list of them grows with the corpus, so it is never broadcast: texts and list are sorted out by id, at every size.
    """
    good = labels.groupBy("doc_id").agg(F.min("quality").alias("q")).where("q = 1").select("doc_id")
    return docs.select("doc_id", "text").join(good.hint("merge"), "doc_id", "left_semi")


def judge(
    docs: DataFrame, ratios: np.ndarray, *, threshold: float = -0.2, min_words: int = 20, repeat_percent: int = 30
) -> DataFrame:
    """``doc_id``, the base counts, ``base_failed``, ``llr`` (mean per n-gram) and ``kept`` for every row.

    A null or empty text has counts of 0 and ``llr`` 0 and fails the base rules. Equal texts get equal verdicts,
    repeated rows one each; an empty table gives an empty table. Columns other than ``doc_id`` and ``text`` are not
    looked at. ``kept`` is false if the base rules fail, else whether ``llr`` is at least ``threshold``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ratios)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    @F.pandas_udf(", ".join(f"{n} long" for n in names) + ", llr double")
    def measure(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            text = text if isinstance(text, str) else ""
            found = ngram_buckets(text)
            rows.append((*base_counts(text), float(shared.value[found].mean()) if len(found) else 0.0))
        return pd.DataFrame(rows, columns=[*names, "llr"])

    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))
    return (
        docs.select("doc_id", measure("text").alias("_m"))
        .select("doc_id", "_m.*")
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold))
    )
