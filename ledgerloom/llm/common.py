"""Helpers shared by the operators: the learning split, bounded samples, text as numpy arrays."""

from __future__ import annotations

import functools
import sys
import unicodedata
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import small_batches  # noqa: F401  (the queries and the pipeline take it from here)

#: Characters that are turned into arrays at once. Bounds a worker's memory whatever a batch holds.
CHUNK_CHARS = 1 << 19


def held_out(doc_id: str = "doc_id") -> Column:
    """True for rows that no model may learn from: crc32 of the id as text, mod 5, is 0.

    A row without an id cannot carry a label and counts as held out.
    """
    remainder = F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5
    return F.coalesce(remainder == 0, F.lit(True))


def labelled_ids(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """``doc_id`` and ``label`` (0 or 1) of the documents a model may learn from.

    One row per document: of repeated labels the smallest counts, nulls count as no label.
    Only ids are read and joined here.
    """
    given = (
        labels.where(F.col(label).isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg((F.min(label) > 0).cast("int").alias("label"))
    )
    ids = docs.where(F.col("doc_id").isNotNull()).select("doc_id").distinct()
    return given.join(ids, "doc_id", "left_semi")


def sample_ids(ids: DataFrame, rows: int, seed: int) -> DataFrame:
    """At most ``rows`` of the ids, the smallest by seeded hash, so that reruns agree."""
    return ids.orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(rows)


def one_text_each(docs: DataFrame, sampled: DataFrame, *extra: str) -> DataFrame:
    """The texts of sampled documents. ``sampled`` has a bounded number of rows, so it is broadcast;
    of rows that repeat an id, one counts."""
    return (
        docs.select("doc_id", "text", *extra)
        .join(F.broadcast(sampled), "doc_id")
        .dropDuplicates(["doc_id"])
    )


def chunks(texts: list[str | None], size: int = CHUNK_CHARS) -> Iterator[list[str]]:
    """The texts in lists of about ``size`` characters; a longer text is a list of its own. Null is empty."""
    part: list[str] = []
    held = 0
    for text in texts:
        text = text if isinstance(text, str) else ""
        if part and held + len(text) > size:
            yield part
            part, held = [], 0
        part.append(text)
        held += len(text)
    if part:
        yield part


def across(batches: Iterable[tuple[list, list[str | None]]], size: int) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of all batches in lists of about ``size`` bytes of text, however few rows a batch has."""
    ids: list = []
    part: list[str] = []
    held = 0
    for numbers, texts in batches:
        for number, text in zip(numbers, texts, strict=True):
            text = text if isinstance(text, str) else ""
            weight = len(text) if text.isascii() else len(text.encode())
            if part and held + weight > size:
                yield ids, part
                ids, part, held = [], [], 0
            ids.append(number)
            part.append(text)
            held += weight
    if part:
        yield ids, part


def by_chunk(score: Callable[[list[str]], pd.DataFrame]) -> Callable[[pd.Series], pd.DataFrame]:
    """Apply ``score`` to the texts of a batch, some at a time."""

    def apply(texts: pd.Series) -> pd.DataFrame:
        parts = [score(part) for part in chunks(texts.tolist())]
        return pd.concat(parts, ignore_index=True) if parts else score([])

    return apply


def codepoints(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


@functools.cache
def letter_table() -> np.ndarray:
    """For each code point, whether it is a letter."""
    table = np.zeros(sys.maxunicode + 1, dtype=bool)
    table[[i for i in range(sys.maxunicode + 1) if unicodedata.category(chr(i))[0] == "L"]] = True
    return table


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values so that every bit depends on every bit (a bijection)."""
    x = np.asarray(x, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` odd 64-bit numbers that follow from ``seed``."""
    base = np.uint64((seed * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + base) | np.uint64(1)
