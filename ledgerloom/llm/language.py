"""Language identification by the nearest of several centroids per language.

A text is its character n-grams (1 to 3, letters with a space beside words), hashed to ``DIM`` counters,
damped by a logarithm, weighted by inverse document frequency and scaled to length 1. Each language's
sampled texts are clustered by spherical k-means into a few centroids, in a task of its own; a text gets the
language of the centroid with the largest cosine. A text further from that centroid than nearly all texts it
was made from is marked ``rejected``: its language is the nearest one known, not a sure one.

Labels are noisy, so a centroid stays only if the other languages' centroids do not claim it: one that
lies nearer to another language's mean than to its own is dropped.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import chunks, codepoints, held_out, letter_table

BITS = 12
DIM = 1 << BITS
UNDETERMINED = "und"
_SPACE = np.uint32(32)


def gram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of hashed n-grams, a row per text, and the number of letters of each text."""
    parts = [codepoints(f" {t.lower()} ") for t in texts]
    if not parts:
        return np.zeros((0, DIM), dtype=np.float32), np.zeros(0, dtype=np.int64)
    cp = np.concatenate(parts)
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    letter = letter_table()[cp]
    cp = np.where(letter, cp, _SPACE).astype(np.uint32)
    total = np.zeros(len(parts) * DIM, dtype=np.float32)
    h = np.zeros(len(cp), dtype=np.uint32)
    for size in (1, 2, 3):
        m = max(0, len(cp) - size + 1)
        h = h[:m] * np.uint32(0x01000193) ^ (cp[size - 1 :] + np.uint32(0x9DC5))
        # Of the texts' n-grams those with a letter in the middle (the last one, of a pair): they cross no text.
        keep = np.flatnonzero(letter[size // 2 : size // 2 + m])
        key = (h[keep] + np.uint32(size)) * np.uint32(0x9E3779B1)
        bucket = ((key ^ (key >> np.uint32(15))) * np.uint32(0x85EBCA77)) >> np.uint32(32 - BITS)
        total += np.bincount(owner[keep] * DIM + bucket, minlength=len(total)).astype(np.float32)
    return total.reshape(len(parts), DIM), np.bincount(owner, letter, len(parts)).astype(np.int64)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-12)


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return unit(np.log1p(counts) * idf).astype(np.float32)


def clusters(x: np.ndarray, k: int, rounds: int = 12, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means: centroids of length 1, and the centroid of each row. At most one per distinct row."""
    rng = np.random.default_rng(seed)
    centres = x[[rng.integers(len(x))]]
    while len(centres) < min(k, len(x)):
        far = 1 - (x @ centres.T).max(1)
        if far.max() < 1e-6:
            break
        centres = np.vstack([centres, x[int(np.argmax(far * rng.random(len(x))))]])
    for _ in range(rounds):
        of = np.argmax(x @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, of, x)
        centres = unit(np.where(np.linalg.norm(sums, axis=1, keepdims=True) > 0, sums, centres))
    return centres, np.argmax(x @ centres.T, axis=1)


@dataclass
class CentroidModel:
    """Centroids of all languages, the language of each, and the least cosine that is not rejected."""

    idf: np.ndarray
    centres: np.ndarray
    langs: list[str] = field(default_factory=list)
    least: np.ndarray = field(default_factory=lambda: np.zeros(0))


def predict(texts: list[str], model: CentroidModel) -> pd.DataFrame:
    """``lang_pred, score, rejected``. Without a letter, or without a model: ``und``, 0, true."""
    counts, letters = gram_counts(texts)
    out = pd.DataFrame({"lang_pred": [UNDETERMINED] * len(texts), "score": 0.0, "rejected": True})
    if not len(texts) or not model.langs:
        return out
    cosine = vectors(counts, model.idf) @ model.centres.T
    best = np.argmax(cosine, axis=1)
    top = cosine[np.arange(len(texts)), best]
    known = letters > 0
    langs = np.array(model.langs, dtype=object)[best]
    out["lang_pred"] = np.where(known, langs, UNDETERMINED)
    out["score"] = np.where(known, np.clip(top, 0, 1), 0.0).astype(np.float64)
    out["rejected"] = ~known | (top < model.least[best])
    return out


def _pack(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x, dtype=np.float32).tobytes()


def _unpack(b: bytes) -> np.ndarray:
    return np.frombuffer(b, dtype=np.float32)


def train(docs: DataFrame, *, per_lang: int = 1_200, k: int = 4, reject: float = 0.005, seed: int = 3) -> CentroidModel:
    """Fit on at most ``per_lang`` documents of each language (by seeded hash) that are not held out and have a
    ``lang``. Each language is one bounded group; the driver receives centroids and document frequencies."""
    learn = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id"))
    picked = learn.select("doc_id", "lang").withColumn("_n", nth).where(F.col("_n") <= per_lang).drop("_n")

    @F.pandas_udf("binary")
    def counted(texts: pd.Series) -> pd.Series:
        out = []
        for part in chunks(texts.tolist()):
            out += [_pack(row) for row in gram_counts(part)[0]]
        return pd.Series(out, dtype=object)

    sampled = (
        learn.select("doc_id", F.col("lang").alias("_lang"), "text")
        .join(F.broadcast(picked.select("doc_id", F.col("lang").alias("_lang")).distinct()), ["doc_id", "_lang"])
        .select("_lang", counted("text").alias("counts"))
    )

    def presence(batches):
        seen, rows = np.zeros(DIM, dtype=np.int64), 0
        for batch in batches:
            for b in batch["counts"]:
                seen += _unpack(b) > 0
                rows += 1
        yield pd.DataFrame({"bucket": np.arange(DIM + 1), "docs": np.append(seen, rows)})

    found = np.zeros(DIM + 1)
    frequency = sampled.select("counts").mapInPandas(presence, "bucket int, docs long").groupBy("bucket").agg(F.sum("docs").alias("docs"))
    for row in frequency.toPandas().itertuples():
        found[row.bucket] = row.docs
    idf = (np.log((found[-1] + 1) / (found[:-1] + 1)) + 1).astype(np.float32)

    def cluster(pdf: pd.DataFrame) -> pd.DataFrame:
        counts = np.stack([_unpack(b) for b in pdf["counts"]])
        x = vectors(counts[counts.sum(1) > 0], idf)
        if not len(x):
            return pd.DataFrame({"lang": [], "centre": [], "least": [], "mean": []})
        centres, of = clusters(x, k)
        cosine = (x * centres[of]).sum(1)
        used = sorted(set(of.tolist()))
        mean = _pack(unit(x.mean(0)))
        return pd.DataFrame({
            "lang": pdf["_lang"].iloc[0], "centre": [_pack(centres[c]) for c in used],
            "least": [float(np.quantile(cosine[of == c], reject)) for c in used], "mean": mean,
        })

    rows = (
        sampled.groupBy("_lang")
        .applyInPandas(cluster, "lang string, centre binary, least double, mean binary")
        .orderBy("lang", "centre")
        .collect()
    )
    if not rows:
        return CentroidModel(idf, np.zeros((0, DIM), dtype=np.float32))
    means = {r["lang"]: _unpack(r["mean"]) for r in rows}
    kept = []
    for r in rows:
        own, centre = r["lang"], _unpack(r["centre"])
        if all(centre @ means[own] >= centre @ m for lang, m in means.items() if lang != own):
            kept.append(r)
    return CentroidModel(
        idf, np.stack([_unpack(r["centre"]) for r in kept]), [r["lang"] for r in kept], np.array([r["least"] for r in kept])
    )


def identify(docs: DataFrame, model: CentroidModel | None = None, **options) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` for every row.

    ``score`` is the cosine to the nearest centroid. A null text, an empty one and one without a letter are
    ``und`` with score 0. Equal texts get equal answers; on a tie of centroids the language that sorts first wins;
    rows that repeat are answered each; an empty table gives an empty table, and if no row has a language, all
    are ``und``. Columns other than ``doc_id, text, lang`` are not looked at.
    """
    model = model or train(docs, **options)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def answer(texts: pd.Series) -> pd.DataFrame:
        parts = [predict(part, shared.value) for part in chunks(texts.tolist(), 1 << 18)]
        return pd.concat(parts, ignore_index=True) if parts else predict([], shared.value)

    return docs.select("doc_id", held_out().alias("held_out"), answer("text").alias("_a")).select(
        "doc_id", "held_out", "_a.lang_pred", "_a.score", "_a.rejected"
    )
