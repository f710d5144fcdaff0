"""Phrase collocations by marginalising the longest windows.

Every word begins one window: itself and the words that follow it in its piece, ``order`` columns, padded with
empty words behind the end of the piece. Only windows are counted; Spark's ROLLUP sums them up over ever shorter
beginnings, which gives the frequency of every phrase of up to ``order`` words, of every word, and of all words of a language.

A window that holds a rare run of words cannot be a frequent phrase, so it is cut (padded) before the last word of the
run; beginnings up to there keep their exact counts, and what is lost is below ``min_count`` anyway. Which runs of two up to
``order - 1`` words may be frequent is found in a pass each: runs whose own parts may be frequent are counted by 40 bits of
a hash, where colliding runs add up, so a count is never too small, and those that reach ``min_count`` set a bit in a map of
``FILTER_BITS`` bits. A map is of one size (8 MB) whatever the input is: on very large inputs it keeps more windows whole
than need be, never fewer.

Texts are cut into words as arrays of bytes, and a chunk's equal windows are summed up before Spark sees them. A text
longer than a chunk is taken in slices that end at a sentence mark.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import mix
from ledgerloom.session import materialize

ORDER, MIN_COUNT, TOP = 4, 30, 2000
CHUNK_BYTES = 4 << 20
FILTER_BITS = 1 << 26
PAIR_BITS = 40
#: Parts of a language that are ranked apart before their first phrases are ranked together.
SALTS = 64

_BREAK = re.compile(rb"[.,;:!?\x0a-\x0d]")
_KIND = np.zeros(256, dtype=np.uint8)  # 0: in a word, 1: between words, 2: between pieces
_KIND[list(b" \t")] = 1
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = 2


def slices(raw: bytes, size: int) -> Iterator[bytes]:
    """``raw`` in parts of about ``size`` bytes that end behind a break; a piece is never cut."""
    at = 0
    while len(raw) - at > size:
        near = _BREAK.search(raw, at + size)
        if near is None:
            break
        yield raw[at : near.end()]
        at = near.end()
    yield raw[at:]


class Words:
    """The words of some texts in order: number, language and whether the next word follows in the same piece."""

    def __init__(self, langs: list[str], texts: list[bytes]) -> None:
        data = np.frombuffer(b"\n".join(texts).lower(), dtype=np.uint8)  # A-Z only, as these are bytes
        kind = _KIND[data]
        inside = kind == 0
        edge = np.diff(inside.view(np.int8), prepend=0, append=0)
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        piece = np.searchsorted(np.flatnonzero(kind == 2), starts)
        self.follows = np.zeros(len(starts), dtype=bool)
        self.follows[:-1] = piece[1:] == piece[:-1]
        offsets = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int64)
        found = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])]
        ).dictionary_encode()
        self.ids = found.indices.to_numpy().astype(np.int64)
        self.names: pa.Array = found.dictionary
        first = np.cumsum([0, *[len(t) + 1 for t in texts]])
        self.lang_names = sorted(set(langs))
        code = {name: i for i, name in enumerate(self.lang_names)}
        self.lang = np.array([code[x] for x in langs], dtype=np.int64)[np.searchsorted(first, starts, side="right") - 1]

    def runs(self, filters: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
        """Where runs begin that may be frequent, for two words and each longer run that there is a filter for; and a hash of
        the language and the run that is one word longer than the last of these, for each place."""
        def hashed(names: list[bytes]) -> np.ndarray:
            return np.fromiter(map(xxhash.xxh3_64_intdigest, names), dtype=np.uint64, count=len(names))

        word = hashed(self.names.to_pylist())[self.ids]
        run = mix(hashed([name.encode() for name in self.lang_names])[self.lang] + word)
        found = []
        ahead = word
        for bits in (*filters, None):
            ahead = np.concatenate((ahead[1:], ahead[:1]))
            run = mix(run * np.uint64(0x9E3779B97F4A7C15) + ahead)
            if bits is not None:
                found.append(self.longer(found) & _is_set(bits, run >> np.uint64(64 - PAIR_BITS)))
        return found, run >> np.uint64(64 - PAIR_BITS)

    def longer(self, found: list[np.ndarray]) -> np.ndarray:
        """Where a run one word longer than the last of ``found`` begins both of whose parts are there."""
        if not found:
            return self.follows
        return found[-1] & np.concatenate((found[-1][1:], [False]))[: len(self.ids)]

    def windows(self, filters: list[np.ndarray], order: int) -> tuple[np.ndarray, np.ndarray]:
        """The distinct windows, a row of language and word numbers each (the dictionary's length is the padding), and their counts."""
        n, pad = len(self.ids), len(self.names)
        columns = [self.lang, self.ids]
        found = self.runs(filters)[0]
        for k, reach in enumerate([*found, self.longer(found)][: order - 1], 1):
            word = np.full(n, pad)
            word[: n - k] = self.ids[k:]
            columns.append(np.where(reach, word, pad))
        long = np.flatnonzero(columns[2] != pad) if order > 1 else np.zeros(0, dtype=np.int64)
        one, n_one = np.unique(self.lang * (pad + 1) + self.ids if order == 1 else (self.lang * (pad + 1) + self.ids)[columns[2] == pad], return_counts=True)
        singles = np.full((len(one), order + 1), pad)
        singles[:, 0], singles[:, 1] = one // (pad + 1), one % (pad + 1)
        rows = np.stack([c[long] for c in columns], axis=1)
        rows = rows[np.lexsort(rows.T[::-1])]
        new = np.flatnonzero(np.concatenate(([True], (rows[1:] != rows[:-1]).any(axis=1)))) if len(rows) else np.zeros(0, dtype=np.int64)
        return np.concatenate((singles, rows[new])), np.concatenate((n_one, np.diff(np.append(new, len(rows)))))


def _chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[Words]:
    """``lang, text`` as words, some texts at a time."""
    langs: list[str] = []
    texts: list[bytes] = []
    held = 0
    for batch in batches:
        for lang, raw in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
            for part in slices(raw, size):
                langs.append(lang)
                texts.append(part)
                held += len(part) + 1
                if held >= size:
                    yield Words(langs, texts)
                    langs, texts, held = [], [], 0
    if texts:
        yield Words(langs, texts)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))


def frequent_runs(
    docs: DataFrame, filters: list[np.ndarray], *, min_count: int = MIN_COUNT, chunk_bytes: int = CHUNK_BYTES, filter_bits: int = FILTER_BITS
) -> np.ndarray:
    """A map of bits (unsigned 64-bit numbers) for runs of one word more than the last of ``filters``, or of two words: the
    bit of each run that occurs ``min_count`` times is set, and perhaps others."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words in _chunks(batches, chunk_bytes):
            found, run = words.runs(filters)
            runs, n = np.unique(run[words.longer(found)], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(runs.astype(np.int64)), pa.array(n)], names=["run", "n"])

    place = F.pmod("run", F.lit(filter_bits))
    found = (
        _texts(docs).mapInArrow(count, "run long, n long")
        .groupBy("run").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
        .select(F.shiftright(place, 6).cast("int").alias("word"), F.pmod("run", F.lit(64)).cast("int").alias("bit"))
        .groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    ).toPandas()
    out = np.zeros(filter_bits // 64, dtype=np.uint64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy(dtype=np.int64).view(np.uint64)
    return out


def _is_set(bits: np.ndarray, runs: np.ndarray) -> np.ndarray:
    place = runs % np.uint64(len(bits) * 64)
    return (bits[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)


def phrase_counts(docs: DataFrame, *, order: int = ORDER, min_count: int = MIN_COUNT, chunk_bytes: int = CHUNK_BYTES, filter_bits: int = FILTER_BITS) -> DataFrame:
    """``lang, phrase, size, f``: every phrase of 1 to ``order`` words that occurs at least ``min_count`` times, and with
    size 0 and an empty phrase how many words the language has. ``docs``: ``lang, text``."""
    filters: list[np.ndarray] = []
    for _ in range(order - 2):
        filters.append(frequent_runs(docs, filters, min_count=min_count, chunk_bytes=chunk_bytes, filter_bits=filter_bits))
    columns = [f"w{k}" for k in range(1, order + 1)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words in _chunks(batches, chunk_bytes):
            rows, n = words.windows(filters, order)
            names = pa.concat_arrays([words.names, pa.array([b""], pa.large_binary())]).cast(pa.binary()).cast(pa.string())
            out = [pa.array(words.lang_names, pa.string()).take(pa.array(rows[:, 0])), *[names.take(pa.array(rows[:, k])) for k in range(1, order + 1)]]
            yield pa.RecordBatch.from_arrays([*out, pa.array(n)], names=["lang", *columns, "n"])

    windows = _texts(docs).mapInArrow(count, f"lang string, {', '.join(f'{c} string' for c in columns)}, n long")
    size = (F.lit(order) - F.bit_count(F.grouping_id())).alias("size")
    sums = windows.rollup("lang", *columns).agg(F.sum("n").alias("f"), size)
    last = F.element_at(F.array(*columns), F.col("size").cast("int"))
    phrase = F.concat_ws(" ", *columns)  # columns that are rolled up are null
    return (
        sums.where((F.col("size") == 0) | ((F.col("size") > 0) & (F.col("f") >= min_count)))
        .where(F.when(F.col("size") > 0, last != "").otherwise(True))
        .select("lang", F.when(F.col("size") > 0, phrase).otherwise("").alias("phrase"), F.col("size").cast("int").alias("size"), "f")
    )


def _cut_scores(candidates: DataFrame, counts: DataFrame) -> DataFrame:
    """``lang, phrase, size, a, l, r, score`` of the lowest-scoring cut of each candidate, on a tie the first."""
    words = F.split("phrase", " ")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", "size", "a", "k",
        F.array_join(F.slice(words, F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice(words, F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("right"),
    )
    part = counts.where("size > 0")
    exact = F.expr("CAST(a AS DECIMAL(20,0)) * 2000000 DIV (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))")
    return (
        cuts.join(part.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
        .join(part.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
        .groupBy("lang", "phrase", "size", "a")
        .agg(F.min(F.struct(exact.alias("score"), "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "size", "a", "cut.l", "cut.r", "cut.score")
    )


def _inside(candidates: DataFrame) -> DataFrame:
    """``lang, phrase, top``: phrases of two words or more inside longer candidates, with the highest count of those."""
    words = F.split("phrase", " ")
    return (
        candidates.where("size > 2")
        .withColumn("m", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
        .withColumn("at", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)))
        .select("lang", F.array_join(F.slice(words, F.col("at"), F.col("m")), " ").alias("phrase"), "a")
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("top"))
    )


def collocations(docs: DataFrame, *, order: int = ORDER, min_count: int = MIN_COUNT, top: int = TOP, **options) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of each language.

    ``docs``: ``lang, text``. A-Z in lower case, pieces end at ``.,;:!?`` and line breaks, words at space and tab. Candidates
    are phrases of 2 to ``order`` words that occur ``a >= min_count`` times; of the cuts into a first part (``l`` times)
    and a rest (``r`` times) the one with the least ``score``, floor(2000000 a / (l + r)), counts. A candidate inside a
    longer one with at least 80 % of its occurrences is dropped. Order: score, then ``a``, both descending, then the phrase
    by its bytes. A null language is ``und``; null, empty and white texts have no words. Rows that repeat count each.
    An empty table gives an empty table. Other columns are not looked at.
    """
    counts = materialize(phrase_counts(docs, order=order, min_count=min_count, **options), "phrases")
    candidates = counts.where("size > 1").withColumnRenamed("f", "a")
    held = F.expr("top IS NOT NULL AND CAST(top AS DECIMAL(20,0)) * 100 >= CAST(a AS DECIMAL(20,0)) * 80")
    kept = _cut_scores(candidates, counts).join(_inside(candidates), ["lang", "phrase"], "left").where(~held)
    order_by = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).alias("salt")
    some = kept.select("*", salt).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order_by)))
    ranked = some.where(F.col("rank") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order_by)))
    totals = counts.where("size = 0").select("lang", F.col("f").alias("n"))
    return (
        ranked.where(F.col("rank") <= top).join(totals, "lang")
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )
