"""Token ids in wavelet matrices: one compressed sequence per shard, with access, counting and lookup.

A shard holds the ids of whole documents, in the order of their ids. The ids that occur in it are numbered;
the numbers' bits, from the highest, make one plane each, and behind each plane the sequence is parted into
zeros and ones, stably. A plane keeps the number of ones before every ``STEP`` bits, so that rank takes a table
look-up and a few bytes, and access, counting between two places and finding the n-th occurrence take one
rank or select per plane.

Shards are rows of Parquet files, which Spark writes and reads on any file system: ``part`` and ``seq``
(their order), ``n_tokens``, ``n_docs`` and ``blob``.
"""

from __future__ import annotations

import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import across
from ledgerloom.llm.pieces import CHUNK_BYTES, ByteLevel
from ledgerloom.session import scratch_path

END_ID = 2
SHARD_TOKENS = 1 << 20
#: What a worker keeps of recurring units, as ``pieces.KEPT``: it stays in memory through later stages.
KEPT = 30_000_000
STEP = 512
MAGIC = b"WMX1"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


# --- encoding -------------------------------------------------------------------------------------------------


_ENCODERS: dict[str, ByteLevel] = {}


def encoder(path: str) -> ByteLevel:
    """One per worker process, so that tasks that follow each other share what is known."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ByteLevel(path, kept=KEPT)
    return _ENCODERS[path]


# --- the matrix -----------------------------------------------------------------------------------------------


class WaveletMatrix:
    """A sequence of ids as bit planes with rank and select."""

    def __init__(self, n: int, alphabet: np.ndarray, zeros: list[int], planes: list[np.ndarray], ranks: list[np.ndarray]):
        self.n, self.alphabet, self.zeros, self.planes, self.ranks = n, alphabet, zeros, planes, ranks

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        used = np.bincount(ids) if len(ids) else np.zeros(0, dtype=np.int64)
        alphabet = np.flatnonzero(used).astype("<u4")
        number = np.zeros(len(used), dtype=np.uint16 if len(alphabet) <= 1 << 16 else np.uint32)
        number[alphabet] = np.arange(len(alphabet))
        x = number[ids]
        zeros, planes, ranks = [], [], []
        for bit in range(max(0, len(alphabet) - 1).bit_length() - 1, -1, -1):
            one = (x >> bit & 1).astype(bool)
            plane = np.packbits(one, bitorder="little")
            plane = np.concatenate((plane, np.zeros(-len(plane) % (STEP // 8), dtype=np.uint8)))
            ones = np.bitwise_count(plane.view("<u8")).reshape(-1, STEP // 64).sum(1, dtype=np.int64)
            ranks.append(np.concatenate(([0], np.cumsum(ones))).astype("<u4"))
            planes.append(plane)
            x = np.concatenate((np.compress(~one, x), np.compress(one, x)))
            zeros.append(len(ids) - int(ranks[-1][-1]))
        return cls(len(ids), alphabet, zeros, planes, ranks)

    def to_bytes(self) -> bytes:
        head = struct.pack("<QII", self.n, len(self.alphabet), len(self.planes))
        body = [struct.pack("<Q", z) + r.tobytes() + p.tobytes() for z, r, p in zip(self.zeros, self.ranks, self.planes, strict=True)]
        return head + self.alphabet.tobytes() + b"".join(body)

    @classmethod
    def from_bytes(cls, blob: bytes, at: int = 0) -> WaveletMatrix:
        n, size, levels = struct.unpack_from("<QII", blob, at)
        at += 16
        alphabet = np.frombuffer(blob, "<u4", size, at)
        at += 4 * size
        steps = -(-n // STEP)
        zeros, planes, ranks = [], [], []
        for _ in range(levels):
            zeros.append(struct.unpack_from("<Q", blob, at)[0])
            ranks.append(np.frombuffer(blob, "<u4", steps + 1, at + 8))
            planes.append(np.frombuffer(blob, np.uint8, steps * STEP // 8, at + 8 + 4 * (steps + 1)))
            at += 8 + 4 * (steps + 1) + steps * STEP // 8
        return cls(n, alphabet, zeros, planes, ranks)

    def _ones(self, level: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane."""
        step, rest = divmod(i, STEP)
        part = self.planes[level][step * STEP // 8 : step * STEP // 8 + (rest + 7) // 8].copy()
        if rest % 8:
            part[-1] &= (1 << rest % 8) - 1
        return int(self.ranks[level][step]) + int(np.bitwise_count(part).sum())

    def _place(self, level: int, one: bool, nth: int) -> int:
        """The place of the ``nth`` (from 0) one or zero of a plane."""
        before = self.ranks[level].astype(np.int64)
        if not one:
            before = np.minimum(np.arange(len(before)) * STEP, self.n) - before
        step = int(np.searchsorted(before, nth, side="right")) - 1
        bits = np.unpackbits(self.planes[level][step * STEP // 8 : (step + 1) * STEP // 8], bitorder="little")
        return step * STEP + int(np.flatnonzero(bits == one)[nth - int(before[step])])

    def access(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        number = 0
        for level, zeros in enumerate(self.zeros):
            one = int(self.planes[level][i >> 3] >> (i & 7) & 1)
            ones = self._ones(level, i)
            i = zeros + ones if one else i - ones
            number = number << 1 | one
        return int(self.alphabet[number])

    def _number(self, token: int) -> int | None:
        k = int(np.searchsorted(self.alphabet, token))
        return k if k < len(self.alphabet) and self.alphabet[k] == token else None

    def _range(self, number: int, lo: int, hi: int) -> tuple[int, int]:
        for level, zeros in enumerate(self.zeros):
            a, b = self._ones(level, lo), self._ones(level, hi)
            one = number >> (len(self.zeros) - 1 - level) & 1
            lo, hi = (zeros + a, zeros + b) if one else (lo - a, hi - b)
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """How often ``token`` occurs in places ``lo`` up to ``hi``."""
        number = self._number(token)
        if number is None:
            return 0
        a, b = self._range(number, max(0, lo), self.n if hi is None else min(hi, self.n))
        return max(0, b - a)

    def select(self, token: int, nth: int) -> int:
        """The place of the ``nth`` (from 0) occurrence of ``token``; IndexError if there are fewer."""
        if not 0 <= nth < self.count(token):
            raise IndexError(nth)
        number = self._number(token)
        at = self._range(number, 0, self.n)[0] + nth
        for level in range(len(self.zeros) - 1, -1, -1):
            one = bool(number >> (len(self.zeros) - 1 - level) & 1)
            at = self._place(level, one, at - self.zeros[level] if one else at)
        return at

    def decode(self) -> np.ndarray:
        """All ids in order, as unsigned 32-bit numbers."""
        x = np.zeros(self.n, dtype=np.uint16 if len(self.alphabet) <= 1 << 16 else np.uint32)
        for k, level in enumerate(range(len(self.zeros) - 1, -1, -1)):
            one = np.unpackbits(self.planes[level], count=self.n, bitorder="little").view(bool)
            out = np.empty_like(x)
            out[np.flatnonzero(one)] = x[self.zeros[level] :] | x.dtype.type(1 << k)
            out[np.flatnonzero(~one)] = x[: self.zeros[level]]
            x = out
        return self.alphabet[x] if self.n else np.zeros(0, dtype="<u4")


def pack_shard(doc_ids: list[int | None], sizes: list[int], ids: np.ndarray) -> bytes:
    """Documents (id, or None, and how many ids it has) and the matrix of all their ids."""
    null = np.array([d is None for d in doc_ids], dtype=np.uint8)
    numbers = np.array([0 if d is None else d for d in doc_ids], dtype="<i8")
    table = null.tobytes() + numbers.tobytes() + np.array(sizes, dtype="<u4").tobytes()
    return MAGIC + struct.pack("<Q", len(doc_ids)) + table + WaveletMatrix.build(ids).to_bytes()


def open_shard(blob: bytes) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    """What ``pack_shard`` was given: document ids, sizes, and the matrix, which reads from ``blob`` in place."""
    if blob[:4] != MAGIC:
        raise ValueError("not a token shard")
    (n,) = struct.unpack_from("<Q", blob, 4)
    null = np.frombuffer(blob, np.uint8, n, 12)
    numbers = np.frombuffer(blob, "<i8", n, 12 + n)
    sizes = np.frombuffer(blob, "<u4", n, 12 + 9 * n)
    ids = [None if gone else d for d, gone in zip(numbers.tolist(), null.tolist(), strict=True)]
    return ids, sizes, WaveletMatrix.from_bytes(blob, 12 + 13 * n)


# --- tables ---------------------------------------------------------------------------------------------------


def write_shards(
    docs: DataFrame, path: str, *, tokenizer: str | None = None, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS
) -> None:
    """Encode every whole text (null: empty), add ``end_id``, and write shards in ascending order of ``doc_id``.

    Rows without an id come first, rows that repeat an id by their text. A shard is closed behind the document that
    brings it to ``shard_tokens``, so a task holds that many ids and one document more. An empty table makes an
    empty one. Columns other than ``doc_id`` and ``text`` are not looked at. A task that is lost is run again
    and writes the same shards, which count once, as Spark commits them.
    """
    source = tokenizer or default_tokenizer()

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        codec = encoder(source)
        end = array(codec.code, [end_id]).tobytes()
        doc_ids: list[int | None] = []
        held: list[bytes] = []
        n = 0

        def shard() -> pd.DataFrame:
            ids = np.frombuffer(b"".join(held), dtype=codec.dtype)
            blob = pack_shard(doc_ids, [len(h) // codec.dtype.itemsize for h in held], ids)
            return pd.DataFrame({"part": [part], "seq": [seq], "n_tokens": [len(ids)], "n_docs": [len(doc_ids)], "blob": [blob]})

        rows = (([None if pd.isna(d) else int(d) for d in b["doc_id"].astype(object)], b["text"].tolist()) for b in batches)
        # A unit is looked at once a chunk, so chunks are made of several batches.
        for numbers, some in across(rows, CHUNK_BYTES):
            for doc_id, found in zip(numbers, codec.encode(some), strict=True):
                doc_ids.append(doc_id)
                held.append(found + end)
                n += len(held[-1]) // codec.dtype.itemsize
                if n >= shard_tokens:
                    yield shard()
                    doc_ids, held, n, seq = [], [], 0, seq + 1
        if doc_ids:
            yield shard()
        pa.default_memory_pool().release_unused()  # the worker lives on through later stages

    (
        docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("doc_id").alias("_order"), "text")
        .repartitionByRange("_order")
        .sortWithinPartitions("_order", "text")
        .select("doc_id", "text")
        .mapInPandas(encode, "part int, seq int, n_tokens long, n_docs long, blob binary")
        .write.parquet(path)
    )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32, part, seq`` of every document, from the shards alone.

    ``start``: ids of all documents before it; ``ids_crc32``: unsigned crc32 of its ids as little-endian unsigned
    32-bit numbers. The blobs are decoded where they are read; only numbers are shuffled.
    """
    shards = spark.read.parquet(path)

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, seq, blob in zip(batch["part"], batch["seq"], batch["blob"], strict=True):
                doc_ids, sizes, matrix = open_shard(blob)
                raw = memoryview(np.ascontiguousarray(matrix.decode(), dtype="<u4")).cast("B")
                ends = np.cumsum(sizes, dtype=np.int64)
                sums = [zlib.crc32(raw[4 * (e - s) : 4 * e]) for s, e in zip(sizes.tolist(), ends.tolist(), strict=True)]
                yield pd.DataFrame({
                    "doc_id": pd.array(doc_ids, dtype="Int64"), "_in": ends - sizes, "n_tokens": sizes.astype(np.int64),
                    "ids_crc32": sums, "part": part, "seq": seq,
                })

    found = shards.select("part", "seq", "blob").mapInPandas(
        decode, "doc_id long, _in long, n_tokens long, ids_crc32 long, part int, seq int"
    )
    # A row per part of the write comes together to be summed up; shards only with those of their part.
    earlier_parts = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
        .select("part", F.coalesce(F.sum("n").over(earlier_parts), F.lit(0)).alias("_before"))
    )
    offsets = (
        shards.select("part", "seq", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)).alias("_earlier"))
        .join(parts, "part")
    )
    return found.join(offsets, ["part", "seq"]).select(
        "doc_id", (F.col("_before") + F.col("_earlier") + F.col("_in")).alias("start"), "n_tokens", "ids_crc32", "part", "seq"
    )


def encode_documents(docs: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write the shards (to ``path`` or to a new folder in the shared scratch space) and read the documents back."""
    path = path or scratch_path(docs.sparkSession, "token-shards")
    write_shards(docs, path, **options)
    return read_documents(docs.sparkSession, path)
