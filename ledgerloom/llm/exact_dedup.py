"""Exact duplicates through an extendible-hash index in shared files.

Texts are equal when they are identical after deleting the six ASCII white spaces. The index is built in bulk:

1. A first pass sums the bytes under each of the 2**``FINEST`` beginnings of the texts' hash keys. From these sums the
   directory grows: an overfull bucket is split by the next bit of the key, and where the bucket is as deep as the
   directory, the directory doubles. A bucket that is overfull at the finest depth, as one text with very many
   copies makes it, gets overflow pages in a chain instead.
2. A second pass looks equal texts up within a window of ``WINDOW_BYTES`` of a task and sends each once, with the rows that
   have it, to the owner of its bucket (or of one of the bucket's pages). The owner's rows come sorted by key; texts
   with one key form a chain and are compared byte by byte. What the owners write is the index: ``owner, key, chain, entry``,
   the digest, the rows, and the text at the first entry of each chain.
3. Only texts that begin chains in overflow pages are compared once more, between the pages of their bucket.

The directory is bounded (65,536 slots) whatever the input is: buckets hold at least ``bucket_bytes`` or a 32,768th of all
bytes. All else is read from the written index; a lost task is run again and writes the same rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ledgerloom.session import scratch_path

WHITE = b" \t\n\x0b\x0c\r"
FINEST = 16
BUCKET_BYTES = 4 << 20
WINDOW_BYTES = 16 << 20
#: Parts that the entries of one text are dealt into when they are summed up and joined.
SALTS = 64


def normal(raw: bytes | None) -> bytes:
    """UTF-8 without white space; null is empty. No byte of a longer character is one of those deleted."""
    return raw.translate(None, WHITE) if raw else b""


def key_of(text: bytes, key_bits: int = 64) -> int:
    """The first ``key_bits`` bits of the text's hash; the rest are zero."""
    return xxhash.xxh3_64_intdigest(text) >> (64 - key_bits) << (64 - key_bits)


class Directory:
    """Slots of an extendible hash: the first ``depth`` bits of a key name a slot, a slot names a bucket.

    ``sizes``: the bytes under each of the ``2**FINEST`` finest beginnings. Buckets lie in the order of their keys, so that
    consecutive owners hold consecutive ranges of keys.
    """

    def __init__(self, sizes: np.ndarray, capacity: int) -> None:
        before = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
        depth, buckets = 0, []
        open_buckets = [(0, 0)]  # beginning and local depth
        while open_buckets:
            prefix, local = open_buckets.pop()
            shift = FINEST - local
            held = int(before[(prefix + 1) << shift] - before[prefix << shift])
            if held > capacity and local < FINEST:
                depth = max(depth, local + 1)  # doubles where the bucket was as deep as the directory
                open_buckets += [(2 * prefix + 1, local + 1), (2 * prefix, local + 1)]
            else:
                buckets.append((local, max(1, -(-held // capacity))))
        self.depth = depth
        self.local = np.array([b[0] for b in buckets])
        self.pages = np.array([b[1] for b in buckets], dtype=np.int64)
        self.first_page = np.cumsum(self.pages) - self.pages
        self.slots = np.repeat(np.arange(len(buckets)), 1 << (depth - self.local))

    def owner(self, key: int, turn: int) -> tuple[int, bool]:
        """The owner of a key, and whether its bucket has overflow pages, which entries take in turn."""
        bucket = self.slots[key >> (64 - self.depth)] if self.depth else 0
        pages = int(self.pages[bucket])
        return int(self.first_page[bucket]) + turn % pages, pages > 1


def _sizes(docs: DataFrame, key_bits: int) -> np.ndarray:
    """Bytes under each finest beginning of a key, summed up by Spark; at most ``2**FINEST`` rows come to the driver."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << FINEST, dtype=np.int64)
        for batch in batches:
            for raw in batch.column(0).cast(pa.binary()).to_pylist():
                text = normal(raw)
                total[key_of(text, key_bits) >> (64 - FINEST)] += len(text) + 1
        slots = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int32()), pa.array(total[slots], pa.int64())], names=["slot", "size"])

    out = np.zeros(1 << FINEST, dtype=np.int64)
    for slot, size in docs.select("text").mapInArrow(measure, "slot int, size long").groupBy("slot").agg(F.sum("size")).collect():
        out[slot] = size
    return out


def _entries(docs: DataFrame, directory: Directory, key_bits: int, window_bytes: int) -> DataFrame:
    """Each distinct text of a window once: ``owner, paged, key, entry, digest, text, members``."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        "owner int, paged boolean, key long, entry long, digest binary, text binary, "
        f"members array<struct<doc_id: {id_type}, points: long, at: long>>"
    )

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 33
        rows = entries = held = 0
        window: dict[bytes, list[tuple]] = {}
        id_arrow = None

        def flush() -> pa.RecordBatch:
            nonlocal entries
            keys = [key_of(t, key_bits) for t in window]
            numbers = range(base + entries, base + entries + len(window))
            owners = [directory.owner(k, xxhash.xxh3_64_intdigest(n.to_bytes(8, "little"))) for k, n in zip(keys, numbers, strict=True)]
            entries += len(window)
            flat = [m for found in window.values() for m in found]
            members = pa.StructArray.from_arrays(
                [pa.array([m[0] for m in flat], id_arrow), pa.array([m[1] for m in flat], pa.int64()), pa.array([m[2] for m in flat], pa.int64())],
                names=["doc_id", "points", "at"],
            )
            ends = np.cumsum([0, *map(len, window.values())]).astype(np.int32)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([o for o, _ in owners], pa.int32()), pa.array([p for _, p in owners], pa.bool_()),
                    pa.array([k - (1 << 63) for k in keys], pa.int64()), pa.array(list(numbers), pa.int64()),
                    pa.array([hashlib.sha256(t).digest() for t in window], pa.binary()), pa.array(list(window), pa.binary()),
                    pa.ListArray.from_arrays(pa.array(ends), members),
                ],
                names=["owner", "paged", "key", "entry", "digest", "text", "members"],
            )

        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            id_arrow = ids.type
            points = pc.fill_null(pc.utf8_length(texts), 0).to_pylist()
            for doc_id, n, raw in zip(ids.to_pylist(), points, texts.cast(pa.binary()).to_pylist(), strict=True):
                text = normal(raw)
                found = window.get(text)
                if found is None:
                    if held > window_bytes:
                        yield flush()
                        window, held = {}, 0
                    found = window[text] = []
                    held += len(text) + 200
                found.append((doc_id, n, base + rows))
                rows += 1
                held += 60
        if window:
            yield flush()

    return docs.select("doc_id", "text").mapInArrow(combine, schema)


class Chains:
    """Chains of the texts that share a key, for rows that come sorted by key."""

    def __init__(self) -> None:
        self.key, self.texts = None, []

    def place(self, key: tuple, text: bytes) -> tuple[int, bool]:
        """The number of the text in the chain of its key, by comparing bytes, and whether it is new there."""
        if key != self.key:
            self.key, self.texts = key, []
        for i, other in enumerate(self.texts):
            if other == text:
                return i, False
        self.texts.append(text)
        return len(self.texts) - 1, True


def build_index(
    docs: DataFrame, path: str, *, bucket_bytes: int = BUCKET_BYTES, window_bytes: int = WINDOW_BYTES, key_bits: int = 64
) -> Directory:
    """Write the index of all texts of ``docs`` (``doc_id, text``) to ``path``. ``key_bits`` below 64 makes keys collide."""
    sizes = _sizes(docs, key_bits)
    directory = Directory(sizes, max(bucket_bytes, int(sizes.sum()) >> 15))
    entries = _entries(docs, directory, key_bits, window_bytes)

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chains = Chains()
        for batch in batches:
            texts = batch.column("text").to_pylist()
            owners, keys = (batch.column(c).to_pylist() for c in ("owner", "key"))
            placed = [chains.place((o, k), t) for o, k, t in zip(owners, keys, texts, strict=True)]
            columns = {name: batch.column(name) for name in batch.schema.names}
            columns["text"] = pa.array([t if new else None for t, (_, new) in zip(texts, placed, strict=True)], pa.binary())
            columns["chain"] = pa.array([c for c, _ in placed], pa.int32())
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    schema = StructType([*entries.schema.fields, StructField("chain", IntegerType())])
    (
        entries.repartition("owner").sortWithinPartitions("owner", "key", "entry")
        .mapInArrow(own, schema).write.parquet(path)
    )
    return directory


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The entries of the index with the place of their text: ``key, home, chain`` are one for equal texts, and only for them.

    ``home`` is the owner that has the text; for texts in overflow pages, the first of these owners.
    """
    index = spark.read.parquet(path)
    starts = index.where("paged AND text IS NOT NULL").select("key", "owner", "chain", "text")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chains, firsts = Chains(), {}
        for batch in batches:
            keys, owners, numbers, texts = (batch.column(c).to_pylist() for c in ("key", "owner", "chain", "text"))
            homes = []
            for key, owner, number, text in zip(keys, owners, numbers, texts, strict=True):
                if key != chains.key:
                    firsts = {}
                place, _ = chains.place(key, text)
                homes.append(firsts.setdefault(place, (owner, number)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("owner"), batch.column("chain"),
                 pa.array([h[0] for h in homes], pa.int32()), pa.array([h[1] for h in homes], pa.int32())],
                names=["key", "owner", "chain", "home", "home_chain"],
            )

    met = (
        starts.repartition("key").sortWithinPartitions("key", "owner", "chain")
        .mapInArrow(meet, "key long, owner int, chain int, home int, home_chain int")
    )
    rest = ("entry", "digest", "members")
    return (
        index.where("NOT paged").select("key", F.col("owner").alias("home"), "chain", *rest)
        .unionByName(
            index.where("paged").join(met, ["key", "owner", "chain"])
            .select("key", "home", F.col("home_chain").alias("chain"), *rest)
        )
    )


def groups(index: DataFrame) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row that the index was built from.

    The entries of one text are summed up and answered in ``SALTS`` parts, so that no part of a text with very many copies
    is much larger than others.
    """
    place = ["key", "home", "chain"]
    best = F.array_min(
        F.transform("members", lambda m: F.struct((-m.points).alias("p"), m.doc_id.isNull().alias("n"), m.doc_id.alias("doc_id"), m["at"].alias("at")))
    )
    entries = index.withColumn("salt", F.pmod(F.xxhash64("entry"), F.lit(SALTS)))
    parts = entries.groupBy(*place, "salt").agg(F.min(best).alias("b"), F.sum(F.size("members")).alias("n"))
    whole = parts.groupBy(*place).agg(F.min("b").alias("best"), F.sum("n").alias("group_size"))
    answers = parts.select(*place, "salt").join(whole, place)
    return (
        entries.join(answers, [*place, "salt"])
        .select(F.explode("members").alias("m"), "best", "group_size", "digest")
        .select(
            "m.doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
            (F.col("m.at") == F.col("best.at")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"),
        )
    )


def exact_duplicates(docs: DataFrame, path: str | None = None, **options) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row of ``docs`` (columns ``doc_id, text``).

    Of equal texts the row with the most code points in its original text stays, then the one with the least ``doc_id``; a
    row without id comes after all ids, and of rows that still tie one stays. Null, empty and white texts are equal. Rows
    that repeat are copies like any others. An empty table gives an empty table. Other columns are not looked at. The
    index lies at ``path`` or in a new folder in the shared scratch space.
    """
    path = path or scratch_path(docs.sparkSession, "exact-index")
    build_index(docs, path, **options)
    return groups(read_index(docs.sparkSession, path))
