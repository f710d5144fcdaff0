"""Alignment of two tokenizers' tokens over the bytes of a text, by products of sparse incidence matrices.

``A`` and ``B`` have a row for each token and a column for each byte. The product of ``A`` and the transpose of ``B``, by
Gustavson's row products, has the bytes that two tokens have in common: the overlap links. Of these, the links whose tokens end
at the same byte cut both sequences into groups. The incidence of tokens and groups, multiplied alike, links all
tokens that share a group.

Neither tokenizer's tokens cross a space between two characters that are no white space, where such a piece is its own
unit to both; so a text's alignment is that of its pieces, and a piece that recurs is aligned once. Texts go into blocks of
``BLOCK_LINKS`` links, which are written as rows of Parquet files: ``block``, per document its numbers and the digest of its
groups, and the block's distinct id pairs, how often each links and which one each link is. Spark sums up the pairs over
all blocks, finds the highest of each id of B, and sends every block the answers for its own distinct pairs.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from itertools import pairwise, starmap

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import chunks
from ledgerloom.llm.pieces import CHUNK_BYTES, KEPT, ByteLevel, Memory, Units, gathered, segments
from ledgerloom.session import materialize, scratch_path

BLOCK_LINKS = 1 << 18
BLOCK_DOCS = 20_000
#: New pieces that are aligned in one product.
ALIGNED = 8_000


# --- sparse matrices ------------------------------------------------------------------------------------------


class Csr:
    """Compressed sparse rows: row ``i`` has ``columns`` and ``values`` from ``first[i]`` up to ``first[i + 1]``."""

    def __init__(self, first: np.ndarray, columns: np.ndarray, values: np.ndarray, width: int) -> None:
        self.first, self.columns, self.values, self.width = first, columns, values, width

    @classmethod
    def spans(cls, ends: np.ndarray, width: int) -> Csr:
        """Rows that cover the columns one after the other, each up to its end."""
        return cls(np.concatenate(([0], ends)), np.arange(width), np.ones(width, dtype=np.int64), width)

    @classmethod
    def single(cls, columns: np.ndarray, width: int) -> Csr:
        """Rows with a one in one column each."""
        n = len(columns)
        return cls(np.arange(n + 1), columns, np.ones(n, dtype=np.int64), width)

    @property
    def rows(self) -> np.ndarray:
        """The row of each stored value."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def transposed(self) -> Csr:
        order = np.argsort(self.columns, kind="stable")
        first = np.concatenate(([0], np.cumsum(np.bincount(self.columns, minlength=self.width))))
        return Csr(first, self.rows[order], self.values[order], len(self.first) - 1)

    def times(self, other: Csr) -> Csr:
        """The product, by Gustavson: row ``i`` is the sum of the rows of ``other`` that row ``i`` names, times their values."""
        sizes = np.diff(other.first)[self.columns]
        total = int(sizes.sum())
        from_row = np.repeat(self.rows, sizes)
        at = np.repeat(other.first[self.columns] - (np.cumsum(sizes) - sizes), sizes) + np.arange(total)
        columns, values = other.columns[at], np.repeat(self.values, sizes) * other.values[at]
        place = from_row * other.width + columns
        if total and (place[1:] < place[:-1]).any():
            order = np.argsort(place, kind="stable")
            place, values = place[order], values[order]
        new = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1]))) if total else np.zeros(0, dtype=np.int64)
        sums = np.add.reduceat(values, new) if total else values
        rows, columns = np.divmod(place[new], max(1, other.width))
        counts = np.bincount(rows, minlength=len(self.first) - 1)
        return Csr(np.concatenate(([0], np.cumsum(counts))), columns, sums, other.width)


class Alignment:
    """Two token sequences over the same bytes. ``a_ends`` and ``b_ends``: where their tokens end."""

    def __init__(self, a_ends: np.ndarray, b_ends: np.ndarray) -> None:
        self.a_ends, self.b_ends = a_ends, b_ends
        n = int(a_ends[-1]) if len(a_ends) else 0
        #: Overlap links: for each token of A the tokens of B that it has bytes in common with, and how many.
        self.overlap = Csr.spans(a_ends, n).times(Csr.spans(b_ends, n).transposed())
        rows = self.overlap.rows
        together = a_ends[rows] == b_ends[self.overlap.columns]
        #: Links of tokens that end together.
        self.a, self.b = rows[together], self.overlap.columns[together]
        cuts = a_ends[self.a]
        #: Tokens of A and of B, by the group that they lie in.
        self.a_groups = Csr.single(np.searchsorted(cuts, a_ends), len(cuts))
        self.b_groups = Csr.single(np.searchsorted(cuts, b_ends), len(cuts))

    def shared(self) -> Csr:
        """Links of all tokens that share a group."""
        return self.a_groups.times(self.b_groups.transposed())

    def groups(self) -> tuple[Csr, Csr]:
        """Rows of groups: their tokens of A, their tokens of B."""
        return self.a_groups.transposed(), self.b_groups.transposed()


# --- the two tokenizers ---------------------------------------------------------------------------------------


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class PieceModel:
    """Ids and bytes of a sentencepiece model that puts a space before a text."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.model.get_piece_size()
        names = [self.model.id_to_piece(i) for i in range(self.size)]
        self.bytes_of = [
            bytes([int(name[3:5], 16)]) if self.model.is_byte(i) else name.replace("▁", " ").encode() for i, name in enumerate(names)
        ]
        self.lengths = np.array([len(b) for b in self.bytes_of], dtype=np.int64)
        #: Whether no piece has a space behind another character, so that words may be encoded apart.
        self.ends_at_spaces = not any("▁" in name.lstrip("▁") for name in names)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1) if texts else []


_HEAD = struct.Struct("<III?")


def packed(n_a: int, n_b: int, codes: bytes, groups: str, ok: bool) -> bytes:
    """What is known of a piece as one object: several objects for each piece take more than twice the memory."""
    return _HEAD.pack(n_a, n_b, len(codes), ok) + codes + groups.encode()


class Aligner:
    """Aligns texts by their pieces; what is known of a piece: how many tokens, its links' id pairs, and its groups."""

    def __init__(self, a_path: str, b_path: str, kept: int = KEPT) -> None:
        # Only new pieces are encoded, so A's own memory of units is small.
        self.a, self.b = ByteLevel(a_path, special_as_text=True, kept=kept // 10), PieceModel(b_path)
        self.code = np.dtype("<u4" if self.a.size * self.b.size <= 1 << 32 else "<i8")
        self.known = Memory(kept)

    def tokens(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of A of a space and the text, and ids of B of the text; None where their bytes are not those, or no text."""
        out: list[tuple[np.ndarray, np.ndarray] | None] = []
        for text, raw, b in zip(texts, self.a.encode([" " + t for t in texts]), self.b.encode(texts), strict=True):
            a = np.frombuffer(raw, self.a.dtype).astype(np.int64)
            whole = (" " + text).encode()
            same = text and b"".join([self.a.bytes_of[i] for i in a.tolist()]) == whole == b"".join([self.b.bytes_of[i] for i in b])
            out.append((a, np.array(b, dtype=np.int64)) if same else None)
        return out

    def align(self, texts: list[str]) -> list[tuple[int, int, bytes, str, bool]]:
        """Per text: tokens of A, tokens of B, the id pairs of its links (``a * size of B + b``), its groups written out, and
        whether it can be aligned. All texts are in one product, as blocks along its diagonal."""
        found = self.tokens(texts)
        pairs = [f for f in found if f is not None]
        if not pairs:
            return [(0, 0, b"", "", False)] * len(texts)
        a, b = (np.concatenate([p[side] for p in pairs]) for side in (0, 1))
        whole = Alignment(np.cumsum(self.a.lengths[a]), np.cumsum(self.b.lengths[b]))
        codes = (a[whole.a] * self.b.size + b[whole.b]).astype(self.code)
        a_rows, b_rows = whole.groups()
        a_text, b_text = list(map(str, a.tolist())), list(map(str, b.tolist()))
        a_first, a_in, b_first, b_in = (x.tolist() for m in (a_rows, b_rows) for x in (m.first, m.columns))
        groups = [
            ",".join([a_text[k] for k in a_in[i:j]]) + "|" + ",".join([b_text[k] for k in b_in[p:q]])
            for (i, j), (p, q) in zip(pairwise(a_first), pairwise(b_first), strict=True)
        ]
        # A text ends with a group, so groups and links, of which each group has one, are parted at the texts' last tokens.
        ends = np.searchsorted(whole.a, np.cumsum([len(p[0]) for p in pairs]) - 1) + 1
        cuts = iter(pairwise([0, *ends.tolist()]))
        out = []
        for pair in found:
            if pair is None:
                out.append((0, 0, b"", "", False))
                continue
            i, j = next(cuts)
            out.append((len(pair[0]), len(pair[1]), codes[i:j].tobytes(), ";".join(groups[i:j]), True))
        return out

    def _fresh(self, names: list[bytes]) -> Iterator[bytes]:
        """What is to be known of new pieces, some at a time, since a product takes far more memory than what it gives."""
        for i in range(0, len(names), ALIGNED):
            yield from starmap(packed, self.align([n.decode()[1:] for n in names[i : i + ALIGNED]]))

    def _parts(self, raws: list[bytes]) -> Iterator[tuple[int, int, np.ndarray, str, bool]]:
        """What ``align`` gives, for texts behind a space, by their pieces."""
        if not self.b.ends_at_spaces:
            for n_a, n_b, codes, groups, ok in self.align([r.decode()[1:] for r in raws]):
                yield n_a, n_b, np.frombuffer(codes, self.code), groups, ok
            return
        units = Units(raws, spaces_only=True)
        known = self.known.look_up(units.names, self._fresh)
        heads = np.frombuffer(b"".join([f[: _HEAD.size] for f in known]), dtype="<u4,<u4,<u4,?")
        bounds = np.concatenate(([0], units.ends))

        def per_part(field: str) -> list[int]:
            of_unit = heads[field].astype(np.int64)
            return np.diff(np.concatenate(([0], np.cumsum(of_unit[units.index])))[bounds]).tolist()

        ends_in = (heads["f2"].astype(np.int64) + _HEAD.size).tolist()
        codes, ends = gathered([f[_HEAD.size : e] for f, e in zip(known, ends_in, strict=True)], units.index, self.code)
        at = np.concatenate(([0], ends))[bounds].tolist()
        names = [f[e:].decode() for f, e in zip(known, ends_in, strict=True)]
        groups = list(map(names.__getitem__, units.index.tolist()))
        ok = per_part("f3")
        for i, (n_a, n_b, (lo, hi)) in enumerate(zip(per_part("f0"), per_part("f1"), pairwise(bounds.tolist()), strict=True)):
            yield n_a, n_b, codes[at[i] : at[i + 1]], ";".join(groups[lo:hi]), ok[i] == hi - lo

    def documents(self, texts: list[str]) -> Iterator[tuple[int, int, np.ndarray, str]]:
        """Per text: tokens of A, tokens of B, the id pairs of its links, and the digest of its groups. A text that is empty, or
        has a piece whose tokens do not give back its bytes, has no tokens and an empty digest."""
        raws = [b" " + t.encode() if t else b"" for t in texts]
        if sum(map(len, raws)) > 2 * CHUNK_BYTES:
            for raw in raws:
                yield self._long(raw)
            return
        for raw, (n_a, n_b, codes, groups, ok) in zip(raws, self._parts(raws), strict=True):
            yield (n_a, n_b, codes, hashlib.sha256(groups.encode()).hexdigest()) if ok and raw else self._nothing()

    def _nothing(self) -> tuple[int, int, np.ndarray, str]:
        return 0, 0, np.zeros(0, dtype=self.code), ""

    def _long(self, raw: bytes) -> tuple[int, int, np.ndarray, str]:
        """A text in segments, whose groups are written into the digest one after the other."""
        digest, n_a, n_b, links = hashlib.sha256(), 0, 0, []
        for part in segments(raw) if self.b.ends_at_spaces else [raw]:
            ((more_a, more_b, codes, groups, ok),) = self._parts([part])
            if not ok or not part:
                return self._nothing()
            digest.update((";" if links else "").encode() + groups.encode())
            n_a, n_b = n_a + more_a, n_b + more_b
            links.append(codes)
        return n_a, n_b, np.concatenate(links), digest.hexdigest()


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(paths: tuple[str, str]) -> Aligner:
    """One per worker process, so that tasks that follow each other share what is known."""
    if paths not in _ALIGNERS:
        _ALIGNERS[paths] = Aligner(*paths)
    return _ALIGNERS[paths]


# --- tables ---------------------------------------------------------------------------------------------------


def write_blocks(
    docs: DataFrame, path: str, *, tokenizers: tuple[str, str] | None = None, block_links: int = BLOCK_LINKS
) -> None:
    """Align every whole text and write blocks. One ends behind the document that brings it to ``block_links`` links."""
    paths = tokenizers or default_tokenizers()
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"block long, doc_ids array<{id_type}>, n_a array<long>, n_b array<long>, n_links array<long>, "
        "digests array<string>, pairs array<long>, counts array<long>, places binary"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        both = aligner(paths)
        block = TaskContext.get().partitionId() << 33
        held: list[tuple] = []
        n = 0
        id_arrow = None

        def close() -> pa.RecordBatch:
            links = np.concatenate([h[3] for h in held])
            pairs, places, counts = np.unique(links, return_inverse=True, return_counts=True)
            columns = [
                pa.array([block], pa.int64()), pa.array([[h[0] for h in held]], pa.list_(id_arrow)),
                *[pa.array([[h[k] for h in held]], pa.list_(pa.int64())) for k in (1, 2)],
                pa.array([[len(h[3]) for h in held]], pa.list_(pa.int64())), pa.array([[h[4] for h in held]], pa.list_(pa.string())),
                pa.array([pairs.astype(np.int64)], pa.list_(pa.int64())), pa.array([counts], pa.list_(pa.int64())),
                pa.array([places.astype(_place_type(len(pairs))).tobytes()], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["block", "doc_ids", "n_a", "n_b", "n_links", "digests", "pairs", "counts", "places"])

        for batch in batches:
            id_arrow = batch.column(0).type
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            at = 0
            for some in chunks(texts, CHUNK_BYTES):
                for doc_id, (n_a, n_b, codes, digest) in zip(ids[at : at + len(some)], both.documents(some), strict=True):
                    held.append((doc_id, n_a, n_b, codes, digest))
                    n += len(codes)
                    if n >= block_links or len(held) >= BLOCK_DOCS:
                        yield close()
                        held, n, block = [], 0, block + 1
                at += len(some)
        if held:
            yield close()

    docs.select("doc_id", "text").mapInArrow(run, schema).write.parquet(path)


def _place_type(n: int) -> str:
    return "<u2" if n <= 1 << 16 else "<u4"


def pair_counts(blocks: DataFrame, size_b: int) -> DataFrame:
    """``pair, a_id, b_id, n, best``: how many links have the two ids, and whether no other id of A has more with ``b_id``."""
    counted = (
        blocks.select(F.explode(F.arrays_zip("pairs", "counts")).alias("p"))
        .groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.counts").alias("n"))
        .withColumn("b_id", F.col("pair") % size_b)
    )
    counted = materialize(counted, "pairs")
    most = counted.groupBy("b_id").agg(F.max("n").alias("most"))
    return counted.join(most, "b_id").select(
        "pair", ((F.col("pair") - F.col("b_id")) / size_b).cast("long").alias("a_id"), "b_id", "n", (F.col("n") == F.col("most")).alias("best")
    )


def document_links(blocks: DataFrame, counts: DataFrame) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every document of the blocks.

    A block is answered once for each of its distinct pairs, so what is shuffled grows with blocks and not with links.
    """
    id_type = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    asked = blocks.select("block", F.posexplode("pairs").alias("at", "pair"))
    answers = asked.join(counts.select("pair", "n", "best"), "pair").select(F.col("block").alias("asker"), "at", "n", "best")
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

    def answer(block: pa.Table, answers: pa.Table) -> pa.Table:
        (row,) = block.to_pylist()
        at = answers.column("at").to_numpy()
        n, best = np.zeros(len(at), dtype=np.int64), np.zeros(len(at), dtype=np.int64)
        n[at], best[at] = answers.column("n").to_numpy(), answers.column("best").to_numpy(zero_copy_only=False)
        places = np.frombuffer(row["places"], _place_type(len(at)))
        ends = np.cumsum([0, *row["n_links"]])
        sums = [np.diff(np.concatenate(([0], np.cumsum(x[places])))[ends]) for x in (best, n)]
        # A group ends with the one link of its last tokens.
        columns = [
            block.column("doc_ids").combine_chunks().flatten(), row["n_a"], row["n_b"], row["n_links"], row["n_links"], *sums, row["digests"],
        ]
        return pa.table(dict(zip(names, columns, strict=True)))

    return (
        blocks.select("block", "doc_ids", "n_a", "n_b", "n_links", "digests", "places").groupBy("block")
        .cogroup(answers.groupBy("asker"))
        .applyInArrow(answer, f"doc_id {id_type}, {', '.join(f'{c} long' for c in names[1:-1])}, groups_sha256 string")
    )


def align_documents(
    docs: DataFrame, path: str | None = None, *, tokenizers: tuple[str, str] | None = None, block_links: int = BLOCK_LINKS
) -> DataFrame:
    """``document_links`` of every row of ``docs`` (``doc_id, text``), by blocks at ``path`` or in the shared scratch space.

    Texts that are null or empty, or whose tokens do not give back a space and the text, have zeros and an empty
    ``groups_sha256``. Rows that repeat count each, in the sums of pairs too; a row without id stays one. An empty table
    gives an empty table. Other columns are not looked at.
    """
    spark: SparkSession = docs.sparkSession
    path = path or scratch_path(spark, "alignment")
    paths = tokenizers or default_tokenizers()
    write_blocks(docs, path, tokenizers=paths, block_links=block_links)
    blocks = spark.read.parquet(path)
    return document_links(blocks, materialize(pair_counts(blocks, PieceModel(paths[1]).size), "pair-counts"))


def links(docs: DataFrame, kind: str = "overlap", *, tokenizers: tuple[str, str] | None = None) -> DataFrame:
    """The links themselves: ``doc_id, a_at, b_at, a_id, b_id, weight``, for places and ids of tokens.

    ``kind``: ``overlap`` (weight: bytes in common), ``end`` (tokens that end together) or ``group`` (tokens of one group).
    """
    if kind not in ("overlap", "end", "group"):
        raise ValueError(f"unknown kind of link: {kind}")
    paths = tokenizers or default_tokenizers()
    id_type = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "a_at", "b_at", "a_id", "b_id", "weight"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(paths)
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                (pair,) = both.tokens([text or ""])
                if pair is None:
                    continue
                a, b = pair
                whole = Alignment(np.cumsum(both.a.lengths[a]), np.cumsum(both.b.lengths[b]))
                if kind == "end":
                    rows, columns, weight = whole.a, whole.b, np.ones(len(whole.a), dtype=np.int64)
                else:
                    product = whole.overlap if kind == "overlap" else whole.shared()
                    rows, columns, weight = product.rows, product.columns, product.values
                ids = pa.array([doc_id.as_py()], batch.column(0).type).take(pa.array(np.zeros(len(rows), dtype=np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [ids, *[pa.array(x.astype(np.int64)) for x in (rows, columns, a[rows], b[columns], weight)]], names=names
                )

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, {', '.join(f'{c} long' for c in names[1:])}")
