import random
import tracemalloc
import zlib

import numpy as np
import pytest
from helpers import awkward, awkward_rows, empty, rows_of, with_clashes, words
from tokenizers import Tokenizer

from ledgerloom.llm import pieces, token_counts, token_shards
from ledgerloom.llm.common import across
from ledgerloom.llm.pieces import ByteLevel, Memory, Units, segments
from ledgerloom.llm.token_shards import WaveletMatrix

PIECES = ["a", "b", "The", " ", "  ", "\n", "\t", " ", "'s", "'", "12", ".", "!", "é", "<|endoftext|>", "\x1c", " \n", "#", "日", " word"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(token_shards.default_tokenizer())


def random_text(rng, most):
    return "".join(rng.choice(PIECES) for _ in range(rng.randint(0, most)))


MORE = [*PIECES, ",", ", ", ".\n", "\n\n", "é\n", "\u00a0", "\u3000", "\u2003x", "don't,", "?!", "x.y", "\r\n", "\x85", "ß.", "\ufeff", "ⅷ", "٣", "́", "\x00"]


@pytest.mark.parametrize("pieces_used", [PIECES, MORE])
def test_units_encode_like_the_whole(library, pieces_used):
    codec, rng = ByteLevel(token_shards.default_tokenizer()), random.Random(0)
    texts = ["".join(rng.choice(pieces_used) for _ in range(rng.randint(0, 16))) for _ in range(3000)]
    for text, found in zip(texts, codec.encode(texts), strict=True):
        assert np.frombuffer(found, codec.dtype).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_documents_encode_like_the_whole(spark, library):
    texts = [r[0] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect() if r[0]]
    codec = ByteLevel(token_shards.default_tokenizer(), kept=200_000)  # so small that it forgets
    for i in range(0, len(texts), 100):
        for text, found in zip(texts[i : i + 100], codec.encode(texts[i : i + 100]), strict=True):
            assert np.frombuffer(found, codec.dtype).tolist() == library.encode(text, add_special_tokens=False).ids


def test_long_texts_are_cut_in_segments(library, monkeypatch):
    monkeypatch.setattr(pieces, "CHUNK_BYTES", 50)
    monkeypatch.setattr(pieces, "segments", lambda raw: segments(raw, 20))
    codec, rng = ByteLevel(token_shards.default_tokenizer()), random.Random(3)
    texts = ["".join(rng.choice(MORE) for _ in range(200)) for _ in range(30)] + [""]
    for text, found in zip(texts, codec.encode(texts), strict=True):
        assert np.frombuffer(found, codec.dtype).tolist() == library.encode(text, add_special_tokens=False).ids


def test_special_tokens_as_text(library):
    codec = ByteLevel(token_shards.default_tokenizer(), special_as_text=True)
    (found,) = codec.encode(["a <|endoftext|> b"])
    ids = np.frombuffer(found, codec.dtype).tolist()
    assert 50256 not in ids and library.decode(ids) == "a <|endoftext|> b"


def test_units_join_to_the_texts():
    rng = random.Random(4)
    raws = ["".join(rng.choice(MORE) for _ in range(rng.randint(0, 12))).encode() for _ in range(400)]
    for spaces_only in (True, False):
        units = Units(raws, spaces_only)
        ends = [0, *units.ends.tolist()]
        assert [b"".join(units.names[i] for i in units.index[a:b]) for a, b in zip(ends, ends[1:])] == raws


def test_memory_keeps_what_recurs():
    made = []
    memory = Memory(kept=1000)
    for i in range(200):
        assert memory.look_up([b"again", str(i).encode()], lambda names: made.extend(names) or [n + b"!" for n in names]) == [b"again!", b"%d!" % i]
    assert made.count(b"again") == 1 and len(made) == 201 and len(memory.young) + len(memory.old) < 20


def test_workers_hold_little():
    assert token_shards.encoder(token_shards.default_tokenizer()).known.kept == token_shards.KEPT <= 30_000_000
    n = 500_000
    value = np.arange(n, dtype="<u2").tobytes()
    tracemalloc.start()
    ids, ends = pieces.gathered([value], np.array([0]), np.dtype("<u2"))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert ids.tobytes() == value and ends.tolist() == [n]
    assert peak < 20 * n  # two numbers for a place at once, not three


@pytest.mark.parametrize("n", [0, 1, 2, 511, 512, 513, 2000])
def test_wavelet_matrix_answers(n):
    rng = random.Random(n)
    ids = np.array([rng.choice([2, 5, 7, 50_000, 9, 13]) if n != 1 else 4 for _ in range(n)], dtype=np.uint16)
    matrix = WaveletMatrix.from_bytes(WaveletMatrix.build(ids).to_bytes())
    assert matrix.decode().tolist() == ids.tolist()
    for _ in range(40 if n else 0):
        i, lo, hi, token = rng.randrange(n), rng.randint(0, n), rng.randint(0, n), rng.choice([2, 5, 50_000, 3])
        lo, hi = min(lo, hi), max(lo, hi)
        assert matrix.access(i) == ids[i] and matrix.count(token, lo, hi) == (ids[lo:hi] == token).sum()
        places = np.flatnonzero(ids == token)
        for nth in {0, len(places) // 2, len(places) - 1} & set(range(len(places))):
            assert matrix.select(token, nth) == places[nth]
    with pytest.raises(IndexError):
        matrix.select(3, 0)
    with pytest.raises(IndexError):
        matrix.access(n)


def expected(rows, library):
    start, out = 0, []
    for doc_id, text in sorted(((r[0], r[1] or "") for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        ids = [*library.encode(text, add_special_tokens=False).ids, 2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("shard_tokens", [50, 1 << 20])
def test_shards_read_back(spark, library, shard_tokens):
    docs = awkward(spark).repartition(3)
    found = token_shards.encode_documents(docs, shard_tokens=shard_tokens)
    columns = ("doc_id", "start", "n_tokens", "ids_crc32")
    rows = rows_of(found, *columns)
    assert rows == sorted(expected(awkward_rows(), library), key=repr)
    again = token_shards.encode_documents(with_clashes(docs.select("doc_id", "text")), shard_tokens=shard_tokens)
    assert rows_of(again, *columns) == rows


def test_no_documents_make_no_tokens(spark):
    assert token_shards.encode_documents(empty(spark)).count() == 0


def test_trees_follow_random_edits(library, monkeypatch):
    monkeypatch.setattr(token_counts, "LEAF_PIECES", 3)
    monkeypatch.setattr(token_counts, "LEAF_CHARS", 60)
    codec, rng = ByteLevel(token_shards.default_tokenizer()), random.Random(1)
    for _ in range(300):
        text = random_text(rng, 60)
        tree = token_counts.CountTree.of(codec, text)
        for _ in range(5):
            at, removed, added = rng.randint(0, len(text) + 2), rng.choice([0, 1, 3, rng.randint(0, len(text))]), random_text(rng, 6)
            tree.edit(at, removed, added)
            at = min(at, len(text))
            text = text[:at] + added + text[at + removed :]
            assert tree.text == text and tree.n_chars == len(text)
            assert tree.n_tokens == len(library.encode(text, add_special_tokens=False).ids)


def test_edits_of_a_long_text_encode_little(library):
    codec = ByteLevel(token_shards.default_tokenizer())
    tree = token_counts.CountTree.of(codec, " ".join(words(20_000, 4)))
    tree.edit(40_000, 5, "changed here")
    assert 0 < tree.encoded_chars < 1000


def test_counts_of_awkward_rows(spark, library):
    docs = awkward(spark)
    shape = "doc_id long, seq long, at long, removed long, added string"
    edits = [
        (1, 2, 3, 4, "second"), (1, 1, 0, 2, "first "), (4, 1, 0, 0, "text now"), (9, 1, 1, 99, None), (10, 1, 500, 3, " x "),
        (77, 1, 0, 0, "nobody"), (None, 1, 0, 0, "nobody"), (5, None, None, None, None), (7, 1, 99, 1, " end"),
    ]
    expected_rows = []
    for doc_id, text, *_ in awkward_rows():
        after, own = text or "", sorted((e for e in edits if e[0] == doc_id and doc_id is not None), key=lambda e: e[1] or 0)
        for _, _, at, removed, added in own:
            at = min(at or 0, len(after))
            after = after[:at] + (added or "") + after[at + (removed or 0) :]
        sizes = [len(library.encode(t, add_special_tokens=False).ids) for t in (text or "", after)]
        expected_rows.append((doc_id, sizes[0], len(own), sizes[1], len(after)))
    columns = ("doc_id", "n_tokens", "n_edits", "n_tokens_edited", "n_chars_edited")
    changes = spark.createDataFrame(edits, shape)
    found = token_counts.count_with_edits(docs, changes)
    assert rows_of(found, *columns) == sorted(expected_rows, key=repr)
    clashing = token_counts.count_with_edits(with_clashes(docs.select("doc_id", "text")), changes)
    assert rows_of(clashing, *columns) == sorted(expected_rows, key=repr)
    assert token_counts.count_with_edits(empty(spark), changes).count() == 0
    assert token_counts.count_with_edits(docs, changes.where("false")).agg({"n_edits": "sum"}).collect()[0][0] == 0


def test_chunks_are_made_of_several_batches():
    """Short batches go together up to the size in bytes, in order; a longer text is a chunk of its own."""
    texts = ["a" * 10, None, "é" * 10, "", "b" * 300, "日" * 30, *["c" * 9] * 40]
    batches = [(list(range(i, min(i + 3, len(texts)))), texts[i : i + 3]) for i in range(0, len(texts), 3)]
    found = list(across(batches, 100))
    assert [i for ids, _ in found for i in ids] == list(range(len(texts)))
    assert [t for _, some in found for t in some] == [t or "" for t in texts]
    sizes = [sum(len(t.encode()) for t in some) for _, some in found]
    assert all(size <= 100 or len(some) == 1 for size, (_, some) in zip(sizes, found, strict=True))
    assert len(found) < len(batches) and list(across([], 100)) == []
