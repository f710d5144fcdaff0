import hashlib
import random
import sys
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from helpers import SHAPE, awkward, awkward_rows, empty, rows_of, with_clashes
from tokenizers import Tokenizer

from ledgerloom.llm import pieces, token_alignment
from ledgerloom.llm.token_alignment import Aligner, Alignment, Csr

COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
SCRAPS = ["a", "The", " ", "  ", "\n", "\t", " of the", "'s", ",", ". ", "é", "été ", "日本語", "\U0001f600", "<s>", "<|endoftext|>",
          "<0x41>", " ", "\x00", " \n", "12", "zzgq", "ﬁ", "́", "ion of", "don't"]


@pytest.fixture(scope="module")
def libraries():
    a_path, b_path = token_alignment.default_tokenizers()
    a = Tokenizer.from_file(a_path)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=b_path)


def plain_tokens(libraries, text):
    """(id, end) of the tokens of both, by the libraries; None where their bytes are not the text's."""
    a, b = libraries
    if not text:
        return None
    alphabet = {}
    n = 0
    for byte in range(256):
        if 33 <= byte <= 126 or 161 <= byte <= 172 or 174 <= byte <= 255:
            alphabet[chr(byte)] = byte
        else:
            alphabet[chr(256 + n)] = byte
            n += 1
    a_ids = a.encode(" " + text, add_special_tokens=False).ids
    a_bytes = [bytes(alphabet[c] for c in a.id_to_token(i)) for i in a_ids]
    b_ids = b.encode(text)
    b_bytes = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in b_ids]
    if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
        return None
    return [[(i, int(e)) for i, e in zip(ids, np.cumsum([len(x) for x in found]))] for ids, found in ((a_ids, a_bytes), (b_ids, b_bytes))]


def plainly(libraries, rows):
    counts, found = Counter(), []
    for doc_id, text in rows:
        tokens = plain_tokens(libraries, text)
        linked, groups = [], []
        if tokens:
            a, b = tokens
            b_end = {e: i for i, e in b}
            linked = [(i, b_end[e]) for i, e in a if e in b_end]
            counts.update(linked)
            rest = [list(reversed(side)) for side in (a, b)]
            for cut in [e for _, e in a if e in b_end]:
                inside = [[], []]
                for side, ids in zip(rest, inside):
                    while side and side[-1][1] <= cut:
                        ids.append(str(side.pop()[0]))
                groups.append("|".join(map(",".join, inside)))
        found.append((doc_id, tokens, linked, groups))
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return sorted(
        (
            (doc_id, len(t[0]) if t else 0, len(t[1]) if t else 0, len(groups), len(linked), sum(counts[x] == best[x[1]] for x in linked),
             sum(counts[x] for x in linked), hashlib.sha256(";".join(groups).encode()).hexdigest() if t else "")
            for doc_id, t, linked, groups in found
        ),
        key=repr,
    )


def table(spark, texts):
    return spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], SHAPE)


def scraps(seed, n, most=25):
    rng = random.Random(seed)
    return ["".join(rng.choice(SCRAPS) for _ in range(rng.randint(0, most))) for _ in range(n)]


def test_like_the_libraries(spark, libraries):
    texts = scraps(1, 500) + ["a▁b", "▁", "plain ▁ text"]
    wanted = plainly(libraries, list(enumerate(texts)))
    assert rows_of(token_alignment.align_documents(table(spark, texts).repartition(3), block_links=300), *COLUMNS) == wanted


def test_real_documents(spark, libraries):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    wanted = plainly(libraries, [tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert rows_of(token_alignment.align_documents(docs), *COLUMNS) == wanted


def test_awkward_rows(spark, libraries):
    wanted = plainly(libraries, [(r[0], r[1]) for r in awkward_rows()])
    assert rows_of(token_alignment.align_documents(awkward(spark)), *COLUMNS) == wanted
    assert rows_of(token_alignment.align_documents(with_clashes(awkward(spark))), *COLUMNS) == wanted
    found = token_alignment.align_documents(empty(spark))
    assert found.columns == list(COLUMNS) and found.count() == 0


def test_long_texts_and_forgetting(libraries, monkeypatch):
    """Segments, and a memory that holds next to nothing."""
    texts = [*scraps(2, 40, 200), "", "a▁b " * 60]
    whole = Aligner(*token_alignment.default_tokenizers())
    wanted = [(n_a, n_b, codes.tolist(), digest) for n_a, n_b, codes, digest in whole.documents(texts)]
    small = Aligner(*token_alignment.default_tokenizers(), kept=500)
    monkeypatch.setattr(token_alignment, "CHUNK_BYTES", 10)
    monkeypatch.setattr(token_alignment, "segments", lambda raw: pieces.segments(raw, 30))
    assert [(n_a, n_b, codes.tolist(), digest) for n_a, n_b, codes, digest in small.documents(texts)] == wanted
    small.b.ends_at_spaces = False  # whole texts instead of pieces
    assert [(n_a, n_b, codes.tolist(), digest) for n_a, n_b, codes, digest in small.documents(texts)] == wanted


def test_memory_weighs_what_it_takes(monkeypatch):
    """What is known of a piece takes no more memory than it is counted with, and a product is not of all new pieces."""
    both = Aligner(*token_alignment.default_tokenizers())
    most = 0

    def align(texts, align=both.align):
        nonlocal most
        most = max(most, len(texts))
        return align(texts)

    monkeypatch.setattr(both, "align", align)
    rng = random.Random(7)
    list(both.documents([" ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(30_000))]))
    known = both.known.young

    def size(x):
        return sys.getsizeof(x) + (sum(map(sys.getsizeof, x)) if isinstance(x, tuple) else 0)

    assert len(known) > 20_000 and sum(size(k) + size(v) for k, v in known.items()) <= both.known.held
    assert most <= 10_000


def test_links_of_each_kind(spark, libraries):
    texts = [*scraps(3, 30), "tokenization unbelievably"]
    docs = table(spark, texts)
    found = {kind: rows_of(token_alignment.links(docs, kind), "doc_id", "a_at", "b_at", "a_id", "b_id", "weight") for kind in ("overlap", "end", "group")}
    wanted = {"overlap": [], "end": [], "group": []}
    for doc_id, text in enumerate(texts):
        tokens = plain_tokens(libraries, text)
        if not tokens:
            continue
        cuts = sorted({e for _, e in tokens[0]} & {e for _, e in tokens[1]})
        spans = [list(zip([0, *[e for _, e in side]], side)) for side in tokens]
        for i, (a_start, (a, a_end)) in enumerate(spans[0]):
            for j, (b_start, (b, b_end)) in enumerate(spans[1]):
                row = (doc_id, i, j, a, b)
                if (common := min(a_end, b_end) - max(a_start, b_start)) > 0:
                    wanted["overlap"].append((*row, common))
                if a_end == b_end:
                    wanted["end"].append((*row, 1))
                if next(k for k, c in enumerate(cuts) if a_end <= c) == next(k for k, c in enumerate(cuts) if b_end <= c):
                    wanted["group"].append((*row, 1))
    assert found == {kind: sorted(rows, key=repr) for kind, rows in wanted.items()} and len(found["group"]) > len(found["end"])
    with pytest.raises(ValueError):
        token_alignment.links(docs, "other")


def test_products_are_those_of_dense_matrices():
    rng = np.random.default_rng(5)

    def random_csr(rows, columns):
        dense = rng.integers(0, 4, (rows, columns)) * (rng.random((rows, columns)) < 0.3)
        r, c = np.nonzero(dense)
        return dense, Csr(np.concatenate(([0], np.cumsum(np.bincount(r, minlength=rows)))), c, dense[r, c], columns)

    def dense_of(m):
        out = np.zeros((len(m.first) - 1, m.width), dtype=np.int64)
        out[m.rows, m.columns] = m.values
        return out

    for n, m, k in ((3, 4, 5), (20, 30, 10), (1, 1, 1), (6, 0, 3), (0, 3, 2)):
        (x, a), (y, b) = random_csr(n, m), random_csr(m, k)
        assert np.array_equal(dense_of(a.times(b)), x @ y)
        assert np.array_equal(dense_of(a.transposed()), x.T)
    nothing = Alignment(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))
    assert len(nothing.a) == 0 and len(nothing.shared().columns) == 0
