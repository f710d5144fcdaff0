import random
import re
from collections import Counter, defaultdict

import pytest
from helpers import SHAPE, awkward, awkward_rows, empty, rows_of, with_clashes

from ledgerloom.llm import collocations
from ledgerloom.llm.collocations import Words, slices

COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def pieces(text):
    return [[w for w in re.split(r"[\x20\x09]+", p) if w] for p in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text or ""))]


def plainly(rows, order=4, min_count=30, top=2000):
    """All n-grams exploded and counted, for rows of language and text."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            n[lang] += len(words)
            for k in range(1, order + 1):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= min_count}
        found = []
        for p, a in candidates.items():
            inside = any(
                len(q) > len(p) and 100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in candidates.items()
            )
            cuts = [(2000000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            if not inside:
                found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out, key=repr)


def prose(seed, n=60):
    rng = random.Random(seed)
    common = ["Of", "the", "new", "york", "city", "é", "日本", "in", "order", "to", "\xa0x"]
    rare = [f"r{i}" for i in range(300)]
    phrases = ["New York City", "in order to", "of the", "as a matter of fact", "a a a a a"]
    rows = []
    for i in range(n):
        bits = [rng.choice(phrases) if rng.random() < 0.4 else rng.choice(common if rng.random() < 0.7 else rare) for _ in range(rng.randrange(60))]
        text = "".join(b + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".\n", "! "]) for b in bits)
        rows.append((None if i % 11 == 0 else "en" if i % 3 else "fr", text))
    return rows


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, None, None) for i, (lang, t) in enumerate(rows)], SHAPE)


@pytest.mark.parametrize("options", [
    {"min_count": 5},
    {"min_count": 3, "chunk_bytes": 40, "filter_bits": 128},
    {"min_count": 2, "order": 2, "top": 4},
    {"min_count": 4, "order": 5, "top": 7, "chunk_bytes": 1000},
])
def test_like_exploded_ngrams(spark, options):
    rows = prose(3) + prose(3)[:20]  # rows that repeat count each
    wanted = plainly(rows, **{k: v for k, v in options.items() if k in ("order", "min_count", "top")})
    assert wanted
    assert rows_of(collocations.collocations(table(spark, rows).repartition(3), **options), *COLUMNS) == wanted


def test_counts_of_all_lengths(spark):
    rows = prose(4, 30)
    f = Counter()
    for lang, text in rows:
        for words in pieces(text):
            f[("und" if lang is None else lang, "", 0)] += len(words)
            f.update(("und" if lang is None else lang, " ".join(words[i : i + k]), k) for k in range(1, 5) for i in range(len(words) - k + 1))
    wanted = sorted(((*p, c) for p, c in f.items() if p[2] == 0 or c >= 3), key=repr)
    assert rows_of(collocations.phrase_counts(table(spark, rows), min_count=3), "lang", "phrase", "size", "f") == wanted


def test_awkward_rows(spark):
    wanted = plainly([(r[2], r[1]) for r in awkward_rows()], min_count=2)
    assert rows_of(collocations.collocations(awkward(spark), min_count=2), *COLUMNS) == wanted
    assert rows_of(collocations.collocations(with_clashes(awkward(spark)).drop("n_chars"), min_count=2), *COLUMNS) == wanted


def test_an_empty_table(spark):
    found = collocations.collocations(empty(spark))
    assert found.columns == list(COLUMNS) and found.count() == 0


def test_large_counts_are_exact(spark):
    """Products beyond 64 bits."""
    big = 9_000_000_000_000_001
    counts = spark.createDataFrame([("en", "a", 1, big + 6), ("en", "b", 1, big + 11), ("en", "a b", 2, big)], "lang string, phrase string, size int, f long")
    row = collocations._cut_scores(counts.where("size = 2").withColumnRenamed("f", "a"), counts).first()
    assert row["score"] == 2_000_000 * big // (2 * big + 17)


def test_slices_join_to_the_whole_and_end_at_breaks():
    raw = b"abc def, ghi jkl. " * 20 + b"no break at the end of this one"
    for size in (1, 7, 50, 10_000):
        parts = list(slices(raw, size))
        assert b"".join(parts) == raw and all(p[-1:] in b",." for p in parts[:-1])


def test_words_of_texts():
    words = Words(["en", "fr", "en"], [b"A b, c", b"", b"b\td"])
    names = words.names.to_pylist()
    assert [names[i] for i in words.ids] == [b"a", b"b", b"c", b"b", b"d"]
    assert words.follows.tolist() == [True, False, False, True, False]
    assert [words.lang_names[i] for i in words.lang] == ["en"] * 5
    assert len(Words(["en"], [b""]).ids) == 0 and len(Words(["en"], [b""]).runs([])[1]) == 0
