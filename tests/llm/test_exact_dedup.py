import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from helpers import SHAPE, awkward, awkward_rows, empty, rows_of, with_clashes

from ledgerloom.llm import exact_dedup
from ledgerloom.llm.exact_dedup import Directory

COLUMNS = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def plainly(rows):
    """Group by the text itself; the answer as a multiset."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        text = text or ""
        groups[re.sub(r"[\x20\x09-\x0D]", "", text)].append((-len(text), doc_id is None, doc_id or 0, doc_id))
    out = []
    for text, members in groups.items():
        members.sort()
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(m[3], members[0][3], len(members), i == 0, digest) for i, m in enumerate(members)]
    return sorted(out, key=repr)


def copies(seed, n=400):
    """Some texts with many copies that differ by white space, one with a third of all rows."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        text = "the hot one" if i % 3 == 0 else f"text {rng.randrange(60)} é\U0001f600"
        rows.append((i, "".join(c + " " * rng.randrange(3) if c != " " else rng.choice(" \t\n") for c in text)))
    rng.shuffle(rows)
    return rows


def table(spark, rows):
    return spark.createDataFrame([(*r, None, None, None) for r in rows], SHAPE)


def test_awkward_rows(spark):
    rows = [(r[0], r[1]) for r in awkward_rows()]
    assert rows_of(exact_dedup.exact_duplicates(awkward(spark)), *COLUMNS) == plainly(rows)
    assert rows_of(exact_dedup.exact_duplicates(with_clashes(awkward(spark))), *COLUMNS) == plainly(rows)


def test_an_empty_table(spark):
    found = exact_dedup.exact_duplicates(empty(spark))
    assert found.columns == list(COLUMNS) and found.count() == 0


@pytest.mark.parametrize("options", [
    {},
    {"key_bits": 16},
    {"key_bits": 18, "bucket_bytes": 64, "window_bytes": 300},
    {"bucket_bytes": 64, "window_bytes": 1},
])
def test_copies_are_found_whatever_the_buckets(spark, options):
    rows = copies(5)
    docs = table(spark, rows).repartition(5)
    assert rows_of(exact_dedup.exact_duplicates(docs, **options), *COLUMNS) == plainly(rows)


def test_colliding_keys_are_told_apart(spark, monkeypatch):
    """All texts under one key: one bucket with overflow pages, and chains that only bytes tell apart."""
    rows = copies(6, 120)
    monkeypatch.setattr(exact_dedup, "key_of", lambda text, bits=64: 7 << 60)
    docs = table(spark, rows).repartition(3)
    for options in ({}, {"bucket_bytes": 100, "window_bytes": 200}):
        assert rows_of(exact_dedup.exact_duplicates(docs, **options), *COLUMNS) == plainly(rows)


def test_the_text_of_each_class_is_in_the_index_once(spark, tmp_path):
    rows = copies(8)
    path = str(tmp_path / "index")
    exact_dedup.build_index(table(spark, rows).repartition(4), path)
    texts = [bytes(r[0]).decode() for r in spark.read.parquet(path).where("text IS NOT NULL").select("text").collect()]
    assert sorted(texts) == sorted({re.sub(r"\s", "", t) for _, t in rows})


def test_the_directory_doubles_and_splits():
    sizes = np.zeros(1 << exact_dedup.FINEST, dtype=np.int64)
    assert Directory(sizes, 10).depth == 0
    sizes[0], sizes[1 << 15] = 6, 6
    halves = Directory(sizes, 10)
    assert halves.depth == 1 and halves.slots.tolist() == [0, 1] and halves.owner(1 << 63, 5) == (1, False)
    sizes[1 << 15] = 95  # one beginning that no further bit can split
    deep = Directory(sizes, 10)
    assert deep.depth == exact_dedup.FINEST and deep.pages.max() == 10
    assert {deep.owner(1 << 63, turn)[0] for turn in range(40)} == set(range(1, 11)) and deep.owner(1 << 63, 0)[1]
    assert deep.owner(0, 3) == (0, False)
    for slot in range(0, 1 << deep.depth, 997):  # each slot leads to the bucket whose beginning it shares
        bucket = deep.slots[slot]
        first = int(np.flatnonzero(deep.slots == bucket)[0])
        assert slot >> (deep.depth - deep.local[bucket]) == first >> (deep.depth - deep.local[bucket])
