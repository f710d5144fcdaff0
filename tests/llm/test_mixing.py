import collections
import re

import numpy as np
import pytest
from helpers import SHAPE, awkward, awkward_rows, empty, rows_of, with_clashes, words

from ledgerloom.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_targets_reshare_what_is_above():
    assert mixing.targets([100, 100, 100], [5, 2, 1]) == pytest.approx([200, 500 / 3 * 1, 250 / 3])
    assert mixing.targets([10, 1000], [5, 2]) == pytest.approx([20, 1495])
    assert mixing.targets([0, 0], [5, 2]) == [0, 0] and mixing.targets([], []) == []


@pytest.mark.parametrize("size", [1, 2, 3, 7, 64, 65, 1000])
def test_permutation_has_every_index_once(size):
    for key in (1, 2, 99):
        found = mixing.permuted(np.arange(size), np.full(size, size), np.full(size, key))
        assert sorted(found.tolist()) == list(range(size))


def test_shards_agree_with_each_other_and_meet_the_plan():
    wanted = np.array([1000, 37, 0, 512])
    mixed = mixing.Mix(list("abcd"), [0] * 4, [0.0] * 4, np.array([600, 20, 0, 300]), wanted, 3, 100)
    total = np.zeros(4, dtype=int)
    for shard in range(mixed.shards):
        counts, before = mixing.shard_counts(mixed, shard)
        assert (before == total).all()
        assert counts.sum() == (100 if shard < mixed.shards - 1 else mixed.slots - 100 * (mixed.shards - 1))
        total += counts
    assert (total == wanted).all()


def test_small_sources_give_their_words_together(spark):
    sizes = spark.createDataFrame([(f"s{i:03}", 100) for i in range(300)], "source string, source_size long")
    mixed = mixing.plan(sizes, block_words=256, shard_slots=50, seed=11)
    assert mixed.slots * 100 == pytest.approx(sum(mixed.targets), abs=100)
    light = mixed.wanted[2::3]
    assert light.min() == 0 and light.max() == 1 and light.sum() * 100 == pytest.approx(sum(mixed.targets[2::3]), rel=0.2)
    assert (mixed.wanted[::3] == 2).all()


def test_mix_meets_targets(spark):
    docs = [(i, " ".join(words(20 + i % 90, i)), f"s{i % 4}", None) for i in range(200)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, n_chars long")
    rows = mixing.mix_documents(df, block_words=16, shard_slots=50).collect()
    sizes = {d: len(WORD.findall(t)) for d, t, _, _ in docs}
    source = {d: s for d, _, s, _ in docs}
    of_source = collections.Counter()
    for d, s in source.items():
        of_source[s] += sizes[d]
    goal = dict(zip("s0 s1 s2 s3".split(), mixing.targets([of_source[f"s{k}"] for k in range(4)], [5, 2, 1, 5]), strict=True))
    taken = collections.Counter()
    for r in rows:
        assert r["size"] == sizes[r.doc_id] and r.source_size == of_source[source[r.doc_id]]
        assert r.target == pytest.approx(goal[source[r.doc_id]])
        assert 0 <= r.taken <= 2 * r["size"]
        taken[source[r.doc_id]] += r.taken
    assert all(abs(taken[s] - goal[s]) <= 3 * 16 for s in goal)
    again = mixing.mix_documents(df.repartition(7), block_words=16, shard_slots=50).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))


def test_mixed_documents_hold_what_is_taken(spark):
    docs = [(i, "\n ".join(words(20 + i % 90, i)) + " ", f"s{i % 3}", "x", 0) for i in range(120)]
    docs += [docs[5], docs[5]]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, other string, n_chars int")
    out = mixing.mixed_documents(df, block_words=16, shard_slots=50)
    assert out.schema == df.schema
    found = collections.Counter()
    texts = {d[0]: d[1] for d in docs}
    for r in out.collect():
        assert r.text in texts[r.doc_id] and r.n_chars == len(r.text)
        found[r.doc_id] += len(WORD.findall(r.text))
    plain = collections.Counter()
    for r in mixing.mix_documents(df, block_words=16, shard_slots=50).collect():
        plain[r.doc_id] += r.taken
    # The order of words differs between the two calls (ids against whole rows), so only sources are compared.
    sources = {d[0]: d[2] for d in docs}
    for s in set(sources.values()):
        assert sum(n for d, n in found.items() if sources[d] == s) == pytest.approx(
            sum(n for d, n in plain.items() if sources[d] == s), abs=32
        )
    assert all(n <= 2 * len(WORD.findall(texts[d])) * sum(e[0] == d for e in docs) for d, n in found.items())


def test_blocks_come_out_in_the_shards_that_drew_them(spark):
    docs = [(i, " ".join(f"{i}.{k}" for k in range(1 + 7 * (i % 12))), f"s{i % 3}") for i in range(90)]
    docs += [docs[80], docs[80]]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    out = mixing.mixed_blocks(df, block_words=16, shard_slots=20).collect()
    mixed, *_ = mixing.mixture(df, block_words=16, shard_slots=20)
    assert mixed.shards > 2 and len(out) == mixed.slots
    for shard in range(mixed.shards):
        rows = [r for r in out if r.shard == shard]
        counts, _ = mixing.shard_counts(mixed, shard)
        assert [sum(r.source == s for r in rows) for s in mixed.names] == counts.tolist()
        assert sorted(r.slot for r in rows) == list(range(len(rows)))
    blocks, of = {}, {str(d[0]): d[2] for d in docs}
    for r in out:
        held = r.text.split()
        assert len(held) == r.n_words <= 16 and {of[w.split(".")[0]] for w in held} == {r.source}
        assert blocks.setdefault((r.source, r.block), r.text) == r.text
    assert len({(r.source, r.block, r.turn) for r in out}) == len(out)
    # The first pass over a source that is taken whole has all of its words.
    top = mixed.names[int(np.argmax(mixed.wanted >= mixed.blocks))]
    once = sorted(w for r in out if r.source == top and r.turn == 0 for w in r.text.split())
    assert once == sorted(w for d in docs if d[2] == top for w in d[1].split())
    assert mixing.mixed_blocks(empty(spark)).count() == 0 and mixing.mixed_blocks(awkward(spark)).count() > 0


def test_documents_come_out_in_their_longest_runs(spark):
    docs = [(i, "\n" + "  ".join(f"{i}.{k}" for k in range(10 + 7 * (i % 30))) + " ", "s") for i in range(60)]
    docs += [docs[29]]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    texts, found = {d[0]: d[1] for d in docs}, collections.defaultdict(list)
    for r in mixing.mixed_documents(df, block_words=16, shard_slots=50).collect():
        found[r.doc_id].append(r.text)
    # One source, of which the first pass takes every block and the second one half of them.
    for i, text in texts.items():
        copies = sum(d[0] == i for d in docs)
        assert found[i].count(text) >= copies
        spans = []
        for t in found[i]:
            places = [int(w.split(".")[1]) for w in t.split()]
            assert t in text and places == list(range(places[0], places[-1] + 1))
            spans.append((places[0], places[-1] + 1))
        for _ in range(copies):
            spans.remove((0, len(text.split())))
        if copies == 1:
            spans.sort()
            assert all(b < c for (_, b), (c, _) in zip(spans[:-1], spans[1:], strict=True))
    assert any(len(f) > 2 for f in found.values())


def test_awkward_rows_are_mixed(spark):
    columns = ("doc_id", "size", "source_size", "target", "taken")
    docs = awkward(spark)
    rows = rows_of(mixing.mix_documents(docs), *columns)
    assert sorted(repr((r[0], r[1])) for r in rows) == sorted(repr((r[0], len(WORD.findall(r[1] or "")))) for r in awkward_rows())
    assert all(r[4] <= 2 * r[1] for r in rows)
    assert rows_of(mixing.mix_documents(with_clashes(docs.select("doc_id", "text", "source")).drop("source_no")), *columns) == rows
    assert mixing.mix_documents(empty(spark)).count() == 0
    assert mixing.mixed_documents(empty(spark)).count() == 0
    pieces = mixing.mixed_documents(docs, block_words=64)
    assert pieces.schema == docs.schema and pieces.count() > 0


def test_large_nodes_are_drawn_like_small_ones(monkeypatch):
    rng = np.random.default_rng(3)
    for good, bad, sample in ((40, 60, 30), (5, 1000, 500), (3000, 10, 1500), (0, 5, 3), (7, 0, 4)):
        own = np.array([mixing._hypergeometric(good, bad, sample, rng) for _ in range(4000)])
        numpy = rng.hypergeometric(good, bad, sample, 4000)
        assert own.min() >= max(0, sample - bad) and own.max() <= min(good, sample)
        assert abs(own.mean() - numpy.mean()) < 0.12 * max(numpy.std(), 0.01) and abs(own.std() - numpy.std()) < 0.1 * max(numpy.std(), 0.01)
    counts = np.array([5 * 10**10, 3, 0, 2 * 10**10, 10**9], dtype=np.int64)
    left = 3 * 10**10
    drawn = mixing._halve(counts, left, rng)
    assert drawn.sum() == left and (drawn >= 0).all() and (drawn <= counts).all()
    share = left / counts.sum()
    off = np.abs(drawn - counts * share)[[0, 3, 4]]
    assert (off > 0).any() and (off < 6 * np.sqrt(counts[[0, 3, 4]] * share)).all()


def test_rows_without_id_or_with_one_id_mix_alike_in_any_order(spark):
    rows = [(None if i % 2 else 7, " ".join(words(40, i)), "en", "a" if i % 3 else None, None) for i in range(300)]
    one = spark.createDataFrame(rows, SHAPE).repartition(2)
    two = spark.createDataFrame(rows[::-1], SHAPE).repartition(7)
    for function in (mixing.mixed_documents, mixing.mix_documents):
        options = {"block_words": 16}
        a, b = (function(df, **options) for df in (one, two))
        assert rows_of(a, *a.columns) == rows_of(b, *b.columns)
