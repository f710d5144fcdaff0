import random

import numpy as np
import pytest
from helpers import awkward, awkward_rows, empty, rows_of, with_clashes, words

from ledgerloom.llm import near_dedup
from ledgerloom.llm.components import components


def sets_of(rows, k):
    out = []
    for _, text, *_ in rows:
        found = (text or "").encode().lower().split()
        n = min(k, len(found))
        out.append({tuple(found[i : i + n]) for i in range(len(found) - n + 1)} if found else set())
    return out


def plain_components(rows, k, percent):
    sets, parent = sets_of(rows, k), list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * len(sets[a] | sets[b]):
                parent[top(a)] = top(b)
    ids: dict[int, list] = {}
    for a, r in enumerate(rows):
        ids.setdefault(top(a), []).append(r[0])
    least = {t: min((i for i in found if i is not None), default=None) for t, found in ids.items()}
    return [(r[0], len(sets[a]), least[top(a)] if sets[a] else r[0]) for a, r in enumerate(rows)]


def groups(seed):
    """Groups of copies with more and more changes, so that many pairs lie near the border."""
    rng = random.Random(seed)
    rows = []
    for g in range(12):
        base = words(rng.randint(30, 200), seed * 100 + g, 5000)
        for _ in range(rng.randint(1, 14)):
            copy = list(base)
            for _ in range(rng.randint(0, len(base) // 18)):
                copy[rng.randrange(len(copy))] = f"new{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(copy)))
            if rng.random() < 0.2:
                base = copy
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_components_agree_with_all_pairs(spark, seed):
    rows = groups(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = near_dedup.near_duplicates(df, words=4)
    assert rows_of(found, "doc_id", "n_shingles", "component_id") == sorted(plain_components(rows, 4, 80), key=repr)
    assert found.where("kept <> (doc_id = component_id)").count() == 0


def test_awkward_rows(spark):
    docs = awkward(spark)
    found = near_dedup.near_duplicates(docs)
    expected = sorted(plain_components(awkward_rows(), 5, 80), key=repr)
    assert rows_of(found, "doc_id", "n_shingles", "component_id") == expected
    clashing = near_dedup.near_duplicates(with_clashes(docs))
    assert rows_of(clashing, "doc_id", "n_shingles", "component_id") == expected
    assert near_dedup.near_duplicates(empty(spark)).count() == 0
    kept = near_dedup.drop_duplicates(docs)
    assert kept.schema == docs.schema
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([1, 4, 5, 6, 7, 8, 10, None, None, 11, 12], key=repr)
    assert near_dedup.drop_duplicates(empty(spark)).count() == 0


def test_sketches_merge_and_agree_as_often_as_sets():
    rng = np.random.default_rng(0)
    values = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    a, b = values[:2000], values[400:2400]
    left, right = near_dedup.registers(a), near_dedup.registers(b)
    assert (np.maximum(left, right) == near_dedup.registers(np.union1d(a, b))).all()
    assert abs((left == right).mean() - 1600 / 2400) < 0.15


def test_likelihood_lets_similar_pairs_through():
    rng = np.random.default_rng(2)
    for shared, alone, wanted in ((900, 50, True), (850, 100, True), (100, 800, False), (500, 500, False)):
        for _ in range(20):
            values = rng.integers(0, 2**63, shared + 2 * alone, dtype=np.uint64)
            a, b = values[: shared + alone], np.concatenate((values[:shared], values[shared + alone :]))
            sketches = [near_dedup.registers(x)[None, :] for x in (a, b)]
            sizes = [np.array([float(len(x))]) for x in (a, b)]
            assert bool(near_dedup.worth_verifying(*sketches, *sizes, 0.8)[0]) == wanted


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 200), (1, 0), (300, 301)]
    df = spark.createDataFrame(links, "u long, v long")
    found = {r.node: r.component for r in components(df).collect()}
    assert found == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 140)}, 300: 300, 301: 300}
    assert components(df.where("false")).count() == 0


def test_one_of_each_group_stays_when_ids_repeat(spark):
    a, b, c = (" ".join(words(80, seed, 9000)) for seed in (31, 32, 33))
    near = a.replace(a.split()[40], "other")
    rows = [(1, a), (2, near), (2, b), (3, b.upper()), (5, c), (5, c), (6, c + " more")]
    kept = near_dedup.drop_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, kept.collect())) == [(1, a), (2, b), (5, c)]


def test_bits_bound_intersections():
    rng = np.random.default_rng(4)
    for _ in range(50):
        pool = rng.integers(0, 2**63, rng.integers(2, 3000), dtype=np.uint64)
        a, b = (np.unique(rng.choice(pool, rng.integers(1, len(pool)))) for _ in range(2))
        bits = [near_dedup.bit_map(x).view("<u8") for x in (a, b)]
        hidden = [len(x) - int(np.bitwise_count(m).sum()) for x, m in zip((a, b), bits, strict=True)]
        assert len(np.intersect1d(a, b)) <= int(np.bitwise_count(bits[0] & bits[1]).sum()) + min(hidden)


def test_only_marked_texts_are_shuffled_for_their_sets(spark, monkeypatch):
    texts = [" ".join(words(40, seed, 9000)) for seed in range(60)]
    docs = spark.createDataFrame([(i % 50, t) for i, t in enumerate([*texts, *texts])], "doc_id long, text string")
    classes = near_dedup.materialize(near_dedup.classes_of(near_dedup.sketched(docs, 4)), "classes")
    assert dict(classes.dtypes)["node"] == "bigint" and classes.select("node").distinct().count() == 60
    wanted = classes.orderBy("node").limit(3).collect()
    plans = []
    written = near_dedup.materialize

    def seen(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return written(df, label)

    monkeypatch.setattr(near_dedup, "materialize", seen)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = near_dedup.sets_of(docs, classes, spark.createDataFrame([(r.node,) for r in wanted], "node long"), 4).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    plan = plans[-1]
    assert 0 < plan.index("SortMergeJoin") < plan.index("BroadcastHashJoin") and plan.count("ArrowEvalPython") == 1
    nodes = {r.row.text_hash: r.node for r in wanted}
    hashed = docs.selectExpr("text", "xxhash64(text) AS h").distinct().collect()
    sets = {nodes[r.h]: near_dedup.shingles(near_dedup.normal(r.text), 4).tobytes() for r in hashed if r.h in nodes}
    assert len(found) == 3 and {r.node: bytes(r.shingles) for r in found} == sets
