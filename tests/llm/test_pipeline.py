"""The registered queries and the pipeline on the small tables."""

import collections
import re
import zlib

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from ledgerloom.llm import decontaminate, mixing, near_dedup, quality_gam, token_shards
from ledgerloom.llm.registry import ORACLE_SQL, QUERIES, table

DATA = contract.SMALL


def test_queries_are_registered_under_their_numbers():
    assert {int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES if q != "pipeline"} == set(range(1, 14))
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE_SQL) <= set(contract.oracle_sql())
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "near-duplicates", "benchmark decontamination", "mix of sources", "token shards",
    ]


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - ORACLE_SQL.keys() - {"pipeline"}))
def test_query_answers_for_every_document(spark, name):
    found = QUERIES[name](spark, DATA).select("doc_id").collect()
    assert sorted(r.doc_id for r in found) == sorted(r.doc_id for r in table(spark, DATA, "documents").select("doc_id").collect())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_against_sql(spark, name):
    duck = duckdb.connect()
    for name_of in ("pages", "documents"):
        duck.execute(f"CREATE VIEW {name_of} AS SELECT * FROM '{DATA}/{name_of}.parquet'")
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    answer = duck.execute(ORACLE_SQL[name])
    order = [[d[0] for d in answer.description].index(c) for c in columns]
    assert sorted(map(repr, (tuple(r) for r in df.select(*columns).collect()))) == sorted(
        repr(tuple(r[i] for i in order)) for r in answer.fetchall()
    )


def test_pipeline_stages_follow_each_other(spark):
    docs = table(spark, DATA, "documents")
    stages = dict(corpus_pipeline.STAGES)
    texts = lambda df: {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}

    good = stages["quality classifier"](spark, docs, DATA)
    model = quality_gam.train(docs, table(spark, DATA, "labels"))
    expected = {d: t for d, t in texts(docs).items() if model.probability(quality_gam.feature_matrix([t]))[0] >= 0.3}
    assert texts(good) == expected

    unique = stages["near-duplicates"](spark, good, DATA)
    sets = {d: set(near_dedup.shingles(near_dedup.normal(t), 5).tolist()) for d, t in expected.items()}
    parent = {d: d for d in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if b < a and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((top(a), top(b)))
                parent[high] = low
    kept = {d: t for d, t in expected.items() if top(d) == d}
    assert texts(unique) == kept

    clean = stages["benchmark decontamination"](spark, unique, DATA)
    _, automata = decontaminate.load_items(table(spark, DATA, "benchmark"))
    free = texts(clean)
    for d, t in kept.items():
        spans = [s for auto in automata for s in decontaminate.match(decontaminate.normal_words(t), auto)[0]]
        if not spans:
            assert free[d] == t
        else:
            share = decontaminate.marked(len(decontaminate.normal_words(t)), spans).mean()
            assert (d in free) == (share <= 0.5)
    assert not any(decontaminate.match(decontaminate.normal_words(t), a)[0] for t in free.values() for a in automata)

    mixed = stages["mix of sources"](spark, clean, DATA)
    assert mixed.columns == docs.columns
    pieces = mixed.collect()
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    taken = collections.Counter()
    for r in pieces:
        assert r.text in free[r.doc_id] and r.n_chars == len(r.text)
        taken[r.doc_id] += count(r.text)
    assert all(n <= 2 * count(free[d]) for d, n in taken.items())
    assert sum(taken.values()) == pytest.approx(1.5 * sum(map(count, free.values())), rel=0.1)
    assert mixing.SHARE == 1.5

    library = Tokenizer.from_file(token_shards.default_tokenizer())
    places = sorted(tuple(r) for r in stages["token shards"](spark, mixed, DATA).select("start", "doc_id", "n_tokens", "ids_crc32").collect())
    start, ordered = 0, sorted(pieces, key=lambda r: (r.doc_id, r.text))
    assert len(places) == len(ordered)
    for place, piece in zip(places, ordered, strict=True):
        ids = [*library.encode(piece.text, add_special_tokens=False).ids, 2]
        assert place == (start, piece.doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_run_gives_the_last_stage(spark):
    found = corpus_pipeline.run(spark, DATA)
    assert {"doc_id", "start", "n_tokens", "ids_crc32"} <= set(found.columns) and found.count() > 0
