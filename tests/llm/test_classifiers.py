"""Quality, toxicity and language: accuracy on held-out rows, and every awkward row."""

import random

import numpy as np
import pandas as pd
import pytest
from helpers import awkward, awkward_rows, empty, is_held_out, rows_of, with_clashes, words

from ledgerloom.llm import language, quality_gam, toxicity
from ledgerloom.llm.common import held_out


@pytest.fixture(scope="module")
def corpus(spark):
    """Good documents in sentences, bad ones in capitals; some hold a word that makes them toxic, or a variant of it."""
    rng = random.Random(5)
    docs, labels = [], []
    for i in range(400):
        text = words(rng.randint(30, 200), i, 3000)
        toxic, bad = i % 4 == 0, i % 5 == 1
        if toxic:
            for _ in range(max(2, len(text) // 40)):
                text[rng.randrange(len(text))] = rng.choice(["grumbleck", "grumblecks", "grumbelck", "Grumbleckish"])
        line = " ".join(text)
        docs.append((i, (line.upper().replace(" ", "!! ") if bad else line.capitalize() + "."), ["en", "fr"][i % 2], "s", len(line)))
        if i % 10:
            labels.append((i, 0 if bad else 1, int(toxic)))
    shape = "doc_id long, text string, lang string, source string, n_chars long"
    return spark.createDataFrame(docs, shape), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_rows_follow_the_rule(spark):
    ids = [1, 2, 3, 17, 10**12, -5, None]
    df = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    assert {r.doc_id: r.h for r in df.select("doc_id", held_out().alias("h")).collect()} == {i: is_held_out(i) for i in ids}


def test_quality_separates_held_out_rows(corpus):
    docs, labels = corpus
    found = quality_gam.classify(docs, labels).where("held_out").join(labels, "doc_id").toPandas()
    assert len(found) > 40
    assert ((found["score"] >= 0.3).astype(int) == found["predicted"]).all()
    assert (found["predicted"] == found["quality"]).mean() > 0.97


def test_gam_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = np.zeros((4000, len(quality_gam.FEATURES)))
    x[:, :3] = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_gam.fit(x[:3000], y[:3000])
    assert (0, 1) in model.pairs
    assert ((model.probability(x[3000:]) > 0.5) == y[3000:]).mean() > 0.9


def test_gam_score_is_the_sum_of_looked_up_values():
    rng = np.random.default_rng(1)
    x = rng.random((300, len(quality_gam.FEATURES)))
    model = quality_gam.fit(x, (x[:, 0] + x[:, 4] > 1).astype(float), rounds=5, pair_rounds=3)
    for row in x[:20]:
        bins = [int((row[j] >= edges).sum()) for j, edges in enumerate(model.edges)]
        plain = model.intercept + sum(t[b] for t, b in zip(model.tables, bins, strict=True))
        plain += sum(t[bins[j], bins[k]] for (j, k), t in model.pairs.items())
        assert model.margin(row[None, :])[0] == pytest.approx(plain)


def test_toxicity_separates_held_out_rows_and_unseen_spellings(corpus):
    docs, labels = corpus
    model = toxicity.train(docs, labels)
    found = toxicity.classify(docs, labels).where("held_out").join(labels, "doc_id").toPandas()
    assert (found["predicted"] == found["toxic"]).mean() > 0.9
    plain = " ".join(words(25, 77, 3000))
    clean, variant = toxicity.probabilities([plain, plain + " grumblecky"], model)
    assert variant > clean + 0.2


def test_one_long_text_does_not_end_the_sample(spark, corpus):
    docs, labels = corpus
    long = docs.where("doc_id = 1").crossJoin(spark.range(40)).selectExpr(
        "1000 + id AS doc_id", "repeat(text, 300) AS text", "lang", "source", "n_chars"
    )
    marks = long.selectExpr("doc_id", "0 AS quality", "0 AS toxic")
    model = toxicity.train(docs.unionByName(long), labels.unionByName(marks), sample_chars=300_000)
    found = toxicity.scored(docs, model, "doc_id").where("doc_id % 10 <> 0").join(labels, "doc_id").toPandas()
    assert (found["predicted"] == found["toxic"]).mean() > 0.9


def test_budget_is_filled_from_either_class():
    rows = pd.DataFrame({"doc_id": range(8), "label": [0, 0, 0, 0, 1, 1, 1, 1], "h": range(8), "n": [900, 1, 2, 2, 5000, 3, 900, 2]})
    assert sorted(toxicity.within_budget(rows, 1000)["doc_id"]) == [1, 2, 3, 5, 7]
    assert sorted(toxicity.within_budget(rows, 2000)["doc_id"]) == [0, 1, 2, 3, 5, 6, 7]
    assert sorted(toxicity.within_budget(rows[:4], 1000)["doc_id"]) == [0, 1, 2, 3]
    assert toxicity.within_budget(rows[:0], 1000).empty


def test_unfitted_model_predicts_clean(spark, corpus):
    docs, labels = corpus
    found = toxicity.classify(docs, labels.where("false"))
    assert {r.predicted for r in found.select("predicted").collect()} == {0}
    assert {r.predicted for r in toxicity.classify(docs, labels, sample_chars=1).select("predicted").collect()} == {0}


def test_one_toxic_window_decides_a_long_text(corpus):
    model = toxicity.train(*corpus)
    plain = words(5000, 78, 3000)
    spoilt = plain[:4000] + ["grumbleck", "grumblecks"] * 3 + plain[4000:]
    clean, toxic = toxicity.probabilities([" ".join(plain), " ".join(spoilt)], model)
    assert toxic > 0.5 > clean


def test_word_values_are_averages_of_their_ngrams():
    weights = np.arange(toxicity.BUCKETS, dtype=float)
    together, first = toxicity.word_values(["Ab, cde!", "", "x"], weights)
    apart = [toxicity.word_values([w], weights)[0][0] for w in ("ab", "cde", "x")]
    assert together.tolist() == apart and first.tolist() == [0, 2, 2, 3]


def test_language_of_held_out_rows(spark):
    rng = random.Random(9)
    syllables = {"en": ["th", "ing", "er", "and"], "fr": ["eau", "oi", "ç", "elle"], "de": ["sch", "ü", "keit", "ein"]}
    docs = []
    for i in range(300):
        lang = ("en", "fr", "de")[i % 3]
        docs.append((i, " ".join("".join(rng.choices(syllables[lang], k=3)) for _ in range(rng.randint(5, 60))), lang))
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    found = language.identify(df).where("held_out").join(df, "doc_id").toPandas()
    assert (found["lang"] == found["lang_pred"]).mean() > 0.97
    assert found["score"].between(0, 1).all()


@pytest.mark.parametrize("classify", [quality_gam.classify, toxicity.classify])
def test_awkward_rows_are_scored(spark, corpus, classify):
    docs, labels = awkward(spark), spark.createDataFrame(
        [(1, 1, 0), (2, 1, 0), (3, None, None), (7, 0, 1), (7, 0, 1), (99, 1, 1), (None, 1, 1)], "doc_id long, quality int, toxic int"
    )
    found = classify(docs, labels)
    rows = rows_of(found, "doc_id", "held_out", "score", "predicted")
    assert [r[0] for r in rows] == sorted((r[0] for r in awkward_rows()), key=lambda d: repr((d,)))
    assert all(r[1] == is_held_out(r[0]) and 0 <= r[2] <= 1 for r in rows)
    by_id = {r[0]: r[2] for r in rows}
    assert by_id[4] == by_id[5] and by_id[7] == by_id[9]
    assert rows_of(classify(with_clashes(docs), labels), "doc_id", "held_out", "score", "predicted") == rows
    assert classify(empty(spark), labels).count() == 0
    assert classify(docs, labels.where("false")).count() == len(rows)


def test_awkward_rows_have_a_language(spark):
    docs = awkward(spark)
    found = language.identify(docs)
    rows = rows_of(found, "doc_id", "lang_pred", "score")
    assert {r[1] for r in rows if r[0] in (4, 5, 6, 8)} == {"und"}
    assert all(r[1] != "und" for r in rows if r[0] in (1, 3, 7, 10, 12, None))
    assert rows_of(language.identify(with_clashes(docs)), "doc_id", "lang_pred", "score") == rows
    assert language.identify(empty(spark)).count() == 0
    without = language.identify(docs.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang"))
    assert {r.lang_pred for r in without.collect()} == {"und"}


def test_quality_stage_keeps_rows_as_they_are(spark, corpus):
    docs, labels = corpus
    kept = quality_gam.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {
        r.doc_id for r in quality_gam.classify(docs, labels).where("predicted = 1").collect()
    }
