"""URL lists, quality rules and benchmark decontamination against plain versions."""

import hashlib
import random
import re

import numpy as np
import pytest
from helpers import awkward, awkward_rows, empty, rows_of, with_clashes, words

from ledgerloom.llm import decontaminate, quality_rules, url_filter

CAPTURES = "page_id long, url string, fetched_at long"
ENTRIES = "list string, kind string, pattern string, verdict string, event string, at long"


def plain_verdict(url, at, entries):
    found = re.match(url_filter._HOST, url or "")
    if not found or at is None:
        return 0, None, False
    host, path = found[1].lower(), re.match(url_filter._PATH, url)[1]
    labels, segments = host.split("."), path.split("/")
    keys = {("host", host)} | {("domain", ".".join(labels[i:])) for i in range(len(labels))}
    keys |= {("prefix", host + "/".join(segments[:i])) for i in range(2, max(2, len(segments)) + 1)}
    hits = []
    for key in keys:
        verdicts = set()
        for name in {e[0] for e in entries}:
            past = sorted(
                {e for e in entries if e[0] == name and (e[1], e[2]) == key and e[5] is not None and e[5] <= at},
                key=lambda e: (e[5], e[4] == "add", e[3]),
            )
            if past and past[-1][4] == "add":
                verdicts.add(past[-1][3])
        if verdicts:
            hits.append((url_filter.KINDS[key[0]], len(key[1]), "allow" in verdicts, ":".join(key)))
    best = max(hits, default=None)
    return len(hits), best and best[3], bool(best) and not best[2]


def test_as_of_join_agrees_with_a_plain_one(spark):
    rng = random.Random(3)
    hosts = ["a.example.com", "b.example.com", "x.y.org", "example.com"]
    entries = []
    for _ in range(150):
        kind = rng.choice(["host", "domain", "prefix"])
        host = rng.choice(hosts)
        pattern = {"host": host, "domain": host.split(".", 1)[-1], "prefix": f"{host}/p{rng.randrange(3)}"}[kind]
        entries.append((rng.choice("AB"), kind, pattern, rng.choice(["allow", "block"]), rng.choice(["add", "remove"]), rng.randrange(60)))
    captures = [
        (i, f"http{'s' * (i % 2)}://{rng.choice(hosts).upper()}/p{rng.randrange(3)}/q?x=1", rng.randrange(70)) for i in range(300)
    ]
    captures += [(900, None, 5), (901, "not a url", 5), (902, f"http://{hosts[0]}", None), (903, f"http://u:p@{hosts[0]}:80/p1", 30), captures[0]]
    shown = url_filter.filter_urls(
        spark.createDataFrame(captures, CAPTURES), spark.createDataFrame([*entries, entries[0]], ENTRIES), rows_per_task=20
    )
    plain = [(c[0], *plain_verdict(c[1], c[2], entries)) for c in captures]
    assert rows_of(shown, "page_id", "n_patterns", "rule", "blocked") == sorted(plain, key=repr)


def test_url_filter_awkward_tables(spark):
    captures = spark.createDataFrame([(1, "http://a.com/x", 5)], CAPTURES)
    entries = spark.createDataFrame(
        [("L", "host", "a.com", "block", "add", 1), ("L", "host", None, "block", "add", 1), (None, "host", "a.com", None, "add", 1),
         ("L", "shape", "a.com", "block", "add", 1), ("L", "host", "a.com", "block", "add", None)], ENTRIES
    )
    assert rows_of(url_filter.filter_urls(with_clashes(captures), entries), "page_id", "rule", "blocked") == [(1, "host:a.com", True)]
    assert rows_of(url_filter.filter_urls(captures, entries.where("false")), "page_id", "rule", "blocked") == [(1, None, False)]
    assert url_filter.filter_urls(captures.where("false"), entries).count() == 0


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    found = WORD.findall(text)
    windows = {}
    for i in range(len(found) - 7):
        windows.setdefault(tuple(found[i : i + 8]), []).append(i)
    hit = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit)


def test_base_counts():
    rng = random.Random(4)
    for _ in range(400):
        text = "".join(rng.choice(["a", "b ", "c\n", " ", "\n", "#", "é ", " ", " ", "\x1c"]) for _ in range(rng.randint(0, 120)))
        assert quality_rules.base_counts(text) == plain_counts(text)
    for _ in range(100):
        text = " ".join(rng.choice("ab") for _ in range(rng.randint(0, 60)))
        assert quality_rules.base_counts(text) == plain_counts(text)


def test_ratio_is_that_of_the_counts(spark):
    docs = spark.createDataFrame([(i, " ".join(words(50, i, 60)) + (" $$$ ###" if i % 3 == 0 else ".")) for i in range(60)], "doc_id long, text string")
    trusted = docs.where("doc_id % 3 <> 0")
    ratios = quality_rules.train(docs, trusted)
    counts = [
        sum(np.bincount(quality_rules.ngram_buckets(r.text), minlength=quality_rules.BUCKETS) for r in df.collect()) for df in (trusted, docs)
    ]
    p, q = ((c + quality_rules.SMOOTH) / (c.sum() + quality_rules.SMOOTH * quality_rules.BUCKETS) for c in counts)
    assert ratios == pytest.approx(np.log(p / q))
    for r in quality_rules.judge(docs, ratios, threshold=0.0).join(docs, "doc_id").collect():
        llr = np.log(p / q)[quality_rules.ngram_buckets(r.text)].mean()
        assert r.llr == pytest.approx(llr) and r.kept == (llr >= 0 and not r.base_failed)


def test_rules_on_awkward_rows(spark):
    docs = awkward(spark)
    ratios = quality_rules.train(docs, quality_rules.trusted_by_label(docs, spark.createDataFrame([(1, 1), (1, 1), (None, 1), (3, None)], "doc_id long, quality int")))
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    expected = []
    for doc_id, text, *_ in awkward_rows():
        c = plain_counts(text or "")
        expected.append((doc_id, *c, c[0] < 20 or 100 * c[4] > 30 * c[0]))
    judged = quality_rules.judge(docs, ratios)
    assert rows_of(judged, *columns) == sorted(expected, key=repr)
    assert judged.where("base_failed AND kept").count() == 0
    assert rows_of(quality_rules.judge(with_clashes(docs), ratios), *columns) == sorted(expected, key=repr)
    assert quality_rules.judge(empty(spark), ratios).count() == 0
    assert not quality_rules.train(docs, empty(spark)).any()


def plain_hits(found, items, window=10):
    hit, of = set(), set()
    for item_id, text in items:
        item = decontaminate.normal_words(text)
        k = min(window, len(item))
        windows = {tuple(item[i : i + k]) for i in range(len(item) - k + 1)} if item else set()
        for i in range(len(found) - k + 1 if windows else 0):
            if tuple(found[i : i + k]) in windows:
                of.add(str(item_id))
                hit |= set(range(i, i + k))
    return len(hit), of


def test_automaton_against_windows():
    rng = random.Random(6)
    for _ in range(800):
        window = rng.choice([2, 3, 4])
        items = [(n, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 8)))) for n in range(rng.randint(0, 5))]
        text = [rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(rng.randint(0, 30))]
        auto = decontaminate.build([(n, decontaminate.normal_words(t)) for n, t in items], window)
        spans, found = decontaminate.match(text, auto)
        assert (int(decontaminate.marked(len(text), spans).sum()), {str(n) for n in found}) == plain_hits(text, items, window)


@pytest.mark.parametrize("automaton_words", [2_000_000, 15])
def test_report_on_awkward_rows(spark, automaton_words):
    passage = " ".join(words(14, 50, 9000))
    items = [(1, passage), (2, "One"), (10, passage + " " + " ".join(words(5, 51))), (3, None), (4, ""), (5, "..."), (None, "no id AT all"), (2, "12 34")]
    rows = [*awkward_rows(), (20, f"before it, {passage.upper().replace(' ', ' - ')}! behind", "en", "a", 5)]
    docs = spark.createDataFrame(rows, awkward(spark).schema)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    named = [("" if i is None else i, t) for i, t in items]
    expected = []
    for doc_id, text, *_ in rows:
        found = decontaminate.normal_words(text)
        hit, of = plain_hits(found, named)
        expected.append((doc_id, len(found), hit, len(of), hashlib.sha256(",".join(sorted(of)).encode()).hexdigest(), hit > 0))
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert rows_of(decontaminate.report(docs, benchmark, automaton_words=automaton_words), *columns) == sorted(expected, key=repr)
    assert rows_of(decontaminate.report(with_clashes(docs), benchmark, automaton_words=automaton_words), *columns) == sorted(expected, key=repr)
    assert decontaminate.report(empty(spark), benchmark).count() == 0
    assert decontaminate.report(docs, benchmark.where("false")).where("contaminated").count() == 0


def test_cleaning_cuts_spans_and_drops_covered_documents(spark):
    passage = " ".join(words(20, 60, 9000))
    long, short = " ".join(words(100, 61)), "short"
    rows = [
        (1, f"{long} {passage} {long}", "en", "a", 1), (2, f"{short} {passage}", "en", "a", 2), (3, long, "en", "a", 3),
        (4, None, "en", "a", None), (5, "", "en", "a", 0), (None, f"{long}\n{passage.title()}.", None, None, 9),
    ]
    docs = spark.createDataFrame(rows, awkward(spark).schema)
    out = decontaminate.clean(docs, spark.createDataFrame([(1, passage)], "item_id long, text string"))
    assert out.schema == docs.schema
    found = {r.doc_id: r for r in out.collect()}
    assert set(found) == {1, 3, 4, 5, None}
    assert found[1].text == f"{long} {long}" and found[1].n_chars == len(found[1].text)
    assert found[3].text == long and found[3].n_chars == 3 and found[4].text is None and found[5].text == ""
    assert found[None].text == f"{long}\n ." and found[None].n_chars == len(found[None].text)
    assert decontaminate.clean(empty(spark), spark.createDataFrame([(1, passage)], "item_id long, text string")).count() == 0


def test_words_that_meet_at_a_cut_are_looked_at_again():
    auto = decontaminate.build([(1, decontaminate.normal_words("a b c d"))], 4)
    assert decontaminate.cut("x a b a b c d c d y z z z z z z z z z z", [auto], 0.5) == "x y z z z z z z z z z z"
