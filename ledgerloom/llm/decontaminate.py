"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton has every substring of words of every item, and no string across two items. A document's words
are streamed through it; after each word it tells the longest run of words, ending there, that an item holds. Where
that run has ``window`` words or more, its last ``window`` words are a window of some item, and are marked; an
item shorter than a window is marked where all of it occurs. The marked words make spans, which are cut from the
text; a document whose marked share exceeds a limit is dropped.

Items are numbered and packed into automata of at most ``automaton_words`` words; documents are streamed
through each, so the size of one automaton, which is broadcast, is bounded however many items there are.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 10
# Of UTF-8, in which all bytes of a character beyond ASCII are over 0x7F; lower() of bytes is that of A-Z.
_WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass").lower()


def normal_words(text: str | None) -> list[bytes]:
    """The words of a text after A-Z are lower-cased: runs of a-z, 0-9 and everything beyond ASCII."""
    return _WORDS.findall(lowered(text)) if text else []


@dataclass
class Automaton:
    """States of a generalised suffix automaton: transitions, suffix links, longest lengths, items inside."""

    window: int
    following: list[dict[bytes, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    length: list[int] = field(default_factory=lambda: [0])
    short_ends: dict[int, list[tuple[int, int]]] = field(default_factory=dict)
    shortest: int = 0
    items: list[set[int]] = field(default_factory=list)

    def _extend(self, last: int, word: bytes) -> int:
        if word in self.following[last]:
            q = self.following[last][word]
            return q if self.length[q] == self.length[last] + 1 else self._split(last, word, q)
        new = self._state({}, self.length[last] + 1)
        at = last
        while at >= 0 and word not in self.following[at]:
            self.following[at][word] = new
            at = self.link[at]
        if at < 0:
            self.link[new] = 0
        else:
            q = self.following[at][word]
            self.link[new] = q if self.length[q] == self.length[at] + 1 else self._split(at, word, q)
        return new

    def _state(self, following: dict[bytes, int], length: int) -> int:
        self.following.append(following)
        self.link.append(0)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, at: int, word: bytes, q: int) -> int:
        clone = self._state(dict(self.following[q]), self.length[at] + 1)
        self.link[clone] = self.link[q]
        self.link[q] = clone
        while at >= 0 and self.following[at].get(word) == q:
            self.following[at][word] = clone
            at = self.link[at]
        return clone

    def _walk(self, words: list[bytes]) -> Iterator[int]:
        state = 0
        for word in words:
            state = self.following[state][word]
            yield state

    def state_of(self, state: int, length: int) -> int:
        """The state of the last ``length`` words of what ``state`` was reached by."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state


def build(items: list[tuple[int, list[bytes]]], window: int = WINDOW) -> Automaton:
    """The automaton of the items' words. ``items``: number and words; items without words are left out."""
    auto = Automaton(window)
    items = [(n, words) for n, words in items if words]
    for _, words in items:
        last = 0
        for word in words:
            last = auto._extend(last, word)
    auto.items = [set() for _ in auto.link]
    for n, words in items:
        states = list(auto._walk(words))
        if len(words) < window:
            auto.short_ends.setdefault(states[-1], []).append((len(words), n))
            continue
        for end in range(window - 1, len(words)):
            auto.items[auto.state_of(states[end], window)].add(n)
    # A state lets through the short items that end its suffixes: those of its links, and its own if long enough.
    for state in sorted(range(1, len(auto.link)), key=auto.length.__getitem__):
        inherited = auto.short_ends.get(auto.link[state], [])
        if inherited:
            auto.short_ends[state] = auto.short_ends.get(state, []) + inherited
    auto.shortest = min((min(len(words), window) for _, words in items), default=0)
    return auto


def match(words: list[bytes], auto: Automaton) -> tuple[list[tuple[int, int]], set[int]]:
    """Spans (first word, after the last) of occurring windows, in order of their ends, and the items they are of.

    Words that no item has end every run, so only runs of known words at least as long as the shortest
    window are streamed.
    """
    spans: list[tuple[int, int]] = []
    found: set[int] = set()
    root = auto.following[0]
    if not root:
        return spans, found
    known = np.fromiter(map(root.__contains__, words), dtype=bool, count=len(words))
    edges = np.flatnonzero(np.diff(np.concatenate(([0], known.view(np.int8), [0]))))
    following, link, length, window = auto.following, auto.link, auto.length, auto.window
    for start, stop in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        if stop - start < auto.shortest:
            continue
        state, run = 0, 0
        for i in range(start, stop):
            word = words[i]
            while state and word not in following[state]:
                state = link[state]
                run = length[state]
            state = following[state][word]  # the root knows every word of this run
            run += 1
            if run >= window:
                spans.append((i + 1 - window, i + 1))
                found |= auto.items[auto.state_of(state, window)]
            for size, item in auto.short_ends.get(state, ()):
                if size <= run:
                    spans.append((i + 1 - size, i + 1))
                    found.add(item)
    return spans, found


def marked(n_words: int, spans: list[tuple[int, int]]) -> np.ndarray:
    """For each word, whether a span covers it."""
    edge = np.zeros(n_words + 1, dtype=np.int64)
    for a, b in spans:
        edge[a] += 1
        edge[b] -= 1
    return np.cumsum(edge[:-1]) > 0


def load_items(benchmark: DataFrame, *, window: int = WINDOW, automaton_words: int = 2_000_000) -> tuple[list[str], list[Automaton]]:
    """The item ids as text, by number, and the automata of all items.

    Null and empty items have no window; items that repeat an id count as one item with the windows of all;
    an item without id has the empty text as its id. ``automaton_words`` bounds what one automaton holds; an item
    longer than that has one of its own.
    """
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    ids: dict[str, int] = {}
    automata, part, held = [], [], 0
    for row in rows.toLocalIterator():
        words = normal_words(row["text"])
        if not words:
            continue
        if part and held + len(words) > automaton_words:
            automata.append(build(part, window))
            part, held = [], 0
        part.append((ids.setdefault(row["item"], len(ids)), words))
        held += len(words)
    if part:
        automata.append(build(part, window))
    return list(ids), automata


def report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` for every row.

    Null and empty texts have no words and no hit; repeated rows are reported each; an empty table gives an empty
    table, an empty benchmark no hits. Columns other than ``doc_id`` and ``text`` are not looked at.
    """
    spark = docs.sparkSession
    ids, automata = load_items(benchmark, **options)
    names = spark.sparkContext.broadcast(ids)
    shared = [spark.sparkContext.broadcast(a) for a in automata]

    @F.pandas_udf("n_words long, n_hit long, n_items long, items_sha256 string")
    def scan(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            words = normal_words(text if isinstance(text, str) else "")
            spans, found = [], set()
            for auto in shared:
                more, of = match(words, auto.value)
                spans += more
                found |= of
            items = ",".join(sorted(names.value[i] for i in found))
            hit = int(marked(len(words), spans).sum()) if spans else 0
            rows.append((len(words), hit, len(found), hashlib.sha256(items.encode()).hexdigest()))
        return pd.DataFrame(rows, columns=["n_words", "n_hit", "n_items", "items_sha256"])

    return (
        docs.select("doc_id", scan("text").alias("_r"))
        .select("doc_id", "_r.*")
        .withColumn("contaminated", F.col("n_hit") > 0)
    )


def cut(text: str, automata: list[Automaton], max_share: float) -> str | None:
    """The text without its marked spans, or None if they are more than ``max_share`` of its words.

    A span goes from its first word to its last, with all between, and one space stays. Words that meet there
    may make a new window, so this repeats until none is left; the share is of the words at first.
    """
    total, gone = None, 0
    while True:
        raw, low = text.encode("utf-8", "surrogatepass"), lowered(text)
        words = _WORDS.findall(low)
        total = len(words) if total is None else total
        spans = [s for auto in automata for s in match(words, auto)[0]]
        if not spans:
            return text
        hit = marked(len(words), spans)
        gone += int(hit.sum())
        if gone > max_share * total:
            return None
        places = [m.span() for m in _WORDS.finditer(low)]
        edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0])))).tolist()
        kept, at = [], 0
        for first, after in zip(edges[::2], edges[1::2], strict=True):
            kept.append(raw[at : places[first][0]].rstrip(b" "))
            at = places[after - 1][1]
        text = b" ".join([*kept, raw[at:].lstrip(b" ")]).decode("utf-8", "surrogatepass")


def clean(docs: DataFrame, benchmark: DataFrame, *, max_share: float = 0.5, **options) -> DataFrame:
    """``docs`` with the marked spans cut from ``text`` and ``n_chars`` brought into line.

    Documents of which more than ``max_share`` of the words are marked are dropped; clean ones stay as they are,
    null and empty texts included. The schema is that of ``docs``; ``n_chars`` is touched where it exists.
    """
    spark = docs.sparkSession
    shared = [spark.sparkContext.broadcast(a) for a in load_items(benchmark, **options)[1]]

    @F.pandas_udf("string")
    def cleaned(texts: pd.Series) -> pd.Series:
        automata = [a.value for a in shared]
        return pd.Series([cut(t, automata, max_share) if isinstance(t, str) else None for t in texts], dtype=object)

    columns = docs.columns
    # Not deterministic as far as Spark knows, so that it is not run once more for the filter.
    out = docs.withColumn("__clean", cleaned.asNondeterministic()("text")).where(F.col("__clean").isNotNull() | F.col("text").isNull())
    changed = ~F.col("__clean").eqNullSafe(F.col("text"))
    if "n_chars" in columns:
        size = F.length("__clean").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(changed, size).otherwise(F.col("n_chars")))
    return out.withColumn("text", F.col("__clean")).select(*columns)
