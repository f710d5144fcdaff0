"""Toxicity: embeddings of subwords, averaged, under a linear softmax.

A word is the bag of its character n-grams (3 to 5, with a space as the mark of either end), each hashed
to a row of one embedding table, so an unseen misspelling shares most of its vectors with the word it
comes from. A window of words is the average of its words' averages; two weight vectors turn it into a
softmax over clean and toxic. Embeddings and weights are trained together by gradient descent in numpy.

A label speaks of a whole document, in which a few words may carry it. So a document is cut into
windows of ``WINDOW`` words that overlap by half, its score is that of its most toxic window, and that
window is the one it is trained by (in the first epoch the one whose n-grams lean most to toxic documents
by their counts). Every word of a text is in a window.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import by_chunk, codepoints, held_out, labelled_ids, letter_table, one_text_each, sample_ids

BUCKETS = 1 << 17
SIZES = (3, 4, 5)
WINDOW = 32
HALF = WINDOW // 2
_SPACE = np.uint32(32)
_PRIME = np.uint32(0x01000193)


def stream(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """One array of lower-case letters with a space for everything else, and each text's place in it.

    Texts are apart by a space; ``starts`` has one entry more than there are texts.
    """
    parts = [codepoints(f" {t.lower()} ") for t in texts]
    starts = np.cumsum([0, *map(len, parts)])
    cp = np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint32)
    return np.where(letter_table()[cp], cp, _SPACE).astype(np.uint32), starts


def grams(cp: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """The word of each position (-1 before the first), and for each n-gram size the positions and buckets.

    An n-gram may begin or end with the space beside its word, but has none inside. Its word is that of its second
    character, which is always a letter.
    """
    blank = cp == _SPACE
    begins = ~blank[1:] & blank[:-1]
    word = np.concatenate(([0], np.cumsum(begins))).astype(np.int64) - 1 if len(cp) else np.zeros(0, dtype=np.int64)
    out = []
    with np.errstate(over="ignore"):
        h = (cp[:-1] ^ np.uint32(0x811C9DC5)) * _PRIME ^ cp[1:] if len(cp) > 1 else cp[:0]
        inside = ~blank[1:]  # of each start, whether all between first and last are letters
        for size in range(3, max(SIZES) + 1):
            m = max(0, len(cp) - size + 1)
            h = (h[:m] * _PRIME) ^ cp[size - 1 :]
            inside = inside[:m] & (~blank[size - 2 : size - 2 + m])
            if size in SIZES:
                at = np.flatnonzero(inside)
                key = h[at] * np.uint32(0x9E3779B1) + np.uint32(size)
                out.append((at, ((key ^ (key >> np.uint32(15))) * np.uint32(0x85EBCA77)) >> np.uint32(32 - 17)))
    return word, out


@dataclass
class SubwordModel:
    """``weights``: the embedding table times the difference of the two softmax vectors; ``bias`` likewise."""

    weights: np.ndarray
    bias: float


def word_values(texts: list[str], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word of the texts, the average weight of its n-grams; and the first word of each text."""
    cp, starts = stream(texts)
    word, found = grams(cp)
    n = int(word[-1]) + 1 if len(word) else 0
    total, many = np.zeros(n), np.zeros(n)
    for at, bucket in found:
        w = word[at + 1]
        total += np.bincount(w, weights[bucket], n)
        many += np.bincount(w, minlength=n)
    # Texts begin and end with a space, so the word count just before a text is the number of its first word.
    first = np.concatenate((word[np.minimum(starts[:-1], len(word) - 1)] + 1, [n])) if len(word) else np.zeros(len(starts), dtype=np.int64)
    return total / np.maximum(many, 1), first


def window_means(values: np.ndarray) -> np.ndarray:
    """The mean of each window of a document's words; of no words, one 0."""
    if len(values) <= WINDOW:
        return np.array([values.mean() if len(values) else 0.0])
    sums = np.add.reduceat(values, np.arange(0, len(values), HALF))
    sizes = np.diff(np.append(np.arange(0, len(values), HALF), len(values)))
    return (sums[:-1] + sums[1:]) / (sizes[:-1] + sizes[1:])


def probabilities(texts: list[str], model: SubwordModel) -> np.ndarray:
    values, first = word_values(texts, model.weights)
    top = [window_means(values[a:b]).max() for a, b in zip(first[:-1], first[1:], strict=True)]
    return 1 / (1 + np.exp(-np.clip(np.array(top, dtype=np.float64) + model.bias, -35, 35)))


class _Words:
    """The distinct words of the sampled texts with their n-grams, and each text as word numbers."""

    def __init__(self, texts: list[str]) -> None:
        self.docs, known = [], {}
        for text in texts:
            cp, _ = stream([text])
            words = cp.tobytes().decode("utf-32-le").split()
            self.docs.append(np.array([known.setdefault(w, len(known)) for w in words], dtype=np.int64))
        cp, _ = stream(list(known))
        word, found = grams(cp)
        w = np.concatenate([word[at + 1] for at, _ in found]) if found else np.zeros(0, dtype=np.int64)
        buckets = np.concatenate([b for _, b in found]) if found else np.zeros(0, dtype=np.int64)
        order = np.argsort(w, kind="stable")
        self.buckets = buckets[order].astype(np.int32)
        self.many = np.bincount(w, minlength=len(known))
        self.ends = np.cumsum(self.many)

    def rows(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The n-gram buckets of these words, one after the other, and each one's place in ``words``."""
        many = self.many[words]
        owner = np.repeat(np.arange(len(words)), many)
        offset = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
        return self.buckets[(self.ends[words] - many)[owner] + offset], owner


def _leaning(words: _Words, y: np.ndarray, shrink: float = 10.0) -> np.ndarray:
    """For each bucket the log ratio of toxic to clean documents of the sample whose words have it. Either kind is given
    ``shrink`` documents more that have it as often as all do, so that what few documents have says little."""
    held = np.zeros((2, BUCKETS))
    for doc, kind in zip(words.docs, y, strict=True):
        held[kind, np.unique(words.rows(np.unique(doc))[0])] += 1
    share = (held.sum(0) + 1) / (len(y) + 2)
    clean, toxic = ((held[k] + shrink * share) / ((y == k).sum() + shrink) for k in (0, 1))
    return np.log(toxic / clean)


def fit(
    texts: list[str], y: np.ndarray, prior: float, *, dim: int = 8, epochs: int = 10, updates: int = 320,
    batch: int = 128, rate: float = 0.3, seed: int = 7,
) -> SubwordModel:
    """Train on texts and labels, for ``epochs`` rounds and on few texts for as many as make ``updates``. ``prior``: the share of toxic documents among all labelled ones, to which the
    bias is moved as the sample holds more of them. One class only, or no text: a constant model, of the class that
    most labelled documents have, clean without any."""
    y = np.asarray(y, dtype=np.int64)
    if len(y) == 0 or y.min() == y.max():
        return SubwordModel(np.zeros(BUCKETS), 6.0 if prior > 0.5 else -6.0)
    rng = np.random.default_rng(seed)
    words = _Words(texts)
    table = rng.normal(0, 0.1, (BUCKETS, dim))
    soft = rng.normal(0, 0.1, (dim, 2))
    bias = np.zeros(2)
    seen_t, seen_s, seen_b = np.full_like(table, 1e-6), np.full_like(soft, 1e-6), np.full_like(bias, 1e-6)

    owner_of = np.repeat(np.arange(len(words.many)), words.many)

    def chosen_windows(weights: np.ndarray) -> list[np.ndarray]:
        value = np.bincount(owner_of, weights[words.buckets], len(words.many)) / np.maximum(words.many, 1)
        at = [HALF * int(np.argmax(window_means(value[d]))) for d in words.docs]
        return [d[i : i + WINDOW] for d, i in zip(words.docs, at, strict=True)]

    for epoch in range(max(epochs, -(-updates // -(-len(y) // batch)))):
        chosen = chosen_windows(_leaning(words, y) if epoch == 0 else table @ (soft[:, 1] - soft[:, 0]))
        order = rng.permutation(len(y))
        for lo in range(0, len(order), batch):
            docs = order[lo : lo + batch]
            sizes = np.array([max(1, len(chosen[d])) for d in docs])
            owner = np.repeat(np.arange(len(docs)), [len(chosen[d]) for d in docs])
            distinct, place = np.unique(np.concatenate([chosen[d] for d in docs]), return_inverse=True)
            buckets, of = words.rows(distinct)
            many = np.maximum(words.many[distinct], 1)
            # How much each distinct word weighs in each window.
            share = np.zeros((len(docs), len(distinct)))
            np.add.at(share, (owner, place), 1 / sizes[owner])
            used, slot = np.unique(buckets, return_inverse=True)
            rows = table[used]
            vectors = np.zeros((len(distinct), dim))
            for k in range(dim):
                vectors[:, k] = np.bincount(of, rows[slot, k], len(distinct)) / many
            hidden = share @ vectors
            z = hidden @ soft + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(docs)), y[docs]] -= 1
            p /= len(docs)
            grad_s, grad_b = hidden.T @ p, p.sum(0)
            grad_v = (share.T @ (p @ soft.T)) / many[:, None]
            grad_t = np.stack([np.bincount(slot, grad_v[of, k], len(used)) for k in range(dim)], axis=1)
            seen_t[used] += grad_t**2
            table[used] -= rate * grad_t / np.sqrt(seen_t[used])
            seen_s += grad_s**2
            soft -= rate * grad_s / np.sqrt(seen_s)
            seen_b += grad_b**2
            bias -= rate * grad_b / np.sqrt(seen_b)
    sampled = y.mean()
    moved = np.log(prior / (1 - prior)) - np.log(sampled / (1 - sampled)) if 0 < prior < 1 else 0.0
    return SubwordModel(table @ (soft[:, 1] - soft[:, 0]), float(bias[1] - bias[0] + moved))


def within_budget(sizes: pd.DataFrame, sample_chars: int) -> pd.DataFrame:
    """Of ``label, n, h, doc_id`` the rows whose texts have at most ``sample_chars`` characters together.

    Either class may fill half of them, and what the other leaves of its half. Its texts of up to a hundredth of
    ``sample_chars`` come in the order of ``h``; longer ones come behind all of these, the shortest first, so that
    a long text takes no other's place and is learnt from where there is room.
    """
    longest = sample_chars // 100
    # Of texts up to `longest`, the order is that of the hash alone.
    late = sizes["n"].where(sizes["n"] > longest, 0)
    sizes = sizes.assign(_late=late).sort_values(["_late", "h", "doc_id"])
    half = sample_chars // 2
    used = {k: min(half, int(sizes.loc[sizes["label"] == k, "n"].sum())) for k in (0, 1)}
    room = sizes["label"].map({k: sample_chars - used[1 - k] for k in (0, 1)})
    return sizes[sizes.groupby("label")["n"].cumsum() <= room].drop(columns="_late")


def train(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", *, rows_per_class: int = 4_000,
    sample_chars: int = 16_000_000, seed: int = 2,
) -> SubwordModel:
    """Fit on a bounded sample: at most ``rows_per_class`` labelled documents of either class that are not held
    out, by seeded hash, taken whole while they have at most ``sample_chars`` characters together. Texts over a hundredth
    of that are taken last, where there is room (``within_budget``)."""
    ids = labelled_ids(docs, labels, label)
    counts = {r["label"]: r["count"] for r in ids.groupBy("label").count().collect()}
    # `label` has two values, so this is one bounded list of ids for each.
    picked = sample_ids(ids.where("label = 0"), rows_per_class, seed).union(
        sample_ids(ids.where("label = 1"), rows_per_class, seed)
    )
    lengths = one_text_each(docs, picked).select(
        "doc_id", "label", F.coalesce(F.length("text"), F.lit(0)).alias("n"), F.xxhash64(F.lit(seed), "doc_id").alias("h")
    )
    sizes = within_budget(lengths.toPandas(), sample_chars)
    spark = docs.sparkSession
    chosen = spark.createDataFrame(
        [(int(d), int(v)) for d, v in zip(sizes["doc_id"], sizes["label"], strict=True)], "doc_id long, label int"
    )
    rows = one_text_each(docs, chosen).toPandas().sort_values("doc_id")
    prior = (counts.get(1, 0) + 0.5) / (sum(counts.values()) + 1)
    return fit([t if isinstance(t, str) else "" for t in rows["text"]], rows["label"].to_numpy(), prior)


def scored(docs: DataFrame, model: SubwordModel, *keep: str, threshold: float = 0.5) -> DataFrame:
    """``keep`` columns (default ``doc_id``) with ``score`` and ``predicted`` for every row.

    A null text, an empty one and one without letters have the score of the bias alone; equal texts get equal
    scores; rows that repeat are scored each; an empty table gives an empty table. Other columns of ``docs``
    are not looked at, whatever their names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        def some(part: list[str]) -> pd.DataFrame:
            return pd.DataFrame({"score": probabilities(part, shared.value)})

        return by_chunk(some)(texts)["score"]

    return docs.select(*(keep or ("doc_id",)), score("text").alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )


def classify(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Train on the labelled rows, then ``doc_id, held_out, score, predicted`` for every document."""
    return scored(docs, train(docs, labels, **options)).select("doc_id", held_out().alias("held_out"), "score", "predicted")
