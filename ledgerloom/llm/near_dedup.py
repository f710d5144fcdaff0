"""Near-duplicates with SetSketch registers.

A document is the set of its distinct shingles of ``words`` words. A register holds the least of the set's exponential
variates, one variate per shingle and register, on a scale of powers of ``BASE``, cut off to two bytes: it can be
merged by maximum, and two registers agree about as often as the sets do. Steps:

1. Documents with the same sequence of normalised words form a class; one of each class goes on.
2. Bands of ``ROWS`` registers make keys; documents that share a key are candidates. ``BANDS`` is such that a pair at
   a similarity of 0.8 shares none with a probability of about 5e-8.
3. Not all pairs of a key's documents are formed. Since results are components, first each document is compared with two
   leaders of the key; the links found give components; then documents outside the largest component of a
   key are compared with all documents of the key that are in other components than theirs. So every two candidates
   end up either in one component or compared, or cannot be similar: each set has a map of ``BITS`` bits with a bit for
   each shingle, and no intersection is larger than the bits in common and the shingles that share a bit.
4. A pair's similarity is estimated from all registers together: with the counts of registers that are
   larger, smaller and equal, the likelihood of the similarity is compared at its maximum and at the wanted one; a pair
   that is ``SURE`` times less likely there is left out.
5. The rest are verified on the full sets, and links make components.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import constants, mix
from ledgerloom.llm.components import components
from ledgerloom.session import materialize

ROWS, BANDS = 4, 32
REGISTERS = ROWS * BANDS
BASE, RATE, LIMIT = 1.001, 20.0, (1 << 16) - 2
#: Logarithm of how much less likely the wanted similarity must be than the best one for a pair to be left out.
SURE = 25.0
BITS = 1024
#: Numbers of 64 marks each, at most, that tell before a join which texts cannot be needed.
WORDS = 1 << 18
_FACTORS, _OFFSETS, _BAND = constants(REGISTERS, 91), constants(REGISTERS, 92), constants(ROWS + 1, 93)
_TOP = np.log(BASE)


def shingles(raw: bytes, words: int) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a normalised text's shingles; of fewer words, that of the whole."""
    found = raw.split()
    if not found:
        return np.zeros(0, dtype=np.uint64)
    h = mix(np.fromiter(map(xxhash.xxh3_64_intdigest, found), dtype=np.uint64, count=len(found)))
    k = min(words, len(h))
    n = len(h) - k + 1
    out = np.full(n, k, dtype=np.uint64)
    for i in range(k):
        out = mix(out + h[i : i + n] * _BAND[0])
    return np.unique(out)


def normal(text: str | None) -> bytes:
    """A-Z in lower case; the six ASCII white spaces are what parts words, so the caller may use ``split``."""
    return text.encode("utf-8", "surrogatepass").lower() if isinstance(text, str) else b""


def registers(hashes: np.ndarray) -> np.ndarray:
    """The sketch of a non-empty set: ``REGISTERS`` unsigned 16-bit numbers."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for lo in range(0, len(hashes), 4096):  # blocks that stay in the processor's cache
        part = hashes[None, lo : lo + 4096]
        for i in range(0, REGISTERS, 16):
            drawn = (part ^ _OFFSETS[i : i + 16, None]) * _FACTORS[i : i + 16, None]
            np.minimum(least[i : i + 16], drawn.min(axis=1), out=least[i : i + 16])
    variate = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64) / RATE
    return np.clip(np.floor(1 - np.log(variate) / _TOP), 0, LIMIT + 1).astype("<u2")


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """A signed 64-bit key for each band."""
    h = np.arange(BANDS, dtype=np.uint64)
    for column in sketch.reshape(BANDS, ROWS).T:
        h = mix(h * _BAND[1] + column)
    return h.view(np.int64)


def _log_likelihood(j, share_a, share_b, larger, smaller, equal):
    """Of similarity ``j``; shares: of either set in the sum of both sizes."""
    def p(x):
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / _TOP

    up, down = p(share_a - share_b * j), p(share_b - share_a * j)
    tiny = 1e-300
    return larger * np.log(np.maximum(up, tiny)) + smaller * np.log(np.maximum(down, tiny)) + equal * np.log(np.maximum(1 - up - down, tiny))


def worth_verifying(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, wanted: float) -> np.ndarray:
    """For pairs of sketches (rows) with their set sizes, whether the similarity may be ``wanted`` or more."""
    larger, smaller = (a > b).sum(1), (a < b).sum(1)
    equal = REGISTERS - larger - smaller
    share_a = n_a / (n_a + n_b)
    share_b = 1 - share_a
    most = np.minimum(n_a, n_b) / np.maximum(n_a, n_b)
    grid = np.linspace(0, 1, 65)[:, None] * most
    curve = _log_likelihood(grid, share_a, share_b, larger, smaller, equal)
    at = _log_likelihood(np.minimum(wanted, most), share_a, share_b, larger, smaller, equal)
    best = np.argmax(curve, axis=0)
    estimate = grid[best, np.arange(len(best))]
    return (most >= wanted) & ((estimate >= wanted) | (curve.max(0) - at < SURE))


def bit_map(hashes: np.ndarray) -> np.ndarray:
    """``BITS`` bits as signed 64-bit numbers, with the bit of each hash set."""
    seen = np.zeros(BITS, dtype=bool)
    seen[(hashes >> np.uint64(32)) % np.uint64(BITS)] = True
    return np.packbits(seen, bitorder="little").view("<i8")


def sketched(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id, text_hash, same`` (of the normalised words), ``n_shingles, sketch, bits`` and ``hidden`` (shingles less
    bits); without words ``same`` is null."""

    @F.pandas_udf("same binary, n_shingles long, sketch binary, bits array<long>, hidden long")
    def sketch(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            raw = normal(text)
            hashes = shingles(raw, words)
            same = hashlib.md5(b" ".join(raw.split())).digest() if len(hashes) else None
            bits = bit_map(hashes)
            hidden = len(hashes) - int(np.bitwise_count(bits.view("<u8")).sum())
            rows.append((same, len(hashes), registers(hashes).tobytes() if len(hashes) else None, bits, hidden))
        return pd.DataFrame(rows, columns=["same", "n_shingles", "sketch", "bits", "hidden"])

    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), sketch("text").alias("_s")).select(
        "doc_id", "text_hash", "_s.*"
    )


def classes_of(rows: DataFrame) -> DataFrame:
    """One row per class of equal word sequences: ``same, n_shingles, sketch, keys``, its least id and one of its rows.

    ``node`` numbers the classes, shorter than ``same`` where keys and pairs are shuffled. The numbers hold once they are written.
    """

    @F.pandas_udf("array<long>")
    def keys(sketches: pd.Series) -> pd.Series:
        return pd.Series([band_keys(np.frombuffer(s, dtype="<u2")) for s in sketches], dtype=object)

    return (
        rows.where("same IS NOT NULL")
        .groupBy("same")
        .agg(
            *[F.first(c).alias(c) for c in ("n_shingles", "sketch", "bits", "hidden")],
            F.min("doc_id").alias("least_id"), F.min(F.struct("text_hash", "doc_id")).alias("row"),
        )
        .withColumn("keys", keys("sketch"))
        .withColumn("node", F.monotonically_increasing_id())
    )


def _similar_sizes(a: str, b: str, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _pair(a: str, b: str) -> list[Column]:
    return [F.greatest(a, b).alias("u"), F.least(a, b).alias("v")]


def sets_of(docs: DataFrame, classes: DataFrame, needed: DataFrame, words: int) -> DataFrame:
    """``node, shingles`` of the classes in ``needed`` (``node``, distinct): the whole sets, sorted, from the texts.

    Texts are shuffled only where the mark of their hash is set. The marks are broadcast; they are 64 times ``WORDS`` bits at
    most, however many classes are needed, and only spare texts the way: what passes is joined with the needed rows.
    """
    # Written, so that Spark knows how small it is before it plans the join with the texts.
    rows = materialize(
        classes.join(needed, "node", "left_semi").select(
            "node", F.col("same").alias("_same"), F.col("row.text_hash").alias("_hash"), F.col("row.doc_id").alias("_id")
        ),
        "needed",
    )
    word = F.shiftrightunsigned("_h", 65 - WORDS.bit_length()).alias("_word")
    bit = F.expr("shiftleft(1L, int(_h & 63))")
    marks = rows.select(F.col("_hash").alias("_h")).groupBy(word).agg(F.bit_or(bit).alias("_marks"))
    marked = (
        docs.select("doc_id", "text", F.xxhash64("text").alias("_h")).withColumn("_word", word)
        .join(F.broadcast(marks), "_word").where(F.col("_marks").bitwiseAND(bit) != 0)
    )

    @F.pandas_udf("binary")
    def whole_set(texts: pd.Series, wanted: pd.Series) -> pd.Series:
        """The set of a text of the wanted class, and null if another text has its hash and its id."""
        out = []
        for text, same in zip(texts, wanted, strict=True):
            raw = normal(text)
            out.append(shingles(raw, words).tobytes() if hashlib.md5(b" ".join(raw.split())).digest() == same else None)
        return pd.Series(out, dtype=object)

    found = (F.col("_h") == F.col("_hash")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    return materialize(
        marked.join(rows, found).select("node", whole_set("text", "_same").alias("shingles"))
        .groupBy("node").agg(F.first("shingles", ignorenulls=True).alias("shingles")),
        "sets",
    )


def likely_pairs(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """``pairs`` (``u, v``) without those that the sketches make out as not similar."""
    wanted = percent / 100

    @F.pandas_udf("boolean")
    def likely(a: pd.Series, b: pd.Series, n_a: pd.Series, n_b: pd.Series) -> pd.Series:
        if not len(a):
            return pd.Series([], dtype=bool)
        both = [np.frombuffer(b"".join(x), dtype="<u2").reshape(-1, REGISTERS) for x in (a, b)]
        return pd.Series(worth_verifying(*both, n_a.to_numpy(float), n_b.to_numpy(float), wanted))

    def side(node: str) -> DataFrame:
        return classes.select(F.col("node").alias(node), F.col("sketch").alias(f"s_{node}"), F.col("n_shingles").alias(f"n_{node}"))

    return materialize(
        pairs.join(side("u"), "u").join(side("v"), "v").where(likely("s_u", "s_v", "n_u", "n_v")).select("u", "v"), "likely"
    )


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``pairs`` (``u, v``) that are similar by their whole sets. A document with very many partners is one row on its
    side of a join, and its pairs can be split."""

    @F.pandas_udf("boolean")
    def linked(a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(a, b, strict=True):
            x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            out.append(100 * both >= percent * (len(x) + len(y) - both))
        return pd.Series(out, dtype=bool)

    return materialize(
        pairs.join(sets.select(F.col("node").alias("u"), F.col("shingles").alias("a")), "u")
        .join(sets.select(F.col("node").alias("v"), F.col("shingles").alias("b")), "v")
        .where(linked("a", "b"))
        .select("u", "v"),
        "links",
    )


def _with_leaders(classes: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """``key, node, n`` of all keys that several classes share; and the pairs of each class with the two leaders of
    its keys, the least and the greatest."""
    bands = classes.select("node", F.col("n_shingles").alias("n"), F.explode("keys").alias("key"))
    one = F.struct("node", "n")
    leaders = (
        bands.groupBy("key").agg(F.min(one).alias("low"), F.max(one).alias("high")).where(F.col("low.node") < F.col("high.node"))
    )
    members = materialize(bands.join(leaders, "key"), "members")
    pairs = (
        members.withColumn("lead", F.explode(F.array("low", "high")))
        .where((F.col("lead.node") != F.col("node")) & _similar_sizes("n", "lead.n", percent))
        .select(*_pair("node", "lead.node"))
        .distinct()
    )
    return members.select("key", "node", "n"), pairs


def _mixed_keys(members: DataFrame, found: DataFrame) -> DataFrame:
    """``key, node, n, c`` (its component) and ``major`` (the largest of the key) where a key has several components."""
    placed = members.join(found, "node", "left").select(
        "key", "node", "n", F.coalesce("component", "node").alias("c")
    )
    mixed = (
        placed.groupBy("key", "c").agg(F.count("*").alias("size"))
        .groupBy("key").agg(F.max(F.struct("size", "c")).alias("top"), F.count("*").alias("parts"))
        .where("parts > 1")
        .select("key", F.col("top.c").alias("major"))
    )
    return placed.join(mixed, "key")


def _remaining(here: DataFrame, percent: int) -> DataFrame:
    """Pairs with a key in common but in different components: each class outside the largest component of a key with
    every class of the key in another component, unless their bits tell that they share too little."""
    outside = here.where("c <> major").select("key", *[F.col(c).alias(f"o_{c}") for c in ("node", "n", "c", "bits", "hidden", "keys")])
    once = (F.col("c") == F.col("major")) | (F.col("node") > F.col("o_node"))
    in_common = sum((F.bit_count(F.col("bits")[i].bitwiseAND(F.col("o_bits")[i])) for i in range(BITS // 64)), F.lit(0))
    most = in_common + F.least("hidden", "o_hidden")
    enough = (100 + percent) * most >= percent * (F.col("n") + F.col("o_n"))
    # Of the keys that two documents have in common, the least makes the pair; all of these keys are mixed.
    first = F.array_min(F.array_intersect("keys", "o_keys")) == F.col("key")
    return (
        here.join(outside, "key")
        .where((F.col("c") != F.col("o_c")) & once & _similar_sizes("n", "o_n", percent) & enough & first)
        .select(*_pair("node", "o_node"))
    )


def _flagged(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``doc_id, text_hash, n_shingles, component_id, kept`` for every row."""
    rows = materialize(sketched(docs, words), "sketches")
    classes = materialize(classes_of(rows), "classes")
    members, pairs = _with_leaders(classes, percent)
    pairs = materialize(pairs, "pairs")

    # The sets of all documents that share a key, so that the texts are read and sorted out once for both rounds.
    sets = sets_of(docs, classes, members.select("node").distinct(), words)
    links = verified(likely_pairs(pairs, classes, percent), sets, percent)
    here = _mixed_keys(members, components(links)).join(classes.select("node", "bits", "hidden", "keys"), "node")
    rest = materialize(_remaining(materialize(here, "mixed"), percent).join(pairs, ["u", "v"], "left_anti"), "rest")
    more = verified(likely_pairs(rest, classes, percent), sets, percent)
    found = components(links.unionByName(more))
    of_class = (
        classes.select("same", "node", "least_id")
        .join(found, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    least = of_class.groupBy("component").agg(F.min("least_id").alias("component_id"))
    ids = of_class.join(least, "component").select("same", "component_id")
    kept = F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    columns = ("doc_id", "text_hash", "n_shingles")
    with_words = rows.where("same IS NOT NULL").join(ids, "same", "left").select(*columns, "component_id", kept)
    without = rows.where("same IS NULL").select(*columns, F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"))
    return with_words.unionByName(without)


def near_duplicates(docs: DataFrame, *, words: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs`` (columns ``doc_id, text``).

    Documents with 100 * intersection >= ``percent`` * union of their shingle sets are linked; ``component_id`` is the
    least ``doc_id`` that can be reached. A text that is null, empty or without words has 0 shingles and is a
    component of its own, with its own id. Fewer than ``words`` words are one shingle. Rows that repeat are linked like any
    equal texts. A row without id counts as greater than all ids; a component of such rows only has a null
    ``component_id``, and all of them are ``kept``. An empty table gives an empty table. Other columns are not looked at.
    """
    return _flagged(docs, words, percent).drop("text_hash")


def drop_duplicates(docs: DataFrame, *, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component, with the columns they came with.

    That is the row with the least id; of several rows with this id, one. Of components without any id all rows stay, and so
    do texts without words. The list of rows that go grows with the corpus, so it is never broadcast.
    """
    flags = materialize(_flagged(docs, words, percent), "flags")
    left = flags.where("kept AND n_shingles > 0 AND doc_id IS NOT NULL")
    first = left.groupBy("component_id").agg(F.min("text_hash").alias("_first"))
    others = left.join(first, "component_id").where("text_hash <> _first")
    place = [F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")]
    gone = materialize(flags.where("NOT kept").select(*place).unionByName(others.select(*place)).distinct(), "gone")
    repeated = materialize(left.groupBy("doc_id", "text_hash").count().where("count > 1").select(*place), "repeated")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash"))
    kept = docs.join(gone.hint("merge"), same, "left_anti")
    return kept.join(repeated, same, "left_anti").unionByName(
        kept.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "text"])
    )
