"""Mix sources to target weights by drawing packed blocks.

1. The words of each source are packed into blocks of ``block_words``, in an order that follows from the rows.
2. The output has as many slots as the targets need blocks, in shards of ``shard_slots``. Each shard draws how
   many of its slots every source gets: multinomial counts, given that all shards together meet the targets. The
   draw goes down a binary tree of shards: a node's counts are dealt to its halves at random, seeded by the node, so
   that every shard finds its counts and how many slots each source had before it on its own, in log(shards) steps.
3. The n-th slot of a source is mapped to a block through a pseudorandom permutation of the source's block
   indexes, one permutation per pass over the source.
4. Slots and blocks are joined by source and block index: ``mixed_blocks`` gives the packed output, ``mixed_documents`` the
   runs of documents in it, ``mix_documents`` how many words of each document are in it.

No pass beyond the second exists, since a target is at most twice its source, so no word is taken more than twice.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import mix
from ledgerloom.session import materialize

#: The weights of sources in the order of their names, and the share of all words to take.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
WORD = r"[^\x20\x09-\x0D]+"
#: numpy draws hypergeometric counts of populations below this; larger ones are drawn by ``_hypergeometric``.
_NUMPY_DRAWS = 10**9


def targets(sizes: list[int], weights: list[float], share: float = SHARE, most: float = MOST) -> list[float]:
    """Shares of ``share`` times all sizes by weight, each at most ``most`` times its size; what is above goes to
    the others by weight, until none is above."""
    goal, out, free = share * sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    while free:
        left = goal - sum(out[i] for i in range(len(sizes)) if i not in free)
        weight = sum(weights[i] for i in free)
        full = {i for i in free if left * weights[i] / weight > most * sizes[i]}
        if not full:
            for i in free:
                out[i] = left * weights[i] / weight
            break
        for i in full:
            out[i] = float(most * sizes[i])
        free -= full
    return out


@dataclass
class Mix:
    """The sources by number: name, words, target words, blocks there are and blocks to take."""

    names: list[str | None]
    sizes: list[int]
    targets: list[float]
    blocks: np.ndarray
    wanted: np.ndarray
    seed: int
    shard_slots: int

    @property
    def slots(self) -> int:
        return int(self.wanted.sum())

    @property
    def shards(self) -> int:
        return -(-self.slots // self.shard_slots)


def whole(exact: np.ndarray, seed: int) -> np.ndarray:
    """Each number rounded down or up, up with the probability of its fraction. One seeded draw serves all, in a random
    order, so that the sum is off by less than one and small sources get their words together."""
    rng = np.random.default_rng((seed, len(exact)))
    down = np.floor(exact + 1e-9)
    order = rng.permutation(len(exact))
    upto = np.floor(np.cumsum(np.maximum(exact - down, 0)[order]) + rng.random())
    up = np.zeros(len(exact), dtype=np.int64)
    up[order] = np.diff(upto, prepend=0)
    return down.astype(np.int64) + up


def plan(sizes: DataFrame, *, block_words: int, shard_slots: int, seed: int) -> Mix:
    """``sizes``: ``source, source_size``. One row per source comes to the driver.

    Sources are in the order of their names by code point, null last (UTF-8 bytes sort like code points).
    """
    rows = sorted(
        ((r["source"], r["source_size"]) for r in sizes.collect()),
        key=lambda r: (r[0] is None, (r[0] or "").encode("utf-8", "surrogatepass")),
    )
    words = [n for _, n in rows]
    goal = targets(words, [WEIGHTS[i % len(WEIGHTS)] for i in range(len(rows))])
    blocks = np.array([-(-n // block_words) for n in words], dtype=np.int64)
    # A slot holds a block's words on average, less than ``block_words`` where the last block is short.
    wanted = np.minimum(whole(np.array(goal) * blocks / np.maximum(words, 1), seed), MOST * blocks)
    return Mix([s for s, _ in rows], words, goal, blocks, wanted, seed, shard_slots)


def _hypergeometric(good: int, bad: int, sample: int, rng: np.random.Generator) -> int:
    """How many of ``sample`` drawn without return are good, by inversion: probabilities follow from their ratios to their
    neighbours, over 14 deviations to either side of the mode, outside of which lies less than double precision can tell."""
    if not good or not sample:
        return 0
    n = good + bad
    mode = (sample + 1) * (good + 1) // (n + 2)
    reach = 40 + int(14 * np.sqrt(sample * (good / n) * (bad / n) * ((n - sample) / max(1, n - 1))))
    lo, hi = max(0, sample - bad, mode - reach), min(good, sample, mode + reach)
    k = np.arange(lo, hi, dtype=np.float64)
    steps = np.log(good - k) + np.log(sample - k) - np.log(k + 1) - np.log(bad - sample + k + 1)
    logs = np.concatenate(([0.0], np.cumsum(steps)))
    upto = np.cumsum(np.exp(logs - logs.max()))
    return lo + int(np.searchsorted(upto, rng.random() * upto[-1], side="right"))


def _halve(counts: np.ndarray, left: int, rng: np.random.Generator) -> np.ndarray:
    """How much of ``counts`` falls among the first ``left`` of ``counts.sum()`` slots in random order."""
    rest = int(counts.sum())
    if rest < _NUMPY_DRAWS:
        return rng.multivariate_hypergeometric(counts, left, method="marginals")
    out = np.zeros_like(counts)
    for i, count in enumerate(counts.tolist()):
        rest -= count
        out[i] = _hypergeometric(count, rest, left, rng)
        left -= int(out[i])
    return out


def shard_counts(mixed: Mix, shard: int) -> tuple[np.ndarray, np.ndarray]:
    """Slots of each source in this shard, and in all shards before it."""
    lo, hi, counts, before = 0, mixed.shards, mixed.wanted.copy(), np.zeros_like(mixed.wanted)
    while hi - lo > 1:
        middle = (lo + hi) // 2
        left = _halve(counts, (middle - lo) * mixed.shard_slots, np.random.default_rng((mixed.seed, lo, hi)))
        if shard < middle:
            hi, counts = middle, left
        else:
            lo, before, counts = middle, before + left, counts - left
    return counts, before


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A permutation of 0..size-1 that follows from ``key``, at ``index``: four Feistel rounds on the next even
    number of bits, walked on until the value is below ``size``."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(size, 2))).astype(np.int64) + 1) // 2).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = index.astype(np.uint64), np.arange(len(index))
    while len(todo):
        x, h, m, k = out[todo], half[todo], mask[todo], key[todo].astype(np.uint64)
        a, b = x >> h, x & m
        for turn in range(4):
            a, b = b, a ^ (mix(b ^ mix(k + np.uint64(turn + 1))) & m)
        out[todo] = (a << h) | b
        todo = todo[out[todo] >= size[todo].astype(np.uint64)]
    return out.astype(np.int64)


def slots(spark, mixed: Mix) -> DataFrame:
    """``shard, slot, source_no, block, turn`` of the whole output; shards are made independently of each other.

    ``turn``: the pass over the source that the slot belongs to, 0 or 1; a pass has each block at most once.

    Spark takes them for as few as there are shards, so joins with them say that they are not to be broadcast.
    """

    def draw(batches):
        for batch in batches:
            for shard in batch["id"]:
                counts, before = shard_counts(mixed, int(shard))
                source = np.repeat(np.arange(len(counts)), counts)
                nth = np.arange(len(source)) - np.repeat(np.cumsum(counts) - counts, counts) + before[source]
                size = mixed.blocks[source]
                turn = nth // size
                key = mix((np.uint64(mixed.seed) << np.uint64(40)) + (source.astype(np.uint64) << np.uint64(2)) + turn.astype(np.uint64))
                block = permuted(nth % size, size, key)
                order = np.random.default_rng((mixed.seed, int(shard))).permutation(len(source))
                yield pd.DataFrame({"shard": shard, "slot": np.arange(len(source)), "source_no": source[order], "block": block[order], "turn": turn[order]})

    shape = "shard long, slot int, source_no int, block long, turn int"
    if not mixed.slots:
        return spark.createDataFrame([], shape)
    return spark.range(mixed.shards).mapInPandas(draw, shape)


def sized(docs: DataFrame, *keep: str) -> DataFrame:
    """``doc_id, source``, the kept columns, and ``size``: words of the text (null: 0)."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select("doc_id", "source", *keep, size.alias("size"))


def placed(rows: DataFrame, *, bucket_rows: int = 50_000) -> DataFrame:
    """``rows`` with ``first``: the place of a row's first word among the words of its source.

    Rows go to buckets by a hash of the row; sums run inside a bucket and over the buckets of a source, so no
    task holds a source. The number of buckets follows from the number of rows.
    """
    per_source = rows.groupBy("source").count().groupBy().agg(F.sum("count").alias("n"))
    n = per_source.collect()[0]["n"] or 0
    buckets = max(1, -(-n // bucket_rows))
    # All columns that tell rows apart: rows without id, or that repeat one, are spread and have an order too.
    by = ["doc_id", "size", *[c for c in rows.columns if c not in ("doc_id", "size", "source")]]
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64(*by, F.lit(17)), F.lit(buckets)))
    inside = Window.partitionBy("source", "_bucket").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("source", "_bucket")
        .agg(F.sum("size").alias("_n"))
        .select(
            F.col("source").alias("_s"), F.col("_bucket").alias("_b"),
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
        )
    )
    return (
        rows.withColumn("_in", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(offsets, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_bucket") == F.col("_b")))
        .withColumn("first", F.col("_offset") + F.col("_in"))
        .drop("_s", "_b", "_bucket", "_in", "_offset")
    )


def _numbered(spark, mixed: Mix) -> DataFrame:
    return spark.createDataFrame(
        [(i, s, n, t) for i, (s, n, t) in enumerate(zip(mixed.names, mixed.sizes, mixed.targets, strict=True))],
        "source_no int, _source string, source_size long, target double",
    )


def _blocks_of(rows: DataFrame, block_words: int) -> DataFrame:
    """A row for each block that a document with words has words in: its words ``from_word`` up to ``to_word``
    (counted from 0, the last one left out)."""
    b = F.lit(block_words)
    last = F.col("first") + F.col("size") - 1
    return (
        rows.where("size > 0")
        .withColumn("block", F.explode(F.sequence(F.floor(F.col("first") / b), F.floor(last / b))))
        .withColumn("from_word", F.greatest(F.lit(0), F.col("block") * b - F.col("first")))
        .withColumn("to_word", F.least(F.col("size"), (F.col("block") + 1) * b - F.col("first")))
    )


def mixture(
    docs: DataFrame, *keep: str, block_words: int, shard_slots: int = 4096, seed: int = 11
) -> tuple[Mix, DataFrame, DataFrame]:
    """The plan, the placed rows with ``source_no, source_size, target``, and the slots. Sizes and places are written once."""
    rows = materialize(placed(materialize(sized(docs, *keep), "sizes")), "placed")
    mixed = plan(
        rows.groupBy("source").agg(F.sum("size").alias("source_size")),
        block_words=block_words, shard_slots=shard_slots, seed=seed,
    )
    spark = docs.sparkSession
    numbered = _numbered(spark, mixed)
    rows = rows.join(numbered, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    return mixed, rows, slots(spark, mixed)


def mix_documents(docs: DataFrame, *, block_words: int = 64, **options) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every row.

    A null or empty text has size 0 and takes nothing; a null source is a source of its own, the last. Rows that
    repeat an id are documents of their own. Reruns on the same rows agree, however the table is split. An empty table
    gives an empty table. Columns other than ``doc_id, text, source`` are not looked at.
    """
    keyed = docs.select("doc_id", "source", "text").withColumn("__row", F.xxhash64("text"))
    _, rows, drawn = mixture(keyed, "__row", block_words=block_words, **options)
    times = drawn.groupBy("source_no", "block").agg(F.count("*").alias("times"))
    words = (F.col("to_word") - F.col("from_word")) * F.coalesce("times", F.lit(0))
    result = ["doc_id", "size", "source_size", "target"]
    taken = (
        _blocks_of(rows, block_words)
        .join(times.hint("merge"), ["source_no", "block"], "left")
        .groupBy(*result, "source_no", "first")
        .agg(F.sum(words).cast("long").alias("taken"))
    )
    without = rows.where("size = 0").select(*result, F.lit(0).cast("long").alias("taken"))
    return taken.select(*result, "taken").unionByName(without)


def _pieces(rows: DataFrame, drawn: DataFrame, block_words: int) -> DataFrame:
    """For each document with words taken, ``__id, __row, __first`` and ``__p``: what each slot takes of it, in order of
    pass and place. Rows that are equal have places of their own in the source, so ``first`` keeps them apart."""
    piece = F.struct("turn", "from_word", "to_word", "shard", "slot", "block")
    return (
        _blocks_of(rows, block_words)
        .join(drawn.hint("merge"), ["source_no", "block"])
        .groupBy("doc_id", "__row", "first")
        .agg(F.sort_array(F.collect_list(piece)).alias("__p"))
        .select(F.col("doc_id").alias("__id"), F.col("__row").alias("__r"), F.col("first").alias("__first"), "__p")
    )


def _with_texts(keyed: DataFrame, pieces: DataFrame) -> DataFrame:
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__row") == F.col("__r"))
    return keyed.dropDuplicates(["doc_id", "__row"]).join(pieces.hint("merge"), same)


def _slices(cut) -> Callable[..., Column]:
    """Of each text the parts that ``cut`` gives for the passes, first words and ends of its pieces."""

    @F.pandas_udf("array<string>")
    def slices(texts: pd.Series, turn: pd.Series, first: pd.Series, after: pd.Series) -> pd.Series:
        out = []
        for text, *taken in zip(texts, turn, first, after, strict=True):
            raw = text.encode("utf-8", "surrogatepass")
            starts, ends = word_places(raw)
            # White space before the first word and behind the last one goes with them.
            starts[0], ends[-1] = 0, len(raw)
            out.append([raw[starts[i] : ends[j - 1]].decode("utf-8", "surrogatepass") for i, j in cut(*taken)])
        return pd.Series(out, dtype=object)

    return lambda: slices("text", "__p.turn", "__p.from_word", "__p.to_word")


def mixed_blocks(docs: DataFrame, *, block_words: int = 64, **options) -> DataFrame:
    """The packed output: ``shard, slot, source, block, turn, n_words, text`` for every slot.

    ``text`` is what the block holds of its documents, in their order in the source, with a blank line between two of them;
    ``turn`` is the pass over the source. Slots of a shard are numbered from 0.
    """
    keyed = docs.withColumn("__row", F.xxhash64(*docs.columns))
    _, rows, drawn = mixture(keyed, "__row", block_words=block_words, **options)
    each = _slices(lambda turn, first, after: zip(first, after, strict=True))
    part = F.explode(F.arrays_zip(F.col("__p").alias("p"), F.col("__texts").alias("t")))
    # The parts of a block come together again: each has a word or more, so there are at most ``block_words``.
    held = F.sort_array(F.collect_list(F.struct((F.col("__first") + F.col("_x.p.from_word")).alias("at"), F.col("_x.t").alias("t"))))
    return (
        _with_texts(keyed.select("doc_id", "source", "text", "__row"), _pieces(rows, drawn, block_words))
        .withColumn("__texts", each())
        .select("source", "__first", part.alias("_x"))
        .groupBy(F.col("_x.p.shard").alias("shard"), F.col("_x.p.slot").alias("slot"), "source", F.col("_x.p.block").alias("block"), F.col("_x.p.turn").alias("turn"))
        .agg(F.sum(F.col("_x.p.to_word") - F.col("_x.p.from_word")).alias("n_words"), held.alias("_t"))
        .select("shard", "slot", "source", "block", "turn", "n_words", F.array_join("_t.t", "\n\n").alias("text"))
    )


def mixed_documents(docs: DataFrame, *, block_words: int = 2048, **options) -> DataFrame:
    """The mix as documents, with the columns of ``docs``: a row for each maximal run of a document's words that a pass
    over its source takes, from the same pieces as ``mixed_blocks``.

    Blocks of one pass that adjoin in a document are one run, so a document that a pass takes wholly is one row with its
    text as written. Other runs have their words as written, with the white space between them; ``n_chars`` is brought
    into line where it exists. A document without words is in no block. Rows that are equal in all columns are
    interchangeable; each takes what its place gives it.
    """
    columns = docs.columns
    keyed = docs.withColumn("__row", F.xxhash64(*columns))
    _, rows, drawn = mixture(keyed, "__row", block_words=block_words, **options)
    out = _with_texts(keyed, _pieces(rows, drawn, block_words)).withColumn("text", F.explode(_slices(runs)()))
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*columns)


def runs(turn: np.ndarray, first: np.ndarray, after: np.ndarray) -> list[tuple[int, int]]:
    """Pieces of a document, in order of pass and place, with those of a pass that adjoin made one."""
    turn, first, after = np.asarray(turn), np.asarray(first), np.asarray(after)
    begins = np.concatenate(([True], (turn[1:] != turn[:-1]) | (first[1:] != after[:-1])))
    at = np.flatnonzero(begins)
    return list(zip(first[at].tolist(), after[np.append(at[1:], len(turn)) - 1].tolist(), strict=True))


def word_places(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of UTF-8 text begin and end, in bytes."""
    b = np.frombuffer(raw, dtype=np.uint8)
    blank = np.concatenate(([True], (b == 32) | ((b >= 9) & (b <= 13)), [True]))
    edge = np.flatnonzero(blank[1:] != blank[:-1])
    return edge[::2], edge[1::2]
