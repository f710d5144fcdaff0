"""Exact, seeded splits, samples and numberings without a global sort.

Rows are ordered by a seeded 64-bit hash of their key. The row of a given rank in that order is
found in two steps: rows are counted per class and leading bits of the hash, which names the
prefix the rank falls into, and only rows under such a prefix are ranked. The hash spreads
rows evenly, so a prefix holds one of 65,536 parts of a class. What comes out is a table with a
few cut points per class. It is written down, which takes these two passes over narrow columns
when a split is asked for; the split itself is a join with that table, which Spark broadcasts
while it is small, and a comparison. Nothing else depends on how many rows or classes there are.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.hashing import seeded_hash
from ledgerloom.session import materialize

PREFIX_BITS = 16
NUMBER_BITS = 20
_WIDE = "decimal(38,0)"


def _unsigned_order(hash_column: Column) -> Column:
    """Hash moved to [0, 2**63) so that prefixes are plain right shifts."""
    return F.shiftrightunsigned(hash_column, 1)


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """``_class`` and its number of rows ``n``."""
    return df.groupBy(F.col(label).alias("_class")).agg(F.count(F.lit(1)).alias("n"))


def proportional_quota(counts: DataFrame, draws: Column, target: str = "q", n: str = "n") -> DataFrame:
    """Add ``target``: the share of ``draws`` of each class in proportion to ``n``, by largest remainder.

    Equal remainders go by class, nulls first. ``counts`` has one row per class.
    """
    everything = Window.partitionBy(F.lit(0))
    total = F.sum(n).over(everything).cast(_WIDE)
    product = F.col(n).cast(_WIDE) * draws.cast(_WIDE)
    ranked = (
        counts.withColumns({"_draws": draws, "_total": total, "_product": product})
        .withColumn("_base", F.coalesce(F.expr("_product div _total"), F.lit(0)).cast("long"))
        .withColumn("_rest", F.col("_product") - F.col("_base").cast(_WIDE) * F.col("_total"))
    )
    place = F.row_number().over(everything.orderBy(F.desc("_rest"), F.asc_nulls_first("_class")))
    left = F.col("_draws") - F.sum("_base").over(everything)
    return ranked.withColumn(target, F.col("_base") + (place <= left).cast("long")).drop(
        "_draws", "_total", "_product", "_base", "_rest"
    )


def _cut_points(df: DataFrame, classes: Column, key: str, seed: int, ranks: Callable[[DataFrame], DataFrame], cuts: int) -> DataFrame:
    """One row per class: ``_class`` and for each cut i ``_h<i>`` and ``_k<i>``, hash and key of the row it comes behind.

    ``ranks`` maps ``_class, n`` to the same with ``_rank0`` up to ``_rank<cuts - 1>``, 1-based ranks; 0 is
    in front of all rows, and a rank of ``n`` or more behind them.
    """
    h = _unsigned_order(seeded_hash(seed, F.col(key)))
    rows = df.select(classes.alias("_class"), h.alias("_h"), F.col(key).alias("_key")).withColumn(
        "_p", F.shiftright("_h", 63 - PREFIX_BITS)
    )
    prefixes = rows.groupBy("_class", "_p").agg(F.count(F.lit(1)).alias("_n"))
    wanted = ranks(prefixes.groupBy("_class").agg(F.sum("_n").alias("n")))
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"_rank{i}").alias("rank")) for i in range(cuts)]))
    searched = wanted.select(F.col("_class").alias("_c"), "n", each.alias("_w")).select("_c", "n", "_w.i", "_w.rank")
    upto = F.sum("_n").over(Window.partitionBy("_class").orderBy("_p"))
    holds = (F.col("_upto") >= F.col("rank")) & (F.col("_upto") - F.col("_n") < F.col("rank"))
    open_searches = (
        prefixes.withColumn("_upto", upto)
        .join(searched.where((F.col("rank") > 0) & (F.col("rank") < F.col("n"))), F.col("_class").eqNullSafe(F.col("_c")))
        .where(holds)
        .select("_c", F.col("_p").alias("_q"), "i", (F.col("rank") - F.col("_upto") + F.col("_n")).alias("_nth"))
    )
    order = Window.partitionBy("_c", "_q", "i").orderBy("_h", F.asc_nulls_first("_key"))
    found = (
        rows.join(open_searches, F.col("_class").eqNullSafe(F.col("_c")) & (F.col("_p") == F.col("_q")))
        .withColumn("_r", F.row_number().over(order))
        .where(F.col("_r") == F.col("_nth"))
        .select(F.col("_c").alias("_fc"), F.col("i").alias("_fi"), "_h", "_key")
    )
    # In front of all rows: a hash below all; behind them: one above all.
    edge = F.when(F.col("rank") <= 0, F.lit(-1)).otherwise(F.lit(2**63 - 1)).cast("long")
    at = searched.join(found, F.col("_c").eqNullSafe(F.col("_fc")) & (F.col("i") == F.col("_fi")), "left").withColumn(
        "_h", F.coalesce("_h", edge)
    )
    columns = []
    for i in range(cuts):
        point = F.max(F.when(F.col("i") == i, F.struct("_h", "_key")))
        columns += [point["_h"].alias(f"_h{i}"), point["_key"].alias(f"_k{i}")]
    return at.groupBy(F.col("_c").alias("_cut_class")).agg(*columns)


def _with_part(
    df: DataFrame, classes: Column, key: str, seed: int, ranks: Callable[[DataFrame], DataFrame], names: Sequence[str], target: str
) -> DataFrame:
    cuts = materialize(_cut_points(df, classes, key, seed, ranks, len(names) - 1), "cuts")
    h = _unsigned_order(seeded_hash(seed, F.col(key)))
    part = F
    for i, name in enumerate(names[:-1]):
        # Keys without a value come first, as in the ranking.
        tied = (h == F.col(f"_h{i}")) & (F.col(key).isNull() | (F.col(key) <= F.col(f"_k{i}")))
        part = part.when((h < F.col(f"_h{i}")) | F.coalesce(tied, F.lit(False)), F.lit(name))
    out = df.join(cuts, classes.eqNullSafe(F.col("_cut_class")), "left")
    return out.withColumn(target, part.otherwise(F.lit(names[-1]))).select(*df.columns, target)


def _rounded_up(total: Column, share: float) -> Column:
    return F.ceil(total * F.lit(share) - F.lit(1e-9)).cast("long")


def stratified_split(
    df: DataFrame,
    label: str,
    key: str,
    seed: int = 42,
    held_out: float = 0.2,
    names: Sequence[str] = ("train", "validation", "test"),
) -> DataFrame:
    """Add ``split``: ``held_out`` of the rows set aside, then halved, both by class.

    Sizes are exact, with the held-out part rounded up, where keys are unique; rows that share a
    key lie on the same side of a cut.
    """
    everything = Window.partitionBy(F.lit(0))

    def ranks(counts: DataFrame) -> DataFrame:
        total = F.sum("n").over(everything)
        held = _rounded_up(total, held_out)
        rows = counts.withColumns({"_all": total, "_held": held})
        rows = proportional_quota(rows, F.col("_all") - F.col("_held"), "_rank0")
        rows = rows.withColumns({"_left": F.col("n") - F.col("_rank0"), "_first": F.floor(F.col("_held") / 2)})
        rows = proportional_quota(rows, F.col("_first"), "_more", "_left")
        return rows.withColumn("_rank1", F.col("_rank0") + F.col("_more"))

    return _with_part(df, F.col(label), key, seed, ranks, names, "split")


def random_split(
    df: DataFrame,
    key: str,
    seed: int = 42,
    test_size: float = 0.2,
    names: Sequence[str] = ("train", "test"),
) -> DataFrame:
    """Add ``split`` with an exact test share, rounded up, regardless of class."""

    def ranks(counts: DataFrame) -> DataFrame:
        return counts.withColumn("_rank0", F.col("n") - _rounded_up(F.col("n"), test_size))

    return _with_part(df, F.lit(0), key, seed, ranks, names, "split")


def group_split(
    df: DataFrame, group: str, seed: int = 42, test_size: float = 0.2,
    names: Sequence[str] = ("train", "test"),
) -> DataFrame:
    """Add ``split`` so that all rows of a group land on the same side; sizes are approximate."""
    share = F.pmod(seeded_hash(seed, F.col(group)), F.lit(1_000_000)) / 1_000_000
    return df.withColumn("split", F.when(share < test_size, names[1]).otherwise(names[0]))


def sample_rows(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows, or all if there are fewer; the same rows for the same seed.

    The n-th row in hash order is found as for a split, and the sample is a filter. A sort with
    a limit would send n whole rows of every task to a single one.
    """
    if n < 0:
        raise ValueError("n must not be negative")
    part = _with_part(
        df, F.lit(0), key, seed, lambda counts: counts.withColumn("_rank0", F.lit(n).cast("long")), ("in", "out"), "_part"
    )
    return part.where(F.col("_part") == "in").drop("_part")


def shuffle_rows(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """All rows in a seeded random order, by a range-partitioned sort on the hash."""
    return df.orderBy(_unsigned_order(seeded_hash(seed, F.col(key))), key)


def number_rows(df: DataFrame, key: str, seed: int = 42, target: str = "sample_idx") -> DataFrame:
    """Add a dense 0-based number, the place of each row in the order of ``shuffle_rows``.

    Leading hash bits put rows into 2**20 even buckets in that order. Rows are numbered within
    their bucket, and the offset of each bucket comes from the counts of the buckets.
    """
    h = _unsigned_order(seeded_hash(seed, F.col(key)))
    rows = df.withColumn("_h", h).withColumn("_bucket", F.shiftright("_h", 63 - NUMBER_BITS))
    # A fixed number of rows at most, whatever the table holds.
    offsets = (
        rows.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_offset", F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy("_bucket")) - F.col("_n"))
        .select("_bucket", "_offset")
    )
    order = Window.partitionBy("_bucket").orderBy("_h", key)
    return (
        rows.withColumn("_r", F.row_number().over(order))
        .join(offsets, "_bucket")
        .withColumn(target, (F.col("_offset") + F.col("_r") - 1).cast("long"))
        .drop("_h", "_bucket", "_r", "_offset")
    )


def batch_number(index: Column, batch_size: int) -> Column:
    """1-based batch of a 0-based row number."""
    return (F.floor(index / batch_size) + 1).cast("long")


def content_key(df: DataFrame, content: Sequence[str], target: str = "row_key") -> DataFrame:
    """Add a key that follows from what a row holds: a digest of ``content`` and a number among equal rows.

    Equal rows are interchangeable, so it does not matter which of them gets which number. The numbers
    come from counts per task, so many copies of one row are numbered in many tasks. The table is written
    down once, as the tasks' rows must be the same for the counts and for the numbering.
    """
    digest = F.sha2(F.to_json(F.struct(*content), {"ignoreNullFields": "false"}), 256)
    rows = materialize(df.withColumns({"_digest": digest, "_task": F.spark_partition_id()}), "keyed")
    before = Window.partitionBy("_digest").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("_digest", "_task")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_digest", "_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    here = Window.partitionBy("_digest", "_task").orderBy(F.lit(0))
    return (
        rows.withColumn("_r", F.row_number().over(here))
        .join(offsets, ["_digest", "_task"])
        .withColumn(target, F.concat_ws("#", "_digest", (F.col("_offset") + F.col("_r")).cast("string")))
        .select(*df.columns, target)
    )
