"""URL filters whose lists change over time: a temporal join of captures with dated list entries.

Entries are events: a pattern is added to a list, or removed, at a time. Each addition holds until the next
event of its pattern on its list, which makes validity intervals. The intervals of a pattern are summed into
its timeline: how many lists allow and how many block it, from each moment on. A capture is asked under every
pattern that could cover it (its host, the domains above it, the beginnings of its path), and each question finds
the latest moment of that pattern's timeline at or before the fetch (an as-of join). The most specific pattern
that is listed then decides; at equal specificity allowing wins.

Everything is DataFrame functions. The as-of join sorts questions and moments of a pattern together; a pattern
with many questions is dealt to several tasks, each of which gets that pattern's moments.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Specificity of the kinds of patterns; within a kind a longer pattern is the more specific.
KINDS = {"domain": 1, "host": 2, "prefix": 3}
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"


def host_of(url: str = "url") -> Column:
    """The lower-case host, without user or port; empty if the text is no URL, null if it is null."""
    return F.lower(F.regexp_extract(url, _HOST, 1))


def path_of(url: str = "url") -> Column:
    return F.regexp_extract(url, _PATH, 1)


def intervals(entries: DataFrame) -> DataFrame:
    """``list, kind, pattern, verdict, valid_from, valid_to`` (null: still valid) of every addition.

    ``entries``: ``list, kind`` (domain, host or prefix), ``pattern``, ``verdict`` (allow or block), ``event`` (add or
    remove), ``at``. Events without a pattern, a time or a known kind, verdict or event are left out. Of events of a
    pattern on a list at one time an addition comes last and so holds, a block last of all; repeated rows change
    nothing.
    """
    known = (
        F.col("pattern").isNotNull() & F.col("at").isNotNull() & F.col("kind").isin(*KINDS)
        & F.col("verdict").isin("allow", "block") & F.col("event").isin("add", "remove")
    )
    of_pattern = Window.partitionBy("list", "kind", "pattern").orderBy("at", F.desc("event"), "verdict")
    return (
        entries.select("list", "kind", "pattern", "verdict", "event", "at")
        .where(known)
        .distinct()
        .withColumn("valid_to", F.lead("at").over(of_pattern))
        .where((F.col("event") == "add") & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("at"))))
        .select("list", "kind", "pattern", "verdict", F.col("at").alias("valid_from"), "valid_to")
    )


def timelines(valid: DataFrame) -> DataFrame:
    """``kind, pattern, at, n_allow, n_block``: how many lists hold a pattern from ``at`` on, a row per change."""
    change = F.explode(
        F.array(
            F.struct(F.col("valid_from").alias("at"), F.lit(1).alias("by")),
            F.struct(F.col("valid_to").alias("at"), F.lit(-1).alias("by")),
        )
    )
    moments = (
        valid.select("kind", "pattern", "verdict", change.alias("_c"))
        .where("_c.at IS NOT NULL")
        .groupBy("kind", "pattern", F.col("_c.at").alias("at"))
        .agg(
            F.sum(F.when(F.col("verdict") == "allow", F.col("_c.by")).otherwise(0)).alias("_allow"),
            F.sum(F.when(F.col("verdict") == "block", F.col("_c.by")).otherwise(0)).alias("_block"),
        )
    )
    so_far = Window.partitionBy("kind", "pattern").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    return moments.select(
        "kind", "pattern", "at", F.sum("_allow").over(so_far).alias("n_allow"), F.sum("_block").over(so_far).alias("n_block")
    )


def questions(captures: DataFrame) -> DataFrame:
    """Every pattern that could cover a capture: ``url, fetched_at, kind, pattern``."""
    labels, segments = F.split("_host", r"\."), F.split("_path", "/")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.struct(F.lit("domain").alias("kind"), F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("pattern")),
    )
    hosts = F.array(F.struct(F.lit("host").alias("kind"), F.col("_host").alias("pattern")))
    # The empty segment before the first slash makes the host alone, which is no prefix.
    paths = F.transform(
        F.sequence(F.lit(2), F.greatest(F.lit(2), F.size(segments))),
        lambda i: F.struct(
            F.lit("prefix").alias("kind"), F.concat("_host", F.array_join(F.slice(segments, F.lit(1), i), "/")).alias("pattern")
        ),
    )
    return (
        captures.withColumn("_host", host_of())
        .withColumn("_path", path_of())
        .where((F.col("_host") != "") & F.col("fetched_at").isNotNull())
        .select("url", "fetched_at", F.explode(F.array_distinct(F.concat(domains, hosts, paths))).alias("_q"))
        .select("url", "fetched_at", "_q.kind", "_q.pattern")
    )


def as_of(asked: DataFrame, timeline: DataFrame, *, rows_per_task: int = 200_000) -> DataFrame:
    """``asked`` with ``n_allow, n_block`` of its pattern at its time, where some list holds it then.

    Only patterns that are listed go on. One with many questions is cut into groups of about ``rows_per_task`` by a
    hash of the question, and each group is sorted together with a copy of the pattern's moments.
    """
    pattern = ["kind", "pattern"]
    listed = asked.join(timeline.select(*pattern).distinct(), pattern, "left_semi")
    groups = listed.groupBy(*pattern).agg(F.ceil(F.count("*") / rows_per_task).cast("int").alias("_groups"))
    dealt = listed.join(groups, pattern).withColumn("_group", F.pmod(F.xxhash64("url", "fetched_at"), F.col("_groups")).cast("int"))
    moments = timeline.join(groups, pattern).withColumn("_group", F.explode(F.sequence(F.lit(0), F.col("_groups") - 1)))
    both = dealt.select(*pattern, "_group", F.col("fetched_at").alias("_at"), F.lit(1).alias("_asks"), "url", F.lit(None).cast("struct<n_allow:bigint,n_block:bigint>").alias("_state")).unionByName(
        moments.select(
            *pattern, "_group", F.col("at").alias("_at"), F.lit(0).alias("_asks"), F.lit(None).cast("string").alias("url"),
            F.struct(F.col("n_allow").cast("bigint").alias("n_allow"), F.col("n_block").cast("bigint").alias("n_block")).alias("_state"),
        )
    )
    until = Window.partitionBy(*pattern, "_group").orderBy("_at", "_asks").rowsBetween(Window.unboundedPreceding, 0)
    return (
        both.withColumn("_then", F.last("_state", ignorenulls=True).over(until))
        .where((F.col("_asks") == 1) & ((F.col("_then.n_allow") > 0) | (F.col("_then.n_block") > 0)))
        .select("url", F.col("_at").alias("fetched_at"), *pattern, "_then.n_allow", "_then.n_block")
    )


def filter_urls(captures: DataFrame, entries: DataFrame, **options) -> DataFrame:
    """``captures`` with ``n_patterns`` (listed patterns at the fetch), ``rule`` (the one that decides, as
    ``kind:pattern``) and ``blocked``.

    ``captures`` has ``url`` and ``fetched_at`` (any type that sorts, as that of ``at`` in ``entries``). Without url, host or
    time no pattern applies: 0, null, false. Captures that agree in url and time are asked once and each get the
    answer. An empty table gives an empty table, an empty list blocks nothing. Columns of ``captures`` named like a
    result are replaced by it.
    """
    result = ("n_patterns", "rule", "blocked")
    rank = F.struct(
        F.coalesce(*(F.when(F.col("kind") == k, F.lit(v)) for k, v in KINDS.items())).alias("kind_rank"),
        F.length("pattern").alias("size"), (F.col("n_allow") > 0).alias("allows"),
        F.concat_ws(":", "kind", "pattern").alias("rule"),
    )
    asked = questions(captures.select("url", "fetched_at").distinct())
    answers = (
        as_of(asked, timelines(intervals(entries)), **options)
        .groupBy(F.col("url").alias("_url"), F.col("fetched_at").alias("_at"))
        .agg(F.count("*").alias("n_patterns"), F.max(rank).alias("_best"))
        .select("_url", "_at", "n_patterns", F.col("_best.rule").alias("rule"), (~F.col("_best.allows")).alias("blocked"))
    )
    plain = captures.drop(*result)
    same = (F.col("url") == F.col("_url")) & (F.col("fetched_at") == F.col("_at"))
    return (
        plain.join(answers, same, "left")
        .drop("_url", "_at")
        .withColumn("n_patterns", F.coalesce("n_patterns", F.lit(0)))
        .withColumn("blocked", F.coalesce("blocked", F.lit(False)))
    )
