"""One query per operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    collocations,
    decontaminate,
    exact_dedup,
    language,
    mixing,
    near_dedup,
    quality_gam,
    quality_rules,
    token_alignment,
    token_counts,
    token_shards,
    toxicity,
    url_filter,
)
from ledgerloom.llm.registry import query, table


@query("op1_quality_gam")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_gam.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op2_toxicity_subwords")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op3_language_centroids")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


@query("op4_mix_sources")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents"))


DAY, START, HOURS = 86_400, 1_704_067_200, 8_760


def _day(digest, first: int):
    """A day of the year from two characters of a digest."""
    a, b = (F.ascii(F.substring(digest, i, 1)) for i in (first, first + 1))
    return (a * 37 + b * 11) % 365


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with a time of fetch in seconds that follows from the page's id."""
    hour = (F.col("page_id") * 7919) % HOURS
    return table(spark, sf_dir, "pages").select("page_id", "url", (F.lit(START) + hour * 3600).alias("fetched_at"))


def list_entries(pages: DataFrame) -> DataFrame:
    """Dated entries about the hosts, domains and path beginnings of the pages, by digests of their names.

    A third of the hosts are put on a list of bad hosts and taken off again, some of them put on once more;
    the domains above are blocked for some weeks; an eighth of the first path segments are allowed for good.
    """
    hosts = pages.select(url_filter.host_of().alias("host"), F.regexp_extract(url_filter.path_of(), "^(/[^/]+)", 1).alias("first")).where("host <> ''")
    digest = F.md5(F.col("pattern").cast("binary"))
    start = F.lit(START)

    def events(patterns: DataFrame, name: str, kind: str, verdict: str, event: str, at) -> DataFrame:
        return patterns.select(
            F.lit(name).alias("list"), F.lit(kind).alias("kind"), "pattern", F.lit(verdict).alias("verdict"),
            F.lit(event).alias("event"), at.cast("long").alias("at"),
        )

    host = hosts.select(F.col("host").alias("pattern")).distinct()
    bad = host.where(F.substring(digest, 1, 1) < "6")
    added = start + _day(digest, 2) * DAY
    removed = added + (1 + _day(digest, 4) % 90) * DAY
    domain = hosts.select(F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1).alias("pattern")).where("pattern <> ''").distinct()
    month = start + _day(digest, 6) * DAY
    prefix = hosts.where("first <> ''").select(F.concat("host", "first").alias("pattern")).distinct()
    return (
        events(bad, "bad_hosts", "host", "block", "add", added)
        .unionByName(events(bad, "bad_hosts", "host", "block", "remove", removed))
        .unionByName(events(bad.where(F.substring(digest, 8, 1) < "8"), "bad_hosts", "host", "block", "add", removed + 40 * DAY))
        .unionByName(events(domain, "outbreaks", "domain", "block", "add", month))
        .unionByName(events(domain, "outbreaks", "domain", "block", "remove", month + 30 * DAY))
        .unionByName(events(prefix.where(F.substring(digest, 1, 1) < "2"), "good_paths", "prefix", "allow", "add", start + _day(digest, 2) * DAY))
    )


_DAY_SQL = "((ascii(substr(d, {0}, 1)) * 37 + ascii(substr(d, {1}, 1)) * 11) % 365)"
_OP5_SQL = rf"""
    WITH parsed AS (
        SELECT page_id, url, {START} + (page_id * 7919 % {HOURS}) * 3600 AS fetched_at,
               lower(regexp_extract(url, '{url_filter._HOST}', 1)) AS host, regexp_extract(url, '{url_filter._PATH}', 1) AS path
        FROM pages),
    hosts AS (SELECT DISTINCT host AS pattern, md5(host) AS d FROM parsed WHERE host <> ''),
    domains AS (SELECT DISTINCT regexp_extract(host, '([^.]+\.[^.]+)$', 1) AS pattern FROM parsed WHERE host <> ''),
    firsts AS (SELECT DISTINCT host || regexp_extract(path, '^(/[^/]+)', 1) AS pattern FROM parsed
               WHERE host <> '' AND regexp_extract(path, '^(/[^/]+)', 1) <> ''),
    bad AS (SELECT pattern, d, {START} + {_DAY_SQL.format(2, 3)} * {DAY} AS added,
                   {START} + {_DAY_SQL.format(2, 3)} * {DAY} + (1 + {_DAY_SQL.format(4, 5)} % 90) * {DAY} AS removed
            FROM hosts WHERE substr(d, 1, 1) < '6'),
    held AS (
        SELECT 2 AS rank, 'host' AS kind, pattern, 'block' AS verdict, added AS lo, removed AS hi FROM bad
        UNION ALL SELECT 2, 'host', pattern, 'block', removed + 40 * {DAY}, NULL FROM bad WHERE substr(d, 8, 1) < '8'
        UNION ALL SELECT 1, 'domain', pattern, 'block', {START} + {_DAY_SQL.format(6, 7)} * {DAY}, {START} + ({_DAY_SQL.format(6, 7)} + 30) * {DAY}
                  FROM (SELECT pattern, md5(pattern) AS d FROM domains WHERE pattern <> '')
        UNION ALL SELECT 3, 'prefix', pattern, 'allow', {START} + {_DAY_SQL.format(2, 3)} * {DAY}, NULL
                  FROM (SELECT pattern, md5(pattern) AS d FROM firsts) WHERE substr(d, 1, 1) < '2'),
    captures AS (SELECT DISTINCT url, fetched_at, host, path FROM parsed WHERE host <> '' AND fetched_at IS NOT NULL),
    asked AS (
        SELECT url, fetched_at, 'host' AS kind, host AS pattern FROM captures
        UNION SELECT url, fetched_at, 'domain', array_to_string(list_slice(string_split(host, '.'), i, len(string_split(host, '.'))), '.')
              FROM (SELECT *, unnest(range(1, len(string_split(host, '.')) + 1)) AS i FROM captures)
        UNION SELECT url, fetched_at, 'prefix', host || array_to_string(list_slice(string_split(path, '/'), 1, i), '/')
              FROM (SELECT *, unnest(range(2, greatest(2, len(string_split(path, '/'))) + 1)) AS i FROM captures)),
    hits AS (
        SELECT url, fetched_at, rank, kind, pattern, bool_or(verdict = 'allow') AS allows
        FROM asked JOIN held USING (kind, pattern) WHERE lo <= fetched_at AND (hi IS NULL OR fetched_at < hi)
        GROUP BY ALL),
    ranked AS (
        SELECT *, count(*) OVER (PARTITION BY url, fetched_at) AS n_patterns,
               row_number() OVER (PARTITION BY url, fetched_at ORDER BY rank DESC, length(pattern) DESC, allows DESC, pattern DESC) AS nth
        FROM hits)
    SELECT page_id, p.url, p.fetched_at, coalesce(n_patterns, 0) AS n_patterns, kind || ':' || pattern AS rule,
           coalesce(NOT allows, false) AS blocked
    FROM parsed p LEFT JOIN ranked r ON p.url = r.url AND p.fetched_at = r.fetched_at AND nth = 1"""


@query("op5_url_filter", _OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(captures(spark, sf_dir), list_entries(table(spark, sf_dir, "pages")))


@query("op6_token_shards")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_shards.encode_documents(table(spark, sf_dir, "documents"))


def text_edits(docs: DataFrame) -> DataFrame:
    """Three edits of every document: some characters replaced, some put in, and some taken out."""
    n = F.coalesce(F.length("text"), F.lit(0)).cast("long")
    edits = F.array(
        F.struct(F.lit(1).alias("seq"), F.floor(n / 3).alias("at"), F.lit(5).alias("removed"), F.concat(F.lit("revised "), F.col("doc_id").cast("string")).alias("added")),
        F.struct(F.lit(2).alias("seq"), F.floor(n / 2).alias("at"), F.lit(0).alias("removed"), F.lit(" and more.\n\nNew").alias("added")),
        F.struct(F.lit(3).alias("seq"), F.floor(3 * n / 4).alias("at"), F.lit(17).alias("removed"), F.lit("").alias("added")),
    )
    return docs.select("doc_id", F.explode(edits).alias("_e")).select("doc_id", "_e.*")


@query("op7_edit_token_counts")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_counts.count_with_edits(docs, text_edits(docs))


@query("op8_quality_rules")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    trusted = quality_rules.trusted_by_label(docs, table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs, quality_rules.train(docs, trusted))


@query("op9_near_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80)


@query("op10_decontaminate")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op11_token_alignment")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align_documents(table(spark, sf_dir, "documents"))


_OP12_SQL = r"""
    WITH texts AS (
        SELECT doc_id, length(coalesce(text, '')) AS points, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t FROM documents)
    SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
           row_number() OVER best = 1 AS kept, sha256(t) AS text_sha256
    FROM texts
    WINDOW best AS (PARTITION BY t ORDER BY points DESC, doc_id NULLS LAST)"""


@query("op12_exact_dedup", _OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


_OP13_SQL = r"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang,
               unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents),
    worded AS (SELECT lang, string_split_regex(trim(piece, ' ' || chr(9)), '[\x20\x09]+') AS w FROM pieces WHERE trim(piece, ' ' || chr(9)) <> ''),
    totals AS (SELECT lang, sum(len(w)) AS n FROM worded GROUP BY lang),
    starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded),
    f AS (
        SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
        FROM (SELECT *, unnest(range(1, least(4, len(w) - i + 1) + 1)) AS k FROM starts) GROUP BY ALL),
    candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 30),
    cuts AS (
        SELECT c.lang, c.phrase, c.a, l.f AS l, r.f AS r, (2000000::HUGEINT * c.a) // (l.f + r.f) AS score,
               row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY (2000000::HUGEINT * c.a) // (l.f + r.f), j) AS nth
        FROM (SELECT *, unnest(range(1, k)) AS j FROM candidates) c
        JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:j], ' ')
        JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[j + 1:c.k], ' ')),
    inside AS (
        SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS top
        FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM candidates)) GROUP BY ALL),
    ranked AS (
        SELECT cuts.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
        FROM cuts LEFT JOIN inside USING (lang, phrase)
        WHERE nth = 1 AND (top IS NULL OR 100 * top::HUGEINT < 80 * a))
    SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""


@query("op13_phrase_collocations", _OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))
