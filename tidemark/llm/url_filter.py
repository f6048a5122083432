"""URL filters with dated lists.

List entries are events: a domain joins or leaves a list at a time. They become validity intervals, and an as-of join
evaluates each capture against the entries that were active when it was fetched, for its host and every parent domain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


#: An address in numbers, which has no parent domains.
ADDRESS = r"^(\[.*|[0-9.]+)$"


def _name(host: Column) -> Column:
    """In lower case, without the dot of the root."""
    return F.regexp_replace(F.lower(host), r"\.+$", "")


def host_of(url: Column) -> Column:
    """The lower-case host of a URL without a final dot (an IPv6 address in its brackets), null where there is none."""
    return F.nullif(_name(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:\[]+)", 1)), F.lit(""))


def domains_of(host: Column) -> Column:
    """The host and its parent domains, down to two labels (a host of one label, or an address, is its own)."""
    parts = F.split(host, r"\.")
    return F.when((F.size(parts) > 1) & ~host.rlike(ADDRESS), F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, i, F.size(parts) - i + 1), "."))).otherwise(F.array(host))


def validity(entries: DataFrame) -> DataFrame:
    """list, domain, valid_from, valid_to (exclusive, null while open) from events (list, domain, at, listed).

    Of events of one list, domain and time, a removal wins. Events that repeat the state before them change nothing. Rows with
    a null are left out.
    """
    events = entries.select("list", _name(F.col("domain")).alias("domain"), "at", "listed").dropna().groupBy("list", "domain", "at").agg(F.min("listed").alias("listed"))
    w = W.partitionBy("list", "domain").orderBy("at")
    changes = events.withColumn("was", F.coalesce(F.lag("listed").over(w), F.lit(False))).where("listed <> was")
    return changes.withColumn("valid_to", F.lead("at").over(w)).where("listed").select("list", "domain", F.col("at").alias("valid_from"), "valid_to")


def evaluate(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url", at_col: str = "fetched_at") -> DataFrame:
    """One row per distinct capture: page_id, fetched_at, host, blocked, matched_domain (the longest one active), lists (sorted, by comma).

    A capture is blocked if its host or a parent domain was on a list when it was fetched. A null URL or one without a host has
    a null host and is not blocked, nor is a capture without a time. Rows that repeat a whole capture count once. Other
    columns are ignored.
    """
    seen = captures.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(at_col).alias("fetched_at")).distinct().withColumn("host", host_of(F.col("url")))
    asked = seen.select("page_id", "url", "fetched_at", "host", F.explode(domains_of(F.col("host"))).alias("of"))
    on = F.expr("of = domain AND valid_from <= fetched_at AND (valid_to IS NULL OR fetched_at < valid_to)")
    lists = F.array_sort(F.collect_set("list"))
    found = asked.join(validity(entries), on, "left").groupBy("page_id", "url", "fetched_at", "host").agg(F.max_by("domain", F.length("domain")).alias("matched_domain"), lists.alias("lists"))
    return found.select("page_id", "fetched_at", "host", (F.size("lists") > 0).alias("blocked"), "matched_domain", F.nullif(F.array_join("lists", ","), F.lit("")).alias("lists"))


def dated_pages(pages: DataFrame) -> DataFrame:
    """Pages as captures of January 2024: page n is fetched n hours, modulo the month, after its start."""
    return pages.withColumn("fetched_at", F.timestamp_seconds(F.lit(1704067200) + F.col("page_id") % 744 * 3600))


def derived_entries(pages: DataFrame) -> DataFrame:
    """A dated list of the pages' own domains: the digest of a host decides on its list, when it joins, leaves and returns."""
    hosts = pages.select(host_of(F.col("url")).alias("host")).where("host IS NOT NULL").distinct()
    digit = lambda at, n: F.conv(F.substring(F.md5("host"), at, 4), 16, 10).cast("long") % n
    named = hosts.select(
        F.element_at(F.array(F.lit("adult"), F.lit("malware"), F.lit("spam")), (digit(1, 3) + 1).cast("int")).alias("list"),
        F.when(digit(5, 2) == 0, F.array_join(F.slice(F.split("host", r"\."), -2, 2), ".")).otherwise(F.col("host")).alias("domain"),
        digit(9, 600).alias("joins"),
        digit(13, 200).alias("stays"),
        digit(17, 3).alias("fate"),
    )
    when = lambda c: F.timestamp_seconds(F.lit(1704067200) + c * 3600)
    events = F.array(F.struct(when(F.col("joins")).alias("at"), F.lit(True).alias("listed")), F.struct(when(F.col("joins") + F.col("stays")).alias("at"), F.lit(False).alias("listed")), F.struct(when(F.col("joins") + 2 * F.col("stays")).alias("at"), F.lit(True).alias("listed")))
    return named.select("list", "domain", F.explode(F.slice(events, F.lit(1), (F.col("fate") + 1).cast("int"))).alias("e")).select("list", "domain", "e.at", "e.listed")


def filtered(pages: DataFrame) -> DataFrame:
    return evaluate(dated_pages(pages), derived_entries(pages)).withColumn("fetched_at", F.unix_timestamp("fetched_at"))


ORACLE_SQL = r"""
WITH p AS (SELECT DISTINCT page_id, url, to_timestamp(1704067200 + page_id % 744 * 3600) AS fetched_at,
                  nullif(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:\[]+)', 1)), '\.+$', ''), '') AS host FROM pages),
h AS (SELECT DISTINCT host, md5(host) AS m, string_split(host, '.') AS parts FROM p WHERE host IS NOT NULL),
n AS (SELECT ['adult', 'malware', 'spam'][('0x' || substr(m, 1, 4))::BIGINT % 3 + 1] AS list,
             CASE WHEN ('0x' || substr(m, 5, 4))::BIGINT % 2 = 0 THEN array_to_string(parts[-2:], '.') ELSE host END AS domain,
             ('0x' || substr(m, 9, 4))::BIGINT % 600 AS joins, ('0x' || substr(m, 13, 4))::BIGINT % 200 AS stays, ('0x' || substr(m, 17, 4))::BIGINT % 3 AS fate FROM h),
e AS (SELECT list, domain, joins AS hour, TRUE AS listed FROM n
      UNION ALL SELECT list, domain, joins + stays, FALSE FROM n WHERE fate > 0
      UNION ALL SELECT list, domain, joins + 2 * stays, TRUE FROM n WHERE fate > 1),
one AS (SELECT list, domain, to_timestamp(1704067200 + hour * 3600) AS moment, bool_and(listed) AS listed FROM e GROUP BY ALL),
changed AS (SELECT *, coalesce(lag(listed) OVER (PARTITION BY list, domain ORDER BY moment), FALSE) AS was FROM one),
spans AS (SELECT list, domain, moment AS valid_from, lead(moment) OVER (PARTITION BY list, domain ORDER BY moment) AS valid_to, listed FROM changed WHERE listed <> was),
asked AS (SELECT page_id, url, fetched_at, unnest(CASE WHEN regexp_matches(host, '^(\[.*|[0-9.]+)$') THEN [host] ELSE list_transform(range(1, greatest(2, len(string_split(host, '.')))), lambda i: array_to_string(string_split(host, '.')[i:], '.')) END) AS domain FROM p WHERE host IS NOT NULL),
hits AS (SELECT page_id, url, fetched_at, arg_max(a.domain, length(a.domain)) AS matched_domain, array_to_string(list_sort(list(DISTINCT list)), ',') AS lists
         FROM asked a JOIN spans s ON a.domain = s.domain AND s.listed AND s.valid_from <= fetched_at AND (s.valid_to IS NULL OR fetched_at < s.valid_to) GROUP BY ALL)
SELECT p.page_id, CAST(epoch(p.fetched_at) AS BIGINT) AS fetched_at, host, lists IS NOT NULL AS blocked, matched_domain, lists FROM p LEFT JOIN hits USING (page_id, url, fetched_at)
"""
