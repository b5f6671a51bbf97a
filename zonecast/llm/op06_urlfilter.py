"""URL filter lists joined as of the time of each capture.

Dated list events (an entry added or removed on a day) become validity
intervals.  A capture is blocked when an entry that covers its URL was active on
the day it was fetched.  An entry is a domain (it covers its subdomains) or a
host with a path prefix of whole segments.

Every URL has few keys an entry can match: its host, the parent domains of two
labels and more, and its path prefixes.  The join runs on the different (key,
day) pairs of the captures, so that a host with a third of all captures meets
the lists once per day, and its captures are spread over the days when the
answers come back.

Defined results: a null URL or one without scheme and host, and a null day, are
never blocked; of several active entries the longest is reported (ties: smaller
text); on one day a removal follows an addition; events without entry or day are
ignored; repeated captures give a row each; empty tables give no blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from zonecast.llm.common import with_row_ids, write_table

_HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"
_PATH = r"^[a-z][a-z0-9+.-]*://[^/?#]+(/[^?#]*)"


def host(url: Column) -> Column:
    return F.regexp_extract(F.lower(url), _HOST, 1)


def url_keys(url: Column) -> Column:
    """Everything an entry may say to cover the URL."""
    name = host(url)
    labels = F.split(name, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
                          lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    steps = F.filter(F.split(F.regexp_extract(F.lower(url), _PATH, 1), "/"), lambda s: s != "")
    prefixes = F.when(F.size(steps) > 0, F.transform(
        F.sequence(F.lit(1), F.size(steps)),
        lambda i: F.concat(name, F.lit("/"), F.array_join(F.slice(steps, F.lit(1), i), "/")))).otherwise(
        F.array().cast("array<string>"))
    return F.when(name != "", F.array_distinct(F.concat(domains, prefixes))).otherwise(F.array().cast("array<string>"))


def intervals(events: DataFrame) -> DataFrame:
    """(entry, day, listed) -> (entry, since, until): the days from ``since`` up to before ``until``."""
    last = (with_row_ids(events, "entry", "day", "listed").where("entry IS NOT NULL AND day IS NOT NULL AND listed IS NOT NULL")
            .groupBy(F.lower("entry").alias("entry"), "day").agg(F.min("listed").alias("listed")))
    w = W.partitionBy("entry").orderBy("day")
    return (last.withColumn("until", F.lead("day").over(w)).where("listed")
            .select("entry", F.col("day").alias("since"), F.coalesce("until", F.lit(2**31 - 1)).alias("until")))


def filter_urls(captures: DataFrame, events: DataFrame) -> DataFrame:
    """(id, url, day) captures -> id, host, day, blocked, entry, since."""
    rows = with_row_ids(captures, "id", "url", "day")
    active, _ = write_table(intervals(events), "intervals")
    keyed, _ = write_table(rows.select("id", "url", "day", F.explode(url_keys(F.col("url"))).alias("key")), "url-keys")
    asked = keyed.where("day IS NOT NULL").select("key", "day").distinct()
    hits, _ = write_table(
        asked.join(active, (F.col("key") == F.col("entry")) & (F.col("day") >= F.col("since")) & (F.col("day") < F.col("until")))
        .groupBy("key", "day").agg(F.max("since").alias("since")), "url-hits")
    best, _ = write_table(
        keyed.join(hits, ["key", "day"]).groupBy("id", "url", "day")
        .agg(F.min(F.struct((-F.length("key")).alias("n"), "key", "since")).alias("b"))
        .select("id", "url", "day", F.col("b.key").alias("entry"), F.col("b.since").alias("since")), "url-best")
    joined = rows.alias("r").join(best.alias("b"), F.expr("r.id <=> b.id AND r.url = b.url AND r.day = b.day"), "left")
    return joined.select("r.id", F.coalesce(host(F.col("r.url")), F.lit("")).alias("host"), "r.day",
                         F.col("b.entry").isNotNull().alias("blocked"), "b.entry", "b.since")


def page_captures(pages: DataFrame) -> DataFrame:
    """Captures of the given pages; the table has no fetch time, so the day (0 to 365) follows from the id."""
    return with_row_ids(pages, "page_id", "url").select(
        F.col("page_id").alias("id"), "url", F.pmod(F.col("page_id") * 7919, F.lit(366)).cast("int").alias("day"))


def page_list_events(pages: DataFrame) -> DataFrame:
    """Dated list events derived from all hosts of the pages: three fifths of the
    hosts are listed, as host, parent domain or path, and some are removed or
    listed again later, as the digits of their md5 say."""
    hosts = with_row_ids(pages, "url").select(host(F.col("url")).alias("h")).where("h <> ''").distinct()
    digits = [F.conv(F.substring(F.md5("h"), at, 4), 16, 10).cast("int") for at in (1, 5)]
    base = hosts.select("h", digits[0].alias("i"), digits[1].alias("j")).where("i % 5 < 3")
    entry = F.expr("CASE WHEN i % 3 = 0 THEN h WHEN i % 3 = 1 THEN regexp_replace(h, '^[^.]+[.]([^.]+[.][^.]+[.])', '$1')"
                   " ELSE concat(h, '/en') END")
    events = F.expr("filter(array(struct(i % 200 AS day, true AS listed),"
                    " struct(if(j % 4 > 0, i % 200 + 20 + j % 100, -1) AS day, false AS listed),"
                    " struct(if(j % 4 = 1, i % 200 + 130, -1) AS day, true AS listed)), e -> e.day >= 0)")
    return base.select(entry.alias("entry"), F.explode(events).alias("e")).select("entry", "e.day", "e.listed")


#: The same result in DuckDB: every key of a page against every interval of that entry.
URL_FILTER_SQL = r"""
WITH captures AS (
  SELECT page_id, url, CAST(((page_id * 7919) % 366 + 366) % 366 AS INTEGER) AS day,
         regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1) AS host,
         regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://[^/?#]+(/[^?#]*)', 1) AS path
  FROM pages),
listed AS (
  SELECT h, CAST('0x' || substr(md5(h), 1, 4) AS INTEGER) AS i, CAST('0x' || substr(md5(h), 5, 4) AS INTEGER) AS j
  FROM (SELECT DISTINCT host AS h FROM captures WHERE host <> '')),
named AS (
  SELECT CASE i % 3 WHEN 0 THEN h WHEN 1 THEN regexp_replace(h, '^[^.]+[.]([^.]+[.][^.]+[.])', '\1') ELSE h || '/en' END AS entry, i, j
  FROM listed WHERE i % 5 < 3),
events AS (
  SELECT entry, i % 200 AS day, true AS listed FROM named
  UNION ALL SELECT entry, i % 200 + 20 + j % 100, false FROM named WHERE j % 4 > 0
  UNION ALL SELECT entry, i % 200 + 130, true FROM named WHERE j % 4 = 1),
days AS (SELECT entry, day, bool_and(listed) AS listed FROM events GROUP BY entry, day),
spans AS (
  SELECT entry, day AS since, coalesce(lead(day) OVER (PARTITION BY entry ORDER BY day), 2147483647) AS until, listed FROM days),
keys AS (
  SELECT DISTINCT page_id, url, day, array_to_string(list_slice(string_split(host, '.'), k, len(string_split(host, '.'))), '.') AS key
  FROM captures, range(1, greatest(len(string_split(host, '.')), 2)) r(k) WHERE host <> ''
  UNION
  SELECT page_id, url, day, host || '/' || array_to_string(list_slice(list_filter(string_split(path, '/'), lambda s: s <> ''), 1, k), '/')
  FROM captures, range(1, 1 + len(list_filter(string_split(path, '/'), lambda s: s <> ''))) r(k) WHERE host <> ''),
best AS (
  SELECT page_id, url, k.day, entry, max(since) AS since,
         row_number() OVER (PARTITION BY page_id, url, k.day ORDER BY length(entry) DESC, entry) AS place
  FROM keys k JOIN spans s ON k.key = s.entry AND s.listed AND k.day >= s.since AND k.day < s.until
  GROUP BY page_id, url, k.day, entry)
SELECT c.page_id, c.host, c.day, b.entry IS NOT NULL AS blocked, b.entry, b.since
FROM captures c LEFT JOIN best b ON b.page_id = c.page_id AND b.url = c.url AND b.day = c.day AND b.place = 1
"""
