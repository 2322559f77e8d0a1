"""Temporal URL filter: every capture against the list entries active when it
was fetched.  DataFrame functions only.

A list's history is dated entries (key, action ``add`` or ``remove``, at),
where a key is a host or a domain, which also covers its subdomains.  The
entries of a key become validity intervals [since, until): an ``add`` holds
until the key's next entry; the latest of several entries at one time counts
(``remove`` before ``add``).  The as-of join looks a capture's host and its
parent domains up among the intervals that hold at its fetch time, to the
microsecond; a date counts as its midnight.

For the join an interval is dealt over the months it touches and a capture
belongs to one month, so a key that changes often meets each capture with one
month's intervals only, and (key, month) spreads a hot host.  The join is an
equi-join with a range test; the engine splits skewed partitions of it.

Edge cases: captures without url, host or time pass unfiltered (blocked is
false); entries with null key, action or time are ignored; repeated captures
are judged each; an empty list blocks nothing; the most specific active key is
reported.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastemap.llm.text import fresh

# As browsers read it: an optional scheme, two slashes or more of either kind,
# anything up to the last @ before the path, then the host.
HOST = r"^[\x00-\x20]*(?:[A-Za-z][A-Za-z0-9+.-]*:)?[/\\]{2,}(?:[^/\\?#]*@)?(\[[^\]/\\?#]*\]|[^/\\?#:]+)"


def host_of(url: Column) -> Column:
    """The lower-cased host, null where there is none."""
    host = F.lower(F.regexp_extract(url, HOST, 1))
    return F.when(host != "", F.rtrim(host, F.lit(".")))


def keys_of(host: Column) -> Column:
    """The host and its parent domains of two labels or more, longest first."""
    parts = F.split(host, r"\.")
    n = F.size(parts)
    return F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))),
                       lambda i: F.array_join(F.slice(parts, i, n), "."))


def intervals(entries: DataFrame) -> DataFrame:
    """key, since, until (null: still active) from key, action, at."""
    rows = (entries.select(F.lower("key").alias("key"), F.lower("action").alias("action"), F.col("at").cast("timestamp").alias("at"))
            .filter(F.col("key").isNotNull() & F.col("at").isNotNull() & F.col("action").isin("add", "remove"))
            .groupBy("key", "at").agg(F.min("action").alias("action")))        # add wins at one time
    following = F.lead("at").over(Window.partitionBy("key").orderBy("at"))
    return rows.select("key", F.col("at").alias("since"), following.alias("until"), "action").filter(
        "action = 'add'").drop("action")


def filter_captures(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched_at") -> DataFrame:
    """All columns of the captures, with blocked and blocked_by."""
    row, host, time = (fresh(captures, c) for c in ("row", "host", "time"))
    rows = captures.withColumn(host, host_of(F.col(url))).withColumn(time, F.col(fetched).cast("timestamp"))
    # Captures of one host and time get one verdict, so each is looked up once.
    asked = rows.filter(F.col(host).isNotNull() & F.col(time).isNotNull()).select(
        F.col(host).alias("host"), F.col(time).alias("time")).distinct()
    last = F.lit(captures.agg(F.max(F.col(fetched).cast("timestamp"))).first()[0]).cast("timestamp")    # the latest capture
    held = intervals(entries).withColumn("last", last)
    month = F.explode(F.sequence(F.trunc("since", "month"),
                                 F.trunc(F.least(F.coalesce("until", "last"), "last"), "month"),
                                 F.expr("interval 1 month")))
    held = held.filter("since <= last").select("key", "since", "until", month.alias("month"))
    looked = asked.select("host", "time", F.trunc("time", "month").alias("month"), F.explode(keys_of(F.col("host"))).alias("key"))
    hits = (looked.join(held, ["key", "month"])
            .filter((F.col("time") >= F.col("since")) & (F.col("until").isNull() | (F.col("time") < F.col("until"))))
            .groupBy("host", "time").agg(F.max(F.struct(F.length("key").alias("size"), "key")).alias(row)))
    hits = hits.select(F.col("host").alias(host), F.col("time").alias(time), F.col(f"{row}.key").alias(row))
    return rows.join(hits, [host, time], "left").select(
        *[F.col(f"`{c}`") for c in captures.columns if c not in ("blocked", "blocked_by")],
        F.col(row).isNotNull().alias("blocked"), F.col(row).alias("blocked_by"))


# --- the registered query's captures and list, derived from the pages --------

FIRST_DAY = "2024-01-01"
DAYS = 366


def _number(text: Column) -> Column:
    """The first 32 bits of md5, as a number."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def _day(text: Column, days: int = DAYS) -> Column:
    return F.date_add(F.to_date(F.lit(FIRST_DAY)), (_number(text) % days).cast("int"))


def captures_of(pages: DataFrame) -> DataFrame:
    """page_id, url and a fetch day drawn from both."""
    key = F.concat_ws("|", F.col("page_id").cast("string"), "url")
    return pages.select("page_id", "url", _day(key).alias("fetched_at"))


def list_of(pages: DataFrame) -> DataFrame:
    """Dated entries for a third of the pages' hosts and some of their
    domains: listed, taken off, and for half of them listed again."""
    hosts = pages.select(host_of(F.col("url")).alias("host")).filter(F.col("host").isNotNull()).distinct()
    domain = F.element_at(keys_of(F.col("host")), -1)
    keys = (hosts.filter(_number(F.col("host")) % 3 == 0).select(F.col("host").alias("key"))
            .unionAll(hosts.filter(_number(F.concat(F.lit("domain:"), "host")) % 20 == 0).select(
                domain.alias("key")))).distinct()
    start = _day(F.concat(F.lit("add:"), "key"), 200)
    off = F.date_add(start, (_number(F.concat(F.lit("off:"), "key")) % 100 + 1).cast("int"))
    again = F.date_add(off, (_number(F.concat(F.lit("again:"), "key")) % 50 + 1).cast("int"))
    steps = F.filter(F.array(
        F.struct(F.lit("add").alias("action"), start.alias("at")),
        F.struct(F.lit("remove").alias("action"), off.alias("at")),
        F.struct(F.lit("add").alias("action"),
                 F.when(_number(F.concat(F.lit("twice:"), "key")) % 2 == 0, again).alias("at"))),
        lambda s: s["at"].isNotNull())
    return keys.select("key", F.inline(steps))


def judge_pages(pages: DataFrame) -> DataFrame:
    judged = filter_captures(captures_of(pages), list_of(pages))
    return judged.select("page_id", F.col("fetched_at").cast("string").alias("fetched_on"), "blocked", "blocked_by")


SQL = r"""
WITH p AS (
  SELECT page_id, url,
    DATE '2024-01-01' + (('0x' || substr(md5(concat_ws('|', page_id::VARCHAR, url)), 1, 8))::BIGINT % 366)::INTEGER AS day,
    nullif(rtrim(lower(regexp_extract(url, '^[\x00-\x20]*(?:[A-Za-z][A-Za-z0-9+.-]*:)?[/\\]{2,}(?:[^/\\?#]*@)?(\[[^\]/\\?#]*\]|[^/\\?#:]+)', 1)), '.'), '') AS host
  FROM pages),
h AS (SELECT DISTINCT host, string_split(host, '.') AS parts FROM p WHERE host IS NOT NULL),
k AS (
  SELECT host AS key FROM h WHERE ('0x' || substr(md5(host), 1, 8))::BIGINT % 3 = 0
  UNION
  SELECT array_to_string(parts[greatest(len(parts) - 1, 1):], '.') FROM h
  WHERE ('0x' || substr(md5('domain:' || host), 1, 8))::BIGINT % 20 = 0),
a AS (
  SELECT key, DATE '2024-01-01' + (('0x' || substr(md5('add:' || key), 1, 8))::BIGINT % 200)::INTEGER AS start,
    (('0x' || substr(md5('off:' || key), 1, 8))::BIGINT % 100 + 1)::INTEGER AS hold,
    (('0x' || substr(md5('again:' || key), 1, 8))::BIGINT % 50 + 1)::INTEGER AS pause,
    ('0x' || substr(md5('twice:' || key), 1, 8))::BIGINT % 2 = 0 AS twice FROM k),
i AS (
  SELECT key, start AS since, start + hold AS until FROM a
  UNION ALL SELECT key, start + hold + pause, NULL FROM a WHERE twice),
c AS (
  SELECT host, array_to_string(parts[j:], '.') AS key
  FROM (SELECT host, parts, unnest(range(1, greatest(len(parts) - 1, 1) + 1)) AS j FROM h)),
b AS (
  SELECT p.host, p.day, arg_max(c.key, length(c.key)) AS key
  FROM (SELECT DISTINCT host, day FROM p) p JOIN c USING (host)
  JOIN i ON i.key = c.key AND p.day >= i.since AND (i.until IS NULL OR p.day < i.until)
  GROUP BY p.host, p.day)
SELECT page_id, p.day::DATE::VARCHAR AS fetched_on, b.key IS NOT NULL AS blocked, b.key AS blocked_by
FROM p LEFT JOIN b ON p.host = b.host AND p.day = b.day"""
