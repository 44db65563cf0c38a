"""URL filters over time (operator 6): DataFrame and SQL functions only.

List entries are dated: ``(pattern, action, day)`` says that from that day on
the pattern is blocked or allowed again.  ``lead`` turns the entries of a
pattern into validity intervals, and every capture is joined with the
intervals that were valid when it was fetched.

Patterns are hosts (which cover their subdomains, a top-level domain all of
its hosts) or host/path prefixes, brought to one spelling first.  So a capture
meets a bounded set of keys: its host and parent domains, and its path's
leading segments, as deep as the deepest entry.  Both sides of the equi-join also carry a time
bucket: intervals are cut into buckets, and a capture only meets the intervals
of its own.  A hot host is a hot key of the captures alone, whose rows any
skewed join partition can split; nothing is gathered by host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vqaspark.functions.hashing import shuffle_key

BUCKET_DAYS = 64
FIRST_DAY, LAST_DAY = 19000, 19999       # days since 1970 that the derived lists and captures cover
MAX_LABELS = 6                           # domain labels and
MAX_SEGMENTS = 3                         # path segments of the derived list's patterns (a caller's may have any number)

HOST = "(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
DOTS = "^\\.+|\\.+$"
PATH = "(?i)^[a-z][a-z0-9+.-]*://[^/?#]*([^?#]*)"


def normal(pattern: Column) -> Column:
    """One spelling of a pattern: host in lower case without dots at its ends,
    path without empty segments or a closing slash (its case counts); null for
    a pattern without a host."""
    parts = F.split(pattern, "/")
    host = F.regexp_replace(F.lower(F.trim(parts[0])), DOTS, "")
    path = F.filter(F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1))), lambda s: s != "")
    return F.when(host != "", F.array_join(F.concat(F.array(host), path), "/"))


def intervals(entries: DataFrame) -> DataFrame:
    """(pattern, action, valid_from, valid_to): entries of a pattern by day;
    each holds until the day before the next, the last for good (null).

    Entries with a null pattern, action or day, or without a host, say nothing.
    Entries that differ in spelling alone (``normal``) are of one pattern; of
    several on one day, ``block`` wins over anything else."""
    one = (entries.withColumn("pattern", normal(F.col("pattern"))).where("pattern is not null and action is not null and day is not null")
           .groupBy("pattern", "day").agg(F.max(F.col("action") == "block").alias("b")))
    nxt = F.lead("day").over(Window.partitionBy("pattern").orderBy("day"))
    return one.select("pattern", F.when(F.col("b"), "block").otherwise("allow").alias("action"),
                      F.col("day").alias("valid_from"), nxt.alias("valid_to"))


def host_of(url: Column) -> Column:
    return F.regexp_replace(F.lower(F.regexp_extract(url, HOST, 1)), DOTS, "")


def depth_of(entries: DataFrame) -> tuple[int, int]:
    """Most domain labels and most path segments of any pattern."""
    parts = F.split(normal(F.col("pattern")), "/")
    d = entries.agg(F.max(F.size(F.split(parts[0], "\\."))).alias("n"), F.max(F.size(parts) - 1).alias("m")).first()
    return max(d["n"] or 0, 1), max(d["m"] or 0, 0)


def keys_of(url: Column, max_labels: int, max_segments: int) -> Column:
    """Patterns of up to so many labels and path segments that cover a URL: its
    host, all its parent domains, and its host with leading path segments.  With the depth of a list, these are all that the list can have."""
    host = host_of(url)
    labels = F.split(host, "\\.")
    n = F.size(labels)
    domains = F.transform(F.sequence(F.greatest(n - F.lit(max_labels), F.lit(0)), F.greatest(n - 1, F.lit(0))),
                          lambda i: F.array_join(F.slice(labels, i + 1, F.greatest(n - i, F.lit(1))), "."))
    segments = F.filter(F.split(F.regexp_extract(url, PATH, 1), "/"), lambda s: s != "")
    paths = F.transform(F.sequence(F.lit(0), F.least(F.size(segments), F.lit(max_segments))),
                        lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(segments, 1, i), "/")))
    paths = F.filter(paths, lambda p: ~p.endswith("/"))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(
        F.array_distinct(F.concat(F.filter(domains, lambda d: d != ""), paths)))


def filter_urls(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url",
                day_col: str = "fetch_day", bucket_days: int = BUCKET_DAYS) -> DataFrame:
    """One row per capture row: id, url, day, ``n_active`` (patterns with an entry in
    force), ``n_block``, ``rule`` (the deciding pattern) and ``blocked``.

    The most specific active pattern decides (longest; ties: smallest name).
    Null or malformed URLs and null days meet no entry: 0, null, false.  Rows that
    repeat an id with the same url and day each get the same result; an empty
    list blocks nothing; other columns are not read.  Keys go as deep as the
    entries do and both sides are spelled alike, so no entry is out of reach of a
    long host or path, another case, or a closing dot or slash."""
    c = captures.select(F.col(id_col).alias("id"), F.col(url_col).alias("u"), F.col(day_col).cast("int").alias("t"))
    # A capture of one url and day is looked up once, however often it was crawled.
    distinct = c.where("u is not null and t is not null").select("u", "t").distinct()
    looked = (distinct.withColumn("pattern", F.explode(keys_of(F.col("u"), *depth_of(entries))))
              .withColumn("bucket", F.floor(F.col("t") / bucket_days)))
    end = captures.agg(F.max(F.col(day_col).cast("int")).alias("end")).first()["end"]
    end = F.lit(-1 if end is None else end)          # open intervals need no buckets after the last capture
    iv = (intervals(entries)
          .withColumn("to", F.coalesce("valid_to", F.greatest(end + 1, F.col("valid_from") + 1)))
          .withColumn("bucket", F.explode(F.sequence(F.floor(F.col("valid_from") / bucket_days),
                                                     F.floor((F.col("to") - 1) / bucket_days)))))
    hit = (looked.join(iv.select("pattern", "bucket", "action", "valid_from", "to"), ["pattern", "bucket"])
           .where("valid_from <= t and t < to"))
    best = F.max_by(F.struct("pattern", "action"), F.struct(F.length("pattern"), _reverse(F.col("pattern"))))
    found = hit.groupBy("u", "t").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("action") == "block").cast("long")).alias("b"),
                                      best.alias("best"))
    out = c.join(found, ["u", "t"], "left")
    return out.select(F.col("id").alias(id_col), F.col("u").alias(url_col), F.col("t").alias(day_col),
                      F.coalesce("n", F.lit(0)).cast("long").alias("n_active"), F.coalesce("b", F.lit(0)).cast("long").alias("n_block"),
                      F.col("best.pattern").alias("rule"), F.coalesce(F.col("best.action") == "block", F.lit(False)).alias("blocked"))


def _reverse(c: Column) -> Column:
    """Orders equally long strings the other way round (smallest name first)."""
    return F.transform(F.split(c, ""), lambda ch: -F.ascii(ch))


def day_of(key: Column, seed: int) -> Column:
    """A day between FIRST_DAY and LAST_DAY that depends on the key alone."""
    n = F.conv(F.substring(shuffle_key(key, seed), 1, 7), 16, 10).cast("long")
    return (F.lit(FIRST_DAY) + n % (LAST_DAY - FIRST_DAY + 1)).cast("int")


def derived_list(pages: DataFrame) -> DataFrame:
    """A dated list made from the hosts of the table: some hosts, parent
    domains and path prefixes are blocked on one day and allowed on another."""
    hosts = pages.where("url is not null").select(F.explode(keys_of(F.col("url"), MAX_LABELS, MAX_SEGMENTS)).alias("pattern")).distinct()
    pick = F.conv(F.substring(shuffle_key(F.col("pattern"), 1), 1, 7), 16, 10).cast("long") % 10
    some = hosts.withColumn("k", pick).where("k < 4")
    first = some.select("pattern", F.lit("block").alias("action"), day_of(F.col("pattern"), 2).alias("day"))
    # Another spelling, as lists by hand have: a host in capitals, a path with a closing slash.
    other = F.when(F.col("pattern").contains("/"), F.concat("pattern", F.lit("/"))).otherwise(F.upper("pattern"))
    then = some.where("k < 3").select(other.alias("pattern"), F.lit("allow").alias("action"), day_of(F.col("pattern"), 3).alias("day"))
    again = some.where("k < 1").select("pattern", F.lit("block").alias("action"), day_of(F.col("pattern"), 4).alias("day"))
    return first.unionByName(then).unionByName(again)


def captures_of(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", day_of(F.col("page_id"), 5).alias("fetch_day"))


def _sql_day(key: str, seed: int) -> str:
    n = f"cast('0x' || substr(md5('{seed}:' || cast({key} as varchar)), 1, 7) as bigint)"
    return f"cast({FIRST_DAY} + {n} % {LAST_DAY - FIRST_DAY + 1} as integer)"


_KEYS = f"""
select page_id, url, unnest(list_distinct(list_concat(
    list_filter(list_transform(range(greatest(n - {MAX_LABELS}, 0), greatest(n - 1, 0) + 1),
        lambda i: array_to_string(labels[i + 1:], '.')), lambda d: d <> ''),
    list_filter(list_transform(range(0, least(len(segments), {MAX_SEGMENTS}) + 1),
        lambda i: host || '/' || array_to_string(segments[1:i], '/')), lambda p: not ends_with(p, '/'))))) as pattern
from (select page_id, url, host, string_split(host, '.') as labels, len(string_split(host, '.')) as n,
             list_filter(string_split(regexp_extract(url, '{PATH}', 1), '/'), lambda s: s <> '') as segments
      from (select page_id, url, regexp_replace(lower(regexp_extract(url, '{HOST}', 1)), '{DOTS}', '', 'g') as host from pages) h where host <> '') x
"""

ORACLE = f"""
with k as ({_KEYS}),
picked as (select pattern, cast('0x' || substr(md5('1:' || pattern), 1, 7) as bigint) % 10 as k
           from (select distinct pattern from k) d),
entries as (
  select pattern, 'block' as action, {_sql_day('pattern', 2)} as day from picked where k < 4
  union all select case when contains(pattern, '/') then pattern || '/' else upper(pattern) end, 'allow',
                   {_sql_day('pattern', 3)} from picked where k < 3
  union all select pattern, 'block', {_sql_day('pattern', 4)} from picked where k < 1),
spelled as (select rtrim(case when contains(pattern, '/') then pattern else lower(pattern) end, '/') as pattern, action, day
            from entries),
one as (select pattern, day, case when bool_or(action = 'block') then 'block' else 'allow' end as action
        from spelled group by pattern, day),
iv as (select pattern, action, day as valid_from, lead(day) over (partition by pattern order by day) as valid_to from one),
c as (select page_id, url, {_sql_day('page_id', 5)} as fetch_day from pages),
hit as (select c.page_id, iv.pattern, iv.action,
               row_number() over (partition by c.page_id order by length(iv.pattern) desc, iv.pattern) as r
        from c join k on k.page_id = c.page_id
        join iv on iv.pattern = k.pattern and iv.valid_from <= c.fetch_day
               and (iv.valid_to is null or c.fetch_day < iv.valid_to)),
found as (select page_id, count(*) as n, sum(case when action = 'block' then 1 else 0 end) as b,
                 max(case when r = 1 then pattern end) as rule, bool_or(r = 1 and action = 'block') as blocked
          from hit group by page_id)
select c.page_id, c.url, c.fetch_day, cast(coalesce(n, 0) as bigint) as n_active, cast(coalesce(b, 0) as bigint) as n_block,
       rule, coalesce(blocked, false) as blocked
from c left join found on found.page_id = c.page_id
"""
