"""URL filters: a temporal list join, in DataFrame operations only.

A block list is a log of dated entries: (pattern, category, action, effective_at),
where action is ``add`` or ``remove``.  The entries of one (pattern, category)
become validity intervals: an entry holds from its date until the next one.  An
as-of join then evaluates each capture against the entries active when it was
fetched.  A pattern is a domain, which covers its subdomains, or
``host/segment``, which covers the paths below that first segment.

Skew: intervals and captures meet on (pattern, time bucket), so the captures of a
hot host spread over the buckets, and what is still large is a plain sort-merge
join that adaptive execution splits.  Equal captures are counted before the
join.  The log is ordered within (pattern, category, bucket); only one summary
row a bucket is ordered across buckets.

Edge cases: a null url or one without a host matches nothing; a null fetch time
matches nothing; entries with a null pattern, category or date, or another
action, are ignored; at equal dates ``remove`` wins; repeated captures return
repeated rows and repeated entries change nothing; a date exactly at the fetch
time counts; empty tables give empty or unmatched results.  Extra columns of
either table are left out of the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import base

BUCKET = 30 * 86400

# A scheme and a host are the same in either case; a path is not
HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
SEGMENT = r"^(?i:[a-z][a-z0-9+.-]*)://[^/?#]+(/[^/?#]+)"


def host_of(url):
    return F.nullif(F.regexp_extract(F.lower(url), HOST, 1), F.lit(""))


def patterns_of(url):
    """Every pattern that would cover the url: its host, the host's parents of
    two labels or more, and host/segment."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    n = F.size(labels)
    parents = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.array_join(F.slice(labels, i, n), "."))
    path = F.concat(host, F.regexp_extract(url, SEGMENT, 1))
    return F.when(host.isNull(), F.array().cast("array<string>")).otherwise(F.array_distinct(F.concat(parents, F.array(path))))


def intervals(log: DataFrame, *, bucket: int = BUCKET) -> DataFrame:
    """(pattern, category, bucket, valid_from, valid_to): when each listing holds,
    cut at bucket borders; valid_to is exclusive and null if it is still open."""
    entries = (
        log.select("pattern", "category", F.col("effective_at").cast("long").alias("at"), F.col("action").alias("a"))
        .where("pattern is not null and category is not null and at is not null and a in ('add', 'remove')")
        .groupBy("pattern", "category", "at")
        .agg(F.min(F.col("a") == "add").alias("on"))
        .withColumn("b", F.floor(F.col("at") / bucket))
    )
    inside = Window.partitionBy("pattern", "category", "b").orderBy("at")
    across = Window.partitionBy("pattern", "category").orderBy("b")
    # One row a bucket: its first date, so the entry before it knows when it ends.
    first = entries.groupBy("pattern", "category", "b").agg(F.min("at").alias("first_at"))
    following = first.withColumn("after", F.lead("first_at").over(across)).select("pattern", "category", "b", "after")
    spans = (
        entries.withColumn("next_at", F.lead("at").over(inside))
        .join(following, ["pattern", "category", "b"])
        .select("pattern", "category", "on", F.col("at").alias("valid_from"), F.coalesce("next_at", "after").alias("valid_to"))
        .where("on")
    )
    return spans.select("pattern", "category", "valid_from", "valid_to")


def _cut(spans: DataFrame, last: int, bucket: int) -> DataFrame:
    """One row for each bucket that an interval touches, up to the last fetch."""
    low = F.floor(F.col("valid_from") / bucket)
    high = F.floor((F.coalesce(F.least("valid_to", F.lit(last + 1)), F.lit(last + 1)) - 1) / bucket)
    return spans.where(F.col("valid_from") <= last).select("*", F.explode(F.sequence(low, F.greatest(low, high))).alias("b"))


def evaluate(captures: DataFrame, log: DataFrame, *, key: str = "page_id", url: str = "url", at: str = "fetched_at", bucket: int = BUCKET) -> DataFrame:
    """key, url, fetch time, host, n_active (listings that hold), categories
    (sorted) and blocked, a row for each capture."""
    rows = captures.select(F.col(key).alias("k"), F.col(url).cast("string").alias("u"), F.col(at).cast("long").alias("t")).groupBy("k", "u", "t").agg(F.count("*").alias("copies"))
    last = captures.select(F.max(F.col(at).cast("long")).alias("m")).first()["m"]
    spans = _cut(intervals(log, bucket=bucket), 0 if last is None else last, bucket)
    wanted = rows.select("k", "u", "t", "copies", F.floor(F.col("t") / bucket).alias("b"), F.explode_outer(patterns_of(F.col("u"))).alias("pattern"))
    met = wanted.join(spans, (wanted.b == spans.b) & (wanted.pattern == spans.pattern) & (wanted.t >= spans.valid_from) & (spans.valid_to.isNull() | (wanted.t < spans.valid_to)), "left")
    out = met.groupBy("k", "u", "t", "copies").agg(F.count(spans.category).alias("n_active"), F.sort_array(F.collect_set(spans.category)).alias("categories"))
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(
        F.col("k").alias(key), F.col("u").alias(url), F.col("t").alias(at), host_of(F.col("u")).alias("host"), "n_active", "categories", (F.col("n_active") > 0).alias("blocked")
    )


# --- the registered query: dates and a list derived from the pages themselves ---

START, SPAN = 1_672_531_200, 63_072_000  # 2023-01-01 UTC, two years


def _hash(x, at: int = 1):
    return F.conv(F.substring(F.md5(x.cast("binary")), at, 8), 16, 10).cast("long")


def synthetic_log(pages: DataFrame) -> DataFrame:
    """Dated entries for the three-label domains and the host/segment pairs of
    the pages: some added, removed and added again."""
    url = F.col("url")
    host = host_of(url)
    domain = F.regexp_extract(host, r"([^.]+\.[^.]+\.[^.]+)$", 1)
    seg = F.concat(host, F.regexp_extract(url, SEGMENT, 1))
    names = pages.select(F.explode(F.array(domain, seg)).alias("pattern")).where("pattern != ''").groupBy("pattern").agg(F.lit(1).alias("x"))
    each = names.select("pattern", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("k")).withColumn("h", F.concat_ws(":", "pattern", "k"))
    return each.where(_hash(F.col("h"), 1) % 4 != 0).select(
        "pattern",
        F.element_at(F.array(F.lit("adult"), F.lit("malware"), F.lit("spam")), (_hash(F.col("h"), 9) % 3 + 1).cast("int")).alias("category"),
        F.when(_hash(F.col("h"), 17) % 5 < 3, "add").otherwise("remove").alias("action"),
        (F.lit(START) + _hash(F.col("h"), 25) % SPAN).alias("effective_at"),
    )


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = base.table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched_at", F.lit(START) + F.pmod(F.col("page_id") * 104729, F.lit(SPAN)))
    out = evaluate(captures, synthetic_log(pages))
    return out.withColumn("categories", F.concat_ws(",", "categories"))


OP5_SQL = r"""
with cap as (
  select page_id, url, 1672531200 + (page_id * 104729) % 63072000 as fetched_at,
    nullif(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1), '') as host,
    regexp_extract(url, '^(?i:[a-z][a-z0-9+.-]*)://[^/?#]+(/[^/?#]+)', 1) as seg
  from pages),
names as (
  select distinct pattern from (
    select regexp_extract(host, '([^.]+\.[^.]+\.[^.]+)$', 1) as pattern from cap
    union all select host || seg from cap) where pattern != ''),
each as (
  select pattern, md5(pattern || ':' || k) as m from names, (select unnest(range(5)) as k)),
log as (
  select pattern,
    ['adult', 'malware', 'spam'][cast(cast('0x' || substr(m, 9, 8) as bigint) % 3 + 1 as int)] as category,
    cast('0x' || substr(m, 17, 8) as bigint) % 5 < 3 as added,
    1672531200 + cast('0x' || substr(m, 25, 8) as bigint) % 63072000 as eff
  from each where cast('0x' || substr(m, 1, 8) as bigint) % 4 != 0),
dated as (select pattern, category, eff, bool_and(added) as added from log group by all),
spans as (
  select pattern, category, added, eff as valid_from,
    lead(eff) over (partition by pattern, category order by eff) as valid_to from dated),
hits as (
  select c.page_id, count(*) as n, string_agg(distinct category, ',' order by category) as categories
  from cap c join spans s on added and fetched_at >= valid_from and (valid_to is null or fetched_at < valid_to)
    and (host = pattern or ends_with(host, '.' || pattern) or host || seg = pattern)
  group by c.page_id)
select page_id, url, fetched_at, host, cast(coalesce(n, 0) as bigint) as n_active,
  coalesce(categories, '') as categories, coalesce(n, 0) > 0 as blocked
from cap left join hits using (page_id)
"""
