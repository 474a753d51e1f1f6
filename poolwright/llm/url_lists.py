"""URL filters by dated lists: which list entries were active when a page was fetched.

A list is a history of events (entry, action, day): an entry is added, removed, and
perhaps added again. Events become validity intervals, and an as-of join holds each
capture against the latest event at or before its fetch time, for every entry that can match
it: its host, each parent domain of the host, and the host with each leading part of the path.

Capture keys are few for each page, so the join is an equality on the entry plus the
interval; there is no pairing of all captures with all entries. Popular hosts are
no hot keys: captures are first reduced to different (key, day) pairs, and the answers
are joined back by that pair, where Spark can split what is still uneven.

Everything is DataFrame expressions. A null or malformed URL has no keys and is kept.
Events without an entry, day or known action are left out; of events of one
entry on one day a removal wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from poolwright.llm.common import column


def host_of(url: Column) -> Column:
    """Host in lower case without user, port or trailing dot; empty where there is none."""
    return F.regexp_replace(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]*)", 1)), r"\.+$", "")


def path_of(url: Column) -> Column:
    """Path without query and fragment."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)


def url_keys(url: Column) -> Column:
    """Entries that would match a URL: host, its parent domains, and host with leading folders or the whole path."""
    host = F.split(host_of(url), r"\.")
    folders = F.filter(F.split(path_of(url), "/"), lambda p: p != "")
    domains = F.transform(F.sequence(F.lit(1), F.size(host)), lambda i: F.array_join(F.slice(host, i, F.size(host)), "."))
    # a top-level domain alone is an entry too
    paths = F.transform(
        F.sequence(F.lit(1), F.size(folders)), lambda i: F.concat_ws("/", host_of(url), F.array_join(F.slice(folders, 1, i), "/")))
    found = F.when(F.size(folders) > 0, F.concat(domains, paths)).otherwise(domains)
    return F.when(host_of(url) != "", F.array_distinct(found)).otherwise(F.array().cast("array<string>"))


def entry_of(entry: Column) -> Column:
    """A list entry as a key: its host in lower case, its path as it is."""
    host = F.regexp_extract(entry, "^[^/]*", 0)
    return F.concat(F.lower(host), F.substr(entry, F.length(host) + 1))


def intervals(events: DataFrame) -> DataFrame:
    """Rows (list_name, entry, valid_from, valid_to): the spans in which an entry was on a list; open ends are null."""
    rows = events.select(
        F.coalesce(column(events, "list_name", "string"), F.lit("")).alias("list_name"), entry_of(column(events, "entry", "string")).alias("entry"),
        column(events, "day", "date").alias("day"), F.lower(column(events, "action", "string")).alias("action"))
    rows = rows.filter("entry is not null and entry <> '' and day is not null and action in ('add', 'remove')")
    daily = rows.groupBy("list_name", "entry", "day").agg(F.max((F.col("action") == "remove").cast("int")).alias("removed"))
    order = Window.partitionBy("list_name", "entry").orderBy("day")
    # an entry's history has one row a day at most
    changes = daily.withColumn("was", F.coalesce(F.lag("removed").over(order), F.lit(1))).filter("removed <> was")
    spans = changes.withColumn("valid_to", F.lead("day").over(order)).filter("removed = 0")
    return spans.select("list_name", "entry", F.col("day").alias("valid_from"), "valid_to")


def matches(captures: DataFrame, events: DataFrame) -> DataFrame:
    """Different (url_key, fetched, list_name) of captures whose key was listed when it was fetched.

    ``captures`` has the columns url and fetched (a date).
    """
    asked = captures.select(F.explode(url_keys(F.col("url"))).alias("url_key"), "fetched").filter("fetched is not null").distinct()
    spans = intervals(events)
    active = (F.col("valid_from") <= F.col("fetched")) & (F.col("valid_to").isNull() | (F.col("fetched") < F.col("valid_to")))
    return asked.join(spans, (F.col("url_key") == F.col("entry")) & active).select("url_key", "fetched", "list_name", "valid_from")


def filter_captures(captures: DataFrame, events: DataFrame) -> DataFrame:
    """Every capture with the entries that blocked it.

    Columns of ``captures``: capture_id, url, fetched. Returned: capture_id, url, host,
    fetched, n_entries (listed keys over all lists), first_entry (the one listed longest,
    of equals the first by name), kept.
    """
    found = matches(captures, events)
    answers = found.groupBy("url_key", "fetched").agg(
        F.count("*").alias("n"), F.min(F.struct("valid_from", "url_key")).alias("first"))
    urls = captures.select("url", "fetched").distinct()
    asked = urls.select("url", "fetched", F.explode(url_keys(F.col("url"))).alias("url_key")).filter("fetched is not null")
    hit = asked.join(answers, ["url_key", "fetched"]).groupBy("url", "fetched").agg(F.sum("n").alias("n_entries"), F.min("first").alias("first"))
    return captures.join(hit, ["url", "fetched"], "left").select(
        "capture_id", "url", host_of(F.col("url")).alias("host"), "fetched",
        F.coalesce("n_entries", F.lit(0)).alias("n_entries"), F.col("first.url_key").alias("first_entry"), F.col("n_entries").isNull().alias("kept"))


# --- the given tables as captures and list history -----------------------------


def _digit(text: Column, at: int) -> Column:
    """The number of two hexadecimal digits of a text's MD5."""
    return F.conv(F.substring(F.md5(text), at, 2), 16, 10).cast("int")


def page_captures(pages: DataFrame) -> DataFrame:
    """Pages as captures: the fetch day follows from the digest of the id (days of 2024)."""
    page = column(pages, "page_id", "long")
    return pages.select(
        page.alias("capture_id"), column(pages, "url", "string").alias("url"),
        F.date_add(F.lit("2024-01-01").cast("date"), _digit(page.cast("string"), 1)).alias("fetched"))


def page_list_events(pages: DataFrame) -> DataFrame:
    """A list history over the pages' hosts and folders, drawn by their digests.

    A quarter of the hosts, and a sixteenth of the first folders of a host, are added on one day;
    half of these are removed later, and half of those added again.
    """
    url = column(pages, "url", "string")
    host = host_of(url)
    folder = F.regexp_extract(path_of(url), "^/([^/]+)/", 1)
    hosts = pages.select(host.alias("entry"), F.lit(64).alias("below")).filter("entry <> ''")
    folders = pages.select(host.alias("h"), folder.alias("f")).filter("h <> '' and f <> ''").select(F.concat_ws("/", "h", "f").alias("entry"), F.lit(16).alias("below"))
    entries = hosts.union(folders).distinct()
    drawn = entries.filter(_digit(F.col("entry"), 1) < F.col("below"))
    start = F.date_add(F.lit("2024-01-01").cast("date"), _digit(F.col("entry"), 3))
    steps = F.array(
        F.struct(F.lit("add").alias("action"), start.alias("day"), F.lit(0).alias("need")),
        F.struct(F.lit("remove").alias("action"), F.date_add(start, 1 + _digit(F.col("entry"), 5)).alias("day"), F.lit(1).alias("need")),
        F.struct(F.lit("add").alias("action"), F.date_add(start, 257 + _digit(F.col("entry"), 7)).alias("day"), F.lit(2).alias("need")))
    events = drawn.select("entry", F.floor(_digit(F.col("entry"), 9) / 64).alias("kind"), F.inline(steps))
    # kind 0 and 1: stays; 2: removed; 3: removed and added again
    return events.filter(F.col("need") <= F.greatest(F.col("kind") - 1, F.lit(0))).select(F.lit("blocked").alias("list_name"), "entry", "day", "action")


def filter_pages(pages: DataFrame) -> DataFrame:
    """Every page against the list entries that were active on its fetch day."""
    found = filter_captures(page_captures(pages), page_list_events(pages))
    return found.withColumn("fetched", F.col("fetched").cast("string")).withColumnRenamed("capture_id", "page_id")


#: The same in SQL.
PAGES_SQL = r"""
with captures as (
  select page_id, url,
    date '2024-01-01' + cast(('0x' || substr(md5(cast(page_id as varchar)), 1, 2)) as integer) as fetched,
    regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]*)', 1)), '\.+$', '') as host,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)', 1) as path
  from pages
), parts as (
  select *, string_split(host, '.') as labels, list_filter(string_split(path, '/'), lambda x: x <> '') as folders from captures
), asked as (
  select distinct page_id, url, fetched, k from (
    select page_id, url, fetched, unnest(list_transform(range(1, len(labels) + 1), lambda i: array_to_string(labels[i:], '.'))) as k from parts where host <> ''
    union all
    select page_id, url, fetched, unnest(list_transform(range(1, len(folders) + 1), lambda i: host || '/' || array_to_string(folders[1:i], '/'))) as k from parts where host <> '' and len(folders) > 0
  )
), entries as (
  select host as entry, 64 as below from captures where host <> ''
  union
  select host || '/' || regexp_extract(path, '^/([^/]+)/', 1), 16 from captures where host <> '' and regexp_extract(path, '^/([^/]+)/', 1) <> ''
), drawn as (
  select entry, md5(entry) as m, date '2024-01-01' + cast(('0x' || substr(md5(entry), 3, 2)) as integer) as start,
    cast(('0x' || substr(md5(entry), 9, 2)) as integer) // 64 as kind
  from entries where cast(('0x' || substr(md5(entry), 1, 2)) as integer) < below
), spans as (
  select entry, start as valid_from,
    case when kind >= 2 then start + 1 + cast(('0x' || substr(m, 5, 2)) as integer) end as valid_to from drawn
  union all
  select entry, start + 257 + cast(('0x' || substr(m, 7, 2)) as integer), null from drawn where kind = 3
), hits as (
  select page_id, url, fetched, count(*) as n_entries, min({'f': valid_from, 'k': k}) as first
  from asked join spans on k = entry and valid_from <= fetched and (valid_to is null or fetched < valid_to)
  group by page_id, url, fetched
)
select c.page_id, c.url, coalesce(c.host, '') as host, cast(c.fetched as varchar) as fetched, coalesce(n_entries, 0) as n_entries, first.k as first_entry, n_entries is null as kept
from captures c left join hits h on c.page_id = h.page_id and c.url = h.url
"""
