import datetime as dt

from poolwright.llm import url_lists as m
from tests.llm import hard  # noqa: F401


def day(n):
    return dt.date(2024, 1, n)


EVENTS = [
    ("l", "bad.org", day(3), "add"), ("l", "bad.org", day(6), "remove"), ("l", "bad.org", day(9), "add"), ("l", "bad.org", day(3), "add"),
    ("l", "x.com/ads", day(2), "ADD"), ("k", "A.bad.org", day(1), "add"), ("l", "same.net", day(4), "add"), ("l", "same.net", day(4), "remove"),
    ("l", None, day(1), "add"), ("l", "later.net", None, "add"), ("l", "odd.net", day(1), "look"), ("l", "never.net", day(2), "remove"),
]


def active(entry, when):
    """Lists that hold an entry on a day, by going through their events."""
    out = 0
    for name in {e[0] for e in EVENTS}:
        held = False
        for _, e, d, action in sorted((x for x in EVENTS if x[0] == name and x[1] and x[2]), key=lambda x: (x[2], x[3].lower() == "remove")):
            if e.lower() == entry and d <= when and action.lower() in ("add", "remove"):
                held = action.lower() == "add"
        out += held
    return out


URLS = {
    "http://bad.org/": ["bad.org", "org"], "https://A.Bad.ORG:8080/p?q#f": ["a.bad.org", "bad.org", "org", "a.bad.org/p"],
    "http://u@x.com/ads/1/": ["x.com", "com", "x.com/ads", "x.com/ads/1"], "http://x.com/adsense": ["x.com", "com", "x.com/adsense"],
    "http://same.net": ["same.net", "net"], "http://never.net": ["never.net", "net"], "http://odd.net./": ["odd.net", "net"], "no url": [], "": [], None: [],
}


def test_captures_against_the_entries_active_then(spark):
    rows = [(i, url, when) for i, url in enumerate(URLS) for when in [*map(day, range(1, 12)), None]]
    captures = spark.createDataFrame(rows + rows[:5], "capture_id long, url string, fetched date")
    events = spark.createDataFrame(EVENTS, "list_name string, entry string, day date, action string")
    got = m.filter_captures(captures, events).collect()
    assert len(got) == len(rows) + 5
    for r in got:
        wanted = sum(active(k, r.fetched) for k in URLS[r.url]) if r.fetched else 0
        assert (r.n_entries, r.kept) == (wanted, wanted == 0), r
        assert r.first_entry is None or r.first_entry in URLS[r.url]


def test_keys(spark):
    df = spark.createDataFrame([(u,) for u in URLS], "url string")
    for r in df.select("url", m.url_keys(df["url"]).alias("k")).collect():
        assert sorted(r.k or []) == sorted(URLS[r.url])


def test_intervals(spark):
    events = spark.createDataFrame(EVENTS, "list_name string, entry string, day date, action string")
    got = {(r.entry, r.valid_from, r.valid_to) for r in m.intervals(events).collect()}
    assert got == {("bad.org", day(3), day(6)), ("bad.org", day(9), None), ("x.com/ads", day(2), None), ("a.bad.org", day(1), None)}


def test_paths_keep_their_case(spark):
    captures = spark.createDataFrame(
        [(1, "http://X.com/Folder/x", day(5)), (2, "http://x.com/folder/x", day(5)), (3, "http://x.com/Folder", day(1))], "capture_id long, url string, fetched date")
    events = spark.createDataFrame([("l", "X.COM/Folder", day(2), "add")], "list_name string, entry string, day date, action string")
    got = {r.capture_id: (r.first_entry, r.kept) for r in m.filter_captures(captures, events).collect()}
    assert got == {1: ("x.com/Folder", False), 2: (None, True), 3: (None, True)}


def test_hard_pages(spark):
    rows = [(None, None, None, 1), (1, "http://a.b/c", "x", 2), (1, "http://a.b/c", "x", 2), (2, None, "", 3), (3, "http://" + "a." * 3000 + "b/", None, 4)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, entry int")
    got = m.filter_pages(pages).collect()
    assert len(got) == 5 and all(r.kept or r.first_entry for r in got)
    assert m.filter_pages(pages.filter("false")).collect() == []
