import random
from datetime import datetime, timedelta

import pytest

from sluice.llm import url_filter as uf

CAPTURES = "page_id long, url string, fetched_at timestamp_ntz, verdict_note string"
ENTRIES = "list_name string, kind string, value string, action string, effective_at timestamp_ntz"
DAY0 = datetime(2024, 1, 1)


def host_path(url):
    rest = url.split("://", 1)[1]
    head, _, _ = rest.partition("#")
    head, _, _ = head.partition("?")
    place, slash, path = head.partition("/")
    return place.rpartition("@")[2].split(":")[0].lower().rstrip("."), slash + path


def brute(captures, entries):
    dated = {}
    for name, kind, value, action, at in entries:
        if None not in (name, kind, value, action, at) and kind in ("host", "domain", "prefix") and action in ("block", "lift"):
            value = value.rstrip("/") if kind == "prefix" else value.lower().rstrip(".")
            key = (name, kind, value)
            dated.setdefault(key, {})[at] = dated.get(key, {}).get(at, False) or action == "block"
    out = []
    for page, url, at, _ in captures:
        hits = []
        if url and "://" in url and at and (place := host_path(url))[0]:
            host, path = place
            for (name, kind, value), times in dated.items():
                matches = {
                    "host": host == value,
                    "domain": host == value or host.endswith("." + value),
                    "prefix": host + path == value or (host + path).startswith(value + "/"),
                }[kind]
                past = [t for t in times if t <= at]
                if matches and past and times[max(past)]:
                    hits.append(({"prefix": 3, "host": 2, "domain": 1}[kind], len(value), name, kind, value, max(past)))
        out.append((page, url, at, *(max(hits)[2:] if hits else (None,) * 4)))
    return sorted(out, key=repr)


def got(df):
    return sorted(
        ((r.page_id, r.url, r.fetched_at, *(r.verdict or (None,) * 4)) for r in df.collect()), key=repr
    )


def some(seed, n):
    r = random.Random(seed)
    hosts = ["a.example.com", "www.a.example.com", "b.org", "x.b.org", "hot.net"]
    values = ["example.com", "a.example.com", "b.org", "org", "hot.net", "hot.net/en", "hot.net/en/x/", "b.org/en", "A.example.com."]
    captures = [
        (i, f"https://{r.choice(hosts)}{r.choice(['', '/', '/en', '/en/x', '/en/x/y?q#f', '/english'])}",
         DAY0 + timedelta(hours=r.randint(0, 9000)), "n") for i in range(n)
    ]
    entries = [
        (r.choice(["one", "two"]), r.choice(["host", "domain", "prefix"]), r.choice(values), r.choice(["block", "lift"]),
         DAY0 + timedelta(hours=r.randint(-2000, 9500))) for _ in range(n)
    ]
    return captures, entries


@pytest.mark.parametrize("rows", [0, 200_000])
def test_random_lists_match_brute_force(spark, monkeypatch, rows):
    monkeypatch.setattr(uf, "BROADCAST_ROWS", rows)
    captures, entries = some(rows + 1, 150)
    frames = spark.createDataFrame(captures, CAPTURES), spark.createDataFrame(entries, ENTRIES)
    assert got(uf.filter_urls(spark, *frames)) == brute(captures, entries)


def test_odd_rows(spark):
    captures = [
        (1, None, DAY0, None), (2, "no url", DAY0, None), (3, "http://", DAY0, None), (4, "http://u:p@HOT.net.:80/en/x", DAY0, None),
        (5, "http://hot.net", None, None), (6, "http://" + "a." * 5000 + "hot.net/", DAY0, None), (7, "http://hot.net/" + "x/" * 5000, DAY0, None),
        (8, "http://hot.net/", DAY0, None), (8, "http://hot.net/", DAY0, None), (None, "http://hot.net/", DAY0, None),
    ]
    entries = [
        ("l", "host", "hot.net", "block", DAY0), ("l", "host", "hot.net", "block", DAY0), ("l", "host", "hot.net", "lift", DAY0),
        ("l", "domain", None, "block", DAY0), (None, "host", "hot.net", "block", DAY0), ("l", "regex", ".*", "block", DAY0),
        ("l", "prefix", "hot.net/x", "block", DAY0), ("l", "host", "hot.net", "pause", DAY0),
    ]
    frames = spark.createDataFrame(captures, CAPTURES), spark.createDataFrame(entries, ENTRIES)
    df = uf.filter_urls(spark, *frames)
    assert df.columns == ["page_id", "url", "fetched_at", "verdict_note", "verdict"]
    assert got(df) == brute(captures, entries)
    assert uf.filter_urls(spark, frames[0].limit(0), frames[1]).count() == 0
    assert uf.filter_urls(spark, frames[0], frames[1].limit(0)).filter("verdict is not null").count() == 0


def test_intervals_across_buckets(spark):
    days = [0, 1, 29, 30, 95, 400]
    rows = [("l", "host", "h", "block" if i % 2 == 0 else "lift", DAY0 + timedelta(days=d)) for i, d in enumerate(days)]
    found = sorted((r.since, r.until) for r in uf.intervals(spark.createDataFrame(rows, ENTRIES)).collect())
    at = [DAY0 + timedelta(days=d) for d in days]
    assert found == [(at[0], at[1]), (at[2], at[3]), (at[4], at[5])]


def test_a_column_called_verdict_gives_way(spark):
    captures = spark.createDataFrame([(1, "http://a.b/x", DAY0, "mine")], CAPTURES).withColumnRenamed("verdict_note", "Verdict")
    entries = spark.createDataFrame([("l", "host", "a.b", "block", DAY0)], ENTRIES)
    found = uf.filter_urls(spark, captures, entries)
    assert found.columns == ["page_id", "url", "fetched_at", "verdict"]
    assert found.first().verdict.value == "a.b"
