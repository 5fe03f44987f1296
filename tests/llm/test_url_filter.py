"""URL filters against a loop over all entries."""

import datetime as dt
import random

from daybook.llm import url_filter

DAY = dt.datetime(2024, 1, 1)


def at(hours):
    return DAY + dt.timedelta(hours=hours)


def brute(captures, changes):
    first = {}
    for list_, target, when, action in changes:
        if None not in (list_, target, when, action) and action in ("add", "remove"):
            key = list_, target, when
            first[key] = max(action, first.get(key, ""))
    by = {}
    for (list_, target, when), action in sorted(first.items()):
        by.setdefault((list_, target), []).append((when, action))
    out = []
    for i, url, when in captures:
        rest = (url or "").partition("://")[2] if "://" in (url or "") else ""
        authority = rest.replace("?", "/").replace("#", "/").split("/")[0]
        host = authority.rpartition("@")[2]
        name, colon, port = host.rpartition(":")
        host = (name if colon and (port.isdigit() or not port) else host).lower()
        host = host[:-1] if host.endswith(".") else host
        path = rest[len(authority):]
        section = path[1:].replace("?", "/").replace("#", "/").split("/")[0] if path.startswith("/") else ""
        targets = {host[k + 1:] for k in range(-1, len(host)) if k < 0 or host[k] == "."} if host else set()
        targets |= {f"{host}/{section}"} if host and section else set()
        active = set()
        for (list_, target), steps in by.items():
            state = None
            for moment, action in steps:
                if when is not None and moment <= when:
                    state = action
            if target in targets and state == "add":
                active.add((list_, target))
        best = max(active, key=lambda e: (len(e[1]), e[0] == "allow", e[1], e[0]), default=None)
        out.append((i, url, when, host, sorted(f"{a}:{b}" for a, b in active),
                    best and best[1], best[0] if best else "none"))
    return sorted(out, key=str)


URLS = ["http://a.b.example.com/news/1?x#y", "https://USER:pw@A.B.Example.com.:8080", "ftp://c.d/x", "nonsense", "",
        None, "http:///no-host", "http://b.example.com?q=/a", "http://c.d/x/" + "y/" * 5000, "http://localhost/a"]
TARGETS = ["example.com", "b.example.com", "a.b.example.com/news", "c.d/x", "com", "localhost", "x.y", None]


def run(spark, captures, changes):
    frame = spark.createDataFrame([(*c, "none", 1) for c in captures],
                                  "page_id long, url string, fetched_at timestamp, verdict string, row int")
    lists = spark.createDataFrame([(*c, 2) for c in changes],
                                  "list string, target string, at timestamp, action string, page_id int")
    found = url_filter.filter_captures(frame, lists).collect()
    return sorted((tuple(r) for r in found), key=str)


def test_against_all_entries(spark):
    rng = random.Random(1)
    captures = [(i, rng.choice(URLS), at(rng.randint(0, 240))) for i in range(200)]
    captures += [(None, URLS[0], at(5)), (None, URLS[0], at(5)), (1, URLS[0], None)]
    changes = [(rng.choice(["allow", "block", "other"]), rng.choice(TARGETS), at(rng.randint(0, 240)),
                rng.choice(["add", "add", "remove", "noise", None])) for _ in range(300)]
    changes += changes[:20] + [("block", "c.d/x", None, "add"), (None, "c.d/x", at(0), "add")]
    assert run(spark, captures, changes) == brute(captures, changes)


def test_interval_ends_are_open_and_ties_remove(spark):
    changes = [("block", "c.d", at(10), "add"), ("block", "c.d", at(20), "remove"),
               ("block", "c.d", at(30), "add"), ("block", "c.d", at(30), "remove"), ("allow", "c.d", at(40), "add")]
    captures = [(h, "ftp://c.d/x", at(h)) for h in (9, 10, 19, 20, 30, 31, 40, 500)]
    verdicts = {r[0]: r[6] for r in run(spark, captures, changes)}
    assert verdicts == {9: "none", 10: "block", 19: "block", 20: "none", 30: "none", 31: "none", 40: "allow", 500: "allow"}


def test_empty_tables(spark):
    assert run(spark, [], [("block", "c.d", at(0), "add")]) == []
    assert [r[6] for r in run(spark, [(1, "ftp://c.d/x", at(0))], [])] == ["none"]
