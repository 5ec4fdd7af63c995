"""Lists as of the fetch time, against a direct reading of the log."""

import random
from datetime import datetime, timedelta
from urllib.parse import urlsplit

from waybill.llm import urls

START = datetime(2024, 1, 1)


def judged(url, t, log):
    parts = urlsplit((url or "").strip())
    host = (parts.hostname or "").rstrip(".")
    if not host or t is None:
        return "unlisted"
    path = parts.path or "/"
    state = {}
    for e in sorted(log, key=lambda e: (e[4], e[5] == "remove")):
        if None not in e and e[4] <= t:
            state[e[:4]] = e[5]
    best = None
    for (name, action, kind, pattern), op in state.items():
        if op == "remove":
            continue
        named = {
            "domain": host == pattern or host.endswith("." + pattern), "host": host == pattern,
            "prefix": (host + path).startswith(pattern) and (pattern.endswith("/") or host + path == pattern),
            "url": host + path + (f"?{parts.query}" if parts.query else "") == pattern,
        }[kind]
        if named:
            size = {"domain": len(pattern.split(".")), "prefix": len(pattern.split("/"))}.get(kind, 0)
            rank = (urls.KINDS.index(kind), size, action == "block")
            best = max(best, (rank, action)) if best else (rank, action)
    return best[1] if best else "unlisted"


def test_against_the_log(spark):
    rng = random.Random(4)
    hosts = ["a.example.com", "b.example.com", "example.com", "x.y.example.org", "other.net"]
    patterns = [("domain", "example.com"), ("domain", "org"), ("host", "a.example.com"), ("host", "other.net"),
                ("prefix", "a.example.com/en/"), ("prefix", "a.example.com/en/deep/"), ("prefix", "other.net/"),
                ("url", "other.net/en/x?q=1"), ("url", "b.example.com/")]
    log = [
        ("l", rng.choice(["allow", "block"]), *rng.choice(patterns), START + timedelta(days=rng.randrange(200)),
         rng.choice(["add", "add", "remove"])) for _ in range(60)
    ]
    log += [log[0], ("l", "block", "host", None, START, "add")]
    captures = []
    for i in range(400):
        url = f"{rng.choice(['http', 'https'])}://{rng.choice(hosts).upper() if i % 9 == 0 else rng.choice(hosts)}" + \
            rng.choice(["", "/", "/en/x?q=1", "/en/deep/y", "/fr#top", ":8080/en/"])
        captures.append((i, url, START + timedelta(days=rng.randrange(300), hours=rng.randrange(24))))
    captures += [(900, None, START), (901, "no url", START), (902, "http://other.net/", None), captures[0], captures[0],
                 (None, captures[1][1], captures[1][2]), (903, "http://other.net" + "/x" * 5000, START + timedelta(days=250))]
    table = spark.createDataFrame([(*c, "z") for c in captures], "page_id long, url string, fetched_at timestamp, host string")
    entries = spark.createDataFrame(log, "list string, action string, kind string, pattern string, at timestamp, op string")
    got = sorted(((r["page_id"], r["url"], r["verdict"]) for r in urls.evaluate(table, entries).collect()), key=repr)
    assert got == sorted(((i, u, judged(u, t, log)) for i, u, t in captures), key=repr)
    assert {v for *_, v in got} == {"allow", "block", "unlisted"}
    assert {r["verdict"] for r in urls.evaluate(table, entries.limit(0)).collect()} == {"unlisted"}
    assert urls.evaluate(table.limit(0), entries).count() == 0
