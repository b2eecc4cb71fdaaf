import random
from urllib.parse import urlsplit

import pytest
from local import frame

from lapsewise.llm import url_filters

ENTRY_DDL = "list_name string, verdict string, kind string, pattern string, action string, effective_at bigint"
CAPTURE_DDL = "page_id bigint, url string, fetched_at bigint, key string, span bigint"


def host(url):
    if url is None or "://" not in url:
        return None
    name = urlsplit(url).hostname or ""
    return name.removesuffix(".") or None


def matches(kind, pattern, url):
    name, path = host(url), urlsplit(url).path or "/"
    if kind == "host":
        return name == pattern.lower()
    if kind == "domain":
        return name == pattern.lower() or name.endswith("." + pattern.lower())
    full = name + path
    return full == pattern or pattern.endswith("/") and full.startswith(pattern)


def plain(captures, entries):
    """Every capture against every entry: the last one of a list and pattern decides."""
    out = []
    for page, url, at in captures:
        state = {}
        if host(url) and at is not None:
            for e in sorted((e for e in entries if None not in e), key=lambda e: (e[5], e[4] != "add")):
                if e[5] <= at and matches(e[2], e[3], url):
                    pattern = e[3] if e[2] == "prefix" else e[3].lower()
                    state[e[0], e[1], f"{e[2]}:{pattern}"] = e[4] == "add"
        held = [k for k, on in state.items() if on]
        verdicts = {v for _, v, _ in held}
        listed = ";".join(sorted({f"{n}|{k}" for n, _, k in held}))
        out.append((page, host(url), at, verdicts == {"block"}, listed))
    return sorted(out, key=str)


def check(spark, captures, entries, **options):
    made = frame(spark, [(*c, "k", 0) for c in captures], CAPTURE_DDL)
    got = url_filters.judge(made, frame(spark, entries, ENTRY_DDL), "page_id", **options)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(captures, entries)


URLS = [
    "http://a.example.org/en/1?q=x",
    "https://user@A.Example.org:8080/en/",
    "https://b.a.example.org",
    "http://example.org./x/y/z#top",
    "http://org/",
    "ftp://other.net/en/1",
    "http:///nohost",
    "nonsense",
    "",
    None,
]
PATTERNS = [
    ("host", "a.example.org"),
    ("host", "A.EXAMPLE.ORG"),
    ("domain", "example.org"),
    ("domain", "org"),
    ("domain", "ple.org"),
    ("prefix", "a.example.org/en/"),
    ("prefix", "a.example.org/en/1"),
    ("prefix", "example.org/x/"),
    ("prefix", "a.example.org/e"),
]


@pytest.mark.parametrize("busy", [0, 2, 100])
def test_random_histories(spark, busy):
    draw = random.Random(busy)
    entries = [
        (draw.choice("mn"), draw.choice(["block", "block", "allow"]), *draw.choice(PATTERNS), draw.choice(["add", "remove"]), draw.randint(0, 60))
        for _ in range(150)
    ]
    entries += entries[:20] + [(None, "block", "host", "a.example.org", "add", 1), ("m", "block", "host", None, "add", 1), ("m", "block", "host", "org", "add", None)]
    captures = [(i, draw.choice(URLS), draw.choice([None, *range(-5, 70)])) for i in range(200)]
    check(spark, captures + captures[:5] + [(None, URLS[0], 30)], entries, busy=busy, span=7)


def test_ends_of_an_interval(spark):
    entry = ("m", "block", "host", "org")
    dated = [(*entry, "add", 10), (*entry, "add", 12), (*entry, "remove", 20), (*entry, "add", 30), (*entry, "remove", 30)]
    check(spark, [(t, "http://org/", t) for t in (9, 10, 19, 20, 29, 30, 31)], dated)


def test_empty_tables(spark):
    entry = ("m", "block", "host", "org", "add", 1)
    check(spark, [], [entry])
    check(spark, [(1, "http://org/", 5), (1, "http://org/", 5)], [])
    check(spark, [(1, "http://org/", None)], [entry], busy=0)


def test_long_url(spark):
    url = "http://" + "a." * 50 + "org/" + "x/" * 500 + "end"
    check(spark, [(1, url, 5)], [("m", "block", "prefix", url[7:-3], "add", 1), ("n", "block", "domain", "a.org", "add", 1)])


def test_very_long_urls(spark):
    """The cost of a URL follows its length and the depths that patterns have."""
    steps = "x/" * 40_000
    labels = "b." * 20_000 + "org"
    urls = [f"http://a.org/{steps}end", f"http://{labels}/", f"http://a.org/{steps}"]
    entries = [
        ("m", "block", "prefix", "a.org/x/", "add", 1),
        ("m", "block", "prefix", f"a.org/{steps}", "add", 1),
        ("m", "block", "prefix", f"a.org/{steps}x/", "add", 1),
        ("n", "block", "domain", "b.b.org", "add", 1),
        ("n", "block", "domain", labels[2:], "add", 1),
        ("n", "block", "domain", "c.org", "add", 1),
    ]
    check(spark, [(i, url, 5) for i, url in enumerate(urls)], entries)
