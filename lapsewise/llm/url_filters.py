"""URL filters from dated lists, by a temporal join.

A list changes over time: each entry adds or removes a pattern from a moment on.  Per
list and pattern the entries become validity intervals, and every capture of a URL is
judged by the intervals that hold its fetch time.  A pattern is a ``host`` (itself), a
``domain`` (itself and all below it) or a ``prefix`` (host and path up to a slash, or a
whole path).  A capture is blocked if some list that blocks holds it and none that
allows does.

A URL becomes the keys of all patterns that could name it, so that matching is an
equality join; keys that no list names go first.  The join adds the condition on time.
For a key with more than ``busy`` intervals the key is cut by ``span`` of time: its
intervals, which do not overlap within a list, are repeated for each span that they
touch, so that a capture meets the few of its own span and not the whole history.  Hot
keys on the side of the captures are split by adaptive execution; nothing is grouped by
key but the lists' own entries, once each by time.

Defined results: times are seconds since 1970; an interval holds its first second and
not its last; of entries of one list and pattern at one time a removal wins; repeated
entries change nothing; an entry without list, verdict, kind, pattern, action or time is
left out; a URL that is null or has no host, and a capture without a time, match nothing
and are not blocked; rows that repeat are judged alike; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapsewise.sources import stage

HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)"
PATH = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)"
ENTRY = ("list_name", "verdict", "kind", "pattern", "action", "effective_at")
FOREVER = (1 << 62) - 1


def host(url: str) -> Column:
    """Lower-case host without user, port or final dot; null if there is none."""
    found = F.regexp_replace(F.lower(F.regexp_extract(F.col(url), HOST, 1)), r"\.$", "")
    return F.when(found != "", found)


def _count(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def keys(url: str, steps: list[int], labels: list[int]) -> Column:
    """Every kind and pattern that names the URL, of domains of so many ``labels`` and
    prefixes of so many ``steps`` as patterns have."""

    def depths(numbers: list[int]) -> Column:
        return F.array(*(F.lit(n) for n in numbers)).cast("array<int>")

    def cut(text: Column, mark: str, n: Column) -> Column:
        return F.call_function("substring_index", text, F.lit(mark), n)

    def of(name: Column, path: Column) -> Column:
        domains = F.transform(
            F.filter(depths(labels), lambda n: n <= _count(name, ".") + 1),
            lambda n: F.concat(F.lit("domain:"), cut(name, ".", -n)),
        )
        prefixes = F.transform(
            F.filter(depths(steps), lambda n: n <= _count(path, "/")),
            lambda n: F.concat(F.lit("prefix:"), name, cut(path, "/", n), F.lit("/")),
        )
        whole = [F.concat(F.lit("host:"), name), F.concat(F.lit("prefix:"), name, path)]
        return F.array_distinct(F.concat(F.array(*whole), domains, prefixes))

    path = F.regexp_extract(F.col(url), PATH, 1)
    parts = F.array(F.struct(host(url).alias("name"), F.when(path == "", "/").otherwise(path).alias("path")))
    # Bound in an array of one, the parts of a URL are found once and not for each key.
    return F.flatten(F.transform(parts, lambda p: of(p["name"], p["path"])))


def intervals(entries: DataFrame) -> DataFrame:
    """(list_name, verdict, key, valid_from, valid_to), disjoint for each list and key."""
    pattern = F.when(F.col("kind") == "prefix", F.col("pattern")).otherwise(F.lower("pattern"))
    dated = (
        entries.select(*ENTRY)
        .dropna()
        .groupBy("list_name", "verdict", F.concat("kind", F.lit(":"), pattern).alias("key"), "effective_at")
        .agg(F.min((F.col("action") == "add").cast("int")).alias("on"))
    )
    order = Window.partitionBy("list_name", "verdict", "key").orderBy("effective_at")
    changes = dated.withColumn("was", F.coalesce(F.lag("on").over(order), F.lit(0))).where("on <> was")
    until = F.coalesce(F.lead("effective_at").over(order), F.lit(FOREVER))
    ended = changes.withColumn("valid_to", until).where("on = 1")
    return ended.select("list_name", "verdict", "key", F.col("effective_at").alias("valid_from"), "valid_to")


def judge(
    captures: DataFrame,
    entries: DataFrame,
    capture_id: str,
    url: str = "url",
    fetched_at: str = "fetched_at",
    busy: int = 16,
    span: int = 30 * 86_400,
) -> DataFrame:
    """Capture id, host, fetched_at, blocked and matches (``list|kind:pattern``, sorted) of every row."""
    known = stage(intervals(entries), "intervals")
    named = known.groupBy("key").agg((F.count(F.lit(1)) > busy).alias("busy"))
    rows = captures.select(
        F.col(capture_id).alias("_id"),
        F.col(url).alias("_url"),
        F.col(fetched_at).cast("long").alias("_at"),
    )
    last = rows.agg(F.max("_at")).first()[0]
    kinds = named.select(
        F.when(F.col("key").endswith("/"), _count(F.col("key"), "/")).alias("steps"),
        F.when(F.col("key").startswith("domain:"), _count(F.col("key"), ".") + 1).alias("labels"),
    ).agg(F.collect_set("steps").alias("steps"), F.collect_set("labels").alias("labels"))
    depth = kinds.first()
    asked = (
        rows.where("_at is not null")
        .distinct()
        .select("_id", "_url", "_at", F.explode(keys("_url", depth["steps"], depth["labels"])).alias("key"))
        .join(named, "key")
        .withColumn("span", F.when(F.col("busy"), F.floor(F.col("_at") / span)).otherwise(-1))
    )
    # No capture is later than the last: spans need not go on beyond it.
    end = F.least(F.col("valid_to") - 1, F.lit(last if last is not None else 0))
    spans = F.when(
        F.col("busy"),
        F.when(
            F.col("valid_from") <= end,
            F.sequence(F.floor(F.col("valid_from") / span), F.floor(end / span)),
        ).otherwise(F.array().cast("array<bigint>")),
    ).otherwise(F.array(F.lit(-1).cast("bigint")))
    held = known.join(named, "key").select("list_name", "verdict", "key", "valid_from", "valid_to", F.explode(spans).alias("span"))
    active = asked.join(held, ["key", "span"]).where("_at >= valid_from and _at < valid_to")
    found = active.groupBy("_id", "_url", "_at").agg(
        F.array_sort(F.collect_set(F.concat("list_name", F.lit("|"), "key"))).alias("matches"),
        F.max((F.col("verdict") == "block").cast("int")).alias("blocks"),
        F.max((F.col("verdict") == "allow").cast("int")).alias("allows"),
    )
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"f.{c}")) for c in ("_id", "_url", "_at")]
    return rows.alias("r").join(found.alias("f"), same, "left").select(
        F.col("r._id").alias(capture_id),
        host("r._url").alias("host"),
        F.col("r._at").alias("fetched_at"),
        F.coalesce((F.col("blocks") == 1) & (F.col("allows") == 0), F.lit(False)).alias("blocked"),
        F.coalesce(F.array_join("matches", ";"), F.lit("")).alias("matches"),
    )


# -- lists and captures drawn from crawled pages ---------------------------------------------

START = 1_704_067_200  # 2024-01-01
DAY = 86_400


def number(value: Column) -> Column:
    """A number from 32 bits of a text's MD5."""
    return F.conv(F.substring(F.md5(value), 1, 8), 16, 10).cast("long")


def captures_of(pages: DataFrame) -> DataFrame:
    """(page_id, url, fetched_at): each page, fetched at a time of 2024 that its URL decides."""
    at = F.lit(START) + F.pmod(number(F.col("url")), F.lit(366 * DAY))
    return pages.select("page_id", "url", at.alias("fetched_at"))


def lists_of(pages: DataFrame) -> DataFrame:
    """Dated entries on the hosts, their last two and three labels and first path steps.

    A fifth of the hosts is blocked for a while, some of them again later; an
    eleventh is allowed; registered domains are blocked now and then, which every
    page of the domain meets; and a seventh of the first path steps is blocked for good.
    """
    hosts = pages.select(host("url").alias("h"), F.regexp_extract("url", PATH, 1).alias("path")).where("h is not null").distinct()
    by_host = hosts.select("h").distinct().withColumn("n", number(F.col("h")))
    parts = F.split("h", r"\.")
    domains = by_host.where(F.size(parts) >= 2).select(
        F.explode(F.array(*(F.array_join(F.slice(parts, -k, k), ".") if k == 2 else F.regexp_extract("h", r"([^.]+\.[^.]+\.[^.]+)$", 1) for k in (2, 3)))).alias("h")
    )
    domains = domains.where("h <> ''").distinct().withColumn("n", number(F.col("h")))
    step = F.regexp_extract("path", r"^(/[^/]+/)", 1)
    steps = hosts.select(F.concat("h", step).alias("h"), step.alias("step")).where("step <> ''").distinct()
    steps = steps.select("h", number(F.col("h")).alias("n"))

    def entries(of: DataFrame, name: str, verdict: str, kind: str, when: str, *dated: tuple[str, str]) -> DataFrame:
        made = [F.struct(F.lit(action).alias("action"), F.expr(f"{START} + {DAY} * ({day})").alias("effective_at")) for action, day in dated]
        return of.where(when).select(
            F.lit(name).alias("list_name"), F.lit(verdict).alias("verdict"), F.lit(kind).alias("kind"),
            F.col("h").alias("pattern"), F.explode(F.array(*made)).alias("e"),
        ).select(*ENTRY[:4], "e.action", "e.effective_at")

    first = "n % 300"
    monthly = [(action, f"n % 30 + {30 * month + 10 * (action == 'remove')}") for month in range(12) for action in ("add", "remove")]
    return (
        entries(by_host, "ads", "block", "host", "n % 5 = 0", ("add", first), ("remove", f"{first} + 30 + n % 50"), ("add", f"{first} + 120 + n % 9"))
        .union(entries(by_host, "trusted", "allow", "host", "n % 11 = 0", ("add", "n % 100"), ("remove", "n % 100 + 150")))
        .union(entries(domains, "outbreaks", "block", "domain", "n % 3 <> 0", *monthly, *((a, f"{d} + 5") for a, d in monthly)))
        .union(entries(steps, "sections", "block", "prefix", "n % 7 = 0", ("add", "n % 200")))
    )
