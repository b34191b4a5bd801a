"""URL filters: a temporal list join.

A list is a history of dated entries: at ``listed_at`` the entry (a host or a host and path
prefix) of a list was added or removed.  Entries become validity intervals: an entry's state
holds until the next dated entry for it.  A capture is evaluated against the entries active at
its fetch time: its host, its parent domains and its path prefixes are looked up as of then.

Hosts with many captures or many entries stay spread over tasks, since the join key has the
calendar month too: an interval is posted under each month that it touches, a capture under its
own.  Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

OPEN_END = "9999-12-31"


def url_host(url: Column) -> Column:
    """Host in lower case, without user, port and trailing dot; empty if the URL has none."""
    host = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:]*)", 1)
    return F.regexp_replace(F.lower(F.coalesce(host, F.lit(""))), r"\.+$", "")


def url_path(url: Column) -> Column:
    """Path without query and fragment, without a trailing slash."""
    path = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*(/[^?#]*)", 1)
    return F.regexp_replace(F.coalesce(path, F.lit("")), r"/+$", "")


def domains(host: Column) -> Column:
    """The host and its parent domains of two labels or more; addresses have no parents."""
    labels = F.split(host, r"\.")
    address = host.rlike(r"^\[|^[0-9]+(\.[0-9]+){3}$")
    return F.when(host == "", F.array().cast("array<string>")).when(
        address | (F.size(labels) < 2), F.array(host)).otherwise(F.transform(
            F.sequence(F.lit(1), F.size(labels) - 1),
            lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")))


def _segments(path: Column) -> Column:
    return F.filter(F.split(path, "/"), lambda p: p != "")


def prefixes(host: Column, path: Column, deepest: int) -> Column:
    """host/first, host/first/second, ... to ``deepest`` segments."""
    parts = _segments(path)
    depth = F.least(F.size(parts), F.lit(deepest))
    return F.when((host == "") | (depth < 1), F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), depth),
                    lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(parts, 1, i), "/"))))


def entry_of(entry: Column) -> Column:
    """A listed entry as captures are looked up.

    A host, a host and path, or a URL: without scheme, user, port, query and fragment, the host in lower
    case without a trailing dot, the path's case kept, without empty segments and trailing slash."""
    bare = F.regexp_replace(F.trim(entry), "^/+", "")
    url = F.when(bare.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*://"), bare).otherwise(F.concat(F.lit("http://"), bare))
    return F.concat_ws("/", url_host(url), _segments(url_path(url)))


def _month(day: Column) -> Column:
    return (F.year(day) * 12 + F.month(day)).cast("int")


def intervals(history: DataFrame) -> DataFrame:
    """(list_name, entry, valid_from, valid_to): when each entry was active, end exclusive.

    ``history(list_name, entry, listed_at, active)``; of entries at one time, a removal wins.
    Rows without entry, time or state are left out, and an entry without a host matches nothing; runs of equal state become one interval."""
    key = ["list_name", "entry"]
    clean = (history.where("entry is not null and listed_at is not null and active is not null")
             .select(F.coalesce("list_name", F.lit("")).alias("list_name"),
                     entry_of(F.col("entry")).alias("entry"), "listed_at", "active")
             .groupBy(*key, "listed_at").agg(F.min("active").alias("active")))
    by_time = Window.partitionBy(*key).orderBy("listed_at")
    turns = (clean.withColumn("before", F.lag("active").over(by_time))
             .where(F.col("active") != F.coalesce("before", F.lit(False))))
    return (turns.withColumn("valid_to", F.coalesce(F.lead("listed_at").over(by_time),
                                                    F.lit(OPEN_END).cast("timestamp")))
            .where("active")
            .select(*key, F.col("listed_at").alias("valid_from"), "valid_to"))


def evaluate(captures: DataFrame, history: DataFrame) -> DataFrame:
    """Per row of ``captures(page_id, url, fetched_at)``: page_id, url, host, fetched_at, listed,
    n_entries, lists, entry, listed_since.

    n_entries and lists count and name what was active at the fetch; entry is the longest such
    entry (of several lists the first by name) and listed_since its start.  Captures without
    host or time match nothing.  Repeated rows are evaluated each; other columns are ignored."""
    url, host = F.col("url").cast("string"), F.col("host")
    rows = captures.select("page_id", url.alias("url"), url_host(url).alias("host"),
                           url_path(url).alias("path"), "fetched_at")
    # Equal host, path and time are evaluated once, before anything is joined.
    asked = rows.select("host", "path", "fetched_at").where("host <> '' and fetched_at is not null")
    last = captures.agg(F.max("fetched_at").alias("last")).scalar()
    first = captures.agg(F.min("fetched_at").alias("first")).scalar()
    # Prefixes as deep as the deepest listed entry: more can't match.
    deepest = history.agg(F.max(F.size(F.split(entry_of(F.col("entry")), "/")) - 1).alias("deepest")).first()[0] or 0
    keys = (asked.distinct()
            .withColumn("entry", F.explode(F.array_distinct(F.concat(
                domains(host), prefixes(host, F.col("path"), deepest)))))
            .withColumn("month", _month(F.col("fetched_at"))))
    active = (intervals(history)
              .where((F.col("valid_from") <= last) & (F.col("valid_to") > first))
              .withColumn("month", F.explode(F.sequence(
                  _month(F.greatest("valid_from", first)), _month(F.least("valid_to", last))))))
    found = (keys.join(active, ["entry", "month"])
             .where("valid_from <= fetched_at and fetched_at < valid_to")
             .groupBy("host", "path", "fetched_at")
             .agg(F.count("*").alias("n"), F.sort_array(F.collect_set("list_name")).alias("names"),
                  F.min(F.struct((-F.length("entry")).alias("size"), "list_name", "entry",
                                 "valid_from")).alias("best")))
    return (rows.join(found, ["host", "path", "fetched_at"], "left")
            .select("page_id", "url", "host", "fetched_at",
                    F.col("n").isNotNull().alias("listed"),
                    F.coalesce("n", F.lit(0).cast("long")).alias("n_entries"),
                    F.coalesce(F.array_join("names", ","), F.lit("")).alias("lists"),
                    F.col("best.entry").alias("entry"),
                    F.col("best.valid_from").alias("listed_since")))


# --- captures and list history from the page table ------------------------------------------

FIRST_DAY = "2023-01-01"
DAYS = 730


def page_captures(pages: DataFrame) -> DataFrame:
    """Captures of ``pages(page_id, url)``, fetched on a day that follows from the page_id."""
    day = F.date_add(F.lit(FIRST_DAY).cast("date"),
                     F.pmod(F.col("page_id") * 7919, F.lit(DAYS)).cast("int"))
    return pages.select("page_id", "url", day.cast("timestamp_ntz").cast("timestamp").alias("fetched_at"))


def page_history(pages: DataFrame) -> DataFrame:
    """List entries from the hosts, domains and sections of ``pages``.

    Every second host (by its digest) is on `hosts`, every third two-label domain on
    `domains`, every fourth host with first path segment on `paths`; each is added on a day from
    its digest, removed 200 days later and added again 300 days after the first time."""
    url = F.col("url").cast("string")
    host, path = url_host(url), url_path(url)
    names = pages.select(host.alias("host"), F.split(path, "/").getItem(1).alias("section")
                         ).where("host <> ''").distinct()
    label = F.split("host", r"\.")

    def entry(list_name: str, name: Column, part: int) -> Column:
        return F.struct(F.lit(list_name).alias("list_name"), name.alias("entry"),
                        F.lit(part).alias("part"))

    entries = names.select(F.explode(F.array(
        entry("hosts", F.col("host"), 2),
        entry("domains", F.array_join(F.slice(label, -2, 2), "."), 3),
        entry("paths", F.concat("host", F.lit("/"), F.col("section")), 4),
    )).alias("e")).select("e.*").where("entry is not null").distinct()
    code = F.conv(F.substring(F.md5(F.col("entry").cast("binary")), 1, 6), 16, 10).cast("long")
    first = F.date_add(F.lit(FIRST_DAY).cast("date"), F.pmod(code, F.lit(500)).cast("int"))

    def state(days: int, active: bool) -> Column:
        return F.struct(F.date_add(first, days).alias("day"), F.lit(active).alias("active"))

    return (entries.where(F.pmod(code, F.col("part")) == 0)
            .select("list_name", "entry", F.explode(F.array(
                state(0, True), state(200, False), state(300, True))).alias("h"))
            .select("list_name", "entry",
                    F.col("h.day").cast("timestamp_ntz").cast("timestamp").alias("listed_at"),
                    F.col("h.active").alias("active")))
