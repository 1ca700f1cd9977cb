"""URL filters: a temporal join of captures with dated lists.

List entries are events (kind, pattern, action add or remove, at). They become validity intervals,
and an as-of join holds every capture against the entries active when it was fetched. A capture (its
URL and fetch time) is expanded to its lookup keys: its host and each parent domain, its URL and each
prefix of its path, up to as many segments as the longest listed prefix has. Keys of patterns that
occur in the lists survive; they and the intervals are sorted together by pattern and time, and each
key takes the last interval that has begun by then: one pass, however often a pattern was
listed. A host may have a third of all captures: keys with more than one in HEAVY of all (fewer than
HEAVY) meet the lists by a broadcast, and are then dealt over parts of about one in HEAVY each, to
each of which their intervals are copied.

Kinds: domain (a host or any below it), prefix (host/path at a segment's end), url (the whole URL
without scheme, query and fragment). Hosts are compared in lower case without port, user and
final dot.

Defined cases: an interval holds its first instant and not its last; of events of one pattern at
one instant a remove counts before an add, and equal events count once; an add while active and a
remove while inactive change nothing; null fields make an entry void; a capture without a URL, host
or time is matched by nothing and stays in the result. Every capture row has its own verdict, by its
own URL and time: repeated, null or missing capture_ids change nothing. Capture columns named
n_active, matched or blocked are replaced, all others kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandline.llm._shared import HEAVY, durable

# The surrogate history of the query: days are counted from this date.
FIRST_DAY = "2024-01-01"


def url_host(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1)
    return F.regexp_replace(F.lower(found), r"\.$", "")


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def lookup_keys(url: Column, depth: int | Column | None = None) -> Column:
    """Array of (kind, pattern) under which a URL may be listed, with prefixes of depth segments at most (None: all)."""
    host, path = url_host(url), url_path(url)
    labels = F.split(host, r"\.")
    segments = F.filter(F.split(path, "/"), lambda x: x != "")
    n = F.size(labels)
    domains = F.transform(F.sequence(F.lit(1), n), lambda i: F.struct(F.lit("domain").alias("kind"), F.array_join(F.slice(labels, i, n), ".").alias("pattern")))
    most = F.size(segments) if depth is None else F.least(F.size(segments), F.lit(depth) if isinstance(depth, int) else depth)
    prefixes = F.transform(F.filter(F.sequence(F.lit(1), F.greatest(most, F.lit(1))), lambda i: i <= most), lambda i: F.struct(F.lit("prefix").alias("kind"), F.concat(host, F.lit("/"), F.array_join(F.slice(segments, F.lit(1), i), "/")).alias("pattern")))
    whole = F.array(F.struct(F.lit("url").alias("kind"), F.concat(host, path).alias("pattern")))
    return F.when(host == "", F.filter(whole, lambda x: F.lit(False))).otherwise(F.concat(domains, prefixes, whole))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """(kind, pattern, active_from, active_to): when each pattern was listed; active_to null means still."""
    events = entries.select("kind", "pattern", "at", (F.col("action") == "add").alias("on"))
    events = events.filter(F.col("kind").isNotNull() & F.col("pattern").isNotNull() & F.col("at").isNotNull() & F.col("on").isNotNull())
    last = events.groupBy("kind", "pattern", "at").agg(F.max("on").alias("on"))  # at one instant an add wins
    w = Window.partitionBy("kind", "pattern").orderBy("at")
    changes = last.withColumn("before", F.coalesce(F.lag("on").over(w), F.lit(False))).filter(F.col("on") != F.col("before"))
    return changes.withColumn("active_to", F.lead("at").over(w)).filter("on").select("kind", "pattern", F.col("at").alias("active_from"), "active_to")


def deepest_prefix(entries: DataFrame) -> int:
    """Segments of the longest listed prefix."""
    slashes = F.length("pattern") - F.length(F.replace("pattern", F.lit("/"), F.lit("")))
    return entries.filter("kind = 'prefix'").agg(F.max(slashes)).first()[0] or 0


def _listed_keys(pages: DataFrame, listed: DataFrame) -> DataFrame:
    """(url, fetched_at, kind, pattern, salts): the lookup keys of the pages that are on a list.

    A key with more than one in HEAVY of all keys, listed or not, never meets in one task: it is taken
    by a broadcast of the fewer than HEAVY such keys, and gets as many salts as it has shares of one in HEAVY.
    """
    key = ["kind", "pattern"]
    keys = pages.select("url", "fetched_at", F.explode(lookup_keys(F.col("url"), deepest_prefix(listed))).alias("k")).select("url", "fetched_at", "k.*")
    total = keys.count()
    counts = keys.groupBy(*key).agg(F.count("*").alias("n"))
    heavy = durable(counts.filter(F.col("n") * HEAVY > F.lit(total)), "heavy_keys")
    patterns = listed.select(*key).distinct()
    salts = F.ceil(F.col("n") * HEAVY / F.lit(max(total, 1))).cast("int").alias("salts")
    hot = keys.join(F.broadcast(heavy.join(patterns, key, "left_semi").select(*key, salts)), key)
    rest = keys.join(F.broadcast(heavy.select(*key)), key, "left_anti").join(patterns, key, "left_semi").withColumn("salts", F.lit(1))
    return durable(hot.unionByName(rest), "keys")


def matches(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """(url, fetched_at, kind, pattern) for every entry active for a distinct (url, fetched_at) of the captures."""
    listed = durable(validity_intervals(entries), "intervals")
    pages = captures.select("url", "fetched_at").filter("url IS NOT NULL AND fetched_at IS NOT NULL").distinct()
    keys = _listed_keys(pages, listed)
    heavy = F.broadcast(keys.filter("salts > 1").select("kind", "pattern", "salts").distinct())  # fewer than HEAVY rows

    never = F.lit(None).cast(listed.schema["active_from"].dataType)
    of_keys = keys.withColumn("salt", F.pmod(F.xxhash64("url", "fetched_at"), F.col("salts")).cast("int"))
    of_lists = listed.join(heavy, ["kind", "pattern"], "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)))
    begun = F.struct("active_from", "active_to")
    both = of_keys.select("kind", "pattern", "salt", F.col("fetched_at").alias("at"), F.lit(1).alias("after"), "url", "fetched_at", F.when(F.lit(False), F.struct(never.alias("active_from"), never.alias("active_to"))).alias("interval"))
    both = both.unionByName(of_lists.select("kind", "pattern", "salt", F.col("active_from").alias("at"), F.lit(0).alias("after"), F.lit(None).cast("string").alias("url"), F.lit(None).cast(captures.schema["fetched_at"].dataType).alias("fetched_at"), begun.alias("interval")))
    w = Window.partitionBy("kind", "pattern", "salt").orderBy("at", "after").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = both.withColumn("last", F.last("interval", ignorenulls=True).over(w)).filter("after = 1")
    active = F.col("last").isNotNull() & (F.col("last.active_to").isNull() | (F.col("fetched_at") < F.col("last.active_to")))
    return found.filter(active).select("url", "fetched_at", "kind", "pattern")


def filter_captures(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """captures(url, fetched_at, ...) with n_active, matched (sorted 'kind:pattern' texts) and blocked.

    Captures without URL or time meet nothing and are not shuffled; those of one URL and time that are
    more than one in HEAVY of all get their matches by a broadcast.
    """
    key = ["url", "fetched_at"]
    per = durable(matches(captures, entries).groupBy(*key).agg(F.sort_array(F.collect_list(F.concat_ws(":", "kind", "pattern"))).alias("found")), "found")
    kept = [c for c in captures.columns if c.lower() not in ("n_active", "matched", "blocked")]
    rows = captures.select(F.struct(*[f"`{c}`" for c in kept]).alias("row"), *key)
    dated = F.col("url").isNotNull() & F.col("fetched_at").isNotNull()
    total = rows.count()
    counts = rows.filter(dated).groupBy(*key).agg(F.count("*").alias("n"))
    heavy = counts.filter(F.col("n") * HEAVY > F.lit(total)).select(*key)
    heavy = durable(heavy.join(per, key, "left"), "heavy")
    hot = rows.join(F.broadcast(heavy), key).select("row", "found")
    rest = rows.filter(dated).join(F.broadcast(heavy.select(*key)), key, "left_anti").join(per, key, "left").select("row", "found")
    bare = rows.filter(~dated).select("row", F.lit(None).cast(per.schema["found"].dataType).alias("found"))
    matched = F.coalesce("found", F.array().cast("array<string>"))
    rows = hot.unionByName(rest).unionByName(bare)
    return rows.select("row.*", F.size(matched).cast("long").alias("n_active"), matched.alias("matched"), (F.size(matched) > 0).alias("blocked"))


def _code(text: Column) -> Column:
    """A number from the first six hex digits of a text's md5."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 6), 16, 10).cast("long")


def _day(n: Column) -> Column:
    return F.date_add(F.lit(FIRST_DAY).cast("date"), n.cast("int"))


def surrogate_entries(pages: DataFrame) -> DataFrame:
    """Dated entries made from the hosts, path prefixes of every depth and URLs of pages, which come without lists.

    By a hash of the pattern: a quarter of the domains, a fifth of the prefixes and a seventh of the
    URLs are listed on some day, some are removed again, and some of those return.
    """
    keys = pages.select(F.explode(lookup_keys(F.col("url"))).alias("k")).select("k.*").distinct()
    c = _code(F.concat_ws(":", "kind", "pattern"))
    share = F.when(F.col("kind") == "domain", 4).when(F.col("kind") == "prefix", 5).otherwise(7)
    keys = keys.withColumn("c", c).filter(F.col("c") % share == 0)
    first = F.col("c") % 200
    event = lambda action, day, on: F.when(on, F.struct(F.lit(action).alias("action"), _day(day).alias("at")))
    events = F.array(event("add", first, F.lit(True)), event("remove", first + 60, F.col("c") % 3 != 0), event("add", first + 120, F.col("c") % 3 == 1))
    return keys.select("kind", "pattern", F.explode(events).alias("e")).filter("e IS NOT NULL").select("kind", "pattern", "e.action", "e.at")


def url_report(pages: DataFrame) -> DataFrame:
    """One row per page row: page_id, host, fetched_on, n_active, matched, blocked.

    Pages come without fetch times: a page is taken as fetched on day (37 * page_id) mod 366.
    """
    captures = pages.select("page_id", "url").withColumn("fetched_at", _day(F.pmod(F.col("page_id") * 37, F.lit(366))))
    out = filter_captures(captures, surrogate_entries(pages.select("url")))
    return out.select("page_id", url_host(F.col("url")).alias("host"), F.col("fetched_at").cast("string").alias("fetched_on"), "n_active", F.array_join("matched", ",").alias("matched"), "blocked")
