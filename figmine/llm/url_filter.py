"""URL filters: a temporal list join, in DataFrame functions only.

A list is a table of dated entries ``kind`` ('domain' or 'path'), ``pattern``, ``action`` ('add' or
'remove') and ``dated``.  The entries of a pattern become validity intervals [added, next entry), and
every capture is evaluated against those active when it was fetched: the latest entry among its host,
the parent domains and the path prefixes decides.

A list of up to ``max_broadcast`` intervals is broadcast.  Beyond that captures and list meet by key in a
shuffle, which only keys that pass a broadcast bit table of the listed ones enter.

Defined cases: two entries of a pattern on one day count as the removal; an addition of what is active
goes on with the newer date; a null url or fetch date, or a url without a host, is never blocked;
repeated captures (same id, url and date) give one row; entries with a null part are ignored; extra columns of
captures are not carried.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from figmine.llm.common import stored

HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
PATH = r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*(/[^?#]*)"
MAX_BROADCAST = 200_000
#: words of 64 bits in the filter of a larger list: 16 MB as rows
FILTER_WORDS = 1 << 20


def host_of(url):
    return F.lower(F.regexp_extract(url, HOST, 1))


def path_of(url):
    return F.regexp_extract(url, PATH, 1)


def url_keys(url):
    """All patterns that can match a url: 'd:' with each domain suffix, 'p:' with each path prefix."""
    parts = F.filter(F.split(host_of(url), r"\."), lambda x: x != "")
    suffixes = F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts), F.lit(1))), lambda i: F.concat(F.lit("d:"), F.array_join(F.slice(parts, i, F.size(parts)), ".")))
    steps = F.filter(F.split(path_of(url), "/"), lambda x: x != "")
    prefixes = F.transform(F.sequence(F.lit(1), F.greatest(F.size(steps), F.lit(1))), lambda i: F.concat(F.lit("p:"), host_of(url), F.lit("/"), F.array_join(F.slice(steps, F.lit(1), i), "/")))
    return F.when(host_of(url) == "", F.array().cast("array<string>")).when(F.size(steps) > 0, F.array_distinct(F.concat(suffixes, prefixes))).otherwise(F.array_distinct(suffixes))


def validity(entries: DataFrame) -> DataFrame:
    """``pattern_key, valid_from, valid_to`` (open end: null) of each active interval."""
    known = entries.where("kind in ('domain', 'path') and pattern is not null and action in ('add', 'remove') and dated is not null")
    key = F.concat(F.when(F.col("kind") == "domain", "d:").otherwise("p:"), F.lower("pattern"))
    daily = known.groupBy(key.alias("pattern_key"), "dated").agg(F.max("action").alias("action"))
    nxt = F.lead("dated").over(W.partitionBy("pattern_key").orderBy("dated"))
    return daily.withColumn("valid_to", nxt).where("action = 'add'").select("pattern_key", F.col("dated").alias("valid_from"), "valid_to")


def _bits(key):
    """Word and bit of a key in a table of ``FILTER_WORDS`` words of 64 bits."""
    h = F.xxhash64(key)
    return F.pmod(F.shiftright(h, 6), F.lit(FILTER_WORDS)), F.pmod(h, F.lit(64)).cast("int")


def _listed(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """Those rows whose key may be on the list: a bit table of the list's keys, at most ``FILTER_WORDS`` rows,
    is broadcast, so that keys of a third of all captures that no entry names never reach the shuffle."""
    word, bit = _bits(F.col("pattern_key"))
    table = spans.select(word.alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("one")).groupBy("word").agg(F.bit_or("one").alias("bits"))
    at, mine = _bits(F.col("key"))
    return rows.withColumn("at", at).join(F.broadcast(table), (F.col("at") == F.col("word")) & (F.bit_get("bits", mine) == 1), "left_semi").drop("at")


def url_filter(captures: DataFrame, entries: DataFrame, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """Per capture: page_id, host, fetched_at, blocked, matched (pattern key), listed_at."""
    spans = stored(validity(entries), "intervals")
    small = spans.limit(max_broadcast + 1).count() <= max_broadcast
    asked = captures.select("page_id", "url", "fetched_at")
    keys, when = url_keys(F.col("url")), ("page_id", "url", "fetched_at")
    active = (F.col("key") == F.col("pattern_key")) & (F.col("fetched_at") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("fetched_at") < F.col("valid_to")))
    # a match sorts above none; the latest entry wins, then the longer and later pattern
    match = F.struct("valid_from", F.length("pattern_key").alias("size"), "pattern_key")
    if small:
        joined = asked.select(*when, F.explode_outer(keys).alias("key")).join(F.broadcast(spans), active, "left")
        found = joined.select(*when, F.when(F.col("pattern_key").isNotNull(), match).alias("found"))
    else:
        hits = _listed(asked.select(*when, F.explode(keys).alias("key")), spans).join(spans, active).select(*when, match.alias("found"))
        found = asked.select(*when, F.lit(None).cast(hits.schema["found"].dataType).alias("found")).unionByName(hits)
    verdict = found.groupBy(*when).agg(F.max("found").alias("found"))
    return verdict.select("page_id", host_of(F.col("url")).alias("host"), "fetched_at", F.col("found").isNotNull().alias("blocked"), F.col("found.pattern_key").alias("matched"), F.col("found.valid_from").alias("listed_at"))
