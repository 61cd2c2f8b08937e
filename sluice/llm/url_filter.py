"""URL filters: dated list entries, evaluated at the time of each capture.

A list says when an entry was put on it ("block") and taken off ("lift").  Entries become
validity intervals: from a block to the next dated entry of the same list, kind and value.
Every capture is looked up under its host, its parent domains and its path prefixes, and joined as of
its time: the interval that holds that time, if there is one.  Intervals are cut at fixed
buckets of days, so that the join is on equality of kind, value and bucket, and a much-used
value is spread over time.  The most specific entry decides: path prefix, then host, then
domain; then the longer value, then the later names in order.

Only DataFrame functions are used.

Defined results: captures without a time or with a URL that has no host are not blocked;
entries with null in any column, other kinds or other actions are not used; a block and a lift at the same time is
a block; repeated captures and entries change nothing for others and captures come out as often as they
go in; hosts longer than a name can be (253 characters) are looked up whole only; empty tables work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.llm.common import prepare, staged

BUCKET_DAYS = 30
#: Interval rows up to which they are broadcast, at some 200 bytes each.
BROADCAST_ROWS = 200_000
LONGEST_HOST = 253
KEY = ["list_name", "kind", "value"]


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?([^/?#:@]*)", 1)
    return F.regexp_replace(F.lower(host), r"\.$", "")


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def bucket_of(time: Column, days: int) -> Column:
    return F.floor(F.unix_date(F.to_date(time)) / days)


def intervals(entries: DataFrame, days: int = BUCKET_DAYS) -> DataFrame:
    """list_name, kind, value, since, until (null: still open) of every time an entry was active.

    The next entry is looked for within a bucket of days first, then among the buckets, so a value with
    a great many entries is not one group.
    """
    used = entries.select(*KEY, "action", "effective_at").na.drop()
    used = used.filter(F.col("kind").isin("host", "domain", "prefix") & F.col("action").isin("block", "lift"))
    value = F.regexp_replace(F.lower("value"), r"\.$", "")
    used = used.withColumn("value", F.when(F.col("kind") == "prefix", F.regexp_replace("value", "/+$", "")).otherwise(value))
    times = used.groupBy(*KEY, "effective_at").agg(F.max(F.col("action") == "block").alias("block"))
    times = times.withColumn("bucket", bucket_of(F.col("effective_at"), days))
    within = Window.partitionBy(*KEY, "bucket").orderBy("effective_at")
    times = times.withColumn("next", F.lead("effective_at").over(within))
    firsts = times.groupBy(*KEY, "bucket").agg(F.min("effective_at").alias("first"))
    following = firsts.withColumn("after", F.lead("first").over(Window.partitionBy(*KEY).orderBy("bucket"))).drop("first")
    return (
        times.filter("block")
        .join(following, [*KEY, "bucket"])
        .select(*KEY, F.col("effective_at").alias("since"), F.coalesce("next", "after").alias("until"))
    )


def keys_of(host: Column, path: Column, depth: Column) -> Column:
    """(kind, value, rank) under which a URL can be listed; prefixes up to ``depth`` segments."""
    labels = F.split(host, r"\.")
    domains = F.when(
        F.length(host) <= LONGEST_HOST,
        F.transform(
            F.sequence(F.lit(1), F.size(labels)),
            lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."),
        ),
    ).otherwise(F.array(host))
    parts = F.split(path, "/")
    steps = F.sequence(F.lit(1), F.least(F.size(parts), F.greatest(depth, F.lit(0)) + 1))
    prefixes = F.transform(steps, lambda i: F.concat(host, F.array_join(F.slice(parts, F.lit(1), i), "/")))

    def keyed(kind: str, rank: int):
        return lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value"), F.lit(rank).alias("rank"))

    return F.concat(
        F.transform(F.array(host), keyed("host", 2)),
        F.transform(domains, keyed("domain", 1)),
        F.transform(prefixes, keyed("prefix", 3)),
    )


def filter_urls(
    spark: SparkSession,
    captures: DataFrame,
    entries: DataFrame,
    url_col: str = "url",
    time_col: str = "fetched_at",
    days: int = BUCKET_DAYS,
) -> DataFrame:
    """All rows and columns of ``captures``, with a struct ``verdict`` of the entry that blocks, or null.

    A column of that name which ``captures`` has already gives way.
    """
    prepare(spark)
    row = F.struct(*(F.col(f"`{c}`") for c in captures.columns))
    held = captures.select(F.col(url_col).alias("url"), F.col(time_col).alias("at"), row.alias("row"))
    active = staged(spark, intervals(entries, days), "intervals")
    span = held.agg(F.min("at").alias("first"), F.max("at").alias("last"))
    span = span.withColumn("from", bucket_of(F.col("first"), days)).withColumn("to", bucket_of(F.col("last"), days)).first()
    low, high = F.lit(span["from"] or 0), F.lit(span["to"] or 0)
    begins = F.greatest(bucket_of(F.col("since"), days), low)
    ends = F.least(F.coalesce(bucket_of(F.col("until"), days), high), high)
    cut = active.withColumn("bucket", F.explode(F.when(begins <= ends, F.sequence(begins, ends))))
    cut = staged(spark, cut, "cut")
    slashes = F.length("value") - F.length(F.replace("value", F.lit("/")))
    size, depth = cut.agg(F.count("*"), F.max(F.when(F.col("kind") == "prefix", slashes))).first()
    looked = (
        held.select("url", "at")
        .withColumn("host", host_of(F.col("url")))
        .filter("host <> '' and at is not null")
        .withColumn("key", F.explode(keys_of(F.col("host"), path_of(F.col("url")), F.lit(depth or 0))))
        .select("url", "at", "key.*", bucket_of(F.col("at"), days).alias("bucket"))
    )
    cut = F.broadcast(cut) if size <= BROADCAST_ROWS else cut
    active_then = (F.col("since") <= F.col("at")) & (F.col("until").isNull() | (F.col("at") < F.col("until")))
    hits = looked.join(cut, ["kind", "value", "bucket"]).filter(active_then)
    best = hits.groupBy("url", "at").agg(
        F.max(F.struct("rank", F.length("value").alias("length"), "list_name", "kind", "value", "since")).alias("best")
    )
    verdict = best.select(
        F.col("url").alias("hit_url"),
        F.col("at").alias("hit_at"),
        F.struct("best.list_name", "best.kind", "best.value", "best.since").alias("verdict"),
    )
    same = (F.col("url") == F.col("hit_url")) & (F.col("at") == F.col("hit_at"))
    others = [F.col("row").getField(c).alias(c) for c in captures.columns if c.lower() != "verdict"]
    return held.join(verdict, same, "left").select(*others, "verdict")
