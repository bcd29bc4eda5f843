"""Operators on tables of URLs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.functions.url import normalize_url, url_part

#: Parts of addresses that lead to endless pages.
TRAP_TOKENS = ["/calendar/", "/search/", "/feed/", "/page/999", "/wp-json/"]


def is_trap(url: Column) -> Column:
    """More than four query pairs, a trap token, more than ten path segments, or one segment four times or more."""
    path = F.lower(url_part(url, "path"))
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    pairs = F.filter(F.split(url_part(url, "query"), "&"), lambda s: s != "")
    repeated = F.exists(parts, lambda s: F.size(F.filter(parts, lambda x: x == s)) >= 4)
    tokens = reduce(lambda a, b: a | b, [path.contains(t) for t in TRAP_TOKENS])
    return (F.size(pairs) > 4) | tokens | (F.size(parts) > 10) | repeated


def same_site(host: Column, domain: Column) -> Column:
    return (host == domain) | host.endswith(F.concat(F.lit("."), domain))


def alias_groups(rows: DataFrame, url: str, first: str, last: str) -> DataFrame:
    """(page, spellings, rows, first_seen, last_seen): URLs that differ in spelling only, merged; blank URLs left out.
    Each spelling is normalised once, after its rows are counted. All aggregates combine before the shuffle, so a page with a third of all rows is no hot spot."""
    kept = rows.select(F.trim(url).alias("raw"), F.col(first).alias("a"), F.col(last).alias("z")).filter("raw <> ''")
    each = kept.groupBy("raw").agg(F.count(F.lit(1)).alias("n"), F.min("a").alias("a"), F.max("z").alias("z")).withColumn("page", normalize_url(F.col("raw")))
    return each.groupBy("page").agg(F.count(F.lit(1)).alias("spellings"), F.sum("n").alias("rows"), F.min("a").alias("first_seen"), F.max("z").alias("last_seen"))
