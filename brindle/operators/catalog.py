"""The catalog of addresses: merged aliases, link rules, refresh priorities and the selections made from them."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.functions.time import parse_micros
from brindle.functions.url import url_part

DAY_US = 86_400 * 1_000_000
#: Order of the reasons to look at an address again.
PRIORITIES = ["stable", "new", "changed", "modified", "contract_changed"]
#: Paths that are no pages of their own, and endings of files that are none.
INDEX_PATHS = ["/category/", "/tag/", "/author/", "/about", "/contact", "/privacy"]
FILE_ENDINGS = [".jpg", ".jpeg", ".png", ".webp", ".pdf"]
#: First labels of hosts that publish nothing themselves.
INFRASTRUCTURE = ["account", "accounts", "ads", "analytics", "assets", "auth", "cdn", "id", "images", "img", "login", "media", "oauth", "sso", "static"]


def earliest_text(text: Column) -> Column:
    """Aggregate: of ISO texts the one of the earliest instant; unreadable ones count only where none is readable, then
    as texts. Blank and null texts don't count; '' for none. Equal instants give the smallest text."""
    kept = F.when(F.coalesce(text, F.lit("")) != "", text)
    return F.coalesce(F.min(F.when(kept.isNotNull(), F.struct(parse_micros(kept).isNull().alias("odd"), parse_micros(kept).alias("t"), kept.alias("s"))))["s"], F.lit(""))


def latest_text(text: Column) -> Column:
    """Aggregate: as earliest_text, of the latest instant; equal instants give the greatest text."""
    kept = F.when(F.coalesce(text, F.lit("")) != "", text)
    return F.coalesce(F.max(F.when(kept.isNotNull(), F.struct(parse_micros(kept).isNotNull().alias("fine"), parse_micros(kept).alias("t"), kept.alias("s"))))["s"], F.lit(""))


def merged_entries(entries: DataFrame, page: Column, fields: list[str]) -> DataFrame:
    """One entry per page of (url, first_discovered, last_checked, priority, missing_count, fields...).

    First and last instants are the extremes, the priority the most pressing, the missing count the highest; each field
    is that of the entry checked last that has one. All rules are associative aggregates, so aliases of a page are
    combined before the shuffle. Pages that are null or '' are left out; extra columns are ignored.
    """
    checked = F.coalesce(parse_micros(F.col("last_checked")), F.lit(-(1 << 62)))
    level = F.array_position(F.array(*[F.lit(x) for x in PRIORITIES]), F.col("priority"))
    kept = [F.max(F.when(F.coalesce(F.col(f), F.lit("")) != "", F.struct(checked.alias("t"), F.col(f).alias("v"))))["v"] for f in fields]
    rows = entries.withColumn("page", page).filter(F.coalesce("page", F.lit("")) != "")
    return rows.groupBy("page").agg(
        F.count(F.lit(1)).alias("aliases"), earliest_text(F.col("first_discovered")).alias("first_discovered"), latest_text(F.col("last_checked")).alias("last_checked"),
        F.max(F.struct(F.coalesce(level, F.lit(0)).alias("l"), "priority"))["priority"].alias("priority"), F.max(F.coalesce("missing_count", F.lit(0))).alias("missing_count"),
        *[F.coalesce(c, F.lit("")).alias(f) for c, f in zip(kept, fields, strict=True)],
    )


def checked_pattern(pattern: str, owner: str) -> str:
    """The pattern, or an error that names whose it is: patterns are looked at before any task runs."""
    try:
        re.compile(pattern)
    except re.error as broken:
        raise ValueError(f"pattern of {owner} can't be read: {pattern!r} ({broken})") from broken
    return pattern


def page_link(url: Column, text: Column, domain: Column, pattern: str, unmatched: bool = True) -> Column:
    """Whether a link leads to a page of a domain (or a host below it): no index or tag path, and either address or text
    match the pattern or, where unmatched ones may pass, the path has two steps and ends like no file. Nulls don't."""
    host = F.regexp_replace(F.lower(url_part(url, "netloc")), r":.*$", "")
    path = F.lower(url_part(url, "path"))
    inside = (host == domain) | host.endswith(F.concat(F.lit("."), domain))
    index = path.isin("", "/")
    for part in INDEX_PATHS:
        index = index | path.contains(part)
    file = F.lit(False)
    for ending in FILE_ENDINGS:
        file = file | path.endswith(ending)
    named = F.concat_ws(" ", url, text).rlike(f"(?i){checked_pattern(pattern, 'the link rule')}")
    loose = (F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit(""))) >= 2) & ~file if unmatched else F.lit(False)
    return F.coalesce(inside & ~index & (named | loose), F.lit(False))


def no_publisher(domain: Column, suffixes: list[str]) -> Column:
    """Whether a normalised domain publishes nothing itself: null or blank, one of the suffixes or below it, or with a
    first label that names infrastructure."""
    below = F.lit(False)
    for s in suffixes:
        below = below | (domain == s) | domain.endswith(f".{s}")
    return F.coalesce(domain, F.lit("")).isin("") | F.coalesce(below | F.element_at(F.split(domain, r"\."), 1).isin(*INFRASTRUCTURE), F.lit(False))


def refresh_scores(catalog: DataFrame, recipes: DataFrame, now: Column) -> DataFrame:
    """Catalog entries with priority_score and age_hours.

    catalog: (page, source, recipe_id, first_seen, last_checked in microseconds, priority, last_status); recipes:
    (recipe_id, rank, evidence_status, grown). A top rank, a never checked or new page, changed markup, growth and age
    raise the score, a recent check without a rating lowers it. Pages of no known recipe keep what the catalog says.
    """
    hour = F.lit(3_600_000_000.0)
    age = F.coalesce(F.greatest(F.lit(0.0), (now - F.col("last_checked")) / hour), F.lit(1e9))
    young = F.coalesce((now - F.col("first_seen")) / hour <= 48, F.lit(False))
    parts = [
        F.when(F.col("evidence_status") == "legacy_unverified", 100000), F.when(F.col("rank") <= 100, 20000 - F.col("rank") * 50), F.when(F.col("last_checked").isNull(), 15000), F.when(young, 8000),
        F.when(F.col("priority").isin("modified", "changed", "contract_changed"), 7000), F.when(F.col("grown") > 0, F.least(F.lit(5000), F.col("grown") * 10)),
        F.when((F.col("last_status") == "no_verified_rating") & (age < 24 * 7), -12000), F.least(F.lit(4000.0), age * 10),
    ]
    total = sum((F.coalesce(x.cast("double"), F.lit(0.0)) for x in parts), F.lit(0.0))
    return catalog.join(recipes, "recipe_id", "left").withColumns({"priority_score": total, "age_hours": age})


def hourly_targets(scored: DataFrame, limit: int) -> DataFrame:
    """The limit pages to look at next: a tenth for pages of no known recipe (at most two of a source), the rest for
    known ones, spread over up to ten sources before any gets more. A report of limit rows by its nature.

    scored: (page, source, recipe_id, priority_score, age_hours). Ties go to the smaller page.
    """
    order = [F.desc("priority_score"), F.desc("age_hours"), F.asc("page")]
    known = F.coalesce(F.col("recipe_id"), F.lit("")) != ""
    counts = scored.groupBy(known.alias("known")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("source").alias("sources")).collect()
    size = {r["known"]: (r["n"], r["sources"]) for r in counts}
    fresh, old = size.get(False, (0, 0)), size.get(True, (0, 0))
    explore = min(fresh[0], max(1, limit // 10)) if fresh[0] else 0
    steady = min(old[0], max(0, limit - explore))
    cap = -(-steady // max(1, min(10, old[1], steady))) if steady else 1
    per_source = Window.partitionBy("source").orderBy(*order)
    first = scored.filter(known).withColumn("over", F.row_number().over(per_source) > cap).orderBy("over", *order).limit(steady).drop("over")
    second = scored.filter(~known).withColumn("nth", F.row_number().over(per_source)).filter("nth <= 2").orderBy(*order).limit(min(explore, max(0, limit - steady))).drop("nth")
    return first.unionByName(second)


def full_targets(scored: DataFrame, cap: int) -> DataFrame:
    """Per source the cap pages that were not looked at for longest; a ranking limit that drops rows before the shuffle."""
    order = Window.partitionBy("source").orderBy(F.desc("age_hours"), F.desc("priority_score"), "page")
    return scored.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= cap)
