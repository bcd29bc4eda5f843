"""Queries of the address catalog: aliases, links, priorities and selections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brindle.bindings import readings, recipes, snapshots
from brindle.functions.time import parse_micros
from brindle.functions.url import normalize_domain, normalize_url
from brindle.operators import catalog as C
from brindle.operators import relational as R
from brindle.plans.functions import PAGE
from brindle.plans.problems import SQL_INSTANT
from brindle.plans.sql import RECIPES, SNAPSHOTS
from brindle.registry import query
from brindle.session import checkpointed, table

_HOUR = 3_600_000_000
_T = SQL_INSTANT
_LOG = f"l AS (SELECT url, recipe_id, source, fetch_status, page_hash, rating, timestamp AS s, obs_id, epoch_us({_T}) AS t FROM observations WHERE trim(url) <> ''),"
_ENTRIES = (
    _LOG
    + """
e AS (SELECT url, arg_min(s, {'t': t, 's': s}) AS first_discovered, arg_max(s, {'t': t, 's': s}) AS last_checked, min(t) AS first_t, max(t) AS last_t,
  arg_max(coalesce(recipe_id, ''), {'t': t, 'o': obs_id}) AS recipe_id, arg_max(coalesce(source, ''), {'t': t, 'o': obs_id}) AS source, arg_max(coalesce(page_hash, ''), {'t': t, 'o': obs_id}) AS page_hash,
  CASE WHEN arg_max(rating IS NULL, {'t': t, 'o': obs_id}) THEN 'no_verified_rating' ELSE arg_max(coalesce(fetch_status, ''), {'t': t, 'o': obs_id}) END AS last_status, count(*) FILTER (WHERE rating IS NULL) AS missing_count,
  CASE WHEN count(*) = 1 THEN 'new' WHEN count(DISTINCT page_hash) > 1 THEN 'changed' ELSE 'stable' END AS priority FROM l GROUP BY 1)"""
)


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One entry per spelled address of the log, as a crawler would keep it; one pass that combines before the shuffle."""
    o = table(spark, sf_dir, "observations").filter("trim(url) <> ''").select("url", "recipe_id", "source", "fetch_status", "page_hash", "rating", F.col("timestamp").alias("s"), "obs_id", parse_micros(F.col("timestamp")).alias("t"))
    last = F.max(F.struct("t", "obs_id", *[F.coalesce(c, F.lit("")).alias(c) for c in ("recipe_id", "source", "page_hash", "fetch_status")], F.col("rating").isNull().alias("unrated")))
    e = o.groupBy("url").agg(
        F.min(F.struct("t", "s"))["s"].alias("first_discovered"), F.max(F.struct("t", "s"))["s"].alias("last_checked"), F.min("t").alias("first_t"), F.max("t").alias("last_t"), last.alias("last"), F.count_if(F.col("rating").isNull()).alias("missing_count"),
        F.count(F.lit(1)).alias("n"), F.count_distinct("page_hash").alias("hashes"),
    )
    priority = F.when(F.col("n") == 1, "new").when(F.col("hashes") > 1, "changed").otherwise("stable")
    status = F.when(F.col("last.unrated"), "no_verified_rating").otherwise(F.col("last.fetch_status"))
    return e.select("url", "first_discovered", "last_checked", "first_t", "last_t", "last.recipe_id", "last.source", "last.page_hash", status.alias("last_status"), "missing_count", priority.alias("priority"))


@query(
    "alias_merge",
    f"WITH {_ENTRIES}, p AS (SELECT *, {PAGE.replace('u', 'u')} AS page FROM (SELECT *, trim(url) AS u FROM e)), q AS (SELECT *, list_position(['stable', 'new', 'changed', 'modified', 'contract_changed'], priority) AS lvl FROM p)"
    " SELECT page, count(*) AS aliases, arg_min(first_discovered, {'t': first_t, 's': first_discovered}) AS first_discovered, arg_max(last_checked, {'t': last_t, 's': last_checked}) AS last_checked, arg_max(priority, lvl) AS priority, max(missing_count) AS missing_count,"
    " coalesce(arg_max(recipe_id, {'t': last_t, 'v': recipe_id}) FILTER (WHERE recipe_id <> ''), '') AS recipe_id, coalesce(arg_max(page_hash, {'t': last_t, 'v': page_hash}) FILTER (WHERE page_hash <> ''), '') AS page_hash, coalesce(arg_max(source, {'t': last_t, 'v': source}) FILTER (WHERE source <> ''), '') AS source FROM q GROUP BY 1",
)
def alias_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.merged_entries(entries(spark, sf_dir), normalize_url(F.col("url")), ["recipe_id", "page_hash", "source"])


_SCORES = f"""{RECIPES}, {SNAPSHOTS}, {_ENTRIES},
rk AS (SELECT key AS recipe_id, arg_max(rank, {{'t': t, 'r': -rank}}) AS rank FROM snapshots GROUP BY 1),
gr AS (SELECT key AS recipe_id, n - pn AS grown FROM (SELECT key, n, lag(n) OVER (PARTITION BY key ORDER BY t) AS pn, row_number() OVER (PARTITION BY key ORDER BY t DESC) AS nth FROM readings) WHERE nth = 1),
rc AS (SELECT id AS recipe_id, evidence_status, rank, grown FROM recipes LEFT JOIN rk ON rk.recipe_id = id LEFT JOIN gr ON gr.recipe_id = id), mx AS (SELECT max(last_t) AS now FROM e),
ag AS (SELECT e.url AS page, e.source, e.recipe_id, evidence_status, rank, grown, e.priority, last_status, coalesce(greatest(0, (now - last_t) / {_HOUR}.0::DOUBLE), 1e9) AS age_hours, (now - first_t) / {_HOUR}.0::DOUBLE <= 48 AS young, last_t FROM e LEFT JOIN rc USING (recipe_id), mx),
sc AS (SELECT page, source, recipe_id, age_hours, coalesce(CASE WHEN evidence_status = 'legacy_unverified' THEN 100000 END, 0) + coalesce(CASE WHEN rank <= 100 THEN 20000 - rank * 50 END, 0) + CASE WHEN last_t IS NULL THEN 15000 ELSE 0 END + CASE WHEN young THEN 8000 ELSE 0 END
  + CASE WHEN priority = 'changed' THEN 7000 ELSE 0 END + coalesce(CASE WHEN grown > 0 THEN least(5000, grown * 10) END, 0) - CASE WHEN last_status = 'no_verified_rating' AND age_hours < 168 THEN 12000 ELSE 0 END + least(4000.0, age_hours * 10) AS priority_score FROM ag)"""


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = readings(spark, sf_dir)
    w = Window.partitionBy("key").orderBy("t")
    grown = log.withColumn("pn", F.lag("n").over(w)).groupBy("key").agg(F.max_by(F.struct((F.col("n") - F.col("pn")).alias("grown")), "t")["grown"].alias("grown"))
    rank = snapshots(spark, sf_dir).groupBy("key").agg(F.max(F.struct("t", (-F.col("rank")).alias("r")))["r"].alias("r")).select("key", (-F.col("r")).alias("rank"))
    known = recipes(spark, sf_dir, "evidence_status").select(F.col("id").alias("key"), "evidence_status").join(rank, "key", "left").join(grown, "key", "left").withColumnRenamed("key", "recipe_id")
    e = checkpointed(entries(spark, sf_dir))
    c = e.select(F.col("url").alias("page"), "source", "recipe_id", F.col("first_t").alias("first_seen"), F.col("last_t").alias("last_checked"), "priority", "last_status").crossJoin(F.broadcast(e.agg(F.max("last_t").alias("now"))))
    return C.refresh_scores(c, known, F.col("now")).select("page", "source", "recipe_id", "priority_score", "age_hours")


@query("crawl_priority", f"WITH {_SCORES} SELECT page, source, recipe_id, round(priority_score, 4) AS priority_score, round(age_hours, 4) AS age_hours FROM sc")
def crawl_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).withColumns({c: F.round(c, 4) for c in ("priority_score", "age_hours")})


@query(
    "targets_hourly",
    f"WITH {_SCORES}, k AS (SELECT *, recipe_id <> '' AS known FROM sc), z AS (SELECT count(*) FILTER (WHERE known) AS kn, count(DISTINCT source) FILTER (WHERE known) AS ks, count(*) FILTER (WHERE NOT known) AS fn FROM k),"
    " y AS (SELECT *, CASE WHEN fn > 0 THEN least(fn, 10) ELSE 0 END AS explore FROM z), x AS (SELECT *, least(kn, 100 - explore) AS steady FROM y), v AS (SELECT *, ceil(steady / greatest(1, least(10, ks, steady))::DOUBLE) AS cap FROM x),"
    " n AS (SELECT *, row_number() OVER (PARTITION BY known, source ORDER BY priority_score DESC, age_hours DESC, page) AS nth FROM k), a AS (SELECT page, row_number() OVER (ORDER BY nth > cap, priority_score DESC, age_hours DESC, page) AS i, steady FROM n, v WHERE known),"
    " b AS (SELECT page, row_number() OVER (ORDER BY priority_score DESC, age_hours DESC, page) AS i, least(explore, 100 - steady) AS lim FROM n, v WHERE NOT known AND nth <= 2) SELECT page FROM a WHERE i <= steady UNION ALL SELECT page FROM b WHERE i <= lim",
)
def targets_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.hourly_targets(checkpointed(_scored(spark, sf_dir)), 100).select("page")


@query("targets_full", f"WITH {_SCORES} SELECT page, source, nth FROM (SELECT page, source, row_number() OVER (PARTITION BY source ORDER BY age_hours DESC, priority_score DESC, page) AS nth FROM sc) WHERE nth <= 5")
def targets_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.full_targets(_scored(spark, sf_dir), 5).select("page", "source", "nth")


_LINK = r"slow-?cooker|recipe"


@query(
    "page_links",
    "WITH l AS (SELECT DISTINCT url, title, lower(trim(source)) AS d FROM observations WHERE trim(url) <> '' AND source IS NOT NULL), p AS (SELECT *, regexp_replace(lower(regexp_extract(url, '^[^:/?#]*://([^/?#]*)', 1)), ':.*$', '') AS host, lower(regexp_extract(url, '^[^:/?#]*://[^/?#]*([^?#]*)', 1)) AS path FROM l)"
    f" SELECT url, title, d AS source, coalesce((host = d OR ends_with(host, '.' || d)) AND path NOT IN ('', '/') AND NOT regexp_matches(path, '/category/|/tag/|/author/|/about|/contact|/privacy') AND (regexp_matches(concat_ws(' ', url, title), '(?i){_LINK}')"
    " OR (length(path) - length(replace(path, '/', '')) >= 2 AND NOT regexp_matches(path, '\\.(jpg|jpeg|png|webp|pdf)$'))), false) AS leads FROM p",
)
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "observations").filter("trim(url) <> '' and source is not null").select("url", "title", F.lower(F.trim("source")).alias("source")).distinct()
    return o.withColumn("leads", C.page_link(F.col("url"), F.col("title"), F.col("source"), _LINK))


_BLOCKED = ["ladle.example", "facebook.com"]


@query(
    "no_publishers",
    "WITH d AS (SELECT DISTINCT domain, regexp_replace(rtrim(lower(trim(domain)), '.'), '^www\\.', '') AS host FROM source_events) SELECT domain, host, coalesce(host, '') = '' OR host = 'ladle.example' OR ends_with(host, '.ladle.example') OR host = 'facebook.com' OR ends_with(host, '.facebook.com') OR string_split(host, '.')[1] IN ("
    + ", ".join(f"'{x}'" for x in C.INFRASTRUCTURE)
    + ") AS blocked FROM d",
)
def no_publishers(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "source_events").select("domain").distinct().withColumn("host", normalize_domain(F.col("domain")))
    return d.withColumn("blocked", C.no_publisher(F.col("host"), _BLOCKED))


@query(
    "candidate_upsert",
    f"WITH e AS (SELECT regexp_replace(rtrim(lower(trim(domain)), '.'), '^www\\.', '') AS host, vertical, event, reason, epoch_us({_T}) AS t FROM source_events) SELECT host, count(*) AS discoveries, count(DISTINCT (coalesce(event, ''), coalesce(reason, ''), coalesce(vertical, ''))) AS evidence, min(t) AS first_seen, max(t) AS last_seen FROM e WHERE host <> '' GROUP BY 1",
)
def candidate_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per candidate: how often it was seen and by how many different pieces of evidence."""
    e = table(spark, sf_dir, "source_events").select(normalize_domain(F.col("domain")).alias("host"), *[F.coalesce(c, F.lit("")).alias(c) for c in ("vertical", "event", "reason")], parse_micros(F.col("timestamp")).alias("t")).filter("host <> ''")
    one = e.groupBy("host", "event", "reason", "vertical").agg(F.count(F.lit(1)).alias("n"), F.min("t").alias("a"), F.max("t").alias("b"))
    return one.groupBy("host").agg(F.sum("n").alias("discoveries"), F.count(F.lit(1)).alias("evidence"), F.min("a").alias("first_seen"), F.max("b").alias("last_seen"))


@query("first_per_feed", "SELECT vertical, recipe_id, board_id, run_id, rank FROM (SELECT *, row_number() OVER (PARTITION BY vertical, recipe_id ORDER BY board_id, run_id, rank, delivered_at) AS n FROM rankings) WHERE n = 1")
def first_per_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each item of a vertical once, the first in feed order, by an associative minimum."""
    r = table(spark, sf_dir, "rankings")
    return r.groupBy("vertical", "recipe_id").agg(F.min(F.struct("board_id", "run_id", "rank", "delivered_at")).alias("r")).select("vertical", "recipe_id", "r.board_id", "r.run_id", "r.rank")


@query(
    "duplicate_lookup",
    f"WITH {RECIPES}, t AS (SELECT key, arg_max(trim(coalesce(nullif(trim(canonical_url), ''), url)), {{'t': t, 'o': obs_id}}) AS u FROM (SELECT o2.recipe_id AS key, epoch_us({_T}) AS t, canonical_url, url, obs_id FROM observations o2 WHERE recipe_id IS NOT NULL) GROUP BY 1),"
    f" p AS (SELECT key, {PAGE} AS page FROM t WHERE u <> ''), g AS (SELECT page, min(key) AS representative, count(*) AS members FROM p GROUP BY 1 HAVING count(*) > 1) SELECT id, representative, coalesce(members, 1) AS members, coalesce(representative = id, true) AS kept FROM recipes LEFT JOIN p ON p.key = id LEFT JOIN g USING (page)",
)
def duplicate_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every recipe with the representative of its page, if it shares one."""
    o = table(spark, sf_dir, "observations").filter("recipe_id is not null").select(F.col("recipe_id").alias("id"), parse_micros(F.col("timestamp")).alias("t"), "obs_id", F.trim(F.coalesce(F.nullif(F.trim("canonical_url"), F.lit("")), "url")).alias("u"))
    page = o.groupBy("id").agg(F.max_by("u", F.struct("t", "obs_id")).alias("u")).filter("u <> ''").select("id", normalize_url(F.col("u")).alias("page"))
    groups = page.groupBy("page").agg(F.min("id").alias("representative"), F.count(F.lit(1)).alias("members")).filter("members > 1")
    found = page.join(groups, "page").select("id", "representative", "members")
    return recipes(spark, sf_dir).select("id").join(found, "id", "left").select("id", "representative", F.coalesce("members", F.lit(1)).alias("members"), F.coalesce(F.col("representative") == F.col("id"), F.lit(True)).alias("kept"))


@query("source_fixtures", f"WITH {RECIPES} SELECT source, arg_max(url, {{'n': n, 'u': url}}) AS url, max(n) AS n FROM recipes WHERE url <> '' GROUP BY 1")
def source_fixtures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page to keep as a sample of each source: the one with the most ratings."""
    r = recipes(spark, sf_dir, "url").filter("url <> ''")
    return r.groupBy("source").agg(F.max(F.struct("n", "url")).alias("r")).select("source", "r.url", "r.n")


@query("corpus_order", f"WITH {RECIPES}, {SNAPSHOTS}, rk AS (SELECT key, arg_max(rank, {{'t': t, 'r': -rank}}) AS rank FROM snapshots GROUP BY 1) SELECT id, row_number() OVER (ORDER BY coalesce(rank, 1000000000), coalesce(confidence, 0) DESC, n DESC, lower(coalesce(title, '')), id) AS nth FROM recipes LEFT JOIN rk ON key = id")
def corpus_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    rank = snapshots(spark, sf_dir).groupBy("key").agg(F.max(F.struct("t", (-F.col("rank")).alias("r")))["r"].alias("r")).select(F.col("key").alias("id"), (-F.col("r")).alias("rank"))
    rows = recipes(spark, sf_dir, "title").join(rank, "id", "left").select("id", F.coalesce("rank", F.lit(10**9)).alias("rank"), F.coalesce("confidence", F.lit(0.0)).alias("c"), "n", F.lower(F.coalesce("title", F.lit(""))).alias("title"))
    return R.numbered(rows, [F.asc("rank"), F.desc("c"), F.desc("n"), F.asc("title"), F.asc("id")]).select("id", "nth")


@query("bounded_history", f"WITH {RECIPES} SELECT key, t, nth FROM (SELECT key, t, row_number() OVER (PARTITION BY key ORDER BY t DESC) AS nth FROM readings) WHERE nth <= 10")
def bounded_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten newest readings of each recipe; the rank limit drops the others before the shuffle."""
    nth = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("t")))
    return readings(spark, sf_dir).select("key", "t").withColumn("nth", nth).filter("nth <= 10")


@query("record_union", f"WITH u AS (SELECT 'reading' AS kind, recipe_id, source, epoch_us({_T}) AS t FROM observations UNION ALL SELECT 'rank', recipe_id, source, epoch_us({_T}) FROM rankings) SELECT kind, source, count(*) AS records, count(DISTINCT recipe_id) AS recipes, min(t) AS first_t, max(t) AS last_t FROM u GROUP BY 1, 2")
def record_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [table(spark, sf_dir, name).select(F.lit(kind).alias("kind"), "recipe_id", "source", parse_micros(F.col("timestamp")).alias("t")) for kind, name in (("reading", "observations"), ("rank", "rankings"))]
    return parts[0].unionByName(parts[1]).groupBy("kind", "source").agg(F.count(F.lit(1)).alias("records"), F.count_distinct("recipe_id").alias("recipes"), F.min("t").alias("first_t"), F.max("t").alias("last_t"))


@query("snapshot_hash", f"WITH {SNAPSHOTS} SELECT board_id, run_id, count(*) AS items, sha256(string_agg(rank || ':' || key, chr(10) ORDER BY rank, key)) AS digest FROM snapshots WHERE rank IS NOT NULL AND key IS NOT NULL GROUP BY 1, 2")
def snapshot_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A digest of each delivered board, whatever the order of its rows; a board has a few hundred rows at most."""
    rows = snapshots(spark, sf_dir).filter("rank is not null and key is not null").groupBy("board_id", "run_id").agg(F.array_sort(F.collect_list(F.struct("rank", "key"))).alias("r"))
    line = F.transform("r", lambda x: F.concat(x["rank"].cast("string"), F.lit(":"), x["key"]))
    return rows.select("board_id", "run_id", F.size("r").cast("bigint").alias("items"), F.sha2(F.array_join(line, "\n"), 256).alias("digest"))
