"""Queries of run reports: reliability, findings, metrics, histories and the whole ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brindle.bindings import coverage, readings, recipes, snapshots
from brindle.functions.time import parse_micros
from brindle.operators import dedupe as D
from brindle.operators import score as S
from brindle.operators import timeseries as T
from brindle.plans.entities import records
from brindle.plans.history import _now, calibrated
from brindle.plans.problems import SQL_INSTANT
from brindle.plans.ranking import _SIM, _r, _simulated
from brindle.plans.ranking import scores as current_scores
from brindle.plans.sql import COVERAGE, DAY, NOW, READINGS, RECIPES, SNAPSHOTS
from brindle.registry import query
from brindle.session import checkpointed, table


@query(
    "source_reliability",
    f"WITH {RECIPES}, {COVERAGE}, r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY run_day DESC) AS nth FROM coverage), a AS (SELECT source, count(*) AS runs_sampled, count(*) FILTER (WHERE status = 'ok') / count(*)::DOUBLE AS run_success_rate, max(run_day) AS last_checked, arg_max(status, run_day) = 'ok' AS healthy_at_last_check FROM r WHERE nth <= 30 GROUP BY 1),"
    " c AS (SELECT source, count(*) AS known_recipes, sum(CAST(round(coalesce(confidence, 0) * 10000) AS BIGINT))::DOUBLE / count(*) / 10000 AS mean_confidence, count(*) FILTER (WHERE evidence_status = 'legacy_unverified') AS legacy_pending FROM recipes GROUP BY 1), s AS (SELECT source FROM a UNION SELECT source FROM c)"
    " SELECT source, coalesce(runs_sampled, 0) AS runs_sampled, round(run_success_rate, 6) AS run_success_rate, last_checked, coalesce(healthy_at_last_check, false) AS healthy_at_last_check, coalesce(known_recipes, 0) AS known_recipes, round(mean_confidence, 6) AS mean_confidence, coalesce(legacy_pending, 0) AS legacy_pending FROM s LEFT JOIN a USING (source) LEFT JOIN c USING (source)",
)
def source_reliability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources of runs or recipes with the success of their last 30 runs and the state of their recipes; confidences are
    summed as whole numbers, so the mean does not depend on the order of rows."""
    nth = F.row_number().over(Window.partitionBy("source").orderBy(F.desc("run_day")))
    a = coverage(spark, sf_dir).withColumn("nth", nth).filter("nth <= 30").groupBy("source").agg(
        F.count(F.lit(1)).alias("runs_sampled"), F.round(F.avg((F.col("status") == "ok").cast("double")), 6).alias("run_success_rate"), F.max("run_day").alias("last_checked"), (F.max_by("status", "run_day") == "ok").alias("healthy_at_last_check")
    )
    c = recipes(spark, sf_dir, "evidence_status").groupBy("source").agg(F.count(F.lit(1)).alias("known_recipes"), F.round(F.sum(F.round(F.coalesce("confidence", F.lit(0.0)) * 10000).cast("bigint")).cast("double") / F.count(F.lit(1)) / 10000, 6).alias("mean_confidence"), F.count_if(F.col("evidence_status") == "legacy_unverified").alias("legacy_pending"))
    return a.join(c, "source", "full").fillna(0, ["runs_sampled", "known_recipes", "legacy_pending"]).fillna(False, ["healthy_at_last_check"])


@query("source_failures", f"WITH {COVERAGE} SELECT source, run_day, 'high' AS severity, status AS detail FROM coverage WHERE status NOT IN ('ok', 'not_checked_this_run')")
def source_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage(spark, sf_dir).filter("status not in ('ok', 'not_checked_this_run')").select("source", "run_day", F.lit("high").alias("severity"), F.col("status").alias("detail"))


_EVENTS = f"""eo AS (SELECT recipe_id AS key, epoch_us({SQL_INSTANT}) AS t, obs_id, rating, evidence_status, fetch_status, dom_fingerprint AS d, schema_signature AS s, source, url FROM observations),
dd AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key, t ORDER BY obs_id DESC) AS nth FROM eo) WHERE nth = 1 AND key IS NOT NULL AND t IS NOT NULL),
w AS (SELECT *, lag(d) OVER p AS pd, lag(s) OVER p AS ps FROM dd WINDOW p AS (PARTITION BY key ORDER BY t)),
ev AS (SELECT key, t, source, url, unnest(list_filter([CASE WHEN evidence_status = 'conflict' THEN 'rating_evidence_conflict' END, CASE WHEN rating > 5.05 OR rating < 0 THEN 'malformed_rating_scale' END, CASE WHEN fetch_status IS NULL THEN 'fetch_error' END,
  CASE WHEN d <> '' AND pd <> '' AND d <> pd THEN 'dom_structure_changed' END, CASE WHEN s <> '' AND ps <> '' AND s <> ps THEN 'schema_structure_changed' END], lambda x: x IS NOT NULL)) AS type FROM w)"""
HIGH = ["recipe_disappeared", "rating_evidence_conflict", "schema_structure_changed"]


@query("tracked_events", f"WITH {_EVENTS} SELECT key, t, source, url, type, CASE WHEN type IN ('rating_evidence_conflict', 'schema_structure_changed') THEN 'high' ELSE 'medium' END AS severity FROM ev")
def tracked_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events worth a look, one row each: conflicts, impossible scales, failed fetches and changed markup."""
    fields = ["rating", "evidence_status", "fetch_status", "dom_fingerprint", "schema_signature", "source", "url"]
    o = table(spark, sf_dir, "observations").select(F.col("recipe_id").alias("key"), parse_micros(F.col("timestamp")).alias("t"), "obs_id", *fields).filter("key is not null and t is not null")
    d = o.groupBy("key", "t").agg(F.max_by(F.struct(*fields), "obs_id").alias("r")).select("key", "t", "r.*")
    before = Window.partitionBy("key").orderBy("t")

    def changed(c: str):
        return (F.col(c) != "") & (F.lag(c).over(before) != "") & (F.col(c) != F.lag(c).over(before))

    d = d.withColumns({"dom": changed("dom_fingerprint"), "schema": changed("schema_signature")})
    rules = {"rating_evidence_conflict": F.col("evidence_status") == "conflict", "malformed_rating_scale": (F.col("rating") > 5.05) | (F.col("rating") < 0), "fetch_error": F.col("fetch_status").isNull(), "dom_structure_changed": F.col("dom"), "schema_structure_changed": F.col("schema")}
    found = F.filter(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules.items()]), lambda x: x.isNotNull())
    return d.select("key", "t", "source", "url", F.explode(found).alias("type")).withColumn("severity", F.when(F.col("type").isin(*HIGH), "high").otherwise("medium"))


@query(
    "temporal_anomalies",
    f"WITH {READINGS}, c AS (SELECT key, rating, row_number() OVER (PARTITION BY key ORDER BY t DESC) AS i FROM readings WHERE t >= {NOW} - 30 * {DAY}), s AS (SELECT key, avg(rating) FILTER (WHERE i <= 3) - avg(rating) FILTER (WHERE i BETWEEN 4 AND 6) AS shift, count(*) AS c FROM c WHERE i <= 6 GROUP BY 1)"
    " SELECT key, 'rating_change_point' AS type, 'medium' AS severity, round(shift, 6) + 0.0 AS shift FROM s WHERE c = 6 AND round(abs(shift), 9) >= 0.05",
)
def temporal_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, now = _now(checkpointed(readings(spark, sf_dir)))
    found = T.change_points(rows, now).filter(F.round(F.abs("shift"), 9) >= 0.05)
    return _r(found.select("key", F.lit("rating_change_point").alias("type"), F.lit("medium").alias("severity"), "shift"), "shift")


_METRICS = ["crawl_targets", "pages_fetched", "pages_not_modified", "crawl_errors", "fetch_success_rate", "extract_success_rate", "verification_rate", "conflict_rate", "configured_recipes", "ranked_recipes", "ranking_eligible_rate", "mean_confidence", "sources_checked_24h", "sources_successful_24h", "sources_stale_24h", "sources_stale_7d", "legacy_pending", "dom_changes", "schema_changes", "mean_targets", "p95_targets"]


@query(
    "pipeline_metrics",
    f"""WITH {RECIPES}, {COVERAGE}, {_EVENTS},
a AS (SELECT count(*) AS crawl_targets, count(*) FILTER (WHERE fetch_status = 'fetched') AS pages_fetched, count(*) FILTER (WHERE fetch_status = 'not_modified') AS pages_not_modified, count(*) FILTER (WHERE fetch_status IS NULL) AS crawl_errors,
  count(*) FILTER (WHERE rating IS NOT NULL) AS recognized, count(*) FILTER (WHERE evidence_status = 'verified') AS verified, count(*) FILTER (WHERE evidence_status = 'conflict') AS conflicts, count(DISTINCT recipe_id) AS configured, max(epoch_us({SQL_INSTANT})) AS now FROM observations),
b AS (SELECT count(*) AS ranked, avg(coalesce(confidence, 0)) AS mc, count(*) FILTER (WHERE evidence_status = 'legacy_unverified') AS legacy FROM recipes),
so AS (SELECT source, max(epoch_us({SQL_INSTANT})) AS last_t, max(epoch_us({SQL_INSTANT})) FILTER (WHERE fetch_status = 'fetched') AS last_ok FROM observations WHERE source IS NOT NULL GROUP BY 1),
c AS (SELECT count(*) FILTER (WHERE last_t >= now - {DAY}) AS c24, count(*) FILTER (WHERE last_ok >= now - {DAY}) AS s24, count(*) FILTER (WHERE last_t < now - {DAY}) AS st24, count(*) FILTER (WHERE last_t < now - 7 * {DAY}) AS st7 FROM so, a),
d AS (SELECT count(*) FILTER (WHERE type = 'dom_structure_changed') AS dom, count(*) FILTER (WHERE type = 'schema_structure_changed') AS sch FROM ev),
t AS (SELECT avg(targets) AS mt, quantile_disc(targets, 0.95) AS p95 FROM coverage),
m AS (SELECT crawl_targets::DOUBLE AS crawl_targets, pages_fetched::DOUBLE AS pages_fetched, pages_not_modified::DOUBLE AS pages_not_modified, crawl_errors::DOUBLE AS crawl_errors, (pages_fetched + pages_not_modified) / greatest(1, crawl_targets)::DOUBLE AS fetch_success_rate,
  recognized / greatest(1, pages_fetched + pages_not_modified)::DOUBLE AS extract_success_rate, verified / greatest(1, pages_fetched + pages_not_modified)::DOUBLE AS verification_rate, conflicts / greatest(1, crawl_targets)::DOUBLE AS conflict_rate, configured::DOUBLE AS configured_recipes, ranked::DOUBLE AS ranked_recipes,
  ranked / greatest(1, configured)::DOUBLE AS ranking_eligible_rate, mc AS mean_confidence, c24::DOUBLE AS sources_checked_24h, s24::DOUBLE AS sources_successful_24h, st24::DOUBLE AS sources_stale_24h, st7::DOUBLE AS sources_stale_7d, legacy::DOUBLE AS legacy_pending, dom::DOUBLE AS dom_changes, sch::DOUBLE AS schema_changes, mt AS mean_targets, p95::DOUBLE AS p95_targets FROM a, b, c, d, t)
SELECT metric, round(value, 6) AS value, CASE WHEN metric = 'fetch_success_rate' AND value < 0.9 THEN 'below 0.9' WHEN metric = 'extract_success_rate' AND value < 0.8 THEN 'below 0.8' WHEN metric = 'conflict_rate' AND value > 0.05 THEN 'above 0.05' END AS alert FROM (UNPIVOT m ON {', '.join(_METRICS)} INTO NAME metric VALUE value)""",
)
def pipeline_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The figures of the pipeline, one row each, with the alert of those beyond their limit. Every input is one
    aggregate; only one-row tables meet."""
    o = table(spark, sf_dir, "observations")
    t = parse_micros(F.col("timestamp"))
    n = lambda c: F.count_if(c).cast("double")
    fetched, unchanged, status = F.col("fetch_status") == "fetched", F.col("fetch_status") == "not_modified", F.col("evidence_status")
    a = o.agg(
        F.count(F.lit(1)).cast("double").alias("crawl_targets"), n(fetched).alias("pages_fetched"), n(unchanged).alias("pages_not_modified"), n(F.col("fetch_status").isNull()).alias("crawl_errors"), n(F.col("rating").isNotNull()).alias("recognized"),
        n(status == "verified").alias("verified"), n(status == "conflict").alias("conflicts"), F.count_distinct("recipe_id").cast("double").alias("configured_recipes"), F.max(t).alias("now"),
    )
    b = recipes(spark, sf_dir, "evidence_status").agg(F.count(F.lit(1)).cast("double").alias("ranked_recipes"), F.avg(F.coalesce("confidence", F.lit(0.0))).alias("mean_confidence"), n(F.col("evidence_status") == "legacy_unverified").alias("legacy_pending"))
    sources = o.filter("source is not null").groupBy("source").agg(F.max(t).alias("last_t"), F.max(F.when(fetched, t)).alias("last_ok")).crossJoin(F.broadcast(a.select("now")))
    last, now = F.col("last_t"), F.col("now")
    c = sources.agg(n(last >= now - DAY).alias("sources_checked_24h"), n(F.col("last_ok") >= now - DAY).alias("sources_successful_24h"), n(last < now - DAY).alias("sources_stale_24h"), n(last < now - 7 * DAY).alias("sources_stale_7d"))
    d = tracked_events(spark, sf_dir).agg(n(F.col("type") == "dom_structure_changed").alias("dom_changes"), n(F.col("type") == "schema_structure_changed").alias("schema_changes"))
    e = coverage(spark, sf_dir).agg(F.avg("targets").alias("mean_targets"), F.expr("percentile_disc(0.95) within group (order by targets)").cast("double").alias("p95_targets"))
    wide = a.crossJoin(F.broadcast(b)).crossJoin(F.broadcast(c)).crossJoin(F.broadcast(d)).crossJoin(F.broadcast(e))
    ok = F.greatest(F.lit(1.0), F.col("pages_fetched") + F.col("pages_not_modified"))
    rates = {
        "fetch_success_rate": (F.col("pages_fetched") + F.col("pages_not_modified")) / F.greatest(F.lit(1.0), "crawl_targets"), "extract_success_rate": F.col("recognized") / ok, "verification_rate": F.col("verified") / ok,
        "conflict_rate": F.col("conflicts") / F.greatest(F.lit(1.0), "crawl_targets"), "ranking_eligible_rate": F.col("ranked_recipes") / F.greatest(F.lit(1.0), "configured_recipes"),
    }
    long = wide.withColumns(rates).select(*_METRICS).unpivot([], _METRICS, "metric", "value")
    limit = {"fetch_success_rate": (F.col("value") < 0.9, "below 0.9"), "extract_success_rate": (F.col("value") < 0.8, "below 0.8"), "conflict_rate": (F.col("value") > 0.05, "above 0.05")}
    alert = F.coalesce(*[F.when((F.col("metric") == m) & cond, text) for m, (cond, text) in limit.items()])
    return long.withColumn("alert", alert).withColumn("value", F.round("value", 6))


@query(
    "robustness_summary",
    _SIM
    + ", c AS (SELECT scenario, coalesce(covar_pop(b.rank, s.rank) / nullif(stddev_pop(b.rank) * stddev_pop(s.rank), 0), 1.0) AS correlation FROM b JOIN s USING (id) WHERE b.rank <= 200 GROUP BY 1),"
    " v AS (SELECT scenario, count(*) FILTER (WHERE b.rank <= 10 AND s.rank <= 10) / 10.0 AS t10, count(*) FILTER (WHERE b.rank <= 50 AND s.rank <= 50) / 50.0 AS t50 FROM b JOIN s USING (id) GROUP BY 1)"
    " SELECT count(*) AS scenarios, round(avg(correlation), 6) AS mean_correlation, round(min(correlation), 6) AS least_correlation, round(avg(t10), 6)::DOUBLE AS mean_top10_overlap, round(avg(t50), 6)::DOUBLE AS mean_top50_overlap FROM v LEFT JOIN c USING (scenario)",
)
def robustness_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row over all scenarios; correlations that are null are skipped."""
    base, simulated = _simulated(spark, sf_dir)
    base, simulated = checkpointed(base), checkpointed(simulated)
    both = base.withColumnRenamed("rank", "x").join(simulated, "id")
    overlap = both.groupBy("scenario").agg(*[(F.count_if((F.col("x") <= k) & (F.col("rank") <= k)) / k).alias(f"t{k}") for k in (10, 50)])
    rows = overlap.join(S.rank_correlation(base, simulated, 200), "scenario", "left")
    return _r(rows.agg(F.count(F.lit(1)).alias("scenarios"), F.avg("correlation").alias("mean_correlation"), F.min("correlation").alias("least_correlation"), F.avg("t10").alias("mean_top10_overlap"), F.avg("t50").alias("mean_top50_overlap")), "mean_correlation", "least_correlation", "mean_top10_overlap", "mean_top50_overlap")


@query(
    "historical_metrics",
    f"WITH {READINGS}, {SNAPSHOTS}, a AS (SELECT key, arg_max({{'t': t, 'r': rating, 'n': n}}, t) AS c, arg_min({{'t': t, 'r': rating, 'n': n}}, t) FILTER (WHERE t >= {NOW} - 7 * {DAY}) AS d7, arg_min({{'t': t, 'r': rating, 'n': n}}, t) FILTER (WHERE t >= {NOW} - 30 * {DAY}) AS d30 FROM readings GROUP BY 1),"
    f" h AS (SELECT key, min(rank) AS peak, round(stddev_pop(rank), 6) AS volatility, count(*) AS snapshots FROM snapshots GROUP BY 1), pc AS (SELECT key, count(*) FILTER (WHERE moved) AS changes FROM (SELECT key, page_hash <> lag(page_hash) OVER (PARTITION BY key ORDER BY t) AS moved FROM readings WHERE t >= {NOW} - 30 * {DAY} AND coalesce(page_hash, '') <> '') GROUP BY 1)"
    " SELECT key, CASE WHEN d7.t < c.t THEN c.n - d7.n END AS growth_7d, CASE WHEN d30.t < c.t THEN c.n - d30.n END AS growth_30d, CASE WHEN d30.t < c.t THEN round(c.r - d30.r, 6) + 0.0 END AS trend_30d, changes, peak, volatility, snapshots FROM a FULL JOIN h USING (key) LEFT JOIN pc USING (key)",
)
def historical_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All figures of a recipe's past in one row, of recipes with readings or ranks. The log's state is written once."""
    o = checkpointed(readings(spark, sf_dir, "page_hash"))
    rows, now = _now(o)
    past = T.trailing_metrics(rows, now).select("key", "growth_7d", "growth_30d", "trend_30d")
    changes = T.value_changes(rows, "page_hash", now).select("key", "changes")
    ranks = T.rank_history(snapshots(spark, sf_dir)).select("key", "peak", "volatility", "snapshots")
    return _r(past.join(ranks, "key", "full").join(changes, "key", "left"), "trend_30d", "volatility")




@query("score_provenance")
def score_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How each score came about, as one line. (No SQL: the engines round halves of binary fractions differently.)"""
    parts = [F.round(c, 6) for c in (F.col("rating"), -F.col("bias"), F.col("posterior"), F.col("uncertainty"), F.col("evidence"), F.col("score"))]
    line = F.format_string("Raw %.3f; adjustment %+.3f; posterior %.3f; uncertainty -%.3f; evidence -%.3f; final %.3f.", *parts)
    return current_scores(spark, sf_dir).select("id", line.alias("provenance"))


@query("full_rank")
def full_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole ranking: duplicates reduced to their representatives, scores with the log's own calibration, ranks,
    their robustness over 36 scenarios, and each recipe's past beside them. (No SQL: titles are compared by a ratio that
    SQL lacks; the parts have SQL of their own.)"""
    whole = checkpointed(records(spark, sf_dir).filter("recipe_id is not null"))
    groups = D.duplicate_groups(whole)
    named = groups.join(whole.select("id", "recipe_id"), "id").withColumn("kept", F.col("id") == F.col("representative"))
    of = named.groupBy("recipe_id").agg(F.max("kept").alias("kept"), F.max(F.struct("confidence", "group_id", "members")).alias("g"))
    items = checkpointed(recipes(spark, sf_dir, "title", "url").join(of.filter("not kept").select(F.col("recipe_id").alias("id")), "id", "left_anti"))
    scored_items = S.ranked(S.score_items(items, [S.Params(), *S.robustness_grid()], checkpointed(calibrated(spark, sf_dir))))
    base = scored_items.filter("scenario = 0").drop("scenario")
    robust = S.rank_robustness(base.select("id", "rank"), scored_items.filter("scenario > 0").select("scenario", "id", "rank")).drop("rank")
    past = historical_metrics(spark, sf_dir).withColumnRenamed("key", "id").select("id", "growth_7d", "trend_30d", "peak")
    group = of.select(F.col("recipe_id").alias("id"), F.col("g.group_id").alias("duplicate_group_id"), F.col("g.members").alias("members"))
    out = base.join(robust, "id").join(items.select("id", "title", "url", "confidence"), "id").join(past, "id", "left").join(group, "id", "left")
    return _r(out, "prior", "expected", "m", "bias", "adjusted", "posterior", "uncertainty", "evidence", "score", "rank_stddev", "rank_confidence", "top10_frequency", "top50_frequency")


@query("expansion_metrics", "WITH e AS (SELECT vertical, upper(trim(new_state)) AS s, json_extract(metrics, '$.quality_score')::DOUBLE AS q, json_extract(metrics, '$.pages_fetched')::DOUBLE AS p FROM source_events) SELECT vertical, count(*) AS events, count(*) FILTER (WHERE s IN ('PROMOTED', 'ACTIVE')) AS promoted, round(count(*) FILTER (WHERE s IN ('PROMOTED', 'ACTIVE')) / nullif(count(*) FILTER (WHERE s IN ('PROMOTED', 'ACTIVE', 'REJECTED', 'QUARANTINED')), 0)::DOUBLE, 6) AS promotion_rate, round(median(q), 6) AS median_score, round(sum(p), 4) AS pages_fetched FROM e GROUP BY 1")
def expansion_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "source_events").select("vertical", F.upper(F.trim("new_state")).alias("s"), F.get_json_object("metrics", "$.quality_score").cast("double").alias("q"), F.get_json_object("metrics", "$.pages_fetched").cast("double").alias("p"))
    up = F.col("s").isin("PROMOTED", "ACTIVE")
    ended = F.col("s").isin("PROMOTED", "ACTIVE", "REJECTED", "QUARANTINED")
    return e.groupBy("vertical").agg(F.count(F.lit(1)).alias("events"), F.count_if(up).alias("promoted"), F.round(F.try_divide(F.count_if(up), F.count_if(ended)), 6).alias("promotion_rate"), F.round(F.median("q"), 6).alias("median_score"), F.round(F.sum("p"), 4).alias("pages_fetched"))


@query("hidden_set", "WITH e AS (SELECT user_id, event_type, event_id, ts, (SELECT max(ts) FROM events) AS now FROM events) SELECT e.user_id, count(*) AS hidden FROM e WHERE event_type = 'purchase' OR (event_type = 'click' AND ts >= now - INTERVAL 1 DAY) GROUP BY 1")
def hidden_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items a user does not want to see again: acted on at any time, or put off within the last day of the log."""
    e = table(spark, sf_dir, "events")
    now = e.agg(F.max("ts").alias("now"))
    recent = F.col("ts") >= F.col("now") - F.expr("interval 1 day")
    return e.crossJoin(F.broadcast(now)).filter((F.col("event_type") == "purchase") | ((F.col("event_type") == "click") & recent)).groupBy("user_id").agg(F.count(F.lit(1)).alias("hidden"))


@query("plan_window", "SELECT o_orderpriority AS slot, count(*) AS planned FROM orders WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 6 DAY GROUP BY 1")
def plan_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of the seven days that end with the latest one, by slot."""
    o = table(spark, sf_dir, "orders")
    last = o.agg(F.max("o_orderdate").alias("last"))
    return o.crossJoin(F.broadcast(last)).filter(F.col("o_orderdate") >= F.col("last") - F.expr("interval 6 days")).groupBy(F.col("o_orderpriority").alias("slot")).agg(F.count(F.lit(1)).alias("planned"))


@query("saved_search", f"WITH {SNAPSHOTS} SELECT board_id, run_id, key, rank FROM snapshots WHERE evidence_grade IN ('A+', 'A', 'B+') AND rank <= 100 AND contains(lower(source), 'ladle') AND score >= 4")
def saved_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored filter of the client: text, grade, rank and score together."""
    s = snapshots(spark, sf_dir)
    return s.filter(F.col("evidence_grade").isin("A+", "A", "B+") & (F.col("rank") <= 100) & F.lower("source").contains("ladle") & (F.col("score") >= 4)).select("board_id", "run_id", "key", "rank")


@query("category_sheet", f"WITH {RECIPES} SELECT id, title, source FROM recipes WHERE contains(lower(array_to_string(categories, ' | ')), 'chicken') ORDER BY rating DESC, n DESC, id LIMIT 100")
def category_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hundred best of one category, a report by a distributed top-k."""
    r = recipes(spark, sf_dir, "title").filter(F.lower(F.array_join("categories", " | ")).contains("chicken"))
    return r.orderBy(F.desc("rating"), F.desc("n"), "id").limit(100).select("id", "title", "source")


@query("app_projection", f"WITH {RECIPES} SELECT id, title, source, url, rating, n AS rating_count, confidence, coalesce(array_to_string(list_sort(categories), '|'), '') AS categories, evidence_status, coalesce(evidence_status = 'verified' AND confidence >= 0.8, false) AS trusted, histogram IS NOT NULL AND cardinality(histogram) > 0 AS has_histogram FROM recipes")
def app_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = recipes(spark, sf_dir, "title", "url", "evidence_status")
    return r.select(
        "id", "title", "source", "url", "rating", F.col("n").alias("rating_count"), "confidence", F.coalesce(F.array_join(F.array_sort("categories"), "|"), F.lit("")).alias("categories"), "evidence_status",
        F.coalesce((F.col("evidence_status") == "verified") & (F.col("confidence") >= 0.8), F.lit(False)).alias("trusted"), F.coalesce(F.size("histogram") > 0, F.lit(False)).alias("has_histogram"),
    )


@query("storage_health", "WITH d AS (SELECT fetch_status AS root, count(*) AS records, sum(length(url) + length(title)) AS characters, count(DISTINCT source) AS files FROM observations GROUP BY 1) SELECT root, records, characters, files, records >= 750000 OR characters >= 536870912 AS archive FROM d")
def storage_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records, characters and parts of each portion of the log, and whether it should go to the archive."""
    o = table(spark, sf_dir, "observations")
    d = o.groupBy(F.col("fetch_status").alias("root")).agg(F.count(F.lit(1)).alias("records"), F.sum(F.length("url") + F.length("title")).alias("characters"), F.count_distinct("source").alias("files"))
    return d.withColumn("archive", (F.col("records") >= 750_000) | (F.col("characters") >= 536_870_912))


@query("reading_age", f"WITH {RECIPES} SELECT id, round(coalesce(({NOW} - t) / {DAY}::DOUBLE, 9999), 6) AS age_days, round(coalesce(({NOW} - t) / 3600000000::DOUBLE, 1e9), 6) AS age_hours FROM recipes")
def reading_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, now = _now(recipes(spark, sf_dir))
    return rows.select("id", F.round(F.coalesce((now - F.col("t")) / DAY, F.lit(9999.0)), 6).alias("age_days"), F.round(F.coalesce((now - F.col("t")) / 3_600_000_000, F.lit(1e9)), 6).alias("age_hours"))


