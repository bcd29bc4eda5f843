"""Queries of quality checks and run metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.bindings import coverage, readings
from brindle.functions.time import parse_micros
from brindle.operators import quality as Q
from brindle.operators.timeseries import HOUR_US, previous_values
from brindle.plans.problems import SQL_INSTANT
from brindle.plans.sql import COVERAGE, READINGS
from brindle.registry import query
from brindle.session import table

_PREV = f"WITH {READINGS}, p AS (SELECT key AS id, rating, n, evidence_confidence AS confidence, evidence_status AS status, lag(rating) OVER w AS pr, lag(n) OVER w AS pn, (t - lag(t) OVER w) / 3600000000.0 AS hours, row_number() OVER (PARTITION BY key ORDER BY t DESC) AS nth FROM readings WINDOW w AS (PARTITION BY key ORDER BY t))"


@query(
    "row_anomalies",
    _PREV + ", c AS (SELECT * FROM p) SELECT id, type, severity, count(*) AS found FROM ("
    " SELECT id, 'review_count_decrease' AS type, 'high' AS severity FROM c WHERE n < pn UNION ALL SELECT id, CASE WHEN hours <= 2 THEN 'hourly_review_count_spike' ELSE 'review_count_spike' END, 'medium' FROM c WHERE n >= pn AND pn > 0 AND n - pn > greatest(250.0, pn * 0.5)"
    " UNION ALL SELECT id, 'rating_shift', 'medium' FROM c WHERE round(abs(rating - pr), 9) >= 0.25 UNION ALL SELECT id, 'evidence_conflict', 'high' FROM c WHERE status = 'conflict' OR confidence < 0.60) GROUP BY ALL",
)
def row_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = readings(spark, sf_dir, "evidence_confidence", "evidence_status")
    p = previous_values(o).join(o.select("key", "t", F.col("evidence_confidence").alias("confidence"), F.col("evidence_status").alias("status")), ["key", "t"])
    rows = p.select(F.col("key").alias("id"), "rating", "n", "previous_rating", "previous_n", ((F.col("t") - F.col("previous_t")) / HOUR_US).alias("hours"), "confidence", "status")
    return Q.row_anomalies(rows).groupBy("id", "type", "severity").agg(F.count(F.lit(1)).alias("found"))


_RULES = {
    "recipe_id": "recipe_id <> ''", "source": "source <> ''", "url": "url <> ''", "title": "title <> ''", "rating": "rating BETWEEN 0 AND 5.05", "rating_count": "rating_count >= 0", "evidence_confidence": "evidence_confidence BETWEEN 0 AND 1",
    "evidence_status": "evidence_status IN ('verified', 'schema_only', 'visible_only', 'conflict', 'legacy_unverified')", "page_hash": "page_hash <> ''",
}


@query("contract_violations", " UNION ALL ".join(f"SELECT obs_id AS \"row\", '{n}' AS rule FROM observations WHERE NOT coalesce({c}, false)" for n, c in _RULES.items()))
def contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.violations(table(spark, sf_dir, "observations"), "obs_id", Q.observation_rules())


@query(
    "structure_changes",
    f"WITH o AS (SELECT recipe_id AS key, epoch_us({SQL_INSTANT}) AS t, obs_id, dom_fingerprint, schema_signature FROM observations), d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key, t ORDER BY obs_id DESC) AS nth FROM o) WHERE nth = 1)"
    " SELECT key, t, coalesce(lag(dom_fingerprint) OVER w <> '' AND dom_fingerprint <> '' AND lag(dom_fingerprint) OVER w <> dom_fingerprint, false) AS changed_dom_fingerprint, coalesce(lag(schema_signature) OVER w <> '' AND schema_signature <> '' AND lag(schema_signature) OVER w <> schema_signature, false) AS changed_schema_signature FROM d WINDOW w AS (PARTITION BY key ORDER BY t)",
)
def structure_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "observations").select(F.col("recipe_id").alias("key"), parse_micros(F.col("timestamp")).alias("t"), "obs_id", "dom_fingerprint", "schema_signature")
    d = o.groupBy("key", "t").agg(F.max_by(F.struct("dom_fingerprint", "schema_signature"), "obs_id").alias("r")).select("key", "t", "r.*")
    return Q.structure_changes(d, ["dom_fingerprint", "schema_signature"])


_HEALTH = f"WITH {COVERAGE}, h AS (SELECT source, max(run_day) AS last_checked, arg_max(status, run_day) AS last_status, count(*) AS runs, count(*) FILTER (WHERE status = 'ok') AS ok_runs, sum(targets) AS targets, sum(errors) AS errors, max(run_day) FILTER (WHERE status = 'ok') AS last_ok FROM coverage GROUP BY 1), hh AS (SELECT *, date_diff('day', last_checked, (SELECT max(run_day) FROM coverage)) AS age_days, ok_runs / runs::DOUBLE AS success_rate, errors / targets::DOUBLE AS error_rate FROM h)"


def _health(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = coverage(spark, sf_dir)
    now = c.agg(F.max("run_day").alias("now"))
    return Q.source_health(c, F.lit(now.first()["now"]))


@query("source_health", _HEALTH + " SELECT source, last_checked, last_status, runs, ok_runs, targets, errors, last_ok, age_days, round(success_rate, 6) AS success_rate, round(error_rate, 6) AS error_rate FROM hh")
def source_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _health(spark, sf_dir).withColumns({c: F.round(c, 6) for c in ("success_rate", "error_rate")})


@query(
    "health_rollup",
    _HEALTH + ", w AS (SELECT count(*)::DOUBLE AS sources, count(*) FILTER (WHERE last_status = 'ok')::DOUBLE AS healthy, count(*) FILTER (WHERE last_status = 'degraded')::DOUBLE AS degraded, sum(targets)::DOUBLE AS targets, sum(errors)::DOUBLE AS errors, avg(success_rate) AS mean_success_rate, median(error_rate) AS median_error_rate FROM hh)"
    " SELECT metric, round(value, 6) AS value FROM (UNPIVOT w ON sources, healthy, degraded, targets, errors, mean_success_rate, median_error_rate INTO NAME metric VALUE value)",
)
def health_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.health_rollup(_health(spark, sf_dir)).withColumn("value", F.round("value", 6))


@query("fetch_metrics", "SELECT source, count(*) AS rows, count(*) FILTER (WHERE fetch_status = 'fetched') AS fetched, count(*) FILTER (WHERE fetch_status = 'not_modified') AS not_modified, count(*) FILTER (WHERE rating IS NULL) AS without_rating, count(DISTINCT recipe_id) AS recipes FROM observations GROUP BY 1")
def fetch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "observations")
    return o.groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("fetch_status") == "fetched").alias("fetched"), F.count_if(F.col("fetch_status") == "not_modified").alias("not_modified"), F.count_if(F.col("rating").isNull()).alias("without_rating"), F.count_distinct("recipe_id").alias("recipes"))
