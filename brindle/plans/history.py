"""Queries over the reading log and the ranking snapshots in time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brindle.bindings import coverage, readings, recipes, snapshots
from brindle.operators import timeseries as T
from brindle.operators.score import volume_bucket
from brindle.plans.sql import BUCKET as SQL_BUCKET
from brindle.plans.sql import COVERAGE, DAY, NOW, READINGS, RECIPES, SNAPSHOTS, WALK
from brindle.registry import query

BUCKETS = ["0-24", "25-99", "100-499", "500-1999", "2000+"]


def _r(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) + F.lit(0.0) for c in columns})


def _now(o: DataFrame) -> tuple[DataFrame, Column]:
    """Readings with the latest instant of the log beside each, by a one-row broadcast."""
    return o.crossJoin(F.broadcast(o.agg(F.max("t").alias("now")))), F.col("now")


@query("previous_value", f"WITH {READINGS} SELECT key, t, rating, n, lag(rating) OVER w AS previous_rating, lag(n) OVER w AS previous_n, lag(t) OVER w AS previous_t FROM readings WINDOW w AS (PARTITION BY key ORDER BY t)")
def previous_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.previous_values(readings(spark, sf_dir))


@query(
    "velocity",
    f"WITH {READINGS}, p AS (SELECT key, t, n, lag(n) OVER w AS pn, lag(t) OVER w AS pt, row_number() OVER (PARTITION BY key ORDER BY t DESC) AS nth FROM readings WINDOW w AS (PARTITION BY key ORDER BY t))"
    f" SELECT key, n - pn AS grown, round((n - pn) / ((t - pt) / {DAY}::DOUBLE), 6) + 0.0 AS per_day FROM p WHERE nth = 1",
)
def velocity(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = T.previous_values(readings(spark, sf_dir))
    last = p.groupBy("key").agg(F.max_by(F.struct("n", "previous_n", "t", "previous_t"), "t").alias("r"))
    grown = F.col("r.n") - F.col("r.previous_n")
    return _r(last.select("key", grown.alias("grown"), (grown / ((F.col("r.t") - F.col("r.previous_t")) / DAY)).alias("per_day")), "per_day")


PAIRS_SQL = f"WITH RECURSIVE {READINGS}, {WALK}"


@query("empirical_pairs", PAIRS_SQL + " SELECT key, from_t, to_t, top AS n, round(delta, 6) + 0.0 AS delta FROM walk WHERE to_t IS NOT NULL")
def empirical_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _r(T.anchored_pairs(readings(spark, sf_dir)), "delta")


def calibrated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per volume bucket, how much ratings move between independent readings of the whole log."""
    pairs = T.anchored_pairs(readings(spark, sf_dir)).withColumn("bucket", volume_bucket(F.col("n")))
    return T.calibration(pairs, spark.createDataFrame([(b,) for b in BUCKETS], "bucket string"))


@query(
    "empirical_calibration",
    PAIRS_SQL + f", p AS (SELECT key, from_t, to_t, top AS n, delta FROM walk WHERE to_t IS NOT NULL), s AS (SELECT {SQL_BUCKET} AS bucket, count(*) AS pairs, count(DISTINCT key) AS keys, (max(to_t) - min(from_t)) / {DAY}::DOUBLE AS span,"
    " min(to_t - from_t) / 3600000000::DOUBLE AS gap, sqrt(avg(delta * delta)) AS rmse, CASE WHEN count(*) > 1 THEN stddev_pop(delta) ELSE max(abs(delta)) END AS sigma FROM p GROUP BY 1)"
    " SELECT b.bucket, coalesce(pairs, 0) AS pairs, coalesce(keys, 0) AS keys, round(coalesce(span, 0), 6) AS span_days, round(gap, 6) AS least_gap_hours, round(rmse, 6) AS rmse, round(sigma, 6) AS sigma, round(least(0.25, 1.96 * rmse), 6) AS penalty,"
    " coalesce(pairs, 0) >= 30 AND coalesce(keys, 0) >= 10 AND coalesce(span, 0) >= 21 AS ready FROM (SELECT unnest(['0-24', '25-99', '100-499', '500-1999', '2000+']) AS bucket) b LEFT JOIN s USING (bucket)",
)
def empirical_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _r(calibrated(spark, sf_dir), "span_days", "least_gap_hours", "rmse", "sigma", "penalty")


def _since(days: int) -> str:
    return f"arg_min({{'t': t, 'r': rating, 'n': n}}, t) FILTER (WHERE t >= {NOW} - {days} * {DAY})"


@query(
    "trailing_growth",
    f"WITH {READINGS}, a AS (SELECT key, arg_max({{'t': t, 'r': rating, 'n': n}}, t) AS c, {_since(7)} AS d7, {_since(14)} AS d14, {_since(30)} AS d30 FROM readings GROUP BY 1),"
    f" v AS (SELECT *, CASE WHEN d7.t < c.t THEN (c.n - d7.n) / ((c.t - d7.t) / {DAY}::DOUBLE) END AS v7, CASE WHEN d14.t < d7.t THEN (d7.n - d14.n) / ((d7.t - d14.t) / {DAY}::DOUBLE) END AS vb FROM a)"
    " SELECT key, CASE WHEN d7.t < c.t THEN c.n - d7.n END AS growth_7d, CASE WHEN d30.t < c.t THEN c.n - d30.n END AS growth_30d, CASE WHEN d30.t < c.t THEN round(c.r - d30.r, 6) + 0.0 END AS trend_30d,"
    " round(v7, 6) + 0.0 AS velocity_7d, round(vb, 6) + 0.0 AS velocity_before, round(v7 - vb, 6) + 0.0 AS acceleration FROM v",
)
def trailing_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, now = _now(readings(spark, sf_dir))
    return _r(T.trailing_metrics(rows, now), "trend_30d", "velocity_7d", "velocity_before", "acceleration")


@query(
    "trailing_slopes",
    f"WITH {READINGS}, w AS (SELECT key, (t - {NOW}) / {DAY}::DOUBLE AS x, rating, n FROM readings WHERE t >= {NOW} - 30 * {DAY}), c AS (SELECT key, x - avg(x) OVER p AS dx, rating - avg(rating) OVER p AS dr, n - avg(n) OVER p AS dn FROM w WINDOW p AS (PARTITION BY key))"
    " SELECT key, round(sum(dx * dr) / nullif(sum(dx * dx), 0), 5) + 0.0 AS rating_slope, round(sum(dx * dn) / nullif(sum(dx * dx), 0), 5) + 0.0 AS count_slope FROM c GROUP BY 1",
)
def trailing_slopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, now = _now(readings(spark, sf_dir))
    return T.trailing_slopes(rows, now).withColumns({c: F.round(c, 5) + F.lit(0.0) for c in ("rating_slope", "count_slope")})


@query(
    "page_changes",
    f"WITH {READINGS}, c AS (SELECT key, t, page_hash <> lag(page_hash) OVER (PARTITION BY key ORDER BY t) AS moved FROM readings WHERE t >= {NOW} - 30 * {DAY} AND coalesce(page_hash, '') <> '')"
    " SELECT key, count(*) FILTER (WHERE moved) AS changes, max(t) FILTER (WHERE moved) AS last_change FROM c GROUP BY 1",
)
def page_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, now = _now(readings(spark, sf_dir, "page_hash"))
    return T.value_changes(rows, "page_hash", now)


@query(
    "change_point",
    f"WITH {READINGS}, c AS (SELECT key, rating, row_number() OVER (PARTITION BY key ORDER BY t DESC) AS i FROM readings WHERE t >= {NOW} - 30 * {DAY}), s AS (SELECT key, avg(rating) FILTER (WHERE i <= 3) - avg(rating) FILTER (WHERE i BETWEEN 4 AND 6) AS shift, count(*) AS c FROM c WHERE i <= 6 GROUP BY 1)"
    " SELECT key, round(shift, 6) + 0.0 AS shift, round(abs(shift), 9) >= 0.05 AS is_change FROM s WHERE c = 6",
)
def change_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, now = _now(readings(spark, sf_dir))
    found = T.change_points(rows, now)
    return _r(found.withColumn("is_change", F.round(F.abs("shift"), 9) >= 0.05), "shift")


@query(
    "rank_history",
    f"WITH {SNAPSHOTS} SELECT key, min(rank) AS peak, round(stddev_pop(rank), 6) AS volatility, count(DISTINCT CASE WHEN rank <= 10 THEN t // {DAY} END) AS days_in_top10, count(DISTINCT CASE WHEN rank <= 50 THEN t // {DAY} END) AS days_in_top50, count(*) AS snapshots FROM snapshots GROUP BY 1",
)
def rank_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _r(T.rank_history(snapshots(spark, sf_dir)), "volatility")


def _cutoffs(spark: SparkSession, sf_dir: str, count: int = 6) -> DataFrame:
    """Evenly spaced instants between the first and the last reading; two numbers come to the driver."""
    low, high = readings(spark, sf_dir).agg(F.min("t"), F.max("t")).first()
    low, high = low or 0, high or 0
    return spark.createDataFrame([(low + (high - low) * i // (count + 1),) for i in range(1, count + 1)], "cutoff bigint")


CUTS = f"cuts AS (SELECT lo + (hi - lo) * i // 7 AS cutoff FROM (SELECT min(t) AS lo, max(t) AS hi FROM readings), (SELECT unnest([1, 2, 3, 4, 5, 6]) AS i))"


@query("asof_snapshot", f"WITH {READINGS}, {CUTS} SELECT cutoff, key, t, rating, n FROM (SELECT c.cutoff, r.*, row_number() OVER (PARTITION BY c.cutoff, r.key ORDER BY r.t DESC) AS nth FROM cuts c JOIN readings r ON r.t <= c.cutoff) WHERE nth = 1")
def asof_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.as_of(readings(spark, sf_dir), _cutoffs(spark, sf_dir))


@query(
    "nearest_future",
    f"WITH {READINGS}, {CUTS} SELECT cutoff AS target, key, t, rating, n FROM (SELECT c.cutoff, r.*, row_number() OVER (PARTITION BY c.cutoff, r.key ORDER BY r.t) AS nth FROM cuts c JOIN readings r ON r.t BETWEEN c.cutoff AND c.cutoff + 10 * {DAY} AND r.n >= 250) WHERE nth = 1",
)
def nearest_future(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.nearest_after(readings(spark, sf_dir), _cutoffs(spark, sf_dir).toDF("target"), 10 * DAY, 250)


@query(
    "run_streaks",
    f"WITH {COVERAGE}, s AS (SELECT source, status = 'ok' AS ok, run_day, row_number() OVER (PARTITION BY source ORDER BY run_day DESC) AS i, row_number() OVER (PARTITION BY source, status = 'ok' ORDER BY run_day DESC) AS j FROM coverage)"
    " SELECT source AS key, ok, count(*) AS length FROM s WHERE i = j GROUP BY 1, 2",
)
def run_streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.latest_streaks(coverage(spark, sf_dir).select(F.col("source").alias("key"), F.col("run_day").alias("t"), (F.col("status") == "ok").alias("ok")))


@query(
    "source_daily_window",
    f"WITH {COVERAGE} SELECT source, run_day, targets, sum(targets) OVER w AS targets_7d, round(avg(errors) OVER w, 6) AS errors_7d FROM coverage WINDOW w AS (PARTITION BY source ORDER BY run_day RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)",
)
def source_daily_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    week = Window.partitionBy("source").orderBy(F.unix_date("run_day")).rangeBetween(-6, 0)
    return coverage(spark, sf_dir).select("source", "run_day", "targets", F.sum("targets").over(week).alias("targets_7d"), F.round(F.avg("errors").over(week), 6).alias("errors_7d"))


@query("history_span", f"WITH {READINGS} SELECT source, count(*) AS readings, count(DISTINCT key) AS recipes, round((max(t) - min(t)) / {DAY}::DOUBLE, 6) AS days FROM readings GROUP BY 1")
def history_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings(spark, sf_dir, "source").groupBy("source").agg(F.count(F.lit(1)).alias("readings"), F.count_distinct("key").alias("recipes"), F.round((F.max("t") - F.min("t")) / DAY, 6).alias("days"))


@query(
    "rank_movement",
    f"WITH {SNAPSHOTS}, r AS (SELECT board_id, run_id, lag(run_id) OVER (PARTITION BY board_id ORDER BY t, run_id) AS prev FROM (SELECT board_id, run_id, max(t) AS t FROM snapshots GROUP BY 1, 2))"
    " SELECT s.board_id, s.run_id, s.key, s.rank, p.rank AS previous_rank, p.rank - s.rank AS movement FROM snapshots s JOIN r USING (board_id, run_id) LEFT JOIN snapshots p ON p.board_id = s.board_id AND p.run_id = r.prev AND p.key = s.key",
)
def rank_movement(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = snapshots(spark, sf_dir)
    runs = s.groupBy("board_id", "run_id").agg(F.max("t").alias("rt")).withColumn("prev", F.lag("run_id").over(Window.partitionBy("board_id").orderBy("rt", "run_id"))).drop("rt")
    before = s.select("board_id", F.col("run_id").alias("prev"), "key", F.col("rank").alias("previous_rank"))
    return s.join(runs, ["board_id", "run_id"]).join(before, ["board_id", "prev", "key"], "left").select("board_id", "run_id", "key", "rank", "previous_rank", (F.col("previous_rank") - F.col("rank")).alias("movement"))


@query(
    "evidence_grade",
    f"WITH {RECIPES}, a AS (SELECT *, ({NOW} - t) / {DAY}::DOUBLE AS age, coalesce(confidence, 0.60) AS c FROM recipes)"
    " SELECT id, CASE WHEN evidence_status = 'conflict' OR c < 0.60 THEN 'F' WHEN evidence_status = 'legacy_unverified' THEN 'C-' WHEN evidence_status = 'verified' AND c >= 0.95 AND n >= 1000 AND age <= 7 THEN 'A+' WHEN evidence_status = 'verified' AND c >= 0.95 AND n >= 250 AND age <= 14 THEN 'A'"
    " WHEN c >= 0.80 AND n >= 100 AND age <= 14 THEN 'B+' WHEN c >= 0.65 AND n >= 50 AND age <= 14 THEN 'B' WHEN age <= 30 THEN 'C' ELSE 'D' END AS grade FROM a",
)
def evidence_grade(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, now = _now(recipes(spark, sf_dir, "evidence_status"))
    c, n, s = F.coalesce("confidence", F.lit(0.60)), F.col("n"), F.coalesce("evidence_status", F.lit(""))
    age = (now - F.col("t")) / DAY
    grade = (
        F.when((s == "conflict") | (c < 0.60), "F").when(s == "legacy_unverified", "C-").when((s == "verified") & (c >= 0.95) & (n >= 1000) & (age <= 7), "A+")
        .when((s == "verified") & (c >= 0.95) & (n >= 250) & (age <= 14), "A").when((c >= 0.80) & (n >= 100) & (age <= 14), "B+").when((c >= 0.65) & (n >= 50) & (age <= 14), "B").when(age <= 30, "C").otherwise("D")
    )
    return rows.select("id", grade.alias("grade"))
