"""Domain views over the tables; the only place that knows the tables' names and columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brindle.functions.time import parse_micros
from brindle.session import table

#: Readings with values outside these bounds are no evidence.
RATING_BOUNDS = (0.0, 5.05)
COUNT_BOUNDS = (1, 99_999_999)


def _valid(spark: SparkSession, sf_dir: str, fields: list[str]) -> DataFrame:
    o = table(spark, sf_dir, "observations")
    rows = o.select(F.col("recipe_id").alias("key"), parse_micros(F.col("timestamp")).alias("t"), "obs_id", "rating", F.col("rating_count").alias("n"), *fields)
    return rows.filter(F.col("key").isNotNull() & F.col("t").isNotNull() & F.col("rating").between(*RATING_BOUNDS) & F.col("n").between(*COUNT_BOUNDS))


def readings(spark: SparkSession, sf_dir: str, *fields: str) -> DataFrame:
    """One row per recipe and instant with possible values, of repeated deliveries the last; with further fields of
    the log where they are asked for, so that no unused column is carried through the shuffle."""
    best = F.max_by(F.struct("rating", "n", *fields), F.col("obs_id")).alias("r")
    return _valid(spark, sf_dir, list(fields)).groupBy("key", "t").agg(best).select("key", "t", "r.*")


def recipes(spark: SparkSession, sf_dir: str, *fields: str) -> DataFrame:
    """The current state: the latest possible reading of every recipe, as the scorer's items. One aggregate that
    combines before the shuffle, whatever the readings of a recipe."""
    names = ["source", "evidence_confidence", "categories", "rating_histogram", *fields]
    last = _valid(spark, sf_dir, names).groupBy("key").agg(F.max_by(F.struct("t", "rating", "n", *names), F.struct("t", "obs_id")).alias("r"))
    return last.select(F.col("key").alias("id"), "r.source", "r.rating", "r.n", F.col("r.evidence_confidence").alias("confidence"), "r.categories", F.col("r.rating_histogram").alias("histogram"), "r.t", *[f"r.{f}" for f in fields])


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranked rows of every run, the last delivery of each."""
    r = table(spark, sf_dir, "rankings").select("board_id", "run_id", F.col("recipe_id").alias("key"), parse_micros(F.col("timestamp")).alias("t"), "rank", "hierarchical_score", "source", "rating", "rating_count", "evidence_grade", "delivered_at")
    best = F.max(F.struct("delivered_at", "rank", "hierarchical_score", "t", "source", "rating", "rating_count", "evidence_grade")).alias("r")
    return r.groupBy("board_id", "run_id", "key").agg(best).select("board_id", "run_id", "key", "r.t", "r.rank", F.col("r.hierarchical_score").alias("score"), "r.source", "r.rating", "r.rating_count", "r.evidence_grade")


def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source, run_day, targets, errors, status): one row per event type and day of the events table."""
    e = table(spark, sf_dir, "events")
    cells = e.groupBy(F.col("event_type").alias("source"), F.to_date("ts").alias("run_day")).agg(F.count(F.lit(1)).alias("targets"), F.count_if(F.col("value") < 5).alias("errors"))
    return cells.withColumn("status", F.when(100 * F.col("errors") > 12 * F.col("targets"), "degraded").otherwise("ok"))


def latest_per(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(order)))
    return df.withColumn("_nth", nth).filter("_nth = 1").drop("_nth")
