"""Checks on readings, contracts and runs, as tables of findings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def row_anomalies(current: DataFrame) -> DataFrame:
    """(id, type, severity) of (id, rating, n, previous_rating, previous_n, hours, confidence, status).

    A falling count; a jump by more than 250 and half the count, named hourly within two hours; a rating moved by a
    quarter star or more; conflicting or weak evidence. Null previous values find nothing.
    """
    delta = F.col("n") - F.col("previous_n")
    jump = (delta >= 0) & (F.col("previous_n") > 0) & (delta > F.greatest(F.lit(250.0), F.col("previous_n") * 0.5))
    rules = [
        ("review_count_decrease", "high", delta < 0),
        ("hourly_review_count_spike", "medium", jump & F.coalesce(F.col("hours") <= 2, F.lit(False))),
        ("review_count_spike", "medium", jump & ~F.coalesce(F.col("hours") <= 2, F.lit(False))),
        ("rating_shift", "medium", F.round(F.abs(F.col("rating") - F.col("previous_rating")), 9) >= 0.25),
        ("evidence_conflict", "high", (F.col("status") == "conflict") | (F.col("confidence") < 0.60)),
    ]
    found = F.filter(F.array(*[F.when(F.coalesce(cond, F.lit(False)), F.struct(F.lit(name).alias("type"), F.lit(level).alias("severity"))) for name, level, cond in rules]), lambda x: x.isNotNull())
    return current.select("id", F.explode(found).alias("f")).select("id", "f.type", "f.severity")


def violations(rows: DataFrame, row_id: str, rules: dict[str, Column]) -> DataFrame:
    """(row, rule): one row per broken rule of a contract; a rule that is null for a row is broken."""
    broken = F.filter(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]), lambda x: x.isNotNull())
    return rows.select(F.col(row_id).alias("row"), F.explode(broken).alias("rule"))


def assert_none(found: DataFrame, what: str) -> DataFrame:
    """Fails the query that reads the result if there are findings; else an empty table."""
    return found.filter(F.assert_true(F.lit(False), F.concat(F.lit(f"{what}: "), F.to_json(F.struct(*found.columns)))).isNull())


def observation_rules() -> dict[str, Column]:
    """The contract of a reading."""
    return {
        "recipe_id": F.col("recipe_id") != "", "source": F.col("source") != "", "url": F.col("url") != "", "title": F.col("title") != "",
        "rating": F.col("rating").between(0, 5.05), "rating_count": F.col("rating_count") >= 0, "evidence_confidence": F.col("evidence_confidence").between(0, 1),
        "evidence_status": F.col("evidence_status").isin("verified", "schema_only", "visible_only", "conflict", "legacy_unverified"), "page_hash": F.col("page_hash") != "",
    }


def structure_changes(readings: DataFrame, columns: list[str]) -> DataFrame:
    """Readings (key, t, ...) with changed_<column>: the value differs from the reading before, both non-empty."""
    w = Window.partitionBy("key").orderBy("t")

    def changed(c: str) -> Column:
        before, now = F.coalesce(F.lag(c).over(w), F.lit("")), F.coalesce(F.col(c), F.lit(""))
        return (before != "") & (now != "") & (before != now)

    return readings.select("key", "t", *[changed(c).alias(f"changed_{c}") for c in columns])


def source_health(runs: DataFrame, now: Column) -> DataFrame:
    """Per source of (source, run_day, targets, errors, status): latest check, age, success over its runs and totals."""
    agg = runs.groupBy("source").agg(
        F.max("run_day").alias("last_checked"), F.max_by("status", "run_day").alias("last_status"), F.count(F.lit(1)).alias("runs"), F.count_if(F.col("status") == "ok").alias("ok_runs"),
        F.sum("targets").alias("targets"), F.sum("errors").alias("errors"), F.max(F.when(F.col("status") == "ok", F.col("run_day"))).alias("last_ok"),
    )
    return agg.withColumn("age_days", F.datediff(now, "last_checked")).withColumn("success_rate", F.try_divide("ok_runs", "runs")).withColumn("error_rate", F.try_divide("errors", "targets"))


def health_rollup(health: DataFrame) -> DataFrame:
    """(metric, value): the fleet's figures, one row each."""
    wide = health.agg(
        F.count(F.lit(1)).cast("double").alias("sources"), F.count_if(F.col("last_status") == "ok").cast("double").alias("healthy"), F.count_if(F.col("last_status") == "degraded").cast("double").alias("degraded"),
        F.sum("targets").cast("double").alias("targets"), F.sum("errors").cast("double").alias("errors"), F.avg("success_rate").alias("mean_success_rate"), F.median("error_rate").alias("median_error_rate"),
    )
    return wide.unpivot([], wide.columns, "metric", "value")
