"""Queries of the general data problems: snapshots, histories, units and spikes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.functions.url import normalize_domain
from brindle.operators.history import validity_periods
from brindle.operators.snapshots import same_to, snapshot_changes
from brindle.operators.spikes import implausible_readings
from brindle.operators.units import equal_amounts
from brindle.registry import query
from brindle.session import table

#: ISO text to an instant, for DuckDB.
SQL_INSTANT = "(CASE WHEN regexp_matches(trim(timestamp), '(Z|[+-][0-9]{2}:?[0-9]{2})$') THEN trim(timestamp) ELSE trim(timestamp) || 'Z' END)::TIMESTAMPTZ"

P2_SQL = f"""
WITH d AS (SELECT board_id, run_id, recipe_id, rank, round(hierarchical_score, 6) + 0.0 AS s, delivered_at, {SQL_INSTANT} AS t FROM rankings),
v AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY board_id, run_id, recipe_id ORDER BY delivered_at DESC NULLS LAST, rank DESC NULLS LAST, s DESC NULLS LAST) AS n FROM d) WHERE n = 1),
r AS (SELECT board_id, run_id, lead(run_id) OVER w AS nxt, row_number() OVER w AS k
      FROM (SELECT board_id, run_id, max(t) AS t FROM d GROUP BY 1, 2) WINDOW w AS (PARTITION BY board_id ORDER BY t NULLS FIRST, run_id NULLS FIRST)),
a AS (SELECT v.board_id, v.run_id, v.recipe_id, v.rank, v.s FROM v JOIN r USING (board_id, run_id) WHERE k > 1),
b AS (SELECT v.board_id, r.nxt AS run_id, v.recipe_id, v.rank, v.s FROM v JOIN r USING (board_id, run_id) WHERE nxt IS NOT NULL),
plus AS (SELECT * FROM a EXCEPT ALL SELECT * FROM b),
minus AS (SELECT * FROM b EXCEPT ALL SELECT * FROM a)
SELECT board_id, run_id, recipe_id, CASE WHEN m.hit IS NULL THEN 'added' WHEN p.hit IS NULL THEN 'removed' ELSE 'changed' END AS change_kind
FROM (SELECT *, 1 AS hit FROM plus) p FULL JOIN (SELECT *, 1 AS hit FROM minus) m USING (board_id, run_id, recipe_id)
"""

P3_SQL = f"""
WITH e AS (
  SELECT DISTINCT vertical, regexp_replace(rtrim(lower(trim(domain)), '.'), '^www\\.', '') AS domain, epoch_us({SQL_INSTANT}) AS t,
         nullif(upper(trim(previous_state)), '') AS p, upper(trim(new_state)) AS n
  FROM source_events WHERE trim(new_state) <> ''),
nodes AS (SELECT vertical, domain, t, n AS s, 1 AS w FROM e UNION ALL SELECT vertical, domain, t, p, -1 FROM e),
bal AS (SELECT vertical, domain, t, s, sum(w) AS w FROM nodes GROUP BY 1, 2, 3, 4),
st AS (SELECT vertical, domain, t, coalesce(max(s) FILTER (WHERE w > 0), CASE WHEN count(*) = 1 THEN min(s) END) AS state FROM bal GROUP BY 1, 2, 3),
ch AS (SELECT *, lag(state) OVER (PARTITION BY vertical, domain ORDER BY t) AS before FROM st WHERE state IS NOT NULL)
SELECT vertical, domain, state, t AS valid_from_us, coalesce(lead(t) OVER (PARTITION BY vertical, domain ORDER BY t), -1) AS valid_to_us
FROM ch WHERE before IS NULL OR before <> state
"""


@query("p2_found", P2_SQL)
def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = {"rank": F.col("rank"), "score": same_to(F.col("hierarchical_score"), 6)}
    return snapshot_changes(table(spark, sf_dir, "rankings"), "board_id", "run_id", "recipe_id", values, "timestamp", "delivered_at")


@query("p3_found", P3_SQL)
def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    entity = {"vertical": F.col("vertical"), "domain": normalize_domain(F.col("domain"))}
    return validity_periods(table(spark, sf_dir, "source_events"), entity, F.col("previous_state"), F.col("new_state"), F.col("timestamp"))


@query("p4_found")
def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = table(spark, sf_dir, "dedupe_pairs").select("pair_id", F.col("left_recipe.ingredients").alias("left_lines"), F.col("right_recipe.ingredients").alias("right_lines"))
    return equal_amounts(pairs, "pair_id", "left_lines", "right_lines")


@query("p5_found")
def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return implausible_readings(table(spark, sf_dir, "observations"), "obs_id", "recipe_id", "source", "timestamp", "rating", "rating_count")
