"""Shared pieces of the DuckDB texts."""

from __future__ import annotations

from brindle.plans.problems import SQL_INSTANT

DAY = 86400000000

READINGS = f"""
o AS (SELECT recipe_id AS key, epoch_us({SQL_INSTANT}) AS t, obs_id, rating, rating_count AS n, source, url, title, evidence_confidence, evidence_status, page_hash, categories, rating_histogram FROM observations),
readings AS (SELECT * EXCLUDE (nth) FROM (SELECT *, row_number() OVER (PARTITION BY key, t ORDER BY obs_id DESC) AS nth FROM o
    WHERE key IS NOT NULL AND t IS NOT NULL AND rating BETWEEN 0 AND 5.05 AND n BETWEEN 1 AND 99999999) WHERE nth = 1)"""
RECIPES = READINGS + """,
recipes AS (SELECT key AS id, source, rating, n, evidence_confidence AS confidence, categories, rating_histogram AS histogram, t, title, url, evidence_status
    FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY t DESC) AS nth FROM readings) WHERE nth = 1)"""
SNAPSHOTS = f"""
sr AS (SELECT board_id, run_id, recipe_id AS key, epoch_us({SQL_INSTANT}) AS t, rank, hierarchical_score AS score, source, rating, rating_count, evidence_grade, delivered_at FROM rankings),
snapshots AS (SELECT * EXCLUDE (nth) FROM (SELECT *, row_number() OVER (PARTITION BY board_id, run_id, key ORDER BY delivered_at DESC, rank DESC NULLS LAST, score DESC NULLS LAST, t DESC) AS nth FROM sr) WHERE nth = 1)"""
NOW = "(SELECT max(t) FROM readings)"
COVERAGE = """
coverage AS (SELECT *, CASE WHEN 100 * errors > 12 * targets THEN 'degraded' ELSE 'ok' END AS status FROM
    (SELECT event_type AS source, CAST(ts AS DATE) AS run_day, count(*) AS targets, count(*) FILTER (WHERE value < 5) AS errors FROM events GROUP BY 1, 2))"""
BASE = RECIPES + """,
wt AS (SELECT *, sqrt(greatest(1, n)::DOUBLE) AS w FROM recipes),
g AS (SELECT sum(rating * w) / greatest(1e-9, sum(w)) AS prior FROM wt),
ec AS (SELECT id, rating, w, unnest(list_distinct(categories)) AS category FROM wt),
cb AS (SELECT category, count(*) AS k, sum(rating * w) / greatest(1e-9, sum(w)) AS raw FROM ec WHERE category IS NOT NULL GROUP BY 1),
cbase AS (SELECT category, k, raw, k / (k + 20.0) * raw + 20.0 / (k + 20.0) * prior AS base FROM cb, g),
em AS (SELECT id, avg(base) AS mean FROM ec JOIN cbase USING (category) GROUP BY 1),
ex AS (SELECT wt.*, prior, coalesce(mean, prior) AS expected FROM wt LEFT JOIN em USING (id), g),
sb AS (SELECT source, count(*) AS k, count(*) / (count(*) + 20.0) * (sum((rating - expected) * w) / greatest(1e-9, sum(w))) AS shrunk FROM ex GROUP BY 1),
vp AS (SELECT quantile_cont(n::DOUBLE, 0.6) AS volume FROM recipes),
hist AS (SELECT id, sum(c) AS tot, CASE WHEN sum(c) > 1 THEN greatest(0.0, (sum(s * s * c) - sum(c) * (sum(s * c) / sum(c)) * (sum(s * c) / sum(c))) / greatest(1.0, sum(c) - 1)) END AS spread
    FROM (SELECT id, TRY_CAST(e.key AS DOUBLE) AS s, e.value::DOUBLE AS c FROM (SELECT id, unnest(map_entries(histogram)) AS e FROM recipes)) WHERE s IS NOT NULL AND c IS NOT NULL GROUP BY 1)"""


WALK = f"""
nth AS (SELECT key, t, rating, n, row_number() OVER (PARTITION BY key ORDER BY t) AS i FROM readings),
walk AS (SELECT key, i, t AS at, rating AS ar, n AS an, NULL::BIGINT AS from_t, NULL::BIGINT AS to_t, NULL::BIGINT AS top, NULL::DOUBLE AS delta FROM nth WHERE i = 1
  UNION ALL SELECT w.key, x.i, CASE WHEN ok THEN x.t ELSE w.at END, CASE WHEN ok THEN x.rating ELSE w.ar END, CASE WHEN ok THEN x.n ELSE w.an END,
    CASE WHEN ok THEN w.at END, CASE WHEN ok THEN x.t END, CASE WHEN ok THEN greatest(w.an, x.n) END, CASE WHEN ok THEN x.rating - w.ar END
  FROM walk w JOIN (SELECT * FROM nth) x ON x.key = w.key AND x.i = w.i + 1, LATERAL (SELECT x.t - w.at >= {DAY} AND x.n > w.an AS ok))"""
BUCKET = "CASE WHEN n <= 24 THEN '0-24' WHEN n <= 99 THEN '25-99' WHEN n <= 499 THEN '100-499' WHEN n <= 1999 THEN '500-1999' ELSE '2000+' END"
#: Penalty of each volume bucket whose history is ready.
READY = WALK + f""",
ap AS (SELECT key, from_t, to_t, top AS n, delta FROM walk WHERE to_t IS NOT NULL),
ready AS (SELECT {BUCKET} AS bucket, least(0.25, 1.96 * sqrt(avg(delta * delta))) AS penalty FROM ap GROUP BY 1 HAVING count(*) >= 30 AND count(DISTINCT key) >= 10 AND (max(to_t) - min(from_t)) / {DAY}::DOUBLE >= 21)"""
ITEMS = "SELECT 0::BIGINT AS cutoff, id, source, rating, n, confidence, categories, histogram FROM recipes"


def scored(grid: str, items: str = ITEMS, quantiles: tuple[float, ...] = (0.6,), head: str = RECIPES + "," + READY, empirical: bool = True) -> str:
    """CTEs that end in rk: all items of each cutoff under the parameter rows of grid (scenario, mult, cap_b, scale_e,
    cap_u, pc, ps, q), ranked. head gives the tables that items reads, and ready if empirical."""
    qs = f"[{', '.join(map(str, quantiles))}]"
    ready = f"LEFT JOIN ready ON ready.bucket = {BUCKET}" if empirical else "CROSS JOIN (SELECT NULL::DOUBLE AS penalty) AS ready"
    return head + f""",
grid AS ({grid}), it AS ({items}),
wt AS (SELECT *, sqrt(greatest(1, n)::DOUBLE) AS w FROM it),
g AS (SELECT cutoff, sum(rating * w) / greatest(1e-9, sum(w)) AS prior FROM wt GROUP BY 1),
vq AS (SELECT cutoff, unnest({qs}::DOUBLE[]) AS q, unnest(quantile_cont(n::DOUBLE, {qs})) AS volume FROM it GROUP BY 1),
ec AS (SELECT cutoff, id, rating, w, unnest(list_distinct(categories)) AS category FROM wt),
cb AS (SELECT cutoff, category, count(*) AS k, sum(rating * w) / greatest(1e-9, sum(w)) AS raw FROM ec WHERE category IS NOT NULL GROUP BY ALL),
pcs AS (SELECT DISTINCT pc FROM grid),
cbase AS (SELECT cutoff, category, pc, k / (k + pc) * raw + pc / (k + pc) * prior AS base FROM cb JOIN g USING (cutoff), pcs),
em AS (SELECT cutoff, id, pc, avg(base) AS mean FROM ec JOIN cbase USING (cutoff, category) GROUP BY ALL),
ex AS (SELECT wp.*, prior, coalesce(mean, prior) AS expected FROM (SELECT * FROM wt, pcs) wp LEFT JOIN em USING (cutoff, id, pc) JOIN g USING (cutoff)),
sb AS (SELECT cutoff, source, pc, count(*) AS k, sum((rating - expected) * w) / greatest(1e-9, sum(w)) AS rho FROM ex GROUP BY ALL),
hist AS (SELECT cutoff, id, sum(c) AS tot, CASE WHEN sum(c) > 1 THEN greatest(0.0, (sum(s * s * c) - sum(c) * (sum(s * c) / sum(c)) * (sum(s * c) / sum(c))) / greatest(1.0, sum(c) - 1)) END AS spread
    FROM (SELECT cutoff, id, TRY_CAST(e.key AS DOUBLE) AS s, e.value::DOUBLE AS c FROM (SELECT cutoff, id, unnest(map_entries(histogram)) AS e FROM it)) WHERE s IS NOT NULL AND c IS NOT NULL GROUP BY ALL),
s1 AS (SELECT grid.*, cutoff, ex.id, source, ex.rating, ex.n, ex.confidence, ex.prior, ex.expected, spread, greatest(1.0, greatest(50.0, volume) * mult) AS m, greatest(-cap_b, least(cap_b, sb.k / (sb.k + ps) * rho)) AS bias
    FROM ex JOIN sb USING (cutoff, source, pc) JOIN grid USING (pc) JOIN vq USING (cutoff, q) LEFT JOIN hist USING (cutoff, id)),
s2 AS (SELECT s1.*, greatest(0.0, least(5.0, rating - bias)) AS adjusted, least(cap_u, 1.96 * 2.5 / sqrt(greatest(1.0, n + m))) AS theory, greatest(0.0, 0.80 - coalesce(confidence, 0.60)) * scale_e AS evidence, ready.penalty AS empirical FROM s1 {ready}),
s3 AS (SELECT *, least(cap_u, coalesce(1.96 * sqrt(spread / greatest(1.0, n + m)), greatest(CASE WHEN empirical IS NOT NULL THEN empirical END, CASE WHEN empirical IS NOT NULL THEN 0.25 * theory END), theory)) AS uncertainty,
    n / (n + m) * adjusted + m / (n + m) * prior AS posterior FROM s2),
sc AS (SELECT *, greatest(0.0, posterior - uncertainty - evidence) AS score FROM s3),
rk AS (SELECT *, row_number() OVER (PARTITION BY cutoff, scenario ORDER BY round(score, 9) DESC, n DESC, id) AS rank FROM sc)"""


FIXED = "20.0::DOUBLE AS pc, 20.0::DOUBLE AS ps, 0.6::DOUBLE AS q"
ACTIVE = f"SELECT 0 AS scenario, 1.0::DOUBLE AS mult, 0.15::DOUBLE AS cap_b, 0.20::DOUBLE AS scale_e, 0.25::DOUBLE AS cap_u, {FIXED}"
GRID36 = f"""SELECT row_number() OVER (ORDER BY cap_b, scale_e, mult, cap_u) AS scenario, mult, cap_b, scale_e, cap_u, {FIXED} FROM
    (SELECT unnest([0.10, 0.15, 0.20]::DOUBLE[]) AS cap_b), (SELECT unnest([0.10, 0.20, 0.30]::DOUBLE[]) AS scale_e), (SELECT unnest([0.8, 1.2]::DOUBLE[]) AS mult), (SELECT unnest([0.20, 0.30]::DOUBLE[]) AS cap_u)"""
