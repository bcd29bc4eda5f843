"""Queries of the scorer and its robustness grid."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.bindings import recipes as current_recipes
from brindle.operators import score as S
from brindle.plans.history import calibrated
from brindle.plans.sql import ACTIVE, BASE, GRID36, scored
from brindle.registry import query
from brindle.session import checkpointed


def recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reduced state, written once: the scorer reads it several times, the log is read once."""
    return checkpointed(current_recipes(spark, sf_dir))


def scores(spark: SparkSession, sf_dir: str, grid: list[S.Params] | None = None) -> DataFrame:
    """The current state scored with the log's own calibration (five rows, written once)."""
    return S.score_items(recipes(spark, sf_dir), grid, checkpointed(calibrated(spark, sf_dir)))


def _r(df: DataFrame, *columns: str) -> DataFrame:
    """Doubles to six decimals, as both engines compare them."""
    return df.withColumns({c: F.round(c, 6) + F.lit(0.0) for c in columns})


@query("flagship_rank", "WITH RECURSIVE " + scored(ACTIVE) + " SELECT rank, id, source, n, round(score, 6) AS score, round(posterior, 6) AS posterior, round(uncertainty, 6) AS uncertainty FROM rk WHERE rank <= 50")
def flagship_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = S.rank_top(scores(spark, sf_dir), 50)
    return _r(top.select("rank", "id", "source", "n", "score", "posterior", "uncertainty"), "score", "posterior", "uncertainty")


@query(
    "score_parts",
    "WITH RECURSIVE " + scored(ACTIVE) + " SELECT id, rank, round(prior, 6) AS prior, round(expected, 6) AS expected, round(m, 6) AS m, round(bias, 6) + 0.0 AS bias, round(adjusted, 6) AS adjusted, round(posterior, 6) AS posterior,"
    " round(uncertainty, 6) AS uncertainty, round(evidence, 6) + 0.0 AS evidence, round(score, 6) AS score, spread IS NOT NULL AS from_histogram FROM rk",
)
def score_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = ["prior", "expected", "m", "bias", "adjusted", "posterior", "uncertainty", "evidence", "score"]
    return _r(S.ranked(scores(spark, sf_dir)), *parts).select("id", "rank", *parts, "from_histogram")


POINTS = {"bias_cap": [0.10, 0.15], "evidence_scale": [0.20, 0.30], "source_pooling": [20.0, 200.0], "category_pooling": [20.0, 500.0], "uncertainty_cap": [0.25, 0.30], "volume_multiplier": [1.0, 1.3], "volume_quantile": [0.6, 0.95]}
_POINTS_SQL = "SELECT row_number() OVER () AS scenario, * FROM " + ", ".join(f"(SELECT unnest({v}::DOUBLE[]) AS {c})" for c, v in zip(["cap_b", "scale_e", "ps", "pc", "cap_u", "mult", "q"], POINTS.values(), strict=True))
_POINT = ["bias_cap", "evidence_scale", "source_pooling", "category_pooling", "uncertainty_cap", "volume_multiplier", "volume_quantile"]


@query(
    "score_grid",
    "WITH RECURSIVE " + scored(_POINTS_SQL, quantiles=(0.6, 0.95)) + " SELECT cap_b AS bias_cap, scale_e AS evidence_scale, ps AS source_pooling, pc AS category_pooling, cap_u AS uncertainty_cap, mult AS volume_multiplier, q AS volume_quantile,"
    " count(*) AS items, round(avg(score), 6) AS score, round(avg(m), 6) AS m, round(avg(expected), 6) AS expected, round(avg(bias), 6) + 0.0 AS bias, round(avg(uncertainty), 6) AS uncertainty, min(CASE WHEN rank = 1 THEN id END) AS best FROM rk GROUP BY ALL",
)
def score_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All seven parameters varied at once; every scenario's means and its best item."""
    grid = S.configuration_grid(POINTS, most=1000)
    figures = ["score", "m", "expected", "bias", "uncertainty"]
    sums = scores(spark, sf_dir, grid).groupBy("scenario").agg(F.count(F.lit(1)).alias("items"), *[F.avg(c).alias(c) for c in figures], F.min(F.struct((-F.round("score", 9)).alias("s"), (-F.col("n")).alias("n"), "id")).alias("b"))
    named = sums.join(F.broadcast(S.grid_frame(spark, grid).select("scenario", *_POINT)), "scenario")
    return _r(named.select(*_POINT, "items", *figures, F.col("b.id").alias("best")), *figures)


@query("global_prior", "WITH " + BASE + " SELECT round(prior, 6) AS prior, round(volume, 6) AS volume, greatest(50.0, volume) AS base FROM g, vp")
def global_prior(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = recipes(spark, sf_dir)
    volume = items.agg(F.percentile("n", 0.6).alias("volume"))
    return _r(S.global_prior(items).crossJoin(volume).withColumn("base", F.greatest(F.lit(50.0), "volume")), "prior", "volume")


@query("category_baselines", "WITH " + BASE + " SELECT category, k, round(raw, 6) AS raw, round(base, 6) AS base FROM cbase")
def category_baselines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _r(S.category_baselines(recipes(spark, sf_dir)), "raw", "base")


@query("source_adjustments", "WITH " + BASE + " SELECT source, k, round(shrunk, 6) + 0.0 AS shrunk, round(greatest(-0.15, least(0.15, shrunk)), 6) + 0.0 AS bias, abs(shrunk - greatest(-0.15, least(0.15, shrunk))) > 1e-12 AS capped FROM sb")
def source_adjustments(spark: SparkSession, sf_dir: str) -> DataFrame:
    bias = F.greatest(F.lit(-0.15), F.least(F.lit(0.15), "shrunk"))
    rows = S.source_residuals(S.expected_ratings(recipes(spark, sf_dir)))
    return _r(rows.select("source", "k", "shrunk", bias.alias("bias"), (F.abs(F.col("shrunk") - bias) > 1e-12).alias("capped")), "shrunk", "bias")


_SIM = "WITH RECURSIVE " + scored(f"({ACTIVE}) UNION ALL SELECT * FROM ({GRID36})") + ", b AS (SELECT id, rank FROM rk WHERE scenario = 0), s AS (SELECT scenario, id, rank FROM rk WHERE scenario > 0) "


def _simulated(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    both = S.ranked(scores(spark, sf_dir, [S.Params(), *S.robustness_grid()])).select("scenario", "id", "rank")
    return both.filter("scenario = 0").select("id", "rank"), both.filter("scenario > 0")


@query(
    "robustness_by_recipe",
    _SIM + "SELECT id, b.rank, round(stddev_pop(s.rank), 6) AS rank_stddev, min(s.rank) AS low, max(s.rank) AS high, round(avg((s.rank <= 10)::DOUBLE), 6) AS top10_frequency, round(avg((s.rank <= 50)::DOUBLE), 6) AS top50_frequency,"
    " round(1 / (1 + stddev_pop(s.rank) / greatest(2.0, b.rank * 0.10 + 2.0)), 6) AS rank_confidence FROM b JOIN s USING (id) GROUP BY id, b.rank",
)
def robustness_by_recipe(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, simulated = _simulated(spark, sf_dir)
    return _r(S.rank_robustness(base, simulated), "rank_stddev", "top10_frequency", "top50_frequency", "rank_confidence")


@query("spearman_topk", _SIM + "SELECT scenario, round(coalesce(covar_pop(b.rank, s.rank) / nullif(stddev_pop(b.rank) * stddev_pop(s.rank), 0), 1.0), 6) AS correlation FROM b JOIN s USING (id) WHERE b.rank <= 200 GROUP BY 1")
def spearman_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _r(S.rank_correlation(*_simulated(spark, sf_dir), 200), "correlation")


@query(
    "gamma_topk",
    _SIM + ", t AS (SELECT scenario, b.rank AS x, s.rank AS y FROM b JOIN s USING (id) WHERE b.rank <= 100) SELECT a.scenario, round(sum(sign((c.x - a.x) * (c.y - a.y))) / sum(abs(sign((c.x - a.x) * (c.y - a.y)))), 6) AS gamma"
    " FROM t a JOIN t c ON a.scenario = c.scenario AND a.x < c.x GROUP BY 1",
)
def gamma_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _r(S.rank_gamma(*_simulated(spark, sf_dir), 100), "gamma")
