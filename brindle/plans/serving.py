"""Queries of backtests, reader tables and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.bindings import readings, snapshots
from brindle.operators import backtest as B
from brindle.operators import serving as V
from brindle.plans.functions import pair_sides
from brindle.operators.score import configuration_grid
from brindle.plans.sql import DAY, READINGS, SNAPSHOTS, scored
from brindle.registry import query
from brindle.session import table
from brindle.streaming import windows as W

#: The windows of backtest.backtest_windows: per horizon up to six evenly spaced cutoffs.
_WINDOWS = f"""ends AS (SELECT h, lo + least(14, greatest(1, h // 3)) * {DAY} AS a, hi - (h + 2) * {DAY} AS b FROM (SELECT min(t) AS lo, max(t) AS hi FROM readings), (SELECT unnest([30, 60, 90]) AS h)),
win AS (SELECT h AS horizon, a + (b - a) * i // greatest(1, c - 1) AS cutoff FROM (SELECT *, least(6, (b - a) // {DAY} // 7 + 1) AS c FROM ends WHERE a < b), (SELECT unnest(range(6)) AS i) WHERE i < c),
past AS (SELECT cutoff, key AS id, source, rating, n, evidence_confidence AS confidence, categories, rating_histogram AS histogram FROM (SELECT c.cutoff, r.*, row_number() OVER (PARTITION BY c.cutoff, r.key ORDER BY r.t DESC) AS nth FROM (SELECT DISTINCT cutoff FROM win) c JOIN readings r ON r.t <= c.cutoff) WHERE nth = 1)"""
CONFIGS = {"bias_cap": [0.15, 0.30], "category_pooling": [20.0, 100.0], "uncertainty_cap": [0.25, 0.40], "volume_multiplier": [1.0, 0.5]}
_GRID = "SELECT * EXCLUDE (active), row_number() OVER (ORDER BY active DESC, cap_b, pc, cap_u, mult DESC) - 1 AS scenario FROM (SELECT *, cap_b = 0.15 AND pc = 20 AND cap_u = 0.25 AND mult = 1 AS active, 0.2::DOUBLE AS scale_e, 20.0::DOUBLE AS ps, 0.6::DOUBLE AS q FROM " + ", ".join(
    f"(SELECT unnest({v}::DOUBLE[]) AS {c})" for c, v in zip(["cap_b", "pc", "cap_u", "mult"], CONFIGS.values(), strict=True)
) + ")"
_BT = f"""WITH {scored(_GRID, "SELECT * FROM past", head=READINGS + ", " + _WINDOWS, empirical=False)},
fu AS (SELECT cutoff, horizon, key AS id, rating AS fr, n AS fn FROM (SELECT c.cutoff, c.horizon, r.*, row_number() OVER (PARTITION BY c.cutoff, c.horizon, r.key ORDER BY r.t) AS nth FROM win c JOIN readings r ON r.t BETWEEN c.cutoff + c.horizon * {DAY} AND c.cutoff + (c.horizon + 10) * {DAY} AND r.n >= 250) WHERE nth = 1),
pr AS (SELECT cutoff, sum(rating * sqrt(greatest(1, n)::DOUBLE)) / sum(sqrt(greatest(1, n)::DOUBLE)) AS bprior FROM past GROUP BY 1),
b AS (SELECT past.*, n / (n + 50.0) * rating + 50.0 / (n + 50.0) * bprior AS bay FROM past JOIN pr USING (cutoff)),
f AS (SELECT cutoff, 'config:' || scenario AS family, id, n, posterior, score FROM sc UNION ALL SELECT cutoff, 'raw_rating', id, n, rating AS posterior, rating AS score FROM b UNION ALL SELECT cutoff, 'confidence_lcb', id, n, rating, greatest(0.0, rating - least(0.5, 4.9 / sqrt(n::DOUBLE))) FROM b UNION ALL SELECT cutoff, 'bayes_m50', id, n, bay, bay FROM b),
k AS (SELECT *, row_number() OVER (PARTITION BY cutoff, family ORDER BY round(score, 9) DESC, n DESC, id) AS rank FROM f),
j AS (SELECT k.*, horizon, fr, row_number() OVER (PARTITION BY cutoff, horizon, family ORDER BY fr DESC, fn DESC, id) AS later FROM k JOIN fu USING (cutoff, id)),
m AS (SELECT cutoff, horizon, family, count(*) AS recipes, coalesce(covar_pop(later, rank) / nullif(stddev_pop(later) * stddev_pop(rank), 0), 1.0) AS rank_correlation, avg(abs(posterior - fr)) AS posterior_mae, avg(abs(score - fr)) AS score_mae,
  count(*) FILTER (WHERE later <= 10 AND rank <= 10) / least(10, count(*))::DOUBLE AS top10_overlap FROM j GROUP BY 1, 2, 3 HAVING count(*) >= 5)"""
_FIGURES = ["rank_correlation", "posterior_mae", "score_mae", "top10_overlap"]
_SUM = "s AS (SELECT family, count(*) AS windows, sum(recipes) AS recipes, " + ", ".join(f"avg({c}) AS {c}" for c in _FIGURES) + " FROM m GROUP BY 1)"


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = readings(spark, sf_dir, "source", "evidence_confidence", "categories", "rating_histogram")
    low, high = log.agg(F.min("t"), F.max("t")).first()
    return B.backtest(log, B.backtest_windows(low or 0, high or 0), configuration_grid(CONFIGS))


def _r(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) + F.lit(0.0) for c in columns})


@query("backtest_windows", _BT + " SELECT cutoff, horizon, family, recipes, " + ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in _FIGURES) + " FROM m")
def backtest_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _r(_metrics(spark, sf_dir), _FIGURES)


@query("backtest_summary", _BT + ", " + _SUM + " SELECT family, windows, recipes, " + ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in _FIGURES) + " FROM s")
def backtest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _r(B.summaries(_metrics(spark, sf_dir)), _FIGURES)


@query(
    "backtest_recommendation",
    _BT + ", " + _SUM + " SELECT family, windows, recipes, " + ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in _FIGURES) + " FROM s WHERE family LIKE 'config:%' AND windows >= 4 AND recipes >= 75"
    " ORDER BY round(coalesce(rank_correlation, -1), 9) DESC, round(posterior_mae, 9), round(top10_overlap, 9) DESC, substr(family, 8)::INT LIMIT 1",
)
def backtest_recommendation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _r(B.recommendation(B.summaries(_metrics(spark, sf_dir))), _FIGURES)


@query("personal_score", f"WITH {SNAPSHOTS} SELECT board_id, run_id, key, round(score + 0.08 * rating / 5 + 0.005 * least(log10(greatest(rating_count, 1)::DOUBLE), 5.0), 6) AS personal FROM snapshots WHERE score IS NOT NULL AND rating IS NOT NULL AND rating_count IS NOT NULL")
def personal_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = snapshots(spark, sf_dir).filter("score is not null and rating is not null and rating_count is not null")
    return s.select("board_id", "run_id", "key", F.round(V.personal_score(F.col("score"), F.col("rating") / 5, F.lit(0.0), F.col("rating_count")), 6).alias("personal"))


@query("diversity_rerank")
def diversity_rerank(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = snapshots(spark, sf_dir).filter("score is not null")
    return V.diverse_order(s.select(F.col("run_id").alias("profile"), F.col("key").alias("id"), F.col("source").alias("category"), "score"))


@query("shopping_totals")
def shopping_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = pair_sides(spark, sf_dir, "ingredients")
    lines = d.select(F.col("pair_id").alias("id"), F.substring("side", 1, 1).alias("side"), F.posexplode("ingredients").alias("p", "text")).select("id", "side", (F.col("p") + 1).cast("bigint").alias("line"), "text")
    return V.shopping_totals(lines).withColumn("amount", F.round("amount", 3))


@query("tumbling_events", "SELECT epoch_us(date_trunc('day', ts)) AS start_us, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def tumbling_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.drain(W.tumbling(W.stream_table(spark, sf_dir, "events")), "complete")


@query("sliding_events", "WITH s AS (SELECT epoch_us(date_trunc('day', ts)) - i * 86400000000 AS start_us, event_type FROM events, (SELECT unnest(range(7)) AS i)) SELECT start_us, event_type, count(*) AS n FROM s GROUP BY 1, 2")
def sliding_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.drain(W.sliding(W.stream_table(spark, sf_dir, "events")), "complete")


@query(
    "session_events",
    "WITH e AS (SELECT user_id, epoch_us(ts) AS t, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER w <= 1800000000 THEN 0 ELSE 1 END AS start FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT user_id, t, sum(start) OVER (PARTITION BY user_id ORDER BY t, start DESC ROWS UNBOUNDED PRECEDING) AS k FROM e)"
    " SELECT min(t) AS start_us, max(t) + 1800000000 AS end_us, user_id, count(*) AS n FROM s GROUP BY user_id, k",
)
def session_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.drain(W.sessions(W.stream_table(spark, sf_dir, "events")), "complete")


@query("stream_dedupe", "SELECT DISTINCT event_id, user_id, event_type FROM events")
def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.drain(W.first_deliveries(W.stream_table(spark, sf_dir, "events"), ["event_id"]), "append").select("event_id", "user_id", "event_type")


@query("stream_upsert", "SELECT user_id, epoch_us(ts) AS t, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_type DESC, value DESC) AS n FROM events) WHERE n = 1")
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.drain(W.latest_values(W.stream_table(spark, sf_dir, "events"), "user_id", ["event_type", "value"]), "complete")
