"""How well scores of the past foretell later ratings, over cutoffs and parameter sets at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.operators.relational import numbered_within
from brindle.operators.score import Params, score_items
from brindle.operators.timeseries import DAY_US, as_of, nearest_after
from brindle.session import checkpointed

FAMILIES = ["raw_rating", "confidence_lcb", "bayes_m50"]


def baseline_scores(items: DataFrame) -> DataFrame:
    """(cutoff, family, id, n, posterior, score) of (cutoff, id, rating, n): three plain predictors per cutoff.

    The prior of a cutoff is one aggregate; the families are an array that is exploded, so items are read once.
    """
    w = F.sqrt(F.greatest(F.lit(1), F.col("n")).cast("double"))
    prior = items.groupBy("cutoff").agg((F.sum(F.col("rating") * w) / F.sum(w)).alias("prior"))
    n = F.greatest(F.lit(1), F.col("n")).cast("double")
    bayes = n / (n + 50) * F.col("rating") + 50 / (n + 50) * F.col("prior")
    lower = F.greatest(F.lit(0.0), F.col("rating") - F.least(F.lit(0.5), 1.96 * 2.5 / F.sqrt(n)))

    def one(family: str, posterior: Column, score: Column) -> Column:
        return F.struct(F.lit(family).alias("family"), posterior.alias("posterior"), score.alias("score"))

    each = F.explode(F.array(one(FAMILIES[0], F.col("rating"), F.col("rating")), one(FAMILIES[1], F.col("rating"), lower), one(FAMILIES[2], bayes, bayes)))
    return items.join(prior, "cutoff").select("cutoff", "id", "n", each.alias("f")).select("cutoff", "f.family", "id", "n", "f.posterior", "f.score")


def prediction_metrics(predicted: DataFrame, future: DataFrame, least: int = 5) -> DataFrame:
    """(cutoff, horizon, family, recipes, rank_correlation, posterior_mae, score_mae, top10_overlap).

    predicted: (cutoff, family, id, n, posterior, score); future: (cutoff, horizon, id, future_rating, future_n). Ranks
    are those among all predicted items, as published; windows with fewer than least common items are left out. Ties go
    to the smaller id. Both ranks are numbered without a task that holds a cutoff.
    """
    ranked = numbered_within(predicted, ["cutoff", "family"], [F.desc(F.round("score", 9)), F.desc("n"), F.asc("id")], "rank")
    # the order of the future is that of the window's items, whatever the family
    later = numbered_within(future.join(predicted.select("cutoff", "id").distinct(), ["cutoff", "id"], "left_semi"), ["cutoff", "horizon"], [F.desc("future_rating"), F.desc("future_n"), F.asc("id")], "later")
    sums = ranked.join(later, ["cutoff", "id"]).groupBy("cutoff", "horizon", "family").agg(
        F.count(F.lit(1)).alias("recipes"), F.covar_pop("later", "rank").alias("c"), F.stddev_pop("later").alias("sx"), F.stddev_pop("rank").alias("sy"),
        F.avg(F.abs(F.col("posterior") - F.col("future_rating"))).alias("posterior_mae"), F.avg(F.abs(F.col("score") - F.col("future_rating"))).alias("score_mae"),
        F.count_if((F.col("later") <= 10) & (F.col("rank") <= 10)).alias("hits"),
    )
    correlation = F.coalesce(F.try_divide("c", F.col("sx") * F.col("sy")), F.lit(1.0))
    return sums.filter(F.col("recipes") >= least).select("cutoff", "horizon", "family", "recipes", correlation.alias("rank_correlation"), "posterior_mae", "score_mae", (F.col("hits") / F.least(F.lit(10), "recipes")).alias("top10_overlap"))


def backtest_windows(first: int, last: int, horizons: tuple[int, ...] = (30, 60, 90), most: int = 6) -> list[tuple[int, int]]:
    """(cutoff, horizon in days): per horizon up to most evenly spaced cutoffs, the first some days after the log begins,
    the last early enough for the horizon to pass; none for horizons the log is too short for."""
    out = []
    for days in horizons:
        low, high = first + min(14, max(1, days // 3)) * DAY_US, last - (days + 2) * DAY_US
        count = min(most, (high - low) // DAY_US // 7 + 1)
        if low < high:
            out += [(low + (high - low) * i // max(1, count - 1), days) for i in range(count)]
    return out


def backtest(readings: DataFrame, windows: list[tuple[int, int]], grid: list[Params], tolerance_us: int = 10 * DAY_US, least_count: int = 250) -> DataFrame:
    """Metrics of every parameter set and every baseline in every window (cutoff, horizon), as one plan.

    readings: (key, t, rating, n, source, evidence_confidence, categories, rating_histogram). family is 'config:<number
    of the grid's point>' or the baseline's name. The state of each cutoff is made once, whatever the horizons; the
    future rating is the first one within tolerance after the horizon that has enough ratings.
    """
    spark = readings.sparkSession
    cutoffs = spark.createDataFrame([(c,) for c in sorted({c for c, _ in windows})], "cutoff bigint")
    state = checkpointed(as_of(readings, cutoffs, "source", "evidence_confidence", "categories", "rating_histogram"))
    items = state.select("cutoff", F.col("key").alias("id"), "source", "rating", "n", F.col("evidence_confidence").alias("confidence"), "categories", F.col("rating_histogram").alias("histogram"))
    scored = score_items(items, grid, by=["cutoff"]).select("cutoff", F.concat(F.lit("config:"), F.col("scenario").cast("string")).alias("family"), "id", "n", "posterior", "score")
    targets = spark.createDataFrame([(c + d * DAY_US, c, d) for c, d in windows], "target bigint, cutoff bigint, horizon int")
    future = nearest_after(readings, targets.select("target").distinct(), tolerance_us, least_count).join(F.broadcast(targets), "target").select("cutoff", "horizon", F.col("key").alias("id"), F.col("rating").alias("future_rating"), F.col("n").alias("future_n"))
    return prediction_metrics(scored.unionByName(baseline_scores(items)), checkpointed(future))


def summaries(metrics: DataFrame) -> DataFrame:
    """(family, windows, recipes, mean figures): null correlations are skipped."""
    return metrics.groupBy("family").agg(
        F.count(F.lit(1)).alias("windows"), F.sum("recipes").alias("recipes"), F.avg("rank_correlation").alias("rank_correlation"), F.avg("posterior_mae").alias("posterior_mae"),
        F.avg("score_mae").alias("score_mae"), F.avg("top10_overlap").alias("top10_overlap"),
    )


def recommendation(summary: DataFrame, least_windows: int = 4, least_recipes: int = 75) -> DataFrame:
    """The parameter set that does best in enough windows, or no row: by correlation (null as -1), then the error of the
    posterior, then the overlap, then the number. Baselines are never recommended."""
    known = summary.filter(F.col("family").startswith("config:") & (F.col("windows") >= least_windows) & (F.col("recipes") >= least_recipes))
    number = F.substring("family", 8, 9).cast("int")
    return known.orderBy(F.desc(F.round(F.coalesce("rank_correlation", F.lit(-1.0)), 9)), F.round("posterior_mae", 9), F.desc(F.round("top10_overlap", 9)), number).limit(1)
