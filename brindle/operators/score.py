"""Category-aware, publisher-adjusted Bayesian scores over one shared plan for any number of parameter sets."""

from __future__ import annotations

import hashlib
from dataclasses import asdict, dataclass, replace
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brindle.operators.relational import numbered_within

#: The least share of the theoretical uncertainty that a ready bucket's history may leave.
EMPIRICAL_FLOOR = 0.25


@dataclass(frozen=True)
class Params:
    """One point of the parameter grid."""

    scenario: int = 0
    minimum_volume_prior: float = 50.0
    volume_quantile: float = 0.60
    volume_multiplier: float = 1.0
    category_pooling: float = 20.0
    source_pooling: float = 20.0
    bias_cap: float = 0.15
    evidence_floor: float = 0.80
    evidence_scale: float = 0.20
    uncertainty_cap: float = 0.25


def robustness_grid(active: Params = Params()) -> list[Params]:
    """36 scenarios around the active point: bias caps x evidence scales x volume multipliers x uncertainty caps."""
    biases, scales = sorted({0.10, active.bias_cap, 0.20}), sorted({0.10, active.evidence_scale, 0.30})
    points = product(biases, scales, (0.8, 1.2), (0.20, 0.30))
    return [Params(i + 1, volume_multiplier=m, bias_cap=b, evidence_scale=e, uncertainty_cap=c) for i, (b, e, m, c) in enumerate(points)]


def configuration_grid(values: dict[str, list[float]], active: Params = Params(), most: int = 96) -> list[Params]:
    """All combinations of the listed values around the active point, which comes first. Of more than most points an
    evenly strided sample in the order of their hashes is kept, the same for the same lists."""
    points = {replace(active, **dict(zip(values, combination, strict=True))): None for combination in product(*values.values())}
    others = [p for p in points if p != active]
    if len(others) >= most:
        others.sort(key=lambda p: hashlib.sha256(repr(p).encode()).hexdigest())
        others = others[:: max(1, len(others) // (most - 1))][: most - 1]
    return [replace(p, scenario=i) for i, p in enumerate([active, *others])]


def posterior(rating: Column, n: Column, prior: Column, strength: Column) -> Column:
    m = F.greatest(F.lit(1e-9), strength)
    k = F.greatest(F.lit(0), n)
    return k / (k + m) * rating + m / (k + m) * prior


def histogram_variance(histogram: Column) -> Column:
    """Sample variance of the stars of a map of counts; null for one rating or none; keys that are no number don't
    count."""
    pairs = F.filter(F.transform(F.map_entries(histogram), lambda e: F.struct(e["key"].try_cast("double").alias("s"), e["value"].cast("double").alias("n"))), lambda p: p["s"].isNotNull() & p["n"].isNotNull())

    def total(f) -> Column:
        return F.aggregate(pairs, F.lit(0.0), lambda acc, p: acc + f(p))

    n = total(lambda p: p["n"])
    mean = F.try_divide(total(lambda p: p["s"] * p["n"]), n)
    spread = total(lambda p: p["s"] * p["s"] * p["n"]) - n * mean * mean
    return F.when(n > 1, F.greatest(F.lit(0.0), F.try_divide(spread, F.greatest(F.lit(1.0), n - 1))))


def volume_bucket(n: Column) -> Column:
    return F.when(n <= 24, "0-24").when(n <= 99, "25-99").when(n <= 499, "100-499").when(n <= 1999, "500-1999").otherwise("2000+")


def weighted_mean(value: Column, weight: Column) -> Column:
    return F.sum(value * weight) / F.greatest(F.lit(1e-9), F.sum(weight))


def with_weight(items: DataFrame) -> DataFrame:
    return items.withColumn("w", F.sqrt(F.greatest(F.lit(1), F.col("n")).cast("double")))


def global_prior(items: DataFrame) -> DataFrame:
    """One row: prior, the mean rating weighted by the root of the counts."""
    return with_weight(items).agg(weighted_mean(F.col("rating"), F.col("w")).alias("prior"))


def category_baselines(items: DataFrame, pooling: float = 20.0) -> DataFrame:
    """(category, k, raw, base): weighted category means shrunk to the prior; an item counts once per category."""
    each = with_weight(items).select(F.explode(F.array_distinct("categories")).alias("category"), "rating", "w")
    raw = each.groupBy("category").agg(F.count(F.lit(1)).alias("k"), weighted_mean(F.col("rating"), F.col("w")).alias("raw"))
    k = F.col("k")
    return raw.crossJoin(F.broadcast(global_prior(items))).select("category", "k", "raw", (k / (k + pooling) * F.col("raw") + pooling / (k + pooling) * F.col("prior")).alias("base"))


def expected_ratings(items: DataFrame, pooling: float = 20.0) -> DataFrame:
    """Items with prior and expected, the mean baseline of their categories, else the prior.

    The explode joins a table of one row per category and is averaged back per item before it meets the items.
    """
    base = category_baselines(items, pooling).select("category", "base")
    mean = items.select("id", F.explode(F.array_distinct("categories")).alias("category")).join(base, "category").groupBy("id").agg(F.avg("base").alias("mean"))
    return items.join(mean, "id", "left").crossJoin(F.broadcast(global_prior(items))).withColumn("expected", F.coalesce("mean", "prior")).drop("mean")


def source_residuals(expected: DataFrame, pooling: float = 20.0) -> DataFrame:
    """(source, k, shrunk): weighted residual of a source's ratings, shrunk to 0."""
    raw = with_weight(expected).groupBy("source").agg(F.count(F.lit(1)).alias("k"), weighted_mean(F.col("rating") - F.col("expected"), F.col("w")).alias("rho"))
    return raw.select("source", "k", (F.col("k") / (F.col("k") + pooling) * F.col("rho")).alias("shrunk"))


def grid_frame(spark: SparkSession, grid: list[Params]) -> DataFrame:
    return spark.createDataFrame([asdict(p) for p in grid], ", ".join(f"{k} {'int' if k == 'scenario' else 'double'}" for k in asdict(grid[0])))


def _beside(rows: DataFrame, facts: DataFrame, by: list[str]) -> DataFrame:
    """Facts of a handful of groups (one row without by) beside every row."""
    return rows.join(F.broadcast(facts), by) if by else rows.crossJoin(F.broadcast(facts))


def score_items(items: DataFrame, grid: list[Params] | None = None, calibration: DataFrame | None = None, by: list[str] | None = None) -> DataFrame:
    """Scores of all items under every parameter set of a grid.

    items: (id, source, rating, n, confidence, categories, histogram), one row per id, or per id and each of the by
    columns (a handful of cutoffs), whose groups are scored apart. Raw sums are made once; category baselines, expected
    ratings and residuals carry one value per category pooling of the grid in an array, volumes one per quantile, and
    only the last projection meets the grid, whose size is fixed by its list. calibration: (bucket, penalty, ready), one row per volume bucket, as
    timeseries.calibration gives it. The uncertainty is that of the histogram; without one, the penalty of the
    item's bucket where that is ready, but at least EMPIRICAL_FLOOR of the theoretical one; else the theoretical one.
    Nulls: a null confidence is 0.60, null or empty categories mean the prior, a null or empty histogram is none, a
    null source is one source, a null penalty or ready is not ready. An empty table gives no rows.
    """
    grid, by = grid or [Params()], by or []
    poolings, quantiles = sorted({p.category_pooling for p in grid}), sorted({p.volume_quantile for p in grid})
    weighted = with_weight(items.withColumn("source", F.coalesce("source", F.lit(""))))
    facts = weighted.groupBy(*by).agg(weighted_mean(F.col("rating"), F.col("w")).alias("prior"), F.percentile("n", quantiles).alias("volumes"))
    each = weighted.select(*by, "id", "rating", "w", F.explode(F.array_distinct("categories")).alias("category"))
    raw = each.groupBy(*by, "category").agg(F.count(F.lit(1)).alias("k"), weighted_mean(F.col("rating"), F.col("w")).alias("raw"))
    k = F.col("k")
    base = _beside(raw, facts, by).select(*by, "category", *[(k / (k + p) * F.col("raw") + p / (k + p) * F.col("prior")).alias(f"_b{i}") for i, p in enumerate(poolings)])
    mean = each.select(*by, "id", "category").join(base, [*by, "category"]).groupBy(*by, "id").agg(*[F.avg(f"_b{i}").alias(f"_m{i}") for i in range(len(poolings))])
    expected = _beside(weighted.join(mean, [*by, "id"], "left"), facts, by).withColumn("expecteds", F.array(*[F.coalesce(f"_m{i}", "prior") for i in range(len(poolings))]))
    residual = expected.groupBy(*by, "source").agg(F.count(F.lit(1)).alias("k"), F.array(*[weighted_mean(F.col("rating") - F.col("expecteds")[i], F.col("w")) for i in range(len(poolings))]).alias("rhos"))
    points = grid_frame(items.sparkSession, grid).withColumn("_pc", F.array_position(F.lit(poolings), F.col("category_pooling")).cast("int")).withColumn("_q", F.array_position(F.lit(quantiles), F.col("volume_quantile")).cast("int"))
    rows = expected.join(residual, [*by, "source"]).crossJoin(F.broadcast(points))
    if calibration is None:
        rows = rows.withColumn("empirical", F.lit(None).cast("double"))
    else:
        history = calibration.filter("ready").select(F.col("bucket").alias("volume_bucket"), F.col("penalty").alias("empirical"))
        rows = rows.withColumn("volume_bucket", volume_bucket(F.col("n"))).join(F.broadcast(history), "volume_bucket", "left")
    m = F.greatest(F.lit(1.0), F.greatest("minimum_volume_prior", F.element_at("volumes", F.col("_q"))) * F.col("volume_multiplier"))
    shrunk = k / (k + F.col("source_pooling")) * F.element_at("rhos", F.col("_pc"))
    bias = F.greatest(-F.col("bias_cap"), F.least(F.col("bias_cap"), shrunk))
    adjusted = F.greatest(F.lit(0.0), F.least(F.lit(5.0), F.col("rating") - F.col("bias")))
    count = F.greatest(F.lit(1.0), F.col("n") + F.col("m"))
    spread = histogram_variance(F.col("histogram"))
    theory = F.least("uncertainty_cap", 1.96 * 2.5 / F.sqrt(count))
    blended = F.when(F.col("empirical").isNotNull(), F.greatest(F.col("empirical"), EMPIRICAL_FLOOR * theory))
    uncertainty = F.least("uncertainty_cap", F.coalesce(1.96 * F.sqrt(F.col("spread") / count), blended, theory))
    evidence = F.greatest(F.lit(0.0), F.col("evidence_floor") - F.coalesce("confidence", F.lit(0.60))) * F.col("evidence_scale")
    return (
        rows.withColumns({"m": m, "bias": bias, "spread": spread, "expected": F.element_at("expecteds", F.col("_pc"))})
        .withColumns({"adjusted": adjusted, "uncertainty": uncertainty, "evidence": evidence})
        .withColumn("posterior", posterior(F.col("adjusted"), F.col("n"), F.col("prior"), F.col("m")))
        .withColumn("score", F.greatest(F.lit(0.0), F.col("posterior") - F.col("uncertainty") - F.col("evidence")))
        .select(*by, "scenario", "id", "source", "rating", "n", "prior", "expected", "m", "bias", "adjusted", "posterior", "uncertainty", "evidence", "score", F.col("spread").isNotNull().alias("from_histogram"))
    )


def _rank_order(digits: int) -> list[Column]:
    return [F.desc(F.round("score", digits)), F.desc("n"), F.asc("id")]


def ranked(scores: DataFrame, digits: int = 9) -> DataFrame:
    """Add rank within the scenario: score (to digits), then count, then id; no task holds a scenario."""
    return numbered_within(scores, ["scenario"], _rank_order(digits), "rank")


def rank_top(scores: DataFrame, k: int, digits: int = 9) -> DataFrame:
    """The k best of one scenario with their rank, by a distributed top-k; only k rows are numbered."""
    top = scores.orderBy(*_rank_order(digits)).limit(k)
    return top.withColumn("rank", F.row_number().over(Window.partitionBy("scenario").orderBy(*_rank_order(digits))))


def rank_robustness(base: DataFrame, simulated: DataFrame) -> DataFrame:
    """Per item over all scenarios: spread, range and hits of its rank, and a confidence from the spread.

    base: (id, rank); simulated: (scenario, id, rank).
    """
    stats = simulated.groupBy("id").agg(
        F.stddev_pop("rank").alias("rank_stddev"), F.min("rank").alias("low"), F.max("rank").alias("high"),
        F.avg((F.col("rank") <= 10).cast("double")).alias("top10_frequency"), F.avg((F.col("rank") <= 50).cast("double")).alias("top50_frequency"),
    )
    scale = F.greatest(F.lit(2.0), F.col("rank") * 0.10 + 2.0)
    return base.join(stats, "id").withColumn("rank_confidence", 1 / (1 + F.col("rank_stddev") / scale))


def rank_correlation(base: DataFrame, simulated: DataFrame, k: int) -> DataFrame:
    """(scenario, correlation): Pearson correlation of the ranks of the base's top k, which are not ranked anew.

    Fewer than two common items: null; no variance on one side: 1.
    """
    both = base.filter(F.col("rank") <= k).select("id", F.col("rank").alias("x")).join(simulated.select("scenario", "id", F.col("rank").alias("y")), "id")
    sums = both.groupBy("scenario").agg(F.count(F.lit(1)).alias("n"), F.covar_pop("x", "y").alias("c"), F.stddev_pop("x").alias("sx"), F.stddev_pop("y").alias("sy"))
    return sums.select("scenario", F.when(F.col("n") >= 2, F.coalesce(F.try_divide(F.col("c"), F.col("sx") * F.col("sy")), F.lit(1.0))).alias("correlation"))


def rank_gamma(base: DataFrame, simulated: DataFrame, k: int) -> DataFrame:
    """(scenario, gamma): concordant less discordant pairs over both, of the base's top k (k bounds the pairs)."""
    both = base.filter(F.col("rank") <= k).select("id", F.col("rank").alias("x")).join(simulated.select("scenario", "id", F.col("rank").alias("y")), "id")
    lists = both.groupBy("scenario").agg(F.array_sort(F.collect_list(F.struct("x", "y"))).alias("r"))
    later = F.transform("r", lambda a, i: F.aggregate(F.slice("r", i + 2, F.greatest(F.lit(0), F.size("r") - i - 1)), F.lit(0), lambda acc, b: acc + F.signum((b["x"] - a["x"]) * (b["y"] - a["y"])).cast("int")))
    counted = F.transform("r", lambda a, i: F.aggregate(F.slice("r", i + 2, F.greatest(F.lit(0), F.size("r") - i - 1)), F.lit(0), lambda acc, b: acc + F.abs(F.signum((b["x"] - a["x"]) * (b["y"] - a["y"]))).cast("int")))

    def total(c: Column) -> Column:
        return F.aggregate(c, F.lit(0), lambda acc, x: acc + x)

    value = F.coalesce(F.try_divide(total(later), total(counted)), F.lit(1.0))
    return lists.select("scenario", F.when(F.size("r") >= 2, value).alias("gamma"))
