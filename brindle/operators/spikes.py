"""Implausible readings in many time series, judged by what is normal for each source."""

from __future__ import annotations

import math
import random
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.functions.time import parse_micros
from brindle.session import checkpointed


@dataclass(frozen=True)
class SpikeRules:
    """Limits and sizes; every default is documented here and none depends on the input's size."""

    rating_low: float = 0.0
    rating_high: float = 5.05
    #: More ratings than any page can have.
    count_high: float = 1e8
    #: Readings on each side that give the level of a series.
    side: int = 7
    #: Longest departure that still is a spike.
    longest: int = 3
    #: Smaller departures and shorter runs are none, however quiet their source is.
    log_count_floor: float = 0.12
    count_floor: float = 3.0
    rating_floor: float = 0.2
    stuck_least: int = 6
    #: Isolation forest: trees of each feature, rows per tree, and the bound on the rows of a source from which trees draw.
    trees: int = 150
    tree_rows: int = 128
    fit_rows: int = 4096
    #: Relative scores: 0 is the usual reading of the source, 1 one beyond all its readings. A level or run is unusual
    #: from this score on, ...
    cut: float = 0.76
    #: ... and a departure needs a difference or seasonal score of so much besides.
    support: float = 0.4
    #: A key with more readings is cut by position in time, with as many readings before and after a part as halo.
    hot_rows: int = 20_000
    halo: int = 64
    #: Sources whose forests are broadcast at once (some 20 KB each); more take further passes over the features.
    block_sources: int = 2_000


FEATURES = ["level_count", "level_rating", "step_count", "step_rating", "season_count", "season_rating", "run_size"]
#: What counts as a small difference of each feature.
FEATURE_UNITS = [0.12, 0.2, 0.12, 0.2, 0.12, 0.2, 3.0]
_OUT = pa.schema(
    [("key", pa.string()), ("t", pa.int64()), ("source", pa.string()), ("impossible", pa.bool_()), ("gap_count", pa.float64()), ("run_length", pa.int64()), ("run_at", pa.int64())] + [(f, pa.float64()) for f in FEATURES]
)
#: Where a reading's run meets an end of its part of a hot series (1 first, 2 last, 3 both), to be joined across cuts.
_SERIES = _OUT.append(pa.field("part", pa.int64())).append(pa.field("edge", pa.int64())).append(pa.field("run_value", pa.float64()))
_OUT_DDL = "key string, t bigint, source string, impossible boolean, gap_count double, run_length bigint, run_at bigint, " + ", ".join(f"{f} double" for f in FEATURES)


def _departures(values: np.ndarray, start: np.ndarray, end: np.ndarray, side: int, longest: int) -> np.ndarray:
    """Signed departure of each value from both its sides.

    A departure is the smaller of the distances from the median before and the median after, where both have the
    same sign, else 0: a lasting rise equals its after side and a trend lies between its sides. A side with fewer
    than 5 values may be outvoted by the rest of a short spike, so there the next 1 or 2 neighbours may be left out.
    """
    n = len(values)
    at = np.arange(n)
    around = np.full((2, side + longest - 1, n), np.nan)
    for k in range(1, side + longest):
        before, after = at - k, at + k
        ok = before >= start
        around[0, k - 1, ok] = values[before[ok]]
        ok = after < end
        around[1, k - 1, ok] = values[after[ok]]
    with np.errstate(all="ignore"):
        middle = {(s, skip): np.nanmedian(around[s, skip : skip + side], axis=0) for s in (0, 1) for skip in range(longest)}
        few = [np.sum(~np.isnan(around[s, :side]), axis=0) < 5 for s in (0, 1)]
        best = np.zeros(n)
        for a in range(longest):
            for b in range(longest - a):
                x, y = values - middle[0, a], values - middle[1, b]
                size = np.where((np.sign(x) == np.sign(y)), np.minimum(np.abs(x), np.abs(y)), 0.0)
                size = np.where(np.isnan(size) | ((a > 0) & ~few[0]) | ((b > 0) & ~few[1]), 0.0, size)
                best = np.where(size > np.abs(best), np.sign(x) * size, best)
    return best


def _series_features(block: pd.DataFrame, rules: SpikeRules) -> pd.DataFrame:
    """Features of all readings of whole series; block is sorted by key, part and time and holds whole parts."""
    n = len(block)
    key, part = block["key"].to_numpy(), block["part"].to_numpy()
    first = np.r_[True, (key[1:] != key[:-1]) | (part[1:] != part[:-1])] if n else np.zeros(0, bool)
    group = np.cumsum(first) - 1
    start = np.flatnonzero(first)[group]
    end = start + np.bincount(group)[group]

    def limits(name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return tuple(block[f"{name}_{x}"].to_numpy(dtype=float, na_value=np.nan) for x in ("min", "max", "max"))

    r_low, r_high, rating = limits("rating")
    c_low, c_high, count = limits("count")
    with np.errstate(invalid="ignore"):
        bad_r = (r_low < rules.rating_low) | (r_high > rules.rating_high)
        bad_c = (c_low < 0) | (c_high >= rules.count_high)
    rating, count = np.where(bad_r, np.nan, rating), np.where(bad_c, np.nan, count)
    log = np.log1p(count)

    def past(values: np.ndarray, k: int) -> np.ndarray:
        back = np.arange(n) - k
        return np.where(back >= start, values[np.maximum(back, 0)], np.nan)

    import warnings

    with warnings.catch_warnings():
        warnings.simplefilter("ignore", RuntimeWarning)  # all-null sides
        level_c, level_r, gap = (_departures(x, start, end, rules.side, rules.longest) for x in (log, rating, count))
        # a reading of a short spike differs much from one of the last few
        step_c, step_r = (np.nanmax([np.abs(x - past(x, k)) for k in range(1, rules.longest + 1)], axis=0) if n else x for x in (log, rating))
    # runs of equal counts, nulls left out; of a part's own readings only, as runs are joined across cuts later
    there = np.flatnonzero(~np.isnan(count) & ~block["halo"].to_numpy(bool))
    run_length, run_at, edge = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    if len(there):
        g, c = group[there], count[there]
        new = np.r_[True, (g[1:] != g[:-1]) | (c[1:] != c[:-1])]
        run = np.cumsum(new) - 1
        run_length[there] = np.bincount(run)[run]
        run_at[there] = np.arange(len(there)) - np.flatnonzero(new)[run] + 1
        turn = g[1:] != g[:-1]
        ends = np.zeros(run[-1] + 1, np.int64)
        ends[run[np.r_[True, turn]]] += 1
        ends[run[np.r_[turn, True]]] += 2
        edge[there] = np.where(block["hot"].to_numpy(bool)[there], ends[run], 0)
    zero = lambda x: np.nan_to_num(np.abs(x), nan=0.0)
    out = pd.DataFrame(
        {
            "key": key, "t": block["t"].to_numpy(), "source": block["source"].to_numpy(), "impossible": bad_r | bad_c,
            "gap_count": zero(gap), "run_length": run_length, "run_at": run_at,
            "level_count": zero(level_c), "level_rating": zero(level_r), "step_count": zero(step_c), "step_rating": zero(step_r),
            "season_count": zero(log - past(log, 7)), "season_rating": zero(rating - past(rating, 7)), "run_size": run_length.astype(float),
            "part": part, "edge": edge, "run_value": count,
        }
    )
    return out[~block["halo"].to_numpy(bool)]


def _feature_batches(rules: SpikeRules):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pd.DataFrame | None = None

        def made(block: pd.DataFrame) -> pa.RecordBatch:
            return pa.RecordBatch.from_pandas(_series_features(block, rules), schema=_SERIES, preserve_index=False)

        for batch in batches:
            block = batch.to_pandas()
            if rest is not None:
                block = pd.concat([rest, block], ignore_index=True)
            if not len(block):
                continue
            last = (block["key"] == block["key"].iloc[-1]) & (block["part"] == block["part"].iloc[-1])
            whole, rest = block[~last], block[last]
            if len(whole):
                yield made(whole.reset_index(drop=True))
        if rest is not None and len(rest):
            yield made(rest.reset_index(drop=True))

    return run


def split_hot(df: DataFrame, key: str, time: str, limit: int, halo: int) -> DataFrame:
    """Add part, halo and hot: series of more than limit rows are hot and cut by position into parts of at most limit
    rows, however uneven their times are, each with copies (halo = true) of the halo rows right before and after it.
    Other series are one part. Times are distinct within a key.

    Positions are exact and no task holds a series: hot rows are range partitioned by key and time, numbered within a
    partition, and count on from the sizes of the partitions before. Hot keys are at most one in limit rows.
    """
    sizes = checkpointed(df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > limit))
    flags = {"part": F.lit(0).cast("bigint"), "halo": F.lit(False), "hot": F.lit(False)}
    if sizes.isEmpty():
        return df.withColumns(flags)
    cold = df.join(F.broadcast(sizes), key, "left_anti").withColumns(flags)
    ordered = checkpointed(df.join(F.broadcast(sizes), key).repartitionByRange(key, time).withColumn("_p", F.spark_partition_id()))
    counts = ordered.groupBy(key, "_p").agg(F.count(F.lit(1)).alias("_c"))
    before = counts.select(key, "_p", (F.sum("_c").over(Window.partitionBy(key).orderBy("_p")) - F.col("_c")).alias("_before"))
    nth = ordered.withColumn("_i", F.row_number().over(Window.partitionBy(key, "_p").orderBy(time)) - 1)
    at = F.col("_before") + F.col("_i")
    parts = F.ceil(F.col("_n") / F.lit(limit))
    placed = nth.join(F.broadcast(before), [key, "_p"]).withColumn("_at", at.cast("bigint")).withColumn("_size", F.ceil(F.col("_n") / parts).cast("bigint"))
    own = F.floor(F.col("_at") / F.col("_size"))
    first = F.greatest(F.lit(0), F.floor((F.col("_at") - halo) / F.col("_size")))
    last = F.least(F.floor((F.col("_n") - 1) / F.col("_size")), F.floor((F.col("_at") + halo) / F.col("_size")))
    hot = placed.withColumn("_own", own).withColumn("part", F.explode(F.sequence(first.cast("bigint"), last.cast("bigint")))).withColumn("halo", F.col("part") != F.col("_own")).withColumn("hot", F.lit(True))
    return cold.unionByName(hot.select(*df.columns, "part", "halo", "hot"))


def _joined_runs(series: DataFrame) -> DataFrame:
    """Features with the runs of hot series joined across cuts; run lengths and places are then those of whole series.

    Only the first and the last run of each part (two rows in hot_rows readings) are looked at.
    """
    ends = series.filter("edge > 0").groupBy("key", "part", "edge").agg(F.first("run_value").alias("value"), F.max("run_length").alias("length"))
    along = Window.partitionBy("key").orderBy("part", "edge")
    new = F.coalesce((F.lag("part").over(along) == F.col("part")) | (F.lag("value").over(along) != F.col("value")), F.lit(True))
    runs = ends.withColumn("new", new).withColumn("run", F.sum(F.col("new").cast("int")).over(along))
    one = Window.partitionBy("key", "run")
    whole = runs.select("key", "part", "edge", F.sum("length").over(one).alias("_length"), (F.sum("length").over(one.orderBy("part", "edge")) - F.col("length")).alias("_before"), "length")
    longer = checkpointed(whole.filter("_length > length").drop("length"))
    extra = ["part", "edge", "run_value"]
    if longer.isEmpty():
        return series.drop(*extra)
    length = F.coalesce("_length", "run_length")
    joined = series.join(F.broadcast(longer), ["key", "part", "edge"], "left").withColumns({"run_length": length, "run_size": length.cast("double"), "run_at": F.col("run_at") + F.coalesce("_before", F.lit(0))})
    return joined.drop("_length", "_before", *extra)


# ---- isolation forest -------------------------------------------------------------------------------------------


def _depth(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search among n values: what a leaf of n rows adds to its own depth."""
    n = np.asarray(n, float)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(n > 2, 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n, np.where(n == 2, 1.0, 0.0))


def fit_trees(values: np.ndarray, unit: float, trees: int, rows: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The isolation trees of one feature as a step function: (bounds, scores), scores one longer; a value has the score
    after the last bound below it. Scores are those of the mean depth over all trees, to three decimals.

    Values are sorted first, so their order does not matter. All features are sizes, so cuts fall between a node's
    lowest value and twice its spread (at least one unit of the feature): what lies beyond all the rows of a tree is cut
    off early, not kept with the highest. No values: everything scores 0.
    """
    pool = np.sort(values).tolist()
    if not pool:
        return np.zeros(0), np.zeros(1)
    rng = random.Random(seed)
    rows = min(rows, len(pool))
    height = max(1, math.ceil(math.log2(max(2, rows))))
    leaf = [float(_depth(k)) for k in range(rows + 1)]
    bounds: list[float] = []
    steps: list[float] = []
    base = 0.0
    for _ in range(trees):
        sample = [pool[k] for k in sorted(rng.sample(range(len(pool)), rows))]
        before = None
        todo = [(0, 0, rows, 0.0)]  # depth, rows from and to, and the bound on the left; leaves come in order
        while todo:
            deep, lo, hi, left = todo.pop()
            if deep == height or hi - lo <= 1:
                depth = deep + leaf[hi - lo]
                if before is None:
                    base += depth
                else:
                    bounds.append(left)
                    steps.append(depth - before)
                before = depth
                continue
            low, high = sample[lo], sample[hi - 1]
            cut = rng.uniform(low, high + max(high - low, unit))
            middle = bisect_right(sample, cut, lo, hi)
            todo.append((deep + 1, middle, hi, cut))
            todo.append((deep + 1, lo, middle, left))
    order = np.argsort(np.array(bounds), kind="stable")
    depth = (base + np.concatenate([[0.0], np.cumsum(np.array(steps)[order])])) / trees
    score = np.round(2.0 ** (-depth / max(leaf[rows], 1e-9)), 3)
    turns = np.flatnonzero(np.diff(score))
    return np.array(bounds)[order][turns], np.concatenate([score[:1], score[turns + 1]])


def score_trees(bounds: np.ndarray, scores: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Anomaly scores in (0, 1); higher is easier to isolate."""
    return scores[np.searchsorted(bounds, values, "left")]


def _fit_source(rules: SpikeRules):
    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        """Per feature the trees' scores, told from the score of the source's usual value (0) to that beyond all (1)."""
        out = {"source": [pdf["source"].iloc[0]]}
        for k, (feature, unit) in enumerate(zip(FEATURES, FEATURE_UNITS, strict=True)):
            rows = pdf[feature][pdf["run_at"] == 1] if feature == "run_size" else pdf[feature]
            bounds, scores = fit_trees(rows.to_numpy(float), unit, rules.trees, rules.tree_rows, 7 + k)
            usual = score_trees(bounds, scores, pdf[f"usual_{feature}"].iloc[:1].to_numpy(float))[0]
            spread = scores[-1] - usual
            out[f"b_{feature}"] = [bounds.tolist()]
            out[f"s_{feature}"] = [((scores - usual) / spread if spread > 0 else np.zeros(len(scores))).tolist()]
        return pd.DataFrame(out)

    return fit


_FOREST_DDL = "source string, " + ", ".join(f"b_{f} array<double>, s_{f} array<double>" for f in FEATURES)
SCORES = [f"score_{f}" for f in FEATURES]


def _score_batches(forests):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = forests.value
        at = [_OUT.get_field_index(f) for f in FEATURES]
        for batch in batches:
            named = batch.column(_OUT.get_field_index("source")).dictionary_encode()
            codes = named.indices.to_numpy()
            order = np.argsort(codes, kind="stable")
            ends = np.searchsorted(codes[order], np.arange(len(named.dictionary) + 1))
            values = [batch.column(k).to_numpy() for k in at]
            scores = np.zeros((len(FEATURES), len(codes)))
            for code, source in enumerate(named.dictionary.to_pylist()):
                rows = order[ends[code] : ends[code + 1]]
                for k, (bounds, levels) in enumerate(known[source]):
                    scores[k, rows] = score_trees(bounds, levels, values[k][rows])
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(x) for x in scores)], names=[*batch.schema.names, *SCORES])

    return run


def scored(features: DataFrame, forests: DataFrame, rules: SpikeRules) -> DataFrame:
    """Features with one relative score each, by the forest of the reading's source. Forests of at most
    rules.block_sources sources at a time are broadcast, so readings are scored where they lie."""
    context = features.sparkSession.sparkContext
    blocks = max(1, math.ceil(forests.count() / rules.block_sources))
    ddl = _OUT_DDL + ", " + ", ".join(f"{c} double" for c in SCORES)
    out = []
    for b in range(blocks):
        mine = F.pmod(F.xxhash64("source"), F.lit(blocks)) == b
        rows = forests.filter(mine).toLocalIterator()
        known = {r["source"]: [(np.array(r[f"b_{f}"]), np.array(r[f"s_{f}"])) for f in FEATURES] for r in rows}
        out.append((features.filter(mine) if blocks > 1 else features).select(_OUT.names).mapInArrow(_score_batches(context.broadcast(known)), ddl))
    return reduce(DataFrame.unionByName, out)


# ---- the operator ------------------------------------------------------------------------------------------------


def source_forests(features: DataFrame, rules: SpikeRules) -> DataFrame:
    """One forest per source. Trees draw from about fit_rows of its readings at most; what is usual covers all."""
    usual = [F.percentile_approx(F.when(F.col("run_at") == 1, F.col(f)) if f == "run_size" else F.col(f), 0.5).alias(f"usual_{f}") for f in FEATURES]
    normal = features.groupBy("source").agg(F.count(F.lit(1)).alias("n"), *usual)
    normal = checkpointed(normal.fillna(0.0, [f"usual_{f}" for f in FEATURES]))
    few = normal.count() <= rules.block_sources
    luck = F.pmod(F.xxhash64("key", "t"), F.lit(1_000_003)) / 1_000_003.0
    drawn = features.select("key", "t", "source", "run_at", *FEATURES).join(F.broadcast(normal) if few else normal, "source").filter(luck < F.lit(rules.fit_rows) / F.col("n")).drop("key", "t")
    return checkpointed(drawn.groupBy("source").applyInPandas(_fit_source(rules), _FOREST_DDL))


def reading_scores(df: DataFrame, key: str, source: str, timestamp: str, rating: str, count: str, rules: SpikeRules = SpikeRules()) -> DataFrame:
    """One row per reading (key, instant) with its features and the forest's relative score of each."""
    rows = df.select(F.col(key).alias("key"), F.coalesce(F.col(source), F.lit("")).alias("source"), parse_micros(F.col(timestamp)).alias("t"), F.nanvl(F.col(rating).cast("double"), F.lit(None)).alias("r"), F.col(count).cast("double").alias("c"))
    readings = rows.filter("key is not null and t is not null").groupBy("key", "t").agg(
        F.min("source").alias("source"), F.min("r").alias("rating_min"), F.max("r").alias("rating_max"), F.min("c").alias("count_min"), F.max("c").alias("count_max")
    )
    series = split_hot(readings, "key", "t", rules.hot_rows, rules.halo).repartition("key", "part").sortWithinPartitions("key", "part", "t")
    features = _joined_runs(checkpointed(series.mapInArrow(_feature_batches(rules), _OUT_DDL + ", part bigint, edge bigint, run_value double")))  # read three times below
    return scored(features, source_forests(features, rules), rules)


def implausible_readings(df: DataFrame, row_id: str, key: str, source: str, timestamp: str, rating: str, count: str, rules: SpikeRules = SpikeRules()) -> DataFrame:
    """Ids of rows whose reading cannot be true or does not fit how its source normally behaves.

    Cases: values beyond the physical limits (rating outside 0..5.05, a negative count or one of 1e8 and more);
    departures of at most 3 readings from a level that holds before and after, and runs of equal counts but for the
    run's first reading, where the forest of the source finds them unusual. Lasting rises are none.

    Method: one isolation forest per source over level, difference, seasonal and run-length features scores every
    reading. Trees have one feature each, so a reading has a score per feature, told from the source's usual reading (0)
    to one beyond all its readings (1): the cut (SpikeRules.cut) lies in each source's own range of scores. The level's
    score decides on departures, with the difference or the season in support, the run length's on runs; explicit limits
    are only the physical ones and the sizes below which nothing is a departure or a run. Trees are fitted on at most
    about fit_rows readings per source, every other statistic covers all rows. Series are shuffled by (key, part), so a
    key may hold a third of all rows; parts are cut by position and see their true neighbours, and runs are joined
    across cuts, so a cut changes no feature. Forests are broadcast and readings scored where they lie, so a source may
    hold any share of the rows.

    Defined cases: rows of one key and instant are one reading, all of whose rows are returned; rows without a
    key or a readable timestamp are judged by the physical limits only; null and NaN values are no departures;
    a null source is a source of its own; the first and last reading of a series never depart; empty tables give
    no rows; extra columns are ignored.
    """
    readings = reading_scores(df, key, source, timestamp, rating, count, rules)

    def departs(field: str) -> Column:
        return (F.col(f"score_level_{field}") >= rules.cut) & (F.greatest(f"score_step_{field}", f"score_season_{field}") >= rules.support)

    spike_c = departs("count") & (F.col("level_count") > rules.log_count_floor) & (F.col("gap_count") >= rules.count_floor)
    spike_r = departs("rating") & (F.col("level_rating") > rules.rating_floor)
    stuck = (F.col("score_run_size") >= rules.cut) & (F.col("run_at") > 1) & (F.col("run_length") >= rules.stuck_least)
    cases = readings.filter(F.col("impossible") | spike_c | spike_r | stuck).select(F.col("key").alias("_k"), F.col("t").alias("_t"))
    rows = df.select(F.col(row_id), F.col(key).alias("_key"), parse_micros(F.col(timestamp)).alias("_at"), F.col(rating).cast("double").alias("_r"), F.col(count).cast("double").alias("_c"))
    found = rows.join(cases, (F.col("_key") == F.col("_k")) & (F.col("_at") == F.col("_t")), "left_semi").select(row_id)
    limits = (F.col("_r") < rules.rating_low) | ((F.col("_r") > rules.rating_high) & ~F.isnan("_r")) | (F.col("_c") < 0) | (F.col("_c") >= rules.count_high)
    loose = rows.filter((F.col("_key").isNull() | F.col("_at").isNull()) & limits).select(row_id)
    return found.unionByName(loose)
