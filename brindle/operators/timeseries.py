"""Time-series operators over an append-only log of readings (key, t in microseconds, rating, n, ...)."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY_US = 86_400 * 1_000_000
HOUR_US = 3_600 * 1_000_000


def previous_values(readings: DataFrame) -> DataFrame:
    """Readings with the rating, count and instant of the reading before."""
    before = Window.partitionBy("key").orderBy("t")
    return readings.select("key", "t", "rating", "n", *[F.lag(c).over(before).alias(f"previous_{c}") for c in ("rating", "n", "t")])


_PAIR = pa.schema([("key", pa.string()), ("from_t", pa.int64()), ("to_t", pa.int64()), ("n", pa.int64()), ("delta", pa.float64())])


def _pairs(gap_us: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, anchor = None, None
        for batch in batches:
            out = []
            for k, t, rating, n in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if k != key:
                    key, anchor = k, (t, rating, n)
                elif t - anchor[0] >= gap_us and t > anchor[0] and n > anchor[2]:
                    out.append((k, anchor[0], t, max(anchor[2], n), rating - anchor[1]))
                    anchor = (t, rating, n)
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], f.type) for i, f in enumerate(_PAIR)], schema=_PAIR)

    return run


def anchored_pairs(readings: DataFrame, gap_us: int = DAY_US) -> DataFrame:
    """(key, from_t, to_t, n, delta): pairs of readings at least a gap apart with a grown count. The anchor moves
    only when a pair is accepted, which no window can express; sorted partitions are streamed with one anchor as
    state, so a key of any length needs constant memory. One reading per key gives none."""
    rows = readings.select(F.col("key").cast("string"), F.col("t").cast("bigint"), F.col("rating").cast("double"), F.col("n").cast("bigint"))
    return rows.repartition("key").sortWithinPartitions("key", "t").mapInArrow(_pairs(gap_us), "key string, from_t bigint, to_t bigint, n bigint, delta double")


def calibration(pairs: DataFrame, buckets: DataFrame, least_pairs: int = 30, least_keys: int = 10, least_days: float = 21.0) -> DataFrame:
    """Per volume bucket, all buckets listed: how much ratings move between independent readings, and whether the
    history suffices to say so."""
    stats = pairs.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("pairs"), F.count_distinct("key").alias("keys"), ((F.max("to_t") - F.min("from_t")) / DAY_US).alias("span_days"),
        (F.min(F.col("to_t") - F.col("from_t")) / HOUR_US).alias("least_gap_hours"), F.sqrt(F.avg(F.col("delta") * F.col("delta"))).alias("rmse"),
        F.when(F.count(F.lit(1)) > 1, F.stddev_pop("delta")).otherwise(F.max(F.abs("delta"))).alias("sigma"),
    )
    full = buckets.join(stats, "bucket", "left").fillna(0, ["pairs", "keys"]).fillna(0.0, ["span_days"])
    ready = (F.col("pairs") >= least_pairs) & (F.col("keys") >= least_keys) & (F.col("span_days") >= least_days)
    return full.withColumn("penalty", F.least(F.lit(0.25), 1.96 * F.col("rmse"))).withColumn("ready", ready)


def trailing_metrics(readings: DataFrame, now: Column) -> DataFrame:
    """Growth, trend, velocity and acceleration of each key over the 7, 14 and 30 days before now; null where the
    window starts at the latest reading. One pass of mergeable aggregates, no sort."""
    state = F.struct("t", "rating", "n")

    def since(days: int) -> Column:
        return F.min(F.when(F.col("t") >= now - days * DAY_US, state))

    agg = readings.groupBy("key").agg(F.max(state).alias("cur"), since(7).alias("d7"), since(14).alias("d14"), since(30).alias("d30"))

    def grown(start: str, field: str) -> Column:
        return F.when(F.col(f"{start}.t") < F.col("cur.t"), F.col(f"cur.{field}") - F.col(f"{start}.{field}"))

    def rate(start: str, end: str) -> Column:
        return F.when(F.col(f"{start}.t") < F.col(f"{end}.t"), (F.col(f"{end}.n") - F.col(f"{start}.n")) / ((F.col(f"{end}.t") - F.col(f"{start}.t")) / DAY_US))

    velocity, earlier = rate("d7", "cur"), rate("d14", "d7")
    return agg.select("key", grown("d7", "n").alias("growth_7d"), grown("d30", "n").alias("growth_30d"), grown("d30", "rating").alias("trend_30d"), velocity.alias("velocity_7d"), earlier.alias("velocity_before"), (velocity - earlier).alias("acceleration"))


def trailing_slopes(readings: DataFrame, now: Column, days: int = 30) -> DataFrame:
    """Least-squares slopes per day of rating and count over the days before now; null without a spread in time."""
    x = F.col("t") / DAY_US
    recent = readings.filter(F.col("t") >= now - days * DAY_US).withColumn("x", x)
    # days since the earliest reading of the log keep the products small
    origin = recent.agg(F.min("x").alias("x0"))
    return recent.crossJoin(F.broadcast(origin)).groupBy("key").agg(F.regr_slope("rating", F.col("x") - F.col("x0")).alias("rating_slope"), F.regr_slope("n", F.col("x") - F.col("x0")).alias("count_slope"))


def value_changes(readings: DataFrame, value: str, now: Column, days: int = 30) -> DataFrame:
    """(key, changes, last_change): how often a non-empty value differs from the one before, and when it last did."""
    kept = readings.filter((F.col("t") >= now - days * DAY_US) & (F.coalesce(F.col(value), F.lit("")) != ""))
    moved = kept.withColumn("before", F.lag(value).over(Window.partitionBy("key").orderBy("t"))).withColumn("moved", F.col("before").isNotNull() & (F.col("before") != F.col(value)))
    return moved.groupBy("key").agg(F.count_if("moved").alias("changes"), F.max(F.when(F.col("moved"), F.col("t"))).alias("last_change"))


def change_points(readings: DataFrame, now: Column, days: int = 30, least: float = 0.05) -> DataFrame:
    """(key, shift, is_change): mean of the last three ratings less that of the three before, of keys with six."""
    recent = readings.filter(F.col("t") >= now - days * DAY_US)
    nth = recent.withColumn("nth", F.row_number().over(Window.partitionBy("key").orderBy(F.desc("t")))).filter("nth <= 6")
    shift = F.avg(F.when(F.col("nth") <= 3, F.col("rating"))) - F.avg(F.when(F.col("nth") > 3, F.col("rating")))
    return nth.groupBy("key").agg(F.count(F.lit(1)).alias("c"), shift.alias("shift")).filter("c = 6").select("key", "shift", (F.abs("shift") >= least).alias("is_change"))


def rank_history(snapshots: DataFrame) -> DataFrame:
    """(key, peak, volatility, days_in_top10, days_in_top50, snapshots) of (key, t, rank)."""
    day = F.floor(F.col("t") / DAY_US)
    return snapshots.groupBy("key").agg(
        F.min("rank").alias("peak"), F.stddev_pop("rank").alias("volatility"),
        F.count_distinct(F.when(F.col("rank") <= 10, day)).alias("days_in_top10"), F.count_distinct(F.when(F.col("rank") <= 50, day)).alias("days_in_top50"), F.count(F.lit(1)).alias("snapshots"),
    )


def as_of(readings: DataFrame, cutoffs: DataFrame, *fields: str) -> DataFrame:
    """(cutoff, key, t, rating, n, fields): the latest reading of each key at or before each cutoff.

    cutoffs: (cutoff), a handful of instants. Readings are first reduced to the last one between two cutoffs (an
    aggregate that combines before the shuffle); only those meet the cutoffs.
    """
    marks = F.broadcast(cutoffs.agg(F.array_sort(F.collect_set("cutoff")).alias("marks")))
    slot = F.size(F.filter("marks", lambda c: c < F.col("t")))
    last = readings.crossJoin(marks).withColumn("slot", slot).filter(F.col("slot") < F.size("marks")).groupBy("key", "slot", "marks").agg(F.max_by(F.struct("t", "rating", "n", *fields), "t").alias("r"))
    nxt = F.coalesce(F.lead("slot").over(Window.partitionBy("key").orderBy("slot")), F.size("marks"))
    filled = last.withColumn("until", nxt).select("key", "r", F.explode(F.slice("marks", F.col("slot") + 1, F.col("until") - F.col("slot"))).alias("cutoff"))
    return filled.select("cutoff", "key", "r.*")


def nearest_after(readings: DataFrame, targets: DataFrame, tolerance_us: int, least_count: int) -> DataFrame:
    """(target, key, t, rating, n): per key the first reading within tolerance after each target with enough ratings.

    targets: (target), a handful of instants: the join is a range join against a broadcast list of fixed size.
    """
    near = readings.filter(F.col("n") >= least_count).join(F.broadcast(targets), (F.col("t") >= F.col("target")) & (F.col("t") <= F.col("target") + tolerance_us))
    return near.groupBy("target", "key").agg(F.min(F.struct("t", "rating", "n")).alias("r")).select("target", "key", "r.t", "r.rating", "r.n")


def latest_streaks(runs: DataFrame) -> DataFrame:
    """(key, ok, length): how many of the newest runs of (key, t, ok) in a row have the newest one's outcome.

    Two mergeable aggregates and a join of one row per key, instead of a sort of each key's history.
    """
    newest = runs.groupBy("key").agg(F.max(F.struct("t", "ok")).alias("last"), F.max(F.when(F.col("ok"), F.col("t"))).alias("last_ok"), F.max(F.when(~F.col("ok"), F.col("t"))).alias("last_bad"))
    bound = newest.select("key", F.col("last.ok").alias("ok"), F.when(F.col("last.ok"), F.col("last_bad")).otherwise(F.col("last_ok")).alias("turn"))
    return runs.select("key", "t").join(bound, "key").filter(F.col("turn").isNull() | (F.col("t") > F.col("turn"))).groupBy("key", "ok").agg(F.count(F.lit(1)).alias("length"))
