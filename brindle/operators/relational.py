"""Joins, set operations, samplings and pages that the pipeline is made of."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.session import checkpointed


def merge_by_key(base: DataFrame, key: str, others: dict[str, DataFrame]) -> DataFrame:
    """Left joins of one-row-per-key tables; columns that the base has already get the other's name as a prefix."""
    out = base
    for name, other in others.items():
        renamed = other.select(*[F.col(c).alias(c if c == key or c not in out.columns else f"{name}_{c}") for c in other.columns])
        out = out.join(renamed, key, "left")
    return out


def shared_values(rows: DataFrame, value: str, member: str) -> DataFrame:
    """(value, members, names): values that more than one member has; blank values don't count."""
    distinct = rows.filter(F.coalesce(F.col(value), F.lit("")) != "").groupBy(value, member).agg(F.count(F.lit(1)).alias("_n"))
    return distinct.groupBy(value).agg(F.count(F.lit(1)).alias("members"), F.min(member).alias("first_member")).filter("members > 1")


def numbered(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Add nth from 1 in a global order without a one-task window: rows are range partitioned and sorted, positions
    count on from the sizes of the partitions before. order must be total."""
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id())
    within = ordered.withColumn("_k", F.row_number().over(Window.partitionBy("_p").orderBy("_i")))
    sizes = ordered.groupBy("_p").agg(F.count(F.lit(1)).alias("_c"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_c").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return within.join(F.broadcast(before.select("_p", "_before")), "_p").withColumn("nth", F.col("_before") + F.col("_k")).drop("_p", "_i", "_k", "_before")


def numbered_within(rows: DataFrame, keys: list[str], order: list[Column], name: str = "nth") -> DataFrame:
    """Add a number from 1 per group of keys without a task that holds a group: rows are range partitioned by keys and
    order and written, and positions count on from the sizes of the partitions before (one row per key and partition
    come to the driver's broadcast, at most the sum of both). order must be total within a group."""
    sort = [*[F.col(k) for k in keys], *order]
    placed = checkpointed(rows.repartitionByRange(*sort).sortWithinPartitions(*sort).withColumn("_i", F.monotonically_increasing_id())).withColumn("_p", F.shiftright("_i", 33))
    sizes = placed.groupBy(*keys, "_p").agg(F.count(F.lit(1)).alias("_c"), F.min("_i").alias("_first"))
    before = sizes.select(*keys, "_p", "_first", (F.sum("_c").over(Window.partitionBy(*keys).orderBy("_p")) - F.col("_c")).alias("_before"))
    return placed.join(F.broadcast(before), [*keys, "_p"]).withColumn(name, F.col("_before") + F.col("_i") - F.col("_first") + 1).drop("_i", "_p", "_first", "_before")


def pages(rows: DataFrame, order: list[Column], size: int) -> DataFrame:
    """Rows with nth and page, fixed pages of size rows in a global order."""
    return numbered(rows, order).withColumn("page", F.ceil(F.col("nth") / size))


def even_sample(rows: DataFrame, key: str, order: list[Column], k: int) -> DataFrame:
    """Per key, the rows at k evenly spaced places (rounded half to even); all rows of keys with k or fewer."""
    w = Window.partitionBy(key)
    placed = rows.withColumn("_i", F.row_number().over(w.orderBy(*order)) - 1).withColumn("_n", F.count(F.lit(1)).over(w))
    wanted = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.bround(i * (F.col("_n") - 1) / (k - 1), 0).cast("int")) if k > 1 else F.array(F.lit(0))
    return placed.filter((F.col("_n") <= k) | F.array_contains(wanted, F.col("_i"))).drop("_i", "_n")


def capped_per_key(rows: DataFrame, key: str, order: list[Column], cap: int, k: int) -> DataFrame:
    """k rows in order, at first at most cap per key, then filled up with the rest. (A report of k rows.)"""
    nth = rows.withColumn("_nth", F.row_number().over(Window.partitionBy(key).orderBy(*order))).withColumn("overflow", F.col("_nth") > cap)
    return nth.drop("_nth").orderBy("overflow", *order).limit(k)


def top_overlap(snapshots: DataFrame, board: str, run: str, time: str, key: str, rank: str, ks: list[int]) -> DataFrame:
    """(board, run, k, overlap): share of a run's top k that was in the top k of the board's run before."""
    runs = snapshots.groupBy(board, run).agg(F.max(time).alias("_t"))
    before = runs.withColumn("_prev", F.lag(run).over(Window.partitionBy(board).orderBy("_t", run))).filter("_prev is not null").drop("_t")
    tops = snapshots.filter(F.col(rank) <= max(ks)).select(board, run, key, rank)
    old = tops.select(board, F.col(run).alias("_prev"), key, F.col(rank).alias("_old"))
    both = tops.join(before, [board, run]).join(old, [board, "_prev", key], "left")
    sums = [F.count_if((F.col(rank) <= k) & (F.col("_old") <= k)).alias(f"k{k}") for k in ks]
    wide = both.groupBy(board, run).agg(*sums)
    return wide.unpivot([board, run], [f"k{k}" for k in ks], "k", "hits").select(board, run, F.substring("k", 2, 9).cast("int").alias("k"), "hits").withColumn("overlap", F.col("hits") / F.col("k"))


def query_family(terms: DataFrame, dimensions: DataFrame, limit: int) -> DataFrame:
    """Search phrases from (pos, term) and (pos, value), both short lists, distinct by first place, the first limit."""
    base = terms.select(F.explode(F.array(F.struct((F.col("pos") * 2).alias("p"), F.concat(F.lit("best "), "term").alias("phrase")), F.struct((F.col("pos") * 2 + 1).alias("p"), F.col("term").alias("phrase")))).alias("s")).select("s.p", "s.phrase")
    first = terms.filter("pos < 2").select(F.col("pos").alias("tp"), "term")
    more = dimensions.crossJoin(F.broadcast(first)).select((1_000_000 + F.col("pos") * 10 + F.col("tp")).alias("p"), F.concat_ws(" ", "term", "value", F.lit("recipe")).alias("phrase"))
    return base.unionByName(more).groupBy("phrase").agg(F.min("p").alias("p")).orderBy("p").limit(limit)
