"""Full history of changing attributes, with the period each value was valid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.functions.time import parse_micros
from brindle.session import checkpointed

#: Rows of one entity are split at multiples of this many microseconds, so no window holds a whole hot entity.
BUCKET_US = 7 * 86_400 * 1_000_000
CHUNK = 64


def chain_end(edges: Column) -> Column:
    """The state in which the transitions of one instant end, whatever order they come in.

    The end is entered once more than it is left. Only self-loops: their state. A closed chain through several
    states ends where it began and changes nothing: null. Broken chains with several ends: the greatest.
    """
    came, went = edges["new"], edges["prev"]

    def surplus(state: Column) -> Column:
        return F.size(F.filter(came, lambda x: x == state)) - F.size(F.filter(went, lambda x: x.eqNullSafe(state)))

    ends = F.filter(F.array_distinct(came), lambda s: surplus(s) > 0)
    return F.when(F.size(ends) > 0, F.array_max(ends)).when(F.size(F.array_distinct(F.array_union(came, went))) == 1, came[0])


def validity_periods(
    df: DataFrame,
    entity: dict[str, Column],
    previous: Column,
    new: Column,
    timestamp: Column,
    bucket_us: int = BUCKET_US,
) -> DataFrame:
    """One row per longest unbroken period in one state of an entity.

    Returns the entity columns, state, valid_from_us and valid_to_us (the start of the next period, -1 if none).

    Method: presence bitmaps. The distinct instants of an entity are its snapshots; per 64 snapshots each state
    has a bitmap with one bit per snapshot in which it held, and b & ~(b << 1) leaves the first bit of every run
    of consecutive bits: the start of a period. A run that continues the last run of the chunk before starts no
    period. Ordinals are counted within time buckets (7 days by default), so the rows of one hot entity spread
    over many tasks; across buckets only one summary row per 64 snapshots is ordered, once forwards for the state
    before and once backwards for the start that ends a chunk's last period.

    Defined cases: rows with a null or blank new state, an unreadable timestamp or a null entity part change
    nothing; several changes of one instant count as the chain's end (chain_end), repeated rows once; an empty
    table gives no rows; extra columns are ignored.
    """
    keys = [f"_e{i}" for i in range(len(entity))]

    def tidy(c: Column) -> Column:
        return F.nullif(F.upper(F.trim(c)), F.lit(""))

    rows = df.select(*[c.alias(k) for k, c in zip(keys, entity.values(), strict=True)], tidy(new).alias("new"), tidy(previous).alias("prev"), parse_micros(timestamp).alias("t"))
    instants = (
        rows.dropna(subset=[*keys, "new", "t"]).groupBy(*keys, "t").agg(F.collect_set(F.struct("new", "prev")).alias("e"))
        .select(*keys, "t", chain_end(F.struct(F.col("e.new").alias("new"), F.col("e.prev").alias("prev"))).alias("state"))
        .filter(F.col("state").isNotNull())
        .withColumn("bucket", F.floor(F.col("t") / F.lit(bucket_us)))
    )
    ordinal = F.row_number().over(Window.partitionBy(*keys, "bucket").orderBy("t")) - 1
    snapshots = (
        instants.withColumn("n", ordinal)
        .groupBy(*keys, "bucket", F.floor(F.col("n") / CHUNK).alias("chunk"))
        .agg(F.array_sort(F.collect_list(F.struct((F.col("n") % CHUNK).alias("bit"), "t", "state"))).alias("snaps"))
    )
    bitmaps = F.transform(
        F.array_distinct(F.transform("snaps", lambda s: s["state"])),
        lambda state: F.struct(
            state.alias("state"),
            F.aggregate("snaps", F.lit(0).cast("bigint"), lambda acc, s: F.when(s["state"] == state, acc.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), s["bit"].cast("int")))).otherwise(acc)).alias("bits"),
        ),
    )

    def run_starts(m: Column) -> Column:
        first_bits = m["bits"].bitwiseAND(F.bitwise_not(F.call_function("shiftleft", m["bits"], F.lit(1))))
        return F.transform(F.filter("snaps", lambda s: F.getbit(first_bits, s["bit"]) == 1), lambda s: F.struct(s["t"].alias("t"), m["state"].alias("state")))

    starts = F.array_sort(F.flatten(F.transform("maps", run_starts)))
    # one pass over the log: what follows reads the starts of runs, one row per 64 snapshots
    chunks = checkpointed(snapshots.withColumn("maps", bitmaps).select(*keys, "bucket", "chunk", starts.alias("starts")))
    along = Window.partitionBy(*keys).orderBy("bucket", "chunk")
    back = Window.partitionBy(*keys).orderBy(F.desc("bucket"), F.desc("chunk")).rowsBetween(Window.unboundedPreceding, -1)
    first, turn = F.element_at("starts", 1), F.try_element_at("starts", F.lit(2))
    summary = (
        chunks.select(*keys, "bucket", "chunk", first.alias("_first"), turn["t"].alias("_turn"), F.element_at("starts", -1)["state"].alias("_last"))
        .withColumn("_before", F.lag("_last").over(along))
        .withColumn("_head", F.when(F.col("_first.state").eqNullSafe(F.col("_before")), F.col("_turn")).otherwise(F.col("_first.t")))
        .select(*keys, "bucket", "chunk", "_before", F.last("_head", True).over(back).alias("_after"))
    )
    own = F.when(first["state"].eqNullSafe(F.col("_before")), F.slice("starts", 2, CHUNK)).otherwise(F.col("starts"))
    period = F.transform("own", lambda s, i: F.struct(s["state"].alias("state"), s["t"].alias("valid_from_us"), F.coalesce(F.try_element_at("own", i + 2)["t"], F.col("_after"), F.lit(-1).cast("bigint")).alias("valid_to_us")))
    periods = chunks.join(summary, [*keys, "bucket", "chunk"]).withColumn("own", own).select(*keys, F.explode(period).alias("p"))
    return periods.select(*[F.col(k).alias(name) for k, name in zip(keys, entity, strict=True)], "p.state", "p.valid_from_us", "p.valid_to_us")
