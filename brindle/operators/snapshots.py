"""What changed between consecutive full snapshots of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.functions.time import parse_micros


def latest_delivery(df: DataFrame, keys: list[str], delivered: str, payload: list[str]) -> DataFrame:
    """One row per key, the one delivered last; of several delivered at once the one with the largest payload.

    A null delivery time counts as the earliest. The reduction combines before the shuffle, so a row that was
    delivered many times costs one row per input partition.
    """
    best = F.max(F.struct(F.col(delivered), *[F.col(c) for c in payload])).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col("_best")[c].alias(c) for c in payload])


def snapshot_changes(
    df: DataFrame,
    board: str,
    run: str,
    key: str,
    values: dict[str, Column],
    timestamp: str,
    delivered: str,
) -> DataFrame:
    """Rows added, removed or changed between each two consecutive snapshots of a board.

    df holds full snapshots: one row per (board, run, key), perhaps delivered several times. Returns
    (board, run, key, change_kind), run being the later snapshot and change_kind 'added', 'removed' or 'changed'.

    Method: EXCEPT ALL in both directions, then a full join of the residues by key. Both differences come from
    one pass: every snapshot row is sent twice, with +1 for its own run and with -1 for the run that follows, and
    what sums to zero over (board, run, key, values) is identical and gone. The residues are then labelled by the
    signs that are left for a key. The table is shuffled twice by (board, run, key), never by board alone, so one
    board may hold most of the rows.

    Defined cases: runs of a board follow each other by the latest readable instant of their rows, then by run;
    a run without a readable instant comes first; the first run of a board has no changes; a null value equals
    only null; NaN equals NaN and -0.0 equals 0.0; a null board, run or key is a value like any other; exact
    repeats do not count; an empty table gives no rows. Extra columns are ignored.
    """
    names = [f"_v{i}" for i in range(len(values))]
    rows = df.select(
        F.col(board).alias("_b"),
        F.col(run).alias("_r"),
        F.col(key).alias("_k"),
        F.col(delivered).alias("_d"),
        parse_micros(F.col(timestamp)).alias("_t"),
        *[c.alias(n) for n, c in zip(names, values.values(), strict=True)],
    )
    in_time = Window.partitionBy("_b").orderBy(F.asc_nulls_first("_t"), F.asc_nulls_first("_r"))
    runs = (
        rows.groupBy("_b", "_r").agg(F.max("_t").alias("_t"))
        .select("_b", "_r", F.lead(F.struct("_r")).over(in_time).alias("_next"), F.row_number().over(in_time).alias("_n"))
        .select(F.col("_b").alias("_rb"), F.col("_r").alias("_rr"), "_next", "_n")
    )
    valid = latest_delivery(rows, ["_b", "_r", "_k"], "_d", names)
    placed = valid.join(runs, F.col("_b").eqNullSafe(F.col("_rb")) & F.col("_r").eqNullSafe(F.col("_rr")))
    sides = F.array(
        F.when(F.col("_n") > 1, F.struct(F.col("_r").alias("run"), F.lit(1).alias("sign"))),
        F.when(F.col("_next").isNotNull(), F.struct(F.col("_next")["_r"].alias("run"), F.lit(-1).alias("sign"))),
    )
    signed = placed.select("_b", "_k", *names, F.explode(F.filter(sides, lambda s: s.isNotNull())).alias("_s"))
    residue = (
        signed.groupBy("_b", F.col("_s")["run"].alias("_r"), "_k", *names).agg(F.sum(F.col("_s")["sign"]).alias("_sign")).filter(F.col("_sign") != 0)
    )
    labelled = residue.groupBy("_b", "_r", "_k").agg(F.max("_sign").alias("_new"), F.min("_sign").alias("_old"))
    kind = F.when(F.col("_old") > 0, "added").when(F.col("_new") < 0, "removed").otherwise("changed")
    return labelled.select(F.col("_b").alias(board), F.col("_r").alias(run), F.col("_k").alias(key), kind.alias("change_kind"))


def same_to(column: Column, digits: int) -> Column:
    """A double compared at a number of decimals, -0.0 as 0.0."""
    return F.round(column, digits) + F.lit(0.0)

