"""The best representative of each group of duplicate records, and consensus values field by field."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brindle.functions.time import parse_micros
from brindle.functions.url import normalize_url, url_part
from brindle.session import checkpointed

#: The heaviest distinct values of a group that make its profile; all others vote on the columns of that profile.
GUIDE = 200
#: Fields on which the members of a group are to agree.
FIELDS = ["title", "author", "address"]

_TOKENS = re.compile(r"\w+|[^\w\s]")


def latest_records(df: DataFrame, key: str, timestamp: str, order: str, fields: list[str]) -> DataFrame:
    """One row per key: that of the latest instant, of several the one with the greatest order column. Unreadable
    timestamps are earliest; a null key is no record. Combined before the shuffle, whatever the rows of a key."""
    best = F.max(F.struct(F.coalesce(parse_micros(F.col(timestamp)), F.lit(-(1 << 62))).alias("t"), F.col(order).alias("o"), *[F.col(f) for f in fields]))
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(best.alias("_best")).select(key, *[F.col("_best")[f].alias(f) for f in fields])


def page_records(df: DataFrame) -> DataFrame:
    """Latest record of each recipe with its page in one spelling; recipes without a page are left out."""
    records = latest_records(df, "recipe_id", "timestamp", "obs_id", ["canonical_url", "url", "source", "evidence_confidence", "rating_count", "title", "author"])
    canonical = F.trim("canonical_url")
    address = F.when(canonical.isNull() | (canonical == ""), F.trim("url")).otherwise(canonical)
    return records.withColumn("address", address).withColumn("page", F.trim(normalize_url(F.col("address")))).filter("page <> ''")


def survivors_of(records: DataFrame) -> DataFrame:
    """(group_id, recipe_id, page, members) of page_records: the best record of every page that two or more share."""
    host = F.regexp_replace(F.regexp_replace(url_part(F.col("page"), "netloc"), r"^.*@", ""), r":\d*$", "")
    own = F.coalesce(F.lower(F.trim("source")) == host, F.lit(False))
    low = F.lit(-math.inf)
    best = F.min(
        F.struct(
            (-F.coalesce(F.nanvl("evidence_confidence", F.lit(None).cast("double")), low)).alias("c"),
            (~own).alias("s"),
            (-F.coalesce(F.col("rating_count").cast("double"), low)).alias("n"),
            "recipe_id",
        )
    )
    groups = records.groupBy("page").agg(F.min("recipe_id").alias("group_id"), best.alias("best"), F.count(F.lit(1)).alias("members"))
    return groups.filter("members > 1").select("group_id", F.col("best.recipe_id").alias("recipe_id"), "page", "members")


def surviving_records(df: DataFrame, guide: int = GUIDE) -> DataFrame:
    """(group_id, recipe_id, page, members, title, author, address): of each page that two or more recipes are copies
    of, the survivor, and the values the group agrees on, field by field.

    The survivor has the highest evidence_confidence, then a source equal to the page's host, then the highest
    rating_count, then the smallest recipe_id; nulls (and NaN) are lowest. The order is lexicographic, so it is an
    associative minimum: groups are combined before the shuffle and never collected, a page may have any share of
    all recipes. group_id is the smallest recipe_id. The fields are built by token-level consensus (consensus_values),
    weighted by evidence_confidence; a field no member has is null. The log is read once: the latest record of each
    recipe is written and read for both. An empty table gives no rows; extra columns are ignored.
    """
    records = checkpointed(page_records(df))
    survivors = survivors_of(records)
    members = records.join(survivors.select("page", "group_id"), "page")
    each = members.select("group_id", "evidence_confidence", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in FIELDS])).alias("v"))
    agreed = _agreed(each.select(F.struct("group_id", "v.field").alias("grp"), F.col("v.value").alias("value"), "evidence_confidence"), "value", "evidence_confidence", guide)
    wide = agreed.groupBy(F.col("grp.group_id").alias("group_id")).agg(*[F.max(F.when(F.col("grp.field") == f, F.col("value"))).alias(f) for f in FIELDS])
    return survivors.join(wide, "group_id", "left").select("group_id", "recipe_id", "page", "members", *FIELDS)


# ---- token consensus ---------------------------------------------------------------------------------------------


def tokens(value: str) -> list[str]:
    return _TOKENS.findall(value)


def path(columns: list[dict[str, float]], value: list[str], total: float) -> list[tuple[int | None, str]]:
    """Global alignment of a value to a profile (one table of weighted tokens per column), in order: the column and the
    token it takes, '' for a gap, or no column and a token between columns. A token scores the weight its column
    already gives it; unlike tokens may share a column, gaps cost half of a match."""
    rows, cols = len(columns), len(value)
    gap = -0.5
    best = [[0.0] * (cols + 1) for _ in range(rows + 1)]
    for i in range(1, rows + 1):
        best[i][0] = i * gap
    for j in range(1, cols + 1):
        best[0][j] = j * gap
    for i in range(1, rows + 1):
        column = columns[i - 1]
        for j in range(1, cols + 1):
            match = 2 * column.get(value[j - 1], 0.0) / total - 0.75
            best[i][j] = max(best[i - 1][j - 1] + match, best[i - 1][j] + gap, best[i][j - 1] + gap)
    out: list[tuple[int | None, str]] = []
    i, j = rows, cols
    while i or j:
        if i and j and best[i][j] == best[i - 1][j - 1] + (2 * columns[i - 1].get(value[j - 1], 0.0) / total - 0.75):
            i, j = i - 1, j - 1
            out.append((i, value[j]))
        elif i and best[i][j] == best[i - 1][j] + gap:
            i -= 1
            out.append((i, ""))
        else:
            j -= 1
            out.append((None, value[j]))
    return out[::-1]


def align(columns: list[dict[str, float]], value: list[str], weight: float, total: float) -> list[dict[str, float]]:
    """Add a value to a profile; its tokens between columns become columns that all values before leave empty."""
    out: list[dict[str, float]] = []
    for column, token in path(columns, value, total):
        if column is None:
            out.append({token: weight, "": total})
        else:
            out.append({**columns[column], token: columns[column].get(token, 0.0) + weight})
    return out


def consensus(values: list[tuple[str, float]]) -> list[str]:
    """Tokens that win the weighted vote of their column after progressive alignment, heaviest value first."""
    ordered = sorted(values, key=lambda v: (-v[1], v[0]))
    columns: list[dict[str, float]] = []
    total = 0.0
    for value, weight in ordered:
        columns = align(columns, tokens(value), weight, max(total, 1e-9))
        total += weight
    voted = (min(c.items(), key=lambda x: (-x[1], x[0]))[0] for c in columns)
    return [t for t in voted if t]


def token_distance(a: list[str], b: list[str]) -> int:
    """Edits of tokens that turn one value into another."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def _column_votes(columns: list[dict[str, float]]) -> list[dict]:
    return [{"column": i, "token": t, "weight": float(w)} for i, c in enumerate(columns) for t, w in c.items()]


_VOTES = pa.list_(pa.struct([("column", pa.int64()), ("token", pa.string()), ("weight", pa.float64())]))


_PROFILE = pa.schema([("key", pa.string()), ("votes", _VOTES), ("total", pa.float64()), ("last", pa.string()), ("last_weight", pa.float64())])
_PROFILE_DDL = "key string, votes array<struct<column: bigint, token: string, weight: double>>, total double, last string, last_weight double"


def _profile_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per group the votes of its heaviest values in the columns of their progressive alignment. Rows come by group,
    heaviest first; the profile of one group is all that is kept."""
    key, columns, total, last, weight = None, [], 0.0, None, 0.0
    for b in batches:
        out = []
        for k, value, w in zip(*(b.column(c).to_pylist() for c in ("key", "value", "weight")), strict=True):
            if k != key:
                if key is not None:
                    out.append((key, _column_votes(columns), total, last, weight))
                key, columns, total = k, [], 0.0
            columns = align(columns, tokens(value), w, max(total, 1e-9))
            total, last, weight = total + w, value, w
        yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], f.type) for i, f in enumerate(_PROFILE)], schema=_PROFILE)
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((key, _column_votes(columns), total, last, weight), _PROFILE, strict=True)], schema=_PROFILE)


def _vote_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each further value adds to the columns of its group's profile; tokens between columns add nothing."""
    for b in batches:
        out = []
        for value, weight, votes, total in zip(*(b.column(c).to_pylist() for c in ("value", "weight", "votes", "total")), strict=True):
            columns: list[dict[str, float]] = [{} for _ in range(1 + max(v["column"] for v in votes))]
            for v in votes:
                columns[v["column"]][v["token"]] = v["weight"]
            out.append([{"column": k, "token": t, "weight": weight} for k, t in path(columns, tokens(value), total) if k is not None])
        yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(out, _VOTES)], names=["key", "votes"])


def _distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        far = [token_distance(tokens(v), c or []) for v, c in zip(b.column("value").to_pylist(), b.column("agreed").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([b.column("key"), b.column("value"), b.column("weight"), pa.array(far, pa.int64())], names=["key", "value", "weight", "far"])


def _agreed(df: DataFrame, field: str, weight: str, guide: int) -> DataFrame:
    """(grp, value) of (grp, field, weight); see consensus_values."""
    text = F.trim(F.regexp_replace(F.col(field), r"\s+", " "))
    heavy = F.greatest(F.coalesce(F.nanvl(F.col(weight).cast("double"), F.lit(None).cast("double")), F.lit(0.01)), F.lit(0.01))
    named = df.select("grp", F.to_json(F.struct("grp")).alias("key"), text.alias("value"), heavy.alias("w")).filter("grp is not null and value <> ''")
    votes = checkpointed(named.groupBy("key", "value").agg(F.first("grp").alias("grp"), F.round(F.sum("w"), 9).alias("weight")))
    order = Window.partitionBy("key").orderBy(F.desc("weight"), "value")
    top = votes.select("key", "value", "weight").withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= guide)
    # the work is in the alignment, not in the bytes, so partitions are not coalesced by their size
    spread = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ready = top.repartition(spread, "key").sortWithinPartitions("key", F.desc("weight"), "value").select("key", "value", "weight")
    profiles = checkpointed(ready.mapInArrow(_profile_batches, _PROFILE_DDL))
    further = votes.join(profiles, "key").filter((F.col("weight") < F.col("last_weight")) | ((F.col("weight") == F.col("last_weight")) & (F.col("value") > F.col("last"))))
    added = further.select("key", "value", "weight", "votes", "total").mapInArrow(_vote_batches, "key string, votes array<struct<column: bigint, token: string, weight: double>>")
    each = profiles.select("key", F.explode("votes").alias("v")).unionByName(added.select("key", F.explode("votes").alias("v")))
    sums = each.groupBy("key", "v.column", "v.token").agg(F.sum("v.weight").alias("weight"))
    winners = sums.groupBy("key", "column").agg(F.min(F.struct((-F.round("weight", 9)).alias("w"), "token")).alias("best"))
    agreed = winners.groupBy("key").agg(F.filter(F.transform(F.array_sort(F.collect_list(F.struct("column", "best.token"))), lambda c: c["token"]), lambda t: t != "").alias("agreed"))
    near = votes.select("key", "value", "weight").join(agreed, "key").mapInArrow(_distances, "key string, value string, weight double, far bigint")
    best = near.groupBy("key").agg(F.min(F.struct("far", (-F.col("weight")).alias("w"), "value")).alias("best"))
    return best.select(F.from_json("key", named.select(F.struct("grp")).schema[0].dataType)["grp"].alias("grp"), F.col("best.value").alias("value"))


def consensus_values(df: DataFrame, group: str, field: str, weight: str, guide: int = GUIDE) -> DataFrame:
    """(grp, value): per group, the existing value of a field that is closest to the group's token consensus.

    Method: token-level consensus. Values are reduced to distinct ones with summed weights before they are grouped. The
    heaviest (up to guide) of a group are aligned progressively to its profile in one task; every other value is then
    aligned to that profile by itself, wherever it lies, and its votes are summed, so every value votes whatever the
    size of the group and no task holds an unbounded group. Tokens vote per column with the weight of their records,
    and the existing value with the fewest token edits to the winners is emitted (ties: heavier, then smaller).
    Values beyond the guide add no columns, which is all that sets them apart from one long progressive alignment.

    Null and blank values and values without a group don't vote; weights that are null count as 0.01; groups
    without a value have no row; an empty table gives no rows.
    """
    return _agreed(df.select(F.col(group).alias("grp"), F.col(field).alias("_value"), F.col(weight).alias("_weight")), "_value", "_weight", guide)
