"""Tables for readers: personal scores, diversity, shopping lists."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.operators.units import common_units


def personal_score(score: Column, confidence: Column, rank_confidence: Column, n: Column) -> Column:
    return score + 0.08 * confidence + 0.04 * rank_confidence + 0.005 * F.least(F.log10(F.greatest(n, F.lit(1)).cast("double")), F.lit(5.0))


def diverse_order(ranked: DataFrame, window: int = 12, step: float = 0.025) -> DataFrame:
    """(profile, id, place) of (profile, id, category, score): greedy order in which an item loses step per earlier
    item of its category, looking window items ahead; ties go to the higher score, then the smaller id.

    The order depends on all earlier picks, so a profile is one stream; it is read in sorted batches with the window
    and one count per category as state, never as a whole.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        profile, pool, seen, place = None, [], {}, 0

        def pick() -> tuple:
            nonlocal place
            best = max(range(len(pool)), key=lambda i: (round(pool[i][3] - step * seen.get(pool[i][2], 0), 9), -i))
            _, item, category, _ = row = pool.pop(best)
            if category:
                seen[category] = seen.get(category, 0) + 1
            place += 1
            return row[0], item, place

        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                if row[0] != profile:
                    while pool:
                        out.append(pick())
                    profile, seen, place = row[0], {}, 0
                pool.append(tuple(row))
                if len(pool) == window:
                    out.append(pick())
            yield pd.DataFrame(out, columns=["profile", "id", "place"])
        rest = []
        while pool:
            rest.append(pick())
        yield pd.DataFrame(rest, columns=["profile", "id", "place"])

    ordered = ranked.select("profile", "id", F.coalesce("category", F.lit("")).alias("category"), "score").repartition("profile").sortWithinPartitions("profile", F.desc("score"), "id")
    return ordered.mapInPandas(run, f"profile {dict(ranked.dtypes)['profile']}, id {dict(ranked.dtypes)['id']}, place bigint")


def shopping_totals(lines: DataFrame) -> DataFrame:
    """(name, kind, amount, lines): total of every ingredient in grams or millilitres over lines
    (id, side, line, text)."""
    return common_units(lines).filter("name <> ''").groupBy("name", "kind").agg(F.sum("amount").alias("amount"), F.count(F.lit(1)).alias("lines"))
