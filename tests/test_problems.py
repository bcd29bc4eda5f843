"""The general data problems on small tables, with brute-force twins and the defined edge cases."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from brindle.functions.url import normalize_domain
from brindle.operators.history import validity_periods
from brindle.operators.snapshots import same_to, snapshot_changes
from brindle.operators.spikes import FEATURES, SpikeRules, fit_trees, implausible_readings, reading_scores, score_trees, split_hot
from brindle.operators.units import common_units, equal_amounts, parse_line

SNAP = "board_id bigint, run_id bigint, recipe_id string, rank int, hierarchical_score double, timestamp string, delivered_at timestamp, extra string, board string"


def changes(df):
    out = snapshot_changes(df, "board_id", "run_id", "recipe_id", {"rank": F.col("rank"), "s": same_to(F.col("hierarchical_score"), 6)}, "timestamp", "delivered_at")
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_snapshot_changes_by_hand(spark):
    from datetime import datetime

    d1, d2 = datetime(2026, 1, 1), datetime(2026, 1, 2)
    t1, t2, t3 = "2026-01-01T00:00:00Z", "2026-01-02T02:00:00+02:00", "2026-01-03T00:00:00"
    rows = [
        (1, 30, "a", 1, 4.5, t1, d1), (1, 30, "b", 2, None, t1, d1), (1, 30, "c", 3, 4.0, t1, d1), (1, 30, None, 9, 1.0, t1, d1),
        (1, 20, "a", 1, 4.5000000001, t2, d1), (1, 20, "b", 2, None, t2, d1), (1, 20, "c", 3, 4.1, t2, d2), (1, 20, "c", 3, 4.0, t2, d1), (1, 20, "c", 3, 4.1, t2, d2),
        (1, 10, "a", 2, 4.5, t3, d1), (1, 10, "d", 1, float("nan"), t3, d1),
        (2, 5, "a", 1, 1.0, t1, d1),
        (3, 1, "x", 1, -0.0, t1, d1), (3, 2, "x", 1, 0.0, t2, d1),
    ]
    df = spark.createDataFrame([(*r, None, "clash") for r in rows], SNAP)
    want = [(1, 10, "a", "changed"), (1, 10, "b", "removed"), (1, 10, "c", "removed"), (1, 10, "d", "added"), (1, 20, None, "removed"), (1, 20, "c", "changed")]
    assert changes(df) == sorted(want, key=str)
    assert changes(df.limit(0)) == []


def test_history_chains_and_periods(spark):
    day = "2026-01-{:02d}T00:00:00Z"
    rows = [
        ("v", "WWW.A.example", "B", "C", day.format(1)), ("v", "a.example.", "A", "B", day.format(1)), ("v", "a.example", None, "A", day.format(1)),
        ("v", "a.example", "C", " c ", day.format(2)), ("v", "a.example", "C", None, day.format(3)), ("v", "a.example", "C", "", day.format(3)),
        ("v", "a.example", "C", "D", "2026-01-20T01:00:00+01:00"), ("v", "a.example", "C", "D", day.format(20)), ("v", "a.example", "D", "E", day.format(21)), ("v", "a.example", "E", "D", day.format(21)),
        ("v", None, "A", "B", day.format(1)), (None, "b.example", "A", "B", day.format(1)), ("v", "b.example", "A", "B", "never"),
    ]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vertical string, domain string, previous_state string, new_state string, timestamp string, state int, valid_from_us string")
    entity = {"vertical": F.col("vertical"), "domain": normalize_domain(F.col("domain"))}
    out = validity_periods(df, entity, F.col("previous_state"), F.col("new_state"), F.col("timestamp"))
    d = 86_400_000_000
    base = 1767225600000000
    assert sorted(tuple(r) for r in out.collect()) == [("v", "a.example", "C", base, base + 19 * d), ("v", "a.example", "D", base + 19 * d, -1)]
    assert validity_periods(df.limit(0), entity, F.col("previous_state"), F.col("new_state"), F.col("timestamp")).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_history_against_a_plain_walk(spark, seed):
    rng = random.Random(seed)
    rows, want = [], []
    for e in ("a", "b", "hot"):
        t, state = 1_700_000_000, None
        history = []
        for _ in range(600 if e == "hot" else 40):
            t += rng.choice([60, 3600, 90_000, 700_000])
            new = rng.choice("XYZ")
            rows.append((e, state, new, f"{np.datetime64(t, 's')}Z"))
            if new != state:
                history.append((t, new))
            state = new
        want += [(e, s, x * 10**6, history[i + 1][0] * 10**6 if i + 1 < len(history) else -1) for i, (x, s) in enumerate(history)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows + rows[:50], "e string, p string, n string, ts string")
    out = validity_periods(df, {"e": F.col("e")}, F.col("p"), F.col("n"), F.col("ts"))
    assert sorted(tuple(r) for r in out.collect()) == sorted(want)


UNIT_LINES = {
    "2 T BUTTER": ("butter", [(2.0, "tablespoon")]), "2 t salt": ("salt", [(2.0, "teaspoon")]), "one and a half tsp salt": ("salt", [(1.5, "teaspoon")]),
    "three quarters of a lb beef": ("beef", [(0.75, "pound")]), "26 and a half ounces (751 g) carrots": ("carrots", [(26.5, "ounce")]), "900-g red lentils, at room temperature": ("red lentils", [(900.0, "gram")]),
    "2 x 175ml of turmeric": ("turmeric", [(350.0, "millilitre")]), "½ lb (227 g) chorizo": ("chorizo", [(0.5, "pound")]), "half a c. milk": ("milk", [(0.5, "cup")]), "1,135 gr fresh lamb neck": ("lamb neck", [(1135.0, "gram")]),
    "1 pound 4 oz parsnips": ("parsnips", [(1.0, "pound"), (4.0, "ounce")]), "4 fl. oz. mirin": ("mirin", [(4.0, "fluid ounce")]), "4 fluid oz mirin": ("mirin", [(4.0, "fluid ounce")]), "0,5 tsp. x": ("x", [(0.5, "teaspoon")]),
    "almonds (2 x 200g), divided": ("almonds", [(400.0, "gram")]), "eggs (4)": ("eggs", []), "7 limes": ("limes", []), "a little cinnamon": ("cinnamon", []), "turkey breast, to taste": ("turkey breast", []), "2½ cups plain yogurt": ("plain yogurt", [(2.5, "cup")]),
    "king prawns – 2 lb 8 oz, peeled": ("king prawns", [(2.0, "pound"), (8.0, "ounce")]), "": ("", []), "a pound of beef": ("beef", [(1.0, "pound")]), "1 1/2 c. milk": ("milk", [(1.5, "cup")]), "0.3ltr cider vinegar": ("cider vinegar", [(0.3, "litre")]),
}


@pytest.mark.parametrize("line", UNIT_LINES)
def test_ingredient_lines(line):
    assert parse_line(line) == UNIT_LINES[line]


def test_odd_lines_do_not_fail():
    for line in [None, "x" * 50_000, "1/0 cup x", "½" * 100, "(((", "İ 2 cups", "1 2 3 4 5", "٣ cups", "g", "2 x x 3 g"]:
        parse_line(line)


def test_equal_amounts(spark):
    pairs = [
        (1, ["1 lb beef", "2 cups milk", "3 tbsp oil", None, ""], ["454 g beef", "0.47 l milk", "45 g oil", "1 pounds beef"]),
        (2, None, ["1 lb beef"]), (3, [], []), (4, ["1 lb 8 oz rice", "1 lb 8 oz rice"], ["24 oz rice"]), (5, ["100 g x"], ["0.095 kg x"]), (6, ["100 g x"], ["0.0949 kg x"]), (4, ["1 lb 8 oz rice", "1 lb 8 oz rice"], ["24 oz rice"]),
    ]
    df = spark.createDataFrame([(*p, "clash") for p in pairs], "pair_id bigint, l array<string>, r array<string>, name string")
    assert sorted(tuple(r) for r in equal_amounts(df, "pair_id", "l", "r").collect()) == [(1, 1, 1), (1, 2, 2), (4, 1, 1), (4, 2, 1), (5, 1, 1)]
    assert equal_amounts(df.limit(0), "pair_id", "l", "r").count() == 0
    lines = spark.createDataFrame([(1, "l", 1, "1 cup 2 tbsp oil")], "id bigint, side string, line bigint, text string")
    row = common_units(lines).first()
    assert row["unit"] == "cup" and abs(row["amount"] - (236.5882365 + 2 * 14.78676478125)) < 1e-9


def series(rng, key, source, kind, n):
    t, count, rating = 1_700_000_000, rng.randint(200, 2000), round(rng.uniform(3.8, 4.8), 2)
    out = []
    for _ in range(n):
        t += rng.randint(80_000, 95_000)
        if kind == "steady":
            count += rng.randint(2, 14)
            r = rating + rng.choice([-0.01, 0, 0.01])
            c = count
        elif kind == "quiet":
            count += rng.random() < 0.1
            r, c = rating, count
        else:
            r, c = rating + rng.gauss(0, 0.1), int(count * np.exp(rng.gauss(0, 0.23)))
        out.append([key, source, t, round(min(5.0, r), 2), int(c)])
    return out


def test_implausible_readings(spark):
    rng = random.Random(3)
    data = [r for k in range(40) for r in series(rng, f"s{k}", "steady", "steady", 25)] + [r for k in range(40) for r in series(rng, f"q{k}", "quiet", "quiet", 25)] + [r for k in range(40) for r in series(rng, f"v{k}", "volatile", "volatile", 25)]
    want = set()

    def at(key, i):
        return [j for j, r in enumerate(data) if r[0] == key][i]

    def plant(key, i, field, value):
        data[at(key, i)][field] = value
        want.add(at(key, i))

    for i in (8, 9, 10):
        plant("s1", i, 4, data[at("s1", i)][4] * 2)
    plant("s2", 12, 3, 3.1)
    plant("v1", 9, 4, data[at("v1", 9)][4] * 12)
    plant("q1", 5, 4, 9_000)
    plant("s3", 7, 3, 5.9)
    plant("s3", 15, 4, -1)
    plant("v2", 3, 4, 999_999_999)
    plant("s5", 23, 4, 40)
    for i in range(6, 18):
        data[at("s4", i)][4] = data[at("s4", 6)][4]
        if i > 6:
            want.add(at("s4", i))
    for i in range(18, 25):
        data[at("s4", i)][4] += 200
    for i in range(12, 25):  # a lasting rise is no case
        data[at("v3", i)][4] *= 3
    data[at("s6", 4)][4] = None
    rows = [(j, r[0], r[1], f"{np.datetime64(r[2], 's')}Z", r[3], r[4]) for j, r in enumerate(data)]
    first = at("s2", 12)
    rows += [(10**6, *rows[first][1:]), (10**6 + 1, None, "steady", rows[0][3], 7.0, 3), (10**6 + 2, "s9", None, "bad", None, None), (10**6 + 3, "n1", None, rows[0][3], float("nan"), None)]
    df = spark.createDataFrame([(*r, 1, 2.0) for r in rows], "obs_id bigint, recipe_id string, source string, timestamp string, rating double, rating_count bigint, t int, score double")
    found = [r[0] for r in implausible_readings(df, "obs_id", "recipe_id", "source", "timestamp", "rating", "rating_count").collect()]
    assert len(found) == len(set(found))
    assert set(found) == want | {10**6, 10**6 + 1}
    assert implausible_readings(df.limit(0), "obs_id", "recipe_id", "source", "timestamp", "rating", "rating_count").count() == 0
    hot = SpikeRules(hot_rows=6, halo=5)
    split = {r[0] for r in implausible_readings(df, "obs_id", "recipe_id", "source", "timestamp", "rating", "rating_count", hot).collect()}
    planted_spikes = want - {at("s4", i) for i in range(6, 18)} - {at("s1", i) for i in (8, 9, 10)}
    assert planted_spikes <= split


def test_hot_series_are_split_with_halo(spark):
    df = spark.createDataFrame([("h", i) for i in range(100)] + [("c", i) for i in range(5)], "key string, t bigint")
    rows = split_hot(df, "key", "t", 20, 3).collect()
    assert sorted((r["key"], r["t"]) for r in rows if not r["halo"]) == sorted([("h", i) for i in range(100)] + [("c", i) for i in range(5)])
    parts = {r["part"] for r in rows if r["key"] == "h" and not r["halo"]}
    assert len(parts) == 5 and {r["part"] for r in rows if r["key"] == "c"} == {0}
    assert max(sum(r["part"] == p and r["key"] == "h" for r in rows) for p in parts) <= 26


def test_cuts_of_uneven_series_change_no_feature(spark):
    rng = random.Random(5)
    t0 = 1_700_000_000
    # a stray early date, a stretch of nulls, long runs and a spike at and across cuts
    counts = [100 + 3 * i for i in range(300)]
    counts[45:130] = [counts[45]] * 85
    counts[180] *= 9
    counts[200:215] = [None] * 15
    counts[220:260] = [counts[220]] * 40
    at = [t0 - 10**9] + [t0 + 86_400 * i for i in range(1, 300)]
    rows = [("h", "s", at[i], 4.0 + rng.random() / 10, counts[i]) for i in range(300)] + [("c", "s", t0 + 86_400 * i, 4.5, 50 + i) for i in range(15)]
    df = spark.createDataFrame(rows, "key string, source string, at bigint, r double, c bigint").withColumn("ts", F.date_format(F.timestamp_seconds("at"), "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    columns = ["key", "t", "run_length", "run_at", "gap_count", *FEATURES]

    def features(rules):
        return sorted(tuple(r) for r in reading_scores(df, "key", "source", "ts", "r", "c", rules).select(*[F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(-1.0)), F.lit(-1.0)).alias(c) if c != "key" else F.col(c) for c in columns]).collect())

    assert features(SpikeRules(hot_rows=20, halo=10)) == features(SpikeRules())


def test_parts_of_uneven_series_are_bounded(spark):
    df = spark.createDataFrame([("h", 0), *[("h", 10**9 + i) for i in range(99)]], "key string, t bigint")
    rows = split_hot(df, "key", "t", 20, 3).collect()
    parts = {p: sorted(r["t"] for r in rows if r["part"] == p) for p in range(5)}
    times = sorted(r["t"] for r in rows if not r["halo"])
    assert len(times) == 100 and {r["part"] for r in rows} == set(range(5))
    assert all(ts == times[max(0, 20 * p - 3) : 20 * p + 23] for p, ts in parts.items())


def test_forest_isolates_outliers():
    rng = np.random.default_rng(0)
    x = np.abs(rng.normal(0, 0.05, 500))
    trees = fit_trees(x, 0.1, 60, 128, 1)
    scores = score_trees(*trees, np.r_[x, 0.5, 5.0])
    assert scores[-1] >= scores[-2] > np.quantile(scores[:500], 0.99)
    again = fit_trees(x[::-1], 0.1, 60, 128, 1)
    assert all(np.array_equal(a, b) for a, b in zip(trees, again, strict=True))
    # the step function is what walking each tree gives: a value far below and far above all bounds get the end scores
    assert score_trees(*trees, np.array([-1.0, 1e9])).tolist() == [trees[1][0], trees[1][-1]]
    assert score_trees(*fit_trees(np.zeros(0), 1.0, 5, 8, 1), np.array([3.0])).tolist() == [0.0]
    assert len(fit_trees(np.zeros(1), 1.0, 5, 8, 1)[1]) >= 1


def test_forest_decides(spark, sf_dir):
    """Without the forest the result is another; source by source, the same departure is a case or is none."""
    log = spark.read.parquet(f"{sf_dir}/observations.parquet")
    args = ("obs_id", "recipe_id", "source", "timestamp", "rating", "rating_count")
    found = {r[0] for r in implausible_readings(log, *args).collect()}
    without = {r[0] for r in implausible_readings(log, *args, SpikeRules(cut=-99.0, support=-99.0)).collect()}
    assert found and found < without and len(without) > 1.5 * len(found)
    blocks = {r[0] for r in implausible_readings(log, *args, SpikeRules(block_sources=7)).collect()}
    assert blocks == found
