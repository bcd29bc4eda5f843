from __future__ import annotations

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from brindle.operators import dedupe as D
from brindle.operators import quality as Q
from brindle.operators import relational as R
from brindle.operators import score as S
from brindle.operators import serving as V
from brindle.operators import timeseries as T
from brindle.operators.graph import connected_components
from brindle.operators.urls import alias_groups, is_trap
from brindle.streaming import windows as W

ITEMS = "id string, source string, rating double, n bigint, confidence double, categories array<string>, histogram map<string, bigint>"


def test_scores_and_nulls(spark):
    rows = [("a", "s", 4.9, 5000, 1.0, ["X"], {}), ("b", "s", 4.0, 1, None, None, None), ("c", "t", 4.5, 100, 0.5, [], {"5": 60, "4": 40, "bad": 3}), ("d", "t", 4.5, 100, 1.0, ["X", "X", "Y"], {"5": 1})]
    df = spark.createDataFrame(rows, ITEMS)
    got = {r["id"]: r for r in S.ranked(S.score_items(df)).collect()}
    assert sorted(r["rank"] for r in got.values()) == [1, 2, 3, 4]
    assert got["c"]["from_histogram"] and not got["d"]["from_histogram"]
    assert got["b"]["expected"] == pytest.approx(got["b"]["prior"]) and got["b"]["evidence"] == pytest.approx(0.04) and got["c"]["evidence"] == pytest.approx(0.06)
    assert S.score_items(df.limit(0)).count() == 0
    assert len(S.robustness_grid()) == 36
    top = S.rank_top(S.score_items(df), 2).orderBy("rank").collect()
    assert [r["id"] for r in top] == [i for i, _ in sorted(((i, r["rank"]) for i, r in got.items()), key=lambda x: x[1])[:2]]


def test_uncertainty_is_histogram_then_ready_history_then_theory(spark):
    stars = {"5": 60, "4": 40}
    rows = [("ready", "s", 4.5, 100, 1.0, ["X"], None), ("floor", "s", 4.5, 10, 1.0, ["X"], None), ("unready", "s", 4.5, 600, 1.0, ["X"], None), ("absent", "s", 4.5, 3000, 1.0, ["X"], None), ("stars", "s", 4.5, 100, 1.0, ["X"], stars)]
    buckets = spark.createDataFrame([("0-24", 0.0, True), ("25-99", None, None), ("100-499", 0.2, True), ("500-1999", 0.01, False)], "bucket string, penalty double, ready boolean")
    df = spark.createDataFrame(rows, ITEMS)
    plain = {(r["scenario"], r["id"]): r["uncertainty"] for r in S.score_items(df, [S.Params(), S.Params(1, uncertainty_cap=0.15)]).collect()}
    got = {(r["scenario"], r["id"]): r for r in S.score_items(df, [S.Params(), S.Params(1, uncertainty_cap=0.15)], buckets).collect()}
    assert len(got) == 10
    assert got[0, "ready"]["uncertainty"] == pytest.approx(0.2) and got[1, "ready"]["uncertainty"] == pytest.approx(0.15)
    assert got[0, "floor"]["uncertainty"] == pytest.approx(0.25 * plain[0, "floor"]) and got[1, "floor"]["uncertainty"] == pytest.approx(0.25 * 0.15)
    for i in ("unready", "absent", "stars"):
        assert got[0, i]["uncertainty"] == plain[0, i]
    assert got[0, "ready"]["score"] == pytest.approx(got[0, "ready"]["posterior"] - 0.2)


def test_ranking_queries_take_the_ready_history(spark, sf_dir):
    from brindle.bindings import recipes
    from brindle.plans.history import calibrated
    from brindle.plans.ranking import score_parts

    ready = {r["bucket"]: r["penalty"] for r in calibrated(spark, sf_dir).filter("ready").collect()}
    parts = score_parts(spark, sf_dir).join(recipes(spark, sf_dir).select("id", "n", S.volume_bucket(F.col("n")).alias("bucket")), "id").filter("not from_histogram").collect()
    assert any(r["bucket"] in ready for r in parts)
    for r in parts:
        theory = min(0.25, 1.96 * 2.5 / max(1.0, r["n"] + r["m"]) ** 0.5)
        assert r["uncertainty"] == pytest.approx(min(0.25, max(ready[r["bucket"]], 0.25 * theory)) if r["bucket"] in ready else theory, abs=2e-6)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rating=st.floats(3, 5), prior=st.floats(3, 5), n=st.integers(1, 1000), more=st.integers(1, 10000), m=st.floats(1, 5000))
def test_posterior_moves_from_the_prior_to_the_rating(spark, rating, prior, n, more, m):
    a, b = spark.range(1).select(S.posterior(F.lit(rating), F.lit(n), F.lit(prior), F.lit(m)), S.posterior(F.lit(rating), F.lit(n + more), F.lit(prior), F.lit(m))).first()
    assert min(rating, prior) - 1e-9 <= a <= max(rating, prior) + 1e-9
    assert abs(b - rating) <= abs(a - rating) + 1e-9


def test_correlations_of_ranks(spark):
    base = spark.createDataFrame([(str(i), i) for i in range(1, 6)], "id string, rank int")
    same = base.select(F.lit(1).alias("scenario"), "id", "rank").union(base.select(F.lit(2), "id", 6 - F.col("rank"))).union(base.limit(1).select(F.lit(3), "id", "rank")).union(base.select(F.lit(4), "id", F.lit(1)))
    assert {r[0]: r[1] for r in S.rank_correlation(base, same, 5).collect()} == pytest.approx({1: 1.0, 2: -1.0, 3: None, 4: 1.0})
    assert {r[0]: r[1] for r in S.rank_gamma(base, same, 5).collect()} == {1: 1.0, 2: -1.0, 3: None, 4: 1.0}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5000), (None, 3)]
    root: dict[int, int] = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for x in root}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def readings(spark, rows):
    return spark.createDataFrame(rows, "key string, t bigint, rating double, n bigint")


def test_anchored_pairs(spark):
    day, hour = T.DAY_US, T.HOUR_US
    hourly = [("h", i * hour, 4.0, 10 + i) for i in range(6)]
    daily = [("d", i * day, 4.0 + i / 10, 10 + i) for i in range(4)]
    stuck = [("s", 0, 4.0, 5), ("s", 2 * day, 4.2, 5), ("s", 3 * day, 4.4, 6), ("s", 3 * day + hour, 4.6, 9), ("s", 4 * day, 5.0, 7)]
    got = sorted((r["key"], r["from_t"] // day, r["to_t"] // day, r["n"], round(r["delta"], 6)) for r in T.anchored_pairs(readings(spark, hourly + daily + stuck)).collect())
    assert got == [("d", 0, 1, 11, 0.1), ("d", 1, 2, 12, 0.1), ("d", 2, 3, 13, 0.1), ("s", 0, 3, 6, 0.4), ("s", 3, 4, 7, 0.6)]
    pairs = T.anchored_pairs(readings(spark, [(f"k{k}", i * day, 4.0, 10 + i) for k in range(10) for i in range(4)])).withColumn("bucket", S.volume_bucket(F.col("n")))
    rows = {r["bucket"]: r for r in T.calibration(pairs, spark.createDataFrame([("0-24",), ("2000+",)], "bucket string")).collect()}
    assert (rows["0-24"]["pairs"], rows["0-24"]["keys"], rows["0-24"]["span_days"], rows["0-24"]["ready"]) == (30, 10, 3.0, False) and rows["2000+"]["pairs"] == 0
    assert T.anchored_pairs(readings(spark, [])).count() == 0


def test_as_of_and_streaks(spark):
    o = readings(spark, [("a", 10, 1.0, 1), ("a", 20, 2.0, 1), ("b", 35, 3.0, 9)])
    cuts = spark.createDataFrame([(5,), (15,), (20,), (40,)], "cutoff bigint")
    assert sorted((r["cutoff"], r["key"], r["t"]) for r in T.as_of(o, cuts).collect()) == [(15, "a", 10), (20, "a", 20), (40, "a", 20), (40, "b", 35)]
    assert [tuple(r) for r in T.nearest_after(o, cuts.toDF("target"), 15, 5).collect()] == [(20, "b", 35, 3.0, 9)]
    runs = spark.createDataFrame([("s", 1, True), ("s", 2, False), ("s", 3, True), ("s", 4, True), ("q", 1, False)], "key string, t bigint, ok boolean")
    assert sorted(tuple(r) for r in T.latest_streaks(runs).collect()) == [("q", False, 1), ("s", True, 2)]


def test_pages_number_all_rows_in_order(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v")).repartition(7)
    rows = R.pages(df, [F.col("v")], 100).orderBy("nth").collect()
    assert [r["v"] for r in rows] == list(range(1000)) and [r["nth"] for r in rows] == list(range(1, 1001)) and rows[-1]["page"] == 10
    assert R.pages(df.limit(0), [F.col("v")], 100).count() == 0


def test_selection_and_merges(spark):
    df = spark.createDataFrame([("a", i) for i in range(9)] + [("b", 1)], "k string, i int")
    assert sorted(r["i"] for r in R.even_sample(df, "k", [F.col("i")], 3).filter("k = 'a'").collect()) == [0, 4, 8]
    assert [(r["k"], r["i"]) for r in R.capped_per_key(df, "k", [F.col("i"), F.col("k")], 2, 4).orderBy("overflow", "i", "k").collect()] == [("a", 0), ("a", 1), ("b", 1), ("a", 2)]
    base, other = spark.createDataFrame([("a", 1)], "k string, x int"), spark.createDataFrame([("a", 5, 6)], "k string, x int, y int")
    assert R.merge_by_key(base, "k", {"crawl": other}).first().asDict() == {"k": "a", "x": 1, "crawl_x": 5, "y": 6}
    assert R.shared_values(spark.createDataFrame([("p", "a"), ("p", "b"), ("p", "b"), ("q", "a"), ("", "a"), ("", "b"), (None, "c")], "v string, m string"), "v", "m").collect()[0].asDict() == {"v": "p", "members": 2, "first_member": "a"}


def test_findings(spark):
    rows = [("a", 4.0, 5, 4.0, 9, 1.0, 1.0, "verified"), ("b", 4.0, 1000, 4.3, 100, 1.5, 0.5, None), ("c", 4.0, 351, 4.0, 100, 50.0, None, "conflict"), ("d", 4.0, 350, None, None, None, 1.0, "x"), ("e", 4.0, 1000, 3.9, 100, None, 1.0, "x")]
    df = spark.createDataFrame(rows, "id string, rating double, n bigint, previous_rating double, previous_n bigint, hours double, confidence double, status string")
    assert sorted((r["id"], r["type"]) for r in Q.row_anomalies(df).collect()) == [("a", "review_count_decrease"), ("b", "evidence_conflict"), ("b", "hourly_review_count_spike"), ("b", "rating_shift"), ("c", "evidence_conflict"), ("c", "review_count_spike"), ("e", "review_count_spike")]
    broken = Q.violations(spark.createDataFrame([(1, 6.0), (2, None), (3, 4.0)], "i int, rating double"), "i", {"rating": F.col("rating").between(0, 5)})
    assert sorted(r["row"] for r in broken.collect()) == [1, 2]
    with pytest.raises(Exception, match="contract"):
        Q.assert_none(broken, "contract").collect()
    assert Q.assert_none(broken.limit(0), "contract").count() == 0


def test_duplicate_groups(spark):
    i, s = ["2 cups chicken wings", "1 tsp salt", "pepper"], ["Toss and fry the wings."]
    rows = [(1, "Crispy Chicken Wings", i, s, None, "Ann", 5, "", None), (2, "Easy Chicken Wings", i, s, None, "Bo", 9, None, ""), (3, "Apple Pie", ["apples"], ["Bake."], None, None, 1, "zz", None), (4, "", None, None, "https://a/x", None, None, None, None), (5, None, [], [], "https://a/x", None, 2, None, None)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "id bigint, title string, ingredients array<string>, instructions array<string>, url string, author string, n bigint, simhash string, image string, score string")
    got = sorted((r["id"], r["representative"], round(r["confidence"], 3), r["members"]) for r in D.duplicate_groups(df).collect())
    assert got == [(1, 2, 1.0, 2), (2, 2, 1.0, 2), (4, 5, 1.0, 2), (5, 5, 1.0, 2)]
    assert D.duplicate_groups(df.limit(0)).count() == 0


def test_label_queue_finds_unlabelled_pairs_by_blocks(spark):
    stock, other = ["2 cups flour", "1 cup sugar", "3 eggs", "butter"], ["2 cups flour", "1 cup sugar", "3 eggs", "vanilla"]
    rows = [
        (0, "a", "Lemon Cake", stock), (1, "b", "Lemon Cake Best", other),  # labelled
        (2, "c", "Lemon Cake", other), (3, "d", "Roast Beef", ["beef", "salt"]),
        (4, "a", "Lemon Cake", stock),  # the same recipe again
    ]
    df = spark.createDataFrame([(i, r, t, g, None, None, None, 1, None, None) for i, r, t, g in rows], "id bigint, recipe_id string, title string, ingredients array<string>, instructions array<string>, url string, author string, n bigint, simhash string, image string")
    done = spark.createDataFrame([("b", "a"), (None, "c")], "x string, y string")
    got = D.label_queue(df, done).collect()
    p = D.prepared(df)
    score = {(r["a"], r["b"]): r["score"] for r in D.similarity(D.blocked_pairs(D.block_keys(p)), p).collect()}
    want = {("a", "c"): score[0, 2], ("b", "c"): score[1, 2]}
    assert {(r["left_id"], r["right_id"]): r["similarity"] for r in got} == {k: v for k, v in want.items() if 0.72 <= v <= 0.92} != {}
    assert [r["distance"] for r in got] == sorted(r["distance"] for r in got)
    assert len(D.label_queue(df, done.limit(0)).collect()) > len(got) and len(D.label_queue(df, done, limit=1).collect()) == 1
    assert D.label_queue(df.limit(0), done).count() == 0


def test_diverse_order(spark):
    rows = [("p", f"i{k}", "x" if k < 3 else "y", 5 - k / 100) for k in range(5)] + [("q", "a", None, 1.0)]
    got = V.diverse_order(spark.createDataFrame(rows, "profile string, id string, category string, score double")).orderBy("profile", "place").collect()
    assert [r["id"] for r in got] == ["i0", "i3", "i1", "i4", "i2", "a"] and [r["place"] for r in got] == [1, 2, 3, 4, 5, 1]


def test_addresses(spark):
    df = spark.createDataFrame([("https://a/x/x/x/x",), ("https://a/?a=1&b=2&c=3&d=4&e=5",), ("https://a/wp-json/1",), ("https://a/b",), ("https://a/" + "/".join(map(str, range(11))),)], "u string")
    assert [r[0] for r in df.select(is_trap(F.col("u"))).collect()] == [True, True, True, False, True]
    rows = spark.createDataFrame([("https://A/x#1", 3), ("https://a/x?utm_a=1", 1), ("", 9), (None, 2)], "u string, t int")
    assert [tuple(r) for r in alias_groups(rows, "u", "t", "t").collect()] == [("https://a/x", 2, 2, 1, 3)]


def test_streams_write_what_batches_give(spark, tmp_path):
    events = spark.sql("select timestamp_ntz'2026-01-01 00:00:00' + make_interval(0, 0, 0, 0, int(id % 7), 0, 0) ts, id % 3 user_id, 'e' event_type, double(id) value, id event_id from range(60)")
    events.write.parquet(str(tmp_path / "events.parquet"))
    stream = W.stream_table(spark, str(tmp_path), "events")
    for make in (W.tumbling, W.sliding, W.sessions):
        assert sorted(map(tuple, W.drain(make(stream), "complete").collect())) == sorted(map(tuple, make(events).collect()))
    once = W.drain(W.first_deliveries(stream.union(stream), ["event_id"]), "append")
    assert once.count() == 60


def test_golden_scores(spark):
    """Scores of five items worked out by hand."""
    from brindle.operators import score as S

    rows = [("a", 4.90, 5000, 1.00), ("b", 5.00, 100, 1.00), ("c", 4.80, 1000, 0.65), ("d", 4.70, 10000, 1.00), ("e", 4.95, 20, 1.00)]
    items = spark.createDataFrame([(i, "example.com", r, n, c, ["Chicken"], {}) for i, r, n, c in rows], "id string, source string, rating double, n bigint, confidence double, categories array<string>, histogram map<string, bigint>")
    got = {r["rank"]: (r["id"], round(r["score"], 9)) for r in S.ranked(S.score_items(items)).collect()}
    assert got == {1: ("a", 4.809175335), 2: ("b", 4.711960435), 3: ("e", 4.704234183), 4: ("c", 4.687473512), 5: ("d", 4.676736588)}
    apart = S.score_items(items.withColumn("cutoff", F.lit(1)).unionByName(items.withColumn("cutoff", F.lit(2))), by=["cutoff"])
    assert sorted((r["cutoff"], r["id"], round(r["score"], 9)) for r in apart.collect()) == sorted((c, i, s) for c in (1, 2) for i, s in got.values())


def test_configuration_grid():
    from brindle.operators.score import Params, configuration_grid

    values = {"bias_cap": [0.1, 0.15, 0.2], "evidence_scale": [0.1, 0.2, 0.3], "source_pooling": [10.0, 20.0], "category_pooling": [10.0, 20.0], "uncertainty_cap": [0.2, 0.25], "volume_multiplier": [0.8, 1.0, 1.2]}
    grid = configuration_grid(values)
    assert len(grid) <= 96 and grid[0] == Params() and len({p for p in grid}) == len(grid) and grid == configuration_grid(values)
    assert len(configuration_grid(values, most=1000)) == 216 and [p.scenario for p in grid] == list(range(len(grid)))


def test_numbers_within_groups(spark):
    from brindle.operators.relational import numbered_within

    rows = [(k, i) for k in "abc" for i in range(50 if k == "a" else 3)]
    df = spark.createDataFrame(rows, "k string, i int").repartition(7)
    got = sorted((r["k"], r["nth"], r["i"]) for r in numbered_within(df, ["k"], [F.desc("i")]).collect())
    assert got == sorted((k, n, i) for k in "abc" for n, i in enumerate(sorted((i for x, i in rows if x == k), reverse=True), 1))
    assert numbered_within(df.limit(0), ["k"], [F.desc("i")]).count() == 0


def test_duplicates_by_evidence_lose_no_pair(spark, sf_dir):
    """Every pair at or above the threshold among all blocked pairs is found by the small keys, with the same score."""
    from brindle.operators import dedupe as D
    from brindle.plans.entities import records

    p = D.prepared(records(spark, sf_dir))
    whole = {(r["a"], r["b"]): round(r["score"], 9) for r in D.similarity(D.blocked_pairs(D.block_keys(p)), p).filter(F.col("score") >= D.THRESHOLD).collect()}
    small = {(r["a"], r["b"]): round(r["score"], 9) for r in D.similarity(D.duplicate_candidates(p), p, D.THRESHOLD).collect()}
    assert whole == small and whole
