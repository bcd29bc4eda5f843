from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from brindle.functions.text import hamming_similarity
from brindle.operators import catalog as C


def test_earliest_and_latest_fall_back_to_text(spark):
    rows = [("a", "2026-01-02T00:00:00Z"), ("a", "2026-01-02T03:00:00+04:00"), ("a", "soon"), ("b", "xyz"), ("b", "abc"), ("b", None), ("c", ""), ("c", None)]
    got = {r["k"]: (r["e"], r["l"]) for r in spark.createDataFrame(rows, "k string, s string").groupBy("k").agg(C.earliest_text(F.col("s")).alias("e"), C.latest_text(F.col("s")).alias("l")).collect()}
    assert got == {"a": ("2026-01-02T03:00:00+04:00", "2026-01-02T00:00:00Z"), "b": ("abc", "xyz"), "c": ("", "")}


def test_links_and_hosts(spark):
    rows = [
        ("https://a.example/recipes/pie", "Pie", "a.example", True), ("https://www.a.example/x/y", "", "a.example", True), ("https://a.example/x", "", "a.example", False), ("https://a.example/x/y.jpg", "", "a.example", False), ("https://b.example/recipes/pie", "Pie", "a.example", False),
        ("https://a.example/tag/recipes", "", "a.example", False), ("https://a.example/", "recipe", "a.example", False), (None, "recipe", "a.example", False), ("https://a.example:443/x", "A recipe", "a.example", True),
    ]
    df = spark.createDataFrame(rows, "u string, t string, d string, want boolean")
    assert [r["got"] for r in df.select(C.page_link(F.col("u"), F.col("t"), F.col("d"), "recipe").alias("got")).collect()] == [r[3] for r in rows]
    with pytest.raises(ValueError, match="a.example"):
        C.checked_pattern("(", "a.example")
    hosts = [("cdn.a.example", True), ("a.example", False), ("x.facebook.com", True), ("notfacebook.com", False), ("", True), (None, True)]
    assert [r[0] for r in spark.createDataFrame(hosts, "h string, w boolean").select(C.no_publisher(F.col("h"), ["facebook.com"])).collect()] == [w for _, w in hosts]


def test_hourly_targets_spread_and_explore(spark):
    rows = [(f"p{i:03}", "big", "r", 1000.0 - i, 1.0) for i in range(60)] + [(f"s{i}", f"src{i}", "r", 1.0, 1.0) for i in range(9)] + [(f"n{i}", "new", None, 5.0, 1.0) for i in range(6)] + [("m", "other", "", 4.0, 1.0)]
    df = spark.createDataFrame(rows, "page string, source string, recipe_id string, priority_score double, age_hours double")
    got = {r["page"] for r in C.hourly_targets(df, 30).collect()}
    assert len(got) == 30 and {f"s{i}" for i in range(9)} <= got and {p for p in got if p[0] in "nm"} == {"n0", "n1", "m"}
    assert C.hourly_targets(df.limit(0), 30).count() == 0 and C.full_targets(df, 2).filter("source = 'big'").count() == 2


def test_hamming_of_any_length(spark):
    rows = [("ff", "fe", 1 - 1 / 8), ("0f", "f", 1.0), ("a" * 40, "a" * 39 + "b", 1 - 1 / 160), ("F" * 16, "f" * 16, 1.0), ("xyz", "ff", None), ("", "ff", None), (None, "ff", None)]
    got = [r[0] for r in spark.createDataFrame(rows, "a string, b string, w double").select(hamming_similarity(F.col("a"), F.col("b"))).collect()]
    assert got == [None if w is None else pytest.approx(w) for _, _, w in rows]
