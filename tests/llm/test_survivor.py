from __future__ import annotations

from pyspark.sql import functions as F

from brindle.llm.queries import LLM
from brindle.llm.survivor import consensus, consensus_values, page_records, surviving_records, token_distance, tokens
from tests.oracle import compare

SCHEMA = "obs_id bigint, recipe_id string, timestamp string, source string, url string, canonical_url string, evidence_confidence double, rating_count bigint, title string, author string, page string, best string, t bigint"
T1, T2 = "2026-01-01T00:00:00Z", "2026-01-02T00:00:00Z"


def frame(spark, rows):
    return spark.createDataFrame([(i, *r, "clash", "clash", 1) for i, r in enumerate(rows)], SCHEMA)


def test_survivors(spark):
    u = "https://a.example/p"
    rows = [
        ("r1", T1, "a.example", u, None, 0.9, 5, "Lemon Cake", "Ann"), ("r1", T2, "b.example", u, "", 0.5, 5, "Lemon Cake", "Ann"),  # the later row counts
        ("r2", T1, "b.example", "x", "HTTPS://A.example/p?utm_source=f#top", 0.8, 1, "Lemon  Cake", None), ("r3", T1, "A.example ", u, " " + u + " ", 0.8, None, "Lemon Cake!", "Ann"),
        ("r4", T1, "c.example", "https://c.example", None, None, None, None, None), ("r5", T1, "c.example", None, "https://c.example/", float("nan"), 3, "", ""),
        ("r6", T1, "d.example", None, None, 0.5, 1, "x", "y"), ("r7", T1, "d.example", "", "  ", 0.5, 1, "x", "y"), (None, T1, "a.example", u, u, 1.0, 9, "x", "y"), ("r8", "never", "e.example", "https://e.example/1", None, 1.0, 1, "z", "z"),
        ("t1", T1, "f", "https://f.example/", None, 0.5, 4, "z", "z"), ("t2", T1, "f", "https://f.example", None, 0.5, 4, "z", "z"),
    ]
    df = frame(spark, rows)
    assert sorted((r["group_id"], r["recipe_id"], r["members"]) for r in surviving_records(df).collect()) == [("r1", "r3", 3), ("r4", "r5", 2), ("t1", "t1", 2)]
    golden = {r["group_id"]: r for r in surviving_records(df).collect()}
    assert golden["r1"]["title"] == "Lemon Cake" and golden["r1"]["author"] == "Ann" and golden["r4"]["title"] is None
    assert surviving_records(df.limit(0)).count() == 0 and surviving_records(df.limit(0)).count() == 0


def test_query_equals_sql(spark, sf_dir):
    compare("p6_found", LLM.queries["p6_found"], LLM.oracles["p6_found"], spark, sf_dir)


def test_consensus_by_hand():
    assert consensus([("Crispy Air Fryer Wings", 1.0), ("Crispy Fryer Wings", 1.0), ("Crispy Air Fryer Wings Recipe", 1.0)]) == ["Crispy", "Air", "Fryer", "Wings"]
    assert consensus([("a", 0.4), ("b", 0.5)]) == ["b"] and consensus([]) == []
    assert token_distance(tokens("a b c"), tokens("a c d")) == 2


def test_every_value_of_a_large_group_votes(spark):
    rows = [("g", f"Best Lemon Tart {i}", 0.1) for i in range(40)] + [("g", "Lemon Tart", 0.5), ("g", None, 1.0), ("g", " ", 1.0), (None, "x", 1.0), ("h", "x", None), ("h", "x", float("nan"))]
    df = spark.createDataFrame(rows, "g string, v string, w double")
    small = {r["grp"]: r["value"] for r in consensus_values(df, "g", "v", "w", guide=7).collect()}
    assert small["g"].startswith(("Best Lemon Tart", "Lemon Tart")) and small["h"] == "x" and len(small) == 2
    assert consensus_values(df.filter(F.lit(False)), "g", "v", "w").count() == 0


def test_golden_equals_a_plain_twin(spark, sf_dir):
    """Every group's fields by the progressive alignment of all its values in plain Python."""
    import collections
    import re

    got = {r["group_id"]: r for r in LLM.queries["p6_golden"](spark, sf_dir).collect()}
    records = page_records(spark.read.parquet(f"{sf_dir}/observations.parquet")).collect()
    pages = collections.defaultdict(list)
    for r in records:
        pages[r["page"]].append(r)
    groups = {min(r["recipe_id"] for r in rs): rs for rs in pages.values() if len(rs) > 1}
    assert set(groups) == set(got) and groups
    for group, rs in groups.items():
        for field in ("title", "author", "address"):
            votes = collections.Counter()
            for r in rs:
                value = re.sub(r"\s+", " ", r[field] or "").strip()
                if value:
                    c = r["evidence_confidence"]
                    votes[value] += max(0.01, c) if c is not None and c == c else 0.01
            votes = {v: round(w, 9) for v, w in votes.items()}
            agreed = consensus(list(votes.items()))
            want = min(votes, key=lambda v: (token_distance(tokens(v), agreed), -votes[v], v), default=None)
            assert got[group][field] == want, (group, field)


def test_agreement_with_one_long_alignment(spark):
    """Groups above the guide agree with the progressive alignment of all their values."""
    import random

    rng = random.Random(3)
    rows, want = [], {}
    for g in range(12):
        base = [f"tok{rng.randrange(60)}" for _ in range(8)]
        values = {}
        for _ in range(120):
            v = list(base)
            for _ in range(rng.randrange(4)):
                k = rng.randrange(len(v))
                v[k : k + 1] = rng.choice([[], [f"x{rng.randrange(40)}"], [v[k], f"y{rng.randrange(40)}"]])
                v = v or ["z"]
            values[" ".join(v)] = rng.choice([0.2, 0.5, 0.9])
        agreed = consensus(list(values.items()))
        want[g] = min(values, key=lambda v: (token_distance(tokens(v), agreed), -values[v], v))
        rows += [(g, v, w) for v, w in values.items()]
    df = spark.createDataFrame(rows, "g int, v string, w double")
    got = {r["grp"]: r["value"] for r in consensus_values(df, "g", "v", "w", guide=20).collect()}
    assert sum(got[g] == want[g] for g in want) >= 11
