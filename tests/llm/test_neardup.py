from __future__ import annotations

import random
from itertools import combinations

import pytest

from brindle.llm.neardup import chunk_count, chunk_keys, record_groups, recurring_pairs, similar_records
from brindle.llm.text import plain_words
from brindle.operators.units import parse_line

SCHEMA = "pair_id bigint, i array<string>, s array<string>, id string, class string, key string"


def brute(rows):
    """Pairs of one group by comparing everything with everything."""
    sets = {}
    for p, i, s in rows:
        a, b = {parse_line(x)[0] for x in i or [] if x} - {""}, set(plain_words(" ".join(x for x in s or [] if x)))
        if p is not None and a and b:
            sets[p] = (a, b)
    root = {p: p for p in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, y in combinations(sets, 2):
        (a, b), (c, d) = sets[x], sets[y]
        if 2 * len(a & c) >= len(a | c) and 3 * len(b & d) >= 2 * len(b | d):
            root[find(x)] = find(y)
    return sorted((min(x, y), max(x, y)) for x, y in combinations(sets, 2) if find(x) == find(y))


def generated(seed, n=150):
    rng = random.Random(seed)
    names = [f"food{c}{d}" for c in "abcdefgh" for d in "uvwxyz"]
    rows = []
    for k in range(n):
        if rows and rng.random() < 0.5:
            _, i, s = rng.choice(rows)
            i, s = list(i), " ".join(s).split(" ")
            for _ in range(rng.randint(0, 3)):
                if rng.random() < 0.5 and len(i) > 1:
                    i.pop(rng.randrange(len(i)))
                else:
                    i.append(f"2 cups {rng.choice(names)}")
            for _ in range(rng.randint(0, 6)):
                s[rng.randrange(len(s))] = f"word{rng.randrange(300)}"
            s = [" ".join(s)]
        else:
            i = [f"{rng.randint(1, 9)} oz {x}" for x in rng.sample(names, rng.randint(1, 30))]
            s = [" ".join(f"word{rng.randrange(300)}" for _ in range(30))]
        rows.append((k, i, s))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_pairs_equal_brute_force(spark, seed):
    rows = generated(seed)
    df = spark.createDataFrame([(*r, "c", "d", "e") for r in rows], SCHEMA)
    assert sorted(tuple(r) for r in recurring_pairs(df, "pair_id", "i", "s").collect()) == brute(rows)


def test_keys_meet_at_the_bound():
    rng = random.Random(5)
    for _ in range(400):
        n = rng.randint(1, 60)
        common = [rng.getrandbits(62) for _ in range(n)]
        extra = rng.randint(0, n)  # |A & B| / |A | B| >= 1/2
        left = rng.randint(0, extra)
        a = sorted(common + [rng.getrandbits(62) for _ in range(left)])
        b = sorted(common + [rng.getrandbits(62) for _ in range(extra - left)])
        if max(len(a), len(b)) <= 30:
            assert chunk_keys(a) & chunk_keys(b)
    assert [chunk_count(n) for n in (1, 12, 13, 24, 25)] == [1, 1, 2, 2, 4]


def test_edges(spark):
    same = (["1 cup rice", "2 eggs"], ["Boil the rice.", "Add the eggs."])
    rows = [(1, *same), (2, *same), (2, *same), (3, None, ["x"]), (4, [], []), (5, None, ["x"]), (6, ["", None], ["y"]), (7, ["1 cup rice"], None), (None, *same), (8, ["x" * 5000], ["y " * 20000]), (9, ["1 cup rice", "2 eggs"], ["Nothing alike here at all."])]
    df = spark.createDataFrame([(*r, "c", "d", "e") for r in rows], SCHEMA)
    assert [tuple(r) for r in recurring_pairs(df, "pair_id", "i", "s").collect()] == [(1, 2)]
    groups = record_groups(df, "pair_id", "i", "s")
    assert sorted(tuple(r) for r in groups.collect()) == [(1, 1, 0), (2, 1, 0)]
    assert recurring_pairs(df.limit(0), "pair_id", "i", "s").count() == 0
    members, links = similar_records(df, "pair_id", "i", "s")
    assert links.count() == 0 and members.filter("class = 1").count() == 2
