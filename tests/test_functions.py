from __future__ import annotations

import hashlib
from datetime import datetime, timezone
from urllib.parse import parse_qsl, urlencode, urlsplit, urlunsplit

from pyspark.sql import functions as F

from brindle.functions import text as X
from brindle.functions.time import parse_micros
from brindle.functions.url import TRACKING_KEYS, normalize_domain, normalize_url, url_host


def one(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.select("i", fn(F.col("x")).alias("y")).orderBy("i").select("y").collect()]


def test_instants(spark):
    def python(s):
        try:
            t = datetime.fromisoformat(s.strip().replace("Z", "+00:00"))
        except (ValueError, AttributeError):
            return None
        t = t if t.tzinfo else t.replace(tzinfo=timezone.utc)
        d = t - datetime(1970, 1, 1, tzinfo=timezone.utc)
        return (d.days * 86400 + d.seconds) * 10**6 + d.microseconds

    values = ["2026-01-05T08:19:22.841198+00:00", "2026-01-05T10:19:22.841198+02:00", "2026-01-05T08:19:22Z", "2026-01-05T08:19:22", " 2026-01-05 08:19:22.5 ", "2026-01-05", "2026-01-05T08:19:22-0330", "1969-12-31T23:59:59.999999Z", "soon", "", None]
    assert one(spark, values, parse_micros) == [python(v) if v else None for v in values]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert one(spark, values, parse_micros) == [python(v) if v else None for v in values]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_urls_as_the_standard_library_reads_them(spark):
    def python(u):
        raw = (u or "").strip()
        if not raw:
            return raw
        p = urlsplit(raw)
        kept = [(k, v) for k, v in parse_qsl(p.query, keep_blank_values=True) if not (k.lower().startswith("utm_") or k.lower() in TRACKING_KEYS)]
        return urlunsplit((p.scheme.lower(), p.netloc.lower(), p.path or "/", urlencode(sorted(kept)), ""))

    values = [
        "https://A.example", "HTTPS://A.example/b?z=1&a=2#top", "https://a.example/?utm_source=x&UTM_medium=y&fbclid=3", "https://a.example/p?flag", "https://a.example/p?b=&a", "https://a.example/p?q=a%20b&q=a+b&r=%C3%A9~*",
        "  https://a.example/x  ", "https://a.example/p?", "https://user@A.example:80/x?b=2&b=1", "", None, "https://a.example/p?share=1", "https://a.example/a?x=1&y=2&x=0",
    ]
    assert one(spark, values, normalize_url) == [python(v) for v in values]


def test_domains(spark):
    cases = {" WWW.A.Example. ": "a.example", "a.example": "a.example", "https://a.example:8080/x": "a.example", "u@a.example": None, "localhost": None, "10.0.0.1": None, "": None, None: None, "a..example": None, "www.www.a.example": "www.a.example", "x" * 64 + ".example": None, "blog.a.example ": "blog.a.example"}
    assert one(spark, list(cases), normalize_domain) == list(cases.values())
    assert one(spark, ["https://www.A.example./x", "nothing"], url_host) == ["a.example", ""]


def test_text_forms(spark):
    assert one(spark, ["  The BEST Crispy Wings & Fries! ", None, "", "Ünïted"], X.normalize_text) == ["the best crispy wings fries", None, "", "n ted"]
    assert one(spark, ["Easy Air Fryer Potatoes Recipes", ""], X.title_form) == ["potato recip", ""]
    assert one(spark, [["2 cups fresh tomatoes", "1 1/2 lb onions", None, ""], None, []], X.ingredient_tokens, "array<string>") == [["onion", "tomato"], [], []]
    assert one(spark, ["1,234.5 reviews", "none", None, "-3 of 4"], X.first_number) == [1234.5, None, None, -3.0]
    assert one(spark, ["a | b||c ", None, ""], X.pipe_to_array) == [["a", "b", "c"], [], []]
    assert one(spark, [["B", "a", "a"], [], None], lambda x: X.signature(x, False), "array<string>") == [hashlib.sha256(b"a\nb").hexdigest()[:24], "", ""]


def test_simhash_is_the_bitwise_majority(spark):
    def python(tokens):
        if not tokens:
            return None
        total = [0] * 64
        for t in tokens:
            h = int.from_bytes(hashlib.sha256(t.encode()).digest()[:8], "big")
            for i in range(64):
                total[i] += (h >> i & 1) * 2 - 1
        value = sum(1 << i for i in range(64) if total[i] >= 0)
        return value - (1 << 64) if value >= 1 << 63 else value

    values = [["a"], ["a", "b", "c", "a"], ["x", "y"], [], None]
    assert one(spark, values, X.simhash, "array<string>") == [python(v) for v in values]


def test_hamming_similarity(spark):
    df = spark.createDataFrame([("0" * 16, "f" * 16), ("ABCDEF0123456789", "abcdef0123456789"), ("", "0" * 16), (None, "0" * 16), ("zz", "0" * 16)], "a string, b string")
    assert [r[0] for r in df.select(X.hamming_similarity(F.col("a"), F.col("b"))).collect()] == [0.0, 1.0, None, None, None]


def test_wilson_and_rescale(spark):
    df = spark.createDataFrame([(0, 0), (5, 10), (10, 10)], "k bigint, n bigint")
    low, high = X.wilson(F.col("k"), F.col("n"))
    got = [tuple(r) for r in df.select(low, high).collect()]
    assert got[0] == (None, None) and abs(got[1][0] - 0.2366) < 1e-3 and abs(got[1][1] - 0.7634) < 1e-3 and abs(got[2][1] - 1.0) < 1e-9
    rows = spark.createDataFrame([(9.0, 10.0, 5), (5.2, 5.0, 5), (6.0, 5.0, 5), (4.0, 0.0, 5), (4.0, 5.0, 0), (None, 5.0, 1)], "r double, b double, n bigint")
    assert [r[0] for r in rows.select(X.rescale_rating(F.col("r"), F.col("b"), F.col("n"))).collect()] == [4.5, 5.0, None, None, None, None]


def test_queries_read_both_recipes_of_a_pair(spark, tmp_path):
    from brindle.plans import functions as P
    from brindle.plans.serving import shopping_totals

    recipe = "struct<ingredients: array<string>, instructions: array<string>>"
    rows = [(1, (["2 cups flour"], ["Mix the flour"]), (["3 eggs", "1 cup milk"], ["Beat all eggs"])), (2, (None, None), (["1 cup rice"], []))]
    spark.createDataFrame(rows, f"pair_id bigint, left_recipe {recipe}, right_recipe {recipe}").write.parquet(str(tmp_path / "dedupe_pairs.parquet"))
    lines = {(1, "left", "2 cups flour"), (1, "right", "3 eggs"), (1, "right", "1 cup milk"), (2, "right", "1 cup rice")}
    for fn in (P.norm_ingredient, P.first_number):
        assert {(r["pair_id"], r["side"], r["line"]) for r in fn(spark, str(tmp_path)).collect()} == lines
    signed = {(r["pair_id"], r["side"]): r for r in P.recipe_signatures(spark, str(tmp_path)).collect()}
    hashed = {(r["pair_id"], r["side"]): r["simhash"] for r in P.simhash_steps(spark, str(tmp_path)).collect()}
    assert len(signed) == len(hashed) == 4
    assert signed[1, "left"]["ingredient_signature"] != signed[1, "right"]["ingredient_signature"] and hashed[1, "left"] != hashed[1, "right"]
    assert signed[2, "left"]["ingredient_signature"] == "" == signed[2, "right"]["instruction_signature"] != signed[2, "right"]["ingredient_signature"]
    assert "milk" in str(shopping_totals(spark, str(tmp_path)).collect())
