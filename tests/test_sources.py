from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from brindle.sources import files, html, sinks


def test_log_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("r1", "2026-08-18T22:39:54Z", 4.5), ("r2", "2026-08-19T00:00:00+02:00", 4.0)], "recipe_id string, timestamp string, rating double")
    sinks.append_log(rows, str(tmp_path / "log"))
    assert sorted(p.name for p in (tmp_path / "log" / "y=2026" / "m=08").iterdir() if p.is_dir()) == ["d=18"]
    (tmp_path / "log" / "y=2026" / "m=08" / "d=18" / "bad.json").write_text('{"recipe_id": "r3", "rating": 1.0, "timestamp": "2026-08-20T00:00:00Z"}\nnot json\n')
    log = files.read_log(spark, str(tmp_path / "log"))
    assert sorted(r["recipe_id"] for r in log.collect()) == ["r1", "r2", "r3"]
    assert files.recent_records(log, "timestamp", 2).count() == 2
    with pytest.raises(Exception):  # noqa: B017
        files.read_log(spark, str(tmp_path / "log"), strict=True).collect()


def test_state_and_csv(spark, tmp_path):
    path = tmp_path / "state.json"
    assert files.read_state(spark, str(path), "rating double, n bigint").count() == 0
    sinks.replace_document(str(path), {"a": {"rating": 4.5, "n": 3}, "b": {"rating": None, "n": 1}})
    assert sorted((r["key"], r["rating"], r["n"]) for r in files.read_state(spark, str(path), "rating double, n bigint").collect()) == [("a", 4.5, 3), ("b", None, 1)]
    path.write_text("[1, 2]")
    with pytest.raises(ValueError):
        files.read_state(spark, str(path), "rating double")
    (tmp_path / "t.csv").write_text('id,n,x\n1,3.0,4.5\n2,,\n3,"bad",7\n')
    t = files.read_table(spark, str(tmp_path / "t.csv"), "id int, n string, x string").select("id", files.csv_number(F.col("n"), "int").alias("n"), files.csv_number(F.col("x"), "float", None).alias("x"))
    assert [tuple(r) for r in t.orderBy("id").collect()] == [(1, 3, 4.5), (2, 0, None), (3, None, 7.0)]


def test_a_failed_replacement_leaves_the_old_document(tmp_path):
    path = tmp_path / "d.json"
    sinks.replace_document(str(path), {"v": 1})

    class Bad:
        def __str__(self):
            raise RuntimeError("no")

    with pytest.raises(RuntimeError):
        sinks.replace_document(str(path), {"v": Bad()})
    assert json.loads(path.read_text()) == {"v": 1} and [p.name for p in tmp_path.iterdir()] == ["d.json"]


def test_dimension_and_feed(spark, tmp_path):
    (tmp_path / "sources.json").write_text(json.dumps({"sources": [{"domain": "a.example"}, {"domain": "b.example", "enabled": False}, {"domain": "c.example", "delay": 2.0}]}))
    d = files.read_dimension(spark, str(tmp_path / "sources.json"), "domain string, delay double", {"delay": 0.2})
    assert sorted(tuple(r) for r in d.collect()) == [("a.example", 0.2), ("c.example", 2.0)]
    pages = spark.range(205).select("id", F.ceil((F.col("id") + 1) / 100).alias("page"))
    out = str(tmp_path / "feed")
    assert sinks.write_feed(pages, out) == {"pages": 3, "items": 205}
    assert sinks.write_feed(pages.filter("page = 1"), out) == {"pages": 1, "items": 100}
    assert sorted(p.name for p in (tmp_path / "feed").iterdir() if p.name.startswith("page")) == ["page=1"]
    sinks.write_archive(pages, str(tmp_path / "archive"))
    assert spark.read.parquet(str(tmp_path / "archive")).count() == 205
    assert sinks.as_text_columns(spark.sql("select array(1, 2) a, 3 b")).first()["a"] == "[1,2]"


def test_sitemaps(spark):
    docs = [
        ("https://a/i", '<?xml version="1.0"?><sitemapindex xmlns="http://x"><sitemap><loc>https://a/1</loc></sitemap><sitemap><loc> https://a/i </loc></sitemap></sitemapindex>'),
        ("https://a/1", '<urlset xmlns="http://x"><url><loc>https://a/p?x=1&amp;y=2</loc><lastmod>2026-01-01</lastmod></url><url><loc><![CDATA[https://a/q]]></loc></url></urlset>'),
        ("https://a/2", "<urlset><url><loc>https://a/never</loc></url></urlset>"), ("https://a/3", "not xml"), ("https://a/4", None),
    ]
    df = spark.createDataFrame(docs, "url string, xml string")
    assert sorted(tuple(r) for r in files.sitemap_pages(df, ["https://a/i"]).collect()) == [("https://a/p?x=1&y=2", "2026-01-01"), ("https://a/q", None)]


PAGE = """<!doctype html><html><head><title>T</title><link rel="canonical" href="/w/"><script type="application/ld+json">%s</script></head>
<body><span itemprop="ratingValue">%s</span><b itemprop="ratingCount" content="%s"></b></body></html>"""


def recipe(**rating):
    return json.dumps({"@graph": [{"@type": ["Thing", "Recipe"], "name": "Wings", "author": [{"name": "Ann"}, "Bo"], "recipeIngredient": ["wings", "salt"], "recipeInstructions": [{"@type": "HowToSection", "itemListElement": [{"text": "Fry."}]}, "Eat."], "aggregateRating": rating}]})


def test_pages(spark):
    pages = [
        ("https://a.example/x", PAGE % (recipe(ratingValue="4.99", ratingCount="1,028", bestRating="5", ratingHistogram={"5": 1000, "4.6": 3, "9": 1}), "4.99", "1028")),
        ("https://a.example/conflict", PAGE % (recipe(ratingValue=9, reviewCount=100, bestRating=10), "2.0", "100")),
        ("https://a.example/plain", "<html><body>Nothing"), ("https://a.example/bad", PAGE % ("{not json", "4", "1")), ("https://a.example/zero", PAGE % (recipe(ratingValue=6, ratingCount=10), "4", "1")), ("https://a.example/null", None),
    ]
    got = {r["url"].rpartition("/")[2]: r for r in html.extract_pages(spark.createDataFrame([(*p, 1) for p in pages], "url string, html string, rating int")).collect()}
    x = got["x"]
    assert (x["title"], x["rating"], x["rating_count"], x["evidence_status"], x["canonical_url"], x["author"]) == ("Wings", 4.99, 1028, "verified", "https://a.example/w/", "Ann, Bo")
    assert x["ingredients"] == ["wings", "salt"] and x["instructions"] == ["Fry.", "Eat."] and x["rating_histogram"] == {"5": 3}
    assert (got["conflict"]["rating"], got["conflict"]["evidence_status"], got["conflict"]["evidence_confidence"]) == (4.5, "conflict", 0.25)
    assert got["zero"]["recognized"] and got["zero"]["recipe_id"] is None
    assert not got["plain"]["recognized"] and not got["bad"]["recognized"] and got["null"]["recipe_id"] is None
    assert html.extract("u", "<p class='a'>x")["dom_fingerprint"] != html.extract("u", "<p class='b'>x")["dom_fingerprint"]


def test_page_structure():
    data = recipe(ratingValue="4.5", ratingCount=10)
    same, other = recipe(ratingValue="3.9", ratingCount=88), '{"@type": "Recipe", "name": ["a", "b"]}'
    pages = [html.extract("https://a.example/", PAGE % (d, "4", "1")) for d in (data, same, other, "{bad")]
    assert pages[0]["schema_signature"] == pages[1]["schema_signature"] != pages[2]["schema_signature"] and pages[3]["schema_signature"] == ""
    assert pages[0]["rating_evidence_signature"] == {"visible_rating_value_nodes": 1, "visible_rating_count_nodes": 1, "jsonld_scripts": 1, "has_visible_pair": True}
    assert html.extract("u", None)["rating_evidence_signature"]["has_visible_pair"] is False
    assert html.image_of([{"@type": "ImageObject", "url": " https://a/i.jpg "}, "x"]) == "https://a/i.jpg" and html.image_of(None) == "" == html.image_of({"url": 3})


def test_deep_sitemaps_are_followed_to_the_end(spark):
    rows = [(f"https://a/{i}", f"<sitemapindex><sitemap><loc>https://a/{i + 1}</loc></sitemap></sitemapindex>") for i in range(8)]
    rows.append(("https://a/8", "<urlset><url><loc>https://a/page</loc></url></urlset>"))
    df = spark.createDataFrame(rows, "url string, xml string")
    assert [tuple(r) for r in files.sitemap_pages(df, ["https://a/0"]).collect()] == [("https://a/page", None)]
