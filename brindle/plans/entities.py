"""Queries of entity resolution, joins, sets and samplings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brindle.bindings import coverage, latest_per, readings, recipes, snapshots
from brindle.functions import text as X
from brindle.functions.time import parse_micros
from brindle.functions.url import normalize_url
from brindle.operators import dedupe as D
from brindle.operators import relational as R
from brindle.operators.graph import connected_components
from brindle.plans.functions import _CASES as CASES
from brindle.plans.functions import NORM, PAGE, SIDES, STEM, pair_sides
from brindle.plans.sql import COVERAGE, READINGS, RECIPES, SNAPSHOTS
from brindle.registry import query
from brindle.session import checkpointed, table
from brindle.sources.html import extract_pages

_MEASURE = "\\b(?:cups?|tablespoons?|tbsp|teaspoons?|tsp|ounces?|oz|pounds?|lbs?|grams?|g|kg|ml|milliliters?|liters?|l|pinch|dash|cloves?)\\b"


def _items_sql(column: str) -> str:
    norm = f"trim(regexp_replace(regexp_replace(regexp_replace({NORM.format('y')}, '\\b\\d+(?:\\s+\\d+/\\d+|/\\d+|\\.\\d+)?\\b', ' ', 'g'), '{_MEASURE}', ' ', 'g'), '\\s+', ' ', 'g'))"
    words = f"flatten([string_split({norm}, ' ') FOR y IN coalesce({column}, []) IF y IS NOT NULL])"
    return f"list_sort(list_distinct(list_filter([{STEM.format('w')} FOR w IN {words}], lambda t: length(t) > 2 AND NOT list_contains({X.INGREDIENT_STOP!r}, t))))"


def _jac(a: str, b: str) -> str:
    return f"CASE WHEN len({a}) > 0 AND len({b}) > 0 THEN len(list_intersect({a}, {b})) / len(list_distinct(list_concat({a}, {b})))::DOUBLE END"


PAIR_SQL = f"w AS (SELECT pair_id, duplicate AS expected, coalesce(kind, 'unspecified') AS kind, {_items_sql('left_recipe.ingredients')} AS li, {_items_sql('right_recipe.ingredients')} AS ri FROM dedupe_pairs), lab AS (SELECT pair_id, expected, kind, coalesce({_jac('li', 'ri')}, 0.0) AS similarity FROM w)"


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "dedupe_pairs")
    items = X.jaccard(X.ingredient_tokens(F.col("left_recipe.ingredients")), X.ingredient_tokens(F.col("right_recipe.ingredients")))
    return d.select("pair_id", F.col("duplicate").alias("expected"), F.coalesce("kind", F.lit("unspecified")).alias("kind"), F.coalesce(items, F.lit(0.0)).alias("similarity"))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both recipes of every labelled pair with the latest author, address and fingerprints of the reading log."""
    d = table(spark, sf_dir, "dedupe_pairs")
    sides = [d.select((F.col("pair_id") * 2 + i).alias("id"), F.col(f"{side}_recipe_id").alias("recipe_id"), f"{side}_recipe.*") for i, side in enumerate(("left", "right"))]
    o = table(spark, sf_dir, "observations").select("recipe_id", parse_micros(F.col("timestamp")).alias("t"), "obs_id", normalize_url(F.coalesce(F.nullif(F.trim("canonical_url"), F.lit("")), "url")).alias("url"), "author", F.col("rating_count").alias("n"), F.col("instruction_simhash").alias("simhash"), F.col("image_perceptual_hash").alias("image"), F.col("image_fingerprint").alias("image_url"), F.col("evidence_confidence").alias("confidence"))
    last = o.groupBy("recipe_id").agg(F.max_by(F.struct("url", "author", "n", "simhash", "image", "image_url", "confidence"), F.struct("t", "obs_id")).alias("o"))
    return sides[0].unionByName(sides[1]).join(last, "recipe_id", "left").select("id", "recipe_id", "title", "ingredients", "instructions", "o.*")


@query("jaccard_pairs", f"WITH {PAIR_SQL} SELECT pair_id, expected, kind, round(similarity, 6) AS similarity FROM lab")
def jaccard_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled(spark, sf_dir).withColumn("similarity", F.round("similarity", 6))


def _pr(by: str) -> str:
    keys = "threshold" + (f", {by}" if by else "")
    return f"c AS (SELECT {keys}, count(*) FILTER (WHERE expected AND similarity >= threshold) AS tp, count(*) FILTER (WHERE NOT expected AND similarity >= threshold) AS fp, count(*) FILTER (WHERE NOT expected AND similarity < threshold) AS tn, count(*) FILTER (WHERE expected AND similarity < threshold) AS fn FROM lab, th GROUP BY ALL) SELECT {keys}, tp, fp, tn, fn, round(tp / nullif(tp + fp, 0)::DOUBLE, 6) AS precision, round(tp / nullif(tp + fn, 0)::DOUBLE, 6) AS recall, round(2 * (tp / nullif(tp + fp, 0)::DOUBLE) * (tp / nullif(tp + fn, 0)::DOUBLE) / nullif((tp / nullif(tp + fp, 0)::DOUBLE) + (tp / nullif(tp + fn, 0)::DOUBLE), 0), 6) AS f1 FROM c"


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query("pr_curve", f"WITH {PAIR_SQL}, th AS (SELECT i / 100.0::DOUBLE AS threshold FROM (SELECT unnest(range(70, 96)) AS i)), {_pr('')}")
def pr_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(D.confusion(labelled(spark, sf_dir), spark.range(70, 96).select((F.col("id") / 100).alias("threshold"))))


@query("pr_by_kind", f"WITH {PAIR_SQL}, th AS (SELECT 0.5::DOUBLE AS threshold), {_pr('kind')}")
def pr_by_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(D.confusion(labelled(spark, sf_dir), spark.range(1).select(F.lit(0.5).alias("threshold")), ["kind"]))


@query("label_queue")
def label_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate pairs over all records that have no label yet, the most doubtful first."""
    d = table(spark, sf_dir, "dedupe_pairs").filter("duplicate is not null").select("left_recipe_id", "right_recipe_id")
    return D.label_queue(records(spark, sf_dir), d).withColumns({c: F.round(c, 6) for c in ("similarity", "distance")})


@query("block_keys")
def block_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.block_keys(D.prepared(records(spark, sf_dir)))


@query("dedupe_benchmark")
def dedupe_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Precision, recall and F1 of the weighted similarity over the labelled pairs, overall and by kind."""
    p = checkpointed(D.prepared(records(spark, sf_dir)))
    d = table(spark, sf_dir, "dedupe_pairs").select("pair_id", (F.col("pair_id") * 2).alias("a"), (F.col("pair_id") * 2 + 1).alias("b"), F.col("duplicate").alias("expected"), F.coalesce("kind", F.lit("unspecified")).alias("kind"))
    rows = checkpointed(D.pair_benchmark(d, p))
    at = spark.range(1).select(F.lit(D.THRESHOLD).alias("threshold"))
    return _rounded(D.confusion(rows, at).withColumn("kind", F.lit("all")).unionByName(D.confusion(rows, at, ["kind"])))


@query("dedupe_groups")
def dedupe_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.duplicate_groups(records(spark, sf_dir))


@query(
    "components",
    f"""WITH RECURSIVE t AS (SELECT recipe_id, trim(canonical_url) AS u FROM observations WHERE trim(canonical_url) <> '' AND recipe_id IS NOT NULL),
e AS (SELECT DISTINCT recipe_id AS r, {PAGE} AS p FROM t), m AS (SELECT p, min(r) AS lo FROM e GROUP BY 1), s AS (SELECT DISTINCT r AS a, lo AS b FROM e JOIN m USING (p) WHERE r <> lo),
bi AS (SELECT a, b FROM s UNION SELECT b, a FROM s), walk AS (SELECT a AS node, a AS seen FROM bi UNION SELECT w.node, bi.b FROM walk w JOIN bi ON w.seen = bi.a)
SELECT node, min(seen) AS component FROM walk GROUP BY 1""",
)
def components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recipes connected by a page that both were ever seen under; each page links its recipes to the smallest."""
    o = table(spark, sf_dir, "observations").filter("trim(canonical_url) <> '' and recipe_id is not null").select("recipe_id", "canonical_url").distinct().select("recipe_id", normalize_url(F.col("canonical_url")).alias("p")).distinct()
    least = o.groupBy("p").agg(F.min("recipe_id").alias("b"))
    return connected_components(o.join(least, "p").filter("recipe_id <> b").select(F.col("recipe_id").alias("a"), "b"))


@query("collisions", f"WITH t AS (SELECT recipe_id, trim(canonical_url) AS u FROM observations WHERE trim(canonical_url) <> ''), p AS (SELECT {PAGE} AS page, recipe_id FROM t) SELECT page, count(DISTINCT recipe_id) AS members, min(recipe_id) AS first_member FROM p GROUP BY 1 HAVING count(DISTINCT recipe_id) > 1")
def collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "observations").select("recipe_id", "canonical_url").distinct().select("recipe_id", normalize_url(F.col("canonical_url")).alias("page"))
    return R.shared_values(o, "page", "recipe_id")


@query(
    "coverage_merge",
    f"WITH {READINGS}, {COVERAGE}, c AS (SELECT source, count(DISTINCT key) AS targets FROM readings GROUP BY 1), s AS (SELECT source, sum(targets) AS targets, sum(errors) AS errors FROM coverage GROUP BY 1), b AS (SELECT source FROM c UNION SELECT source FROM s)"
    " SELECT source, c.targets AS targets, s.targets AS run_targets, s.errors AS errors, coalesce(CASE WHEN s.errors > 0 THEN 'seen_errors' END, CASE WHEN c.targets > 0 THEN 'recipes' END, 'none') AS status FROM b LEFT JOIN c USING (source) LEFT JOIN s USING (source)",
)
def coverage_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = readings(spark, sf_dir, "source").groupBy("source").agg(F.count_distinct("key").alias("targets"))
    s = coverage(spark, sf_dir).groupBy("source").agg(F.sum("targets").alias("targets"), F.sum("errors").alias("errors"))
    base = c.select("source").union(s.select("source")).distinct()
    merged = R.merge_by_key(base, "source", {"recipes": c, "run": s})
    return merged.withColumn("status", F.coalesce(F.when(F.col("errors") > 0, "seen_errors"), F.when(F.col("targets") > 0, "recipes"), F.lit("none")))


@query("semi_sources", f"WITH {RECIPES} SELECT id, source FROM recipes WHERE source IN (SELECT source FROM rankings WHERE rank <= 10)")
def semi_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = table(spark, sf_dir, "rankings").filter("rank <= 10").select("source").distinct()
    return recipes(spark, sf_dir).select("id", "source").join(top, "source", "left_semi")


@query("anti_ranked", f"WITH {RECIPES} SELECT id, source FROM recipes r WHERE NOT EXISTS (SELECT 1 FROM rankings k WHERE k.recipe_id = r.id)")
def anti_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = table(spark, sf_dir, "rankings").select(F.col("recipe_id").alias("id")).distinct()
    return recipes(spark, sf_dir).select("id", "source").join(ranked, "id", "left_anti")


@query("key_union", f"WITH {READINGS} SELECT key FROM readings UNION SELECT recipe_id FROM rankings")
def key_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings(spark, sf_dir).select("key").union(table(spark, sf_dir, "rankings").select("recipe_id")).distinct()


@query(
    "top_overlap",
    f"WITH {SNAPSHOTS}, r AS (SELECT board_id, run_id, lag(run_id) OVER (PARTITION BY board_id ORDER BY t, run_id) AS prev FROM (SELECT board_id, run_id, max(t) AS t FROM snapshots GROUP BY 1, 2)), k AS (SELECT unnest([10, 50]) AS k)"
    " SELECT s.board_id, s.run_id, k, count(*) FILTER (WHERE s.rank <= k AND p.rank <= k) AS hits, round(count(*) FILTER (WHERE s.rank <= k AND p.rank <= k) / k::DOUBLE, 6) AS overlap FROM snapshots s JOIN r USING (board_id, run_id) LEFT JOIN snapshots p ON p.board_id = s.board_id AND p.run_id = prev AND p.key = s.key, k WHERE prev IS NOT NULL AND s.rank <= 50 GROUP BY 1, 2, 3",
)
def top_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.top_overlap(snapshots(spark, sf_dir), "board_id", "run_id", "t", "key", "rank", [10, 50]).withColumn("overlap", F.round("overlap", 6))


@query("even_sample", f"WITH {READINGS}, p AS (SELECT key, t, row_number() OVER (PARTITION BY key ORDER BY t) - 1 AS i, count(*) OVER (PARTITION BY key) AS c FROM readings) SELECT key, t FROM p WHERE c <= 5 OR i IN (0, round_even((c - 1) / 4.0, 0), round_even((c - 1) * 2 / 4.0, 0), round_even((c - 1) * 3 / 4.0, 0), c - 1)")
def even_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.even_sample(readings(spark, sf_dir).select("key", "t"), "key", [F.col("t")], 5)


@query("balanced_selection", f"WITH {RECIPES}, p AS (SELECT id, source, t, row_number() OVER (PARTITION BY source ORDER BY t, id) > 3 AS overflow FROM recipes) SELECT id, source, overflow FROM p ORDER BY overflow, t, id LIMIT 200")
def balanced_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.capped_per_key(recipes(spark, sf_dir).select("id", "source", "t"), "source", [F.col("t"), F.col("id")], 3, 200).select("id", "source", "overflow")


@query("feed_pages", f"WITH {RECIPES}, n AS (SELECT id, row_number() OVER (ORDER BY rating DESC, n DESC, id) AS nth FROM recipes) SELECT id, nth, ceil(nth / 100.0)::BIGINT AS page FROM n")
def feed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.pages(recipes(spark, sf_dir).select("id", "rating", "n"), [F.desc("rating"), F.desc("n"), F.asc("id")], 100).select("id", "nth", "page")


@query("page_manifest", f"WITH {RECIPES}, n AS (SELECT id, ceil(row_number() OVER (ORDER BY rating DESC, n DESC, id) / 100.0)::BIGINT AS page FROM recipes) SELECT page, count(*) AS items, list(id ORDER BY id) AS ids FROM n GROUP BY 1")
def page_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages hold a fixed number of rows, so their lists are bounded."""
    return feed_pages(spark, sf_dir).groupBy("page").agg(F.count(F.lit(1)).alias("items"), F.array_sort(F.collect_list("id")).alias("ids"))


@query(
    "query_family",
    "WITH t AS (SELECT replace(vertical, '_', ' ') AS term, row_number() OVER (ORDER BY vertical) - 1 AS pos FROM (SELECT DISTINCT vertical FROM rankings WHERE vertical <> '')), v AS (SELECT value, row_number() OVER (ORDER BY value) - 1 AS pos FROM (SELECT DISTINCT lower(c) AS value FROM (SELECT unnest(categories) AS c FROM observations) WHERE c <> '')),"
    " u AS (SELECT pos * 2 AS p, 'best ' || term AS phrase FROM t UNION ALL SELECT pos * 2 + 1, term FROM t UNION ALL SELECT 1000000 + v.pos * 10 + t.pos, term || ' ' || value || ' recipe' FROM v, t WHERE t.pos < 2) SELECT phrase, min(p) AS p FROM u GROUP BY 1 ORDER BY p LIMIT 20",
)
def query_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search phrases from the verticals of the rankings and the categories of the log, both short lists."""
    terms = table(spark, sf_dir, "rankings").filter("vertical <> ''").select("vertical").distinct().withColumn("pos", F.row_number().over(Window.orderBy("vertical")) - 1).select("pos", F.replace("vertical", F.lit("_"), F.lit(" ")).alias("term"))
    values = table(spark, sf_dir, "observations").select(F.explode("categories").alias("value")).select(F.lower("value").alias("value")).filter("value <> ''").distinct().withColumn("pos", F.row_number().over(Window.orderBy("value")) - 1)
    return R.query_family(terms, values, 20).withColumn("p", F.col("p").cast("bigint"))


@query(
    "category_recipes",
    f"WITH {SIDES}, t AS (SELECT pair_id, side, {NORM.format("concat_ws(' ', r.title, array_to_string(r.ingredients, ' '))")} AS n FROM b) SELECT pair_id, side, list_filter([{CASES}], lambda c: c IS NOT NULL) AS categories FROM t",
)
def category_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categories by title and ingredients together, of both recipes of each pair."""
    d = pair_sides(spark, sf_dir, "title", "ingredients")
    return d.select("pair_id", "side", X.categories_of(F.concat_ws(" ", "title", F.array_join("ingredients", " "))).alias("categories"))


@query(
    "page_extract",
    f"WITH {RECIPES} SELECT url, trim(title) AS title, round(least(5.0, rating / 5.0 * 5.0), 6) AS rating, n AS rating_count, 'verified' AS evidence_status, 1.0::DOUBLE AS evidence_confidence, 1 AS jsonld_scripts, true AS has_visible_pair FROM recipes WHERE trim(title) <> '' AND trim(url) <> ''",
)
def page_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written from the current state of the log and read again by the extractor: what comes out must be what went
    in. (The tables hold no fetched pages.)"""
    r = recipes(spark, sf_dir, "title", "url").filter("trim(title) <> '' and trim(url) <> ''")
    data = F.to_json(F.create_map(F.lit("@type"), F.lit("Recipe"), F.lit("name"), F.col("title")))
    rated = F.to_json(F.struct(F.col("rating").alias("ratingValue"), F.col("n").alias("ratingCount")))
    item = F.concat(F.expr("substring(_d, 1, length(_d) - 1)"), F.lit(', "aggregateRating": '), F.col("_r"), F.lit("}"))
    page = F.concat(
        F.lit("<html><head><script type='application/ld+json'>"), item, F.lit("</script></head><body><span itemprop='ratingValue'>"), F.col("rating").cast("string"), F.lit("</span><b itemprop='ratingCount' content='"), F.col("n").cast("string"), F.lit("'></b></body></html>")
    )
    pages = r.withColumns({"_d": data, "_r": rated}).select("url", page.alias("html"))
    e = extract_pages(pages)
    return e.select("url", "title", F.round("rating", 6).alias("rating"), "rating_count", "evidence_status", "evidence_confidence", "rating_evidence_signature.jsonld_scripts", "rating_evidence_signature.has_visible_pair")


@query("status_counts", f"WITH {RECIPES} SELECT source, evidence_status, count(*) AS c, grouping(source) AS gs, grouping(evidence_status) AS ge FROM recipes GROUP BY ROLLUP (source, evidence_status)")
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recipes(spark, sf_dir, "evidence_status").rollup("source", "evidence_status").agg(F.count(F.lit(1)).alias("c"), F.grouping("source").cast("bigint").alias("gs"), F.grouping("evidence_status").cast("bigint").alias("ge"))


@query("rating_pivot", f"WITH {READINGS}, m AS (SELECT source, t // 604800000000 AS week, rating FROM readings), x AS (SELECT max(week) AS w FROM m) SELECT source, " + ", ".join(f"round(avg(rating) FILTER (WHERE week = w - {i}), 6) AS week_{i}" for i in range(4)) + " FROM m, x GROUP BY source")
def rating_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = readings(spark, sf_dir, "source").select("source", F.floor(F.col("t") / 604_800_000_000).alias("week"), "rating")
    last = o.agg(F.max("week").alias("w"))
    placed = o.crossJoin(F.broadcast(last)).withColumn("back", (F.col("w") - F.col("week")).cast("int"))
    wide = placed.groupBy("source").pivot("back", [0, 1, 2, 3]).agg(F.round(F.avg("rating"), 6))
    return wide.select("source", *[F.col(str(i)).alias(f"week_{i}") for i in range(4)])


@query(
    "biggest_movers",
    f"WITH {SNAPSHOTS}, r AS (SELECT board_id, run_id, lag(run_id) OVER w AS prev, row_number() OVER (PARTITION BY board_id ORDER BY t DESC, run_id DESC) AS back FROM (SELECT board_id, run_id, max(t) AS t FROM snapshots GROUP BY 1, 2) WINDOW w AS (PARTITION BY board_id ORDER BY t, run_id)),"
    " m AS (SELECT s.board_id, s.key, p.rank - s.rank AS movement, s.rank FROM snapshots s JOIN r USING (board_id, run_id) JOIN snapshots p ON p.board_id = s.board_id AND p.run_id = prev AND p.key = s.key WHERE back = 1) SELECT board_id, key, movement, rank FROM m ORDER BY abs(movement) DESC, board_id, rank, key LIMIT 100",
)
def biggest_movers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = snapshots(spark, sf_dir)
    runs = s.groupBy("board_id", "run_id").agg(F.max("t").alias("rt"))
    w = Window.partitionBy("board_id")
    last = runs.withColumn("prev", F.lag("run_id").over(w.orderBy("rt", "run_id"))).withColumn("back", F.row_number().over(w.orderBy(F.desc("rt"), F.desc("run_id")))).filter("back = 1").select("board_id", "run_id", "prev")
    before = s.select("board_id", F.col("run_id").alias("prev"), "key", F.col("rank").alias("old"))
    moved = s.join(last, ["board_id", "run_id"]).join(before, ["board_id", "prev", "key"]).select("board_id", "key", (F.col("old") - F.col("rank")).alias("movement"), "rank")
    return moved.orderBy(F.desc(F.abs("movement")), "board_id", "rank", "key").limit(100)


@query("latest_audit", f"SELECT domain, new_state, audit_id FROM (SELECT domain, new_state, audit_id, row_number() OVER (PARTITION BY domain ORDER BY audit_id DESC) AS n FROM source_events) WHERE n = 1")
def latest_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per(table(spark, sf_dir, "source_events"), ["domain"], "audit_id").select("domain", "new_state", "audit_id")

