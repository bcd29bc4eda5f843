"""Queries of the scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brindle.bindings import readings, recipes
from brindle.functions import text as X
from brindle.functions.time import parse_micros
from brindle.functions.url import normalize_domain, normalize_url, url_host
from brindle.operators.score import histogram_variance as variance
from brindle.operators.urls import TRAP_TOKENS, alias_groups, is_trap
from brindle.plans.problems import SQL_INSTANT
from brindle.plans.sql import READINGS, RECIPES
from brindle.registry import query
from brindle.session import table

NORM = "trim(regexp_replace(lower({0}), '[^a-z0-9]+', ' ', 'g'))"
STEM = "CASE WHEN length({0}) > 4 AND suffix({0}, 'es') THEN left({0}, length({0}) - 2) WHEN length({0}) > 3 AND suffix({0}, 's') THEN left({0}, length({0}) - 1) ELSE {0} END"
SIDES = "b AS (SELECT pair_id, 'left' AS side, left_recipe AS r FROM dedupe_pairs UNION ALL SELECT pair_id, 'right', right_recipe FROM dedupe_pairs)"
LINES = SIDES + ", l AS (SELECT pair_id, side, unnest(r.ingredients) AS line FROM b)"
URL = r"""regexp_extract({0}, '^[^:/?#]*://[^/?#]*([^?#]*)', 1)"""
PAGE = (
    "lower(regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) || '://' || lower(regexp_extract(u, '^[^:/?#]*://([^/?#]*)', 1)) || coalesce(nullif(" + URL.format("u") + ", ''), '/')"
    " || coalesce('?' || nullif(array_to_string(list_sort(list_filter(string_split(regexp_extract(u, '^[^?#]*[?]([^#]*)', 1), '&'), lambda x: x <> '' AND NOT regexp_matches(lower(x),"
    " '^(utm_[^=]*|fbclid|gclid|dclid|msclkid|igshid|mc_cid|mc_eid|share)(=|$)'))), '&'), ''), '')"
)


def _titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "observations").select("title").distinct()


def pair_sides(spark: SparkSession, sf_dir: str, *fields: str) -> DataFrame:
    """Both recipes of every pair, one row each, with their side; the table is read once."""
    sides = F.explode(F.array(*[F.struct(F.lit(side).alias("side"), *[F.col(f"{side}_recipe.{f}").alias(f) for f in fields]) for side in ("left", "right")]))
    return table(spark, sf_dir, "dedupe_pairs").select("pair_id", sides.alias("r")).select("pair_id", "r.*")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_sides(spark, sf_dir, "ingredients").select("pair_id", "side", F.explode("ingredients").alias("line"))


@query("norm_text", f"SELECT DISTINCT title, {NORM.format('title')} AS norm FROM observations")
def norm_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _titles(spark, sf_dir).withColumn("norm", X.normalize_text(F.col("title")))


@query(
    "title_form",
    f"WITH t AS (SELECT DISTINCT title FROM observations) SELECT title, coalesce(array_to_string(list_filter([{STEM.format('w')} FOR w IN string_split({NORM.format('title')}, ' ') IF w <> ''],"
    f" lambda t: length(t) > 2 AND NOT list_contains({X.GENERIC_TITLE!r}, t)), ' '), CASE WHEN title IS NOT NULL THEN '' END) AS form FROM t",
)
def title_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _titles(spark, sf_dir).withColumn("form", X.title_form(F.col("title")))


@query(
    "norm_ingredient",
    f"WITH {LINES} SELECT pair_id, side, line, trim(regexp_replace(regexp_replace(regexp_replace({NORM.format('line')}, '\\b\\d+(?:\\s+\\d+/\\d+|/\\d+|\\.\\d+)?\\b', ' ', 'g'), '\\b(?:cups?|tablespoons?|tbsp|teaspoons?|tsp|ounces?|oz|pounds?|lbs?|grams?|g|kg|ml|milliliters?|liters?|l|pinch|dash|cloves?)\\b', ' ', 'g'), '\\s+', ' ', 'g')) AS norm FROM l",
)
def norm_ingredient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).withColumn("norm", X.normalize_ingredient(F.col("line")))


@query("first_number", f"WITH {LINES} SELECT pair_id, side, line, TRY_CAST(replace(regexp_extract(line, '-?\\d[\\d,]*(?:\\.\\d+)?'), ',', '') AS DOUBLE) AS number FROM l")
def first_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).withColumn("number", X.first_number(F.col("line")))


@query(
    "recipe_signatures",
    "WITH " + SIDES + ", n AS (SELECT pair_id, side, [x FOR x IN [" + NORM.format("y") + " FOR y IN coalesce(r.ingredients, [])] IF x <> ''] AS i, [x FOR x IN [" + NORM.format("y") + " FOR y IN coalesce(r.instructions, [])] IF x <> ''] AS s FROM b)"
    " SELECT pair_id, side, CASE WHEN len(i) = 0 THEN '' ELSE left(sha256(array_to_string(list_sort(list_distinct(i)), chr(10))), 24) END AS ingredient_signature, CASE WHEN len(s) = 0 THEN '' ELSE left(sha256(array_to_string(s, chr(10))), 24) END AS instruction_signature FROM n",
)
def recipe_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = pair_sides(spark, sf_dir, "ingredients", "instructions")
    return d.select("pair_id", "side", X.signature(F.col("ingredients"), False).alias("ingredient_signature"), X.signature(F.col("instructions"), True).alias("instruction_signature"))


@query("simhash_steps")
def simhash_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = pair_sides(spark, sf_dir, "instructions")
    tokens = F.filter(X.words(F.array_join("instructions", " ")), lambda w: F.length(w) > 2)
    return d.select("pair_id", "side", X.simhash(tokens).alias("simhash"))


_CASES = ", ".join("CASE WHEN " + " OR ".join(f"contains(n, '{w}')" for w in ws) + f" THEN '{name}' END" for name, ws in sorted(X.CATEGORIES.items()))


@query("category_multilabel", f"WITH t AS (SELECT DISTINCT title, {NORM.format('title')} AS n FROM observations WHERE title IS NOT NULL) SELECT title, list_filter([{_CASES}], lambda c: c IS NOT NULL) AS categories FROM t")
def category_multilabel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _titles(spark, sf_dir).filter("title is not null").withColumn("categories", X.categories_of(F.col("title")))


@query("url_normalize", f"WITH t AS (SELECT DISTINCT url AS raw, trim(url) AS u FROM observations WHERE url IS NOT NULL UNION SELECT DISTINCT canonical_url, trim(canonical_url) FROM observations WHERE trim(canonical_url) <> '') SELECT raw, {PAGE} AS page, regexp_replace(lower(regexp_extract(u, '^[^:/?#]*://([^/?#]*)', 1)), '^www\\.', '') AS host FROM t")
def url_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "observations")
    raw = o.select(F.col("url").alias("raw")).filter("raw is not null").union(o.select("canonical_url").filter("trim(canonical_url) <> ''")).distinct()
    return raw.select("raw", normalize_url(F.col("raw")).alias("page"), url_host(F.col("raw")).alias("host"))


@query(
    "url_aliases",
    f"WITH t AS (SELECT trim(canonical_url) AS u, epoch_us({SQL_INSTANT}) AS t FROM observations WHERE trim(canonical_url) <> '') SELECT {PAGE} AS page, count(DISTINCT u) AS spellings, count(*) AS rows, min(t) AS first_seen, max(t) AS last_seen FROM t GROUP BY 1",
)
def url_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "observations").select("canonical_url", parse_micros(F.col("timestamp")).alias("t"))
    return alias_groups(o, "canonical_url", "t", "t")


@query(
    "trap_url",
    "WITH t AS (SELECT DISTINCT url, list_filter(string_split(lower(" + URL.format("url") + "), '/'), lambda x: x <> '') AS p, lower(" + URL.format("url") + ") AS path, list_filter(string_split(regexp_extract(url, '^[^?#]*[?]([^#]*)', 1), '&'), lambda x: x <> '') AS q FROM observations WHERE url IS NOT NULL)"
    " SELECT url, len(q) > 4 OR len(p) > 10 OR " + " OR ".join(f"contains(path, '{t}')" for t in TRAP_TOKENS) + " OR len(list_filter(p, lambda x: len(list_filter(p, lambda y: y = x)) >= 4)) > 0 AS trap FROM t",
)
def trap_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "observations").select("url").filter("url is not null").distinct().withColumn("trap", is_trap(F.col("url")))


@query("domain_norm", "SELECT domain, regexp_replace(rtrim(lower(trim(domain)), '.'), '^www\\.', '') AS norm, count(*) AS rows FROM source_events GROUP BY 1, 2")
def domain_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "source_events").groupBy("domain").agg(F.count(F.lit(1)).alias("rows")).withColumn("norm", normalize_domain(F.col("domain")))


@query("timestamp_parse", f"SELECT timestamp, epoch_us({SQL_INSTANT}) AS us, count(*) AS rows FROM observations GROUP BY 1, 2")
def timestamp_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "observations").groupBy("timestamp").agg(F.count(F.lit(1)).alias("rows")).withColumn("us", parse_micros(F.col("timestamp")))


@query(
    "hamming_pairs",
    "WITH h AS (SELECT recipe_id, max(lower(instruction_simhash)) FILTER (WHERE regexp_matches(instruction_simhash, '^[0-9a-fA-F]{16}$')) AS h FROM observations GROUP BY 1)"
    " SELECT pair_id, round(1 - bit_count(xor(('0x' || a.h)::UBIGINT, ('0x' || b.h)::UBIGINT)) / 64.0, 6)::DOUBLE AS similarity FROM dedupe_pairs LEFT JOIN h a ON a.recipe_id = left_recipe_id LEFT JOIN h b ON b.recipe_id = right_recipe_id",
)
def hamming_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "observations").filter(F.col("instruction_simhash").rlike("^[0-9a-fA-F]{16}$"))
    h = o.groupBy("recipe_id").agg(F.max(F.lower("instruction_simhash")).alias("h"))
    d = table(spark, sf_dir, "dedupe_pairs").select("pair_id", "left_recipe_id", "right_recipe_id")
    both = d.join(h.toDF("left_recipe_id", "a"), "left_recipe_id", "left").join(h.toDF("right_recipe_id", "b"), "right_recipe_id", "left")
    return both.select("pair_id", F.round(X.hamming_similarity(F.col("a"), F.col("b")), 6).alias("similarity"))


@query(
    "wilson_by_status",
    f"WITH {RECIPES}, s AS (SELECT evidence_status AS status, count(*) AS n, count(*) FILTER (WHERE rating >= 4.5) AS k FROM recipes GROUP BY 1)"
    " SELECT status, n, k, round(greatest(0.0, (k / n::DOUBLE + 3.8416 / (2 * n) - 1.96 * sqrt((k / n::DOUBLE) * (1 - k / n::DOUBLE) / n + 3.8416 / (4 * n * n))) / (1 + 3.8416 / n)), 6)::DOUBLE AS low,"
    " round(least(1.0, (k / n::DOUBLE + 3.8416 / (2 * n) + 1.96 * sqrt((k / n::DOUBLE) * (1 - k / n::DOUBLE) / n + 3.8416 / (4 * n * n))) / (1 + 3.8416 / n)), 6)::DOUBLE AS high FROM s",
)
def wilson_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = recipes(spark, sf_dir, "evidence_status").groupBy(F.col("evidence_status").alias("status")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("rating") >= 4.5).alias("k"))
    low, high = X.wilson(F.col("k"), F.col("n"))
    return s.select("status", "n", "k", F.round(low, 6).alias("low"), F.round(high, 6).alias("high"))


@query(
    "percentiles_by_source",
    f"WITH {READINGS}, c AS (SELECT source, list_sort(list(n)) AS l, quantile_cont(n::DOUBLE, 0.95) AS p95, median(n::DOUBLE) AS med FROM readings GROUP BY 1) SELECT source, round(p95, 6) AS p95_linear, round(med, 6) AS median, l[round_even((len(l) - 1) * 0.95, 0)::BIGINT + 1] AS p95_nearest FROM c",
)
def percentiles_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interpolated percentiles are exact mergeable aggregates; the nearest-rank one is the lower or upper value that
    the running counts reach at the rounded place, so no list of a source's values is built."""
    o = readings(spark, sf_dir, "source")
    stats = o.groupBy("source").agg(F.percentile("n", 0.95).alias("a"), F.median("n").alias("m"), F.count(F.lit(1)).alias("c"))
    place = (F.bround((F.col("c") - 1) * 0.95, 0) + 1).cast("bigint")
    each = o.groupBy("source", "n").agg(F.count(F.lit(1)).alias("k"))
    upto = each.withColumn("upto", F.sum("k").over(Window.partitionBy("source").orderBy("n"))).join(stats.select("source", place.alias("place")), "source").filter(F.col("upto") >= F.col("place"))
    nearest = upto.groupBy("source").agg(F.min("n").alias("p95_nearest"))
    return stats.join(nearest, "source").select("source", F.round("a", 6).alias("p95_linear"), F.round("m", 6).alias("median"), "p95_nearest")


@query(
    "rating_rescale",
    "SELECT obs_id, CASE WHEN rating_count > 0 AND rating <= b * 1.05 THEN round(greatest(0.0, least(5.0, rating / b * 5)), 6) + 0.0 END AS rescaled FROM (SELECT obs_id, rating, rating_count, CASE WHEN extraction_method = 'microdata' THEN 10.0 ELSE 5.0 END AS b FROM observations)",
)
def rating_rescale(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = F.when(F.col("extraction_method") == "microdata", 10.0).otherwise(5.0)
    return table(spark, sf_dir, "observations").select("obs_id", (F.round(X.rescale_rating(F.col("rating"), best, F.col("rating_count")), 6) + F.lit(0.0)).alias("rescaled"))


@query("category_text", f"WITH {RECIPES} SELECT id, array_to_string(coalesce(categories, []), ' | ') AS joined, len(coalesce(categories, [])) AS parts FROM recipes")
def category_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = F.array_join(F.coalesce("categories", F.array().cast("array<string>")), " | ")
    return recipes(spark, sf_dir).select("id", joined.alias("joined"), F.size(X.pipe_to_array(joined)).alias("parts"))


@query("slugs", "SELECT DISTINCT title, regexp_replace(regexp_replace(lower(title), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS slug FROM observations")
def slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _titles(spark, sf_dir).withColumn("slug", X.slug(F.col("title")))


@query("histogram_variance", f"WITH {RECIPES}, e AS (SELECT id, unnest(map_entries(histogram)) AS e FROM recipes), s AS (SELECT id, sum(e.value)::DOUBLE AS n, sum(e.key::DOUBLE * e.value) AS a, sum(e.key::DOUBLE * e.key::DOUBLE * e.value) AS b FROM e GROUP BY 1) SELECT id, round(greatest(0.0, (b - a * a / n) / (n - 1)), 6) + 0.0 AS variance FROM s WHERE n > 1")
def histogram_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recipes(spark, sf_dir).select("id", (F.round(variance(F.col("histogram")), 6) + F.lit(0.0)).alias("variance")).filter("variance is not null")
