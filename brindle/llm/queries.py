"""Registered queries of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.llm.bpe import encode_corpus
from brindle.llm.leak import leaked_items
from brindle.llm.neardup import record_groups, recurring_pairs
from brindle.llm.spam import spam_pages
from brindle.llm.survivor import surviving_records
from brindle.registry import Registry
from brindle.session import table

LLM = Registry()


def left_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "dedupe_pairs").select("pair_id", F.col("left_recipe.ingredients").alias("ingredients"), F.col("left_recipe.instructions").alias("instructions"))


@LLM.query("p1_found")
def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recurring_pairs(left_recipes(spark, sf_dir), "pair_id", "ingredients", "instructions").toDF("pair_id_a", "pair_id_b")


@LLM.query("p1_groups")
def p1_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return record_groups(left_recipes(spark, sf_dir), "pair_id", "ingredients", "instructions").withColumnRenamed("id", "pair_id")


P6_SQL = r"""
WITH o AS (SELECT *, row_number() OVER (PARTITION BY recipe_id ORDER BY
        (CASE WHEN regexp_matches(trim(timestamp), '(Z|[+-][0-9]{2}:?[0-9]{2})$') THEN trim(timestamp) ELSE trim(timestamp) || 'Z' END)::TIMESTAMPTZ DESC NULLS LAST, obs_id DESC) AS nth
    FROM observations WHERE recipe_id IS NOT NULL),
r AS (SELECT recipe_id, source, evidence_confidence AS c, rating_count AS n, trim(coalesce(nullif(trim(canonical_url), ''), url)) AS u FROM o WHERE nth = 1),
s AS (SELECT *, lower(regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) AS scheme, lower(regexp_extract(u, '^[^:/?#]*://([^/?#]*)', 1)) AS host,
        regexp_extract(u, '^[^:/?#]*://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(u, '^[^?#]*[?]([^#]*)', 1) AS q FROM r WHERE u <> ''),
p AS (SELECT *, scheme || '://' || host || CASE WHEN path = '' THEN '/' ELSE path END || coalesce('?' || nullif(array_to_string(list_sort(list_filter(string_split(q, '&'),
        lambda x: x <> '' AND NOT regexp_matches(lower(x), '^(utm_[^=]*|fbclid|gclid|dclid|msclkid|igshid|mc_cid|mc_eid|share)(=|$)'))), '&'), ''), '') AS page FROM s),
g AS (SELECT *, min(recipe_id) OVER (PARTITION BY page) AS group_id, count(*) OVER (PARTITION BY page) AS members,
        row_number() OVER (PARTITION BY page ORDER BY c DESC NULLS LAST, (lower(trim(source)) = host) DESC NULLS LAST, n DESC NULLS LAST, recipe_id) AS nth FROM p)
SELECT group_id, recipe_id FROM g WHERE members > 1 AND nth = 1
"""


@LLM.query("p6_found", P6_SQL)
def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surviving_records(table(spark, sf_dir, "observations")).select("group_id", "recipe_id")


@LLM.query("p6_golden")
def p6_golden(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surviving_records(table(spark, sf_dir, "observations"))


@LLM.query("p7_ids")
def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_corpus(table(spark, sf_dir, "documents"), "doc_id", "text")


@LLM.query("p8_found")
def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaked_items(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "eval_items"), "item_id", "text")


@LLM.query("p9_found")
def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spam_pages(table(spark, sf_dir, "documents"), "doc_id", "text").select("doc_id")
