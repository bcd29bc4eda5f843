"""File sources with explicit schemas: logs of JSON lines, one-document state, CSV, YAML-like dimensions, sitemaps."""

from __future__ import annotations

import json
import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brindle.session import checkpointed

OBSERVATION = (
    "recipe_id STRING, timestamp STRING, source STRING, url STRING, title STRING, rating DOUBLE, rating_count BIGINT, evidence_confidence DOUBLE, evidence_status STRING, extraction_method STRING, page_hash STRING, schema_version INT,"
    " dom_fingerprint STRING, schema_signature STRING, canonical_url STRING, author STRING, ingredient_signature STRING, instruction_signature STRING, instruction_simhash STRING, image_fingerprint STRING, image_perceptual_hash STRING,"
    " categories ARRAY<STRING>, rating_histogram MAP<STRING, BIGINT>, fetch_status STRING"
)


def read_log(spark: SparkSession, path: str, schema: str = OBSERVATION, strict: bool = False) -> DataFrame:
    """All records of a tree of JSON-line files, with file; bad lines are left out, or fail the read if strict."""
    reader = spark.read.schema(schema).option("recursiveFileLookup", "true").option("mode", "FAILFAST" if strict else "DROPMALFORMED")
    return reader.json(path).withColumn("file", F.col("_metadata.file_path"))


def recent_records(log: DataFrame, timestamp: str, limit: int) -> DataFrame:
    """The limit newest records, oldest first (a report of limit rows)."""
    return log.orderBy(F.desc("file"), F.desc(timestamp)).limit(limit).orderBy("file", timestamp)


def read_state(spark: SparkSession, path: str, value: str) -> DataFrame:
    """(key, value.*) of one JSON document that maps keys to records of the DDL value; a missing file has none, a
    corrupt one fails."""
    if not os.path.exists(path):
        return spark.createDataFrame([], f"key string, {value}")
    document = json.loads(Path(path).read_text())
    if not isinstance(document, dict):
        raise ValueError(f"{path} must hold an object")
    schema = T.MapType(T.StringType(), T.StructType.fromDDL(value))
    rows = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", schema, {"mode": "FAILFAST"})).alias("key", "r"))
    return rows.select("key", "r.*")


def csv_number(x: Column, kind: str, blank: int | None = 0) -> Column:
    """A CSV cell as a number: integers may be written as decimals, blank cells are blank."""
    text = F.trim(x)
    value = text.try_cast("double")
    number = value.try_cast("bigint") if kind == "int" else value
    return F.when(F.coalesce(text, F.lit("")) == "", F.lit(blank).cast(number_type(kind))).otherwise(number)


def number_type(kind: str) -> str:
    return "bigint" if kind == "int" else "double"


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV table with a header; quoted cells may hold line ends."""
    return spark.read.schema(schema).option("header", "true").option("multiLine", "true").option("escape", '"').csv(path)


def read_dimension(spark: SparkSession, path: str, schema: str, defaults: dict[str, object]) -> DataFrame:
    """A small YAML or JSON list of records with defaults; disabled rows are left out."""
    text = Path(path).read_text()
    try:
        rows = json.loads(text)
    except ValueError:
        import yaml

        rows = yaml.safe_load(text)
    rows = rows.get("sources", []) if isinstance(rows, dict) else rows
    names = T.StructType.fromDDL(schema).names
    kept = [tuple((defaults | r).get(n) for n in names) for r in rows or [] if (defaults | r).get("enabled", True)]
    return spark.createDataFrame(kept, schema)


def sitemap_links(documents: DataFrame) -> DataFrame:
    """(url, kind, loc, lastmod) of sitemap documents (url, xml): kind 'index' names further sitemaps, 'page' pages.
    Documents that aren't XML give nothing."""
    xml = F.regexp_replace("xml", r"""\sxmlns(:\w+)?\s*=\s*("[^"]*"|'[^']*')""", "")
    parts = documents.select("url", F.explode(F.regexp_extract_all(xml, F.lit(r"(?s)<(sitemap|url)\b[^>]*>(.*?)</(?:sitemap|url)>"), 0)).alias("entry"))
    loc = F.trim(F.regexp_extract("entry", r"(?s)<loc>\s*(?:<!\[CDATA\[)?(.*?)(?:\]\]>)?\s*</loc>", 1))
    last = F.nullif(F.trim(F.regexp_extract("entry", r"(?s)<lastmod>(.*?)</lastmod>", 1)), F.lit(""))
    unescaped = F.replace(F.replace(F.replace(loc, F.lit("&lt;"), F.lit("<")), F.lit("&gt;"), F.lit(">")), F.lit("&amp;"), F.lit("&"))
    return parts.select("url", F.when(F.col("entry").startswith("<sitemap"), "index").otherwise("page").alias("kind"), unescaped.alias("loc"), last.alias("lastmod")).filter("loc <> ''")


def sitemap_pages(documents: DataFrame, roots: list[str]) -> DataFrame:
    """Pages that root sitemaps reach through indexes of any depth, each once with its latest lastmod; cycles end by
    themselves, since no document is followed twice. Each level is written, so a deep tree has no deep plan."""
    links = sitemap_links(documents)
    seen = documents.sparkSession.createDataFrame([(r,) for r in roots], "doc string")
    new = seen
    while True:
        new = links.filter("kind = 'index'").join(new, links["url"] == new["doc"], "left_semi").select(F.col("loc").alias("doc")).distinct().join(seen, "doc", "left_anti")
        new = checkpointed(new)
        if new.isEmpty():
            break
        seen = checkpointed(seen.union(new))
    return links.filter("kind = 'page'").join(seen, links["url"] == seen["doc"], "left_semi").groupBy(F.col("loc").alias("page")).agg(F.max("lastmod").alias("lastmod"))
