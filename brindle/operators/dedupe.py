"""Pairwise entity resolution on blocks: keys, similarity, groups and its benchmark."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brindle.functions import text as X
from brindle.operators.graph import connected_components
from brindle.session import checkpointed

THRESHOLD = 0.80
#: What makes strong evidence of a duplicate.
STRONG = {"title": 0.88, "ingredients": 0.62, "title_with_image": 0.94, "title_alone": 0.97, "image": 0.90, "simhash": 0.88}
#: Weights of the signals of a pair; the image's address counts where its hash is missing.
WEIGHTS = {"title": 0.38, "ingredients": 0.35, "instructions": 0.08, "simhash": 0.07, "author": 0.04, "image": 0.08, "image_url": 0.03}


def prepared(records: DataFrame) -> DataFrame:
    """Records (id, title, ingredients, instructions, url, author, simhash, image, n), where there also image_url and
    confidence, with what pairs are compared on."""
    more = [F.col(c) if c in records.columns else F.lit(None).cast(t).alias(c) for c, t in (("image_url", "string"), ("confidence", "double"))]
    return records.select(
        "id", "url", "simhash", "image", "n", *more,
        X.title_form(F.coalesce("title", F.lit(""))).alias("form"), X.normalize_text(F.coalesce("title", F.lit(""))).alias("plain"),
        X.ingredient_tokens(F.col("ingredients")).alias("items"), X.long_words(F.col("instructions")).alias("steps"), X.normalize_text(F.coalesce("author", F.lit(""))).alias("author"),
    )


def block_keys(p: DataFrame) -> DataFrame:
    """(id, key): the blocks of a prepared record; pairs are compared within blocks only."""
    title = F.filter(F.split("form", " "), lambda t: F.length(t) > 2)
    keys = F.array(
        F.when(F.coalesce("url", F.lit("")) != "", F.concat(F.lit("canonical:"), "url")),
        F.when(F.size(title) > 0, F.concat(F.lit("title:"), F.array_join(F.slice(F.array_sort(F.slice(title, 1, 4)), 1, 2), "|"))),
        F.when(F.size(title) == 1, F.concat(F.lit("title1:"), F.try_element_at(title, F.lit(1)))),
        F.when(F.size("items") > 0, F.concat(F.lit("ing:"), F.array_join(F.slice("items", 1, 3), "|"))),
        F.when(F.coalesce("image", F.lit("")) != "", F.concat(F.lit("phash:"), F.substring("image", 1, 6))),
    )
    found = F.filter(keys, lambda k: k.isNotNull())
    return p.select("id", F.explode(F.when(F.size(found) > 0, found).otherwise(F.array(F.concat(F.lit("id:"), F.col("id").cast("string"))))).alias("key"))


def blocked_pairs(keys: DataFrame) -> DataFrame:
    """Distinct (a, b), a < b, that share a block. No block is truncated; large ones are split by the skew join."""
    x, y = keys.select(F.col("id").alias("a"), "key"), keys.select(F.col("id").alias("b"), "key")
    return x.join(y, "key").filter("a < b").select("a", "b").distinct()


def _chunks(hex16: Column, name: str, count: int) -> Column:
    """Parts of a fingerprint of up to 16 digits, one of which two with fewer differing bits than parts share."""
    bits = F.when(F.coalesce(hex16, F.lit("")).rlike("^[0-9a-fA-F]{1,16}$"), F.lpad(F.conv(F.upper(hex16), 16, 2), 64, "0"))
    size = -(-64 // count)
    return F.when(bits.isNotNull(), F.array(*[F.concat(F.lit(f"{name}{i}:"), F.substring(bits, 1 + i * size, size)) for i in range(count)])).otherwise(F.array().cast("array<string>"))


def duplicate_candidates(p: DataFrame) -> DataFrame:
    """Distinct (a, b), a < b, that share a block and some evidence without which no pair is a duplicate.

    A duplicate has an equal address, or ingredients alike (one of the first size - 0.62 size + 1 in a common order is
    then shared), or a like image hash (one of its seven parts is equal), or an equal author or image address, or a like
    simhash (one of eight parts). Keys are made of the block and one such piece, so that a block that many records share
    falls into small ones and is never compared all with all; nothing that can be a duplicate is lost.
    """
    ordered = F.transform(F.array_sort(F.transform("items", lambda t: F.struct(F.xxhash64(t).alias("h"), t.alias("t")))), lambda x: F.concat(F.lit("i:"), x["t"]))
    size = F.size("items")
    first = F.slice(ordered, F.lit(1), (size - F.ceil(size * STRONG["ingredients"] - 1e-9) + 1).cast("int"))
    single = F.filter(F.array(*[F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(k), c)) for k, c in (("u:", F.col("url")), ("a:", F.col("author")), ("p:", F.col("image_url")))]), lambda x: x.isNotNull())
    # up to 6 of 64 bits differ at 0.90, up to 7 at 0.88
    evidence = F.concat(single, F.when(size > 0, first).otherwise(F.array().cast("array<string>")), _chunks(F.col("image"), "m", 7), _chunks(F.col("simhash"), "s", 8))
    # longer hashes than any in use are not cut, but held together
    other = F.when((F.length("image") > 16) | (F.length("simhash") > 16), F.array(F.lit("long hash"))).otherwise(F.array().cast("array<string>"))
    pieces = p.select("id", F.explode(F.array_distinct(F.concat(evidence, other))).alias("piece"))
    keys = block_keys(p).join(pieces, "id").select("id", F.xxhash64("key", "piece").alias("key"))
    return blocked_pairs(keys)


@F.pandas_udf(T.DoubleType())
def sequence_ratio(x: pd.Series, y: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio of two texts, nulls as empty ones; Spark has no built-in with these results."""
    return pd.Series([SequenceMatcher(None, a or "", b or "").ratio() for a, b in zip(x, y, strict=True)], dtype=float)


def similarity(pairs: DataFrame, p: DataFrame, least: float | None = None) -> DataFrame:
    """(a, b, score) of pairs of prepared records: the weighted mean of the signals that are present, capped below
    the threshold without strong evidence; equal addresses give 1.

    With least (the threshold or more) only pairs that reach it are returned: pairs that couldn't with the best title
    their lengths allow are dropped before titles are compared, which is the one signal that is not JVM-side.
    """
    left = p.select(*[F.col(c).alias("a" if c == "id" else f"l_{c}") for c in p.columns])
    right = p.select(*[F.col(c).alias("b" if c == "id" else f"r_{c}") for c in p.columns])
    both = pairs.join(left, "a").join(right, "b")
    empty = (F.col("l_form") == "") | (F.col("r_form") == "")
    author = (F.col("l_author") != "") & (F.col("l_author") == F.col("r_author"))
    address = F.coalesce((F.col("l_image_url") != "") & (F.col("l_image_url") == F.col("r_image_url")), F.lit(False))
    same = F.coalesce((F.coalesce("l_url", F.lit("")) != "") & F.col("l_url").eqNullSafe(F.col("r_url")), F.lit(False))
    rows = both.select(
        "a", "b", F.when(empty, F.col("l_plain")).otherwise(F.col("l_form")).alias("x"), F.when(empty, F.col("r_plain")).otherwise(F.col("r_form")).alias("y"), author.alias("author"), address.alias("address"), same.alias("same"),
        X.jaccard(F.col("l_items"), F.col("r_items")).alias("items"), X.jaccard(F.col("l_steps"), F.col("r_steps")).alias("steps"),
        X.hamming_similarity(F.col("l_simhash"), F.col("r_simhash")).alias("simhash"), X.hamming_similarity(F.col("l_image"), F.col("r_image")).alias("image"),
    )

    def scored(title: Column) -> Column:
        signals: list[tuple[Column, float]] = [
            (title, WEIGHTS["title"]), (F.col("items"), WEIGHTS["ingredients"]), (F.col("steps"), WEIGHTS["instructions"]), (F.col("simhash"), WEIGHTS["simhash"]), (F.when(F.col("author"), 1.0), WEIGHTS["author"]),
            (F.col("image"), WEIGHTS["image"]), (F.when(F.col("image").isNull() & F.col("address"), 1.0), WEIGHTS["image_url"]),
        ]
        total = sum((F.when(v.isNotNull(), F.lit(w)).otherwise(F.lit(0.0)) for v, w in signals), F.lit(0.0))
        score = sum((F.coalesce(v, F.lit(0.0)) * w for v, w in signals), F.lit(0.0)) / total
        picture, hashed = F.coalesce(F.col("image") >= STRONG["image"], F.lit(False)), F.coalesce(F.col("simhash") >= STRONG["simhash"], F.lit(False))
        alike = ((title >= STRONG["title"]) & (F.col("items") >= STRONG["ingredients"])) | ((title >= STRONG["title_with_image"]) & picture)
        strong = F.when(F.col("items").isNotNull(), alike).otherwise((title >= STRONG["title_alone"]) & (F.col("author") | F.col("address") | picture | hashed))
        return F.when(F.col("same"), 1.0).when(strong, score).otherwise(F.least(score, F.lit(THRESHOLD - 0.01)))

    if least is not None:
        lengths = F.length("x") + F.length("y")
        best = F.when(lengths == 0, 1.0).otherwise(2 * F.least(F.length("x"), F.length("y")) / lengths)
        rows = rows.filter(scored(best) >= least - 1e-9)
    # a title is compared once per pair of spellings
    titles = rows.filter("not same").select("x", "y").distinct().withColumn("title", sequence_ratio("x", "y"))
    out = rows.join(titles, ["x", "y"], "left").select("a", "b", scored(F.coalesce("title", F.lit(1.0))).alias("score"))
    return out if least is None else out.filter(F.col("score") >= least)


def duplicate_groups(records: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(group_id, id, representative, confidence, members): records connected by pairs at or above the threshold.

    The representative has the most ratings, then the highest confidence, then the smallest id. group_id is a hash of
    the member ids that does not depend on their order and needs no list of them; a group's confidence is the best of
    its pairs. Empty tables give no rows; records without a partner are left out.
    """
    p = checkpointed(prepared(records))
    links = checkpointed(similarity(duplicate_candidates(p), p, threshold))
    nodes = checkpointed(connected_components(links))
    placed = nodes.join(p.select(F.col("id").alias("node"), "n", "confidence"), "node")
    best = links.join(nodes, links["a"] == nodes["node"]).groupBy("component").agg(F.max("score").alias("confidence"))
    order = F.struct(F.coalesce("n", F.lit(0)), F.coalesce("confidence", F.lit(0.0)), -F.col("node"))
    groups = placed.groupBy("component").agg(
        F.max_by("node", order).alias("representative"), F.lower(F.lpad(F.hex(F.xxhash64(F.bit_xor(F.xxhash64("node")), F.count(F.lit(1)))), 16, "0")).alias("group_id"), F.count(F.lit(1)).alias("members")
    )
    return placed.select("component", "node").join(groups, "component").join(best, "component").select("group_id", F.col("node").alias("id"), "representative", "confidence", "members")


def pair_benchmark(pairs: DataFrame, p: DataFrame) -> DataFrame:
    """(pair_id, expected, kind, similarity) of labelled pairs (pair_id, a, b, expected, kind) of prepared records."""
    scores = similarity(pairs.select("a", "b").distinct(), p)
    return pairs.join(scores, ["a", "b"]).select("pair_id", "expected", "kind", F.col("score").alias("similarity"))


def label_queue(records: DataFrame, labelled: DataFrame, low: float = 0.72, high: float = 0.92, limit: int = 250) -> DataFrame:
    """(left_id, right_id, similarity, distance, left_title, right_title, left_url, right_url): pairs of recipes that
    share a block, have a similarity from low to high and no label yet; the limit nearest to the threshold, of equal
    distances (to 9 digits) the more similar, then the smaller ids.

    records: as for prepared, with recipe_id; labelled: two columns of recipe ids, in either order. All candidates are
    scored before the best are taken. A recipe with several records is no candidate of itself, and of several records
    of two recipes the most similar pair counts. Rows of labelled with nulls label nothing; records without a recipe
    are left out; empty tables give no rows.
    """
    whole = checkpointed(records.filter("recipe_id is not null"))
    p = checkpointed(prepared(whole))
    scored = similarity(blocked_pairs(block_keys(p)), p).filter(F.col("score").between(low, high))
    side = {x: whole.select(F.col("id").alias(i), F.col("recipe_id").alias(f"{x}_r"), F.col("title").alias(f"{x}_t"), F.col("url").alias(f"{x}_u")) for x, i in (("l", "a"), ("r", "b"))}
    both = scored.join(side["l"], "a").join(side["r"], "b").filter("l_r <> r_r")
    less = F.col("l_r") < F.col("r_r")
    ends = {f"{name}_{c}": F.when(less if name == "left" else ~less, F.col(f"l_{k}")).otherwise(F.col(f"r_{k}")) for name in ("left", "right") for c, k in (("id", "r"), ("title", "t"), ("url", "u"))}
    pairs = both.select(F.struct("score", "a", "b").alias("_by"), *[c.alias(name) for name, c in ends.items()])
    best = pairs.groupBy("left_id", "right_id").agg(F.max_by(F.struct(F.col("_by.score").alias("similarity"), "left_title", "right_title", "left_url", "right_url"), "_by").alias("r")).select("left_id", "right_id", "r.*")
    x, y = (F.col(c) for c in labelled.columns)
    done = labelled.select(F.least(x, y).alias("left_id"), F.greatest(x, y).alias("right_id")).filter(x.isNotNull() & y.isNotNull())
    queue = best.join(done, ["left_id", "right_id"], "left_anti").withColumn("distance", F.abs(F.col("similarity") - THRESHOLD))
    return queue.orderBy(F.round("distance", 9), F.desc("similarity"), "left_id", "right_id").limit(limit).select("left_id", "right_id", "similarity", "distance", "left_title", "right_title", "left_url", "right_url")


def confusion(rows: DataFrame, thresholds: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Counts, precision, recall and F1 of (expected, similarity) at each threshold, per group of by.

    Thresholds are a list of fixed size; the counts combine before the shuffle.
    """
    keys = ["threshold", *(by or [])]
    hit, want = F.col("similarity") >= F.col("threshold"), F.col("expected")
    counted = rows.crossJoin(F.broadcast(thresholds)).groupBy(*keys).agg(F.count_if(want & hit).alias("tp"), F.count_if(~want & hit).alias("fp"), F.count_if(~want & ~hit).alias("tn"), F.count_if(want & ~hit).alias("fn"))
    precision, recall = F.try_divide("tp", F.col("tp") + F.col("fp")), F.try_divide("tp", F.col("tp") + F.col("fn"))
    return counted.withColumns({"precision": precision, "recall": recall}).withColumn("f1", F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
