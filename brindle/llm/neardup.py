"""Groups of records that recur with small edits."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.llm.text import hash_words, plain_words
from brindle.operators.graph import connected_components
from brindle.operators.units import parse_line
from brindle.session import checkpointed

#: Bits of a chunk beyond which a signature is split in more chunks, and the most bits that a key keeps.
CHUNK_BITS = 12
KEY_BITS = 3
#: Words (of 64 bits) of the sketch of a record's step words.
SKETCH = 4
#: Names in at least this share of records are ordered by their counts; rarer ones come first, by hash.
COMMON_SHARE = 0.001


def chunk_count(bits: int) -> int:
    """Chunks of a signature with so many bits set: a power of two, so that few counts occur."""
    count = 1
    while bits > CHUNK_BITS * count:
        count *= 2
    return count


def least_common(a: int, b: int) -> int:
    """Common bits of two chunks within the allowed distance: |A xor B| <= (a + b) / 3 means 3 |A and B| >= a + b."""
    return -(-(a + b) // 3)


def chunk_keys(signature: list[int]) -> set[int]:
    """Keys of a signature (its bits in one order for all records, rare ones first) such that any two signatures with
    Jaccard similarity 1/2 or more share one.

    The similarity bounds the Hamming distance by a third of the bits of both. Split into chunks by the bits'
    hashes, at least one chunk keeps that bound (pigeonhole). For every size b that the partner's chunk may have, the
    allowed errors are enumerated: of the a bits of a chunk the two have c or more in common, so the first KEY_BITS
    (or c) common ones are among its first a - c + KEY_BITS, and all ways to choose them there are keys. The commonest
    bits are thus in no key.
    """
    n = len(signature)
    keys: set[int] = set()
    # the partner has from n/2 to 2n bits; both sides use the chunks of the larger one
    for count in {chunk_count(n), chunk_count(2 * n)}:
        chunks: dict[int, list[int]] = {}
        for bit in signature:
            chunks.setdefault((bit >> 40) % count, []).append(bit)
        for place, bits in chunks.items():
            a = len(bits)
            reach: dict[int, int] = {}
            for b in range(1, 2 * a + 1):
                c = least_common(a, b)
                if c <= min(a, b):
                    keep = min(KEY_BITS, c)
                    reach[keep] = max(reach.get(keep, 0), a - c + keep)
            for keep, first in reach.items():
                for kept in combinations(bits[:first], keep):
                    keys.add(xxhash.xxh3_64_intdigest(np.array([count, place, *kept], np.uint64).tobytes()) >> 1)
    return keys


def sketch(words: np.ndarray) -> list[int]:
    """Parity of the words that fall on each of SKETCH x 64 bits. Sketches of two sets differ in at most as many bits as
    the sets in words, so their Hamming distance is a lower bound."""
    odd = np.bincount((words >> 20) % (SKETCH * 64), minlength=SKETCH * 64) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["id", "names", "words"]
    for batch in batches:
        ids, items, steps = (batch.column(i).to_pylist() for i in range(3))
        left = [sorted({int(h) for h in (hash_words(sorted({parse_line(x)[0] for x in row or [] if x} - {""})) >> np.uint64(1))}) for row in items]
        right = [np.unique(hash_words(plain_words(" ".join(x for x in row or [] if x))) >> np.uint64(1)).astype(np.int64).tolist() for row in steps]
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(left, pa.list_(pa.int64())), pa.array(right, pa.list_(pa.int64()))], names=names)


def _key_batches(common: dict[int, int]):
    schema = pa.schema([("id", pa.int64()), ("key", pa.int64()), ("n", pa.int64()), ("w", pa.int64()), *[(f"s{i}", pa.int64()) for i in range(SKETCH)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, signatures, words = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)
            for at in range(0, len(ids), 200):
                made = [chunk_keys(sorted(s, key=lambda bit: (common.get(bit, 0), bit))) for s in signatures[at : at + 200]]
                sizes = [len(k) for k in made]
                facts = [[len(signatures[k]), len(words[k].values), *sketch(words[k].values.to_numpy())] for k in range(at, at + len(made))]
                keys = np.fromiter((k for m in made for k in m), np.int64, sum(sizes))
                columns = [np.repeat(np.array(ids[at : at + 200], np.int64), sizes), keys, *(np.repeat(c, sizes) for c in np.array(facts, np.int64).T)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema)

    return run


def similar_records(df: DataFrame, row_id: str, ingredients: str, steps: str) -> tuple[DataFrame, DataFrame]:
    """Classes of equal records and the links between different ones.

    Returns (members, links): members (id, class) with class the smallest id of records with the same ingredient
    names and the same distinct words; links (a, b), a < b, classes that share at least half of all ingredient
    names and two thirds of all distinct words of their steps.

    Method: a multi-index Hamming join. A record's signature has one bit per ingredient name; keys (chunk_keys)
    guarantee that all pairs within the signature distance meet. Key rows carry the sizes of both sets and a second
    signature of SKETCH x 64 bits over the step words, so the join itself drops pairs whose sizes or whose signature
    distance exceed what the thresholds allow (neither can lose a link); what is left is compared exactly on names and
    words. Copies are collapsed first, so a record that recurs a million times is signed once; keys, not records, are
    shuffled, and a key that many different records have is an ordinary skewed join.
    """
    rows = df.select(F.col(row_id).cast("bigint").alias("id"), F.col(ingredients).alias("i"), F.col(steps).alias("s")).filter("id is not null")
    signed = checkpointed(rows.mapInArrow(_sign, "id bigint, names array<bigint>, words array<bigint>"))
    classes = checkpointed(signed.groupBy("names", "words").agg(F.min("id").alias("class")))
    members = signed.join(classes, ["names", "words"]).select("id", "class").distinct()
    kept = classes.filter((F.size("names") > 0) & (F.size("words") > 0))
    counts = kept.select(F.explode("names").alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    least = max(2.0, COMMON_SHARE * kept.count())  # bounds what is collected to a mean record's names / COMMON_SHARE
    common = {r["name"]: r["n"] for r in counts.filter(F.col("n") >= least).collect()}
    sketches = [f"s{i}" for i in range(SKETCH)]
    keys = kept.select("class", "names", "words").mapInArrow(_key_batches(common), "id bigint, key bigint, n bigint, w bigint, " + ", ".join(f"{s} bigint" for s in sketches))
    distance = sum((F.bit_count(F.col(f"x.{s}").bitwiseXOR(F.col(f"y.{s}"))) for s in sketches), F.lit(0))
    sizes = (2 * F.least("x.n", "y.n") >= F.greatest("x.n", "y.n")) & (3 * F.least("x.w", "y.w") >= 2 * F.greatest("x.w", "y.w"))
    near = (F.col("x.key") == F.col("y.key")) & (F.col("x.id") < F.col("y.id")) & sizes & (5 * distance <= F.col("x.w") + F.col("y.w"))
    pairs = keys.alias("x").join(keys.alias("y"), near).select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()
    one = kept.select(F.col("class").alias("a"), F.col("names").alias("an"), F.col("words").alias("aw"))
    two = kept.select(F.col("class").alias("b"), F.col("names").alias("bn"), F.col("words").alias("bw"))
    both = pairs.join(one, "a").join(two, "b")

    def shared(x: str, y: str) -> Column:
        return F.size(F.array_intersect(x, y))

    def united(x: str, y: str) -> Column:
        return F.size(x) + F.size(y) - shared(x, y)

    links = both.filter((2 * shared("an", "bn") >= united("an", "bn")) & (3 * shared("aw", "bw") >= 2 * united("aw", "bw"))).select("a", "b")
    return members, links


def record_groups(df: DataFrame, row_id: str, ingredients: str, steps: str) -> DataFrame:
    """(id, group_id, links): every record that recurs, its group (smallest id) and its class's links.

    Records belong to one group if links or equality connect them. Defined cases: null or empty ingredient lists
    or steps, and lists without a single name, recur nowhere, not even as copies; null ids are left out; repeated
    rows of one id count once; ties don't arise; very long lists are split in more chunks; extra columns are
    ignored; an empty table gives no rows.
    """
    members, links = similar_records(df, row_id, ingredients, steps)
    links = checkpointed(links)
    components = connected_components(links)
    degree = links.select(F.col("a").alias("class")).union(links.select("b")).groupBy("class").agg(F.count(F.lit(1)).alias("links"))
    placed = members.join(components.withColumnRenamed("node", "class"), "class", "left").join(degree, "class", "left")
    usable = df.filter(F.exists(ingredients, lambda x: F.trim(x) != "") & F.exists(steps, lambda x: F.trim(x) != "")).select(F.col(row_id).cast("bigint").alias("id")).distinct()
    grouped = placed.join(usable, "id", "left_semi").select("id", F.coalesce("component", "class").alias("group_id"), F.coalesce("links", F.lit(0)).alias("links"))
    several = grouped.groupBy("group_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("group_id")
    return grouped.join(several, "group_id", "left_semi").select("id", "group_id", "links")


def recurring_pairs(df: DataFrame, row_id: str, ingredients: str, steps: str) -> DataFrame:
    """(a, b), a < b: every two ids of one group."""
    groups = checkpointed(record_groups(df, row_id, ingredients, steps).select("id", "group_id"))
    return groups.alias("x").join(groups.alias("y"), "group_id").filter("x.id < y.id").select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
