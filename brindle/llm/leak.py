"""Held-out test items that stand, whole or in part and disguised, in a training corpus."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm.text import NOTE_WORDS, hash_words, plain_words, shingles
from brindle.session import checkpointed


@dataclass(frozen=True)
class LeakRules:
    #: Share of an item's words that must stand in a document as one passage.
    share: float = 0.5
    #: Share of a passage's words that may be altered (one word at least, of a passage of three words or more).
    altered: float = 0.2
    #: Most words of a shingle; items take the largest size of which a passage surely keeps one.
    size: int = 3
    #: Words that may lie between two matching stretches of a passage.
    gap: int = 4
    #: Words of the items of one pass over the corpus, which bounds what is broadcast; more items take more passes.
    block_words: int = 2_000_000

    def passage(self, words: int) -> int:
        """Fewest words of a passage: half of the item, but not a single word of several."""
        return max(math.ceil(self.share * words), min(2, words))

    def may_alter(self, span: int) -> int:
        return max(1, int(self.altered * span)) if span >= 3 else 0

    def kept(self, words: int, size: int) -> int:
        """Shingles that the shortest and every longer passage surely keeps: an altered word breaks size of them."""
        return min(s - size + 1 - size * self.may_alter(s) for s in range(self.passage(words), words + 1))

    def shingle(self, words: int) -> tuple[int, int]:
        """Size of an item's shingles and how many of them a passage surely keeps (one word always is kept)."""
        size = next(k for k in range(self.size, 0, -1) if k == 1 or self.kept(words, k) >= 1)
        return size, self.kept(words, size)

    @staticmethod
    def joint(kept: int) -> int:
        """Shingles of the prefix that a passage must share: a prefix longer by so many minus one assures them."""
        return -(-3 * kept // 4)


def short(words: np.ndarray) -> np.ndarray:
    """Word hashes in 32 bits, as they are written and compared word by word."""
    return (words & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)


class Known:
    """The shingles of all items of a block, numbered: sorted hashes by size, and a bitmap that most others miss."""

    BITS = 22

    def __init__(self, by_size: dict[int, np.ndarray]) -> None:
        self.by_size = by_size
        self.first = dict(zip(by_size, np.cumsum([0, *map(len, by_size.values())]), strict=False))
        self.maps = {}
        for size, values in by_size.items():
            self.maps[size] = np.zeros(1 << self.BITS, bool)
            self.maps[size][(values & np.uint64((1 << self.BITS) - 1)).astype(np.int64)] = True

    def hits(self, words: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of known shingles that lie within one document, and their numbers."""
        at, which = [], []
        for size, values in self.by_size.items():
            found = shingles(words, size)
            likely = np.flatnonzero(self.maps[size][(found & np.uint64((1 << self.BITS) - 1)).astype(np.int64)] & (doc[: len(found)] == doc[size - 1 :])) if len(found) else np.zeros(0, np.int64)
            place = np.minimum(np.searchsorted(values, found[likely]), len(values) - 1)
            same = values[place] == found[likely]
            at.append(likely[same])
            which.append(self.first[size] + place[same])
        at, which = np.concatenate(at), np.concatenate(which)
        order = np.argsort(at, kind="stable")
        return at[order], which[order]


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), pa.array(values.astype(np.int32)))


def _scan(known, least: int, note_words: int):
    """Documents with at least so many known shingles: their words and the places and numbers of those shingles. A row
    without an id counts in how many documents of the batch each shingle is (hits the number, places the count)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sought = known.value
        for batch in batches:
            texts = [hash_words(plain_words(t.as_py(), note_words)) for t in batch.column(1)]
            sizes = np.array([len(t) for t in texts], np.int64)
            words = np.concatenate(texts) if texts else np.zeros(0, np.uint64)
            doc = np.repeat(np.arange(len(texts)), sizes)
            at, which = sought.hits(words, doc)
            owner = doc[at]
            once = np.unique(owner * (1 << 32) + which)
            number, docs = np.unique(once & ((1 << 32) - 1), return_counts=True)
            per_doc = np.bincount(owner, minlength=len(texts))
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            keep = (per_doc >= least) & batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            mine = keep[owner]
            first = np.r_[0, np.cumsum(sizes)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([*ids[keep].astype(np.int64).tolist(), None], pa.int64()),
                    _lists(np.r_[which[mine], number], np.r_[per_doc[keep], len(number)]),
                    _lists(np.r_[(at - first[owner])[mine], docs], np.r_[per_doc[keep], len(number)]),
                    _lists(short(words[keep[doc]]), np.r_[sizes[keep], 0]),
                ],
                names=["doc_id", "hits", "places", "words"],
            )

    return run


class Passage:
    """A text as a list of word hashes, with its neighbouring pairs as one number each."""

    def __init__(self, words: np.ndarray) -> None:
        wide = words.view(np.uint32).astype(np.uint64)
        self.words: list[int] = words.tolist()
        self.pairs: list[int] = ((wide[:-1] << np.uint64(32)) | wide[1:]).tolist()

    def places(self) -> dict[int, list[int]]:
        """Where each neighbouring pair stands."""
        found: dict[int, list[int]] = {}
        for place, pair in enumerate(self.pairs):
            found.setdefault(pair, []).append(place)
        return found


def _resume(doc: Passage, item: Passage, index: dict[int, list[int]], i: int, j: int, step: int, gap: int) -> tuple[int, int] | None:
    """Words to skip in both texts after a mismatch at (i, j): the fewest within gap words of either text to where two
    words in a row match, or one word after at most two replaced ones."""
    best = None
    for a in range(gap + 1):
        x = i + a * step if step > 0 else i - a - 1
        if not 0 <= x < len(doc.pairs):
            break
        for y in index.get(doc.pairs[x], ()):
            b = y - j if step > 0 else j - y - 1
            if 0 <= b <= gap and (best is None or (a + b, a) < (sum(best), best[0])):
                best = (a, b)
    for k in (1, 2):
        x, y = i + k * step, j + k * step
        if (best is None or (2 * k, k) < (sum(best), best[0])) and 0 <= x < len(doc.words) and 0 <= y < len(item.words) and doc.words[x] == item.words[y]:
            return k, k
    return best


def _extend(doc: Passage, item: Passage, index: dict[int, list[int]], i: int, j: int, step: int, rules: LeakRules) -> list[tuple[int, int]]:
    """How far matching words go from (i, j) on in one direction: after each matching stretch its last item place and
    the alterations up to it. Lost item words count each, inserted ones as one alteration."""
    last, altered, ends, most = j - step, 0, [], rules.may_alter(len(item.words))
    while 0 <= i < len(doc.words) and 0 <= j < len(item.words):
        if doc.words[i] == item.words[j]:
            last, i, j = j, i + step, j + step
            continue
        ends.append((last, altered))
        skip = _resume(doc, item, index, i, j, step, rules.gap)
        if skip is None or altered + max(1, skip[1]) > most:
            return ends
        i, j, altered = i + skip[0] * step, j + skip[1] * step, altered + max(1, skip[1])
    ends.append((last, altered))
    return ends


def stands_in(doc: Passage, item: Passage, index: dict[int, list[int]], anchors: list[tuple[int, int]], rules: LeakRules) -> bool:
    """Whether a passage around one of the anchors (places of equal shingles) holds enough of the item's words."""
    need = rules.passage(len(item.words))
    seen: dict[int, int] = {}  # the furthest item place looked at on a diagonal, for anchors come in the document's order
    for i, j in anchors:
        if seen.get(i - j, -1) >= j:
            continue
        right = _extend(doc, item, index, i, j, 1, rules)
        left = _extend(doc, item, index, i - 1, j - 1, -1, rules)
        for start, before in left:
            for end, after in right:
                span = end - start + 1
                if span >= need and before + after <= rules.may_alter(span):
                    return True
        seen[i - j] = right[0][0]  # the stretch without an alteration: its other anchors give the same
    return False


@dataclass(frozen=True)
class Prefixes:
    """The rarest shingles of each item, by shingle: those of shingle k are at start[k] .. start[k + 1]."""

    start: np.ndarray
    item: np.ndarray
    place: np.ndarray
    joint: np.ndarray
    least: np.ndarray
    ids: np.ndarray
    words: list[np.ndarray]


def _joined(which: np.ndarray, at: np.ndarray, owner: np.ndarray, sizes: np.ndarray, p: Prefixes) -> tuple[np.ndarray, ...]:
    """Documents, items and anchors (document place, item place) that share enough of a prefix, within the bounds of
    length and place: no more words can match than lie on either side of an anchor in both texts."""
    many = p.start[which + 1] - p.start[which]
    row = np.repeat(np.arange(len(which)), many)
    entry = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many) + p.start[which][row]
    item, j, i, doc = p.item[entry], p.place[entry], at[row], owner[row]
    length = np.array([len(w) for w in p.words])[item]
    near = np.minimum(i, j) + np.minimum(sizes[doc] - i, length - j) >= p.least[item]
    item, j, i, doc = item[near], j[near], i[near], doc[near]
    pair = doc * len(p.ids) + item
    longest = max(map(len, p.words), default=1)
    pairs, shared = np.unique(np.unique(pair * longest + j) // longest, return_counts=True)
    good = pairs[shared >= p.joint[pairs % len(p.ids)]]
    at = np.searchsorted(good, pair)
    chosen = np.flatnonzero(good[np.minimum(at, len(good) - 1)] == pair) if len(good) else np.zeros(0, np.int64)
    chosen = chosen[np.argsort(pair[chosen], kind="stable")]  # hits come in the order of their places
    return tuple(x[chosen] for x in (doc, item, i, j))


def _verify(prefixes, rules: LeakRules, most: int = 4_000_000):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p: Prefixes = prefixes.value
        texts: dict[int, tuple[Passage, dict[int, list[int]]]] = {}
        for batch in batches:
            ids, docs, items = batch.column(0).to_numpy(), [], []
            hits, places, words = (batch.column(k) for k in (1, 2, 3))
            starts = hits.offsets.to_numpy()
            which, at = hits.values.to_numpy()[starts[0] : starts[-1]], places.values.to_numpy()[places.offsets[0].as_py() : places.offsets[-1].as_py()]
            owner, sizes = np.repeat(np.arange(len(ids)), np.diff(starts)), np.diff(words.offsets.to_numpy())
            # slices of whole documents with a bounded number of joined rows
            load = np.r_[0, np.cumsum(p.start[which + 1] - p.start[which])]
            ends = load[starts - starts[0]]
            first = 0
            while first < len(ids):
                last = max(first + 1, int(np.searchsorted(ends, ends[first] + most, "right")) - 1)
                span = slice(starts[first] - starts[0], starts[last] - starts[0])
                doc, item, i, j = _joined(which[span], at[span], owner[span], sizes, p)
                new = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])]) if len(doc) else np.zeros(0, int)
                here, passage = -1, None
                for a, b in zip(new, np.r_[new[1:], len(doc)], strict=True):
                    k = int(item[a])
                    if k not in texts:
                        made = Passage(p.words[k])
                        texts[k] = made, made.places()
                    if doc[a] != here:
                        here, passage = doc[a], Passage(words[int(doc[a])].values.to_numpy())
                    if stands_in(passage, *texts[k], list(zip(i[a:b].tolist(), j[a:b].tolist(), strict=True)), rules):
                        docs.append(ids[doc[a]])
                        items.append(p.ids[k])
                first = last
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(items, pa.int64())], names=["doc_id", "item_id"])

    return run


def _block(rows: DataFrame, items: dict[int, np.ndarray], rules: LeakRules) -> DataFrame:
    """One pass over the corpus for the items of a block."""
    context = rows.sparkSession.sparkContext
    ids = sorted(items)
    shape = [rules.shingle(len(items[k])) for k in ids]
    made = [shingles(items[k], size) for k, (size, _) in zip(ids, shape, strict=True)]
    by_size = {s: np.unique(np.concatenate([m for m, (size, _) in zip(made, shape, strict=True) if size == s])) for s in sorted({size for size, _ in shape})}
    known = Known(by_size)
    note_words = min([NOTE_WORDS, *(rules.passage(len(items[k])) for k in ids)])
    least = min((kept for _, kept in shape), default=1)
    scanned = checkpointed(rows.mapInArrow(_scan(context.broadcast(known), least, note_words), "doc_id bigint, hits array<int>, places array<int>, words array<int>"))
    counts = scanned.filter("doc_id is null").select(F.explode(F.arrays_zip("hits", "places")).alias("h")).groupBy("h.hits").agg(F.sum("h.places").alias("docs")).toPandas()
    docs = np.zeros(sum(map(len, by_size.values())), np.int64)
    docs[counts["hits"].to_numpy(np.int64)] = counts["docs"].to_numpy(np.int64)
    shingle, item, place = [], [], []
    for k, (m, (size, kept)) in enumerate(zip(made, shape, strict=True)):
        number = known.first[size] + np.searchsorted(by_size[size], m)
        rare = np.lexsort([np.arange(len(m)), number, docs[number]])[: len(m) - kept + rules.joint(kept)]
        rare = rare[docs[number[rare]] > 0]
        shingle.append(number[rare])
        item.append(np.full(len(rare), k))
        place.append(rare)
    shingle, item, place = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (shingle, item, place))
    order = np.argsort(shingle, kind="stable")
    spans = [rules.passage(len(items[k])) for k in ids]
    prefixes = Prefixes(
        np.searchsorted(shingle[order], np.arange(len(docs) + 1)), item[order].astype(np.int32), place[order].astype(np.int32), np.array([rules.joint(kept) for _, kept in shape], np.int64),
        np.array([s - rules.may_alter(s) for s in spans], np.int64), np.array(ids, np.int64), [short(items[k]) for k in ids],
    )
    return scanned.filter("doc_id is not null").mapInArrow(_verify(context.broadcast(prefixes), rules), "doc_id bigint, item_id bigint")


def leaked_items(docs: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str, rules: LeakRules = LeakRules()) -> DataFrame:
    """(doc_id, item_id) of items of which at least half the words stand in a document as one passage in the item's
    order, apart from the surface form and a few altered words (a fifth of the passage at most, or one; both ends of
    a passage are the item's own words, and a single word is no passage of an item of several).

    Method: a prefix-filtered set join on shingles. Each item takes the largest shingle of up to LeakRules.size words
    of which every passage that counts surely keeps t > 0 (LeakRules.shingle; single words for items of six words or
    less), so nothing that counts can be lost, whatever the item's length. One pass over the corpus keeps the places of
    item shingles and counts in how many documents each occurs. Of an item's n shingles, ordered by that rarity, only
    the n - t + c rarest are joined, since a passage can't miss more than t - c of the rest, and documents that share
    fewer than c of them are out (c is three quarters of t). Length and place bound the pairs, and the passage around each anchor
    is then verified word by word within an item-sized window. Items are the stated query set: their shingles (of
    items with at most rules.block_words words at a time) are broadcast, so nothing but counts is shuffled; larger sets
    take further passes.

    Defined cases: null and empty documents and items and rows without an id have no pairs; an item of one word stands
    where its word stands; repeated documents are each one row, repeated item rows one; very long documents take time in proportion;
    extra columns are ignored.
    """
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    wanted = items.select(F.col(item_id).cast("bigint").alias("item_id"), F.col(item_text).cast("string").alias("text")).filter("item_id is not null and text is not null")
    # a word takes two characters at least
    blocks = max(1, math.ceil((wanted.agg(F.sum(F.length("text"))).first()[0] or 0) / (2 * rules.block_words)))
    found = []
    for b in range(blocks):
        here = wanted.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).toLocalIterator()
        words = {r["item_id"]: w for r in here if len(w := hash_words(plain_words(r["text"], 1)))}
        if words:
            found.append(_block(rows, words, rules))
    if not found:
        return rows.sparkSession.createDataFrame([], "doc_id bigint, item_id bigint")
    return reduce(DataFrame.unionByName, found).distinct()
