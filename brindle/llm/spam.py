"""Pages of repeated keywords, links or tags instead of sentences."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.session import checkpointed


@dataclass(frozen=True)
class SpamRules:
    """All shares are of the characters of a text's tokens. Shares of texts don't depend on the corpus size; only
    least_texts does, below which a count tells nothing whatever the share."""

    #: A neighbouring pair is known from this share of all texts on (and from least_texts texts on), ...
    known_share: float = 0.0005
    least_texts: int = 3
    #: ... its words attract each other in this order: mean information of the pair against its reverse (bits).
    order_bits: float = 0.585
    #: Words are salad where the mean information of neighbours within so many tokens is below this share of what these
    #: words have on average in the corpus, if that is at least so many bits a token.
    company_reach: int = 16
    company: float = 0.3
    company_bits: float = 1.8
    #: Words that come again within so many tokens, but never beside the same word, are shuffled keywords where they are
    #: this share of the words around.
    shuffle_reach: int = 128
    shuffled: float = 0.8
    #: A word in more than this share of texts is no keyword, however often a text has it.
    common_share: float = 0.1
    #: A word is repeated from so many times in a text on; a known collocation from so many times in a window on.
    repeated: int = 3
    #: Beginnings and ends of long words count as repeated from so many times on.
    part_repeated: int = 4
    dense: int = 5
    dense_reach: int = 16
    #: Tokens on either side over which the evidence is averaged; how much an unknown word speaks against such matter,
    #: and a number.
    reach: int = 10
    unknown: float = 0.6
    numbers: float = 0.4
    #: So much of a link's length is evidence, so that a few links among their descriptions are none.
    link_evidence: int = 12
    #: Category links from which a page is a list of them; labels (#word, word-word-12) likewise.
    categories: int = 8
    labels: int = 5
    #: The share of a text that must be such matter.
    share: float = 0.5
    least_tokens: int = 8


_MARKS = "".join(f"\\u{i:04x}" for i in range(0x300, 0xFFFF) if unicodedata.category(chr(i)) in ("Mn", "Mc", "Me"))
_TOKENS = re.compile(rf"\|\||!!|\n[|!*#:;]+|https?://[^\s\]\"<>|]+|\[\[category:[^\]\n]*\]\]|<a\s[^<>]*>|</?[a-z][^<>]*>|#\w[\w-]*|\w+-\w+-\d+|[\w{_MARKS}]+")

MEMO_WORDS = 400_000
#: Texts that are judged at once.
SLICE = 1_000
WORD, NUMBER, LINK, CATEGORY, TAG, LABEL = range(6)
#: Marks what begins a cell of a table.
CELL = -1


class _Vocabulary(dict):
    """Token to a small number, with what is known of each token in columns; emptied when full."""

    def __init__(self) -> None:
        super().__init__()
        self.rows: list[tuple[int, int, int, int, int]] = []
        self.columns = np.zeros((0, 5), np.int64)

    def __missing__(self, token: str) -> int:
        if token[:4] == "http" and "://" in token or token[:3] == "<a ":
            kind = LINK
        elif token[0] == "[":
            kind = CATEGORY
        elif token[0] in "<|!\n":  # what stands in another cell, row or list entry is no neighbour
            kind = TAG
        elif token[0] == "#" or "-" in token:
            kind = LABEL
        else:
            kind = NUMBER if token.isdigit() else WORD
        whole = xxhash.xxh3_64_intdigest(token) >> 1
        long = kind == WORD and len(token) >= 6
        head = xxhash.xxh3_64_intdigest("^" + token[:4]) >> 1 if long and token[:4].isalpha() else 0
        tail = xxhash.xxh3_64_intdigest("$" + token[-4:]) >> 1 if long and token[-4:].isalpha() else 0
        if kind == TAG and token[-1] in "|!":
            head = CELL
        self[token] = number = len(self.rows)
        self.rows.append((whole, head, tail, kind, len(token) + 1))
        return number

    def of(self, numbers: np.ndarray) -> np.ndarray:
        if len(self.columns) < len(self.rows):
            self.columns = np.concatenate([self.columns, np.array(self.rows[len(self.columns) :], np.int64)])
        return self.columns[numbers]

    def make_room(self) -> None:
        if len(self) > MEMO_WORDS:
            self.clear()
            self.rows, self.columns = [], np.zeros((0, 5), np.int64)


_VOCABULARY = _Vocabulary()


def tokens_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """What is known of all tokens of some texts (a row each) and the number of the text of each."""
    _VOCABULARY.make_room()
    numbers, sizes = [], []
    for text in texts:
        found = _TOKENS.findall(text.lower()) if text else []
        numbers.append(np.fromiter(map(_VOCABULARY.__getitem__, found), np.int64, len(found)))
        sizes.append(len(found))
    rows = _VOCABULARY.of(np.concatenate(numbers)) if numbers else np.zeros((0, 5), np.int64)
    return rows, np.repeat(np.arange(len(texts)), sizes)


ID_BITS = 31
_ID = (1 << ID_BITS) - 1
ALL = -(1 << 62)


def pair_keys(rows: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of different neighbouring words of one text and the key of each pair: the short ids of both in order."""
    at = np.flatnonzero((doc[1:] == doc[:-1]) & (rows[1:, 3] == WORD) & (rows[:-1, 3] == WORD) & (rows[1:, 0] != rows[:-1, 0])) if len(doc) else np.zeros(0, int)
    return at, ((rows[at, 0] & _ID) << ID_BITS) | (rows[at + 1, 0] & _ID)


def _per_text(keys: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """In how many texts each key is."""
    _, first = np.unique(_mixed(keys, owner), return_index=True)
    return np.unique(keys[first], return_counts=True)


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts of a batch each pair (key > 0, the smaller id first; reverse counts the other order) and each
    word (key < 0; reverse counts the different neighbours it has in them) is; key 0 counts texts with words, key ALL the
    distinct words of each."""
    for batch in batches:
        rows, doc = tokens_of(batch.column(0).to_pylist())
        at, keys = pair_keys(rows, doc)
        once = keys[np.unique(_mixed(keys, doc[at]), return_index=True)[1]]
        pair, pair_n = np.unique(once, return_counts=True)
        first, second = pair >> ID_BITS, pair & _ID
        forward = first < second
        pair = (np.minimum(first, second) << ID_BITS) | np.maximum(first, second)
        words = rows[:, 3] == WORD
        word, word_n = _per_text(rows[words, 0] & _ID, doc[words])
        texts = len(np.unique(doc))
        ends, ends_n = np.unique(np.r_[once >> ID_BITS, once & _ID], return_counts=True)
        beside = np.zeros(len(word), np.int64)
        beside[np.searchsorted(word, ends)] = ends_n
        n = np.r_[np.where(forward, pair_n, 0), word_n, texts, word_n.sum()].astype(np.int64)
        reverse = np.r_[np.where(forward, 0, pair_n), beside, 0, 0].astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[pair, -word - 1, 0, ALL]), pa.array(n), pa.array(reverse)], names=["key", "texts", "reverse"])


class _Nearby:
    """Sums over the tokens within reach of each token in the same text."""

    def __init__(self, doc: np.ndarray) -> None:
        self.n = len(doc)
        sizes = np.bincount(doc)
        self.end = np.repeat(np.cumsum(sizes), sizes)
        self.first = self.end - np.repeat(sizes, sizes)
        self.spans: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def sum(self, values: np.ndarray, reach: int) -> np.ndarray:
        if reach not in self.spans:
            at = np.arange(self.n)
            self.spans[reach] = np.minimum(at + reach + 1, self.end), np.maximum(at - reach, self.first)
        total = np.r_[0.0, np.cumsum(values)]
        high, low = self.spans[reach]
        return total[high] - total[low]


def _mixed(keys: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """One number for a key within a text."""
    return (keys.view(np.uint64) * np.uint64(0xD6E8FEB86659FD93)) ^ (doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _counts(keys: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """How often the key of each token is in its text."""
    _, group, n = np.unique(_mixed(keys, doc), return_inverse=True, return_counts=True)
    return n[group]


@dataclass(frozen=True)
class Company:
    """What the corpus tells of neighbouring words, keys and ids sorted."""

    #: Known pairs, their pointwise mutual information (bits, not below 0) and whether they keep this order.
    pairs: np.ndarray
    bits: np.ndarray
    ordered: np.ndarray
    #: Known words, the mean information they have with the word after and the word before, and whether they are common.
    words: np.ndarray
    after: np.ndarray
    before: np.ndarray
    common: np.ndarray


def _found(sought: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each sought key among the known ones, and whether it is there."""
    if not len(known):
        return np.zeros(len(sought), np.int64), np.zeros(len(sought), bool)
    place = np.minimum(np.searchsorted(known, sought), len(known) - 1)
    return place, known[place] == sought


def matter_shares(texts: list[str | None], company: Company, rules: SpamRules) -> np.ndarray:
    """Share of each text that consists of keywords, links or tags; 0 for texts of a few tokens."""
    rows, doc = tokens_of(texts)
    n = len(doc)
    if not n:
        return np.zeros(len(texts))
    whole, head, tail, kind, size = rows.T
    at, forward = pair_keys(rows, doc)
    place, there = _found(forward, company.pairs)
    hit = at[there & company.ordered[place]] if len(company.pairs) else at[:0]
    coherent = np.zeros(n, bool)
    coherent[hit] = coherent[hit + 1] = True
    spot, known = _found(whole & _ID, company.words)
    known &= kind == WORD
    frequent = known & company.common[spot] if len(company.words) else known

    # salad: known words whose neighbours tell far less of each other than these words' neighbours do in the corpus
    told, usual = np.zeros(n), np.zeros(n)
    if len(company.words):
        told[at] = np.where(there, company.bits[place], 0.0) if len(company.pairs) else 0.0
        both = known[at] & known[at + 1]
        usual[at] = np.where(both, (company.after[spot[at]] + company.before[spot[at + 1]]) / 2, 0.0)
    nearby = _Nearby(doc)
    near = nearby.sum(np.ones(n), rules.company_reach)
    expected = nearby.sum(usual, rules.company_reach)
    strange = known & ~coherent & (nearby.sum(told, rules.company_reach) < rules.company * expected) & (expected >= rules.company_bits * near)

    # equal words of a text side by side, each word's in the order of their places
    mixed = _mixed(whole, doc)
    order = np.argsort(mixed, kind="stable")
    run = np.cumsum(np.r_[False, mixed[order[1:]] != mixed[order[:-1]]])
    again = np.zeros(n, bool)
    again[order] = np.bincount(run)[run] >= rules.repeated
    part = np.zeros(n, bool)
    long = np.flatnonzero((head > 0) & ~coherent)
    part[long] = (_counts(head[long], doc[long]) >= rules.part_repeated) | (_counts(tail[long], doc[long]) >= rules.part_repeated)
    # a collocation that comes again and again within a few words
    close = np.zeros(n, bool)
    k = rules.dense - 1
    if n > k:
        early, late = order[:-k], order[k:]
        run = (whole[early] == whole[late]) & (doc[early] == doc[late]) & (late - early <= 2 * rules.dense_reach)
        for i in range(rules.dense):
            close[order[np.flatnonzero(run) + i]] = True
    word = kind == WORD
    # keywords in ever new orders: words that come again nearby while their neighbours don't
    next_to = order[1:]
    again_near = np.flatnonzero((whole[order[:-1]] == whole[next_to]) & (doc[order[:-1]] == doc[next_to]) & (next_to - order[:-1] <= rules.shuffle_reach))
    moved = np.zeros(n, bool)
    moved[order[again_near]] = moved[next_to[again_near]] = True
    beside = np.zeros(n, bool)
    beside[at] = beside[at + 1] = True
    moved &= beside  # a cell or an entry of its own keeps no company
    if len(at):
        same = at[_counts(forward, doc[at]) > 1]
        moved[same] = moved[same + 1] = False
    words_near = nearby.sum(word.astype(float), rules.company_reach)
    strange |= word & ~coherent & (nearby.sum((moved & word).astype(float), rules.company_reach) >= rules.shuffled * words_near)
    # a word that is all of a table's cell is a value, however often it comes
    mark = np.maximum.accumulate(np.where((kind == TAG) | (np.r_[True, doc[1:] != doc[:-1]]), np.arange(n), 0))
    repeated = word & ~((head[mark] == CELL) & ~beside) & ((~coherent & (again | part)) | (close & ~frequent) | strange)

    def many(what: int, least: int) -> np.ndarray:
        return (kind == what) & (np.bincount(doc[kind == what], minlength=doc[-1] + 1)[doc] >= least)

    lists = many(CATEGORY, rules.categories) | many(LABEL, rules.labels)
    bad = repeated | (kind == LINK) | lists
    neutral = ~bad & np.isin(kind, [TAG, CATEGORY, NUMBER, LABEL])
    weight = size.astype(float)
    counted = np.where(kind == LINK, np.minimum(weight, rules.link_evidence), weight)
    good = ~bad & ~neutral & coherent
    unknown = ~bad & ~neutral & ~coherent
    evidence = nearby.sum(counted * (bad.astype(float) - good - rules.unknown * unknown - rules.numbers * (kind == NUMBER)), rules.reach)
    matter = np.bincount(doc, weight * ((evidence > 0) & (kind != TAG)), minlength=len(texts))
    total = np.bincount(doc, weight * (kind != TAG), minlength=len(texts))
    enough = np.bincount(doc, minlength=len(texts)) >= rules.least_tokens
    return np.where(enough & (total > 0), matter / np.maximum(total, 1), 0.0)


def corpus_company(df: DataFrame, rules: SpamRules = SpamRules()) -> Company:
    """Pointwise mutual information of neighbouring words, and the mean of it that each word usually has.

    df has one text column. All texts are counted, batches are summed before the shuffle. What comes to the driver
    is bounded whatever the corpus: with m distinct pairs in a mean text, at most m / known_share pairs are in that
    share of all texts, and likewise for words. Counts are of texts, so a text that repeats itself has one vote.
    """
    counts = df.mapInArrow(_count_batches, "key bigint, texts bigint, reverse bigint").groupBy("key").agg(F.sum("texts").alias("texts"), F.sum("reverse").alias("reverse"))
    often = F.when(F.col("key") > 0, F.greatest("texts", "reverse")).otherwise(F.col("texts"))
    kept = checkpointed(counts.withColumn("often", often).filter(F.col("often") >= rules.least_texts))
    sums = {r["key"]: r["texts"] for r in kept.filter(F.col("key").isin(0, ALL)).collect()}
    texts, total = sums.get(0, 0), float(sums.get(ALL, 0))
    least = max(rules.least_texts, rules.known_share * texts)
    known = kept.filter((F.col("often") >= least) & ~F.col("key").isin(0, ALL)).toPandas().sort_values("key")
    keys, n, back = known["key"].to_numpy(np.int64), known["texts"].to_numpy(float), known["reverse"].to_numpy(float)
    words, word_n, beside = (x[keys < 0][::-1] for x in (-keys - 1, n, back))
    keys, n, back = keys[keys > 0], n[keys > 0], back[keys > 0]
    # both orders of a pair, each with the count of the other
    pairs, pair_n, reverse = np.r_[keys, ((keys & _ID) << ID_BITS) | (keys >> ID_BITS)], np.r_[n, back], np.r_[back, n]
    order = np.argsort(pairs)
    order = order[pair_n[order] >= least]
    pairs, pair_n, reverse = pairs[order], pair_n[order], reverse[order]
    first, second = pairs >> ID_BITS, pairs & _ID
    ordered = (pair_n >= reverse) & (np.log2((pair_n + 0.5) / ((pair_n + reverse) / 2 + 0.5)) >= rules.order_bits)
    (a, has_a), (b, has_b) = _found(first, words), _found(second, words)
    if len(words):
        bits = np.where(has_a & has_b, np.maximum(0.0, np.log2(pair_n * total / (word_n[a] * word_n[b]))), 0.0)
        after, before = (np.bincount(x[ok], (pair_n * bits)[ok], minlength=len(words)) / np.maximum(beside / 2, 1) for x, ok in ((a, has_a), (b, has_b)))
    else:
        bits, after, before = np.zeros(len(pairs)), np.zeros(0), np.zeros(0)
    return Company(pairs, bits.astype(np.float32), ordered, words, after.astype(np.float32), before.astype(np.float32), word_n >= rules.common_share * texts)


def _found_batches(model, rules: SpamRules):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), SLICE):
                part = batch.slice(at, SLICE)
                shares = matter_shares(part.column(1).to_pylist(), model.value, rules)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(shares, pa.float64())], names=["doc_id", "matter"])

    return run


def spam_pages(df: DataFrame, doc_id: str, text: str, rules: SpamRules = SpamRules()) -> DataFrame:
    """(doc_id, matter): texts of which more than half consists of repeated keywords, links or tags, and how much.

    Method: mean pointwise mutual information of neighbouring words from corpus counts. Each word has a mean
    information with its neighbours in the corpus. Where the neighbours in a text tell far less of each other than these
    words usually do, known words stand in unknown company: word salad. Words that come again and again in ever new
    company are salad too, known or not. Keywords of one subject meet often, so what speaks for sentences is a known pair that keeps one
    order (information of the pair against the mean of both orders); a collocation that comes again excessively
    within a few words doesn't. Words repeated in a text without such neighbours, links, and lists of categories or
    labels speak against. The evidence is averaged over neighbouring tokens, so that the share holds whatever the
    layout and wherever sentences stand. Two passes over the corpus; only counts are shuffled, what is broadcast is
    bounded (corpus_company). Words the corpus hardly has tell nothing of their company; they speak for prose against
    mere repetition, as in a language of few texts.

    Defined cases: null, empty and blank texts and texts of fewer than least_tokens tokens are no cases; repeated
    rows are judged each; very long texts take time in proportion; extra columns are ignored.
    """
    spark = df.sparkSession
    model = spark.sparkContext.broadcast(corpus_company(df.select(F.col(text).cast("string").alias("text")), rules))
    rows = df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_found_batches(model, rules), "doc_id bigint, matter double").filter(F.col("matter") > rules.share)
