"""Byte-level BPE encoding of a whole corpus with a public vocabulary."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Where the public vocabularies lie (a parameter of the operator) and their split pattern.
#: \s is spelled as the Unicode property so that all regex libraries mean the same characters.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"

#: Bounds of the two memos of a worker; a full memo is emptied.
MEMO_PIECES = 400_000
#: Characters of the lines that are remembered; with their ids some 40 bytes each.
MEMO_CHARS = 4_000_000
_NEVER = 1 << 62


def load_ranks(path: str = VOCABULARY) -> dict[bytes, int]:
    """Token bytes to rank (= id) of a rank file: one base64 token and its rank per line."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in Path(path).read_bytes().splitlines() if line)}


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: merge the leftmost of the lowest-ranked adjacent pairs until none can be merged.

    A segment tree holds the rank of every adjacent pair, ties broken by place, so its root is the next merge. A
    merge changes three leaves, each in logarithmic time: a piece of n bytes takes O(n log n), however long it is.
    """
    n = len(piece)
    if n < 2:
        return [ranks[piece]] if n else []
    width = 1 << (n - 1).bit_length()
    tree = [_NEVER] * (2 * width)
    find = ranks.get
    for i in range(n - 1):
        rank = find(piece[i : i + 2])
        if rank is not None:
            tree[width + i] = rank * n + i
    for node in range(width - 1, 0, -1):
        left, right = tree[2 * node], tree[2 * node + 1]
        tree[node] = left if left < right else right
    after = list(range(1, n + 1))  # start of the next part
    before = list(range(-1, n - 1))

    def put(i: int, value: int) -> None:
        node = width + i
        tree[node] = value
        node >>= 1
        while node:
            left, right = tree[2 * node], tree[2 * node + 1]
            value = left if left < right else right
            if tree[node] == value:
                break
            tree[node] = value
            node >>= 1

    def pair(i: int) -> int:
        second = after[i]
        if second >= n:
            return _NEVER
        rank = find(piece[i : after[second]])
        return _NEVER if rank is None else rank * n + i

    while tree[1] < _NEVER:
        i = tree[1] % n
        gone = after[i]
        after[i] = after[gone]
        if after[i] < n:
            before[after[i]] = i
        put(gone, _NEVER)
        put(i, pair(i))
        if before[i] >= 0:
            put(before[i], pair(before[i]))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : after[i]]])
        i = after[i]
    return ids


class _Pieces(dict):
    """Memo of pieces; a piece that is itself a token needs no merging."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        super().__init__()
        self.ranks = ranks

    def __missing__(self, piece: str) -> tuple[int, ...]:
        raw = piece.encode("utf-8", "surrogatepass")
        whole = self.ranks.get(raw)
        ids = (whole,) if whole is not None else tuple(merge_piece(raw, self.ranks))
        if len(self) >= MEMO_PIECES:
            self.clear()
        if len(piece) < 64:
            self[piece] = ids
        return ids


class Encoder:
    """Encodes texts; keeps memos of pieces and of lines, which revisions of a page share."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.pieces = _Pieces(ranks)
        self.lines: dict[str, list[int]] = {}
        self.kept = 0
        self.split = regex.compile(PATTERN).findall
        # A line end between two characters that aren't white space is a piece of its own, and so is each of two.
        self.cut = regex.compile(r"(?<=\P{White_Space})(\n\n?)(?=\P{White_Space})").split
        self.breaks = list(self.pieces["\n"])

    def line(self, text: str) -> list[int]:
        pieces = self.pieces
        out: list[int] = []
        for piece in self.split(text):
            out += pieces[piece]
        return out

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text without special tokens; null and empty texts have none."""
        if not text:
            return []
        out: list[int] = []
        for i, part in enumerate(self.cut(text)):
            if i % 2:
                out += self.breaks * len(part)
                continue
            ids = self.lines.get(part)
            if ids is None:
                ids = self.line(part)
                if len(part) <= 1000:
                    self.kept += len(part)
                    if self.kept > MEMO_CHARS:
                        self.lines.clear()
                        self.kept = len(part)
                    self.lines[part] = ids
            out += ids
        return out


_ENCODERS: dict[int, Encoder] = {}


def _encode_batches(ranks) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = ranks.id if hasattr(ranks, "id") else 0
        if key not in _ENCODERS:
            _ENCODERS.clear()
            _ENCODERS[key] = Encoder(ranks.value)
        encode = _ENCODERS[key].encode
        for batch in batches:
            ends, flat = [0], []
            total = 0
            for text in batch.column(1):
                ids = encode(text.as_py())
                total += len(ids)
                ends.append(total)
                flat.append(np.array(ids, np.int64))
            values = pa.array(np.concatenate(flat) if flat else np.zeros(0, np.int64))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["doc_id", "ids"])

    return run


def encode_corpus(df: DataFrame, row_id: str, text: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, ids): every text as its ids in a byte-level BPE vocabulary, without special tokens.

    One pass without a shuffle. The vocabulary (about 50,000 entries, whatever the corpus) is read once on the
    driver and broadcast. Workers split texts by the public pattern and merge each piece by a segment tree over
    adjacent pair ranks (merge_piece); pieces and whole lines are memoised, bounded by MEMO_PIECES and
    MEMO_CHARS.

    Defined cases: null and empty texts give an empty list; strings that look like special tokens are ordinary
    text; repeated rows are encoded each; a text of one endless word takes O(n log n); extra columns are ignored.
    """
    ranks = df.sparkSession.sparkContext.broadcast(load_ranks(vocabulary))
    rows = df.select(F.col(row_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_encode_batches(ranks), "doc_id bigint, ids array<bigint>")
