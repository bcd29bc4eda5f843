"""Plain words of marked-up text, and stable hashes of words and shingles."""

from __future__ import annotations

import html
import re
import unicodedata

import numpy as np
import xxhash

_HIDDEN = re.compile("[\\u00ad\\u200b-\\u200f\\u202a-\\u202e\\u2060-\\u2064\\ufe0f\\ufeff]")
#: A note ends before the next one begins, so that an unclosed one takes nothing with it.
_NOTES = re.compile(r"<ref\b[^<>]*/>|<ref\b[^<>]*>((?:(?!<ref\b).)*?)</ref\s*>|<!--(.*?)-->", re.S | re.I)
_NAMES = (
    "a abbr article aside b big blockquote body br caption center cite code col colgroup dd del dfn div dl dt em figcaption figure font footer gallery h1 h2 h3 h4 h5 h6 head header hr html i img includeonly ins kbd li link main"
    " map math meta nav noinclude nowiki ol onlyinclude p poem pre q ref references s samp script section small source span strike strong style sub sup syntaxhighlight table tbody td templatestyles tfoot th thead time timeline title"
    " tr tt u ul var wbr"
)
_TAGS = re.compile(rf"</?(?:{'|'.join(_NAMES.split())})(?:[\s/][^<>]*)?>", re.I)
_LINKS = re.compile(r"\[\[(?:[^\[\]|]*\|)?([^\[\]|]*)\]\]")
_QUOTES = re.compile("'{2,}")
_WORDS = re.compile(r"[^\W_]+")

MEMO_WORDS = 500_000
#: Shorter notes hold no shingle of the usual five words.
NOTE_WORDS = 5


def plain_words(text: str | None, note_words: int = NOTE_WORDS) -> list[str]:
    """Words of a text apart from its surface form: entities, invisible characters, tags of known names,
    link targets and quote markup are taken away, letters folded to one case and compatibility form; the words of notes
    and comments of at least note_words words follow behind those of the text, which they would break. Null and empty texts have none."""
    if not text:
        return []
    if "&" in text:
        text = html.unescape(text)
    if not text.isascii():
        text = unicodedata.normalize("NFKC", _HIDDEN.sub("", text))
    if "<" in text:
        notes = [note for a, b in _NOTES.findall(text) if len(_WORDS.findall(note := a or b)) >= note_words]
        text = _TAGS.sub(" ", "\n".join([_NOTES.sub(" ", text), *notes]))
    if "[[" in text:
        text = _LINKS.sub(r"\1", text)
    if "''" in text:
        text = _QUOTES.sub("", text)
    return _WORDS.findall(text.lower())


class WordHashes(dict):
    """Word to a stable 64-bit hash, memoised within a bound."""

    def __missing__(self, word: str) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= MEMO_WORDS:
            self.clear()
        self[word] = value
        return value


_HASHES = WordHashes()


def hash_words(words: list[str]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of size consecutive words; empty for shorter texts."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    step = np.uint64(0x9E3779B97F4A7C15)
    for k in range(size):
        out = (out ^ (words[k : k + n] + np.uint64(k + 1))) * step
        out ^= out >> np.uint64(29)
    return out
