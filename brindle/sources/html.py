"""Recipe evidence from fetched pages, in Arrow batches with the standard library's parser."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame

_NUMBER = re.compile(r"-?\d[\d,]*(?:\.\d+)?")
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
#: Keys of a page's data that make up its shape.
SHAPE_KEYS = ["@type", "aggregateRating", "ratingValue", "ratingCount", "reviewCount", "bestRating", "recipeIngredient", "recipeInstructions", "author", "image", "name"]
#: Attributes that make up a page's structure.
STRUCTURE = ["class", "id", "itemprop", "itemtype", "role"]


def number(value: object) -> float | None:
    """A JSON value or text as a number: the first one in a text, thousands separators left out."""
    if isinstance(value, bool) or value is None:
        return None
    if isinstance(value, (int, float)):
        return float(value)
    found = _NUMBER.search(str(value))
    return float(found[0].replace(",", "")) if found else None


class _Page(HTMLParser):
    """What the extraction needs of a page, gathered in one pass."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.scripts: list[str] = []
        self.canonical: str | None = None
        self.title = ""
        self.shape: list[str] = []
        self.marked: list[tuple[str, dict[str, str], list[str]]] = []
        self._open: list[tuple[str, list[str] | None]] = []
        self._script: list[str] | None = None
        self._in_title = False

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        at = {k: v or "" for k, v in attrs}
        if len(self.shape) < 2500:
            self.shape.append(f"{tag}[{';'.join(f'{k}={at[k]}' for k in STRUCTURE if k in at)}]")
        if tag == "script" and at.get("type") == "application/ld+json":
            self._script = []
        elif tag == "link" and "canonical" in at.get("rel", "").lower() and self.canonical is None and at.get("href"):
            self.canonical = at["href"].strip()
        elif tag == "title":
            self._in_title = True
        text: list[str] | None = None
        if "itemprop" in at:
            text = []
            self.marked.append((at["itemprop"], at, text))
        if tag not in _VOID:
            self._open.append((tag, text))

    def handle_endtag(self, tag: str) -> None:
        if tag == "script" and self._script is not None:
            self.scripts.append("".join(self._script))
            self._script = None
        if tag == "title":
            self._in_title = False
        for i in range(len(self._open) - 1, -1, -1):
            if self._open[i][0] == tag:
                del self._open[i:]
                break

    def handle_data(self, data: str) -> None:
        if self._script is not None:
            self._script.append(data)
            return
        if self._in_title:
            self.title += data
        for _, text in self._open:
            if text is not None:
                text.append(data)

    def visible(self, names: list[str]) -> float | None:
        for name in names:
            for prop, at, text in self.marked:
                if prop == name:
                    for key in ("content", "value", "data-rating", "data-value", "aria-label"):
                        if (found := number(at.get(key))) is not None:
                            return found
                    if (found := number(" ".join(text))) is not None:
                        return found
                    break
        return None


def _objects(scripts: list[str]) -> Iterator[dict]:
    for raw in scripts:
        try:
            stack = [json.loads(raw)]
        except ValueError:
            continue
        while stack:
            item = stack.pop()
            if isinstance(item, list):
                stack += item
            elif isinstance(item, dict):
                yield item
                stack += [item[k] for k in ("@graph", "mainEntity") if isinstance(item.get(k), (list, dict))]


def histogram(aggregate: dict) -> dict[str, int]:
    """Stars to counts of either shape; stars outside 0..5 don't count, of equal stars the last does."""
    raw = aggregate.get("ratingHistogram") or aggregate.get("ratingDistribution") or {}
    pairs = list(raw.items()) if isinstance(raw, dict) else []
    if isinstance(raw, list):
        pairs = [(x.get("ratingValue") or x.get("star") or x.get("value"), x.get("count") or x.get("ratingCount") or x.get("reviewCount")) for x in raw if isinstance(x, dict)]
    numbers = [(number(s), number(c)) for s, c in pairs]
    return {str(round(s)): int(c) for s, c in numbers if s is not None and c is not None and 0 <= s <= 5 and c >= 0}


def evidence(rating: float, count: int, seen_rating: float | None, seen_count: float | None) -> tuple[float, str]:
    """Confidence and status of a rating in the page's data against the one a reader sees."""
    if seen_rating is None and seen_count is None:
        return 0.65, "schema_only"
    # fixed values: how far the shown values may lie from those of the data
    agrees = (seen_rating is None or abs(rating - seen_rating) <= 0.08) and (seen_count is None or abs(count - int(seen_count)) <= max(5, int(count * 0.08)))
    return (1.0, "verified") if agrees else (0.25, "conflict")


def _texts(value: object) -> list[str]:
    out = []
    for item in value if isinstance(value, list) else [value]:
        if isinstance(item, str):
            out.append(item.strip())
        elif isinstance(item, dict):
            steps = item.get("itemListElement")
            out += [str(item.get("text") or item.get("name") or "").strip()] + (_texts(steps) if isinstance(steps, list) else [])
    return [x for x in out if x]


def _names(value: object) -> str:
    found = [x if isinstance(x, str) else x.get("name") for x in (value if isinstance(value, list) else [value]) if isinstance(x, (str, dict))]
    return ", ".join(str(x).strip() for x in found if x and str(x).strip())


def _hash(text: str, digits: int = 24) -> str:
    return hashlib.sha256(text.encode("utf-8", "ignore")).hexdigest()[:digits]


def shape(value: object) -> object:
    """What kind of data a JSON value is: its known keys, the first entry of its lists, the types of its values."""
    if isinstance(value, dict):
        return {k: shape(v) for k, v in sorted(value.items()) if k in SHAPE_KEYS}
    return [shape(x) for x in value[:1]] if isinstance(value, list) else type(value).__name__


def schema_signature(scripts: list[str]) -> str:
    """24 hex digits over the shapes of a page's data; '' without any that can be read."""
    shapes = []
    for raw in scripts:
        try:
            shapes.append(shape(json.loads(raw)))
        except ValueError:
            continue
    return _hash(json.dumps(shapes, sort_keys=True, separators=(",", ":"))) if shapes else ""


def image_of(value: object) -> str:
    """Address of an image given as text, object or a list of either; '' for none."""
    for item in value if isinstance(value, list) else [value]:
        found = item if isinstance(item, str) else item.get("url") or item.get("contentUrl") if isinstance(item, dict) else ""
        if isinstance(found, str) and found.strip():
            return found.strip()
    return ""


def extract(url: str, html: str | None) -> dict[str, object]:
    """Evidence of one page; recipe_id is null where the page has no rated recipe. Null and empty pages have none."""
    page = _Page()
    page.feed(html or "")
    page.close()
    canonical = urljoin(url or "", page.canonical) if page.canonical else url
    seen_rating, seen_count = page.visible(["ratingValue", "rating"]), page.visible(["ratingCount", "reviewCount"])
    out: dict[str, object] = {"url": url, "canonical_url": canonical, "page_hash": _hash(html or ""), "dom_fingerprint": _hash("\n".join(page.shape)), "recognized": False}
    values, counts = (sum(prop in names for prop, _, _ in page.marked) for names in (["ratingValue"], ["ratingCount", "reviewCount"]))
    out["schema_signature"] = schema_signature(page.scripts)
    out["rating_evidence_signature"] = {"visible_rating_value_nodes": values, "visible_rating_count_nodes": counts, "jsonld_scripts": len(page.scripts), "has_visible_pair": bool(values and counts)}
    best: tuple | None = None
    for item in _objects(page.scripts):
        kinds = item.get("@type")
        if "recipe" not in [str(k).lower() for k in (kinds if isinstance(kinds, list) else [kinds])]:
            continue
        out["recognized"] = True
        rated = item.get("aggregateRating")
        if not isinstance(rated, dict):
            continue
        rating, count, scale = number(rated.get("ratingValue")), number(rated.get("ratingCount") or rated.get("reviewCount")), number(rated.get("bestRating")) or 5.0
        if rating is None or count is None or int(count) <= 0 or scale <= 0 or not 0 <= rating <= scale * 1.05:
            continue
        value = max(0.0, min(5.0, rating / scale * 5))
        shown = None if seen_rating is None else seen_rating if seen_rating <= 5.05 else seen_rating / scale * 5
        confidence, status = evidence(value, int(count), shown, seen_count)
        if best is None or (confidence, int(count)) > best[0]:
            items = item.get("recipeIngredient")
            best = (confidence, int(count)), {
                "title": str(item.get("name") or page.title or url).strip(), "rating": value, "rating_count": int(count), "evidence_confidence": confidence, "evidence_status": status, "author": _names(item.get("author")), "image": image_of(item.get("image")),
                "ingredients": [str(x).strip() for x in items] if isinstance(items, list) else [], "instructions": _texts(item.get("recipeInstructions") or []), "rating_histogram": list(histogram(rated).items()),
            }
    if best:
        out |= {"recipe_id": _hash(canonical or "")} | best[1]
    return out


SCHEMA = pa.schema(
    [("url", pa.string()), ("canonical_url", pa.string()), ("page_hash", pa.string()), ("dom_fingerprint", pa.string()), ("schema_signature", pa.string()),
     ("rating_evidence_signature", pa.struct([("visible_rating_value_nodes", pa.int32()), ("visible_rating_count_nodes", pa.int32()), ("jsonld_scripts", pa.int32()), ("has_visible_pair", pa.bool_())])), ("recognized", pa.bool_()), ("recipe_id", pa.string()), ("title", pa.string()), ("rating", pa.float64()), ("rating_count", pa.int64()),
     ("evidence_confidence", pa.float64()), ("evidence_status", pa.string()), ("author", pa.string()), ("image", pa.string()), ("ingredients", pa.list_(pa.string())), ("instructions", pa.list_(pa.string())), ("rating_histogram", pa.map_(pa.string(), pa.int64()))]
)
DDL = "url string, canonical_url string, page_hash string, dom_fingerprint string, schema_signature string, rating_evidence_signature struct<visible_rating_value_nodes: int, visible_rating_count_nodes: int, jsonld_scripts: int, has_visible_pair: boolean>, recognized boolean, recipe_id string, title string, rating double, rating_count bigint, evidence_confidence double, evidence_status string, author string, image string, ingredients array<string>, instructions array<string>, rating_histogram map<string, bigint>"


def _pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [extract(u, h) for u, h in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_pylist(rows, schema=SCHEMA)


def extract_pages(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """One row of evidence per page (url, html); no shuffle."""
    return pages.select(url, html).mapInArrow(_pages, DDL)
