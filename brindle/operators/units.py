"""Quantities in free text, converted to common units."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Factor of each unit to grams or millilitres (US customary measures).
UNITS = [
    # unit, kind, factor, spellings (a spelling of one letter keeps its case)
    ("gram", "mass", 1.0, ["g", "G", "gr", "gram", "grams", "gm", "gms", "gramme", "grammes"]),
    ("kilogram", "mass", 1000.0, ["kg", "kgs", "kilo", "kilos", "kilogram", "kilograms"]),
    ("milligram", "mass", 0.001, ["mg", "milligram", "milligrams"]),
    ("pound", "mass", 453.59237, ["lb", "lbs", "pound", "pounds"]),
    ("ounce", "mass", 28.349523125, ["oz", "ounce", "ounces", "ozs"]),
    ("millilitre", "volume", 1.0, ["ml", "mls", "milliliter", "milliliters", "millilitre", "millilitres"]),
    ("centilitre", "volume", 10.0, ["cl", "centiliter", "centiliters", "centilitre", "centilitres"]),
    ("decilitre", "volume", 100.0, ["dl", "deciliter", "deciliters", "decilitre", "decilitres"]),
    ("litre", "volume", 1000.0, ["l", "L", "ltr", "ltrs", "liter", "liters", "litre", "litres"]),
    ("cup", "volume", 236.5882365, ["cup", "cups", "c", "C"]),
    ("fluid ounce", "volume", 29.5735295625, ["fl oz", "fl. oz", "fl.oz", "floz", "fluid oz", "fluid ounce", "fluid ounces", "fl ounce", "fl ounces"]),
    ("tablespoon", "volume", 14.78676478125, ["tbsp", "tbsps", "tbs", "tablespoon", "tablespoons", "tblsp", "T"]),
    ("teaspoon", "volume", 4.92892159375, ["tsp", "tsps", "teaspoon", "teaspoons", "t"]),
    ("pint", "volume", 473.176473, ["pint", "pints", "pt"]),
    ("quart", "volume", 946.352946, ["quart", "quarts", "qt"]),
    ("gallon", "volume", 3785.411784, ["gallon", "gallons", "gal"]),
]
VULGAR = {"½": 1 / 2, "¼": 1 / 4, "¾": 3 / 4, "⅓": 1 / 3, "⅔": 2 / 3, "⅕": 1 / 5, "⅖": 2 / 5, "⅗": 3 / 5, "⅘": 4 / 5, "⅙": 1 / 6, "⅚": 5 / 6, "⅛": 1 / 8, "⅜": 3 / 8, "⅝": 5 / 8, "⅞": 7 / 8}
WORDS = {w: n for n, w in enumerate("zero one two three four five six seven eight nine ten eleven twelve".split())}
#: Words that describe an ingredient without naming another one.
QUALITY = ["good", "best", "fresh", "of", "a", "little", "some", "quality"]
TRAILING = ["for serving", "to taste", "to serve", "as needed", "optional"]

_V = "[" + "".join(VULGAR) + "]"
_DIGITS = rf"\d+\s+\d+\s*[/⁄]\s*\d+|\d+\s*{_V}|\d+\s*[/⁄]\s*\d+|{_V}|[1-9]\d{{0,2}}(?:,\d{{3}})+(?![\d,])(?:\.\d+)?|\d+[.,]\d+|\d+"
_WORD = r"\b(?:(?:half|quarter)(?:\s+of)?(?:\s+an?)?|three\s+quarters?(?:\s+of)?(?:\s+an?)?|an?\s+(?:half|quarter)(?:\s+of)?(?:\s+an?)?|" + "|".join(WORDS) + r"|an?)\b"
_NUMBER = re.compile(rf"(?:(?P<n>{_DIGITS})|(?P<w>{_WORD}))(?P<half>\s+and\s+a\s+(?:half|quarter)\b)?", re.I)
_TIMES = re.compile(r"\s*[x×*]\s*", re.I)
_SPACE = re.compile(r"\s+")


@lru_cache(1)
def _automaton():
    """All spellings of all units in one automaton; it reports every spelling that ends at a character."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for _, _, _, spellings in UNITS:
        for s in spellings:
            found.add_word(s.lower(), s.lower())
    found.make_automaton()
    return found


@lru_cache(1)
def _spellings() -> dict[str, str]:
    return {s: unit for unit, _, _, spellings in UNITS for s in spellings}


def _number(m: re.Match) -> float:
    def plain(t: str) -> float:
        if t[-1] in VULGAR:
            return (float(t[:-1]) if t[:-1].strip() else 0.0) + VULGAR[t[-1]]
        if "/" in t or "⁄" in t:
            whole, _, rest = t.rpartition(" ") if re.match(r"\d+\s+\d", t) else ("", "", t)
            over, under = re.split(r"\s*[/⁄]\s*", rest)
            return (float(whole) if whole else 0.0) + (float(over) / float(under) if float(under) else 0.0)
        if re.fullmatch(r"[1-9]\d{0,2}(?:,\d{3})+(?:\.\d+)?", t):
            return float(t.replace(",", ""))
        return float(t.replace(",", "."))

    if m["n"]:
        value = plain(m["n"].strip())
    else:
        word = m["w"].lower()
        value = 0.75 if word.startswith("three q") else 0.5 if "half" in word else 0.25 if "quarter" in word else float(WORDS.get(word, 1))
    if m["half"]:
        value += 0.5 if "half" in m["half"].lower() else 0.25
    return value


def _units_at(line: str) -> dict[int, tuple[int, str]]:
    """Start of each unit that stands as a word of its own, with its end and unit; the longest spelling wins."""
    low = line.lower()
    if len(low) != len(line):  # a letter whose lower case is longer would shift the places
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in line)
    found: dict[int, tuple[int, str]] = {}
    for last, spelling in _automaton().iter(low):
        start, end = last + 1 - len(spelling), last + 1
        if (start and low[start - 1].isalpha()) or (end < len(low) and (low[end].isalpha() or low[end] == "'")):
            continue
        unit = _spellings().get(line[start:end] if len(spelling) == 1 else spelling)
        if unit and end > found.get(start, (0, ""))[0]:
            found[start] = (end, unit)
    return found


def parse_line(line: str | None) -> tuple[str, list[tuple[float, str]]]:
    """Name of the ingredient and its amount as [(number, unit), ...]; [] if no amount of mass or volume is given.

    A number counts with the unit that follows it at once (blanks or a hyphen between). '2 x 175 ml' is multiplied;
    '1 lb 8 oz' is one amount of two parts; of two separate amounts the first counts. A lone 'T' is a tablespoon,
    a lone 't' a teaspoon. '1,135 g' is a thousand and more, '0,5 l' and '1,5 kg' are decimals. Null, empty and
    very long lines are lines without an amount unless they give one.
    """
    if not line:
        return "", []
    units = _units_at(line)
    parts: list[tuple[float, str]] = []
    spans: list[tuple[int, int]] = []
    at = 0
    while m := _NUMBER.search(line, at):
        at = m.end()
        if m.start() and (line[m.start() - 1].isalnum() or line[m.start() - 1] in ".,/"):
            continue
        begin, value = m.start(), _number(m)
        if (x := _TIMES.match(line, at)) and (n := _NUMBER.match(line, x.end())) and n["n"]:
            value, at = value * _number(n), n.end()
        place = at
        while place < len(line) and (line[place].isspace() or line[place] in "-‑"):
            place += 1
        if place not in units:
            if m["n"] or not m["w"]:
                spans.append((begin, at))
            elif m["w"].lower() in WORDS:
                spans.append((begin, at))
            continue
        end, unit = units[place]
        if end < len(line) and line[end] == ".":
            end += 1
        joined = parts and re.fullmatch(r"[\s,+&]*(?:and\s+|plus\s+)?", line[spans[-1][1] : begin], re.I)
        if not parts or (joined and len(parts) == len(spans) and unit != parts[-1][1]):
            parts.append((value, unit))
        spans.append((begin, end))
        at = end
    return _name(line, spans), parts


def _name(line: str, spans: list[tuple[int, int]]) -> str:
    out, last = [], 0
    for a, b in spans:
        out.append(line[last:a])
        out.append("\0")
        last = max(last, b)
    out.append(line[last:])
    text = re.sub(r"\(\s*\0[^()]*\)", "\0", "".join(out).lower())
    text = re.sub(r"\([^()]*\)", " ", text)
    pieces = [p.strip() for p in re.split(r"[,;]|\s[–—-]\s|\0", text)]
    name = next((p for p in pieces if _words(p)), "")
    return _words(name)


def _words(piece: str) -> str:
    words = _SPACE.sub(" ", piece).strip(" .–—-:")
    for tail in TRAILING:
        if words.endswith(tail):
            words = words[: -len(tail)].strip()
    kept = [w for w in words.split(" ") if w and w not in QUALITY]
    return " ".join(kept)


def unit_factors(spark: SparkSession) -> DataFrame:
    """(unit, kind, factor): the conversion table, one row per unit of UNITS; its size is fixed by this module."""
    return spark.createDataFrame([(u, k, f) for u, k, f, _ in UNITS], "unit string, kind string, factor double")


_LINES = pa.list_(pa.struct([("line", pa.int64()), ("name", pa.string()), ("parts", pa.list_(pa.struct([("number", pa.float64()), ("unit", pa.string())])))]))
_LINES_DDL = "array<struct<line: bigint, name: string, parts: array<struct<number: double, unit: string>>>>"


def _parsed(lines: list[str | None] | None) -> list[dict]:
    """Lines of a list that give an amount, with their positions from 1."""
    out = []
    for n, text in enumerate(lines or [], 1):
        name, parts = parse_line(text)
        if parts:
            out.append({"line": n, "name": name, "parts": [{"number": x, "unit": u} for x, u in parts]})
    return out


def _parse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parses the texts of all columns but the first."""
    for b in batches:
        made = [pa.array([_parsed(x) for x in b.column(i).to_pylist()], _LINES) for i in range(1, b.num_columns)]
        yield pa.RecordBatch.from_arrays([b.column(0), *made], names=b.schema.names)


def parsed_amounts(df: DataFrame, key: str, lists: list[str]) -> DataFrame:
    """(key, one column per list): for each list of lines, those that give an amount of mass or volume, as an array of
    (line, name, kind, unit, amount): amount in grams or millilitres, unit the first unit of the amount, which settles
    its kind; parts of the other kind don't count. Lists are parsed within their rows, so nothing is shuffled.

    Method: an automaton over all unit spellings (Aho-Corasick) finds units after numbers, the longest spelling
    wins, and the surroundings settle the rest (parse_line); the conversion factors, a table whose size the
    module fixes, are joined by broadcast as one row.
    """
    kind = df.schema[key].dataType.simpleString()
    parsed = df.select(key, *lists).mapInArrow(_parse_batches, f"`{key}` {kind}, " + ", ".join(f"`{c}` {_LINES_DDL}" for c in lists))
    factors = unit_factors(df.sparkSession).agg(F.map_from_entries(F.collect_list(F.struct("unit", F.struct("kind", "factor")))).alias("_factors"))
    table = parsed.crossJoin(F.broadcast(factors))

    def amount(entry: Column) -> Column:
        first = F.element_at(entry["parts"], 1)["unit"]
        known = F.filter(entry["parts"], lambda p: F.col("_factors")[p["unit"]]["kind"] == F.col("_factors")[first]["kind"])
        total = F.aggregate(known, F.lit(0.0), lambda acc, p: acc + p["number"] * F.col("_factors")[p["unit"]]["factor"])
        return F.struct(entry["line"].alias("line"), entry["name"].alias("name"), F.col("_factors")[first]["kind"].alias("kind"), first.alias("unit"), total.alias("amount"))

    return table.select(key, *[F.transform(c, amount).alias(c) for c in lists])


def common_units(lines: DataFrame) -> DataFrame:
    """Amounts of ingredient lines in grams or millilitres.

    lines: (id BIGINT, side STRING, line BIGINT, text STRING). Returns (id, side, line, name, kind, unit, amount),
    one row per line that gives an amount of mass or volume (parsed_amounts). Lines without one give no row.
    """
    rows = lines.select(F.struct("id", "side", "line").alias("_key"), F.array("text").alias("_texts"))
    return parsed_amounts(rows, "_key", ["_texts"]).select("_key.*", F.explode("_texts").alias("a")).select("id", "side", "line", "a.name", "a.kind", "a.unit", "a.amount")


def equal_amounts(df: DataFrame, key: str, left: str, right: str, tolerance: float = 0.05) -> DataFrame:
    """Lines of two lists that give about the same amount of the same ingredient in different units.

    left and right name array columns of free text. Returns (key, left_line, right_line), positions from 1, of
    lines of one row that name the same ingredient, are both masses or both volumes, are given in different units, and
    differ by at most tolerance of the larger amount. Both lists are parsed once and compared within their row, so
    only results are shuffled, to give each once. Null and empty arrays and null lines have no partner, rows without a
    key none; repeated lines each give their own rows; lines without a name match none.
    """
    rows = df.filter(F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("_key"), F.col(left).alias("_left"), F.col(right).alias("_right"))
    amounts = parsed_amounts(rows, "_key", ["_left", "_right"])

    def partners(a: Column) -> Column:
        close = F.filter("_right", lambda b: (b["name"] == a["name"]) & (b["kind"] == a["kind"]) & (b["unit"] != a["unit"]) & (F.abs(a["amount"] - b["amount"]) <= F.lit(tolerance) * F.greatest(a["amount"], b["amount"]) + 1e-9))
        return F.transform(close, lambda b: F.struct(a["line"].alias("left_line"), b["line"].alias("right_line")))

    pairs = amounts.select("_key", F.explode(F.flatten(F.transform(F.filter("_left", lambda a: a["name"] != ""), partners))).alias("p"))
    return pairs.select(F.col("_key").alias(key), "p.left_line", "p.right_line").distinct()
