"""Text, hash and number functions as Column expressions, all inside code generation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from brindle.functions.url import url_part

#: Words of measure that don't name an ingredient.
MEASURE = r"(?i)\b(?:cups?|tablespoons?|tbsp|teaspoons?|tsp|ounces?|oz|pounds?|lbs?|grams?|g|kg|ml|milliliters?|liters?|l|pinch|dash|cloves?)\b"
#: Words that titles share whatever the dish.
GENERIC_TITLE = ["air", "fryer", "fried", "frying", "recipe", "recipes", "easy", "best", "crispy", "quick", "homemade"]
#: Ingredient words that say nothing of the ingredient.
INGREDIENT_STOP = ["fresh", "kosher", "ground", "large", "small", "medium", "optional"]
#: Words whose presence puts a dish in a category.
CATEGORIES = {
    "Chicken": ["chicken", "wing", "wings", "drumstick", "drumsticks", "tender", "tenders"],
    "Potatoes": ["potato", "potatoes", "fries", "tater"],
    "Vegetables": ["broccoli", "cauliflower", "zucchini", "asparagus", "carrot", "carrots", "brussels", "sprout", "sprouts", "eggplant", "mushroom", "mushrooms", "green bean", "green beans", "vegetable", "vegetables", "squash"],
    "Desserts": ["cake", "cookie", "cookies", "dessert", "donut", "doughnut", "apple", "brownie", "cinnamon", "churro"],
    "Beef": ["beef", "steak", "burger", "hamburger", "meatball", "meatballs"],
    "Pork": ["pork", "bacon", "sausage", "ham"],
    "Seafood": ["salmon", "shrimp", "fish", "cod", "tilapia", "tuna", "scallop", "scallops"],
    "Breakfast": ["breakfast", "egg", "eggs", "toast", "pancake", "waffle", "bacon", "hash brown", "hashbrown"],
    "Snacks": ["snack", "snacks", "chips", "fries", "nugget", "nuggets", "bite", "bites", "taquito", "taquitos"],
}


def normalize_text(x: Column) -> Column:
    """Lower case, everything but a-z and 0-9 to one blank, trimmed; null stays null."""
    return F.trim(F.regexp_replace(F.lower(x), "[^a-z0-9]+", " "))


def words(x: Column) -> Column:
    return F.filter(F.split(normalize_text(x), " "), lambda w: w != "")


def normalize_ingredient(x: Column) -> Column:
    # fixed value: how amounts are spelled
    bare = F.regexp_replace(normalize_text(x), r"\b\d+(?:\s+\d+/\d+|/\d+|\.\d+)?\b", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, MEASURE, " "), r"\s+", " "))


def stem(token: Column) -> Column:
    """Plural endings off: -es from five letters on, -s from four on."""
    n = F.length(token)
    return F.when((n > 4) & token.endswith("es"), F.substring(token, F.lit(1), n - 2)).when((n > 3) & token.endswith("s"), F.substring(token, F.lit(1), n - 1)).otherwise(token)


def title_form(title: Column) -> Column:
    """The words of a title that tell dishes apart, stemmed, in order."""
    return F.array_join(F.filter(F.transform(words(title), stem), lambda t: ~t.isin(*GENERIC_TITLE) & (F.length(t) > 2)), " ")


def ingredient_tokens(lines: Column) -> Column:
    """Distinct sorted stemmed words of ingredient lines; null lines and a null list have none."""
    raw = F.flatten(F.transform(F.filter(F.coalesce(lines, F.array().cast("array<string>")), lambda x: x.isNotNull()), lambda x: F.split(normalize_ingredient(x), " ")))
    return F.array_sort(F.array_distinct(F.filter(F.transform(raw, stem), lambda t: (F.length(t) > 2) & ~t.isin(*INGREDIENT_STOP))))


def long_words(lines: Column) -> Column:
    """Distinct sorted words of more than two letters of all lines."""
    return F.array_sort(F.array_distinct(F.filter(words(F.array_join(F.coalesce(lines, F.array().cast("array<string>")), " ")), lambda t: F.length(t) > 2)))


def signature(lines: Column, ordered: bool) -> Column:
    """24 hex digits over the normalised lines; sorted and distinct unless their order counts; '' for none."""
    kept = F.filter(F.transform(F.coalesce(lines, F.array().cast("array<string>")), normalize_text), lambda x: x != "")
    payload = F.array_join(kept if ordered else F.array_sort(F.array_distinct(kept)), "\n")
    return F.when(F.size(kept) == 0, "").otherwise(F.substring(F.sha2(payload, 256), 1, 24))


def simhash(tokens: Column) -> Column:
    """64-bit simhash of an array of tokens, repeats counting, as a BIGINT; null for none. A token's bits are the
    first eight bytes of its SHA-256; a bit is set where at least half of the tokens have it."""
    bits = F.transform(tokens, lambda t: F.conv(F.substring(F.sha2(t, 256), 1, 16), 16, -10).cast("bigint"))
    places = F.sequence(F.lit(0), F.lit(63))
    ones = F.aggregate(bits, F.array_repeat(F.lit(0), 64), lambda acc, h: F.zip_with(acc, places, lambda n, i: n + F.getbit(h, i).cast("int")))
    set_bits = F.zip_with(ones, places, lambda n, i: F.when(2 * n >= F.size(tokens), F.call_function("shiftleft", F.lit(1).cast("bigint"), i)).otherwise(F.lit(0).cast("bigint")))
    return F.when(F.size(tokens) > 0, F.aggregate(set_bits, F.lit(0).cast("bigint"), lambda acc, b: acc.bitwiseOR(b)))


def hamming_similarity(left_hex: Column, right_hex: Column) -> Column:
    """1 - differing bits / bits of the longer of two hex strings, whatever their case; null if either is no such string
    or empty."""

    def bits(x: Column) -> Column:
        return F.conv(F.upper(x), 16, -10).cast("bigint")

    ok = left_hex.rlike("^[0-9a-fA-F]+$") & right_hex.rlike("^[0-9a-fA-F]+$")
    longest = F.greatest(F.length(left_hex), F.length(right_hex))
    left, right = F.lpad(left_hex, longest, F.lit("0")), F.lpad(right_hex, longest, F.lit("0"))
    parts = F.sequence(F.lit(1), longest, F.lit(15))
    far = F.aggregate(parts, F.lit(0), lambda acc, i: acc + F.bit_count(bits(F.substring(left, i, F.lit(15))).bitwiseXOR(bits(F.substring(right, i, F.lit(15))))))
    usual = (F.length(left_hex) == 16) & (F.length(right_hex) == 16)
    return F.when(ok & usual, 1 - F.bit_count(bits(left_hex).bitwiseXOR(bits(right_hex))) / 64).when(ok, 1 - far / (4 * longest))


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays as sets; null if either is empty or null."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), both / F.size(F.array_union(a, b)))


def categories_of(text: Column) -> Column:
    """Sorted names of all categories a word of which occurs anywhere in the normalised text, also inside words."""
    norm = normalize_text(text)
    found = [F.when(reduce(lambda x, y: x | y, [norm.contains(w) for w in ws]), F.lit(name)) for name, ws in sorted(CATEGORIES.items())]
    return F.filter(F.array(*found), lambda c: c.isNotNull())


def first_number(x: Column) -> Column:
    """First number in a text, thousands separators left out; null if none."""
    return F.replace(F.regexp_extract(x, r"-?\d[\d,]*(?:\.\d+)?", 0), F.lit(","), F.lit("")).try_cast("double")


def rescale_rating(rating: Column, best: Column, count: Column) -> Column:
    """A rating on a scale up to 5; null for counts or scales that aren't positive and ratings above the scale."""
    ok = (count > 0) & (best > 0) & (rating <= best * 1.05)
    return F.when(ok, F.greatest(F.lit(0.0), F.least(F.lit(5.0), F.try_divide(rating, best) * 5)))


def wilson(successes: Column, n: Column, z: float = 1.96) -> tuple[Column, Column]:
    """Lower and upper end of the 95 % interval of a share; null for n = 0."""
    p = F.try_divide(successes, n)
    centre = p + z * z / (2 * n)
    spread = z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
    scale = 1 + z * z / n
    ok = n > 0
    return F.when(ok, F.greatest(F.lit(0.0), F.try_divide(centre - spread, scale))), F.when(ok, F.least(F.lit(1.0), F.try_divide(centre + spread, scale)))


def pipe_to_array(x: Column) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(x, F.lit("")), r"\|"), lambda p: F.trim(p)), lambda p: p != "")


def slug(x: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(x), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def image_key(url: Column) -> Column:
    """20 hex digits of an image's address without its query; '' for a blank one."""
    address = F.concat(F.lower(url_part(F.trim(url), "scheme")), F.lit("://"), F.lower(url_part(F.trim(url), "netloc")), url_part(F.trim(url), "path"))
    return F.when(F.trim(F.coalesce(url, F.lit(""))) == "", "").otherwise(F.substring(F.sha2(address, 256), 1, 20))
