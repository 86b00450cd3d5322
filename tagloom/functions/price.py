"""Prices as text with two decimals, read from numbers, clean text or noisy machine readings (all Column expressions)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Characters that a reader takes for digits, currency signs, words that stand for nothing.
GLYPHS = {
    "O": "0", "О": "0", "о": "0", "o": "0",
    "I": "1", "l": "1", "|": "1", "!": "1", "і": "1",
    "S": "5", "s": "5",
    "Б": "6",
    "З": "3", "з": "3",
    "В": "8", "в": "8",
}
CURRENCY = r"[₽рР]"
ZONES = ("main_price", "main_price_rubles", "main_price_kopeeks", "old_price_or_without_card", "unit_price_or_article", "full_tag")
SPLIT_FORM, COMPACT_FORM = r"(?<!\d)(\d{1,5})\s*[., -]\s*(\d{2})(?!\d)", r"(?<!\d)(\d{3,7})(?!\d)"


def as_digits(x: Column) -> Column:
    """The text with GLYPHS read as digits."""
    return F.translate(x, "".join(GLYPHS), "".join(GLYPHS.values()))


def two_decimals(x: Column) -> Column:
    """A number as text with two decimals and no grouping; null for null and non-finite."""
    x = x.cast("double")
    return F.when(x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), F.replace(F.format_number(x, 2), F.lit(","), F.lit("")))


def try_double(x: Column) -> Column:
    """A finite double, or null."""
    d = x.try_cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) != F.lit(float("inf"))), d)


def normalize(x: Column) -> Column:
    """Price text of a string: digits and dots are kept, a comma is a dot, four digits or more without a dot end in kopecks.

    Of several dots the first counts, and two digits behind it. A chain of replacements, so that the expression stays small.
    """
    kept = F.regexp_replace(F.replace(x.cast("string"), F.lit(","), F.lit(".")), r"[^0-9.]", "")
    for pattern, by in ((r"^\.*([0-9]+)\.+([0-9]{2})[0-9]*\.[0-9.]*$", "$1.$2"), (r"^\.*([0-9]+)\.+([0-9])\.+([0-9]?)[0-9.]*$", "$1.$2$3"), (r"^\.*([0-9]+)\.\.+$", "$1."), (r"^([0-9]{2,})([0-9]{2})$", "$1.$2")):
        kept = F.regexp_replace(kept, pattern, by)
    return F.replace(F.format_number(kept.try_cast("double"), 2), F.lit(","), F.lit(""))


def integer_rubles(x: Column) -> Column:
    """One to five digits, after the glyph map, as whole rubles from 1 to 99999."""
    digits = F.regexp_replace(as_digits(F.trim(x.cast("string"))), r"\s", "")
    n = digits.try_cast("int")
    return F.when(digits.rlike(r"^\d{1,5}$") & (n >= 1), two_decimals(n))


def clean_text(x: Column) -> Column:
    """A price-like text: glyphs mapped, currency dropped, only digits, `,.-` and single blanks left."""
    kept = F.regexp_replace(F.regexp_replace(as_digits(F.trim(x)), CURRENCY, " "), r"[^0-9,.\- ]", " ")
    return F.trim(F.regexp_replace(kept, r"\s+", " "))


def candidates(x: Column, compact: bool = True) -> Column:
    """Prices in a text as array<struct<value, confidence>>, best first, each value once with its highest confidence."""
    text = clean_text(x)

    def found(pattern: str, confidence: float) -> Column:
        return F.transform(
            F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)).alias("a"), F.regexp_extract_all(text, F.lit(pattern), F.lit(2)).alias("b")),
            lambda p: F.struct((p["a"].cast("int") + p["b"].cast("int") / 100.0).alias("value"), F.lit(confidence).alias("confidence")),
        )

    split = F.filter(found(SPLIT_FORM, 0.75), lambda c: c["value"] >= 1)
    if compact:
        whole = F.transform(F.regexp_extract_all(text, F.lit(COMPACT_FORM), F.lit(1)), lambda d: F.struct((d.cast("int") / 100.0).alias("value"), F.lit(0.55).alias("confidence")))
        whole = F.filter(whole, lambda c: ~F.exists(split, lambda s: s["value"] == c["value"]) & (c["value"] >= 1))
        return F.array_distinct(F.concat(split, whole))
    return F.array_distinct(split)


def dedupe_candidates(cands: Column) -> Column:
    """Of equal values the one of highest confidence (the first such), ordered by confidence, then as they came."""
    indexed = F.transform(cands, lambda c, i: F.struct((-c["confidence"]).alias("down"), i.alias("i"), c["value"].alias("value"), c["confidence"].alias("confidence")))
    ordered = F.array_sort(indexed)
    firsts = F.filter(ordered, lambda c: ~F.exists(ordered, lambda o: (o["value"] == c["value"]) & ((o["down"] < c["down"]) | ((o["down"] == c["down"]) & (o["i"] < c["i"])))))
    return F.transform(firsts, lambda c: F.struct(c["value"].alias("value"), c["confidence"].alias("confidence")))


def choose_main(by_zone: Column) -> Column:
    """The first candidate of the first zone, in fixed order, that has one: struct<zone, value, confidence>."""
    pick = lambda z: F.when(F.size(F.coalesce(F.try_element_at(by_zone, F.lit(z)), F.array())) > 0, F.struct(F.lit(z).alias("zone"), F.try_element_at(by_zone, F.lit(z))[0].alias("price")))
    return F.coalesce(*[pick(z) for z in ZONES])


def first_price(x: Column) -> Column:
    """The first split form in a text, else its first run of 3 to 7 digits with kopecks at its end."""
    text = clean_text(x)
    a, b, c = F.regexp_extract(text, SPLIT_FORM, 1), F.regexp_extract(text, SPLIT_FORM, 2), F.regexp_extract(text, COMPACT_FORM, 1)
    return F.when(a != "", two_decimals(a.try_cast("double") + b.try_cast("double") / 100)).when(c != "", two_decimals(c.try_cast("double") / 100))


def _whole(price: Column) -> Column:
    return F.regexp_extract(price, r"^0*(\d*)\.", 1)


def _kopecks(price: Column) -> Column:
    return F.regexp_extract(price, r"\.(\d\d)$", 1)


def shift_key(price: Column) -> Column:
    """The digits that one sees whether or not the decimal point was read: 179.00 and 1.79 share 179."""
    whole, kopecks, value = _whole(price), _kopecks(price), price.try_cast("double")
    return F.when((kopecks == "00") & (value >= 5), whole).when((value < 100) & (kopecks != "00"), F.ltrim(F.concat(whole, kopecks), F.lit("0"))).when(kopecks == "00", whole).otherwise(F.concat(whole, kopecks))


def flip_key(digits: Column) -> Column:
    """Digits with 6 and 9 made one, if there are at most four."""
    return F.when(F.length(digits) <= 4, F.translate(digits, "69", "gg")).otherwise(digits)


def alias_key(price: Column, flips: bool = True) -> Column:
    """Prices with this key may be readings of one tag."""
    return flip_key(shift_key(price)) if flips else shift_key(price)


def has_flips(prices: Column) -> Column:
    """Whether an array of price texts has two that differ only in 6 and 9."""
    keys = F.array_distinct(F.transform(prices, shift_key))
    return F.size(keys) > F.size(F.array_distinct(F.transform(keys, flip_key)))


def is_integer_rubles(price: Column) -> Column:
    return price.rlike(r"^\d+\.00$") & (price.try_cast("double") >= 1)


def compatible(a: Column, b: Column, gap: float = 0.16, flips: bool = True) -> Column:
    """Equal, alias of each other, at most `gap` of the smaller apart, or of the same visible digits; null is compatible with nothing."""
    x, y = a.try_cast("double"), b.try_cast("double")
    near = F.abs(x - y) <= gap * F.greatest(F.least(x, y), F.lit(0.01))
    same = F.regexp_replace(a, r"\D", "") == F.regexp_replace(b, r"\D", "")
    return F.coalesce((a == b) | (alias_key(a, flips) == alias_key(b, flips)) | near | same, F.lit(False))


def resolve_shift(price: Column, others: Column) -> Column:
    """The largest whole-ruble candidate of the same visible digits, if it is larger than the price; else the price."""
    better = F.filter(others, lambda c: (shift_key(c) == shift_key(price)) & is_integer_rubles(c) & (c.try_cast("double") > price.try_cast("double")))
    best = F.array_max(F.transform(better, lambda c: F.struct(c.try_cast("double").alias("v"), c.alias("t"))))
    return F.coalesce(best["t"], price)


def repair_kopecks(price: Column, text: Column) -> Column:
    """`129.00` where the text says `129 99` becomes `129.99`."""
    rubles = _whole(price)
    found = _extract(text, F.concat(F.lit(r"(?<!\d)"), rubles, F.lit(r"\s*[., -]\s*(\d{2})(?!\d)")))
    return F.when((_kopecks(price) == "00") & (rubles != "") & (F.coalesce(found, F.lit("")) != ""), F.concat(rubles, F.lit("."), found)).otherwise(price)


def _extract(text: Column, pattern: Column) -> Column:
    return F.call_function("regexp_extract", text, pattern, F.lit(1))


def tokens(x: Column) -> Column:
    """All price texts in a text, in order of form and place, each once, from 0.01 to 99999.99."""
    pair = lambda p: F.transform(F.arrays_zip(F.regexp_extract_all(x, F.lit(p), F.lit(1)).alias("a"), F.regexp_extract_all(x, F.lit(p), F.lit(2)).alias("b")), lambda z: F.concat(z["a"], F.lit("."), z["b"]))
    whole = F.transform(F.regexp_extract_all(x, F.lit(r"(?<![\d.,])(\d{2,5})(?![\d.,]|\s*%)"), F.lit(1)), lambda d: F.concat(d, F.lit(".00")))
    every = F.concat(pair(r"(?<!\d)(\d{1,5})[.,](\d{2})(?!\d)"), pair(r"(?<!\d)(\d{1,5})-(\d{2})(?!\d)"), pair(r"(?<!\d)(\d{1,5})\s(\d{2})(?!\d)"), whole)
    texts = F.array_distinct(F.transform(every, lambda t: two_decimals(t.try_cast("double"))))
    return F.filter(texts, lambda t: t.try_cast("double").between(0.01, 99999.99))


def badge_price(sources: Column) -> Column:
    """The price that follows a discount badge (`28%1199`, `28%129 99`) in the first text that has one."""
    def one(t: Column) -> Column:
        a, b = F.regexp_extract(t, r"\d{1,2}\s*%\s*(\d{2,5})(?:\s(\d{2}))?(?!\d)", 1), F.regexp_extract(t, r"\d{1,2}\s*%\s*(\d{2,5})(?:\s(\d{2}))?(?!\d)", 2)
        return F.when(a != "", F.concat(a, F.lit("."), F.when(b != "", b).otherwise("00")))

    return F.get(F.filter(F.transform(sources, one), lambda t: t.isNotNull()), F.lit(0))


def context_price(sources: Column, reference: Column) -> Column:
    """The price near words for the price without a card or before: over 1.01 and up to 4.5 times the reference, nearest 1.25 times it."""
    near = F.flatten(F.transform(sources, lambda s: F.flatten(F.transform(F.regexp_extract_all(F.lower(s), F.lit(r"(.{0,24}(?:без карты|старая цена|обычная цена).{0,32})"), F.lit(1)), tokens))))
    value = lambda t: t.try_cast("double")
    ref = reference.try_cast("double")
    fit = F.filter(near, lambda t: (value(t) > ref * 1.01) & (value(t) <= ref * 4.5))
    return F.array_min(F.transform(fit, lambda t: F.struct(F.abs(value(t) - ref * 1.25).alias("far"), (-value(t)).alias("v"), t.alias("t"))))["t"]


def suspicious_default(default: Column, reference: Column, promo: Column) -> Column:
    """Whether a default price can't be right: not positive, too large, or on a promo tag far below the reference."""
    d, r = default.try_cast("double"), reference.try_cast("double")
    return F.coalesce((d <= 0) | (d > 99999) | (promo & (r > 0) & (d < F.greatest(F.lit(10.0), 0.70 * r))), F.lit(False))


def visible(main: Column, card: Column, explicit: Column, discount: Column, badge: Column, context: Column, promo: Column) -> Column:
    """struct<price_default, price_card, price_discount>: how the prices on one tag are to be understood."""
    m, b = main.try_cast("double"), badge.try_cast("double")
    first = F.when(badge.isNotNull() & (main.isNull() | (m > 1.12 * b)), badge).otherwise(main)
    card_ = F.coalesce(card, first)
    low = F.coalesce(discount, F.when(promo, F.coalesce(badge, first)))
    default = F.coalesce(explicit, context)
    default = F.when(~suspicious_default(default, first, promo), default)
    return F.struct(default.alias("price_default"), F.coalesce(card_, F.when(promo, low)).alias("price_card"), F.coalesce(low, F.when(promo, card_)).alias("price_discount"))


def from_compact(digits: Column) -> Column:
    """Three to five digits as rubles and kopecks: struct<rub, kop, price>."""
    d = F.regexp_replace(as_digits(digits), r"\D", "")
    rub, kop = F.substring(d, 1, F.length(d) - 2).try_cast("int"), F.right(d, F.lit(2)).try_cast("int")
    return F.when(F.length(d).between(3, 5), F.struct(rub.alias("rub"), kop.alias("kop"), pair_text(rub, kop).alias("price")))


def pair_text(rub: Column, kop: Column) -> Column:
    return F.concat(rub.cast("string"), F.lit("."), F.lpad(kop.cast("string"), 2, "0"))


def matches_any(value: Column, observed: Column, tolerance: float = 0.015) -> Column:
    """Whether one of the observed numbers is within the tolerance, as a share of the larger (1 at least)."""
    return F.coalesce(F.exists(observed, lambda o: F.abs(value - o) / F.greatest(F.lit(1.0), F.abs(value), F.abs(o)) <= tolerance), F.lit(False))


def tolerant_int(x: Column) -> Column:
    """A whole number out of a number's text, else its first run of digits."""
    s = x.cast("string")
    return F.coalesce(try_double(s).try_cast("long"), F.regexp_extract(s, r"(-?\d+)", 1).try_cast("long"))


def tolerant_double(x: Column, default: float | None = None) -> Column:
    """A finite number out of text with blanks and a comma, else the default."""
    got = try_double(F.regexp_replace(F.replace(x.cast("string"), F.lit(","), F.lit(".")), r"[\s ]", ""))
    return F.coalesce(got, F.lit(default)) if default is not None else got


def tolerant_bool(x: Column) -> Column:
    s = F.lower(F.trim(x.cast("string")))
    return F.when(s.isin("1", "true", "yes", "y", "да"), True).when(s.isin("0", "false", "no", "n", "нет"), False)


def clip01(x: Column) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), x))


def saturate(x: Column, k: float) -> Column:
    """x / (x + k) for x that isn't negative."""
    x = F.greatest(F.lit(0.0), x)
    return x / (x + k)
