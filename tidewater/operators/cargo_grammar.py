"""Cargo strings by one grammar: quantity, unit from a vocabulary, commodity and merchant of each item in one pattern.

Unlike ``cargo.parse_cargo`` an item's place decides what belongs to it: its own merchant behind its own comma, its unit whether abbreviated
or a word. Fragments and units that stand where a commodity should are left out.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cargo import ITEM

# Units as abbreviations, with the words they stand for, and as words.
UNIT_ABBREVIATIONS = {"pcs": "pieces", "bdls": "bundles", "bgs": "bags", "doz": "dozens", "lds": "loads", "fms": "fathoms", "std": "standards", "stds": "standards", "sq": "squares", "ft": "feet"}
UNIT_WORDS = [
    "load", "loads", "ton", "tons", "piece", "pieces", "bundle", "bundles", "cord", "cords", "fathom", "fathoms", "standard", "standards",
    "square", "squares", "bag", "bags", "bale", "bales", "dozen", "dozens", "package", "packages",
]
# What is no commodity, short words that are one, and what is no merchant.
FRAGMENTS = ["w", "p", "sq", "ft", "pp", "i", "o", "s", "r", "&", "co", "bt", "rd", "er", "j", "m", "d", "f", "b", "a"]
SHORT_COMMODITIES = ["oak", "fir", "ash", "elm"]
PLACEHOLDERS = ["order", "to order", "in bond", "nil", "ditto"]
_UNIT = "(?:" + "|".join(UNIT_ABBREVIATIONS) + r")\.?|(?:" + "|".join(UNIT_WORDS) + ")"
_ITEM = rf"(?i)(\d[\d,]*)\s+(?:({_UNIT})\s+)?([a-z][a-z\s&\-]{{2,40}}?)(?:,\s*([A-Z][A-Za-z\s.&'\-]+?))?(?=\s*(?:,|;|—|$))"


def unit_name(unit: Column) -> Column:
    """The word of an abbreviation, and the plural of a word; null for none."""
    u = F.regexp_replace(F.lower(unit), r"\.+$", "")
    short = F.create_map(*(F.lit(x) for pair in UNIT_ABBREVIATIONS.items() for x in pair))
    plural = F.when(u.isin(UNIT_WORDS), F.when(u.endswith("s"), u).otherwise(F.concat(u, F.lit("s"))))
    return F.coalesce(F.try_element_at(short, u), plural)


def merchant_name(merchant: Column) -> Column:
    """A merchant without titles and business endings, & written out, with capitals at the beginning of words; null for placeholders and blanks.

    Words of up to two capitals stay, as initials do; and, of and the are small. An "and" that lost what followed it goes, too.
    """
    placeholder = F.lower(F.trim(F.regexp_replace(merchant, r"[.,;:\s]+$", ""))).isin(PLACEHOLDERS)
    m = F.regexp_replace(merchant, r"(?i)\b(?:Messrs?|Mrs?|Ms)\.?\s+", "")
    m = F.regexp_replace(m, r"(?i)\s+(?:Ltd|Limited|Co\.?|Company|Sons?|Brothers?)\s*$", "")
    m = F.trim(F.regexp_replace(F.replace(m, F.lit("&"), F.lit("and")), r"\s+", " "))
    m = F.regexp_replace(F.regexp_replace(m, r"[.,;:]+$", ""), r"(?i)(?:^|\s+)and$", "")

    def word(w: Column) -> Column:
        initials = (F.length(w) <= 2) & (F.upper(w) == w) & (F.lower(w) != w)
        rest = F.concat(F.upper(F.left(w, F.lit(1))), F.lower(F.substring(w, F.lit(2), F.length(w))))
        return F.when(initials, w).when(F.lower(w).isin("and", "of", "the"), F.lower(w)).otherwise(rest)

    return F.when(~placeholder, F.nullif(F.array_join(F.transform(F.split(m, " "), word), " "), F.lit("")))


def parse_items(cargo: Column) -> Column:
    """The items of a cargo string (``cargo.ITEM``) by the grammar; strings under three letters and null have none.

    Segments lie between semicolons and em dashes and have five letters or more; ``raw`` is the first 100 of an item's segment.
    """

    def of(segment: Column) -> Column:
        def item(m: Column) -> Column:
            part = lambda i: F.nullif(F.regexp_extract(m, _ITEM, i), F.lit(""))
            fields = {"quantity": F.replace(part(1), F.lit(","), F.lit("")), "unit": unit_name(part(2)), "commodity": F.lower(F.trim(part(3))), "merchant": merchant_name(part(4)), "raw": F.left(segment, F.lit(100))}
            return F.struct(*(c.alias(k) for k, c in fields.items()))

        def kept(x: Column) -> Column:
            c = x["commodity"]
            return ((F.length(c) >= 3) | c.isin(SHORT_COMMODITIES)) & ~c.isin(FRAGMENTS) & ~c.isin(UNIT_WORDS)

        return F.filter(F.transform(F.regexp_extract_all(segment, F.lit(_ITEM), F.lit(0)), item), kept)

    segments = F.filter(F.transform(F.split(F.trim(F.regexp_replace(cargo, "^[—-]+", "")), "[;—]+"), lambda s: F.trim(s)), lambda s: F.length(s) >= 5)
    return F.coalesce(F.when(F.length(cargo) >= 3, F.flatten(F.transform(segments, of)).cast(ITEM)), F.array().cast(ITEM))
