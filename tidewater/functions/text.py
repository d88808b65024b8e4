"""Column functions that repair, recognise and take apart the text of records. Null stays null unless said otherwise."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names that were decoded with the wrong character set, and what they should be.
MOJIBAKE_NAMES = {
    "GÃ¤vle": "Gävle",
    "VÃ¤stervik": "Västervik",
    "MÃ¶nsterÃ¥s": "Mönsterås",
    "TimrÃ¥": "Timrå",
    "VilagarcÃ\xada de Arousa": "Vilagarcía de Arousa",
    "A CoruÃ±a": "A Coruña",
    "TÃ¸nsberg": "Tønsberg",
    "Trois-RiviÃ¨res": "Trois-Rivières",
    "Â\xa0Saint-Brieuc": "Saint-Brieuc",
    "Â Saint-Brieuc": "Saint-Brieuc",
}
# The same for single characters, wherever they stand.
MOJIBAKE_LETTERS = {"Ã¤": "ä", "Ã¶": "ö", "Ã¥": "å", "Ã¸": "ø", "Ã±": "ñ", "Ã©": "é", "Ã¨": "è", "Ã\xad": "í"}
# Month names by their first three letters.
MONTHS = {
    "Jan": "January", "Feb": "February", "Mar": "March", "Apr": "April", "May": "May", "Jun": "June",
    "Jul": "July", "Aug": "August", "Sep": "September", "Oct": "October", "Nov": "November", "Dec": "December",
}
# The first rule that a commodity matches names it.
COMMODITY_RULES = [
    (r"^deals?$", "deals"), (r"^deal$", "deals"), (r"sawn fir deals?", "deals"), (r"white deals?", "deals"), (r"yellow deals?", "deals"),
    (r"bright.*deals?", "deals"), (r"spruce deals?", "deals"), (r"pine deals?", "deals"),
    (r"^timbers?$", "timber"), (r"oak timbers?", "oak timber"), (r"pine timbers?", "pine timber"), (r"birch timbers?", "birch timber"), (r"white pine timbers?", "white pine timber"),
    (r"^boards?$", "boards"), (r"^boars$", "boards"), (r"flooring boards?", "flooring boards"), (r"weather boards?", "weather boards"), (r"match boards?", "match boards"),
    (r"^staves?$", "staves"), (r"oak staves?", "oak staves"), (r"pipe staves?", "pipe staves"), (r"fir staves?", "fir staves"),
    (r"^battens?$", "battens"), (r"slating battens?", "slating battens"),
    (r"^logs?$", "logs"), (r"mahogany logs?", "logs mahogany"), (r"oak logs?", "logs oak"), (r"walnut logs?", "logs walnut"), (r"cedar logs?", "logs cedar"),
    (r"^planks?$", "planks"), (r"oak planks?", "oak planks"), (r"teak planks?", "teak planks"),
]
# Abbreviations of ports.
PORT_ABBREVIATIONS = {
    "F'stad": "Fredrikstad", "Fred'stad": "Fredrikstad", "G'burg": "Gothenburg", "G'berg": "Gothenburg", "Christ'a": "Christiania",
    "Christ": "Christiania", "Cronst": "Cronstadt", "St. John, N.B.": "St. John", "St. John's, N.B.": "St. John", "St. John, N. B.": "St. John",
    "St. Johns": "St. John", "Dantzig": "Danzig", "Dantzic": "Danzig", "Danzic": "Danzig", "Nykoping": "Nyköping", "Bjorneborg": "Björneborg",
    "Gefle": "Gävle", "Soderhamn": "Söderhamn",
}
# Parts of names and the port of that family, the last one otherwise.
PORT_FAMILIES = [
    (("fredrik", "fredrick", "frederik"), [(("voern", "voarn", "vaern"), "Fredriksvoern"), (("ham",), "Fredrikshamn"), (("hald", "hall"), "Fredrikshald")], "Fredrikstad"),
    (("christian",), [(("sand", "sann"), "Christiansand"), (("stad", "stat"), "Christianstad"), (("sund",), "Christiansund")], "Christiania"),
]
# Marks of a value that can't be a port or a commodity.
NON_VALUES = ["---", "--", "-", ".", "&", "and", "or"]
JOURNAL_MARKS = ["TIMBER TRADES JOURNAL", "JOURNAL", "IMPORTS", "EXPORTS", "FREIGHTS", "FAILURES", "LIQUIDATIONS", "DIVIDENDS"]
COMMODITIES_AS_PORTS = ["deals", "timber", "staves", "lathwood", "pitwood", "props", "battens", "boards"]
COMMODITY_PLACEHOLDERS = ["order", "nil", "ditto", "do.", "do"]
MERCHANT_PLACEHOLDERS = ["order", "nil", "ditto", "---"]
MERCHANT_ENDS = ["& co", "& son", "& sons", "& atkinson", "& sim", "& wood"]
COMMODITY_KEYWORDS = ["deals", "timber", "boards", "battens", "staves", "mahogany", "cedar", "oak", "pine", "firewood", "laths", "planks"]
COMMODITY_WORDS = ["deals", "timber", "boards", "staves", "battens", "planks", "logs"]
# Commodities that are none (fragments, units), and single forms with what they are merged into.
NO_COMMODITIES = [
    "w", "sq", "p", "i", "pp", "ft", "o", "s", "r", "&c", "a", "m", "b", "wo", "ww", "d", "f",
    "lds", "pcs", "tons", "loads", "bdls", "square", "pieces", "cords", "fathoms", "bundles", "cubic", "ft", "standards",
]
MERGED_COMMODITIES = {
    "deal": "deals", "stave": "staves", "prop": "props", "batten": "battens", "board": "boards", "sleeper": "sleepers", "log": "logs", "hoop": "hoops",
    "end": "ends", "lath": "laths", "scantling": "scantlings", "spar": "spars", "plank": "planks", "flooring": "floorings", "square": "squares",
}
PROVINCES = r", (?:N[.]\s?B|N[.]\s?S|P[.]\s?E[.]\s?I|P[.]\s?Q)[.]$"


def first_case(pairs: list[tuple[Column, object]], rest: object) -> Column:
    """One CASE: the value of the first condition that holds."""
    out = None
    for test, value in pairs:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(test, value) if out is None else out.when(test, value)
    rest = rest if isinstance(rest, Column) else F.lit(rest)
    return rest if out is None else out.otherwise(rest)


def let(value: Column, body) -> Column:
    """``body(value)``, for a value that is dear and used more than once: it is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def has_any(c: Column, parts) -> Column:
    return reduce(lambda a, b: a | b, (F.contains(c, F.lit(p)) for p in parts))


def strip(c: Column) -> Column:
    """Without any white space at the ends (``trim`` takes spaces only)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def low(c: Column) -> Column:
    return F.lower(strip(c))


def squeeze(c: Column) -> Column:
    """White space runs, no-break spaces included, as one space; none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)[\s\x{a0}]+", " "))


def fix_encoding(c: Column) -> Column:
    """Repairs double-encoded text: whole names first, else single letters."""
    letters = reduce(lambda s, kv: F.replace(s, F.lit(kv[0]), F.lit(kv[1])), MOJIBAKE_LETTERS.items(), c)
    return first_case([(c == k, v) for k, v in MOJIBAKE_NAMES.items()], letters)


def is_port_header(line: Column) -> Column:
    return line.rlike(r"^[A-Z\s&.'()]+\.\s*$")


# The forms of date headers and record lines.
DATE_HEADER = r"^(\w{3,9})\.?\s+(\d{1,2})\.?\s*$"
EARLY = r"(?i)^(?:(\w{3,9})\.?\s+(\d{1,2})\.?\s+)?([A-Za-z\s.&'-]+?)\s*(?:\(s\))?\s*@\s*([A-Za-z\s.,&-]+?),?\s*(?=[—\d])(.*?)$"
STANDARD = r"(?i)^(?:(\w{3,9})\.\s+)?(\d{1,2})\s+([A-Za-z\s.&'-]+?)\s*(?:\(s\))?\s*-\s*([A-Za-z\s.,'-]+?)\s*-\s*([^-]+?)\s*-\s*(.+?)$"
CONDENSED = r"(?i)^([A-Z][A-Za-z\s.&'-]+?)\s*(?:\(s\))?\s*-\s*([A-Za-z\s.,'-]+?)\s*-\s*([^-]+?)\s*-\s*(.+?)$"


def part(c: Column, pattern: str, group: int) -> Column:
    """A group of the first match; null if there is none or it is empty."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def parse_record(line: Column) -> Column:
    """A record line as a struct: format_type, month, day, ship_name, is_steamship, origin_port, cargo, merchant.

    The first format that fits holds: early_at (has an @), standard_dash (a day first, with or without its month), condensed. Null
    format_type if none does.
    """
    early = F.contains(line, F.lit("@")) & line.rlike(EARLY)
    standard = line.rlike(r"^(?:\w+\.\s+)?\d{1,2}\s+") & line.rlike(STANDARD)
    condensed = F.contains(line, F.lit("-")) & line.rlike(CONDENSED)
    # All groups by one match: no group but the last can hold the mark. Early lines have their cargo last, others their merchant.
    mark = "\x1f-\x1f"
    found = lambda kind, pattern, *groups: F.concat(F.array(F.lit(kind)), F.split(F.regexp_replace(line, pattern + "(?s:.*)", mark.join(groups)), mark, 6))
    fields = F.when(early, found("early_at", EARLY, "$1", "$2", "$3", "$4", "", "$5")).when(standard, found("standard_dash", STANDARD, "$1", "$2", "$3", "$4", "$5", "$6"))
    fields = fields.when(condensed, found("condensed", CONDENSED, "", "", "$1", "$2", "$3", "$4"))

    def record(f: Column) -> Column:
        field = lambda i: F.nullif(F.get(f, i), F.lit(""))
        clean = lambda c: F.trim(F.replace(c, F.lit("(s)"), F.lit("")))
        return F.struct(
            F.get(f, 0).alias("format_type"),
            field(1).alias("month"),
            F.try_to_number(field(2), F.lit("99")).cast("int").alias("day"),
            clean(field(3)).alias("ship_name"),
            F.contains(line, F.lit("(s)")).alias("is_steamship"),
            F.trim(field(4)).alias("origin_port"),
            F.trim(F.when(F.get(f, 0) == "early_at", field(6)).otherwise(field(5))).alias("cargo"),
            F.trim(F.when(F.get(f, 0) != "early_at", field(6))).alias("merchant"),
        )

    return let(fields, record)


def confidence(own_place: Column, own_date: Column) -> Column:
    """1.0 with the place from the lines just before, 0.9 from the carried context with a date, else 0.7."""
    return F.when(own_place, F.lit(1.0)).when(own_date, F.lit(0.9)).otherwise(F.lit(0.7))


def normalize_merchant(c: Column) -> Column:
    """'' for null, blank and placeholders; & written out, trailing periods off, then Co. and Bros. expanded."""
    s = strip(c)
    bare = F.regexp_replace(s, r"\.+$", "")
    full = F.replace(F.replace(F.replace(bare, F.lit("&"), F.lit("and")), F.lit(" Co."), F.lit(" Company")), F.lit(" Bros."), F.lit(" Brothers"))
    return F.coalesce(F.when(F.lower(s).isin(MERCHANT_PLACEHOLDERS), "").otherwise(full), F.lit(""))


def normalize_commodity(c: Column) -> Column:
    """The name of the first rule that fits, else the value in lower case; '' for null and blank."""
    s = F.lower(strip(c))
    return F.coalesce(first_case([(s.rlike(p), v) for p, v in COMMODITY_RULES], s), F.lit(""))


def recommended_commodity(c: Column) -> Column:
    """The recommended form of a commodity: '' for fragments and units, the merged form of single ones (which goes first), else the value itself."""
    s = low(c)
    merged = F.create_map(*(F.lit(x) for pair in MERGED_COMMODITIES.items() for x in pair))
    return F.coalesce(F.try_element_at(merged, s), F.when(s.isin(NO_COMMODITIES), F.lit("")), c)


def normalize_port(c: Column, canonical: Column) -> Column:
    """``canonical`` (the exact hit, null if none), else the abbreviation's or family's port, else the value itself; '' for blank."""
    s = strip(c)
    low = F.lower(s)
    tests: list[tuple[Column, object]] = [(canonical.isNotNull(), canonical)] + [(low == k.lower(), v) for k, v in PORT_ABBREVIATIONS.items()]
    for stems, members, rest in PORT_FAMILIES:
        tests += [(has_any(low, stems) & has_any(low, parts), name) for parts, name in members] + [(has_any(low, stems), rest)]
    return F.coalesce(first_case(tests, s), F.lit(""))


def is_port_error(c: Column, port_type: str) -> Column:
    """Blank, too short or long, a placeholder, a journal's heading; for origins a commodity, too."""
    s = strip(c)
    short = (F.length(s) <= 2) & ~s.isin("Mo", "Mo.")
    bad = (s == "") | short | s.isin(NON_VALUES) | (F.length(s) > 150) | has_any(F.upper(s), JOURNAL_MARKS)
    if port_type == "origin":
        bad = bad | F.lower(s).isin(COMMODITIES_AS_PORTS)
    return F.coalesce(bad, F.lit(True))


def consolidate_dock(c: Column) -> Column:
    """London without its dock; for buoys, wharves and stairs the first word of several."""
    low, words = F.lower(c), F.split(strip(c), r"\s+")
    return first_case([(c.startswith("London (") & c.endswith(")"), "London"), (has_any(low, ["buoy", "wharf", "stairs"]) & (F.size(words) >= 2), F.get(words, 0))], c)


def number_forms(c: Column) -> Column:
    s = F.lower(strip(c))
    return first_case([(s == "lath", "laths"), (s == "flooring", "floorings")], c)


def fix_artifacts(c: Column) -> Column:
    """Without & and &c at the end; '' for what is a merchant's name or only an artifact."""
    s = F.trim(F.regexp_replace(c, "&+$", ""))
    s = F.when(s.endswith("&c"), F.trim(F.regexp_replace(s, "&c$", ""))).otherwise(s)
    merchant = reduce(lambda a, b: a | b, (s.endswith(e) for e in MERCHANT_ENDS))
    return F.when(s.isin("&", "& co", "&c") | merchant | s.startswith("&"), "").otherwise(s)


def dashes(c: Column) -> Column:
    """Every kind of dash as a spaced em dash."""
    return F.regexp_replace(F.regexp_replace(c, "–|--", "—"), r"\s*—\s*", " — ")


def notes(c: Column) -> Column:
    """What stands in parentheses, joined by '; ', without marks of one letter; null if nothing does."""
    inner = F.transform(F.regexp_extract_all(c, F.lit(r"\(([^)]*)\)"), F.lit(1)), lambda x: F.trim(x))
    return F.nullif(F.array_join(F.filter(inner, lambda x: F.length(x) > 1), "; "), F.lit(""))


def without_notes(c: Column) -> Column:
    return squeeze(F.regexp_replace(c, r"\([^)]*\)", ""))


def dash_parts(c: Column) -> Column:
    return F.filter(F.transform(F.split(c, r"\s*(?:—|–|\s-\s|-{2,})\s*"), squeeze), lambda x: x != "")


# The words of quantities.
QUANTITY = r"(?i)\b(?:\d+[\d,.]*|n\.?s\.?|pcs?\.?|loads?\.?|bdft|ft\.?|in\.?|cwt\.?|tons?\.?|bales?\.?|pkgs?\.?|cases?\.?|boxes?\.?)\b"


def strip_quantities(c: Column) -> Column:
    t = F.regexp_replace(c, QUANTITY, " ")
    t = F.regexp_replace(F.regexp_replace(t, r"\s+,", ","), r",\s*,", ", ")
    return F.trim(F.regexp_replace(F.regexp_replace(t, r"\s+", " "), r"^[ ;,:]+|[ ;,:]+$", ""))


def product_types(c: Column, vocabulary: list[str]) -> Column:
    """The vocabulary's entries that stand in the text as whole words, longest first."""
    s = F.lower(c)
    ordered = sorted(vocabulary, key=lambda v: (-len(v), v))
    return F.array_compact(F.array(*(F.when(s.rlike(rf"(?<![a-z])\Q{v}\E(?![a-z])"), F.lit(v)) for v in ordered)))


def tagged_products(c: Column, vocabulary: list[str]) -> Column:
    """``product_types`` with what lists of deals and ends mean: such redwood is deals, deal ends and redwood, and ends of deals are deal ends."""
    s = F.replace(F.lower(c), F.lit("deaks"), F.lit("deals"))
    ends = s.rlike(r"\bends\b")
    redwood = F.contains(s, F.lit("redwood")) & ends & F.contains(s, F.lit("deal"))
    first = F.when(redwood, F.array(F.lit("deals"), F.lit("deal ends"), F.lit("redwood"))).otherwise(F.array().cast("array<string>"))
    last = F.when(ends & s.rlike(r"\bdeals?\b"), F.array(F.lit("deal ends"))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(first, product_types(s, vocabulary), last))


def product_tokens(c: Column) -> Column:
    """Products between commas, semicolons, slashes, ampersands and the words and / et."""
    t = F.regexp_replace(F.regexp_replace(c, "[/;]", ","), "&", " and ")
    parts = F.split(F.regexp_replace(t, r"(?i)\b(?:et|and)\b", ","), ",")
    return F.filter(F.transform(parts, squeeze), lambda x: x != "")


def split_merchant(c: Column) -> Column:
    """(products, merchant): the last comma part if it looks like a merchant."""
    parts = F.filter(F.transform(F.split(squeeze(c), ","), lambda x: F.trim(x)), lambda x: x != "")
    last = F.try_element_at(parts, F.lit(-1))
    name = last.rlike(r"^[A-Z][A-Za-z.'’&-]+(?:\s+[A-Z][A-Za-z.'’&-]+){0,4}$")
    is_merchant = (F.lower(last) == "order") | name | last.rlike(r"(?i)\b(?:co|sons?|bros?|brothers|ltd|limited)\b")
    return F.struct(
        F.when(is_merchant, F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), ", ")).otherwise(squeeze(c)).alias("products"),
        F.when(is_merchant, last).alias("merchant"),
    )


def split_for(c: Column) -> Column:
    """(products, merchant) at the first semicolon, if what follows says for or to."""
    after = F.regexp_extract(c, r"^[^;]*;(.*)$", 1)
    found = after.rlike(r"(?i)\b(?:for|to)\b")
    return F.struct(F.when(found, F.trim(F.substring_index(c, ";", 1))).otherwise(c).alias("products"), F.when(found, squeeze(after)).alias("merchant"))


def without_province(c: Column) -> Column:
    return F.regexp_replace(c, PROVINCES, "")
