"""Cargo strings as lists of items."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewater.functions import text as T

ITEM = "array<struct<quantity:string,unit:string,commodity:string,merchant:string,raw:string>>"
# Quantities with and without a unit; the second ends at punctuation, a digit or the end.
_WITH_UNIT = r"(?i)(\d+[,\d]*)\s+([a-z]{1,6}\.)\s+([a-z\s\-&]+)"
_BARE = r"(?i)(\d+[,\d]*)\s+([a-z][a-z\s\-&]{2,25}?)(?=,|;|\.|\d|$)"


def merchant_of(segment: Column) -> Column:
    """The capitalised name behind a comma at the end; not a placeholder, not commodities alone."""

    def checked(name: Column) -> Column:
        low = F.lower(name)
        goods = F.forall(F.split(low, r"\s+"), lambda w: w.isin(T.COMMODITY_WORDS))
        return F.when((name != "") & ~T.has_any(low, ["order", "nil", "ditto"]) & ~goods, name)

    return T.let(F.regexp_replace(F.trim(F.regexp_extract(segment, r",\s*([A-Z][A-Za-z\s.&'-]+?)$", 1)), r"\.+$", ""), checked)


def parse_cargo(cargo: Column) -> Column:
    """The items of a cargo string (ITEM): quantity, unit, commodity, merchant and the segment they stand in.

    Segments lie between semicolons. Items with a unit come first, then those without whose quantity no
    item with a unit has; a segment without quantities gives the first commodity keyword in it.
    """

    none = F.lit(None).cast("string")

    def keyword(segment: Column) -> Column:
        first = T.let(F.lower(segment), lambda low: T.first_case([(F.contains(low, F.lit(k)), k) for k in T.COMMODITY_KEYWORDS], none))
        item = lambda k: F.struct(none.alias("quantity"), none.alias("unit"), k.alias("commodity"), none.alias("merchant"), F.left(segment, F.lit(100)).alias("raw"))
        return F.transform(F.filter(F.array(first), lambda k: k.isNotNull()), item).cast(ITEM)

    def of(segment: Column) -> Column:
        # White space parts what a pattern finds: into its quantity, unit and commodity, or quantity and commodity.
        matches = lambda pattern, parts: F.transform(F.regexp_extract_all(segment, F.lit(pattern), F.lit(0)), lambda m: F.split(m, r"\s+", parts))
        seen = F.struct(merchant_of(segment).alias("merchant"), F.left(segment, F.lit(100)).alias("raw"), matches(_WITH_UNIT, 3).alias("units"), matches(_BARE, 2).alias("bare"))

        def items(s: Column) -> Column:
            number = lambda m: F.replace(m[0], F.lit(","), F.lit(""))
            item = lambda m, unit, commodity: F.struct(number(m).alias("quantity"), unit.alias("unit"), F.lower(F.trim(commodity)).alias("commodity"), s["merchant"].alias("merchant"), s["raw"].alias("raw"))
            units = F.transform(s["units"], lambda m: item(m, F.regexp_replace(F.lower(m[1]), r"\.+$", ""), m[2]))
            others = F.filter(s["bare"], lambda b: ~F.exists(s["units"], lambda u: number(u) == number(b)))
            return F.concat(units.cast(ITEM), F.transform(others, lambda m: item(m, none, m[1])).cast(ITEM))

        return T.let(T.let(seen, items), lambda found: F.when(F.size(found) > 0, found).otherwise(keyword(segment)))

    body = F.trim(F.regexp_replace(cargo, "^[—-]+", ""))
    segments = F.filter(F.transform(F.split(body, ";"), lambda s: F.trim(s)), lambda s: F.length(s) >= 5)
    return F.coalesce(F.when(F.length(cargo) >= 3, F.flatten(F.transform(segments, of))), F.array().cast(ITEM))
