"""The two earlier readings of record lines: dated lines with a merchant under their port's header, and lines of three formats whose month lasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions import text as T
from tidewater.operators.context import forward_fill

# Headers, records and goods as the earlier readers knew them. Only a line feed ends a line; white space is Unicode's.
_HEADER = r"(?dU)^([A-Z\s&.']+)\.$"
_DATED = r"(?dU)^(\d{1,2})\s+([A-Za-z\s.&'-]+?)(?:\s*\(s\))?\s*-\s*([A-Za-z\s.,-]+?)\s*-\s*(.*?)\s*-\s*([A-Za-z\s.,&;-]+?)$"
_GOODS = r"(?idU)(\d{1,3}(?:,\d{3})*)\s+([a-z.]+)\s+([a-z\s.]+?)(?:,|;|$|\s*-)"
_EARLY = r"(?idU)^(?:(\w{3,4})\.\s+)?(?:(\d{1,2})\s+)?([A-Za-z\s.&'-]+?)\s*(?:\(s\))?\s*@\s*([A-Za-z\s.,&-]+?)\s*[,.—]\s*(.*?)$"
_STANDARD = r"(?idU)^(?:(\w{3,4})\.\s+)?(\d{1,2})\s+([A-Za-z\s.&'-]+?)\s*(?:\(s\))?\s*-\s*([A-Za-z\s.,'-]+?)\s*-\s*([^-]+?)\s*-\s*(.+?)$"
_CONDENSED = r"(?idU)^([A-Z][A-Za-z\s.&'-]+?)\s*(?:\(s\))?\s*-\s*([A-Za-z\s.,'-]+?)\s*-\s*([^-]+?)\s*-\s*(.+?)$"

ITEMS = "array<struct<quantity:bigint,unit:string,type:string>>"
_STEAM = "(s)"


def _ship(name: Column) -> Column:
    return T.strip(F.replace(name, F.lit(_STEAM), F.lit("")))


def _day(digits: Column) -> Column:
    return F.nullif(digits, F.lit("")).try_cast("int")


def goods(cargo: Column) -> Column:
    """Quantity, unit and type of all goods of a cargo string, in order (ITEMS); none for null.

    A quantity is the last group of up to three digits with those its commas join on; the type ends at a comma,
    a semicolon, a dash or the end.
    """
    found = F.arrays_zip(*(F.regexp_extract_all(cargo, F.lit(_GOODS), F.lit(i)) for i in (1, 2, 3)))
    item = lambda m: F.struct(F.replace(m["0"], F.lit(","), F.lit("")).try_cast("bigint").alias("quantity"), F.regexp_replace(m["1"], r"\.+$", "").alias("unit"), T.strip(m["2"]).alias("type"))
    return F.coalesce(F.transform(found, item).cast(ITEMS), F.array().cast(ITEMS))


def dated_record(line: Column) -> Column:
    """A line that starts with a day and ends with a merchant, as a struct; null for any other line.

    The merchant takes all dashes that no digit follows any more: of ``4 lds. pit-props-Order`` it is ``props-Order``.
    """
    s = T.strip(line)
    got = lambda i: F.regexp_extract(s, _DATED, i)
    fields = {"day": _day(got(1)), "ship_name": _ship(got(2)), "is_steamship": F.contains(line, F.lit(_STEAM)), "origin_port": T.strip(got(3)), "cargo": T.strip(got(4)), "merchant": T.strip(got(5)), "raw_line": s}
    return F.when(s.rlike(_DATED), F.struct(*(c.alias(k) for k, c in fields.items())))


def dated_records(lines: DataFrame, keys: list[str], order: list[str], year: Column, month: Column, line: str = "line") -> DataFrame:
    """(keys, order, port, arrival_date, record fields, cargo_items): the dated records that stand under a header, within ``keys``.

    ``arrival_date`` is an ISO date if ``month`` is the full name of one that has this day, else year, month and day as
    they are, joined by dashes (null if one is null). Lines before the first header give nothing.
    """
    s = T.strip(F.col(line))
    x = lines.select(*keys, *order, F.when(s.rlike(_HEADER), F.regexp_replace(s, r"\.+$", "")).alias("port"), dated_record(F.col(line)).alias("record"), year.cast("string").alias("year"), month.alias("month"))
    x = x.withColumn("port", forward_fill(F.col("port"), keys, order)).filter("record is not null and port is not null")
    day = F.col("record.day").cast("string")
    date = F.try_to_timestamp(F.concat_ws("-", "year", F.initcap("month"), F.lpad(day, 2, "0")), F.lit("yyyy-MMMM-dd"))
    written = F.concat(F.col("year"), F.lit("-"), F.col("month"), F.lit("-"), F.regexp_extract(F.col("record.raw_line"), r"(?U)^\d+", 0))
    return x.select(*keys, *order, "port", F.coalesce(F.date_format(date, "yyyy-MM-dd"), written).alias("arrival_date"), "record.*", goods(F.col("record.cargo")).alias("cargo_items"))


def line_record(line: Column) -> Column:
    """A record line as a struct, by the first format that fits: early_at, standard_dash, condensed; null for headers and other lines.

    Early lines have no merchant, and their place ends at its first comma, period or em dash (``St. John`` is ``St``); condensed ones have no day; ``month`` is null where the line has none of its own.
    """
    s, none = T.strip(line), F.lit(None).cast("string")

    def of(name: str, pattern: str, month: int, day: int, first: int, merchant: bool) -> Column:
        got = lambda i: F.regexp_extract(s, pattern, i) if i else none
        fields = {"format_type": F.lit(name), "month": F.nullif(got(month), F.lit("")), "day": _day(got(day)), "ship_name": _ship(got(first)), "is_steamship": F.contains(s, F.lit(_STEAM))}
        fields |= {"origin_port": T.strip(got(first + 1)), "cargo": T.strip(got(first + 2)), "merchant": T.strip(got(first + 3)) if merchant else none}
        return F.struct(*(c.alias(k) for k, c in fields.items()))

    record = F.when(s.rlike(_EARLY), of("early_at", _EARLY, 1, 2, 3, False)).when(s.rlike(_STANDARD), of("standard_dash", _STANDARD, 1, 2, 3, True))
    return F.when(~T.is_port_header(s), record.when(s.rlike(_CONDENSED), of("condensed", _CONDENSED, 0, 0, 1, True)))


def line_records(lines: DataFrame, keys: list[str], order: list[str], line: str = "line") -> DataFrame:
    """(keys, order, destination_port, record fields): all record lines; a header's port and a record's own month last, within ``keys``.

    Records before the first header have a null port, those before the first month of a record a null month.
    """
    s = T.strip(F.col(line))
    x = lines.select(*keys, *order, F.when(T.is_port_header(s), F.regexp_replace(s, r"\.+\s*$", "")).alias("destination_port"), line_record(F.col(line)).alias("record"))
    month = forward_fill(F.col("record.month"), keys, order)
    x = x.withColumns({"destination_port": forward_fill(F.col("destination_port"), keys, order), "record": F.when(F.col("record").isNotNull(), F.col("record").withField("month", month))})
    return x.filter("record is not null").select(*keys, *order, "destination_port", "record.*")
