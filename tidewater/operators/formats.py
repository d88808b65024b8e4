"""What a page's text looks like: signals of its format, its class by year or by signals, and the classes of a year's pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions import text as T

# The signs of formats.
_HEADERS = r"(?md)^([A-Z\s&.'()]+)\.\s*$"
_SAMPLE = r"^(?:\w+\.\s+)?\d{1,2}\s+\w+.*[@—]"
_DOCKS_SEEN = r"SURREY COMMERCIAL DOCKS|MILLWALL DOCKS|TILBURY"
DOCKS = [
    "SURREY COMMERCIAL DOCKS", "MILLWALL DOCKS", "ROYAL ALBERT DOCKS", "VICTORIA DOCKS", "TILBURY DOCKS", "WEST INDIA DOCKS", "REGENT'S CANAL DOCK",
    "SHADWELL BASIN", "BREWER'S QUAY", "BURT'S WHARF", "GALLEON'S BUOYS", "HANOVER HOLE", "PRINCE REGENT'S WHARF", "OTHER DOCKS AND WHARVES",
]
#: Lines of a text that samples are taken from, samples, letters of each, and headers shown.
SAMPLE_LINES, SAMPLES, SAMPLE_LETTERS, HEADERS_SHOWN = 200, 5, 150, 10


def signals(text: Column) -> dict[str, Column]:
    """The signals of a text by name: flags, counts, the first port headers and sample records; nothing is found in a null text.

    ``port_headers`` holds the first 10 of ``port_header_count`` runs of lines in capitals that end with a period; ``sample_records`` up to five lines, among
    the first 200, that begin with a date and have an @ or a dash.
    """
    s = F.coalesce(text, F.lit(""))
    headers = F.regexp_extract_all(s, F.lit(_HEADERS), F.lit(1))
    lines = F.transform(F.slice(F.split(s, "\n"), 1, SAMPLE_LINES), T.strip)
    return {
        "has_import_header": s.rlike(r"(?i)Imports? of Timber"),
        "has_imports_caps": s.rlike(r"(?md)^IMPORTS\.?\s*$"),
        "uses_at_delimiter": F.contains(s, F.lit("@")),
        "uses_dash_delimiter": s.rlike(r"\s+-\s+"),
        "at_count": F.regexp_count(s, F.lit("@")),
        "port_headers": F.slice(headers, 1, HEADERS_SHOWN),
        "port_header_count": F.size(headers),
        "has_date_prefix": s.rlike(r"(?md)^\w{3,4}\.\s+\d{1,2}\s+"),
        "has_numeric_date": s.rlike(r"(?md)^\d{1,2}\s+[A-Z]"),
        "has_steamship_marker": F.contains(s, F.lit("(s)")),
        "has_dock_subdivisions": s.rlike(_DOCKS_SEEN),
        "has_compressed_format": s.rlike(r"—\w+[-,]\w+"),
        "sample_records": F.transform(F.slice(F.filter(lines, lambda x: x.rlike(_SAMPLE)), 1, SAMPLES), lambda x: F.left(x, F.lit(SAMPLE_LETTERS))),
    }


def format_of(text: Column, year: Column) -> Column:
    """early_at, transition, standard_dash or late_dock: by the year if it is known (neither null nor 0), else by what delimits records; unknown without either."""
    s = F.coalesce(text, F.lit(""))
    at, dash = F.regexp_count(s, F.lit("@")), F.regexp_count(s, F.lit(r"\s+-\s+"))
    known = year.isNotNull() & (year != 0)
    return (
        F.when(known & (year <= 1878), "early_at").when(known & (year <= 1880), "transition").when(known & (year <= 1884), "standard_dash").when(known, "late_dock")
        .when(at > dash, "early_at").when(T.has_any(s, DOCKS), "late_dock").when(s.rlike("-[A-Z]"), "standard_dash").when((at > 0) & (dash > 0), "transition").otherwise("unknown")
    )


def formats_by_year(pages: DataFrame, year: str, text: str) -> DataFrame:
    """(year, pages, at_pages, dash_pages, dock_pages, format): what most pages of a year are delimited by; null years are one."""
    found = signals(F.col(text))
    count = lambda n: F.count_if(found[n])
    sums = pages.groupBy(F.col(year).alias("year")).agg(
        F.count("*").alias("pages"), count("uses_at_delimiter").alias("at_pages"), count("uses_dash_delimiter").alias("dash_pages"), count("has_dock_subdivisions").alias("dock_pages")
    )
    base = F.when(F.col("at_pages") > F.col("dash_pages"), "AT-DELIMITER").when(F.col("dash_pages") > 0, "DASH-DELIMITER").otherwise("MIXED")
    return sums.withColumn("format", F.concat(base, F.when(F.col("dock_pages") > 0, " + DOCK-SUBS").otherwise("")))
