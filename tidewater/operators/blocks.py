"""Blocks of import records in mixed text, entries of running text, and frequency-ordered vocabularies."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions import text as T
from tidewater.operators import context as C

# Headings that stand where a port's would, tested by equality if they are short, else as parts.
SKIP_HEADERS = [
    "TIMBER TRADES JOURNAL", "TIMBER TRADES' JOURNAL", "ADES JOURNAL", "ENGLAND AND WALES", "SCOTLAND", "IRELAND", "SCOTCH SUPPLEMENT",
    "IMPORTS", "REVIEWS", "FREIGHTS", "FAILURES AND ARRANGEMENTS", "LIQUIDATIONS", "ERRATUM", "TRADE ITEMS", "CREDITOR PARTLY SECURED",
    "ACCEPTED TENDERS", "LONDON DOCK DELIVERIES", "ARRIVALS",
    "PINE", "SPRUCE", "PITCH PINE", "OAK", "OAK TIMBER", "MAHOGANY", "ASH", "LATHWOOD", "WEATHERBOARDS", "SLATING BATTENS", "MOULDING",
    "MOULDINGS", "VENEERS", "SLAB BOARDS", "POLES", "SPARS", "DECK DEALS", "LATHS", "PLASTERERS' LATHS", "BEAD", "TORUS SKIRTING", "DEAL",
    "ERABLE", "HEWN BALK", "AHOGANY",
    "CONTRACTS OPEN", "TRADE MARK", "ILLUSTRATED CATALOGUES FREE ON APPLICATION", "POST FREE ON APPLICATION",
    "EXPORT ORDERS PROMPTLY EXECUTED", "WRITE FOR CATALOGUE", "DETAILED SPECIFICATION ON APPLICATION",
    "COUNTRY ORDERS RECEIVE PROMPT ATTENTION", "SEND FOR REFERENCES TO USERS", "REGISTERED BRAND", "SILVER MEDAL", "CIRCULAR SAWS",
    "IN THE WORLD", "SPECIFICATIONS OF THE FOLLOWING HAVE BEEN PUBLISHED", "EVERY DESCRIPTION OF BALTIC AND AMERICAN TIMBER",
    "VENEERS OF ALL KINDS", "AND ALL VARIETIES OF FANCY WOODS", "EVERY DESCRIPTION OF WOOD ALWAYS IN STOCK",
    "PREPARED FROM THE DIMENSIONS STATED", "EXPORTERS AMERICAN HARDWOOD LUMBER", "AUSTRALIAN TIMBER TRADE", "TIMBER FROM CORSICA",
    "SEEDLING AND TRANSPLANTED FOREST TREES", "HORTICULTURAL TIMBER MERCHANT", "THE STANDARD TIMBER MEASURER",
    "GANDY'S PATENT COTTON BELTING", "THE GANDY BELT",
    "MAURICE GANDY", "THOMAS ROEBUCK & COMPANY (LIMITED)", "JOSEPH GARDNER & SONS", "ROBERT PARKER & CO", "LAVY BROS",
    "AT NEW ORLEANS", "THE MISSISSIPPI VALLEY", "THE HAWAIIAN ISLANDS", "BRANCH YARD AT NEWBURGH", "AT THE MILLWALL DOCKS", "AT AVONMOUTH",
    "BY SURREY COMMERCIAL DOCKS",
    "R. M", "R & CO", "H", "A", "ONE", "EST", "TONE", "BURGH", "J. H. ROW... AU", "B. & F. S. WHARF", "B. & F. WHARF", "Y COMMERCIAL DOCKS",
    "COLUMBIA", "MILWALL",
]
HEADER_STARTS = ["imports of timber", "london.", *(f"{m.lower()} " for m in T.MONTHS.values())]
# Patterns of record lines and of what ends a block.
_RECORD = [r"^(?:\w+\.\s+)?\d{1,2}\s+\w+.*-.*-", r"^\w+[\s(].*-.*-.*-", r"^\d{1,5}\s+(?:pcs\.|lds\.|deals|timber|boards)"]
_OPENS = r"(?i)^Imports? of Timber|^IMPORTS\.?$|^Timber Imports"
# Any ten letters and spaces with a period end a list, whatever their case.
_ENDS = r"(?i)^THE\s+\w+\s+TRADE|^\(From\s+our\s+own\s+Correspondent|^[A-Z\s]{10,}\.$|^MARKET\s+REPORTS|^PRICES\s+CURRENT"
_PORT = r"^[A-Z\s&.'()]+\.$"


def skipped(header: Column, skip: list[str] = SKIP_HEADERS) -> Column:
    """Whether a heading is none of a port: entries of up to 4 letters must be equal, longer ones may be a part."""
    up = F.upper(F.regexp_replace(T.strip(header), r"\.$", ""))
    return T.has_any(up, [s for s in skip if len(s) > 4]) | up.isin([s for s in skip if len(s) <= 4])


def heads_lines(line: Column) -> Column:
    """Blank lines, summaries and the headings of a list."""
    s = F.regexp_replace(F.lower(T.strip(line)), r"[.:;]+$", "")
    starts = F.lit(False)
    for h in HEADER_STARTS:
        starts = starts | s.startswith(h)
    return (s == "") | s.rlike(r"^(?:in all|sundry imports)\b") | starts


def is_import_record(line: Column) -> Column:
    s = T.strip(line)
    found = F.contains(s, F.lit("@"))
    for p in _RECORD:
        found = found | s.rlike(p)
    return (F.length(s) >= 10) & found


def line_kinds(line: Column) -> Column:
    """What a line is to a list of imports: header (opens one), end, record (port headings too), blank or other."""
    s = T.strip(line)
    port = s.rlike(_PORT) & (F.length(F.regexp_replace(s, r"[.\s]+$", "")) > 3)
    return F.when(s.rlike(_OPENS), "header").when(s.rlike(_ENDS), "end").when(is_import_record(s) | port, "record").when(s == "", "blank").otherwise("other")


def import_blocks(lines: DataFrame, doc: str, order: str, line: str = "line", tolerated: int = 3, least: int = 6) -> DataFrame:
    """(doc, first, last, n): lists of imports; ``order`` is an integer without ties within a document, null lines are blank.

    A list begins with its heading and ends before the next one, at a line that ends it, with the ``tolerated`` + 1st other line in a row, or with the
    document. ``n`` lines are in it, ``tolerated`` other ones at its end included; there ``last`` is that many lines before the
    one that ended it. Lists of fewer than ``least`` lines are left out, but for those that the next heading ends.

    From one heading to the next, a list ends at the first line that can end it, so that lists are minima over sections; lines in a row are told by
    the last line that isn't an other one. Both are carried over ranges of lines: a document may have any number of them.
    """
    flat = lines.select(F.col(doc).cast("long").alias("doc"), F.col(order).cast("long").alias("n"), line_kinds(F.coalesce(F.col(line), F.lit(""))).alias("kind"))
    placed = C.place_within(flat, ["doc"], "n", "i")
    i, kind = F.col("i"), F.col("kind")
    filled = C.fill_by_ranges(placed, ["doc"], "i", {"begin": F.when(kind == "header", i), "solid": F.when(kind != "other", i)}).filter("begin is not null")
    sections = filled.groupBy("doc", "begin").agg(
        F.min("n").alias("first"), F.max("i").alias("end"), F.min(F.when(kind == "end", i)).alias("closed"), F.min(F.when((kind == "other") & (i - F.col("solid") > tolerated), i)).alias("drowned")
    )
    ends = placed.groupBy(F.col("doc").alias("own")).agg(F.max("i").alias("last_i"))
    at = F.least("closed", "drowned")  # the other one if one is null
    sections = sections.join(ends, F.col("doc").eqNullSafe(F.col("own"))).withColumn("at", at).withColumn("n", F.coalesce("at", F.col("end") + 1) - F.col("begin"))
    kept = sections.filter((F.col("at").isNull() & (F.col("end") < F.col("last_i"))) | (F.col("n") >= least))
    drowned = F.col("at").eqNullSafe(F.col("drowned")) & F.col("at").isNotNull()
    last_i = F.when(drowned, F.col("at") - tolerated).otherwise(F.col("begin") + F.col("n") - 1)
    kept = kept.select("own", "first", last_i.alias("last_place"), F.col("n").alias("size"))
    found = kept.join(placed.select("doc", "i", F.col("n").alias("last")), F.col("own").eqNullSafe(F.col("doc")) & (F.col("i") == F.col("last_place")))
    return found.select("doc", "first", "last", F.col("size").alias("n"))


# A date that heads entries, and an entry: after a period or at the start, up to the next entry or date.
_DATE = "(?:" + "|".join(T.MONTHS.values()) + r")\s+\d{1,2}(?:st|nd|rd|th)\."
_SHIP = r"[A-Z][^@.\n—]{0,80}?\s*(?:\(s\))?\s*@"
_LABEL = re.compile(rf"\b{_DATE}")
_ENTRY = re.compile(rf"(?:^|[.]\s+)([A-Z][^@.\n—]{{0,80}}?)\s*(\(s\))?\s*@\s*([^.\n—]+)\.\s*—\s*(.*?)(?=[.]\s+(?:{_SHIP}|{_DATE})|$)", re.S)


def nearest_before(places: list[int], labelled: list[int]) -> list[int | None]:
    """For each of the sorted ``places`` the index of the last of the sorted ``labelled`` places that isn't behind it; one pass over both."""
    out, k = [], -1
    for p in places:
        while k + 1 < len(labelled) and labelled[k + 1] <= p:
            k += 1
        out.append(k if k >= 0 else None)
    return out


def entries(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, place, date_label, ship_name, is_steamship, origin_port, body) of ``Ship (s) @ Port. — body`` entries in running text.

    ``date_label`` is the nearest ``Month 3rd`` at or before an entry's beginning, without its period; null if there is none. Null texts have no entries.
    """

    def find(batches):
        for b in batches:
            rows = []
            for k, t in zip(b[key], b[text]):
                found, dates = list(_ENTRY.finditer(t or "")), list(_LABEL.finditer(t or ""))
                labels = [" ".join(m.group().rstrip(".").split()) for m in dates]
                for m, at in zip(found, nearest_before([m.start() for m in found], [m.start() for m in dates])):
                    rows.append((k, m.start(1), None if at is None else labels[at], m.group(1).strip(), bool(m.group(2)), m.group(3).strip(), m.group(4).strip()))
            yield pd.DataFrame(rows, columns=[key, "place", "date_label", "ship_name", "is_steamship", "origin_port", "body"])

    kind = texts.schema[key].dataType.simpleString()
    return texts.select(key, text).mapInPandas(find, f"{key} {kind}, place int, date_label string, ship_name string, is_steamship boolean, origin_port string, body string")


def parse_lines(lines: DataFrame, line: str, ports: list[str], vocabulary: list[str]) -> DataFrame:
    """``lines`` with a struct ``parsed`` of each line of the form place - port - products; other lines and headings are left out.

    Fields: date_iso, arrival_place_raw, departure_port_raw, departure_port_std (the listed port, without case, else null),
    product_type_list, product_list_raw, merchants_raw, notes, and warnings: unknown_port, ambiguous_products.
    """
    raw = T.squeeze(F.col(line))
    body = T.squeeze(T.without_notes(raw))
    dated = r"^(\d{4})-(\d{2})-(\d{2})"
    parts = T.dash_parts(F.regexp_replace(F.regexp_replace(body, dated, ""), r"^[ \-—:]+", ""))
    known = F.create_map(*(F.lit(v) for p in ports for v in (p.lower(), p))) if ports else None
    port, tail = F.get(parts, 1), F.coalesce(F.get(parts, 2), F.lit(""))
    split = T.split_for(tail)
    products = T.strip_quantities(split["products"])
    standard = F.try_element_at(known, F.lower(port)) if ports else F.lit(None).cast("string")
    kinds = T.tagged_products(products, vocabulary)
    warnings = F.array_compact(F.array(F.when(standard.isNull(), "unknown_port"), F.when(F.size(kinds) == 0, "ambiguous_products")))
    fields = {
        "date_iso": F.nullif(F.regexp_extract(body, dated, 0), F.lit("")), "arrival_place_raw": F.get(parts, 0), "departure_port_raw": port, "departure_port_std": standard,
        "product_type_list": kinds, "product_list_raw": products, "merchants_raw": split["merchant"], "notes": F.nullif(T.notes(raw), F.lit("")), "warnings": warnings,
    }
    parsed = F.struct(*(c.alias(n) for n, c in fields.items()))
    return lines.filter((raw != "") & ~heads_lines(raw) & (F.size(parts) >= 2)).withColumn("parsed", parsed)


def triage(parsed: DataFrame) -> DataFrame:
    """Parsed lines with warnings."""
    return parsed.filter(F.size("parsed.warnings") > 0)
