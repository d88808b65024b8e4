"""Column functions for dates that come in parts, quantities and rates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import MONTHS, first_case

_YEAR = r"187[4-9]|188[0-9]|189[0-9]"
_MONTH = r"Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|Jun(?:e)?|Jul(?:y)?|Aug(?:us)?(?:t)?|Sep(?:t)?(?:ember)?|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?"


def month_name(number: Column) -> Column:
    """The month's name; null outside 1 to 12."""
    return F.get(F.array(*map(F.lit, MONTHS.values())), number - 1)


def month_number(name: Column) -> Column:
    """The number of a month's full or three-letter name; null for others."""
    return first_case([(name.isin(short, full), i) for i, (short, full) in enumerate(MONTHS.items(), 1)], F.lit(None).cast("int"))


def publication_date(file_name: Column) -> Column:
    """(year, month, day) of a file name: YYYYMMDD, else Month D YYYY, else the year alone."""
    compact = rf"({_YEAR})(\d{{2}})(\d{{2}})"
    number = F.try_to_number(F.regexp_extract(file_name, compact, 2), F.lit("99")).cast("int")
    by_number = F.coalesce(number.between(1, 12), F.lit(False))
    written = rf"(?i)({_MONTH})\w*\s+(\d{{1,2}})\s+({_YEAR})"
    by_name = file_name.rlike(written)
    short = F.initcap(F.substring(F.regexp_extract(file_name, written, 1), 1, 3))
    full = first_case([(short == s, f) for s, f in MONTHS.items()], F.lit(None).cast("string"))
    take = lambda p, g: F.nullif(F.regexp_extract(file_name, p, g), F.lit("")).cast("int")
    return F.struct(
        F.when(by_number, take(compact, 1)).when(by_name, take(written, 3)).otherwise(take(rf"({_YEAR})", 1)).alias("year"),
        F.when(by_number, month_name(number)).when(by_name, full).alias("month"),
        F.when(by_number, take(compact, 3)).when(by_name, take(written, 2)).alias("day"),
    )


def year_of(publication: Column, arrival: Column) -> Column:
    return F.coalesce(F.nullif(publication, F.lit("")), arrival).try_cast("int")


def date_text(year: Column, month: Column, day: Column) -> Column:
    """The parts that are given, joined by hyphens; the month is a name."""
    return F.concat_ws("-", *(F.nullif(c.cast("string"), F.lit("")) for c in (year, month, day)))


def _iso(year: Column, month: Column, day: Column) -> Column:
    number, date = month_number(month), day.try_cast("int")
    return F.when(F.nullif(year, F.lit("")).isNotNull(), F.concat(year, F.lit("-"), F.lpad(number.cast("string"), 2, "0"), F.lit("-"), F.lpad(date.cast("string"), 2, "0")))


def hybrid_date(arrival: tuple[Column, Column, Column], publication: tuple[Column, Column, Column]) -> Column:
    """ISO text of the arrival (year, month name, day) if complete, else of the publication, else ''."""
    return F.coalesce(_iso(*arrival), _iso(*publication), F.lit(""))


def iso_prefix(line: Column) -> Column:
    return F.nullif(F.regexp_extract(line, r"^(\d{4}-\d{2}-\d{2})\b", 1), F.lit(""))


def quantity(c: Column) -> Column:
    """The first number of a text whose commas group digits."""
    return F.nullif(F.regexp_extract(F.replace(c, F.lit(","), F.lit("")), r"(\d+(?:\.\d+)?)", 1), F.lit("")).try_cast("double")


def error_class(auto: Column, human: Column) -> Column:
    """How two quantities differ: the first class that fits."""
    ratio = F.when(human > 0, auto / F.nullif(human, F.lit(0.0))).otherwise(F.lit(999.0))
    apart = F.abs(auto - human) / F.nullif(F.greatest(auto, human), F.lit(0.0)) * 100
    return first_case(
        [
            (auto == human, "exact"),
            (F.abs(auto - human * 10) < 5, "missing_digit_human"),
            (F.abs(auto * 10 - human) < 5, "missing_digit_auto"),
            (ratio.between(9.5, 10.5), "10x_auto_high"),
            (ratio.between(0.095, 0.105), "10x_auto_low"),
            (apart <= 5, "close_5pct"),
            (apart <= 10, "close_10pct"),
            (apart <= 25, "moderate_diff"),
        ],
        "large_diff",
    )


def grade(exact_percent: Column) -> Column:
    return first_case([(exact_percent >= 35, "GOOD"), (exact_percent >= 25, "MODERATE")], "POOR")


def word_error_rate(read: Column, truth: Column) -> Column:
    """Edits of whole words over the words of ``truth``; null without any."""
    words = lambda c: F.filter(F.split(c, r"\s+"), lambda w: w != "")
    # Row by row of the table of edits: after a word of ``read``, the edits to each beginning of ``truth``.
    a, b = words(read), words(truth)

    def row(before: Column, word: Column) -> Column:
        start = F.array(F.get(before, 0) + 1)

        def step(done: Column, i: Column) -> Column:
            change = F.get(before, i) + F.when(F.get(b, i) == word, 0).otherwise(1)
            return F.concat(done, F.array(F.least(change, F.get(before, i + 1) + 1, F.element_at(done, -1) + 1)))

        return F.when(F.size(b) == 0, start).otherwise(F.aggregate(F.sequence(F.lit(0), F.greatest(F.size(b) - 1, F.lit(0))), start, step))

    edits = F.aggregate(a, F.sequence(F.lit(0), F.size(b)), row)
    return F.try_divide(F.element_at(edits, -1), F.size(b))


def character_error_rate(read: Column, truth: Column) -> Column:
    return F.try_divide(F.levenshtein(read, truth), F.length(truth))
