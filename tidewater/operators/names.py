"""Lists of names and parts of tables: cleaned dictionaries, extended lists, one part without repeats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions import text as T

# What stands for an empty cell.
EMPTY = ["(vide)", "---", "vide", "Vide"]


def clean_names(rows: DataFrame, name: str, least: int = 2) -> DataFrame:
    """The distinct names of ``rows`` without white space at the ends; no placeholders, numbers, nulls or names shorter than ``least``."""
    s = T.strip(F.col(name))
    return rows.select(s.alias(name)).filter((F.length(name) >= least) & ~F.col(name).isin(EMPTY) & ~F.col(name).rlike(r"^\d+$")).distinct()


def extended(names: DataFrame, accepted: DataFrame, name: str) -> DataFrame:
    """The names of either list, each once."""
    return names.select(name).union(accepted.select(name)).distinct()


def without_repeats_where(rows: DataFrame, part: Column, signature: list[str], order: str) -> DataFrame:
    """All rows outside ``part``, and of those in it one of each signature, that with the smallest ``order`` (a unique column); a null ``part`` is outside."""
    inside = F.coalesce(part, F.lit(False))
    firsts = rows.filter(inside).groupBy(*signature).agg(F.min(order).alias(order)).select(order)
    return rows.filter(~inside).unionByName(rows.filter(inside).join(firsts, order, "left_semi"))


def commodity_names(items: Column) -> Column:
    """The commodities of a list of cargo items that have one, in order."""
    return F.filter(F.transform(items, lambda i: i["commodity"]), lambda c: c != "")
