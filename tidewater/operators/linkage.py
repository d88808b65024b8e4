"""Linking records of two sources: bands of dates, nearest dates, similar names, one-to-one assignment, measures."""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher
from math import ceil, sqrt

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as K

from tidewater.functions import text as T
from tidewater.sources.between import written


def similarity(a: Column, b: Column) -> Column:
    """1 - edit distance / longer length, without case; 1 for equal, 0 with a null or empty side."""
    x, y = F.lower(a), F.lower(b)
    longer = F.greatest(F.length(x), F.length(y))
    return F.when(a.isNull() | b.isNull() | (a == "") | (b == ""), F.lit(0.0)).when(x == y, F.lit(1.0)).otherwise(1 - F.levenshtein(x, y) / longer)


@F.pandas_udf(K.DoubleType())
def matching_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio without case, 0 with a null side; not symmetric. Call it on distinct pairs."""
    return pd.Series([SequenceMatcher(None, x.lower(), y.lower()).ratio() if x is not None and y is not None else 0.0 for x, y in zip(a, b)], dtype="float64")


def band_join(left: DataFrame, right: DataFrame, left_date: str, right_date: str, days: int, on: tuple[str, ...] = (), missing: bool = False) -> DataFrame:
    """Pairs whose dates are at most ``days`` apart: an equi-join on buckets of dates, each row of the left in three.

    With ``missing`` two rows without a date are a pair, too.
    """
    number = lambda c: F.floor(F.datediff(F.col(c), F.lit("1970-01-01").cast("date")) / (days + 1))
    bucket, taken = "_bucket", {c.lower() for c in left.columns + right.columns}
    while bucket in taken:
        bucket += "_"
    near = F.array(*(number(left_date) + k for k in (-1, 0, 1)))
    fits = F.abs(F.datediff(left_date, right_date)) <= days
    if missing:
        none = F.lit(-(1 << 40))
        near = F.when(F.col(left_date).isNull(), F.array(none)).otherwise(near)
        fits = fits | (F.col(left_date).isNull() & F.col(right_date).isNull())
    a = left.withColumn(bucket, F.explode(near))
    b = right.withColumn(bucket, F.coalesce(number(right_date), none) if missing else number(right_date))
    return a.join(b, [bucket, *on]).filter(fits).drop(bucket)


def cell_pairs(autos: DataFrame, humans: DataFrame, keys: DataFrame, days: int = 14, each: int = 1024) -> DataFrame:
    """(auto_id, human_id, total_score): all pairs whose keys match and whose dates are at most ``days`` apart.

    ``autos`` has auto_id, date and key, ``humans`` human_id, date and key, and ``keys`` (a_key, b_key, total_score) says which keys match, a row for each pair.
    Rows of one key and date have the same partners, so they travel as lists of some ``each`` ids. Lists meet by key and band of days, and their dates are tested for all
    their pairs at once. What would be joined for a key and band is dealt to parts of some ``most`` ids, and each part of one side meets each of the other in a place of its
    own. There are some 16 places a core (and one for each key and band at least), so the copies of ids that are moved grow with the rows, not with the pairs: 2 * sqrt(places
    * pairs tested) besides one for each band and similar key. A task holds lists of one place's humans and what one auto's list makes of them; pairs are never moved.
    """
    spark, cells, lists = autos.sparkSession, {}, {}
    for s, x in (("auto", autos), ("human", humans)):
        x = x.select(F.col("key").alias(f"{s}_key"), F.col("date").alias(f"{s}_date"), f"{s}_id").filter(f"{s}_key is not null and {s}_date is not null")
        cell = [f"{s}_key", f"{s}_date"]
        cells[s] = written(x.groupBy(*cell).agg(F.count("*").alias(f"{s}_n")), "cells")
        part = F.pmod(F.xxhash64(f"{s}_id"), F.ceil(F.col(f"{s}_n") / each)).alias(f"{s}_part")
        lists[s] = written(x.join(cells[s], cell).groupBy(*cell, part).agg(F.collect_list(f"{s}_id").alias(f"{s}_ids")), "lists")

    alike = written(keys.select(F.col("a_key").alias("auto_key"), F.col("b_key").alias("human_key"), "total_score"), "alike")
    band = lambda c, k=0: F.floor((F.datediff(c, F.lit("1970-01-01").cast("date")) + k) / (days + 1))

    def around(a: DataFrame) -> DataFrame:
        """Autos under the keys and bands of their partners."""
        return a.join(alike, "auto_key").withColumn("band", F.explode(F.sequence(band("auto_date", -days), band("auto_date", days))))

    def within(b: DataFrame) -> DataFrame:
        return b.withColumn("band", band("human_date"))

    unit = ["human_key", "band"]
    counts = [x.groupBy(*unit).agg(F.sum(f"{s}_n").alias(f"{s}_n")) for s, x in (("auto", around(cells["auto"])), ("human", within(cells["human"])))]
    units = written(counts[0].join(counts[1], unit), "units")
    tested, ids = units.agg(F.sum(F.col("auto_n").cast("double") * F.col("human_n")), F.sum(F.col("auto_n") + F.col("human_n"))).first()
    cores = spark.sparkContext.defaultParallelism
    places = min(max(2 * cores, ceil((tested or 0) / (1 << 22))), 16 * cores)
    most = max(1.0, sqrt((tested or 0) / places))
    tasks = max(2 * places, ceil((2 * (tested or 0) / most + (ids or 0)) / (1 << 22)))

    place = [*unit, "auto_deal", "human_deal"]
    own = lambda s: F.pmod(F.xxhash64(f"{s}_date", f"{s}_part"), F.ceil(F.col(f"{s}_n") / most)).alias(f"{s}_deal")
    every = lambda s: F.explode(F.sequence(F.lit(0).cast("bigint"), F.ceil(F.col(f"{s}_n") / most) - 1)).alias(f"{s}_deal")
    a = around(lists["auto"]).join(units, unit).select(*unit, own("auto"), every("human"), "auto_date", "auto_ids", "total_score").repartition(tasks, *place)
    b = within(lists["human"]).join(units, unit).select(*unit, every("auto"), own("human"), "human_date", "human_ids").repartition(tasks, *place)
    met = a.join(b, place).filter(F.abs(F.datediff("auto_date", "human_date")) <= days).select("auto_ids", "human_ids", "total_score")
    # Generated code holds what it makes of a row; coalesce, which leaves the partitions as they are, ends it, so that a row is a list with a list, then one auto with a list.
    ones = met.coalesce(tasks).select("human_ids", "total_score", F.explode("auto_ids").alias("auto_id")).coalesce(tasks)
    return ones.select("auto_id", F.explode("human_ids").alias("human_id"), "total_score")


def nearest(left: DataFrame, right: DataFrame, left_id: str, left_date: str, right_date: str, days: int) -> DataFrame:
    """Each left row with the nearest right date within ``days``, the earlier of two; rows without one are left out."""
    pairs = band_join(left, right, left_date, right_date, days).withColumn("days_apart", F.abs(F.datediff(left_date, right_date)))
    first = F.row_number().over(Window.partitionBy(left_id).orderBy("days_apart", right_date))
    return pairs.withColumn("_r", first).filter("_r = 1").drop("_r")


def _bigrams(c: Column) -> Column:
    padded = F.concat(F.lit("^"), F.lower(c), F.lit("$"))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(padded) - 1), lambda i: F.substring(padded, i, F.lit(2))))


def close_pairs(values: DataFrame, names: DataFrame, value: str, name: str, least: float = 0.80) -> DataFrame:
    """(value, name, score): all pairs of different values whose edit distance's ``similarity`` is at least ``least``, of 0.5 and more; they share a pair of letters."""
    a = values.select(value).distinct().withColumn("_g", F.explode(_bigrams(F.col(value))))
    b = names.select(name).distinct().withColumn("_g", F.explode(_bigrams(F.col(name))))
    pairs = a.join(b, "_g").select(value, name).distinct()
    return pairs.withColumn("score", similarity(F.col(value), F.col(name))).filter(F.col("score") >= least)


def best_match(values: DataFrame, canonical: DataFrame, value: str, name: str, least: float = 0.70, ratio: bool = False) -> DataFrame:
    """(value, name, score): for each distinct value the most similar name above ``least``, the first in order of equals.

    Strings so similar share a pair of neighbouring letters for ``least`` of 0.5 and more, so candidates come
    from an equi-join on those pairs. With ``ratio`` the score is ``matching_ratio`` instead of the edit distance's;
    then that holds for ``least`` of 0.85 and more. Lengths bound either score before it is worked out.
    """
    first = F.row_number().over(Window.partitionBy(value).orderBy(F.desc("score"), name))
    return matches(values, canonical, value, name, least, ratio).withColumn("_r", first).filter("_r = 1").drop("_r")


def matches(values: DataFrame, canonical: DataFrame, value: str, name: str, least: float = 0.70, ratio: bool = False) -> DataFrame:
    """(value, name, score): for each distinct value all names above ``least``; see ``best_match``."""
    a = values.select(value).distinct().withColumn("_g", F.explode(_bigrams(F.col(value))))
    b = canonical.select(name).distinct().withColumn("_g", F.explode(_bigrams(F.col(name))))
    x, y = F.length(value), F.length(name)
    bound = 2 * F.least(x, y) / (x + y) if ratio else F.least(x, y) / F.greatest(x, y)
    pairs = a.join(b, "_g").select(value, name).distinct().filter(bound > least)
    return pairs.withColumn("score", matching_ratio(F.col(value), F.col(name)) if ratio else similarity(F.col(value), F.col(name))).filter(F.col("score") > least)


def normalize_ports(rows: DataFrame, value: str, canonical: DataFrame, name: str) -> DataFrame:
    """Adds ``port``: the listed name without case, else the abbreviation's or family's, else the most similar above 0.85, else the value; '' for blank."""
    listed = canonical.groupBy(F.lower(name).alias("_low")).agg(F.min(name).alias("_listed"))
    distinct = rows.select(value).distinct().join(listed, T.low(F.col(value)) == F.col("_low"), "left").drop("_low")
    ruled = distinct.withColumn("_ruled", T.normalize_port(F.col(value), F.col("_listed")))
    left = ruled.filter(F.col("_ruled") == T.strip(F.col(value))).filter(F.col("_listed").isNull())
    near = best_match(left, canonical, value, name, 0.85, ratio=True).select(value, F.col(name).alias("_near"))
    found = ruled.join(near, value, "left").select(F.col(value).alias("_key"), F.coalesce("_near", "_ruled").alias("port"))
    return rows.join(found, F.col(value).eqNullSafe(F.col("_key")), "left").drop("_key")


def normalize_commodities(rows: DataFrame, value: str, frequent: int = 20, canonical: DataFrame | None = None, name: str = "commodity") -> DataFrame:
    """Adds ``commodity_name``: the value itself if ``canonical`` lists it, else the rules' name, else the most similar frequent one.

    All in lower case; '' for blank. Similar names are those of a ratio above 0.90 that more than ``frequent`` rows have, and for a name that itself has so
    many more than ``frequent`` times its rows: in large tables misspelled names have many rows, too.
    """
    # Written, because filters on the rules' names would be pushed below the count and tried on every row.
    ruled = written(rows.groupBy(value).agg(F.count("*").alias("_n")), "names").withColumn("_ruled", T.normalize_commodity(F.col(value)))
    if canonical is not None:
        listed = canonical.select(T.low(F.col(name)).alias("_listed")).filter("_listed != ''").distinct()
        ruled = ruled.join(listed, T.low(F.col(value)) == F.col("_listed"), "left").withColumn("_ruled", F.coalesce("_listed", "_ruled"))
    else:
        ruled = ruled.withColumn("_listed", F.lit(None).cast("string"))
    counts = ruled.filter("_ruled != ''").groupBy("_ruled").agg(F.sum("_n").alias("_rows"), F.count_if(F.col("_listed").isNull()).alias("_own"))
    names = counts.filter(F.col("_rows") > frequent).select(F.col("_ruled").alias("_name"), F.col("_rows").alias("_name_rows"))
    close = matches(counts.filter("_own > 0"), names, "_ruled", "_name", 0.90, ratio=True).join(counts, "_ruled").join(names, "_name")
    close = close.filter((F.col("_rows") <= frequent) | (F.col("_name_rows") > frequent * F.col("_rows")))
    near = close.groupBy(F.col("_ruled").alias("_from")).agg(F.min_by("_name", F.struct(-F.col("score"), "_name")).alias("_near"))
    found = ruled.join(near, (F.col("_ruled") == F.col("_from")) & F.col("_listed").isNull(), "left").select(F.col(value).alias("_key"), F.coalesce("_near", "_ruled").alias("commodity_name"))
    return rows.join(found, F.col(value).eqNullSafe(F.col("_key")), "left").drop("_key")


def tier(error: Column, exact: Column, variant: Column, score: Column) -> Column:
    """How a name was found: error, exact, variant, fuzzy_high, fuzzy_medium, fuzzy_low or unmapped."""
    return (
        F.when(error, "error").when(exact, "exact").when(variant, "variant")
        .when(score > 0.92, "fuzzy_high").when(score > 0.85, "fuzzy_medium").when(score > 0.70, "fuzzy_low").otherwise("unmapped")
    )


def triage(tier_: Column, count: Column) -> Column:
    """What happens to a name: auto, error or review."""
    return (
        F.when(tier_.isin("exact", "variant", "fuzzy_high"), "auto").when(tier_ == "error", "error")
        .when((count >= 20) | (tier_ == "fuzzy_medium"), "review").when(count < 10, "error").otherwise("review")
    )


def decide(rows: DataFrame, decisions: DataFrame, value: str, automatic: Column) -> DataFrame:
    """Adds ``decided``: '' for ERROR, the mapped name for MAP, the name itself for ACCEPT, else ``automatic``."""
    joined = rows.join(decisions.select(F.col("original_port").alias(value), "action", "map_to_port"), value, "left")
    decided = F.when(F.col("action") == "ERROR", "").when(F.col("action") == "MAP", F.col("map_to_port")).when(F.col("action") == "ACCEPT", F.col(value)).otherwise(automatic)
    return joined.withColumn("decided", decided)


def label_matches(candidates: DataFrame, autos: DataFrame, humans: DataFrame) -> DataFrame:
    """The best candidate of each auto_id with its match_type, and the rows of both sides without any."""
    # Counted by score first, so that pairs are combined before anything moves.
    by_score = candidates.groupBy("auto_id", "total_score").agg(F.count("*").alias("n"), F.min("human_id").alias("human_id"))
    best = F.max_by(F.struct("human_id", "total_score"), "total_score")
    ranked = by_score.groupBy("auto_id").agg(F.sum("n").alias("n"), best.alias("best")).select("auto_id", "n", "best.*")
    kind = F.when(F.col("n") == 1, "1:1").otherwise(F.format_string("1:many (best of %d)", "n"))
    matched = ranked.select(kind.alias("match_type"), "auto_id", "human_id", "total_score")
    zero = F.lit(0.0).alias("total_score")
    lone_auto = autos.join(matched, "auto_id", "left_anti").select(F.lit("unmatched_auto").alias("match_type"), "auto_id", F.lit(None).cast("bigint").alias("human_id"), zero)
    lone_human = humans.join(matched, "human_id", "left_anti").select(F.lit("unmatched_human").alias("match_type"), F.lit(None).cast("bigint").alias("auto_id"), "human_id", zero)
    return matched.unionByName(lone_auto).unionByName(lone_human)


def greedy(candidates: DataFrame, block: str = "block") -> DataFrame:
    """(block, auto_id, human_id, total_score): in order of auto_id each takes its best human still free, within a block.

    Of equals the smallest human_id is taken; null blocks are one. A block's rows pass in order, so that of a block only
    the ids of taken humans are held.
    """
    columns = [block, "auto_id", "human_id", "total_score"]
    kinds = ", ".join(f"`{c}` {candidates.schema[c].dataType.simpleString()}" for c in columns)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, taken, done = object(), set(), None
        for rows in batches:
            kept = []
            for i, (own, auto, human) in enumerate(zip(*(rows.column(k).to_pylist() for k in range(3)))):
                if own != now:
                    now, taken, done = own, set(), object()
                if auto != done and human not in taken:
                    done = auto
                    taken.add(human)
                    kept.append(i)
            yield rows.take(pa.array(kept, pa.int64()))

    ordered = candidates.select(*columns).repartition(block).sortWithinPartitions(block, "auto_id", F.desc("total_score"), "human_id")
    return ordered.mapInArrow(assign, kinds)


def scores(true_positive: Column, found: Column, wanted: Column) -> list[Column]:
    """precision, recall and f1, 0 where undefined, to 6 digits."""
    p, r = F.coalesce(F.try_divide(true_positive, found), F.lit(0.0)), F.coalesce(F.try_divide(true_positive, wanted), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0))
    return [F.round(p, 6).alias("precision"), F.round(r, 6).alias("recall"), F.round(f1, 6).alias("f1")]
