"""Matching the records of two sources on similar ports and commodities within a band of dates.

Names are compared by the Ratcliff-Obershelp ratio, once for each pair of different names that can reach the threshold; records are then
joined by equality, through the tables of similar names and buckets of dates. Labels need no pairs of records at all: records
with one date and the same names have the same candidates, so cells of records are counted instead. Names and cells, which are few, are
written once, so that no step counts the records anew.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions import text as T
from tidewater.sources.between import written

from .linkage import matching_ratio


def named(c: Column) -> Column:
    """A name as it is compared: in lower case, without white space at the ends; null for null and empty ones."""
    return F.when(c != "", T.low(c))


def _numbered(parts: Column) -> Column:
    """Each part with its number among equal ones, so that a set has what was a multiset."""
    number = lambda s: F.transform(s, lambda x, i: F.concat(x, F.lit("\x00"), (i - F.array_position(s, x)).cast("string")))
    return F.get(F.transform(F.array(F.array_sort(parts)), number), 0)


def _letters(c: Column) -> Column:
    return F.filter(F.split(c, ""), lambda x: x != "")


def _pairs_of_letters(c: Column) -> Column:
    return F.when(F.length(c) >= 2, F.transform(F.sequence(F.lit(1), F.length(c) - 1), lambda i: F.substring(c, i, F.lit(2)))).otherwise(F.array().cast("array<string>"))


def shared_letter_pairs(least: float, length: Column) -> Column:
    """How many pairs of neighbouring letters a name shares, at least, with any name of a ratio of ``least`` or more.

    With s letters in both names, at least ``least`` s / 2 letters of each match, in blocks. Blocks that follow each other are parted by a letter that
    doesn't match, of which there are (1 - least) s at most, so (1.5 least - 1) s - 1 pairs lie within blocks; and s is at least 2 / (2 - least)
    times the length of either name.
    """
    return F.ceil((1.5 * least - 1) * 2 / (2 - least) * length - 1 - 1e-9)


def ratio_pairs(left: DataFrame, right: DataFrame, a: str, b: str, least: float) -> DataFrame:
    """(a, b, score): all pairs of different values of ``left.a`` and ``right.b`` with a ratio of at least ``least``, above 2/3.

    Values are compared as they are (see ``named``); nulls match nothing, equal values score 1. Other candidates share one of their rarest
    pairs of letters, as many of them as ``shared_letter_pairs`` leaves necessary, or, being short, a letter; their lengths and common letters bound the
    ratio before it is worked out. No pair is lost. The ratio isn't symmetric: the left value is the first argument.
    """
    assert 2 / 3 < least <= 1
    x = left.select(F.col(a).alias("a")).filter("a is not null").distinct()
    y = right.select(F.col(b).alias("b")).filter("b is not null").distinct()
    short = ceil(1 / (1.5 * least - 1))  # two names so short may share no pair of letters

    def parts(names: DataFrame, c: str) -> DataFrame:
        value = F.col(c)
        by_pair = F.transform(_numbered(_pairs_of_letters(value)), lambda p: F.concat(F.lit("2"), p))
        by_letter = F.when(F.length(value) <= short, F.transform(_numbered(_letters(value)), lambda p: F.concat(F.lit("1"), p))).otherwise(F.array().cast("array<string>"))
        return names.select(c, F.length(value).alias("n"), _numbered(_letters(value)).alias("letters"), by_pair.alias("pairs"), by_letter.alias("singles"))

    own = {"a": parts(x, "a"), "b": parts(y, "b")}
    every = own["a"].select(F.explode("pairs").alias("part")).unionByName(own["b"].select(F.explode("pairs").alias("part")))
    counts = every.groupBy("part").agg(F.count("*").alias("times"))

    def keys(c: str) -> DataFrame:
        """The rarest pairs of letters that one must share, and all letters of short names."""
        ranked = own[c].select(c, "n", F.explode("pairs").alias("part")).join(counts, "part")
        place = F.row_number().over(Window.partitionBy(c).orderBy("times", "part"))
        needed = F.greatest(shared_letter_pairs(least, F.col("n")), F.lit(1))
        rare = ranked.withColumn("place", place).filter(F.col("place") <= F.col("n") - 1 - needed + 1).select(c, "part")
        return rare.unionByName(own[c].select(c, F.explode("singles").alias("part")))

    together = keys("a").join(keys("b"), "part").filter("a != b").select("a", "b").distinct()
    sizes = {c: own[c].select(c, F.col("n").alias(f"n_{c}"), F.col("letters").alias(f"letters_{c}")) for c in own}
    tried = together.join(sizes["a"], "a").join(sizes["b"], "b").filter(2 * F.least("n_a", "n_b") >= (least - 1e-9) * (F.col("n_a") + F.col("n_b")))
    tried = tried.filter(2 * F.size(F.array_intersect("letters_a", "letters_b")) >= (least - 1e-9) * (F.col("n_a") + F.col("n_b")))
    unequal = tried.select("a", "b").withColumn("score", matching_ratio(F.col("a"), F.col("b"))).filter(F.col("score") >= least)
    return x.join(y, F.col("a") == F.col("b")).select("a", "b", F.lit(1.0).alias("score")).unionByName(unequal)


def similar_keys(autos: DataFrame, humans: DataFrame, port: float = 0.85, commodity: float = 0.80) -> DataFrame:
    """(a_port, a_commodity, b_port, b_commodity, port_score, commodity_score, total_score) of the (port, commodity) that both sides have.

    Both scores reach their thresholds; the total is their mean. A row for each pair of different keys that occur, not of records.
    """
    keys = {s: written(x.select(named(F.col("port")).alias(f"{s}_port"), named(F.col("commodity")).alias(f"{s}_commodity")).distinct(), "keys") for s, x in (("a", autos), ("b", humans))}
    ports = ratio_pairs(keys["a"], keys["b"], "a_port", "b_port", port).toDF("a_port", "b_port", "port_score")
    goods = ratio_pairs(keys["a"], keys["b"], "a_commodity", "b_commodity", commodity).toDF("a_commodity", "b_commodity", "commodity_score")
    found = keys["a"].join(ports, "a_port").join(goods, "a_commodity").join(keys["b"], ["b_port", "b_commodity"])
    total = ((F.col("port_score") + F.col("commodity_score")) / 2).alias("total_score")
    return found.select("a_port", "a_commodity", "b_port", "b_commodity", "port_score", "commodity_score", total)


def _day(c: str) -> Column:
    return F.datediff(F.col(c), F.lit("1970-01-01").cast("date"))


def record_pairs(autos: DataFrame, humans: DataFrame, days: int = 14, port: float = 0.85, commodity: float = 0.80) -> DataFrame:
    """(auto_id, human_id, port_score, commodity_score, total_score, date_diff): all pairs of records that match.

    ``autos`` has auto_id, date, port and commodity, ``humans`` human_id and the same. Dates are at most ``days`` apart, or both are missing (then
    date_diff is null); both names reach their thresholds. A missing name matches nothing. Records meet by equality of
    port, commodity and a bucket of dates.
    """
    keys = written(similar_keys(autos, humans, port, commodity), "similar-keys")  # few, and known to be few once they are written
    bucket = lambda: F.coalesce(F.floor(_day("date") / (days + 1)), F.lit(-(1 << 40)))
    near = F.when(F.col("date").isNull(), F.array(bucket())).otherwise(F.array(*(bucket() + k for k in (-1, 0, 1))))
    a = autos.select("auto_id", F.col("date").alias("a_date"), named(F.col("port")).alias("a_port"), named(F.col("commodity")).alias("a_commodity"), F.explode(near).alias("bucket"))
    b = humans.select("human_id", F.col("date").alias("b_date"), named(F.col("port")).alias("b_port"), named(F.col("commodity")).alias("b_commodity"), bucket().alias("bucket"))
    met = a.join(keys, ["a_port", "a_commodity"]).join(b, ["b_port", "b_commodity", "bucket"])
    apart = F.abs(F.datediff("a_date", "b_date"))
    fits = F.col("a_date").isNull() | (apart <= days)
    return met.filter(fits).select("auto_id", "human_id", "port_score", "commodity_score", "total_score", apart.alias("date_diff"))


def record_classes(autos: DataFrame, humans: DataFrame, days: int = 14, port: float = 0.85, commodity: float = 0.80) -> tuple[DataFrame, DataFrame]:
    """All pairs of records that match, without expanding copies: the pairs of classes, and the class of each record.

    Records of one side with the same date, port and commodity, as names are compared, are a class, named by its smallest id. The first table is
    ``record_pairs`` of these, the second (side, id, class_id) has a row for each record of either side (``auto`` or ``human``). Two records match if and
    only if their classes do, with the same scores, so joining the second table to the first on both sides gives ``record_pairs`` of all records. A class has at most
    as many partners as similar names have days, so the pairs don't grow with the copies.
    """
    firsts, members = {}, []
    for s, x in (("auto", autos), ("human", humans)):
        x = x.select(f"{s}_id", "date", "port", "commodity", named(F.col("port")).alias("_port"), named(F.col("commodity")).alias("_commodity"))
        # A name as it is written goes along, because a blank one is named '' and '' is no name.
        firsts[s] = written(x.groupBy(F.col("date").alias("of_date"), F.col("_port").alias("of_port"), F.col("_commodity").alias("of_commodity")).agg(F.min(f"{s}_id").alias("class_id"), F.min("port").alias("of_port_name"), F.min("commodity").alias("of_commodity_name")), "classes")
        same = [F.col(c).eqNullSafe(F.col(of)) for c, of in (("date", "of_date"), ("_port", "of_port"), ("_commodity", "of_commodity"))]
        members.append(x.join(firsts[s], same).select(F.lit(s).alias("side"), F.col(f"{s}_id").alias("id"), "class_id"))
    own = (x.select(F.col("class_id").alias(f"{s}_id"), F.col("of_date").alias("date"), F.col("of_port_name").alias("port"), F.col("of_commodity_name").alias("commodity")) for s, x in firsts.items())
    return record_pairs(*own, days, port, commodity), members[0].unionByName(members[1])


def best_of_cells(autos: DataFrame, humans: DataFrame, keys: DataFrame, days: int = 14) -> DataFrame:
    """(a_key, date, n, human_id, total_score): for each date and key of ``autos`` how many ``humans`` match and the best of them.

    ``autos`` has date and key, ``humans`` human_id, date and key, and ``keys`` (a_key, b_key, total_score) says which keys match. The best has the
    highest score, of equals the smallest human_id. Missing dates match missing ones. Humans are counted by (key, date); a window of dates over these
    counts answers each (key, date) of autos, so nothing grows with the pairs of records.
    """
    cells = humans.groupBy(F.col("key").alias("b_key"), "date").agg(F.count("*").alias("n"), F.min("human_id").alias("human_id"))
    asked = written(autos.select(F.col("key").alias("a_key"), "date").distinct().join(keys, "a_key"), "asked")
    empty = asked.select("b_key", "date").distinct().select("b_key", "date", F.lit(0).cast("long").alias("n"), F.lit(None).cast(humans.schema["human_id"].dataType).alias("human_id"))
    days_ = cells.unionByName(empty).groupBy("b_key", "date").agg(F.sum("n").alias("n"), F.min("human_id").alias("human_id"))
    # Windows over days don't reach from dates to missing ones, which get a number far from all others. They see a row for each key and day, however many ask.
    day = F.coalesce(_day("date").cast("long"), F.lit(-(1 << 40)))
    around = Window.partitionBy("b_key").orderBy(day).rangeBetween(-days, days)
    counted = days_.select("b_key", F.col("date").alias("day"), F.sum("n").over(around).alias("n"), F.min("human_id").over(around).alias("human_id")).filter("n > 0")
    found = asked.join(counted.withColumnRenamed("b_key", "key"), (F.col("b_key") == F.col("key")) & F.col("date").eqNullSafe(F.col("day")))
    best = F.max_by(F.struct("human_id", "total_score"), F.struct("total_score", (-F.col("human_id")).alias("first")))
    return found.groupBy("a_key", "date").agg(F.sum("n").alias("n"), best.alias("best")).select("a_key", "date", "n", "best.human_id", "best.total_score")


def labels_by_cells(autos: DataFrame, humans: DataFrame, keys: DataFrame, days: int = 14) -> DataFrame:
    """(match_type, auto_id, human_id, total_score): as ``label_matches`` of all pairs gives, without making them.

    ``autos`` has auto_id, date and key; see ``best_of_cells`` for the rest.
    """
    best = written(best_of_cells(autos, humans, keys, days), "best").select(F.col("a_key").alias("cell_key"), F.col("date").alias("cell_date"), "n", "human_id", "total_score")
    found = autos.select("auto_id", "date", "key").join(best, (F.col("key") == F.col("cell_key")) & F.col("date").eqNullSafe(F.col("cell_date")), "left")
    kind = F.when(F.col("n").isNull(), "unmatched_auto").when(F.col("n") == 1, "1:1").otherwise(F.format_string("1:many (best of %d)", "n"))
    own = found.select(kind.alias("match_type"), "auto_id", "human_id", F.coalesce("total_score", F.lit(0.0)).alias("total_score"))
    # Of a cell only one human is taken: what is taken has as many rows as there are cells.
    lone = humans.select("human_id").join(best.select("human_id").distinct(), "human_id", "left_anti")
    lone = lone.select(F.lit("unmatched_human").alias("match_type"), F.lit(None).cast(autos.schema["auto_id"].dataType).alias("auto_id"), "human_id", F.lit(0.0).alias("total_score"))
    return own.unionByName(lone)


def key_of(port: Column, commodity: Column) -> Column:
    """A port and a commodity as one key for ``best_of_cells``; null if one is missing."""
    return F.concat(named(port), F.lit("\x00"), named(commodity))


def keyed(records: DataFrame) -> DataFrame:
    """``records`` with their port and commodity as one ``key``."""
    return records.withColumn("key", key_of(F.col("port"), F.col("commodity")))


def key_scores(autos: DataFrame, humans: DataFrame, port: float = 0.85, commodity: float = 0.80) -> DataFrame:
    """(a_key, b_key, total_score) of the similar keys of both sides."""
    keys = similar_keys(autos, humans, port, commodity)
    return written(keys.select(F.concat("a_port", F.lit("\x00"), "a_commodity").alias("a_key"), F.concat("b_port", F.lit("\x00"), "b_commodity").alias("b_key"), "total_score"), "similar-keys")


def record_labels(autos: DataFrame, humans: DataFrame, days: int = 14, port: float = 0.85, commodity: float = 0.80) -> DataFrame:
    """(match_type, auto_id, human_id, total_score) of records on port, commodity and date, as ``record_pairs`` would match them."""
    return labels_by_cells(keyed(autos), keyed(humans), key_scores(autos, humans, port, commodity), days)


def matched_quantities(autos: DataFrame, humans: DataFrame, days: int = 14) -> DataFrame:
    """The columns of ``autos`` and human_quantity of all autos with a match: that of the human that ``record_labels`` names.

    The best human and its quantity are found for each cell, so autos meet their cells and no records their ids.
    """
    best = best_of_cells(keyed(autos), keyed(humans), key_scores(autos, humans), days).select(F.col("a_key").alias("cell_key"), F.col("date").alias("cell_date"), "human_id")
    best = best.join(humans.select("human_id", "human_quantity"), "human_id")
    return keyed(autos).join(best, (F.col("key") == F.col("cell_key")) & F.col("date").eqNullSafe(F.col("cell_date"))).select(*autos.columns, "human_quantity")


def quantity_report(matched: DataFrame, by: str, top: int = 10, examples: int = 10) -> DataFrame:
    """(by, total, exact, within_5, within_10, mean_error, worst) of the ``top`` groups by ``by`` with the most matched records.

    ``matched`` has auto_quantity, human_quantity and ``by``, which is cut to 20 characters; rows without both quantities are left out. Errors are in
    percent of the larger quantity; ``worst`` lists the largest ``examples`` of a group, which are all that is ever together.
    """
    a, b = F.col("auto_quantity"), F.col("human_quantity")
    error = F.coalesce(F.try_divide(100 * F.abs(a - b), F.greatest(a, b)), F.lit(0.0))
    rows = matched.filter(a.isNotNull() & b.isNotNull()).select(F.left(F.coalesce(by, F.lit("")), F.lit(20)).alias(by), error.alias("error"))
    # Rows of one error are one: what is counted twice, for the sums and for the largest errors, is small and written once.
    errors = written(rows.groupBy(by, "error").agg(F.count("*").alias("n")), "errors")
    several = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0).cast("long"))
    sums = errors.groupBy(by).agg(
        F.sum("n").alias("total"), several(F.col("error") == 0).alias("exact"), several(F.col("error") <= 5).alias("within_5"), several(F.col("error") <= 10).alias("within_10"),
        F.round(F.sum(F.col("error") * F.col("n")) / F.sum("n"), 4).alias("mean_error"),
    )
    sums = sums.orderBy(F.desc("total"), by).limit(top)
    wrong = errors.filter("error > 0").join(F.broadcast(sums.select(by)), by).withColumn("r", F.row_number().over(Window.partitionBy(by).orderBy(F.desc("error"))))
    wrong = wrong.filter(F.col("r") <= examples).withColumn("error", F.explode(F.array_repeat("error", F.least("n", F.lit(examples)).cast("int"))))
    worst = wrong.groupBy(by).agg(F.array_join(F.transform(F.slice(F.sort_array(F.collect_list("error"), False), 1, examples), lambda e: F.format_string("%.2f", e)), ",").alias("worst"))
    return sums.join(F.broadcast(worst), by, "left").withColumn("worst", F.coalesce("worst", F.lit("")))


def bounds(a: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray]:
    """The least and the greatest b with |a - b| / max(a, b) <= share in doubles, for each a > 0 that is finite.

    Near these bounds the difference of two doubles is exact, so the quotient as it is rounded grows on either side of a.
    """
    most = np.finfo(np.float64).max
    fits = lambda b: np.abs(a - b) / np.maximum(a, b) <= share
    with np.errstate(over="ignore"):
        low, high = a * (1 - share), np.minimum(a / (1 - share), most)
    for b, out in ((low, -np.inf), (high, np.inf)):
        while not (ok := fits(b)).all():
            b[~ok] = np.nextafter(b[~ok], a[~ok])
        while (more := fits(step := np.nextafter(b, np.clip(out, -most, most))) & (step != b)).any():
            b[more] = step[more]
    return low, high


def near_quantities(autos: DataFrame, humans: DataFrame, keys: DataFrame, shares: tuple[float, ...] = (0.05, 0.10), days: int = 14) -> DataFrame:
    """(key, n, within_0, ...): how many pairs within ``days`` the autos of a key have, and how many with quantities that differ by each of ``shares``.

    ``autos`` and ``humans`` have date, key and quantity; ``keys`` is as in ``best_of_cells``. No pairs are made: the days around an auto's are at most ten
    blocks of 1, 2, 4, ... days, and the humans of a block up to a quantity are a running count. Two negative quantities are always near, zero is near nothing.
    """
    levels = (2 * days + 1).bit_length()
    own = autos.filter("date is not null").groupBy("key", _day("date").alias("day"), "quantity").agg(F.count("*").alias("n"))
    own = written(own, "own-quantities")
    other = humans.filter("date is not null").groupBy(F.col("key").alias("b_key"), _day("date").alias("day"), "quantity").agg(F.count("*").alias("n"))
    other = written(other.join(keys.select(F.col("a_key").alias("key"), "b_key"), "b_key").groupBy("key", "day", "quantity").agg(F.sum("n").alias("n")), "other-quantities")

    around = own.groupBy("key", "day").agg(F.sum("n").alias("asking")).withColumn("day", F.explode(F.sequence(F.col("day") - days, F.col("day") + days)))
    around = around.groupBy("key", "day").agg(F.sum("asking").alias("asking"))
    total = around.join(other.groupBy("key", "day").agg(F.sum("n").alias("n")), ["key", "day"]).groupBy("key").agg(F.sum(F.col("asking") * F.col("n")).alias("n"))

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each block of an auto's days with the quantities up to which its humans count, for (weight 1) or against (-1)."""
        for batch in batches:
            key, (day, quantity, n) = batch.column(0), (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))
            place = np.arange(len(day))
            asked = []  # (row, quantity, share, weight)
            for k, share in enumerate(shares):
                up = place[(quantity > 0) & (quantity < np.inf)]
                low, high = bounds(quantity[up].astype(np.float64), share)
                asked += [(up, high, k, 1), (up, np.nextafter(low, -np.inf), k, -1)]
                down, least = place[quantity < 0], place[quantity == -np.inf]
                asked += [(down, np.full(len(down), np.nextafter(0.0, -1.0)), k, 1), (least, np.full(len(least), -np.inf), k, -1)]
            rows, upto, which, weight = (np.concatenate(c) for c in zip(*((r, q, np.full(len(r), k), np.full(len(r), w)) for r, q, k, w in asked)))
            first, past = day[rows].astype(np.int64) - days, day[rows].astype(np.int64) + days + 1
            for level in range(levels):
                odd = (first < past) & ((first & 1) == 1)
                last = (first + odd < past) & ((past & 1) == 1)
                for block, take in ((first, odd), (past - 1, last)):
                    at = rows[take]
                    yield pa.RecordBatch.from_arrays([key.take(pa.array(at)), pa.array(np.full(len(at), level, np.int32)), pa.array(block[take]), pa.array(upto[take]), pa.array(which[take].astype(np.int32)), pa.array(weight[take] * n[at])], names)
                first, past = (first + odd) >> 1, (past - last) >> 1

    names = ["key", "level", "block", "upto", "which", "weight"]
    sent = own.filter("quantity is not null and not isnan(quantity)").select("key", "day", F.col("quantity").cast("double").alias("quantity"), "n")
    # Few large files would be few tasks: what is multiplied is dealt first.
    sent = sent.repartition("key", "day", "quantity").mapInArrow(edges, "key string, level int, block long, upto double, which int, weight long")
    weights = [F.sum(F.when(F.col("which") == k, F.col("weight")).otherwise(0)).alias(f"w{k}") for k in range(len(shares))]
    asking = sent.groupBy("key", "level", "block", "upto").agg(*weights).withColumn("n", F.lit(0).cast("long"))
    held = other.filter("quantity is not null and not isnan(quantity)").withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(levels - 1))))
    held = held.select("key", "level", "day", F.col("quantity").cast("double").alias("upto"), "n")
    held = held.select("key", "level", F.floor(F.col("day") / F.pow(F.lit(2.0), "level")).alias("block"), "upto", "n", *(F.lit(0).cast("long").alias(f"w{k}") for k in range(len(shares))))
    upto = F.sum("n").over(Window.partitionBy("key", "level", "block").orderBy("upto"))  # equal quantities are counted together
    counted = held.unionByName(asking).withColumn("upto_n", upto).groupBy("key").agg(*(F.sum(F.col(f"w{k}") * F.col("upto_n")).alias(f"within_{k}") for k in range(len(shares))))
    return total.join(counted, "key", "left").select("key", "n", *(F.coalesce(f"within_{k}", F.lit(0).cast("long")).alias(f"within_{k}") for k in range(len(shares))))


def examples_by_cells(autos: DataFrame, humans: DataFrame, keys: DataFrame, days: int = 14, most: int = 3) -> DataFrame:
    """(k, r, auto_id, human_id): the first ``most`` pairs, by auto_id and human_id, of same (score 1) and of near keys.

    The first autos with any candidate are found by cells, and only these few meet their candidates.
    """
    out = None
    for k, kind in (("same", F.col("total_score") == 1), ("near", F.col("total_score") < 1)):
        some = keys.filter(kind)
        cells = best_of_cells(autos, humans, some, days).select(F.col("a_key").alias("key"), F.col("date").alias("cell_date"))
        firsts = autos.join(cells.withColumnRenamed("key", "cell_key"), (F.col("key") == F.col("cell_key")) & F.col("date").eqNullSafe(F.col("cell_date")), "left_semi")
        firsts = firsts.orderBy("auto_id").limit(most).join(some, F.col("key") == F.col("a_key")).select("auto_id", F.col("date").alias("a_date"), "b_key")
        near = (F.abs(F.datediff("a_date", "date")) <= days) | (F.col("a_date").isNull() & F.col("date").isNull())
        pairs = humans.join(F.broadcast(firsts), F.col("key") == F.col("b_key")).filter(near).select("auto_id", "human_id").orderBy("auto_id", "human_id").limit(most)
        numbered = pairs.select(F.lit(k).alias("k"), F.row_number().over(Window.orderBy("auto_id", "human_id")).alias("r"), "auto_id", "human_id")  # ``most`` rows
        out = numbered if out is None else out.unionByName(numbered)
    return out
