"""Order-dependent operators over lines and rows: carried context, runs, sections, neighbours, signatures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions import text as T

# Headers that name a city; docks after them belong to it.
CITIES = ["LONDON", "LIVERPOOL", "GLASGOW", "HULL", "BRISTOL", "CARDIFF", "LEITH", "GRANGEMOUTH"]


def forward_fill(value: Column, keys: list[str], order: list[str]) -> Column:
    """The last value so far that isn't null, within ``keys``."""
    return F.last(value, ignorenulls=True).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))


def look_back(value: Column, keys: list[str], order: list[str], rows: int = 4) -> Column:
    """The last value that isn't null in the ``rows`` rows before this one."""
    return F.last(value, ignorenulls=True).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(-rows, -1))


def context_updates(c: Column) -> dict[str, Column]:
    """What a line changes of the context: a header's name and whether it names a city or a dock, and the month and day of a date header or record."""
    name = F.when(T.is_port_header(c), F.initcap(F.regexp_replace(c, r"\.\s*$", "")))
    upper = F.upper(name)
    record = T.parse_record(c)
    month = F.coalesce(T.part(c, T.DATE_HEADER, 1), record["month"])
    day = F.coalesce(T.part(c, T.DATE_HEADER, 2).cast("int"), record["day"])
    return {"_name": name, "_is_city": F.coalesce(upper.isin(CITIES), F.lit(False)), "_dock": F.coalesce(T.has_any(upper, ["DOCK", "WHARF"]), F.lit(False)), "month": month, "day": day}


def carry_context(lines: DataFrame, keys: list[str], order: list[str], line: str = "line") -> DataFrame:
    """Adds to each line the place and date it stands under: port, month, day; they last until the next header, within ``keys``.

    A city's header is the port until a dock follows, which is then ``City (Dock)``; any other header is a port of
    its own and ends the city. A record's own date holds for the records after it as a date header's does.
    """
    out = lines.withColumns(context_updates(F.col(line)))
    # A struct isn't null even if its field is: it resets the city.
    city = F.when(F.col("_is_city"), F.struct(F.col("_name").alias("name"))).when(F.col("_name").isNotNull() & ~F.col("_dock"), F.struct(F.lit(None).cast("string").alias("name")))
    out = out.withColumn("_city", city).drop("_is_city")
    out = out.withColumn("_city", forward_fill(F.col("_city"), keys, order)["name"])
    port = F.when(F.col("_dock") & F.col("_city").isNotNull(), F.format_string("%s (%s)", "_city", "_name")).otherwise(F.col("_name"))
    out = out.withColumn("port", port)
    return out.withColumns({x: forward_fill(F.col(x), keys, order) for x in ("port", "month", "day")}).drop("_city", "_name", "_dock")


def sections(lines: DataFrame, keys: list[str], order: list[str], is_header: Column) -> DataFrame:
    """Adds ``section``: how many headers came so far, within ``keys``."""
    return lines.withColumn("section", F.sum(is_header.cast("int")).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))


def runs(rows: DataFrame, keys: list[str], order: list[str], value: str, least: int = 3) -> DataFrame:
    """(keys, value, run, n): runs of at least ``least`` neighbouring rows with one value."""
    w = Window.partitionBy(*keys).orderBy(*order)
    changed = ~F.col(value).eqNullSafe(F.lag(value).over(w)) | (F.row_number().over(w) == 1)
    marked = rows.withColumn("_changed", changed.cast("int")).withColumn("run", F.sum("_changed").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*keys, value, "run").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def neighbour_mode(rows: DataFrame, keys: list[str], order: list[str], value: str, before: int = 10, after: int = 9) -> DataFrame:
    """Adds ``near``: the commonest value among the neighbouring rows but this one, the smallest of equals; '' without any."""
    w = Window.partitionBy(*keys).orderBy(*order)
    near = F.concat(F.collect_list(value).over(w.rowsBetween(-before, -1)), F.collect_list(value).over(w.rowsBetween(1, after)))
    counted = rows.withColumn("_near", F.filter(near, lambda x: x != ""))
    ranked = F.array_sort(F.transform(F.array_distinct("_near"), lambda x: F.struct((-F.size(F.filter("_near", lambda y: y == x))).alias("n"), x.alias("value"))))
    return counted.withColumn("near", F.coalesce(F.get(ranked, 0)["value"], F.lit(""))).drop("_near")


def first_of_signature(rows: DataFrame, signature: list[str], order: str) -> DataFrame:
    """One row of each signature, that with the smallest ``order``, which has no repeats; nulls are equal.

    What is shuffled is a SHA-256 of the signature and the smallest ``order`` of each task, never the signature itself.
    """
    key = F.unhex(F.sha2(F.to_json(F.struct(*(F.col(c).alias(f"c{i}") for i, c in enumerate(signature)))), 256))
    firsts = rows.groupBy(key.alias("_signature")).agg(F.min(order).alias(order))
    return rows.join(firsts.select(order), order, "left_semi")


def first_members(rows: DataFrame, group: list[str], member: str, most: int, name: str, salts: int = 16) -> DataFrame:
    """(_s0, _s1, ..., name): for each ``group`` an array of its first ``most`` members in order, missing ones left out; nulls of the group are equal.

    Groups are cut twice: tasks and then parts of a group keep ``most`` members, so that no task sees more of a group than parts times ``most``.
    """
    own = [f"_s{i}" for i in range(len(group))]
    kept = rows.select(*(F.col(c).alias(k) for c, k in zip(group, own)), F.col(member).alias("_member")).filter("_member is not null")
    kept = kept.withColumn("_salt", F.pmod(F.xxhash64("_member"), F.lit(salts)))
    for keys in ([*own, "_salt"], own):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy("_member"))
        kept = kept.withColumn("_place", place).filter(F.col("_place") <= most)
    return kept.groupBy(*own).agg(F.array_sort(F.collect_list("_member")).alias(name))


def duplicate_report(rows: DataFrame, signature: list[str], member: str, major: int = 50, shown: int = 10, source: str | None = None) -> DataFrame:
    """Signatures of several rows: how many, whether many, and the first members; null signatures are equal, null members don't show.

    With ``source`` also ``n_sources``, how many different sources they have, and ``sources``, the first of these. Only the first
    members of a signature are ever together.
    """
    counts = rows.groupBy(*signature).agg(F.count("*").alias("n")).filter("n > 1")
    own = [f"_s{i}" for i in range(len(signature))]
    same = reduce(lambda x, y: x & y, (F.col(c).eqNullSafe(F.col(k)) for c, k in zip(signature, own)))
    out = counts.join(first_members(rows, signature, member, shown, "members"), same, "left").drop(*own)
    columns = [*signature, "n", (F.col("n") >= major).alias("is_major"), F.array_join(F.coalesce("members", F.array()), ",").alias("members")]
    if source is not None:
        each = rows.select(*signature, source).distinct()
        kinds = each.groupBy(*(F.col(c).alias(k) for c, k in zip(signature, own))).agg(F.count(source).alias("n_sources"))
        out = out.join(kinds, same).drop(*own).join(first_members(each, signature, source, shown, "sources"), same, "left").drop(*own)
        columns += ["n_sources", F.array_join(F.coalesce("sources", F.array()), ",").alias("sources")]
    return out.select(*columns)


def place_within(rows: DataFrame, keys: list[str], order: str, name: str, each: int = 1 << 16) -> DataFrame:
    """Adds ``name``: the place from 0 of each row within ``keys`` in order of ``order``, an integer without ties or nulls.

    Rows are numbered in ranges of ``each`` values, and a row for each range carries what lies before it,
    so a few large keys keep all tasks busy.
    """
    ranged = rows.withColumn("_range", F.floor(F.col(order) / each))
    sizes = ranged.groupBy(*keys, "_range").agg(F.count("*").alias("_size"))
    before = F.sum("_size").over(Window.partitionBy(*keys).orderBy("_range")) - F.col("_size")
    own = {k: f"_k{i}" for i, k in enumerate([*keys, "_range"])}
    starts = sizes.withColumn("_before", before).select(*(F.col(k).alias(v) for k, v in own.items()), "_before")
    same = reduce(lambda x, y: x & y, (F.col(k).eqNullSafe(F.col(v)) for k, v in own.items()))
    local = F.row_number().over(Window.partitionBy(*keys, "_range").orderBy(order)) - 1
    return ranged.withColumn("_local", local).join(starts, same).withColumn(name, F.col("_before") + F.col("_local")).drop("_range", "_local", "_before", *own.values())


def fill_by_ranges(rows: DataFrame, keys: list[str], order: str, values: dict[str, Column], each: int = 1 << 16) -> DataFrame:
    """Adds for each name the last of its values so far that isn't null, within ``keys``; ``order`` is an integer without ties or nulls.

    Like ``forward_fill``, but ranges of ``each`` values of the order are filled apart, and a row for each range carries what the ranges
    before it end with: no task sorts all rows of a large key. ``rows`` is read twice.
    """
    at, own = "_fill_range", {n: f"_fill_{n}" for n in values}
    ranged = rows.withColumns({own[n]: v for n, v in values.items()}).withColumn(at, F.floor(F.col(order) / each))
    ends = ranged.groupBy(*keys, at).agg(*(F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in own.values()))
    before = Window.partitionBy(*keys).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    names = {k: f"_fill_key{i}" for i, k in enumerate([*keys, at])}
    carried = ends.select(*(F.col(k).alias(v) for k, v in names.items()), *(F.last(c, ignorenulls=True).over(before).alias(f"{c}_before") for c in own.values()))
    same = reduce(lambda x, y: x & y, (F.col(k).eqNullSafe(F.col(v)) for k, v in names.items()))
    here = Window.partitionBy(*keys, at).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.withColumns({c: F.last(c, ignorenulls=True).over(here) for c in own.values()})
    out = local.join(carried, same).withColumns({n: F.coalesce(c, f"{c}_before") for n, c in own.items()})
    return out.drop(at, *own.values(), *(f"{c}_before" for c in own.values()), *names.values())


def stratified(rows: DataFrame, stratum: str, order: str, most: int = 5) -> DataFrame:
    """Every step-th row of each stratum, ``most`` of them: step is the stratum's size by ``most``, rounded down; ``order`` is an integer without ties."""
    sizes = rows.groupBy(F.col(stratum).alias("_stratum")).agg(F.count("*").alias("_n"))
    placed = place_within(rows, [stratum], order, "_i").join(sizes, F.col(stratum).eqNullSafe(F.col("_stratum")))
    step = F.greatest(F.lit(1), F.floor(F.col("_n") / most))
    return placed.filter((F.col("_i") % step == 0) & (F.floor(F.col("_i") / step) < most)).drop("_n", "_i", "_stratum")
