"""How five filters interact: a histogram of their failures, and what every order of them would remove.

A document's failures are five bits. Four are native expressions of its text alone; the fifth says that a
smaller id has the same text, for which texts are grouped by length and SHA-256. All that any order of the filters
removes follows from how many documents of a part have each of the 32 masks, so the orders are counted
on 32 cells a part, never on documents.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .rules import let, words_of
from .shared import written

FILTERS = "ABCDE"
MIN_WORDS = 50
MIN_DISTINCT_PERCENT = 65
MAX_UPPER_PERCENT = 5
SYMBOLS = r"[#$%&*|]"
ORDERS = ["".join(p) for p in permutations(FILTERS)]


def own_failures(text: Column) -> Column:
    """The failures that a text shows by itself, bits of A to D from the lowest; null counts as empty.

    A: under 50 words. B: 100 * different words < 65 * words. C: 100 * A-Z > 5 * code points. D: one of ``#$%&*|``.
    Words are runs between space and U+0009 to U+000D, compared with case.
    """
    text = F.coalesce(text, F.lit(""))
    few = let(words_of(text), lambda w: F.when(F.size(w) < MIN_WORDS, 1).otherwise(0) + F.when(100 * F.size(F.array_distinct(w)).cast("long") < MIN_DISTINCT_PERCENT * F.size(w).cast("long"), 2).otherwise(0))
    upper = F.when(100 * F.regexp_count(text, F.lit("[A-Z]")).cast("long") > MAX_UPPER_PERCENT * F.length(text).cast("long"), 4).otherwise(0)
    return few + upper + F.when(text.rlike(SYMBOLS), 8).otherwise(0)


def masks(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(id, part, mask, good, toxic): a row for each document with its five failures, E (the fifth bit) included.

    E: a smaller id has the identical text. A null id is neither smaller nor larger than any, and rows that repeat an id and its text
    fail E alike. A null part is ''. ``good`` and ``toxic`` tell whether some label of the id has quality 1 or toxic 1;
    labels of null ids belong to none. Only ids, parts, masks and digests are shuffled, texts never are.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    whole = F.concat(F.unhex(F.sha2(text, 256)), F.encode(F.octet_length(text).cast("string"), "UTF-8"))
    own = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col), F.lit("")).alias("part"), own_failures(F.col(text_col)).cast("tinyint").alias("mask"), whole.alias("text"))
    own = written(own, "masks")  # ids and digests, which both sides of the join below read
    first = own.filter("id is not null").groupBy("text").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    marks = labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
    marks = marks.agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    again = F.col("id").isNotNull() & F.col("first").isNull()
    found = own.join(first, ["id", "text"], "left").join(marks, "id", "left")
    mask = F.col("mask").cast("int") + F.when(again, 16).otherwise(0)
    return found.select(F.col("id").alias(id_col), "part", mask.alias("mask"), *(F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")))


def cells(masked: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): how many documents of a part have a mask; at most 32 rows a part."""
    return masked.groupBy("part", "mask").agg(F.count("*").alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))


def steps(spark: SparkSession) -> DataFrame:
    """(filter_order, step, bit, before): the 600 steps of all orders, each with its filter's bit and the bits of those before."""
    rows = []
    for order in ORDERS:
        bits = [1 << FILTERS.index(f) for f in order]
        rows += [f"{order},{k + 1},{bit},{sum(bits[:k])}" for k, bit in enumerate(bits)]
    fields = spark.range(1).select(F.explode(F.split(F.lit(" ".join(rows)), " ")).alias("row")).select(F.split("row", ",").alias("x"))
    return fields.select(F.get("x", F.lit(0)).alias("filter_order"), *(F.get("x", F.lit(i)).cast("int").alias(c) for i, c in enumerate(("step", "bit", "before"), 1)))


def audit(counted: DataFrame) -> DataFrame:
    """A row for each part, order of the filters and step of it, from ``cells``; see ``query`` for the columns.

    What a step does depends on its filter and on which ran before, not on their order: the cells are summed for the 80 such
    pairs, and the steps of the 120 orders, 600 rows whatever the input, look theirs up.
    """
    every = F.expr("explode(flatten(transform(array(1, 2, 4, 8, 16), b -> transform(filter(sequence(0, 31), m -> m & b = 0), m -> struct(b as bit, m as before)))))")
    tried = counted.select("*", every.alias("s")).select("part", "mask", "n", "good", "toxic", "s.bit", "s.before")
    fails, gone, alone = (F.col("mask").bitwiseAND(F.col("bit")) != 0, F.col("mask").bitwiseAND(F.col("before")) != 0, F.col("mask") == F.col("bit"))
    total = lambda c, when: F.sum(F.when(when, F.col(c)).otherwise(0))
    # A document of k failures is removed by each of them in 120 / k of the orders.
    share = F.sum(F.when(fails, F.expr(f"n * ({len(ORDERS)} div bit_count(mask))")).otherwise(0))
    sums = {"kept": total("n", ~fails & ~gone), "removed": total("n", fails & ~gone), "redundant": total("n", fails & gone), "unique_fails": total("n", alone)}
    sums |= {"good_lost": total("good", fails & ~gone), "toxic_lost": total("toxic", fails & ~gone), "shapley": share}
    states = tried.groupBy("part", "bit", "before").agg(*(c.cast("long").alias(k) for k, c in sums.items()))
    return states.join(F.broadcast(steps(counted.sparkSession)), ["bit", "before"]).select("part", "filter_order", "step", *sums)


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of ``documents``.

    For each part all 120 orders of A to E with their five steps: documents left after the step, removed by it, failing its
    filter but removed earlier, failing it alone, removed good and toxic ones, and what its filter removes summed over all orders.
    Parts without documents don't occur; an empty table gives no rows.
    """
    return audit(cells(masks(docs, labels)))
