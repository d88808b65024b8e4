"""Canonical exact fingerprints, native.

The canonical form is compatibility composition (NFKC), full case folding and folded white space, by
static functions of the JVM's own Unicode library. Its fingerprint is 128 bits wide: XXH64 of the
form, and of the form behind a prefix. Rows with equal fingerprints form a bucket; within a bucket
the bytes of the canonical forms decide, so a collision would not join two texts.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import free_name, parts, written

#: Bytes of text that one range of ids holds about, see ``followed``.
RANGE_BYTES = 128 << 20
_SPACE = r"[\s\x1c-\x1f\x85\p{Z}]+"


def canonical(text: Column) -> Column:
    """NFKC, case folded, NFKC again (folding can undo it), white space runs as one space, none at the ends; null as empty."""
    nfkc = lambda c: F.call_function("java_method", F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), c, F.lit(True))
    fold = lambda c: F.call_function("java_method", F.lit("com.ibm.icu.lang.UCharacter"), F.lit("foldCase"), c, F.lit(True))
    text = F.coalesce(text, F.lit(""))
    plain = F.lower(text)  # for ASCII all of the above is lower case
    folded = F.when(F.octet_length(text) == F.length(text), plain).otherwise(nfkc(fold(nfkc(text))))
    return F.trim(F.regexp_replace(folded, _SPACE, " "))


def wide_hash(form: Column) -> Column:
    """32 hex digits of two XXH64 values."""
    return F.lower(F.concat(F.lpad(F.hex(F.xxhash64(form)), 16, "0"), F.lpad(F.hex(F.xxhash64(F.lit("second"), form)), 16, "0")))


def fingerprints(docs: DataFrame, text_col: str = "text", out: str = "fingerprint") -> DataFrame:
    """Adds ``out`` to ``docs``: equal canonical forms have equal fingerprints. Null texts count as empty; a column ``out`` (names are compared without case) is replaced."""
    return docs.withColumn(out, wide_hash(canonical(F.col(text_col))))


def buckets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, list[str]]:
    """(fingerprint, group_id) of all canonical forms, written, and the fingerprints under which different forms met.

    A bucket whose smallest and largest form are the same bytes is one group; these extremes are
    combined before they are shuffled, so a bucket may hold any share of the rows. Collisions of 128
    bits are listed on the driver: there is about one among 10**19 forms.
    """
    rows = docs.select(F.col(id_col).alias("id"), canonical(F.col(text_col)).alias("form")).withColumn("fingerprint", wide_hash(F.col("form")))
    extremes = rows.groupBy("fingerprint").agg(F.min("id").alias("group_id"), F.min("form").alias("low"), F.max("form").alias("high"))
    table = written(extremes.select("fingerprint", "group_id", (F.col("low") == F.col("high")).alias("same")), "digest-buckets")
    mixed = [r["fingerprint"] for r in table.filter("not same").select("fingerprint").collect()]
    if mixed:
        apart = rows.filter(F.col("fingerprint").isin(mixed)).withColumn("fingerprint", resolved(F.col("fingerprint"), F.col("form"), mixed))
        table = table.unionByName(apart.groupBy("fingerprint").agg(F.min("id").alias("group_id"), F.lit(True).alias("same")))
    return table.filter("same").select("fingerprint", "group_id"), mixed


def resolved(fingerprint: Column, form: Column, mixed: list[str]) -> Column:
    """``fingerprint``, with a SHA-256 digest behind it where different forms share it."""
    return F.when(fingerprint.isin(mixed), F.concat(fingerprint, F.sha2(form.cast("binary"), 256))).otherwise(fingerprint) if mixed else fingerprint


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint, group_id): group_id is the smallest id of the rows whose canonical forms have the same bytes.

    A null id is never the smallest, unless a group has no other. Each row stays a row. Where the id is
    itself called ``fingerprint`` or ``group_id``, the new column of that name gets an underscore.
    """
    table, mixed = buckets(docs, id_col, text_col)
    form = canonical(F.col(text_col))
    own = docs.select(F.col(id_col).alias("id"), resolved(wide_hash(form), form, mixed).alias("fingerprint"))
    names = [free_name(docs.select(id_col), c) for c in ("fingerprint", "group_id")]
    return own.join(table, "fingerprint").select(F.col("id").alias(id_col), *(F.col(c).alias(n) for c, n in zip(("fingerprint", "group_id"), names)))


def followed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(id, text, fingerprint, next_text, next_fingerprint): the row that follows in descending order of the id; after the last the first.

    Null ids come last, equal ids (nulls too) in the order of the XXH64 values of their texts, then of the
    texts; null texts count as empty. Rows are dealt out once, to ranges of about ``range_bytes``: between
    quantiles of the id, and by the hash within an id that is several quantiles, or null. Within a range a
    window finds the follower; the last row of each range gets the first row of the next. What comes to
    the driver is one row for each range.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    size, unnamed = rows.agg(*(F.coalesce(F.sum(F.when(c, F.octet_length("text"))), F.lit(0)) for c in (F.lit(True), F.col("id").isNull()))).first()
    n = parts(spark, size, range_bytes)
    cuts = docs.agg(F.percentile_approx(id_col, [i / n for i in range(1, n)], 10 * n)).first()[0] if n > 1 else []
    times = Counter(cuts or [])
    bounds, wide = sorted(times), {i: k for i, k in times.items() if k > 1}
    # A row's place among the bounds, by chunks of them, and among the ranges of its own id.
    longs = lambda xs: F.split(F.lit(",".join(map(str, xs))), ",").cast("array<bigint>") if xs else F.array().cast("array<bigint>")
    up_to = lambda xs: F.size(F.filter(xs, lambda x: x <= F.col("id")))
    chunk = math.isqrt(len(bounds)) + 1
    full = up_to(longs(bounds[chunk - 1 :: chunk]))
    above = len(bounds) - (full * chunk + up_to(F.slice(longs(bounds), full * chunk + 1, chunk)))
    piece = lambda k: 1 + F.floor((F.shiftright("h", 40) + (1 << 23)) * k / (1 << 24))
    own = F.coalesce(piece(F.element_at(F.map_from_arrays(longs(list(wide)), longs(list(wide.values()))), F.col("id"))), F.lit(0)) if wide else F.lit(0)
    split = unnamed // range_bytes + 1
    part = F.when(F.col("id").isNull(), F.lit(n) * n + piece(split)).otherwise(above * F.lit(n) + own).cast("long")  # an id has n - 1 ranges at most
    whole = rows.withColumn("part", part)
    heads = sorted((r["part"], r["id"]) for r in whole.groupBy("part").agg(F.max("id").alias("id")).collect())
    printed = lambda df: df.withColumn("fingerprint", wide_hash(canonical(F.col("text"))))
    within = Window.partitionBy("part").orderBy(F.col("id").desc_nulls_last(), "h", "text")
    led = printed(whole).withColumns({"next_text": F.lead("text").over(within), "next_fingerprint": F.lead("fingerprint").over(within)})
    after = [(p, *heads[(i + 1) % len(heads)]) for i, (p, _) in enumerate(heads)]
    table = spark.createDataFrame(after, "part long, next_part long, next_id long")  # three numbers for each range
    first = whole.join(F.broadcast(table.select("next_part", "next_id")), (F.col("part") == F.col("next_part")) & F.col("id").eqNullSafe(F.col("next_id")))
    first = printed(first.groupBy("next_part").agg(F.min(F.struct("h", "text"))["text"].alias("text")))
    first = table.join(first, "next_part").select("part", F.col("text").alias("first_text"), F.col("fingerprint").alias("first_fingerprint"))
    return led.join(first, "part", "left").select(
        "id", "text", "fingerprint", F.coalesce("next_text", "first_text").alias("next_text"), F.coalesce("next_fingerprint", "first_fingerprint").alias("next_fingerprint")
    )


def edited(text: Column, follower: Column) -> Column:
    """``text`` with its last third of code points replaced by as many, or all, of ``follower``'s first."""
    k = F.floor(F.length(text) / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - k), F.substring(follower, F.lit(1), k))


def alike(fingerprint: Column, other: Column, text: Column, other_text: Column) -> Column:
    """1.0 if the fingerprints and then the canonical bytes are equal, else 0.0."""
    return F.when(fingerprint == other, (canonical(text) == canonical(other_text)).cast("double")).otherwise(F.lit(0.0))


def query(docs: DataFrame) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, with the group of each document."""
    docs = docs.select("doc_id", "text")
    table, mixed = buckets(docs)
    rows = followed(docs)
    rows = rows.withColumn("edited", edited(F.col("text"), F.col("next_text"))).withColumn("edited_fingerprint", wide_hash(canonical(F.col("edited"))))
    exact = lambda print_col, text_col: resolved(F.col(print_col), canonical(F.col(text_col)), mixed)
    out = rows.select(
        F.col("id").alias("doc_id"),
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        exact("fingerprint", "text").alias("fingerprint"),
        exact("edited_fingerprint", "edited").alias("edited_fingerprint"),
        alike(F.col("fingerprint"), F.col("edited_fingerprint"), F.col("text"), F.col("edited")).alias("near_edited"),
        alike(F.col("fingerprint"), F.col("next_fingerprint"), F.col("text"), F.col("next_text")).alias("near_next"),
    )
    return out.join(table, "fingerprint").select(*out.columns, "group_id")
