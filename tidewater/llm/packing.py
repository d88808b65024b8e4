"""Best-fit packing by minimum bin slack.

Pieces are grouped by length, of which there are fewer than the capacity; only that histogram reaches
the driver. There each pattern of a bin starts with the longest length left and is filled as far as
possible: a subset-sum over the lengths still available, one bit per reachable sum, longest first.
The fullest pattern is taken as often as its lengths last, which uses up at least one of them, so
there are at most ``capacity`` patterns whatever the number of pieces. Spark then numbers the pieces
of each length and looks every one up in that bounded table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bpe
from .shared import free_name, shuffle_parts, written

CAPACITY = 4096
END_ID = 1


def fullest(lengths: list[int], counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of ``lengths`` (descending, within ``counts``) with the largest sum up to ``room``; longer lengths win ties."""
    full = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in lengths:
        if length > room:
            continue
        left, size = min(counts[length], room // length), 1
        while left > 0:  # binary splitting: 1, 2, 4, ... copies at a time
            size = min(size, left)
            after = (reach | reach << (length * size)) & full
            if after != reach:
                steps.append((length, size, reach))
                reach = after
            left -= size
            size *= 2
        if reach >> room & 1:
            break
    at, used = reach.bit_length() - 1, {}
    for length, size, before in reversed(steps):
        if not before >> at & 1:
            at -= length * size
            used[length] = used.get(length, 0) + size
    return used


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Patterns (copies by length) and how often each is used, for pieces of 1 to ``capacity``; every piece is placed."""
    counts = {n: c for n, c in histogram.items() if c > 0}
    lengths = sorted(counts, reverse=True)
    out = []
    while lengths:
        first = lengths[0]
        counts[first] -= 1
        pattern = fullest(lengths, counts, capacity - first)
        counts[first] += 1
        pattern[first] = pattern.get(first, 0) + 1
        times = min(counts[n] // k for n, k in pattern.items())
        out.append((pattern, times))
        for n, k in pattern.items():
            counts[n] -= k * times
        lengths = [n for n in lengths if counts[n]]
    return out


def lookup(patterns: list[tuple[dict[int, int], int]]) -> pd.DataFrame:
    """One row for each length of each pattern: which numbers of that length it takes and where they go."""
    rows, taken, base = [], {}, 0
    for pattern, times in patterns:
        offset = 0
        for length in sorted(pattern, reverse=True):
            k = pattern[length]
            start = taken.get(length, 0)
            rows.append((length, start, k, base, offset))
            taken[length] = start + k * times
            offset += k * length
        base += times
    return pd.DataFrame(rows, columns=["length", "start", "copies", "base", "offset"]).sort_values(["length", "start"], ignore_index=True)


def pack(pieces: DataFrame, key: list[str], length_col: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` (long) to ``pieces``, each of 1 to ``capacity`` long; ``key`` tells rows apart.

    Rows with a null or smaller length get null for both. Rows with equal keys are placed one after
    the other. Places within a sequence are gapless from 0. ``pieces`` is read three times and should be a
    written table. A length that many rows share is numbered in as many parts as there are shuffle
    partitions, and more of them beyond 4 million rows each. Existing columns of the two names are replaced.
    """
    spark = pieces.sparkSession
    pieces = pieces.drop("sequence_id", "offset")
    salts = shuffle_parts(spark) + (pieces.count() >> 22)
    salt, rank, before, n, s = (free_name(pieces, x) for x in ("_salt", "_rank", "_before", "_n", "_s"))
    usable = F.col(length_col).between(1, capacity)
    salted = pieces.withColumn(salt, F.pmod(F.xxhash64(*key), F.lit(salts)).cast("int"))
    by_part = salted.filter(usable).groupBy(F.col(length_col).alias(n), F.col(salt).alias(s)).count()
    by_part = written(by_part, "piece-counts")
    histogram = {r[n]: r["c"] for r in by_part.groupBy(n).agg(F.sum("count").alias("c")).collect()}  # at most `capacity` rows
    table = lookup(plan(histogram, capacity))
    starts = by_part.select(n, s, (F.sum("count").over(Window.partitionBy(n).orderBy(s)) - F.col("count")).alias(before))
    numbered = (
        salted.withColumn(rank, F.row_number().over(Window.partitionBy(length_col, salt).orderBy(*key)) - 1)
        .join(starts, F.col(length_col).eqNullSafe(F.col(n)) & (F.col(salt) == F.col(s)), "left")
        .withColumn(rank, F.col(rank) + F.col(before))
        .drop(n, s, salt, before)
    )
    kept = [c for c in numbered.columns if c != rank]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in numbered.schema.fields if f.name != rank), "sequence_id long", "offset long"])
    lookups = spark.sparkContext.broadcast({c: table[c].to_numpy(np.int64) for c in table.columns})  # bounded: see above

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = lookups.value
        keys = (t["length"] << 44) + t["start"]
        for b in batches:
            if not len(keys):
                yield b[kept].assign(sequence_id=None, offset=None)
                continue
            known = b[rank].notna()
            size, r = b[length_col].where(known, 1).to_numpy(np.int64), b[rank].where(known, 0).to_numpy(np.int64)
            at = np.maximum(np.searchsorted(keys, (size << 44) + r, side="right") - 1, 0)
            nth, k = r - t["start"][at], t["copies"][at]
            sequence, offset = t["base"][at] + nth // k, t["offset"][at] + nth % k * size
            yield b[kept].assign(sequence_id=pd.Series(sequence, b.index).where(known), offset=pd.Series(offset, b.index).where(known))

    return numbered.mapInPandas(place, schema)


def cut(ids: DataFrame, ids_col: str = "ids", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of at most ``capacity`` ids of each row's ids with ``end_id`` behind them: piece, start, length, ids_crc32."""
    whole = ids.withColumn(ids_col, F.concat(F.coalesce(ids_col, F.lit(b"")), F.lit(end_id.to_bytes(4, "little"))))
    others = [c for c in ids.columns if c != ids_col]
    size = (F.octet_length(ids_col) / 4).cast("int")
    part = whole.select(*others, ids_col, F.explode(F.sequence(F.lit(0), ((size - 1) / capacity).cast("int"))).alias("piece"))
    part = part.withColumn(ids_col, F.substring(F.col(ids_col), F.col("piece") * (4 * capacity) + 1, F.lit(4 * capacity)))
    return part.select(
        *others,
        "piece",
        (F.col("piece").cast("long") * capacity).alias("start"),
        (F.octet_length(ids_col) / 4).cast("long").alias("length"),
        F.crc32(ids_col).alias("ids_crc32"),
    )


def query(docs: DataFrame, path: str) -> DataFrame:
    """Places of all pieces of all documents; null and empty texts are the end id alone."""
    pieces = written(cut(bpe.encode(docs.select("doc_id", "text"), path)), "pieces")
    return pack(pieces, ["doc_id", "piece"])
