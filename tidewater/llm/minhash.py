"""Links between texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Candidates share a band of MinHash values; each candidate pair is confirmed by its exact sets of
shingle hashes. Texts with equal sets are one node from the start. In a first round every member of a
bucket is held against the bucket's smallest. What the links of the first leave in different
components of a bucket is joined on prefixes: with the shingles of each set in one common order, rare
ones first, similar sets share one of their first fifth, so text that unlike documents have in common
makes no pairs. Buckets of near copies stay linear.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import star_table
from .shared import written

WORDS = 5
LEAST = 0.8
#: A pair of similarity s is a candidate with probability 1 - (1 - s^ROWS)^BANDS: 0.9996 at 0.8.
BANDS, ROWS = 20, 5
SEED = 42
#: Slots in which shingles are counted for their order; the order decides only how many pairs are tried.
SLOTS = 1 << 16
_PART = 2048
_FACTORS = np.random.default_rng(SEED).integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = np.random.default_rng(SEED + 1).integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The distinct hashes of a text's word runs in order; a text with fewer words is one run, one without words has none."""
    tokens = (text or "").encode("utf-8").lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    runs = zip(*(tokens[i:] for i in range(words))) if len(tokens) >= words else (tokens,)
    return np.unique(np.array([digest(join(run), SEED) for run in runs], np.uint64))


def bands(own: np.ndarray) -> list[int]:
    """A hash for each band of the smallest values under ROWS mixings."""
    if not len(own):
        return []
    least = np.full(len(_FACTORS), np.iinfo(np.uint64).max)
    for at in range(0, len(own), _PART):
        np.minimum(least, (_FACTORS[:, None] * own[at : at + _PART] + _SHIFTS[:, None]).min(axis=1), out=least)
    rows = least.reshape(BANDS, ROWS)
    return [xxhash.xxh64_intdigest(r.tobytes(), k) - (1 << 63) for k, r in enumerate(rows)]


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / max(1, len(a) + len(b) - both)


def signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, h, s, bands): the hash of a row's text, that of its set of shingles, and the hashes of the set's bands."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(2)
            s, found = [], []
            for i in range(b.num_rows):
                own = shingles(texts[i].as_py())
                s.append(xxhash.xxh64_intdigest(own.tobytes(), SEED) - (1 << 63))
                found.append(bands(own))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s, pa.int64()), pa.array(found, pa.list_(pa.int64()))], ["id", "h", "s", "bands"])

    rows = docs.select(F.col(id_col).alias("id"), text_hash(text_col).alias("h"), text_col)
    return rows.mapInArrow(run, f"id {kind}, h long, s long, bands array<long>")


def text_hash(text_col: str):
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def sets(wanted: DataFrame, nodes: DataFrame, docs: DataFrame, text_col: str) -> DataFrame:
    """(s, own): the sets of the nodes ``wanted`` (s), each from one text that has it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([shingles(texts[i].as_py()).tobytes() for i in range(b.num_rows)], pa.binary())], ["s", "own"])

    chosen = wanted.distinct().join(nodes, "s").select("s", "h")
    texts = docs.select(text_hash(text_col).alias("h"), F.col(text_col).alias("text")).join(chosen, "h").select("s", "text")
    return texts.dropDuplicates(["s"]).mapInArrow(run, "s long, own binary")


def confirmed(pairs: DataFrame, own: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose sets in ``own`` are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            left, right = b.column(2), b.column(3)
            near = [similarity(np.frombuffer(left[i].as_py(), np.uint64), np.frombuffer(right[i].as_py(), np.uint64)) >= LEAST for i in range(b.num_rows)]
            yield b.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    both = pairs.join(own.select(F.col("s").alias("a"), F.col("own").alias("x")), "a").join(own.select(F.col("s").alias("b"), F.col("own").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def slots(own: np.ndarray) -> np.ndarray:
    """The slot of each shingle."""
    return ((own * _FACTORS[0]) >> np.uint64(65 - SLOTS.bit_length())).astype(np.int64)


def prefix(own: np.ndarray, times: np.ndarray) -> np.ndarray:
    """The first shingles of a set in order of ``times`` of their slots: two sets that are similar enough share one of these."""
    return own[np.lexsort((own, times[slots(own)]))][: len(own) - math.ceil(LEAST * len(own) - 1e-9) + 1]


def prefixes(own: DataFrame) -> DataFrame:
    """(token, s, n, at): the first shingles of each set, its size, and where they stand."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times = np.zeros(SLOTS, np.int64)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                times += np.bincount(slots(np.frombuffer(b"".join(b.column(0).slice(at, 256).to_pylist()), np.uint64)), minlength=SLOTS)
        at = np.flatnonzero(times)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(times[at])], ["slot", "n"])

    rows = own.select("own").mapInArrow(counted, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect()  # at most SLOTS rows
    times = np.zeros(SLOTS, np.int64)
    for slot, n in rows:
        times[slot] = n
    del rows
    shared = own.sparkSession.sparkContext.broadcast(times)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                whole = np.frombuffer(b.column(1)[i].as_py(), np.uint64)
                first = prefix(whole, shared.value)
                n = len(first)
                fixed = (np.full(n, b.column(0)[i].as_py(), np.int64), np.full(n, len(whole), np.int32), np.arange(n, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (first.view(np.int64), *fixed)], ["token", "s", "n", "at"])

    return written(own.select("s", "own").mapInArrow(cut, "token long, s long, n int, at int"), "prefixes")


def across(firsts: DataFrame, roots: DataFrame, every: bool) -> DataFrame:
    """Pairs (a, b) of sets in ``firsts`` with different roots that share one of their first shingles and may be similar enough.

    If ``every``, all of them; else only those with the set in which a shingle stands first of all. The
    smaller set of a pair needs only the first ninth of its shingles. Where a common one stands bounds how
    many are common.
    """
    placed = firsts.join(roots.select(F.col("node").alias("s"), "root"), "s", "left").withColumn("root", F.coalesce("root", "s"))
    x, y = (placed.select("token", *(F.col(c).alias(c + k) for c in ("s", "root", "n", "at"))) for k in ("1", "2"))
    left = F.least(F.col("n1") - F.col("at1"), F.col("n2") - F.col("at2"))
    could = (F.least("n1", "n2") >= LEAST * F.greatest("n1", "n2") - 1e-9) & (left >= LEAST / (1 + LEAST) * (F.col("n1") + F.col("n2")) - 1e-9)
    if every:
        x = x.filter(F.col("at1") < F.col("n1") - F.ceil(2 * LEAST / (1 + LEAST) * F.col("n1") - 1e-9) + 1)
        could = could & ((F.col("n1") < F.col("n2")) | ((F.col("n1") == F.col("n2")) & (F.col("s1") < F.col("s2"))))
    else:
        x = x.groupBy("token").agg(F.min(F.struct("at1", "n1", "s1", "root1")).alias("x")).select("token", "x.*")
    found = x.join(y, (x["token"] == y["token"]) & (F.col("root1") != F.col("root2")) & could)
    return found.select(F.least("s1", "s2").alias("a"), F.greatest("s1", "s2").alias("b")).distinct()


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", whole: bool = False, alike: DataFrame | None = None) -> DataFrame:
    """(id, component_id) of every row of ``docs``; component_id is the smallest id that links lead to, null where no row has one.

    If ``whole``: (id, h, root), the hash of the row's text and its component instead. Texts whose hashes have one component_id in
    ``alike`` (h, component_id) are linked, too.
    """
    known = written(signatures(docs, id_col, text_col), "signatures")
    nodes = written(known.groupBy("s").agg(F.min("id").alias("first"), F.min("h").alias("h"), F.first("bands").alias("bands")), "nodes")
    buckets = nodes.select("s", F.explode("bands").alias("key"))
    several = buckets.groupBy("key").agg(F.min("s").alias("a"), F.max("s").alias("z")).filter("a <> z").drop("z")
    members = written(buckets.join(several, "key").select("key", "a", "s"), "buckets")
    tried = written(members.filter("a <> s").select("a", F.col("s").alias("b")).distinct(), "pairs")
    links = written(confirmed(tried, written(sets(tried.select(F.explode(F.array("a", "b")).alias("s")), nodes, docs, text_col), "shingle-sets")), "links")
    if alike is not None:
        placed = written(known.select("h", "s").distinct().join(alike, "h").select("component_id", "s").distinct(), "alike")
        least = placed.groupBy("component_id").agg(F.min("s").alias("a"))
        links = links.unionByName(placed.join(least, "component_id").filter("a <> s").select("a", F.col("s").alias("b")))
    roots = written(star_table(links), "roots")
    placed = members.select("key", "s").join(roots, members["s"] == roots["node"], "left").select("key", "s", F.coalesce("root", "s").alias("root"))
    apart = placed.groupBy("key").agg(F.min("root").alias("p"), F.max("root").alias("q")).filter("p <> q").select("key")
    apart = written(placed.join(apart, "key").select("s").distinct(), "nodes-apart")
    if not apart.isEmpty():
        own = written(sets(apart, nodes, docs, text_col), "shingle-sets")
        firsts = prefixes(own)
        for every in (False, True):  # the first round joins most of what belongs together, with no more pairs than shingles
            more = written(across(firsts, roots, every).join(tried, ["a", "b"], "left_anti"), "more-pairs")
            if more.isEmpty():
                continue
            tried = tried.unionByName(more)
            links = links.unionByName(written(confirmed(more, own), "more-links"))
            roots = written(star_table(links), "roots")
    linked = nodes.join(roots, nodes["s"] == roots["node"], "left").select("s", "first", F.coalesce("root", "s").alias("root"))
    if whole:
        return known.join(linked.select("s", "root"), "s").select("id", "h", "root")
    least = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    return known.join(linked.join(least, "root").select("s", "component_id"), "s").select(F.col("id").alias(id_col), "component_id")
