"""SimHash near-duplicates with vantage-point trees.

A fingerprint bit is the majority of that bit over the hashes of a text's word shingles. Distinct
fingerprints are dealt to the leaves of a vantage-point tree: a node splits them at a Hamming
distance ``mu`` from its vantage point, and by the triangle inequality a fingerprint inside can only
have partners outside if its distance is above ``mu - radius``; those near the border are sent along
as queries. So every leaf finds its exact pairs by itself, in a tree of its own, and hands on no more
than one edge for each fingerprint. Components of these edges are joined back to the documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import minhash
from .components import star_table, stars
from .shared import free_name, written

SHINGLE_WORDS = 3
SEED = 42
RADIUS = 2
#: Distinct fingerprints that a leaf is meant to hold, and rows beyond which it is split again.
LEAF = 16_384
FULL = 1 << 20
#: How often, at most, and from how many fingerprints of a leaf; leaves that stay larger are searched all the same.
SPLITS, SPLIT_SAMPLE = 6, 1 << 13
#: Fingerprints from which the driver grows the tree; bounds its vantage points, not what is indexed.
SAMPLE = 1 << 17
SMALL = 768
_BLOCK = 1 << 16


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """The 64-bit fingerprint of a text: A-Z in lower case, words between ASCII white space; no word gives 0."""
    tokens = (text or "").encode("utf-8").lower().split()
    if not tokens:
        return 0
    total, ones, digest, join = max(1, len(tokens) - words + 1), np.zeros(64, np.int64), xxhash.xxh64_intdigest, b" ".join
    for at in range(0, total, _BLOCK):
        part = tokens[at : at + _BLOCK + words - 1]
        runs = zip(*(part[i:] for i in range(words))) if len(part) >= words else (part,)
        hashes = np.array([digest(join(run), SEED) for run in runs], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """(id, fp): the fingerprint of every row as a signed long (``fp_`` if the id is itself called ``fp``); null texts count as empty."""
    fp = free_name(docs.select(id_col), "fp")
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1)
            found = np.fromiter((fingerprint(texts[i].as_py(), words) for i in range(b.num_rows)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found.view(np.int64))], [id_col, fp])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, {fp} long")


def distance(a: np.ndarray, v: np.uint64) -> np.ndarray:
    return np.bitwise_count(a ^ v)


def grow(sample: np.ndarray, depth: int) -> list[tuple[int, int] | None]:
    """Vantage points and split distances of a tree ``depth`` levels deep, as a heap; None where nothing splits."""
    tree: list[tuple[int, int] | None] = [None] * (2**depth - 1)
    waiting = [(0, np.unique(sample))]
    rng = np.random.default_rng(0)
    while waiting:
        at, own = waiting.pop()
        if at >= len(tree) or len(own) < 4:
            continue
        v, d, mu = split(own, rng)
        tree[at] = (int(v), int(mu))
        waiting += [(2 * at + 1, own[d <= mu]), (2 * at + 2, own[d > mu])]
    return tree


def split(own: np.ndarray, rng: np.random.Generator) -> tuple[np.uint64, np.ndarray, int]:
    """The most even of a few vantage points, the distances to it, and where to split."""
    best = None
    for v in own[rng.integers(0, len(own), 4)]:
        d = distance(own, v)
        upto = np.bincount(d, minlength=65).cumsum()
        mu = int(np.abs(2 * upto - len(own)).argmin())
        worst = max(upto[mu], len(own) - upto[mu])
        if best is None or worst < best[0]:
            best = (worst, v, d, mu)
    return best[1:]


def deal(tree: list, fps: np.ndarray, radius: int, asked: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, bool]]:
    """(leaf, fingerprints, whether they are queries only): every one of ``fps`` is a member of one leaf, ``asked`` are queries from the start."""
    waiting = [(0, fps, fps[:0] if asked is None else asked)]
    while waiting:
        at, own, asked = waiting.pop()
        if not len(own) and not len(asked):
            continue
        if at >= len(tree) or tree[at] is None:
            if len(own):
                yield at, own, False
            if len(asked):
                yield at, asked, True
            continue
        v, mu = np.uint64(tree[at][0]), tree[at][1]
        d, e = distance(own, v), distance(asked, v)
        waiting.append((2 * at + 1, own[d <= mu], asked[e <= mu + radius]))
        waiting.append((2 * at + 2, own[d > mu], np.concatenate([asked[e > mu - radius], own[(d <= mu) & (d > mu - radius)]])))


def links(own: np.ndarray, asked: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Star edges that connect the distinct ``own`` and ``asked`` as their pairs within ``radius`` do (no pairs among ``asked``)."""
    rng, a, b, held = np.random.default_rng(0), [own[:0]], [own[:0]], 0
    waiting = [(own, asked)]
    while waiting:
        own, asked = waiting.pop()
        if not len(own):
            continue
        if len(own) > SMALL:
            v, d, mu = split(own, rng)
            if max((d <= mu).sum(), (d > mu).sum()) < 0.95 * len(own):
                e = distance(asked, v)
                waiting.append((own[d <= mu], asked[e <= mu + radius]))
                waiting.append((own[d > mu], np.concatenate([asked[e > mu - radius], own[(d <= mu) & (d > mu - radius)]])))
                continue
        rest = np.concatenate([own, asked])
        step = max(1, (1 << 20) // len(rest))
        for i in range(0, len(own), step):
            x, y = np.nonzero(np.bitwise_count(own[i : i + step, None] ^ rest[None, i:]) <= radius)
            keep = x != y
            a.append(own[i + x[keep]])
            b.append(rest[i + y[keep]])
            held += len(a[-1])
            if held > 1_000_000:
                p, q = stars(np.concatenate(a), np.concatenate(b))
                a, b, held = [p], [q], 0
    return stars(np.concatenate(a), np.concatenate(b))


def edges(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs of distinct ``fp`` within ``radius``."""
    n = distinct.count()
    depth = max(0, math.ceil(math.log2(max(1, n) / LEAF)))
    depth = min(depth, int(math.log2(SAMPLE // 16)))
    share = min(1.0, SAMPLE / max(1, n))
    picked = distinct.filter(F.pmod(F.xxhash64("fp"), F.lit(1 << 30)) < int(share * (1 << 30))).limit(SAMPLE) if depth else distinct.limit(0)
    tree = grow(np.array([r["fp"] for r in picked.select("fp").collect()], np.int64).view(np.uint64), depth)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for leaf, fps, only in deal(tree, b.column(0).to_numpy(zero_copy_only=False).view(np.uint64), radius):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(fps), leaf, np.int64)), pa.array(fps.view(np.int64)), pa.array(np.full(len(fps), only))], ["leaf", "fp", "asked"])

    def found(group: pd.DataFrame) -> pd.DataFrame:
        fps, only = group["fp"].to_numpy(np.int64).view(np.uint64), group["asked"].to_numpy(bool)
        a, b = links(np.unique(fps[~only]), np.unique(fps[only]), radius)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    sent = distinct.select("fp").mapInArrow(dealt, "leaf long, fp long, asked boolean")
    return _split_again(written(sent, "leaves"), radius).groupBy("leaf").applyInPandas(found, "a long, b long")


def _split_again(sent: DataFrame, radius: int) -> DataFrame:
    """``sent`` (leaf, fp, asked) with no leaf much over FULL: a large one is dealt by a tree of its own, in tasks of its own.

    Like the first tree, the others only decide where shards are cut. Leaves get new numbers by a hash;
    should two meet, they are searched as one.
    """

    def grown(group: pd.DataFrame) -> pd.DataFrame:
        depth = max(1, min(math.ceil(math.log2(group["n"].iloc[0] / LEAF)), int(math.log2(SPLIT_SAMPLE // 16))))
        tree = grow(group["fp"].to_numpy(np.int64).view(np.uint64), depth)
        points = [(np.array([t[0]], np.uint64).view(np.int64)[0], t[1]) if t else (0, -1) for t in tree]
        return pd.DataFrame({"leaf": [group["leaf"].iloc[0]], "salts": [group["salts"].iloc[0]], "points": [[p[0] for p in points]], "splits": [[p[1] for p in points]]})

    def parted(rows: pd.DataFrame, trees: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(trees):
            return pd.DataFrame({"old": [], "sub": [], "fp": [], "asked": []}).astype({"old": "int64", "sub": "int64", "fp": "int64", "asked": "bool"})
        tree = [(int(np.int64(p).view(np.uint64)), int(mu)) if mu >= 0 else None for p, mu in zip(trees["points"].iloc[0], trees["splits"].iloc[0])]
        fps, only = rows["fp"].to_numpy(np.int64).view(np.uint64), rows["asked"].to_numpy(bool)
        parts = [pd.DataFrame({"sub": leaf, "fp": own.view(np.int64), "asked": asked}) for leaf, own, asked in deal(tree, fps[~only], radius, fps[only])]
        return pd.concat(parts, ignore_index=True).assign(old=rows["leaf"].iloc[0])[["old", "sub", "fp", "asked"]]

    for _ in range(SPLITS):
        large = sent.groupBy("leaf").agg(F.count("*").alias("n"), F.count_if(~F.col("asked")).alias("own")).filter(F.col("n") > FULL)
        large = written(large.withColumn("salts", F.ceil(F.col("n") / FULL).cast("int")), "large-leaves")
        if large.isEmpty():
            break
        whole = sent.join(large, "leaf")
        sample = whole.filter(~F.col("asked") & (F.pmod(F.xxhash64("fp", F.lit("split")), F.lit(1 << 30)) < F.lit(float(SPLIT_SAMPLE << 30)) / F.col("own")))
        trees = sample.select("leaf", "fp", "n", "salts").groupBy("leaf").applyInPandas(grown, "leaf long, salts int, points array<long>, splits array<int>")
        trees = written(trees, "trees").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
        salted = whole.withColumn("salt", F.pmod(F.xxhash64("fp"), F.col("salts")).cast("int")).select("leaf", "salt", "fp", "asked")
        anew = salted.groupBy("leaf", "salt").cogroup(trees.groupBy("leaf", "salt")).applyInPandas(parted, "old long, sub long, fp long, asked boolean")
        rest = sent.join(large.select("leaf"), "leaf", "left_anti")
        sent = written(rest.unionByName(anew.select(F.xxhash64("old", "sub").alias("leaf"), "fp", "asked")), "leaves")
    return sent


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """(id, fp, component_id) of every row of ``docs``; component_id is the smallest id that links lead to.

    If the id has one of the other two names, that one gets an underscore.

    Texts without words have fingerprint 0 and are linked like any other. Rows with equal ids keep a row
    each. A null id takes part in links but is never the smallest, unless a component has no other.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    known = written(fingerprints(rows, "id", "text", words), "fingerprints")
    distinct = written(known.groupBy("fp").agg(F.min("id").alias("first")), "distinct-fingerprints")
    roots = written(star_table(edges(distinct, radius)), "roots")
    linked = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    out = known.join(linked.join(least, "root").select("fp", "component_id"), "fp")
    return out.select(F.col("id").alias(id_col), *(F.col(c).alias(c + "_" if c == id_col.lower() else c) for c in ("fp", "component_id")))


def query(docs: DataFrame) -> DataFrame:
    return groups(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` without near-duplicates: of each group the row with the smallest ``doc_id`` stays, of several the one whose
    text has the smallest hash; rows without an id stay.

    Texts are linked by their fingerprints, as ``groups`` finds them, and besides by five-word shingles with
    a similarity of 0.8 or more, which fingerprints of 64 bits can't tell apart at a radius that a tree can
    search. Of rows with equal ids and texts the one with the smallest hash of all columns stays.
    """
    own = {c: f"c{i}" for i, c in enumerate(docs.columns)}  # own names, so that none clashes
    rows = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in own.items()))
    doc_id, text = own["doc_id"], own["text"]
    hashes = rows.select(minhash.text_hash(text).alias("h"), F.col(text).alias("text"))
    alike = groups(hashes, "h").select("h", "component_id").distinct()
    grouped = minhash.groups(rows, doc_id, text, whole=True, alike=alike).filter(F.col("id").isNotNull())
    first = grouped.groupBy("root").agg(F.min(F.struct("id", "h")).alias("first")).select("first.id", "first.h").distinct()
    hashed = rows.withColumn("h", minhash.text_hash(text))
    kept = hashed.join(first, (F.col(doc_id) == F.col("id")) & (hashed["h"] == first["h"]), "left_semi")
    place = F.row_number().over(Window.partitionBy(doc_id, "h").orderBy(F.xxhash64(*own.values())))
    kept = kept.withColumn("place", place).filter("place = 1").select(*own.values())
    out = kept.unionByName(rows.filter(F.col(doc_id).isNull()))
    return out.select(*(F.col(n).alias(c) for c, n in own.items()))
