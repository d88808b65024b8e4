"""Ranked lexical search over a document-partitioned index of two levels.

The index is a table of blocks of documents. Its first level holds, for each term and document, the term's impact rounded up to
a byte; its second level holds the occurrences from which exact scores follow. A search reads the first level
for what every document scores at least, which gives each query the k-th largest of these lower bounds; then it
reads both levels and scores exactly, in integers, every document whose upper bound reaches that. Tasks keep their
k best of each query, so what moves doesn't grow with the documents of a task.

The index holds the terms that some query asks for; document frequencies, counts and lengths are those of all documents.
Queries come in passes of bounded size, each with an index of its own terms.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import written

K = 50
#: A block of documents ends with so many bytes of text or documents.
BLOCK_BYTES, BLOCK_DOCS = 4 << 20, 4096
#: A pass over the documents ends with so many queries, different terms or bytes of queries.
PASS_QUERIES, PASS_TERMS, PASS_BYTES = 1024, 1 << 17, 8 << 20
#: Cells of the matrices that a task multiplies, 8 bytes each.
CELLS = 1 << 22
_CHUNK = 4 << 20
_SALTS = 32
#: Letters and digits of ASCII, A-Z in lower case, and all other bytes of UTF-8 stay; the rest parts terms.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_ONE = 1_000_000  # no impact of weight 1 reaches this
_Q = np.arange(256, dtype=np.int64)
#: The largest and smallest impacts of weight 1 that a byte stands for.
UPPER, LOWER = _Q * _ONE // 255, np.maximum(_Q - 1, 0) * _ONE // 255


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text, in lists of about _CHUNK bytes."""
    data, at = text.translate(_TERM_BYTES), 0
    while at < len(data):
        end = data.find(b" ", at + _CHUNK) if at + _CHUNK < len(data) else -1
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Impacts of weight 1: 10^9 tf div (1000 tf + 20 m)."""
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def rounded_up(u: np.ndarray) -> np.ndarray:
    """Impacts of weight 1 as bytes: the least that stands for as much or more."""
    return ((255 * u + _ONE - 1) // _ONE).astype(np.uint8)


BLOCKS = pa.schema([("ids", pa.list_(pa.int64())), ("sizes", pa.binary()), ("per_doc", pa.binary()), ("terms", pa.binary()), ("tf", pa.binary()), ("n_docs", pa.int64()), ("n_terms", pa.int64())])
_BLOCKS = "ids array<long>, sizes binary, per_doc binary, terms binary, tf binary, n_docs long, n_terms long"


def counted(batches: Iterator[pa.RecordBatch], vocabulary: bytes) -> Iterator[pa.RecordBatch]:
    """Blocks of documents: their lengths, and the numbers and occurrences of the vocabulary's terms in each."""
    numbers = {t: i for i, t in enumerate(vocabulary.split())}
    ids: list[int | None] = []
    sizes: list[int] = []
    found: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0

    def row() -> pa.RecordBatch:
        nonlocal held
        own = [np.concatenate([x[k] for x in found]) if found else np.zeros(0, np.int64) for k in (0, 1)]
        per_doc = np.array([len(x[0]) for x in found], np.int64)
        n = np.array(sizes, np.int64)
        values = (list(ids), n.tobytes(), per_doc.tobytes(), own[0].astype(np.uint32).tobytes(), own[1].tobytes(), int((n > 0).sum()), int(n.sum()))
        held = 0
        ids.clear(), sizes.clear(), found.clear()
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, BLOCKS)], schema=BLOCKS)

    for b in batches:
        for i in range(b.num_rows):
            data, n, codes = b.column(1)[i].as_py(), 0, [np.zeros(0, np.int64)]
            for words in terms_of(data):
                n += len(words)
                code = np.fromiter(map(numbers.get, words, repeat(-1)), np.int64, len(words))
                codes.append(code[code >= 0])
            ids.append(b.column(0)[i].as_py())
            sizes.append(n)
            found.append(np.unique(np.concatenate(codes), return_counts=True))
            held += len(data)
            if held >= BLOCK_BYTES or len(ids) >= BLOCK_DOCS:
                yield row()
    if ids:
        yield row()


def frequencies(batches: Iterator[pa.RecordBatch], n_terms: int) -> Iterator[pa.RecordBatch]:
    """(term, n): in how many of a task's documents each term occurs."""
    df = np.zeros(n_terms, np.int64)
    for b in batches:
        for blob in b.column(0):
            df += np.bincount(np.frombuffer(blob.as_py(), np.uint32), minlength=n_terms)
    at = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], ["term", "n"])


def quantised(batches: Iterator[pa.RecordBatch], n_docs: int, n_terms: int) -> Iterator[pa.RecordBatch]:
    """Blocks with the lengths' m and with byte impacts."""
    for b in batches:
        for r in b.to_pylist():
            m = 100 - 50 + (50 * np.frombuffer(r["sizes"], np.int64) * n_docs) // max(n_terms, 1)
            tf = np.frombuffer(r["tf"], np.int64)
            q = rounded_up(impact(tf, np.repeat(m, np.frombuffer(r["per_doc"], np.int64))))
            values = [r["ids"], m.tobytes(), r["per_doc"], r["terms"], q.tobytes(), r["tf"]]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, (pa.list_(pa.int64()), *[pa.binary()] * 5))], ["ids", "m", "per_doc", "terms", "q", "tf"])


class Queries:
    """Some queries as a matrix of the weights of their terms."""

    def __init__(self, first: int, items: list[np.ndarray], weights: np.ndarray):
        self.first = first
        self.terms = np.unique(np.concatenate(items))
        self.own = [np.searchsorted(self.terms, t) for t in items]
        self.weights = weights[self.terms]
        self.matrix = np.zeros((len(self.terms), len(items)))
        for k, at in enumerate(self.own):
            self.matrix[at, k] = self.weights[at]


def in_matrices(items: list[np.ndarray], weights: np.ndarray) -> list[Queries]:
    """All queries, as many in a matrix as CELLS allows (one at least); queries without terms are left out."""
    out, now, first, size = [], [], 0, 0
    for k, t in enumerate(items):
        if now and (size + len(t)) * (len(now) + 1) > CELLS:
            out.append(Queries(first, now, weights))
            now, size = [], 0
        if not now:
            first = k
        now, size = [*now, t], size + len(t)
    return out + ([Queries(first, now, weights)] if now else [])


def _dense(rows: slice, starts: np.ndarray, terms: np.ndarray, values: np.ndarray, queries: Queries) -> np.ndarray:
    """The values of some documents as a matrix over the queries' terms."""
    a, b = starts[rows.start], starts[rows.stop]
    at = np.searchsorted(queries.terms, terms[a:b])
    at[at == len(queries.terms)] = 0
    hit = queries.terms[at] == terms[a:b]
    doc = np.repeat(np.arange(rows.stop - rows.start), np.diff(starts[rows.start : rows.stop + 1]))
    out = np.zeros((rows.stop - rows.start, len(queries.terms)), values.dtype)
    out[doc[hit], at[hit]] = values[a:b][hit]
    return out


def _slices(n_docs: int, width: int) -> Iterator[slice]:
    step = max(1, CELLS // max(width, 1))
    for a in range(0, n_docs, step):
        yield slice(a, min(n_docs, a + step))


def lower_bounds(batches: Iterator[pa.RecordBatch], items: list[np.ndarray], weights: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    """(item, salt, bound): the k largest lower bounds above 0 of a task's documents, for each query."""
    groups = in_matrices(items, weights)
    best = np.zeros((len(items), k))
    for b in batches:
        for r in b.to_pylist():
            starts = np.concatenate([[0], np.cumsum(np.frombuffer(r["per_doc"], np.int64))])
            terms, values = np.frombuffer(r["terms"], np.uint32), LOWER[np.frombuffer(r["q"], np.uint8)].astype(np.float64)
            for g in groups:
                own = slice(g.first, g.first + len(g.own))
                for rows in _slices(len(starts) - 1, len(g.terms)):
                    bounds = np.concatenate([best[own], (_dense(rows, starts, terms, values, g) @ g.matrix).T], axis=1)
                    best[own] = np.partition(bounds, bounds.shape[1] - k, axis=1)[:, -k:]
    item, place = np.nonzero(best > 0)
    salt = np.full(len(item), TaskContext.get().partitionId() % _SALTS, np.int32)
    yield pa.RecordBatch.from_arrays([pa.array(item.astype(np.int32)), pa.array(salt), pa.array(best[item, place].astype(np.int64))], ["item", "salt", "bound"])


def exact(batches: Iterator[pa.RecordBatch], items: list[np.ndarray], weights: np.ndarray, reach: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    """(item, salt, doc_id, score): of the documents whose upper bounds reach ``reach``, a task's k best of each query."""
    groups = in_matrices(items, weights)
    kept: list[tuple[np.ndarray, ...]] = [(np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))] * len(items)
    for b in batches:
        for r in b.to_pylist():
            per_doc, m, tf = (np.frombuffer(r[c], np.int64) for c in ("per_doc", "m", "tf"))
            starts = np.concatenate([[0], np.cumsum(per_doc)])
            terms, upper = np.frombuffer(r["terms"], np.uint32), UPPER[np.frombuffer(r["q"], np.uint8)].astype(np.float64)
            unknown = np.array([i is None for i in r["ids"]], bool)
            ids = np.array([i or 0 for i in r["ids"]], np.int64)
            whole = impact(tf, np.repeat(m, per_doc))
            for g in groups:
                for rows in _slices(len(starts) - 1, len(g.terms)):
                    bounds = _dense(rows, starts, terms, upper, g) @ g.matrix
                    hits = bounds >= np.maximum(reach[g.first : g.first + len(g.own)], 1)
                    if not hits.any():
                        continue
                    impacts = _dense(rows, starts, terms, whole, g)
                    for j in np.flatnonzero(hits.any(axis=0)).tolist():
                        at = np.flatnonzero(hits[:, j])
                        own = g.own[j]
                        scores = impacts[np.ix_(at, own)] @ g.weights[own]  # integers all the way
                        at, scores = at[scores > 0] + rows.start, scores[scores > 0]
                        found = [np.concatenate(x) for x in zip(kept[g.first + j], (scores, unknown[at], ids[at]))]
                        order = np.lexsort((found[2], found[1], -found[0]))[:k]
                        kept[g.first + j] = tuple(x[order] for x in found)
    salt = TaskContext.get().partitionId() % _SALTS
    item = np.repeat(np.arange(len(kept), dtype=np.int32), [len(x[0]) for x in kept])
    score, unknown, ids = (np.concatenate([x[c] for x in kept]) if kept else np.zeros(0, np.int64) for c in range(3))
    yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(np.full(len(item), salt, np.int32)), pa.array(ids, mask=unknown.astype(bool)), pa.array(score)], ["item", "salt", "doc_id", "score"])


def _best(rows: DataFrame, order: list, k: int) -> DataFrame:
    """The first k of each item with their ``rank``, in two steps, so that no task sorts what all tasks found for an item."""
    place = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    some = rows.withColumn("rank", place("item", "salt")).filter(F.col("rank") <= k)
    return some.withColumn("rank", place("item")).filter(F.col("rank") <= k)


def _passes(queries: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """The queries with their different terms, a pass at a time; the driver holds one pass."""
    now, terms, size = [], set(), 0
    for r in queries.select(F.col(id_col).cast("long"), F.coalesce(F.col(text_col), F.lit("")).cast("binary")).toLocalIterator():
        own = sorted({t for words in terms_of(bytes(r[1])) for t in words})
        if now and (len(now) >= PASS_QUERIES or size + len(r[1]) > PASS_BYTES or len(terms) + len(own) > PASS_TERMS):
            yield now
            now, terms, size = [], set(), 0
        if own:
            now.append((r[0], own))
            terms.update(own)
            size += len(r[1])
    if now:
        yield now


def search(docs: DataFrame, queries: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents of the highest scores above 0 for each query.

    Terms are the longest runs of ASCII letters and digits and of all characters beyond ASCII, with A-Z in lower case. N documents
    have a term, L terms with repeats have all documents; a document has n and a term tf times; df documents have the term. Its weight
    is floor(1000 ln((2 N + 2) / (2 df + 1))) and the document's m is 50 + 50 n N div L; it scores the sum, over the query's different
    terms, of weight * (10^9 tf div (1000 tf + 20 m)). Equal scores go by ascending id, null ids last. Null and wordless texts
    have no terms: such documents are never found, such queries find none. Rows that repeat an id are documents of their own, and
    so are queries. Ids of both tables are integers. Other columns don't matter, whatever their names.
    """
    spark, out = docs.sparkSession, None
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("data"))
    for now in _passes(queries, item_col, item_text_col):
        found = _search(rows, now, k)
        out = found if out is None else out.unionByName(found)
    schema = "item_id long, rank int, doc_id long, score long"
    out = spark.createDataFrame([], schema) if out is None else out.select("item_id", "rank", "doc_id", "score")
    return out.withColumnsRenamed({"item_id": item_col, "doc_id": id_col})


def _search(rows: DataFrame, queries: list[tuple[int | None, list[bytes]]], k: int) -> DataFrame:
    """One pass: the index of its queries' terms, the bounds, the exact scores."""
    spark = rows.sparkSession
    vocabulary = sorted({t for _, own in queries for t in own})
    number = {t: i for i, t in enumerate(vocabulary)}
    items = [np.array([number[t] for t in own], np.int64) for _, own in queries]
    blob = b" ".join(vocabulary)
    blocks = written(rows.mapInArrow(lambda b: counted(b, blob), _BLOCKS), "search-blocks")
    n_docs, n_terms = (x or 0 for x in blocks.agg(F.sum("n_docs"), F.sum("n_terms")).first())
    df = np.zeros(len(vocabulary), np.int64)
    size = len(vocabulary)
    for r in blocks.select("terms").mapInArrow(lambda b: frequencies(b, size), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        df[r["term"]] = r["n"]  # at most PASS_TERMS and a query's own
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    two_levels = "ids array<long>, m binary, per_doc binary, terms binary, q binary, tf binary"
    index = written(blocks.select("ids", "sizes", "per_doc", "terms", "tf").mapInArrow(lambda b: quantised(b, n_docs, n_terms), two_levels), "search-index")
    bounds = index.select("per_doc", "terms", "q").mapInArrow(lambda b: lower_bounds(b, items, weights, k), "item int, salt int, bound long")
    reach = np.zeros(len(items))
    for r in _best(bounds, [F.desc("bound")], k).filter(F.col("rank") == k).collect():
        reach[r["item"]] = r["bound"]  # one number for each query of the pass
    scored = index.mapInArrow(lambda b: exact(b, items, weights, reach, k), "item int, salt int, doc_id long, score long")
    names = [i for i, _ in queries]
    ids = spark.createDataFrame(list(enumerate(names)), "item int, item_id long")
    best = _best(scored, [F.desc("score"), F.col("doc_id").asc_nulls_last()], k)
    return best.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")


def query(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The 50 best of all ``documents`` for each ``benchmark`` item."""
    return search(docs, items)
