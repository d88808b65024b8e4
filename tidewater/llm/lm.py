"""Language-model scores by stupid backoff, from n-gram counts of the whole corpus.

Each document is scored by the counts of all other documents. Every task packs the texts it reads into
blocks of word numbers, so texts are split and hashed once. For each order, a block sends its different
n-grams, as hashes and with their counts, to the shards of the count table, which are partitioned by
hash; the shards add up and join the totals back to what each block asked for. An n-gram that other
documents hold has both of its shorter parts in other documents, so higher orders ask only for those.
The block then sums the scores of each document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import free_name, parts, text_bytes

ORDER = 3
BACKOFF = 0.4
BLOCK_BYTES = 8 << 20
SHARD_BYTES = 16 << 20
_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


class _Numbers(dict):
    """Numbers of words in the order in which they are first asked for."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _cuts(data: bytes, size: int = 1 << 22) -> Iterator[slice]:
    """Slices of about ``size`` bytes that end at spaces or line ends."""
    at = 0
    while at < len(data):
        end = at + size
        if end < len(data):
            found = [p for p in (data.find(b" ", end), data.find(b"\n", end)) if p >= 0]
            end = min(found, default=len(data))
        yield slice(at, end)
        at = end


BLOCKS = pa.schema([("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("sizes", pa.binary()), ("vocabulary", pa.binary()), ("n", pa.int64()), ("codes", pa.binary())])


def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of documents: ids, words of each, hashes of the different words, and the words as numbers of these."""
    first = TaskContext.get().partitionId() << 32
    ids: list[int | None] = []
    sizes: list[int] = []
    codes: list[np.ndarray] = []
    numbers, held = _Numbers(), 0

    def row() -> pa.RecordBatch:
        nonlocal numbers, held, first
        vocabulary = np.fromiter(map(xxhash.xxh64_intdigest, numbers), np.uint64, len(numbers))
        flat = np.concatenate([np.zeros(0, np.uint32), *codes])
        planes = _pack(np.ascontiguousarray(flat.view(np.uint8).reshape(-1, 4).T))
        values = (first, list(ids), np.array(sizes, np.int64).tobytes(), vocabulary.tobytes(), len(flat), planes)
        numbers, held, first = _Numbers(), 0, first + 1
        ids.clear(), sizes.clear(), codes.clear()
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, BLOCKS)], schema=BLOCKS)

    for b in batches:
        for i in range(b.num_rows):
            data, n = b.column(1)[i].as_py().lower(), 0
            for at in _cuts(data):
                words = data[at].split()
                codes.append(np.fromiter(map(numbers.__getitem__, words), np.uint32, len(words)))
                n += len(words)
            ids.append(b.column(0)[i].as_py())
            sizes.append(n)
            held += len(data)
            if held >= BLOCK_BYTES:
                yield row()
    if ids:
        yield row()


class Level:
    """The places of n-grams in use, by n-gram and place, and what their different n-grams are."""

    def __init__(self, block: Block, n: int, below: Level | None, counts: np.ndarray | None):
        use = block.left >= n
        if below is not None and len(use):
            use &= (counts > 0) & np.append(counts[1:] > 0, False)
        at = np.flatnonzero(use)
        # What comes before the last word and the last word tell n-grams apart.
        key = block.codes[at + n - 1] if below is None else below.rank[at] * len(block.vocabulary) + block.codes[at + n - 1]
        bits = max(1, len(use).bit_length())
        if len(key) and int(key.max()).bit_length() + bits > 63:
            key = np.unique(key, return_inverse=True)[1].astype(np.int64)
        mixed = np.sort(key << bits | at)
        self.at, key = mixed & ((1 << bits) - 1), mixed >> bits
        first = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
        starts = np.flatnonzero(first)
        self.counts = np.diff(np.append(starts, len(key)))
        self.rank = np.full(len(use), -1, np.int64)
        self.rank[self.at] = np.cumsum(first) - 1
        doc = block.doc[self.at]
        own = np.flatnonzero(first | np.concatenate([[True], doc[1:] != doc[:-1]])) if len(key) else starts
        times = np.diff(np.append(own, len(key)))
        self.per_doc = np.repeat(times, times)
        hashes = block.hashes(self.at[starts], n)
        self.order = np.argsort(hashes)
        self.grams = hashes[self.order]

    def others(self, totals: np.ndarray) -> np.ndarray:
        """For each place, how often other documents hold its n-gram; ``totals`` are in order of the hashes."""
        by_rank, out = np.empty(len(totals), np.int64), np.zeros(len(self.rank), np.int64)
        by_rank[self.order] = totals
        out[self.at] = np.repeat(by_rank, self.counts) - self.per_doc
        return out


class Block:
    """The words of a block's documents behind each other."""

    def __init__(self, table: pa.Table):
        row = table.select(BLOCKS.names).to_pylist()[0]
        self.number, self.ids = row["block"], row["ids"]
        self.sizes, self.vocabulary = np.frombuffer(row["sizes"], np.int64), np.frombuffer(row["vocabulary"], np.uint64)
        n = row["n"]
        planes = pa.decompress(row["codes"], 4 * n, codec="zstd", asbytes=True) if n else b""
        self.codes = np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, n).T).view(np.uint32).ravel().astype(np.int64)
        self.doc = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.left = np.repeat(np.cumsum(self.sizes), self.sizes) - np.arange(n)  # words from here to the document's end

    def hashes(self, places: np.ndarray, n: int) -> np.ndarray:
        """The hashes of the n-grams at ``places``."""
        h = self.vocabulary[self.codes[places]]
        for k in range(1, n):
            h = h * _ODD + self.vocabulary[self.codes[places + k]]
            h ^= h >> np.uint64(29)
            h *= _MIX
            h ^= h >> np.uint64(32)
        return h


def _pack(values: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(values), codec="zstd", asbytes=True) if len(values) else b""


def _unpack(blob: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(blob, 8 * n, codec="zstd", asbytes=True), np.int64) if n else np.zeros(0, np.int64)


def _planes(values: np.ndarray) -> bytes:
    """Sorted hashes as differences, byte by byte, so that what is alike lies together."""
    return _pack(np.ascontiguousarray(np.diff(values, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T))


def _from_planes(blob: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.uint64)
    raw = np.frombuffer(pa.decompress(blob, 8 * n, codec="zstd", asbytes=True), np.uint8).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(raw.T).view(np.uint64).ravel(), dtype=np.uint64)


def _cut(grams: np.ndarray, shards: int) -> np.ndarray:
    """Where each shard's part of sorted hashes begins, and the end: shards are ranges of the hash."""
    bounds = [(i << 64) // shards for i in range(1, shards)]
    return np.concatenate([[0], np.searchsorted(grams, np.array(bounds, np.uint64)), [len(grams)]])


ASKED = pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("n", pa.int64()), ("grams", pa.binary()), ("counts", pa.binary())])
TOLD = pa.schema([("block", pa.int64()), ("level", pa.int32()), ("shard", pa.int32()), ("n", pa.int64()), ("words", pa.int64()), ("totals", pa.binary())])


def _levels(block: Block, told: pa.Table, order: int) -> tuple[list[np.ndarray], Level | None, int]:
    """Counts in other documents of each order up to ``order``, the last of these levels, and the words of the corpus."""
    rows = sorted(told.select(["level", "shard", "n", "words", "totals"]).to_pylist(), key=lambda r: (r["level"], r["shard"]))
    level, counts = None, []
    for n in range(1, order + 1):
        level = Level(block, n, level, counts[-1] if counts else None)
        counts.append(level.others(np.concatenate([np.zeros(0, np.int64), *(_unpack(r["totals"], r["n"]) for r in rows if r["level"] == n)])))
    return counts, level, sum(r["words"] for r in rows)


def _asked(block: Block, level: Level, shards: int, all_shards: bool) -> pa.RecordBatch:
    """For each shard the different n-grams of a level and how often they occur."""
    cuts, counts = _cut(level.grams, shards), level.counts[level.order]
    rows = [(s, block.number, int(b - a), _planes(level.grams[a:b]), _pack(counts[a:b])) for s, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())) if b > a or all_shards]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(ASKED)], schema=ASKED)


def ask_words(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    """What blocks ask first: their words, of every shard, so that each shard's share of the corpus reaches every block."""
    for b in batches:
        for i in range(b.num_rows):
            block = Block(pa.Table.from_batches([b.slice(i, 1)]))
            yield _asked(block, Level(block, 1, None, None), shards, True)


def ask(table: pa.Table, told: pa.Table, n: int, shards: int) -> pa.Table:
    """What a block asks of order ``n``, 2 or more."""
    if not table.num_rows:
        return ASKED.empty_table()
    block = Block(table)
    counts, below, _ = _levels(block, told, n - 1)
    return pa.Table.from_batches([_asked(block, Level(block, n, below, counts[-1]), shards, False)])


def add_up(table: pa.Table, level: int) -> pa.Table:
    """Of a shard: the totals of its n-grams, joined to what each block asked for."""
    rows = table.to_pylist()
    grams = np.concatenate([_from_planes(r["grams"], r["n"]) for r in rows])
    counts = np.concatenate([_unpack(r["counts"], r["n"]) for r in rows])
    order = np.argsort(grams)
    grams, joined = grams[order], np.empty(len(grams), np.int64)
    if len(grams):
        starts = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
        joined[order] = np.repeat(np.add.reduceat(counts[order], starts), np.diff(np.append(starts, len(grams))))
    words, out, begin = int(counts.sum()) if level == 1 else 0, [], 0
    for r in rows:
        out.append((r["block"], level, r["shard"], r["n"], words, _pack(joined[begin : begin + r["n"]])))
        begin += r["n"]
    return pa.table({f.name: pa.array([r[i] for r in out], f.type) for i, f in enumerate(TOLD)})


def score(table: pa.Table, told: pa.Table, order: int) -> pa.Table:
    """Of a block: each document's words and the sum of its words' log10 scores."""
    block = Block(table)
    counts, _, corpus = _levels(block, told, order)
    others = corpus - block.sizes[block.doc]  # words in other documents
    # A word at p is the last of the n-gram at p - n + 1. Unseen words share the chance of one more word.
    log = np.log10(np.maximum(counts[0], 1) / (others + (counts[0] == 0)))
    penalty = np.log10(BACKOFF)
    for n in range(2, order + 1):
        has = np.zeros(len(block.codes), bool)
        whole, context = np.zeros(len(block.codes), np.int64), np.zeros(len(block.codes), np.int64)
        fit = np.flatnonzero(block.left >= n)
        has[fit + n - 1] = True
        whole[fit + n - 1], context[fit + n - 1] = counts[n - 1][fit], counts[n - 2][fit]
        seen = whole > 0
        log = np.where(has & ~seen, log + penalty, log)
        log[seen] = np.log10(whole[seen] / context[seen])
    sums = np.bincount(block.doc, weights=log, minlength=len(block.ids))
    return pa.table({"id": pa.array(block.ids, pa.int64()), "n_words": pa.array(block.sizes), "log_score": pa.array(sums, pa.float64())})


def scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER) -> DataFrame:
    """(id, n_words, log_score): the summed log10 stupid-backoff scores of each text's words under all other documents.

    Words are runs between ASCII white space, A-Z in lower case. With c the counts in documents other
    than the scored row, a word's score is c(context word) / c(context) for the longest context of at
    most ``order - 1`` words for which c(context word) > 0, times 0.4 for each shortening (only contexts that
    the document has count); a word found nowhere else counts like one more word, 1 / (words + 1). Null
    and wordless texts have no words and score 0. Equal texts in several rows see each other; rows with
    equal or null ids are scored like others. ``docs`` is a table, or other rows that come in the same
    order when a lost task runs again (write them first if they come out of a shuffle). Ids must be
    numbers, others are an error. Where the id is itself called ``n_words`` or ``log_score``, the new column
    of that name gets an underscore.
    """
    if not isinstance(docs.schema[id_col].dataType, T.IntegralType):
        raise TypeError(f"{id_col} must be an integer column")
    shards = parts(docs.sparkSession, text_bytes(docs, text_col), SHARD_BYTES)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("data"))
    # One exchange, which all orders read.
    dealt = rows.mapInArrow(packed, "block long, ids array<long>, sizes binary, vocabulary binary, n long, codes binary").repartition("block")
    asks, tells = "shard int, block long, n long, grams binary, counts binary", "block long, level int, shard int, n long, words long, totals binary"

    def asker(n: int):
        return lambda t, s: ask(t, s, n, shards)

    def adder(n: int):
        return lambda t: add_up(t, n)

    asked, told = dealt.mapInArrow(lambda b: ask_words(b, shards), asks), None
    for n in range(1, order + 1):
        if told is not None:
            asked = dealt.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(asker(n), asks)
        answers = asked.groupBy("shard").applyInArrow(adder(n), tells)
        told = answers if told is None else told.unionByName(answers)
    out = dealt.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(lambda t, s: score(t, s, order), "id long, n_words long, log_score double")
    return out.toDF(id_col, *(free_name(docs.select(id_col), c) for c in ("n_words", "log_score")))


def query(docs: DataFrame) -> DataFrame:
    """The mean score of each document's words, rounded to 6 digits; 0 without words."""
    return scores(docs).select("doc_id", "n_words", F.round(F.coalesce(F.try_divide("log_score", "n_words"), F.lit(0.0)), 6).alias("mean_log10"))
