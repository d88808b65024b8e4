"""Removal of long passages that earlier documents hold, with run-compressed indexes.

Every string of 50 bytes has a minimizer: the smallest hash of its 25-byte substrings. A run of
neighbouring strings with one minimizer is a segment. Equal strings have equal minimizers, so three
exact steps follow, each between blocks of documents and shards of minimizers:

1. each block sends its minimizers; one that no other document has can't be in a shared string,
2. each block sends its segments with shared minimizers, equal ones once, and their smallest id; the
   shard indexes those that share a minimizer with others in a run-length Burrows-Wheeler index,
   streams them through it and answers with the smallest id that holds each string,
3. each block marks what a smaller id holds, and cuts it out.

A minimizer with more segments than an index holds is hot: its segments go as single strings to shards
of their own, dealt by a hash of the whole string, which compare them without an index. So no minimizer,
however frequent, has to fit a task.

What repeats is therefore combined in its block before it moves, however many documents hold it.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .rindex import LIMIT, RunIndex
from .shared import parts, text_bytes

DEPTH = 50
GRAM = 25
BLOCK_BYTES = 8 << 20
#: Text bytes for each shard of minimizers.
SHARD_BYTES = 16 << 20
#: Segment bytes that one index is filled with; a shard's minimizers are dealt to as many indexes as it takes.
INDEX_BYTES = 1_000_000
_CHUNK = 1 << 16
#: Strings of a segment at most.
LONGEST = 2 * (DEPTH - GRAM + 1)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
NOBODY = np.iinfo(np.int64).max


def _powers() -> tuple[np.ndarray, np.ndarray]:
    n = _CHUNK + DEPTH
    up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _ODD)]))
    back = np.uint64(pow(int(_ODD), -1, 1 << 64))
    return up, np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, back)]))


_UP, _DOWN = _powers()


def minimizers(data: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """(place, smallest hash of each 50-byte string from there on), in chunks; hashes have 48 bits."""
    whole = np.frombuffer(data, np.uint8)
    for at in range(0, max(0, len(whole) - DEPTH + 1), _CHUNK):
        part = whole[at : at + _CHUNK + DEPTH - 1]
        n = len(part) - GRAM + 1
        total = np.concatenate([[np.uint64(0)], np.cumsum(part * _UP[: len(part)], dtype=np.uint64)])
        h = (total[GRAM:] - total[:-GRAM]) * _DOWN[:n]
        h ^= h >> np.uint64(31)
        h *= _MIX
        h >>= np.uint64(16)
        width, done = DEPTH - GRAM + 1, 1
        while done < width:
            step = min(done, width - done)
            h = np.minimum(h[:-step], h[step:])
            done += step
        yield at, h


def segments(data: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(minimizer, first string, behind the last string) of each segment, in chunks; long ones are cut."""
    for at, h in minimizers(data):
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        behind = np.append(first[1:], len(h))
        if (behind - first > LONGEST).any():  # periodic text has one minimizer for long
            parts = -((first - behind) // LONGEST)
            nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            first, end = np.repeat(first, parts) + nth * LONGEST, np.repeat(behind, parts)
            behind = np.minimum(first + LONGEST, end)
        yield h[first], first + at, behind + at


def _pack(values: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(values), codec="zstd", asbytes=True) if len(values) else b""


def _unpack(blob: bytes, n: int, kind) -> np.ndarray:
    kind = np.dtype(kind)
    return np.frombuffer(pa.decompress(blob, n * kind.itemsize, codec="zstd", asbytes=True), kind) if n else np.zeros(0, kind)


def _pack48(values: np.ndarray) -> bytes:
    """Sorted 48-bit numbers as differences."""
    return np.diff(values, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack48(blob: bytes) -> np.ndarray:
    six = np.frombuffer(blob, np.uint8).reshape(-1, 6)
    eight = np.zeros((len(six), 8), np.uint8)
    eight[:, :6] = six
    return np.cumsum(eight.view("<u8").ravel(), dtype=np.uint64)


def _documents(table: pa.Table) -> Iterator[tuple[int, bytes]]:
    for batch in table.select(["id", "data"]).to_batches():
        ids, data = batch.column(0), batch.column(1)
        for i in range(batch.num_rows):
            yield ids[i].as_py(), data[i].as_py()


def _shards(hashes: np.ndarray, shards: int) -> np.ndarray:
    return (hashes % np.uint64(shards)).astype(np.int64)


def ask_minimizers(table: pa.Table, shards: int) -> pa.Table:
    """Of a block, for each shard: its minimizers, which of them several documents of the block have, and how many segments each has."""
    found: list[np.ndarray] = []
    times: list[np.ndarray] = []
    held = 0
    once, twice, n_segments = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def merge() -> None:
        nonlocal once, twice, n_segments, found, times, held
        values, at, counts = np.unique(np.concatenate([once, *found]), return_inverse=True, return_counts=True)
        n_segments = np.bincount(at, np.concatenate([n_segments, *times]), len(values)).astype(np.int64)
        twice = np.union1d(twice, values[counts > 1])
        once, found, times, held = values, [], [], 0

    def add(own: list[np.ndarray]) -> None:
        values, n = np.unique(np.concatenate(own), return_counts=True)
        found.append(values)
        times.append(n)

    last = None
    own: list[np.ndarray] = []
    for doc, data in sorted(_documents(table), key=lambda x: x[0]):
        if doc != last and own:
            add(own)
            held += len(found[-1])
            own = []
        last = doc
        own += [h for h, _, _ in segments(data)]
        if held > 1_000_000:
            merge()
    if own:
        add(own)
    merge()
    block, to = table.column("block")[0].as_py(), _shards(once, shards)
    order = np.argsort(to, kind="stable")
    cuts = np.flatnonzero(np.diff(to[order], prepend=-1)) if len(order) else np.zeros(0, np.int64)
    rows = []
    for a, b in zip(cuts, [*cuts[1:], len(order)]):
        part = once[order[a:b]]
        rows.append((int(to[order[a]]), block, _pack48(part), np.packbits(np.isin(part, twice, assume_unique=True)).tobytes(), _pack(np.ceil(np.log2(n_segments[order[a:b]])).astype(np.uint8))))
    return pa.table({n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate((("shard", pa.int32()), ("block", pa.int32()), ("hashes", pa.binary()), ("several", pa.binary()), ("sizes", pa.binary())))})


def shared_minimizers(table: pa.Table) -> pa.Table:
    """Of a shard, for each block: its minimizers that more than one document has, and which of them are hot in all blocks together."""
    blocks = table.column("block").to_pylist()
    parts = [_unpack48(b) for b in table.column("hashes").to_pylist()]
    flags = [np.unpackbits(np.frombuffer(b, np.uint8), count=len(p)).astype(bool) for b, p in zip(table.column("several").to_pylist(), parts)]
    everything = np.sort(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)
    again = np.unique(np.concatenate([everything[1:][everything[1:] == everything[:-1]], *(p[f] for p, f in zip(parts, flags))]))
    n_segments = np.zeros(len(again), np.int64)  # at most twice as many as there are
    for p, blob in zip(parts, table.column("sizes").to_pylist()):
        at = np.minimum(np.searchsorted(again, p), len(again) - 1) if len(again) else np.zeros(0, np.int64)
        hit = again[at] == p if len(again) else np.zeros(0, bool)
        n_segments[at[hit]] += np.int64(1) << _unpack(blob, len(p), np.uint8)[hit].astype(np.int64)
    burning = again[n_segments > _hot()]
    out = [p[np.isin(p, again, assume_unique=True)] for p in parts]
    keep = [i for i, p in enumerate(out) if len(p)]
    hot = [_pack48(np.intersect1d(out[i], burning, assume_unique=True)) for i in keep]
    return pa.table({"block": pa.array([blocks[i] for i in keep], pa.int32()), "hashes": pa.array([_pack48(out[i]) for i in keep], pa.binary()), "hot": pa.array(hot, pa.binary())})


def _hot() -> int:
    """Segments of a minimizer that fit an index whatever their length; one minimizer may fill twice what is else put together."""
    return min(2 * INDEX_BYTES, LIMIT) // (LONGEST + DEPTH)


class _Numbers(dict):
    """Numbers of segments in the order in which they are first asked for."""

    def __missing__(self, segment: bytes) -> int:
        self[segment] = n = len(self)
        return n


class Segments:
    """The different segments of a block's documents that hold shared minimizers, by number, and those of each document."""

    def __init__(self, docs: Iterable[tuple[int, bytes]], shared: pa.Table):
        numbers, self.places, minimizers = _Numbers(), [], []
        for doc, data, h, first, behind in _candidates(docs, shared):
            own = (data[a:b] for a, b in zip(first.tolist(), (behind + (DEPTH - 1)).tolist()))
            codes = np.fromiter(map(numbers.__getitem__, own), np.int32, len(first))
            self.places.append((doc, data, first, codes))
            minimizers.append(h)
        self.keys = list(numbers)
        del numbers
        self.codes = np.concatenate([np.zeros(0, np.int32), *(c for _, _, _, c in self.places)])
        self.minimizer = np.zeros(len(self.keys), np.uint64)
        self.minimizer[self.codes] = np.concatenate([np.zeros(0, np.uint64), *minimizers])
        hot = np.unique(np.concatenate([np.zeros(0, np.uint64), *(_unpack48(b) for b in shared.column("hot").to_pylist())]))
        self.hot = np.isin(self.minimizer, hot)

    def by_shard(self, shards: int) -> Iterator[tuple[int, np.ndarray]]:
        """Numbers of the segments that aren't hot, in the order in which a block sends them: by shard, then by their bytes."""
        order = np.array(sorted(np.flatnonzero(~self.hot).tolist(), key=self.keys.__getitem__), np.int64)
        to = _shards(self.minimizer[order], shards)
        order = order[np.argsort(to, kind="stable")]
        to = np.sort(to)
        cuts = np.flatnonzero(np.diff(to, prepend=-1))
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(order)]):
            yield int(to[a]), order[a:b]

    def hot_strings(self, shards: int) -> dict[int, list[bytes]]:
        """The different strings of hot segments by shard (behind those of segments), in the order in which a block sends them."""
        by: dict[int, list[bytes]] = {}
        for string in sorted({s[i : i + DEPTH] for s in map(self.keys.__getitem__, np.flatnonzero(self.hot).tolist()) for i in range(len(s) - DEPTH + 1)}):
            by.setdefault(shards + zlib.crc32(string) % shards, []).append(string)
        return by


def _candidates(docs: Iterable[tuple[int, bytes]], shared: pa.Table) -> Iterator[tuple[int, bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """(id, data, minimizer, first, behind) of the segments with shared minimizers, document by document."""
    known = np.unique(np.concatenate([np.zeros(0, np.uint64), *(_unpack48(b) for b in shared.column("hashes").to_pylist())]))
    for doc, data in docs:
        parts = []
        if len(known):
            for h, first, behind in segments(data):
                at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                hit = known[at] == h
                if hit.any():
                    parts.append((h[hit], first[hit], behind[hit]))
        yield (doc, data, *(np.concatenate(c) for c in zip(*parts))) if parts else (doc, data, *(np.zeros(0, k) for k in (np.uint64, np.int64, np.int64)))


def ask_segments(table: pa.Table, shared: pa.Table, shards: int) -> pa.Table:
    """Of a block, for each shard: its different segments, or strings if hot, and the smallest id of each."""
    found = Segments(_documents(table), shared)
    least = np.full(len(found.keys), NOBODY)
    np.minimum.at(least, found.codes, np.repeat(np.array([p[0] for p in found.places], np.int64), [len(p[3]) for p in found.places]))
    block = table.column("block")[0].as_py() if table.num_rows else -1
    apart: dict[bytes, int] = {}
    for i in np.flatnonzero(found.hot).tolist():
        segment, doc = found.keys[i], int(least[i])
        for k in range(len(segment) - DEPTH + 1):
            string = segment[k : k + DEPTH]
            apart[string] = min(apart.get(string, NOBODY), doc)
    rows = [
        (s, block, len(own), DEPTH * len(own), None, None, _pack(np.array([apart[k] for k in own], np.int64)), pa.compress(b"".join(own), codec="zstd", asbytes=True))
        for s, own in found.hot_strings(shards).items()
    ]
    for s, codes in found.by_shard(shards):
        own = [found.keys[i] for i in codes.tolist()]
        sizes = np.fromiter(map(len, own), np.int32, len(own))
        rows.append((s, block, len(own), int(sizes.sum()), _pack(found.minimizer[codes]), _pack(sizes), _pack(least[codes]), pa.compress(b"".join(own), codec="zstd", asbytes=True)))
    return pa.table({f.name: pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_SEGMENTS)})


_SEGMENTS = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("n", pa.int32()), ("n_bytes", pa.int64()), ("minimizers", pa.binary()), ("sizes", pa.binary()), ("ids", pa.binary()), ("bytes", pa.binary())])


def answer(table: pa.Table) -> pa.Table:
    """Of a shard, for each block and segment: the smallest id that holds each of its strings."""
    if table.column("sizes").null_count:
        return _answer_strings(table)
    numbers, asked, minimizers, ids = _Numbers(), [], [], []
    for i in range(table.num_rows):
        r = table.slice(i, 1).to_pylist()[0]
        sizes, text = _unpack(r["sizes"], r["n"], np.int32), pa.decompress(r["bytes"], r["n_bytes"], codec="zstd", asbytes=True)
        ends = np.cumsum(sizes).tolist()
        asked.append((r["block"], np.fromiter(map(numbers.__getitem__, (text[e - s : e] for s, e in zip(sizes.tolist(), ends))), np.int32, len(ends))))
        minimizers.append(_unpack(r["minimizers"], r["n"], np.uint64))
        ids.append(_unpack(r["ids"], r["n"], np.int64))
    keys, codes = list(numbers), np.concatenate([c for _, c in asked])
    del numbers
    minimizer, least = np.empty(len(keys), np.uint64), np.full(len(keys), NOBODY)
    minimizer[codes] = np.concatenate(minimizers)
    np.minimum.at(least, codes, np.concatenate(ids))
    del minimizers, ids, codes
    widths = np.fromiter(map(len, keys), np.int64, len(keys)) - (DEPTH - 1)
    ends = np.cumsum(widths)
    owners = np.repeat(least, widths)  # of each string of each segment
    pending: list[int] = []

    def index() -> None:
        if pending:
            own = [keys[i] for i in pending]
            for i, found in zip(pending, RunIndex(own, least[pending], DEPTH).least_owners(own)):
                owners[ends[i] - len(found) : ends[i]] = found
            pending.clear()

    held = 0
    order = np.argsort(minimizer, kind="stable")
    cuts = np.flatnonzero(np.concatenate([[True], minimizer[order][1:] != minimizer[order][:-1]])) if len(order) else order
    for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(order)]):
        if b - a == 1:  # a minimizer with one segment shares strings with no other
            continue
        group = order[a:b]
        size = int(widths[group].sum()) + DEPTH * len(group)
        if held + size > INDEX_BYTES:
            index()
            held = 0
        pending += group.tolist()
        held += size
    index()
    rows, shard = [], table.column("shard")[0].as_py()
    for block, own in asked:
        n = widths[own]
        total = np.cumsum(n) - n
        values = owners[np.repeat(ends[own] - n - total, n) + np.arange(int(n.sum()))]
        rows.append((block, shard, len(values), _pack(values)))
    return _answers(rows)


def _answers(rows: list[tuple]) -> pa.Table:
    return pa.table({n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate((("block", pa.int32()), ("shard", pa.int32()), ("n", pa.int64()), ("least", pa.binary())))})


def _answer_strings(table: pa.Table) -> pa.Table:
    """Of a shard of hot strings, for each block and string: the smallest id that holds it."""
    blobs = list(zip(*(table.column(c).to_pylist() for c in ("block", "shard", "n", "n_bytes", "ids", "bytes"))))

    def own(n: int, n_bytes: int, blob: bytes) -> Iterator[bytes]:
        text = pa.decompress(blob, n_bytes, codec="zstd", asbytes=True)
        return (text[i : i + DEPTH] for i in range(0, n_bytes, DEPTH))

    least: dict[bytes, int] = {}
    for _, _, n, n_bytes, ids, blob in blobs:
        for string, doc in zip(own(n, n_bytes, blob), _unpack(ids, n, np.int64).tolist()):
            if doc < least.get(string, NOBODY):
                least[string] = doc
    return _answers([(block, shard, n, _pack(np.array([least.get(k, NOBODY) for k in own(n, n_bytes, blob)], np.int64))) for block, shard, n, n_bytes, _, blob in blobs])


def cut_out(table: pa.Table, told: pa.Table, shards: int) -> pa.Table:
    """Of a block: each document's removed spans, remaining bytes and other columns. ``told`` has the shared minimizers and the answers."""
    shared = told.filter(pa.compute.is_valid(told.column("hashes")))
    found = Segments(_documents(table), shared)
    answers = {r["shard"]: _unpack(r["least"], r["n"], np.int64) for r in told.select(["shard", "n", "least"]).to_pylist() if r["least"] is not None}
    # Of each segment the answers for its strings, and the extremes of these.
    widths = np.fromiter(map(len, found.keys), np.int64, len(found.keys)) - (DEPTH - 1)
    begins = np.cumsum(widths) - widths
    owners = np.empty(int(widths.sum()), np.int64)
    for s, codes in found.by_shard(shards):
        n = widths[codes]
        owners[np.repeat(begins[codes] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))] = answers.pop(s)
    if found.hot.any():
        apart = dict(itertools.chain.from_iterable(zip(own, answers[s].tolist()) for s, own in found.hot_strings(shards).items()))
        for i in np.flatnonzero(found.hot).tolist():
            k = found.keys[i]
            owners[begins[i] : begins[i] + widths[i]] = [apart[k[j : j + DEPTH]] for j in range(int(widths[i]))]
    low, high = (np.minimum.reduceat(owners, begins), np.maximum.reduceat(owners, begins)) if len(begins) else (begins, begins)
    rows = []
    for doc, data, first, codes in found.places:
        whole = high[codes] < doc
        begin, stop = first[whole].tolist(), (first[whole] + widths[codes[whole]] + (DEPTH - 1)).tolist()
        for i in np.flatnonzero((low[codes] < doc) & ~whole).tolist():
            at, a = begins[codes[i]], first[i]
            hit = (np.flatnonzero(owners[at : at + widths[codes[i]]] < doc) + a).tolist()
            begin += hit
            stop += [x + DEPTH for x in hit]
        if not begin:
            rows.append((doc, [], data))
            continue
        steps = np.bincount(begin, minlength=len(data) + 1) - np.bincount(stop, minlength=len(data) + 1)
        gone = np.cumsum(steps[:-1]) > 0
        edge = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
        rows.append((doc, [{"start": x, "stop": y} for x, y in edge.reshape(-1, 2).tolist()], np.frombuffer(data, np.uint8)[~gone].tobytes()))
    kinds = (("id", pa.int64()), ("removed", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), ("kept", pa.binary()))
    out = pa.table({n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate(kinds)})
    for name in table.column_names[3:]:
        out = out.append_column(name, table.column(name))
    return out


REMOVED = "array<struct<start:long,stop:long>>"


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, removed, kept, *carry): the byte spans of each text that earlier documents hold, the remaining bytes, other columns.

    A byte is removed if a string of 50 bytes covers it that also starts in a document with a smaller
    id; texts count as they come in. Null texts are empty. Rows with equal ids keep a row each and don't
    match each other; rows with a null id are neither searched nor found, and stay whole. Ids must be integers, others
    are an error.
    """
    if not isinstance(docs.schema[id_col].dataType, T.IntegralType):
        raise TypeError(f"{id_col} must be an integer column")
    size = text_bytes(docs, text_col)
    blocks, shards = parts(docs.sparkSession, size, BLOCK_BYTES), parts(docs.sparkSession, size, SHARD_BYTES)
    more = [f"c{i}" for i in range(len(carry))]
    rows = docs.select(
        F.pmod(F.xxhash64(F.col(id_col)), F.lit(blocks)).cast("int").alias("block"),
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("data"),
        *(F.col(f"`{c}`").alias(n) for c, n in zip(carry, more)),
    )
    kinds = "".join(f", {n} {docs.schema[c].dataType.simpleString()}" for c, n in zip(carry, more))
    dealt = rows.filter("id is not null").repartition("block")  # one exchange, which all three steps read
    asked = dealt.groupBy("block").applyInArrow(lambda t: ask_minimizers(t, shards), "shard int, block int, hashes binary, several binary, sizes binary")
    shared = asked.groupBy("shard").applyInArrow(shared_minimizers, "block int, hashes binary, hot binary")
    sought = dealt.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(
        lambda t, s: ask_segments(t, s, shards),
        "shard int, block int, n int, n_bytes long, minimizers binary, sizes binary, ids binary, bytes binary",
    )
    answers = sought.groupBy("shard").applyInArrow(answer, "block int, shard int, n long, least binary")
    told = answers.withColumns({"hashes": F.lit(None).cast("binary"), "hot": F.lit(None).cast("binary")}).unionByName(shared, allowMissingColumns=True)
    done = dealt.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(lambda t, s: cut_out(t, s, shards), f"id long, removed {REMOVED}, kept binary{kinds}")
    free = rows.filter("id is null").select("id", F.array().cast(REMOVED).alias("removed"), F.col("data").alias("kept"), *more)
    out = done.unionByName(free)
    return out.select(F.col("id").alias(id_col), "removed", "kept", *(F.col(n).alias(c) for c, n in zip(carry, more)))


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the removed spans cut out of ``text`` and ``n_chars`` counted anew where something went.

    A character of which only some bytes went becomes U+FFFD. A text that is removed as a whole is
    left empty; null texts stay null.
    """
    names = {c: f"k{i}" for i, c in enumerate(docs.columns)}  # own names, so that none clashes
    inner = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in names.items()), F.col("text").isNull().alias("is_null"))
    doc_id, text = names["doc_id"], names["text"]
    found = dedup(inner, doc_id, text, tuple(c for c in inner.columns if c not in (doc_id, text)))
    found = found.withColumn(text, F.when(~F.col("is_null"), F.make_valid_utf8(F.col("kept").cast("string"))))
    if "n_chars" in names:
        n_chars = names["n_chars"]
        found = found.withColumn(n_chars, F.when(F.size("removed") > 0, F.length(text).cast(docs.schema["n_chars"].dataType)).otherwise(F.col(n_chars)))
    return found.select(*(F.col(n).cast(docs.schema[c].dataType).alias(c) for c, n in names.items()))


def query(docs: DataFrame) -> DataFrame:
    found = dedup(docs)
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"])
    return found.select(
        "doc_id",
        (F.octet_length("kept") + removed).cast("long").alias("n_bytes"),
        removed.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
