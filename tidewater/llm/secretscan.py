"""Secret scans: three fixed forms, and strings near sensitive words that a primed compressor finds new.

A candidate is a run of 16 or more letters, digits and ``+/_-`` that has letters and digits and stands in a line behind a sensitive
word. What it adds to its surroundings is measured in bytes: the surroundings are compressed by zstandard with and without it,
both times primed with a dictionary of identifiers. Names, paths and placeholders consist of parts that the dictionary or
the surrounding code holds and add few bytes; keys add almost as many as they have.

The dictionary holds common words of code and the words that stand around sensitive words in all documents; a word counts
once for each different surrounding, so that copies of one text don't make their own secret common.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "novel")
#: Bytes on each side of a candidate that are compressed with it, and how far behind a sensitive word it may begin.
AROUND, REACH = 192, 96
#: A candidate is reported if it adds so many bytes for each of its own.
NOVELTY = 0.75
#: Words of the dictionary: at most so many, in so many different surroundings at least.
DICTIONARY_WORDS, SEEN = 4096, 3
LEVEL = 12
# Sensitive words, in lower case.
CUES = [b"password", b"passwd", b"passphrase", b"secret", b"token", b"api_key", b"apikey", b"api-key", b"credential", b"private_key", b"private key", b"access_key", b"accesskey", b"auth", b"bearer", b"signing_key"]
# Common words of code and configuration.
CODE_WORDS = (
    "string function return import export const static public private protected class interface package module default config configuration settings "
    "environment variable value values username userName user_id client_id clientId client_secret clientSecret access_key_id access_token refresh_token "
    "authorization authentication authenticate authorize Authorization Authentication bearer header request response session cookie "
    "password passphrase credential credentials private_key public_key signing_key certificate encryption encrypted decrypt sha256 sha512 hmac md5 "
    "http https localhost database connection host port endpoint service account provider manager handler factory controller repository "
    "example placeholder changeme your_api_key_here your_token_here redacted undefined null true false development production staging test testing version "
    "app application get set from with param args index number name type path file text encoding algorithm storage cache group project region"
)
# Sequences that stand for a value.
SEQUENCES = b"abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 01234567890123456789 _id _ID _v1 _v2 Id V1 V2"
_BASE_CUES = (b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey")
# The base forms.
_ASSIGN = re.compile(rb"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = bytes(49 if b in b"0123456789abcdef" else 48 for b in range(256))
_TOKEN = re.compile(rb"[A-Za-z0-9+/_-]{16,}={0,2}")
_WORD = re.compile(rb"[A-Za-z]{3,32}")
_RUN = re.compile(rb"[A-Za-z0-9+/_-]*")

Span = tuple[int, int, int]  # start, kind, end, in bytes


def _places(data: bytes, words: tuple[bytes, ...] | list[bytes]) -> list[tuple[int, int]]:
    """(start, end) of every occurrence of the words, in order."""
    out = []
    for w in words:
        at = data.find(w)
        while at >= 0:
            out.append((at, at + len(w)))
            at = data.find(w, at + 1)
    return sorted(out)


def base_spans(data: bytes, low: bytes) -> list[Span]:
    """The fixed forms; ``low`` is ``data`` with A-Z in lower case."""
    out, end = [], 0
    for at, _ in _places(low, _BASE_CUES):
        if at >= end and (m := _ASSIGN.match(data, at)):
            end = m.end()
            if m.end(2) - m.start(2) >= 12:
                out.append((at, 0, end))
    end = 0
    for at, _ in _places(data, [b"AKIA"]):
        if at >= end and (m := _ACCESS.match(data, at)):
            end = m.end()
            if end - at >= 18:
                out.append((at, 1, end))
    marks = data.translate(_HEX)
    at = marks.find(b"1" * 16)
    while at >= 0:
        end = marks.find(b"0", at)
        end = len(data) if end < 0 else end
        out.append((at, 2, end))
        at = marks.find(b"1" * 16, end)
    return sorted(out)


def candidates(data: bytes, low: bytes, base: list[Span]) -> Iterator[tuple[int, int]]:
    """Runs that may be secrets and don't touch a base span, in order."""
    taken, k, done, rest = sorted((s, e) for s, _, e in base), 0, 0, 0
    for _, at in _places(low, CUES):
        line = low.find(b"\n", at, at + REACH)
        limit = line if line >= 0 else at + REACH
        if at > rest:
            rest = _RUN.match(data, at).end()  # of the word that the sensitive word is part of
        at = max(rest, done)
        while at < limit and (m := _TOKEN.search(data, at, limit + 16)) and m.start() < limit:
            start, at = m.start(), _TOKEN.match(data, m.start()).end()
            done, token = at, data[start:at]
            while k < len(taken) and taken[k][1] <= start:
                k += 1
            if not (k < len(taken) and taken[k][0] < at) and b"//" not in token and re.search(rb"[0-9]", token) and re.search(rb"[A-Za-z]", token):
                yield start, at


def around(data: bytes, start: int, end: int) -> tuple[bytes, bytes]:
    return data[max(0, start - AROUND) : start], data[end : end + AROUND]


class Novelty:
    """Bytes that a string adds to its surroundings, for a compressor primed with a dictionary."""

    def __init__(self, words: list[bytes]):
        code = CODE_WORDS.encode().split()
        forms = {f(w): None for f in (bytes.upper, bytes.capitalize, bytes) for w in code}
        content = b"\n".join([*words, SEQUENCES, *forms])
        primed = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        primed.precompute_compress(level=LEVEL)
        self._size = zstandard.ZstdCompressor(level=LEVEL, dict_data=primed, write_checksum=False, write_content_size=False, write_dict_id=False)

    def added(self, before: bytes, token: bytes, after: bytes) -> int:
        return len(self._size.compress(before + token + after)) - len(self._size.compress(before + after))

    def is_new(self, before: bytes, token: bytes, after: bytes) -> bool:
        """Whether it adds much in its surroundings and by itself, too: what either knows isn't new."""
        least = NOVELTY * len(token)
        return self.added(before, token, after) >= least and self.added(b"", token, b"") >= least


def words_around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, place): the words around candidates, with a hash of their surroundings; the candidate's own parts are none of them."""
    for b in batches:
        words, places = [], []
        for x in b.column(0):
            data = x.as_py()
            low = data.lower()
            for start, end in candidates(data, low, base_spans(data, low)):
                before, after = around(data, start, end)
                where = xxhash.xxh64_intdigest(before + b"\x00" + after) - (1 << 63)
                own = {w.group() for side in (before, after) for w in _WORD.finditer(side)}
                words += own
                places += [where] * len(own)
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(places, pa.int64())], ["word", "place"])


def dictionary(docs: DataFrame, text_col: str = "text") -> list[bytes]:
    """The commonest words around candidates, at most DICTIONARY_WORDS, the commonest first; each counts once for a surrounding."""
    data = docs.select(F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("data"))
    seen = data.mapInArrow(words_around, "word binary, place long").distinct().groupBy("word").agg(F.count("*").alias("n"))
    top = seen.filter(F.col("n") >= SEEN).orderBy(F.desc("n"), "word").limit(DICTIONARY_WORDS).collect()
    return [bytes(r["word"]) for r in top]


FOUND = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def found(batches: Iterator[pa.RecordBatch], words: list[bytes]) -> Iterator[pa.RecordBatch]:
    """(id, spans): all spans of each document in code points, by start and kind."""
    novelty = Novelty(words)
    for b in batches:
        rows = []
        for x in b.column(1):
            data = x.as_py()
            low = data.lower()
            spans = base_spans(data, low)
            new = [(s, 3, e) for s, e in candidates(data, low, spans) if novelty.is_new((w := around(data, s, e))[0], data[s:e], w[1])]
            spans = sorted(spans + new)
            if spans and not data.isascii():
                points = np.concatenate([[0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)])
                spans = [(int(points[s]), k, int(points[e])) for s, k, e in spans]
            rows.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans])
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, FOUND)], ["id", "spans"])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans): a row for each document with its spans of secrets, an array of kind, start and end in code points.

    Kinds: ``assign``, ``access`` and ``hex`` are the fixed forms, which may overlap each other; ``novel`` spans are what the method adds, apart from
    all others. Null and empty texts have no spans. Rows with equal or null ids are scanned like others, ids may have
    any type, and other columns don't matter.
    """
    words = dictionary(docs, text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("data"))
    kind = rows.schema["id"].dataType.simpleString()
    spans = rows.mapInArrow(lambda b: found(b, words), f"id {kind}, spans array<struct<kind:string,start:long,end:long>>")
    return spans.withColumnRenamed("id", id_col)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def query(docs: DataFrame) -> DataFrame:
    """Counts of the base forms, a digest of their spans, and all spans as text."""
    base = F.filter("spans", lambda s: s["kind"] != "novel")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return scan(docs).select("doc_id", *map(count, KINDS[:3]), F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"), count("novel"))
