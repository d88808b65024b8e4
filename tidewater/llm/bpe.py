"""BPE encoding and decoding by a depth-first walk over a trie of distinct words.

Every word of a batch is inserted once. Words in sorted order are the depth-first order of their
trie, so the walk needs only the states of the current path: for each prefix, the last token of its
encoding. An automaton over the vocabulary lists the tokens that end a prefix; the last token is the only vocabulary entry that ends the prefix and may stand next to the
last token of what is left of it; a shared prefix is therefore encoded once. Two tokens may be
neighbours if no merge crosses their border at any time while both are being built.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
from collections.abc import Iterable, Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

WORD_END = "</w>"
# White space of the tokenizer's normalizer (Unicode White_Space).
SPACE = "".join(map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
_SPACE_RUN = re.compile(f"[{SPACE}]+")
_SHORT = "'s|'t|'re|'ve|'m|'ll|'d"
_LATIN_END = "\u0250"
_BEYOND_LATIN = re.compile(f"[{_LATIN_END}-\U0010ffff]")


def _class(kind: str) -> str:
    """The lower-case Latin code points of a general category, for a character class."""
    return re.escape("".join(c for c in map(chr, range(ord(_LATIN_END))) if unicodedata.category(c)[0] == kind))


# Letters, digits and quotes start different alternatives, so that the common case may come first.
_ASCII_PIECE = re.compile(rf"[a-z]+|{_SHORT}|[0-9]|[^{SPACE}a-z0-9]+")
_LATIN_PIECE = re.compile(rf"[{_class('L')}]+|{_SHORT}|[{_class('N')}]|[^{SPACE}{_class('L')}{_class('N')}]+")
#: Words of each of a Python worker's two generations of memory, and pairs of tokens that it remembers.
CACHE_WORDS = 400_000
CACHE_PAIRS = 400_000
#: Characters whose words are held at a time.
SEGMENT_CHARS = 1 << 22
NEVER = 1 << 60


def byte_alphabet() -> list[str]:
    """The printable stand-in of each byte, as byte-level tokenizers define it."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    stand_in = {b: chr(b) for b in printable}
    rest = (b for b in range(256) if b not in stand_in)
    stand_in.update({b: chr(256 + i) for i, b in enumerate(rest)})
    return [stand_in[b] for b in range(256)]


def _pack_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordBpe:
    """Encoder and decoder of a word-end BPE file (``tokenizers`` JSON)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.vocab: dict[str, int] = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.rank: dict[tuple[int, int], int] = {}
        parts: dict[int, tuple[int, int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            left, right = self.vocab[a], self.vocab[b]
            self.rank[left, right] = rank
            parts[self.vocab[a + b]] = (left, right, rank)
        self.parts = parts
        self.width = [0] * (max(self.vocab.values()) + 1)
        self._automaton()
        self.bytes = byte_alphabet()
        self.byte_of = {c: b for b, c in enumerate(self.bytes)}
        self.path = path
        self._fits: list[dict[int, bool]] = [{} for _ in self.width]  # by the right token, then by the left one
        self._pairs = 0
        self._ids: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def _automaton(self) -> None:
        """States are the prefixes of vocabulary strings; each knows the tokens that are its suffixes, longest first."""
        self.step: list[dict[str, int]] = [{}]  # of each state: character -> state
        self.inner_at: list[tuple[int, ...]] = [()]
        self.final_at: list[tuple[int, ...]] = [()]
        chars, parent, inner, final = [""], [0], {}, {}
        for name, token in self.vocab.items():
            ends = name.endswith(WORD_END) and name != WORD_END
            text, at = name[: -len(WORD_END)] if ends else name, 0
            self.width[token] = len(text)
            for c in text:
                if (to := self.step[at].get(c)) is None:
                    to = self.step[at][c] = len(chars)
                    self.step.append({})
                    chars.append(c)
                    parent.append(at)
                at = to
            (final if ends else inner)[at] = token
        self._fallbacks = 0
        # Breadth first: the longest proper suffix of a state that is a state, too.
        depth = [0] * len(chars)
        for at in range(1, len(chars)):
            depth[at] = depth[parent[at]] + 1
        self.back = [0] * len(chars)
        self.inner_at += [()] * (len(chars) - 1)
        self.final_at += [()] * (len(chars) - 1)
        for at in sorted(range(1, len(chars)), key=depth.__getitem__):
            to = self._step(self.back[parent[at]], chars[at]) if parent[at] else 0
            self.back[at] = to
            self.inner_at[at] = ((inner[at],) if at in inner else ()) + self.inner_at[to]
            self.final_at[at] = ((final[at],) if at in final else ()) + self.final_at[to]

    def _step(self, at: int, char: str) -> int:
        """The state after ``char``; what the vocabulary doesn't continue falls back to a suffix."""
        to = self.step[at].get(char)
        if to is None:
            to = self._step(self.back[at], char) if at else 0
            if at and self._fallbacks < 400_000:
                self._fallbacks += 1
                self.step[at][char] = to
        return to

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The tokens that stand at one edge while ``token`` is built, each with the rank of the merge that ends it."""
        out, until = [(token, NEVER)], NEVER
        while token in self.parts:
            until = self.parts[token][2]
            token = self.parts[token][side]
            out.append((token, until))
        return out

    def fits(self, left: int, right: int) -> bool:
        """Whether no merge crosses the border of ``left`` and ``right``."""
        known = self._fits[right].get(left)
        if known is None:
            known, edge = True, self._edge(right, 0)
            for a, a_until in self._edge(left, 1):
                for b, b_until in edge:
                    # Of equal merges the leftmost comes first: a's own wins a tie, b's own loses it.
                    if (r := self.rank.get((a, b))) is not None and a_until > r and b_until >= r:
                        known = False
            if self._pairs >= CACHE_PAIRS:
                self._pairs = 0
                for row in self._fits:
                    row.clear()
            self._pairs += 1
            self._fits[right][left] = known
        return known

    def encode_words(self, words: Iterable[str]) -> dict[str, list[int]]:
        """Token ids of each distinct word (in the byte alphabet, not empty); words share the work on common prefixes."""
        out: dict[str, list[int]] = {}
        last, states = [-1], [0]  # by depth on the current path: last token of that prefix, state
        before, width, fits = "", self.width, self._fits
        steps, inner_at, final_at = self.step, self.inner_at, self.final_at

        def last_token(tokens: tuple[int, ...], d: int) -> tuple[int, int]:
            """Which of ``tokens``, all of which end the first ``d`` characters, ends their encoding; and where it begins."""
            for token in tokens:
                rest = d - width[token]
                if not rest:
                    return token, 0
                left = last[rest]
                fit = fits[token].get(left)
                if self.fits(left, token) if fit is None else fit:
                    return token, rest
            raise ValueError("the vocabulary lacks a byte")

        for word in sorted(words):
            n, depth, most = len(word), 0, min(len(word), len(before)) - 1
            while depth < most and word[depth] == before[depth]:
                depth += 1
            del last[depth + 1 :], states[depth + 1 :]
            at = states[depth]
            for d in range(depth, n - 1):
                char = word[d]
                to = steps[at].get(char)
                at = self._step(at, char) if to is None else to
                last.append(last_token(inner_at[at], d + 1)[0])
                states.append(at)
            token, rest = last_token(final_at[self._step(at, word[-1])], n)
            ids = [token]
            while rest:
                ids.append(last[rest])
                rest -= width[last[rest]]
            ids.reverse()
            out[word] = ids
            before = word
        return out

    @cached_property
    def rules(self) -> Tokenizer:
        """The file's own normalizer and splitter, which only texts beyond Latin need."""
        return Tokenizer.from_file(self.path)

    def _pieces(self, text: str) -> list[str]:
        """Normalized words of a text, in order.

        Latin texts are split here; beyond them the file's own rules decide, so that their Unicode tables hold.
        """
        if text.isascii():
            return _ASCII_PIECE.findall(text.lower())
        # Tested in lower case: some Latin capitals have their lower case far beyond.
        if not _BEYOND_LATIN.search(text) and not _BEYOND_LATIN.search(low := unicodedata.normalize("NFC", text).lower()):
            return _LATIN_PIECE.findall(low)
        text = self.rules.normalizer.normalize_str(text) if self.rules.normalizer else text
        back = self.byte_of
        return [bytes([back[c] for c in p]).decode("utf-8") for p, _ in self.rules.pre_tokenizer.pre_tokenize_str(text)]

    def _learn(self, pieces: set[str]) -> None:
        """Makes sure that the memory holds all ``pieces``; words that nothing has used for two generations are forgotten."""
        if len(self._ids) > CACHE_WORDS:
            self._older, self._ids = self._ids, {}
        known, older, names = self._ids, self._older, self.bytes
        fresh = pieces.difference(known)
        again = fresh.intersection(older)
        known.update(zip(again, map(older.__getitem__, again)))
        shown = {p: p if p.isascii() and p.isprintable() else "".join([names[b] for b in p.encode("utf-8")]) for p in fresh.difference(again)}
        ids = self.encode_words(shown.values())
        for p, word in shown.items():
            known[p] = _pack_ids(ids[word])

    def _parts_of(self, text: str) -> Iterator[list[str] | int]:
        """Lists of words and ids of special tokens, in order; no list covers much more than SEGMENT_CHARS."""
        for part in self.special_split.split(text) if self.special_split and "<|" in text else (text,):
            if part in self.special:
                yield self.special[part]
                continue
            at = 0
            while at < len(part):
                end = at + SEGMENT_CHARS
                if end < len(part):
                    space = _SPACE_RUN.search(part, end)
                    end = space.start() if space else len(part)
                yield self._pieces(part[at:end])
                at = end

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, little-endian unsigned 32-bit."""
        out: list[bytes] = []
        waiting: list[list[list[str] | int]] = []
        held = 0

        def flush() -> None:
            nonlocal held
            self._learn(set().union(*(part for parts in waiting for part in parts if not isinstance(part, int))))
            get = self._ids.__getitem__
            for parts in waiting:
                out.append(b"".join([p.to_bytes(4, "little") if isinstance(p, int) else b"".join(map(get, p)) for p in parts]))
            waiting.clear()
            held = 0

        for text in texts:
            if len(text) > SEGMENT_CHARS:
                flush()
                ids = []
                for part in self._parts_of(text):
                    waiting.append([part])
                    flush()
                    ids.append(out.pop())
                out.append(b"".join(ids))
                continue
            waiting.append(list(self._parts_of(text)))
            held += len(text)
            if held >= SEGMENT_CHARS:
                flush()
        flush()
        return out

    def decode(self, ids: bytes) -> str:
        return load_names(self.path).decode(ids)


class Names:
    """The decoder of such a file, without what only the encoder needs."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        names = {i: s for s, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.names = [names.get(i, "") for i in range(max(names) + 1)]

    def decode(self, ids: bytes) -> str:
        """The tokens' strings joined by spaces: such files name no decoder that would join them otherwise."""
        names = self.names
        return " ".join([names[i] for i in np.frombuffer(ids, dtype="<u4").tolist() if names[i]])


@lru_cache(maxsize=1)
def load(path: str) -> WordBpe:
    """One encoder per Python worker, so its memory of words lasts over tasks."""
    return WordBpe(path)


@lru_cache(maxsize=1)
def load_names(path: str) -> Names:
    return Names(path)


def encode(df: DataFrame, path: str, text_col: str = "text", out: str = "ids") -> DataFrame:
    """Adds ``out``: the ids of ``text_col`` as binary, little-endian unsigned 32-bit; null and empty texts give no ids.

    All other columns stay; ``text_col`` is dropped, as ids replace it. Another column ``out`` is
    an error (names are compared without case). Each row is encoded by itself: no shuffle, no limit on length.
    """
    keep = [c for c in df.columns if c.lower() != text_col.lower()]
    if out.lower() in map(str.lower, keep):
        raise ValueError(f"column {out} exists")
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField(out, T.BinaryType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                b = whole.slice(at, 1024)
                ids = bpe.encode([t or "" for t in b.column(text_col).to_pylist()])
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(ids, pa.binary())], [*keep, out])

    return df.select(*keep, F.col(text_col)).mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds ``out``: the decoded text of a binary ``ids_col``; null and empty ids give the empty text, unknown ids nothing.

    A column ``out`` (names are compared without case) is an error.
    """
    if out.lower() in map(str.lower, df.columns):
        raise ValueError(f"column {out} exists")
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = load_names(path)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                b = whole.slice(at, 512)
                texts = pa.array([names.decode(i or b"") for i in b.column(ids_col).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([*b.columns, texts], schema.names)

    return df.mapInArrow(run, schema)


def query(docs: DataFrame, path: str) -> DataFrame:
    """Digests of every document's ids and decoded text (see ``encode`` and ``decode`` for nulls)."""
    ids = encode(docs.select("doc_id", "text"), path)
    return decode(ids, path).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
