"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Document frequencies come from all documents of the learning folds. The weights are fitted on a
bounded sample of them, as many of each language, by follow-the-regularised-leader with an elastic-net penalty, and a
temperature fitted on a part of the sample kept aside calibrates the scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ORDERS = (1, 2, 3)
FEATURES = 1 << 14
#: Documents the weights are fitted on, at most, in equal shares of all languages (one of each at least); of them one in CALIBRATE for the temperature.
SAMPLE_DOCS = 4000
CALIBRATE = 5
#: Languages that can be told apart, at most.
MAX_LANGS = 512
EPOCHS = 6
BATCH = 16
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.02, 0.02
FOLDS = 5
UNKNOWN = "und"
_CHUNK = 1 << 20
_HASHES = 1 << 30
_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)
_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    """Every code point's own value if it is a letter, else that of a space."""
    if not _letters:
        _letters.append(np.fromiter((c if chr(c).isalpha() else 32 for c in range(0x110000)), np.uint32, 0x110000))
    return _letters[0]


def counts(text: str | None) -> np.ndarray | None:
    """How often each hashed n-gram occurs in the whole text: lower case, other characters as single spaces; None without a letter."""
    out = None
    tail = np.array([32], np.uint32)
    lower = (text or "").lower()
    for at in range(0, len(lower), _CHUNK):
        codes = np.frombuffer(lower[at : at + _CHUNK].encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = np.concatenate([tail, _letter_table()[codes]])
        codes = codes[np.concatenate([[True], (codes[1:] != 32) | (codes[:-1] != 32)])]
        if out is None:
            if not (codes != 32).any():
                continue
            out = np.zeros(FEATURES, np.int64)
        h, slots = np.zeros(len(codes), np.uint32), []
        for k in range(max(ORDERS)):
            h = (h[: len(codes) - k] ^ codes[k:]) * _MULTIPLIERS[k % 3]
            h ^= h >> np.uint32(15)
            if len(h) == 0:
                break
            if k + 1 in ORDERS:
                slots.append((h * np.uint32(k + 1 | 1)) >> np.uint32(32 - FEATURES.bit_length() + 1))
            h = h[:-1]
        out += np.bincount(np.concatenate(slots), minlength=FEATURES)
        tail = codes[-(max(ORDERS) - 1) :]
    return out


def vector(count: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and weights of unit length: (1 + log count) * idf."""
    at = np.flatnonzero(count)
    value = (1 + np.log(count[at])) * idf[at]
    norm = np.sqrt((value**2).sum())
    return at, value / norm if norm else value


@dataclass
class Model:
    """``score(doc)`` of each language is softmax((weights . x + bias) / temperature)."""

    langs: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        count = counts(text) if self.langs else None
        if count is None:
            return UNKNOWN, 0.0
        at, value = vector(count, self.idf)
        p = _softmax((value @ self.weights[at] + self.bias)[None] / self.temperature)[0]
        return self.langs[int(p.argmax())], float(p.max())


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(vectors: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights (features x classes) and bias by follow-the-regularised-leader; a weight stays 0 until its gradients pass L1."""
    z, n = np.zeros((FEATURES + 1, k)), np.zeros((FEATURES + 1, k))

    def weights(at: np.ndarray) -> np.ndarray:
        w = -(z[at] - np.sign(z[at]) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        return np.where(np.abs(z[at]) <= L1, 0.0, w)

    rng = np.random.default_rng(0)
    for _ in range(EPOCHS):
        for batch in np.array_split(rng.permutation(len(vectors)), max(1, len(vectors) // BATCH)):
            rows = [(np.append(vectors[i][0], FEATURES), np.append(vectors[i][1], 1.0)) for i in batch]  # the last one is the bias
            at, own = np.unique(np.concatenate([r[0] for r in rows]), return_inverse=True)
            value, row = np.concatenate([r[1] for r in rows]), np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
            x = np.zeros((len(rows), len(at)))
            x[row, own] = value
            w = weights(at)
            error = _softmax(x @ w)
            error[np.arange(len(rows)), target[batch]] -= 1
            g = x.T @ error / len(rows)
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    w = weights(np.arange(FEATURES + 1))
    return w[:-1], w[-1]


def temperature(logits: np.ndarray, target: np.ndarray) -> float:
    """The temperature with the smallest log loss, of a geometric grid."""
    grid = np.geomspace(0.5, 20, 81)
    loss = [-np.log(_softmax(logits / t)[np.arange(len(target)), target] + 1e-300).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def learnable(id_col: str = "doc_id", lang_col: str = "lang") -> Column:
    """Rows with a language outside the held-out fold; rows without an id are never learned from."""
    return (F.crc32(F.col(id_col).cast("string")) % FOLDS != 0) & F.col(lang_col).isNotNull()


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", sample: int = SAMPLE_DOCS) -> Model:
    """Learns from the rows of ``docs``, all of which have a language; null texts and texts without letters are left out first.

    The weights are fitted on ``sample`` rows at most, in equal shares of all languages: those with the
    smallest hashes of id and text, repeated rows once, so they don't depend on how rows are dealt out.
    Each language with a usable text gives a row at least. More than ``MAX_LANGS`` languages are an error,
    as the model holds ``FEATURES`` numbers for each.
    """
    docs = docs.filter(F.col(text_col).rlike(r"\p{L}"))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(FEATURES, np.int64), 0
        for b in batches:
            texts = b.column(0)
            for i in range(b.num_rows):
                if (c := counts(texts[i].as_py())) is not None:
                    total += c > 0
                    n += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(total[at], n))], ["feature", "df"])

    df = docs.select(text_col).mapInArrow(frequencies, "feature long, df long").groupBy("feature").agg(F.sum("df").alias("df")).collect()  # FEATURES + 1 rows
    seen = {r["feature"]: r["df"] for r in df}
    n = seen.pop(-1, 0)
    idf = np.full(FEATURES, np.log(1.0 + n) + 1)
    for f, d in seen.items():
        idf[f] = np.log((1.0 + n) / (1.0 + d)) + 1

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i in range(b.num_rows):
                if (c := counts(b.column(0)[i].as_py())) is not None:
                    at = np.flatnonzero(c)
                    rows.append((b.column(1)[i].as_py(), b.column(2)[i].as_py(), at.astype("<i4").tobytes(), c[at].astype("<i4").tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.string(), pa.binary(), pa.binary()))], ["h", "lang", "at", "count"])

    hashed = docs.select(F.col(text_col).alias("text"), F.xxhash64(id_col, text_col).alias("h"), F.col(lang_col).alias("lang"))
    rank = F.pmod("h", F.lit(_HASHES))
    sizes = hashed.groupBy("lang").agg(F.approx_count_distinct("h").alias("n"), F.min(rank).alias("least")).limit(MAX_LANGS + 1).collect()  # a row for each language
    if len(sizes) > MAX_LANGS:
        raise ValueError(f"{lang_col} has more than {MAX_LANGS} values")
    share = max(1, sample // max(1, len(sizes)))
    # So few hashes lie under a language's bound that a window over them is small, and hardly ever fewer than its share.
    bounds = [(r["lang"], max(r["least"] + 1, min(_HASHES, (2 * share + 64) * _HASHES // r["n"]))) for r in sizes]
    bounded = F.broadcast(docs.sparkSession.createDataFrame(bounds, "lang string, bound long"))
    near = hashed.join(bounded, "lang").filter(rank < F.col("bound")).groupBy("lang", "h").agg(F.min("text").alias("text"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(rank, "h"))
    picked = near.withColumn("place", place).filter(F.col("place") <= share).select("text", "h", "lang")
    rows = picked.mapInArrow(vectors, "h long, lang string, at binary, count binary").collect()  # at most `sample`, or one of each language
    rows.sort(key=lambda r: (r["h"], r["lang"], r["count"]))
    langs = sorted({r["lang"] for r in rows})
    if not langs:
        return Model([], idf, np.zeros((FEATURES, 0)), np.zeros(0), 1.0)
    xs = []
    for r in rows:
        count = np.zeros(FEATURES, np.int64)
        count[np.frombuffer(r["at"], "<i4")] = np.frombuffer(r["count"], "<i4")
        xs.append(vector(count, idf))
    target = np.array([langs.index(r["lang"]) for r in rows], np.int64)
    aside = np.arange(len(rows)) % CALIBRATE == 0 if len(rows) >= 10 * CALIBRATE else np.zeros(len(rows), bool)
    w, bias = fit([x for x, a in zip(xs, aside) if not a], target[~aside], len(langs))
    logits = np.array([x[1] @ w[x[0]] + bias for x, a in zip(xs, aside) if a])
    return Model(langs, idf, w, bias, temperature(logits, target[aside]) if aside.any() else 1.0)


def predict(docs: DataFrame, model: Model, text_col: str = "text", out: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """Adds the likeliest language and its calibrated probability, from the text alone.

    A null text or one without a letter gets ``und`` and 0, as does every text if nothing was learned;
    of equally likely languages the first by name is taken.
    Existing columns of these names (compared without case) are replaced; ``text_col`` is dropped.
    """
    keep = [c for c in docs.columns if c.lower() not in {n.lower() for n in (text_col, *out)}]
    kinds = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep), f"{out[0]} string, {out[1]} double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(text_col)
            found = [model.predict(texts[i].as_py()) for i in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], [*keep, *out])

    return docs.select(*keep, text_col).mapInArrow(run, kinds)


def query(docs: DataFrame) -> DataFrame:
    model = train(docs.filter(learnable()).select("doc_id", "text", "lang"))
    rows = docs.select("doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == 0, F.lit(False)).alias("held_out"), "text")
    return predict(rows, model)
