"""Plain versions of what the operators compute in blocks and by the JVM: fingerprints, canonical forms, the learned weights and their temperature."""

import math
import random
import re
import unicodedata

import numpy as np
import pytest

xxhash = pytest.importorskip("xxhash")
from pyspark.sql import functions as F

from tidewater.llm import digest, langid, simhash


def plain_fingerprint(text, words):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    tokens = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not tokens:
        return 0
    shingles = [" ".join(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << bit for bit in range(64) if sum(h >> bit & 1 for h in hashes) * 2 > len(hashes))


@pytest.mark.parametrize("words", [1, 3, 5])
def test_fingerprint(monkeypatch, words):
    monkeypatch.setattr(simhash, "_BLOCK", 7)
    rng = random.Random(words)
    pieces = ["a", "B", "É", "ß", " ", "\x1c", "\x85", " ", " ", "\t", "\n", "\r\n", "\x0b", "Zz", " "]
    for text in [None, "", " \n", "A", "a b", *("".join(rng.choices(pieces, k=rng.randint(1, 90))) for _ in range(300))]:
        assert simhash.fingerprint(text, words) == plain_fingerprint(text, words), repr(text)


def test_canonical_forms(spark):
    rng = random.Random(3)
    letters = [*range(1, 0x250), *range(0x300, 0x350), *range(0x391, 0x3CA), *range(0x400, 0x530), *range(0x1E00, 0x2010), *range(0x2028, 0x2030), 0x2126, 0x212A, *range(0x2460, 0x24EA), 0x3000, *range(0xAC00, 0xAC40), *range(0x1100, 0x1113), *range(0xFB00, 0xFB07), *range(0xFF01, 0xFF5F), 0x1D400]
    texts = [chr(c) for c in letters] + ["".join(chr(rng.choice(letters)) for _ in range(rng.randint(2, 12))) for _ in range(5000)]
    texts = [t for t in texts if all(unicodedata.category(c) != "Cn" for c in t)]

    def plain(text):
        nfkc = lambda s: unicodedata.normalize("NFKC", s)
        return re.sub(r"\s+", " ", nfkc(nfkc(text).casefold())).strip(" ")

    got = spark.createDataFrame([(t,) for t in texts], "s string").select("s", digest.canonical(F.col("s")).alias("c")).collect()
    assert [(r.s, r.c) for r in got if r.c != plain(r.s)] == []


def plain_fit(vectors, target, k):
    """The same steps, number by number."""
    bias = langid.FEATURES
    z, n = {}, {}

    def weight(f, c):
        v = z.get((f, c), 0.0)
        if abs(v) <= langid.L1:
            return 0.0
        return -(v - math.copysign(langid.L1, v)) / ((langid.BETA + math.sqrt(n[f, c])) / langid.ALPHA + langid.L2)

    rng = np.random.default_rng(0)
    for _ in range(langid.EPOCHS):
        for batch in np.array_split(rng.permutation(len(vectors)), max(1, len(vectors) // langid.BATCH)):
            gradient = {}
            for i in batch:
                row = [*zip(map(int, vectors[i][0]), vectors[i][1]), (bias, 1.0)]
                score = [sum(v * weight(f, c) for f, v in row) for c in range(k)]
                e = [math.exp(s - max(score)) for s in score]
                for c in range(k):
                    error = e[c] / sum(e) - (c == target[i])
                    for f, v in row:
                        gradient[f, c] = gradient.get((f, c), 0.0) + v * error / len(batch)
            step = {}
            for at, g in gradient.items():
                old = n.get(at, 0.0)
                step[at] = (g - (math.sqrt(old + g * g) - math.sqrt(old)) / langid.ALPHA * weight(*at), old + g * g)
            for at, (d, total) in step.items():
                z[at], n[at] = z.get(at, 0.0) + d, total
    w = np.array([[weight(f, c) for c in range(k)] for f in range(bias + 1)])
    return w[:-1], w[-1]


def test_fit_and_temperature(monkeypatch):
    monkeypatch.setattr(langid, "FEATURES", 32)
    monkeypatch.setattr(langid, "L1", 0.1)
    rng = np.random.default_rng(8)
    target = rng.integers(0, 3, 2 * langid.BATCH + 5)
    idf = rng.uniform(0.5, 2, 32)
    often = lambda t: np.where(np.arange(32) < 28, 0.3 + 2.0 * (np.arange(32) % 3 == t), 0.01)
    vectors = [langid.vector(rng.poisson(often(t)), idf) for t in target]  # the last four features are rare and tell nothing
    for at, value in vectors:
        assert len(at) == len(value) and np.isclose((value**2).sum(), 1) or not len(at)
    (w, b), (pw, pb) = langid.fit(vectors, target, 3), plain_fit(vectors, target, 3)
    assert np.allclose(w, pw, atol=1e-8) and np.allclose(b, pb, atol=1e-8)
    assert np.any(w == 0) and np.array_equal(w == 0, pw == 0)

    logits = rng.normal(size=(400, 3))
    truth = np.array([rng.choice(3, p=np.exp(r) / np.exp(r).sum()) for r in logits])

    def loss(t):
        return -sum(math.log(math.exp(r[y] / t) / sum(math.exp(x / t) for x in r)) for r, y in zip(logits * 4, truth))

    best = langid.temperature(logits * 4, truth)
    assert loss(best) <= min(loss(best * 1.05), loss(best / 1.05)) and 2 < best < 8
