import numpy as np
import pytest

pytest.importorskip("xxhash")
from tidewater.llm import simhash
from tidewater.llm.components import star_table, stars


def brute(fps, radius):
    parent = {int(f): int(f) for f in fps}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i, f in enumerate(fps):
        for g in fps[i + 1 :][np.bitwise_count(fps[i + 1 :] ^ f) <= radius]:
            a, b = find(int(f)), find(int(g))
            parent[max(a, b)] = min(a, b)
    return {f: find(f) for f in parent}


def clustered(n, seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 63, n // 4, dtype=np.uint64)
    near = [b ^ np.uint64(1 << int(rng.integers(64))) ^ np.uint64(1 << int(rng.integers(64))) for b in rng.choice(base, n - len(base))]
    return np.unique(np.concatenate([base, np.array(near, np.uint64)]))


def test_leaves_find_what_brute_force_finds(monkeypatch):
    monkeypatch.setattr(simhash, "SMALL", 8)
    fps = clustered(600, 1)
    tree = simhash.grow(fps, 4)
    own, asked = {}, {}
    for leaf, part, only in simhash.deal(tree, fps, 2):
        (asked if only else own).setdefault(leaf, []).append(part)
    assert sum(len(p) for ps in own.values() for p in ps) == len(fps)
    a, b = [], []
    for leaf, parts in own.items():
        found = simhash.links(np.unique(np.concatenate(parts)), np.unique(np.concatenate(asked.get(leaf, [fps[:0]]))), 2)
        a.append(found[0])
        b.append(found[1])
    node, root = stars(np.concatenate(a), np.concatenate(b))
    got = {int(f): int(f) for f in fps} | dict(zip(map(int, node), map(int, root)))
    assert got == brute(fps, 2)


def test_components_over_tables(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (8, 7), (3, 3), (20, 10), (10, 15), (15, 1), (1, 2)], "a long, b long")
    got = {r["node"]: r["root"] for r in star_table(edges).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 10: 1, 15: 1, 20: 1, 7: 7, 8: 7, 9: 7}
    assert star_table(edges.limit(0)).count() == 0


def test_odd_rows(spark):
    long_text = "alpha beta gamma delta " * 50_000
    docs = spark.createDataFrame(
        [(3, None, 1), (1, "", 1), (2, "a b c d", 1), (7, "A B C D", 1), (9, long_text, 1), (9, long_text, 1), (None, "q r s t", 1), (11, "a b", 1)],
        "doc_id long, text string, fp int",
    )
    rows = {(r["doc_id"], r["component_id"]) for r in simhash.query(docs).collect()}
    assert rows == {(3, 1), (1, 1), (2, 2), (7, 2), (9, 9), (None, None), (11, 11)}
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 9, 11]
    assert simhash.query(docs.limit(0)).count() == 0


def test_texts_of_one_fingerprint_are_near_duplicates(spark):
    """Fingerprints count repeats: texts that share most of their words are linked, though their sets of shingles are unlike."""
    common = "alpha beta gamma " * 200
    rows = [(1, common + " ".join(f"one{i}" for i in range(20)), 0), (2, common + " ".join(f"two{i}" for i in range(20)), 0), (3, "delta " * 50, 0)]
    assert simhash.fingerprint(rows[0][1]) == simhash.fingerprint(rows[1][1])
    assert sorted(r["doc_id"] for r in simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string, x int")).collect()) == [1, 3]
