import random

from tidewater.llm import minhash, simhash


def planted(n, seed):
    """(id, text) of texts and of copies with some words replaced."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(3000)]
    rows = []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randrange(100, 400))]
        rows.append((2 * i, " ".join(text)))
        for at in rng.sample(range(len(text)), rng.choice([1, 1, len(text) // 100, len(text) // 50, len(text) // 10])):
            text[at] = rng.choice(words)
        rows.append((2 * i + 1, " ".join(text)))
    return rows


def test_near_copies_go_and_others_stay(spark):
    rows = planted(150, 1)
    own = {k: set(zip(*(t.split()[i:] for i in range(5)))) for k, t in rows}
    alike = [k for k in own if k % 2 and len(own[k] & own[k - 1]) >= 0.8 * len(own[k] | own[k - 1])]
    assert 60 < len(alike) < 150
    kept = {r["doc_id"] for r in simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == set(own) - set(alike)


def test_a_bucket_is_searched_beyond_its_smallest(spark, monkeypatch):
    """All texts share one bucket: links between any two members are found, not only those to the first."""
    monkeypatch.setattr(minhash, "bands", lambda own: [7] if len(own) else [])
    rows = planted(20, 2)
    own = {k: set(zip(*(t.split()[i:] for i in range(5)))) for k, t in rows}
    alike = {k for k in own if k % 2 and len(own[k] & own[k - 1]) >= 0.8 * len(own[k] | own[k - 1])}
    got = {r["doc_id"]: r["component_id"] for r in minhash.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {k: k - 1 if k in alike else k for k in own}
