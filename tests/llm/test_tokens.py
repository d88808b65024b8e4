import hashlib
import random

import numpy as np
import pytest

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")
from tidewater.llm import bpe, packing

PATH = public.path("word_bpe_49k.json")
ODD = [
    "", "  ", "Hello, it's  World!! 12 x\x1cy <|endoftext|>z a<|startoftext|>b 's", "aaaaaaaaaaaaab" * 40, "!!!??..,,,", "\x00\x01 y",
    "ΑΣ ΣΑΣ É é İ 你好 العربية हिन्दी 👩‍👩‍👧 ﬁ", "<|endoftext|><|endoftext|>",
]


def noise(n, alphabet, length, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(length)) for _ in range(n)]


def test_ids_and_text_are_the_librarys():
    mine, theirs = bpe.load(PATH), tokenizers.Tokenizer.from_file(PATH)
    texts = ODD + noise(60, "abc", 50, 1) + noise(60, "abcdefghijklmnopqrstuvwxyz'!.-#0é ", 200, 2) + noise(40, [chr(c) for c in range(32, 0x400)], 120, 3)
    for text, ids in zip(texts, mine.encode(texts)):
        want = theirs.encode(text, add_special_tokens=False)
        assert np.frombuffer(ids, "<u4").tolist() == want.ids, text
        assert mine.decode(ids) == theirs.decode(want.ids, skip_special_tokens=False)


def test_every_code_point_alone_is_encoded_as_by_the_library():
    mine, theirs = bpe.load(PATH), tokenizers.Tokenizer.from_file(PATH)
    texts = [f"a{chr(c)}b" for c in range(0x110000) if not 0xD800 <= c < 0xE000] + ["BAKI ƏLI", "Ɔkan", "aȺb", "İstanbul", "ȺȾ Ɐ"]
    for at in range(0, len(texts), 50_000):
        part = texts[at : at + 50_000]
        want = theirs.encode_batch(part, add_special_tokens=False)
        assert [t for t, ids, w in zip(part, mine.encode(part), want) if np.frombuffer(ids, "<u4").tolist() != w.ids] == []


def test_forgotten_words_and_pairs_are_learned_anew(monkeypatch):
    texts = noise(80, "abcdefgh ", 200, 7)
    whole = bpe.WordBpe(PATH).encode(texts)
    monkeypatch.setattr(bpe, "CACHE_WORDS", 20)
    monkeypatch.setattr(bpe, "CACHE_PAIRS", 10)
    small = bpe.WordBpe(PATH)
    assert [i for t in texts + texts for i in small.encode([t])] == whole + whole


def test_long_texts_and_a_full_memory(monkeypatch):
    monkeypatch.setattr(bpe, "SEGMENT_CHARS", 50)
    monkeypatch.setattr(bpe, "CACHE_WORDS", 7)
    mine, theirs = bpe.WordBpe(PATH), tokenizers.Tokenizer.from_file(PATH)
    text = "some words, and <|endoftext|> more of them; " * 30
    assert np.frombuffer(mine.encode([text, "x", text])[2], "<u4").tolist() == theirs.encode(text, add_special_tokens=False).ids


def test_queries(spark):
    docs = spark.createDataFrame([(i, t, "c") for i, t in enumerate([*ODD, None, "word " * 9000])], "doc_id long, text string, ids string")
    theirs = tokenizers.Tokenizer.from_file(PATH)
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for r in bpe.query(docs, PATH).collect():
        ids = theirs.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(theirs.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    rows = packing.query(docs, PATH).toPandas()
    assert set(rows["doc_id"]) == set(texts)
    for doc, part in rows.sort_values("piece").groupby("doc_id"):
        assert part["length"].sum() == len(theirs.encode(texts[doc], add_special_tokens=False).ids) + 1
        assert (part["length"].iloc[:-1] == 4096).all() and (part["start"] == np.arange(len(part)) * 4096).all()
    check_places(rows, 4096)
    assert packing.query(docs.limit(0), PATH).count() == 0


def check_places(rows, capacity):
    for _, part in rows.sort_values("offset").groupby("sequence_id"):
        ends = part["length"].cumsum()
        assert (part["offset"] == ends - part["length"]).all() and ends.iloc[-1] <= capacity


def brute_fullest(lengths, counts, room):
    sums = {0}
    for n in lengths:
        for _ in range(counts[n]):
            sums |= {s + n for s in sums if s + n <= room}
    return max(sums)


def test_fullest_is_the_largest_subset_sum():
    rng = random.Random(4)
    for _ in range(200):
        counts = {rng.randrange(1, 40): rng.randrange(1, 5) for _ in range(rng.randrange(1, 7))}
        lengths, room = sorted(counts, reverse=True), rng.randrange(0, 60)
        used = packing.fullest(lengths, counts, room)
        assert all(k <= counts[n] for n, k in used.items())
        assert sum(n * k for n, k in used.items()) == brute_fullest(lengths, counts, room)


def test_packing_is_tight_and_whole(spark):
    rng = random.Random(5)
    sizes = [rng.choice([50, 50, 50, rng.randrange(1, 101)]) for _ in range(2000)]  # most rows share a length
    df = spark.createDataFrame(list(enumerate(sizes)) + [(5000, None), (5001, 0), (5002, 101)], "id long, length long")
    rows = packing.pack(df, ["id"], capacity=100).toPandas().set_index("id")
    assert len(rows) == 2003 and rows["sequence_id"].isna().sum() == 3
    rows = rows.dropna()
    check_places(rows, 100)
    assert rows["sequence_id"].nunique() <= -(-sum(sizes) // 100) + 2
