import hashlib
import random
import re
import string

from tidewater.llm import secretscan as S


def plain(text):
    """The base spans by the patterns as they are written."""
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    return sorted(out + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16])


def shown(spans):
    return ",".join(f"{S.KINDS[k]}:{s}:{e}" for s, k, e in spans)


def secret(rng, n=40, letters=string.ascii_letters + string.digits):
    while True:
        found = "".join(rng.choice(letters) for _ in range(n))
        if re.search("[0-9]", found) and re.search("[A-Za-z]", found):
            return found


def test_base_spans(spark):
    rng = random.Random(3)
    bits = ["password", "PassWord", "secret", "token", "tokentoken", "api_key", "apikey", "ſecret", "toKen", '"', "'", " ", "   ", ":", "=", "==", "AKIA", "AKIAAKIA", "A1B2C3D4E5F6G7", "deadbeef", "0123456789abcdef", "DEADBEEF", "é", "€", "\n", ".", "x_y", "-", "abcdefgh1234"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(60))) for _ in range(400)]
    texts += ["", None, "a" * 50_000, "token" * 9000 + "=" + "z" * 20, "0" * 15, "0" * 16, "AKIA" + "A" * 13, "AKIA" + "A" * 14, "secret=" + "b" * 11, "secret=" + "q" * 12, "é" * 9 + "token: '" + "q" * 30 + "'", texts[0], texts[0]]
    docs = spark.createDataFrame([(f"d{i}", t, 7, "x") for i, t in enumerate(texts)] + [(None, "token=" + "h" * 12, 1, None)], "doc_id string, text string, spans int, kind string").repartition(3)
    got = S.query(docs).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        text = "token=" + "h" * 12 if r["doc_id"] is None else texts[int(r["doc_id"][1:])]
        base = plain(text)
        assert [r[f"n_{k}"] for k in S.KINDS[:3]] == [sum(s[1] == k for s in base) for k in range(3)]
        assert r["base_sha256"] == hashlib.sha256(shown(base).encode()).hexdigest()
        assert [x for x in r["spans"].split(",") if x and not x.startswith("novel")] == [x for x in shown(base).split(",") if x]
    assert S.query(docs.limit(0)).count() == 0


def test_new_strings_are_found_where_secrets_are_named(spark):
    """Recall on planted keys that the base forms miss; names, paths and placeholders of the same places stay alone."""
    rng = random.Random(5)
    frames = ['client_secret -> "{}" here', "Authorization: Bearer {}", "set credential {} and go on", "private_key is {}\nnext line", "signing_key ({})", "the passphrase was {} then"]
    names = ["sha256WithRSAEncryption2", "your_api_key_here_123", "refresh_token_expires_in_3600", "test_password_example_1234", "config/production/credentials2", "oauth2_access_token_endpoint", "aaaaaaaaaaaaaaaaaaaa1111", "00000000-0000-0000-0000-000000000000", "authentication_service_v2_host", "https://host.example/auth/v2/token/endpoint", "1234567890abcdefghij", "VISITORMANAGEMENTPORTAL1"]
    rows, wanted = [], {}
    for i in range(300):
        frame, key = rng.choice(frames), secret(rng, rng.randrange(20, 50))
        text = "é some words " + frame.format(key if i % 2 else rng.choice(names)) + f"\nmore words {i}"
        rows.append((i, text))
        if i % 2:
            wanted[i] = (text.index(key), text.index(key) + len(key))
    rows += [(1000 + i, f"plain prose without anything {secret(rng)} named") for i in range(30)]
    found = {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"] if s["kind"] == "novel"] for r in S.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    hit = sum(found[i] == [w] for i, w in wanted.items())
    assert hit >= 0.97 * len(wanted)
    assert sum(len(v) for i, v in found.items() if i not in wanted) <= 0.05 * 150


def test_copies_dont_make_their_secret_known(spark):
    rng = random.Random(7)
    key = secret(rng)
    copies = [(i, f"the credential {key} of the service") for i in range(200)]
    assert all(r["spans"][0]["kind"] == "novel" for r in S.scan(spark.createDataFrame(copies, "doc_id long, text string")).collect())


def test_corpus_words_prime_the_dictionary(spark):
    """A product's name isn't new where many documents name it."""
    rows = [(i, f"auth of Quvoxandrel{i % 7}: see Quvoxandrel Timbrowsky number {secret(random.Random(i), 24)} x{i}") for i in range(40)]
    words = S.dictionary(spark.createDataFrame(rows, "doc_id long, text string"))
    assert b"Quvoxandrel" in words and b"Timbrowsky" in words and len(words) <= S.DICTIONARY_WORDS
