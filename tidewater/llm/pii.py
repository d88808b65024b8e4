"""Personal data: fixed patterns, and bootstrapped contextual extraction beyond them.

The fixed patterns give seed entities. Every token that looks like an identifier is an instance; its
left word, its right word and its shape, alone and together, are the lexical patterns that the instance induces. On the
graph of patterns and instances Spark alternates two steps: a pattern's score for a kind is the share
of that kind among its instances that count (see ``discover``), an instance's score is that of its best pattern, contexts
before shapes; seeds stay at 1. Instances that end above a threshold without being seeds are identifiers that the fixed patterns miss.
All of it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rules import let
from .shared import written

KINDS = ("email", "ip", "card", "phone")
# Possessive forms and look-behinds find what the plain forms find, in time linear in the text.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){15,}+",  # shorter runs can't be cards
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
HINTS = {"email": "@", "phone": "+"}
TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
ROUNDS = 3
#: A pattern needs so many different seeds, a pattern and an instance such a score.
MIN_SEEDS = 5
MIN_SCORE = 0.8
#: What is found has so many characters: shorter numbers identify nobody.
MIN_CHARS = 6
SPAN = "array<struct<start:int,stop:int>>"
FOUND = "array<struct<start:int,stop:int,value:string,lead:string,trail:string>>"
#: Elements that are added up at a time; only the steps of work depend on it.
_BLOCK = 128


def running(values: Column, both) -> Column:
    """What ``both`` makes of all elements before each one, from 0 on: within blocks, after one pass over the blocks' totals."""

    def scan(some: Column, begin: Column) -> Column:
        start = F.struct(begin.alias("at"), F.array().cast("array<int>").alias("out"))
        step = lambda a, x: F.struct(both(a["at"], x).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out"))
        return F.aggregate(some, start, step, lambda a: a["out"])

    def block(b: Column) -> Column:
        return F.slice(values, b * _BLOCK + 1, F.lit(_BLOCK))

    blocks = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / _BLOCK).cast("int"))
    totals = F.transform(blocks, lambda b: F.aggregate(block(b), F.lit(0), both))
    return let(totals, lambda t: let(scan(t, F.lit(0)), lambda begin: F.flatten(F.transform(blocks, lambda b: scan(block(b), F.get(begin, b))))))


def located(text: Column, pattern: str) -> Column:
    """The leftmost non-overlapping matches with their code-point places and the text between them (FOUND)."""
    pattern = F.lit(pattern)

    def place(found: Column) -> Column:
        def with_gaps(gaps: Column) -> Column:
            sizes = F.transform(found, lambda x, i: F.length(F.get(gaps, i)) + F.length(x))

            def one(at: Column):
                def at_match(x: Column, i: Column) -> Column:
                    stop = F.get(at, i) + F.length(F.get(gaps, i)) + F.length(x)
                    return F.struct((stop - F.length(x)).alias("start"), stop.alias("stop"), x.alias("value"), F.get(gaps, i).alias("lead"), F.get(gaps, i + 1).alias("trail"))

                return F.transform(found, at_match)

            return let(sizes, lambda x: let(running(x, lambda a, b: a + b), one))

        return F.when(F.size(found) == 0, F.array().cast(FOUND)).otherwise(let(F.split(text, pattern, -1), with_gaps).cast(FOUND))

    return let(F.regexp_extract_all(text, pattern, F.lit(0)), place)


def luhn(digits: Column) -> Column:
    def add(a: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return a + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def valid(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return match.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?:\.|$)){4}$")
    if kind == "card":
        return let(digits, lambda d: F.length(d).between(16, 19) & luhn(d))
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    """The places of a kind's valid matches, by start (SPAN)."""
    kept = F.transform(
        F.filter(located(text, PATTERNS[kind]), lambda x: valid(kind, x["value"])),
        lambda x: F.struct(x["start"].alias("start"), x["stop"].alias("stop")),
    )
    return F.when(F.contains(text, F.lit(HINTS[kind])), kept).otherwise(F.array().cast(SPAN)) if kind in HINTS else kept


def spaced(text: Column) -> Column:
    """``text`` with every white space of words as a space."""
    for other in "\t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(other), F.lit(" "))
    return text


def _word(gap: Column, last: bool) -> Column:
    return F.lower(F.substring_index(F.trim(gap), " ", -1 if last else 1))


def touched(tokens: Column, places: Column) -> Column:
    """Of each of the ``tokens`` whether one of the ``places`` overlaps it; both are in order and don't overlap themselves.

    The place of a token among the starts (ends) of the others tells how many of them come before its end (start).
    """

    def before(own: Column, others: Column, own_first: bool) -> Column:
        mine = F.transform(own, lambda x: F.struct(x.alias("at"), F.lit(0 if own_first else 1).alias("other")))
        rest = F.transform(others, lambda x: F.struct(x.alias("at"), F.lit(1 if own_first else 0).alias("other")))
        numbered = F.transform(F.sort_array(F.concat(mine, rest)), lambda x, i: F.struct(x["other"].alias("other"), i.alias("i")))
        return F.transform(F.filter(numbered, lambda x: x["other"] == (0 if own_first else 1)), lambda x, i: x["i"] - i)

    starting = before(F.transform(tokens, lambda t: t["stop"]), F.transform(places, lambda s: s["start"]), True)
    ended = before(F.transform(tokens, lambda t: t["start"]), F.transform(places, lambda s: s["stop"]), False)
    return F.zip_with(starting, ended, lambda a, b: a > b)


def instances(text: Column, base: dict[str, Column]) -> Column:
    """Tokens with a digit or an at sign: place, shape (runs of letters as one), left and right word, and the kind of a base span there.

    Next to another such token the word is ``<id>``, at the ends of the text ``<end>``.
    """
    shape = lambda v: F.regexp_replace(F.regexp_replace(F.regexp_replace(v, r"\p{Lu}+", "A"), r"\p{Ll}+", "a"), "[0-9]", "9")
    beside = lambda word, at_end: F.when(word != "", word).when(at_end, "<end>").otherwise("<id>")

    def describe(found: Column) -> Column:
        flags = [F.when((F.size(places) > 0) & (F.size(found) > 0), touched(found, places)) for places in base.values()]

        def labelled(marks: Column) -> Column:
            def one(x: Column, i: Column) -> Column:
                seed = F.lit(None).cast("string")
                for k, kind in reversed(list(enumerate(base))):
                    seed = F.when(F.get(F.get(marks, k), i), kind).otherwise(seed)
                return F.struct(
                    x["start"].alias("start"),
                    x["stop"].alias("stop"),
                    shape(x["value"]).alias("shape"),
                    beside(_word(x["lead"], True), i == 0).alias("left"),
                    beside(_word(x["trail"], False), i == F.size(found) - 1).alias("right"),
                    seed.alias("seed"),
                )

            return F.transform(found, one)

        return let(F.array(*flags), labelled)

    return let(located(spaced(text), TOKEN), describe)


def scanned(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """A written table with a struct ``kept`` of the columns ``keep``, a row id, the base spans of each kind and the instances; null texts have none."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("kept"), text.alias("text"), *(base_spans(text, k).alias(k) for k in KINDS))
    tokens = instances(F.col("text"), {k: F.col(k) for k in KINDS})
    return written(base.select("kept", F.monotonically_increasing_id().alias("row"), *KINDS, tokens.alias("tokens")), "pii")


def discover(scan: DataFrame) -> DataFrame:
    """(row, kind, start, stop) of instances that patterns find and base spans don't touch.

    A pattern's score for a kind is the share of its positives, which are seeds and, from the second round on, what was found as that kind. Its negatives
    are seeds of other kinds, what was found as another kind and tokens too short to identify anybody; tokens that nothing is known of are negatives
    of patterns with one neighbour or none, but not of contexts (both neighbours), whose instances may all be of a form that no seed has.
    """
    key = ["row", "start", "stop"]
    flat = scan.select("row", F.explode("tokens").alias("t")).select("row", "t.start", "t.stop", "t.shape", "t.left", "t.right", "t.seed")
    pattern = lambda name, *cols: F.struct(F.lit(name == "context").alias("context"), F.xxhash64(F.lit(name), *cols).alias("pattern"))
    # Another identifier beside one is no word: it tells of lists and of parts of numbers, not of kinds.
    before, after = F.col("left") != "<id>", F.col("right") != "<id>"
    words = [F.when(before, pattern("left", "left", "shape")), F.when(after, pattern("right", "right", "shape")), F.when(before, pattern("word", "left")), F.when(before & after, pattern("context", "left", "right"))]
    patterns = F.array_compact(F.array(pattern("shape", "shape"), *words))
    short = (F.col("stop") - F.col("start") < MIN_CHARS) & F.col("seed").isNull()
    edges = written(flat.select(*key, "seed", short.alias("short"), F.explode(patterns).alias("p")).select(*key, "seed", "short", "p.context", "p.pattern"), "pii-graph")
    totals = edges.groupBy("pattern").agg(F.count("*").alias("n"), F.count_if(F.col("short") | F.col("seed").isNotNull()).alias("known"))
    seeds = edges.filter("seed is not null").select(*key, F.col("seed").alias("kind"), F.lit(1.0).alias("score")).distinct()
    scores, found = seeds, None
    for _ in range(ROUNDS):
        of = scores.join(edges.select(*key, "pattern", "context", "seed"), key)
        good = of.groupBy("pattern", "context", "kind").agg(F.sum("score").alias("s"), F.count("*").alias("support"), F.count_if(F.col("seed").isNull()).alias("new")).filter(F.col("support") >= MIN_SEEDS)
        others = of.groupBy("pattern").agg(F.count_if(F.col("seed").isNull()).alias("all_new"))
        good = good.join(totals, "pattern").join(others, "pattern")
        judged = F.when(F.col("context"), F.col("known") + F.col("all_new")).otherwise(F.col("n"))
        good = good.select("pattern", "kind", "context", (F.col("s") / judged).alias("score")).filter(F.col("score") >= MIN_SCORE)
        new = edges.filter(~F.col("short") & F.col("seed").isNull()).drop("context").join(good, "pattern").groupBy(*key).agg(F.max(F.struct("context", "score", "kind")).alias("best"))
        found = written(new.select(*key, F.col("best.kind").alias("kind"), F.col("best.score").alias("score")), "pii-scores")
        scores = seeds.unionByName(found)
    return found.select("row", "kind", "start", "stop")


def spans(scan: DataFrame) -> DataFrame:
    """``scan`` with ``base`` and ``found``: arrays of (rank of the kind, start, stop), in that order."""
    rank = F.lit(0)
    for i, k in enumerate(KINDS):
        rank = F.when(F.col("kind") == k, F.lit(i)).otherwise(rank)
    more = discover(scan).groupBy("row").agg(F.collect_list(F.struct(rank.alias("kind"), "start", "stop")).alias("more"))

    def ranked(i: int, kind: str) -> Column:
        return F.transform(kind, lambda s: F.struct(F.lit(i).alias("kind"), s["start"].alias("start"), s["stop"].alias("stop")))

    base = F.concat(*(ranked(i, k) for i, k in enumerate(KINDS)))
    joined = scan.withColumn("base", base).drop("tokens").join(more, "row", "left")
    return joined.withColumn("found", F.sort_array(F.concat("base", F.coalesce("more", F.array().cast("array<struct<kind:int,start:int,stop:int>>"))))).drop("more")


def written_out(spans_col: str) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans_col, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["stop"])), ",")


def query(docs: DataFrame) -> DataFrame:
    found = spans(scanned(docs))
    return found.select(
        "kept.doc_id",
        *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(written_out("base").cast("binary"), 256).alias("base_sha256"),
        written_out("found").alias("spans"),
    )


def masked(text: Column, places: Column) -> Column:
    """``text`` with every run of overlapping spans replaced by <KIND> of its first."""
    ordered = F.sort_array(F.transform(places, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind"))))
    names = F.array(*(F.lit(f"<{k.upper()}>") for k in KINDS))

    def cut(spans_: Column) -> Column:
        stops = F.transform(spans_, lambda s: s["stop"])

        def replaced(done: Column) -> Column:
            """``done``: where the spans before each one end. A run begins where they have ended."""
            numbered = F.transform(spans_, lambda s, i: F.struct(F.get(done, i).alias("done"), s["start"].alias("start"), s["kind"].alias("kind")))

            def joined(runs: Column) -> Column:
                def block(b: Column) -> Column:
                    return let(F.slice(runs, b * _BLOCK + 1, F.lit(_BLOCK)), filled)

                def filled(some: Column) -> Column:
                    begin, end = F.get(some, 0)["done"], F.element_at(some, -1)["start"]
                    part = lambda piece: F.array_join(
                        F.transform(some, lambda r: F.concat(F.substring(piece, r["done"] - begin + 1, r["start"] - r["done"]), F.get(names, r["kind"]))), ""
                    )
                    return let(F.substring(text, begin + 1, end - begin), part)

                blocks = F.sequence(F.lit(0), F.floor((F.size(runs) - 1) / _BLOCK).cast("int"))
                return F.concat(F.array_join(F.transform(blocks, block), ""), F.substring(text, F.array_max(stops) + 1, F.length(text)))

            return let(F.filter(numbered, lambda r: r["start"] >= r["done"]), joined)

        return let(stops, lambda x: let(running(x, lambda a, b: F.greatest(a, b)), replaced))

    return let(ordered, cut)


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` with all spans masked in ``text`` and ``n_chars`` counted anew where the text changes; null texts stay null."""
    keep = [c for c in docs.columns]
    inner = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)))
    text = f"c{keep.index('text')}"
    found = spans(scanned(inner, text, tuple(inner.columns)))
    old = F.col("kept")[text]
    out = found.withColumn("new", F.when(F.size("found") > 0, masked(old, F.col("found"))).otherwise(old))
    cols = []
    for i, c in enumerate(keep):
        value = F.col("kept")[f"c{i}"]
        if c == "text":
            value = F.col("new")
        elif c == "n_chars":
            value = F.when(F.size("found") > 0, F.length("new").cast(docs.schema[c].dataType)).otherwise(value)
        cols.append(value.alias(c))
    return out.select(*cols)
