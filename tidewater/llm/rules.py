"""Quality rules: native text statistics and a learned decision list over them.

The list is learned by sequential covering. Each round grows a conjunction of thresholds that covers
bad documents and no good ones, prunes it on rows it was not grown on, and removes what it covers.
The result is one ordered CASE expression of Spark; no Python runs on the executors.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import free_name

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Labelled rows from which the list is learned (those with the smallest hashes of their ids).
TRAIN_ROWS = 20_000
MAX_RULES = 24
MAX_CONDITIONS = 4
MIN_PRECISION = 0.95
FEATURES = ("n_words", "mean_chars", "symbol_share", "bang_share", "upper_share", "dup_line_share", "repeat_share")


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), use), 0)


def words_of(text: Column) -> Column:
    """The runs of characters other than space and U+0009 to U+000D; null gives no words."""
    for other in "\t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(other), F.lit(" "))
    return F.coalesce(F.array_remove(F.split(text, " "), ""), F.array().cast("array<string>"))


def repeated_words(words: Column) -> Column:
    """How many words lie in a 3-word window that is found twice or more."""

    def covered(windows: Column) -> Column:
        pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def again(s: Column) -> Column:
            # try_element_at counts from 1 and from the end below 0: index 0 is kept out
            same = lambda h, k: F.coalesce(F.get(s, k)["h"] == h, F.lit(False))
            return F.sort_array(F.transform(F.filter(s, lambda x, k: same(x["h"], k - 1) | same(x["h"], k + 1)), lambda x: x["i"]))

        def total(at: Column) -> Column:
            gaps = F.transform(at, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - p, F.lit(3))))
            return F.aggregate(gaps, F.lit(0), lambda a, b: a + b)

        return let(pairs, lambda s: let(again(s), total))

    hashes = let(
        words,
        lambda w: F.when(
            F.size(w) >= 3,
            F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))


def statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds to ``docs`` the base counts (long) and the shares of FEATURES (double), all 0 for null and wordless texts.

    n_words, word_chars (code points in words), n_symbols (of ``#*$%&|<>``), n_dup_lines (lines with a
    word that equal an earlier line) and n_repeat_words (see ``repeated_words``). Columns of ``docs``
    with these names are replaced; all others stay.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    words, lines, n_lines, bangs, upper = own = [free_name(docs, n) for n in ("_words", "_lines", "_n_lines", "_bangs", "_upper")]
    spaced = docs.withColumn(words, words_of(text)).withColumn(lines, F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    out = spaced.withColumns(
        {
            "n_words": F.size(words).cast("long"),
            "word_chars": F.length(F.array_join(words, "")).cast("long"),
            "n_symbols": F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long"),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
            "n_repeat_words": repeated_words(F.col(words)).cast("long"),
            n_lines: F.size(lines),
            bangs: F.length(text) - F.length(F.replace(text, F.lit("!"), F.lit(""))),
            upper: F.regexp_count(text, F.lit(r"\p{Lu}")),
        }
    )
    share = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return out.withColumns(
        {
            "mean_chars": share("word_chars", "n_words"),
            "symbol_share": share("n_symbols", "word_chars"),
            "bang_share": share(bangs, "word_chars"),
            "upper_share": share(upper, "word_chars"),
            "dup_line_share": share("n_dup_lines", n_lines),
            "repeat_share": share("n_repeat_words", "n_words"),
        }
    ).drop(*own)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: int
    above: bool
    threshold: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        v = x[:, self.feature]
        return v > self.threshold if self.above else v <= self.threshold

    def column(self) -> Column:
        c = F.col(FEATURES[self.feature])
        return c > self.threshold if self.above else c <= self.threshold


Rule = tuple[Condition, ...]


def covers(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for c in rule:
        out &= c.holds(x)
    return out


def grow(x: np.ndarray, bad: np.ndarray) -> Rule:
    """Adds the condition with the largest information gain until no good row is covered; thresholds lie midway between rows."""
    rule: list[Condition] = []
    inside = np.ones(len(x), bool)
    while len(rule) < MAX_CONDITIONS and (inside & ~bad).any():
        p, n = (inside & bad).sum(), (inside & ~bad).sum()
        before, best = np.log2(p / (p + n)), (1e-9, None)
        for f in range(x.shape[1]):
            v = x[inside, f]
            for t in np.unique(np.quantile(v, np.linspace(0.0, 1.0, 65))):
                t = float(f"{t:.6g}")
                for above in (True, False):
                    hit = v > t if above else v <= t
                    q = int((hit & bad[inside]).sum())
                    m = int(hit.sum())
                    if q and m < len(v) and (gain := q * (np.log2(q / m) - before)) > best[0]:
                        best = (gain, Condition(f, above, t))
        if best[1] is None:
            break
        c = best[1]
        v = x[inside, c.feature]
        low, high = v[v <= c.threshold].max(), v[v > c.threshold].min()
        rule.append(Condition(c.feature, c.above, float(f"{(low + high) / 2:.6g}") if low < (low + high) / 2 < high else c.threshold))
        inside &= c.holds(x)
    return tuple(rule)


def prune(rule: Rule, x: np.ndarray, bad: np.ndarray) -> Rule:
    """The prefix of ``rule`` that does best on rows it was not grown on; shorter wins ties."""

    def worth(r: Rule) -> float:
        hit = covers(r, x)
        p, n = (hit & bad).sum(), (hit & ~bad).sum()
        return (p - n) / (p + n) if p + n else -1.0

    return max((rule[:k] for k in range(1, len(rule) + 1)), key=lambda r: (round(worth(r), 9), -len(r)), default=())


def learn(x: np.ndarray, bad: np.ndarray) -> list[Rule]:
    """Ordered rules that cover bad rows; every third row is kept for pruning. No bad or no good row: no rules."""
    out: list[Rule] = []
    hold = np.arange(len(x)) % 3 == 2
    while len(out) < MAX_RULES and bad[~hold].sum() >= 2 and (~bad[~hold]).any():
        rule = prune(grow(x[~hold], bad[~hold]), x[hold], bad[hold])
        hit = covers(rule, x) if rule else np.zeros(len(x), bool)
        if not rule or (hit & bad).sum() < 2 or (hit & bad).sum() < MIN_PRECISION * hit.sum():
            break
        out.append(rule)
        x, bad, hold = x[~hit], bad[~hit], hold[~hit]
    return out


def verdict(rules: list[Rule]) -> Column:
    """The decision list as one CASE: false for the first rule that holds, true if none does."""
    out = None
    for rule in rules:
        test = rule[0].column()
        for c in rule[1:]:
            test = test & c.column()
        out = F.when(test, False) if out is None else out.when(test, False)
    return F.lit(True) if out is None else out.otherwise(True)


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> list[Rule]:
    """Learns from ``rows`` labelled documents at most; labels and documents with null ids or qualities are left out."""
    known = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    joined = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")  # at most `rows` pairs of numbers
    joined = joined.groupBy("doc_id", "quality").agg(F.min("text").alias("text"))  # of rows with one id the smallest text
    got = statistics(joined).select(F.xxhash64("doc_id").alias("h"), "quality", *(F.col(c).cast("double") for c in FEATURES)).collect()
    got.sort(key=tuple)
    x = np.array([r[2:] for r in got], float).reshape(-1, len(FEATURES))
    return learn(x, np.array([r[1] == 0 for r in got], bool))


def judge(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """``statistics`` of ``docs`` with base_failed and kept: false if base_failed, else what the rules say."""
    return statistics(docs).withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & verdict(rules))


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return judge(docs.select("doc_id", "text"), train(docs, labels)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns as they are."""
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    own = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in names.items()), F.col("text").alias("text"))
    return judge(own, train(docs, labels)).filter("kept").select(*(F.col(n).alias(c) for c, n in names.items()))
