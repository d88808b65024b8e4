"""The queries of the training-data operators and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, digest, html, interactions, langid, lm, packing, pii, rules, search, secretscan, simhash, suffix

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.query(table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.query(table(spark, sf_dir, "documents"), tokenizer_path())


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.query(table(spark, sf_dir, "documents"), tokenizer_path())


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.query(table(spark, sf_dir, "pages"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.query(table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.query(table(spark, sf_dir, "documents"))


def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.query(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.query(table(spark, sf_dir, "documents"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.query(table(spark, sf_dir, "documents"))


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.query(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_lm_scores": op1_lm_scores, "op2_packing": op2_packing, "op3_repeats": op3_repeats, "op4_quality_rules": op4_quality_rules, "op5_fingerprints": op5_fingerprints, "op6_pii": op6_pii, "op7_bpe": op7_bpe, "op8_html": op8_html, "op9_language": op9_language, "op10_simhash": op10_simhash, "op11_search": op11_search, "op12_secrets": op12_secrets, "op13_filter_audit": op13_filter_audit}


OP1_SQL = r"""
with words as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[\x20\x09-\x0D]+'), lambda x: x <> '') ws
  from documents),
places as (select doc_id, unnest(ws) w1, generate_subscripts(ws, 1) p from words),
grams as (select doc_id, p, w1, lag(w1) over d w2, lag(w1, 2) over d w3 from places window d as (partition by doc_id order by p)),
own1 as (select doc_id, w1, count(*) n from grams group by all),
own2 as (select doc_id, w2, w1, count(*) n from grams where w2 is not null group by all),
own3 as (select doc_id, w3, w2, w1, count(*) n from grams where w3 is not null group by all),
all1 as (select w1, sum(n) n from own1 group by all),
all2 as (select w2, w1, sum(n) n from own2 group by all),
all3 as (select w3, w2, w1, sum(n) n from own3 group by all),
rest1 as (select doc_id, w1, a.n - o.n n from own1 o join all1 a using (w1)),
rest2 as (select doc_id, w2, w1, a.n - o.n n from own2 o join all2 a using (w2, w1)),
rest3 as (select doc_id, w3, w2, w1, a.n - o.n n from own3 o join all3 a using (w3, w2, w1)),
size as (select doc_id, len(ws) n_words, sum(len(ws)) over () - len(ws) others from words),
scored as (
  select g.doc_id,
    case when c.n > 0 then log10(c.n / y.n)
         when b.n > 0 then log10(b.n / x.n) + case when g.w3 is not null then log10(0.4) else 0 end
         else case when a.n > 0 then log10(a.n / s.others) else log10(1.0 / (s.others + 1)) end
              + case when g.w3 is not null then 2 * log10(0.4) when g.w2 is not null then log10(0.4) else 0 end
    end score
  from grams g join size s on s.doc_id = g.doc_id
  join rest1 a on a.doc_id = g.doc_id and a.w1 = g.w1
  left join rest2 b on b.doc_id = g.doc_id and b.w2 = g.w2 and b.w1 = g.w1
  left join rest3 c on c.doc_id = g.doc_id and c.w3 = g.w3 and c.w2 = g.w2 and c.w1 = g.w1
  left join rest1 x on x.doc_id = g.doc_id and x.w1 = g.w2
  left join rest2 y on y.doc_id = g.doc_id and y.w2 = g.w3 and y.w1 = g.w2)
select s.doc_id, cast(s.n_words as bigint) n_words, round(coalesce(sum(score) / s.n_words, 0), 6) mean_log10
from size s left join scored z on z.doc_id = s.doc_id
group by s.doc_id, s.n_words
"""

OP11_SQL = r"""
with terms_of as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') ts from documents),
asked as (
  select distinct item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) term from benchmark),
totals as (select count(*) filter (len(ts) > 0) n_docs, sum(len(ts)) n_terms from terms_of),
lengths as (select doc_id, 100 - 50 + ((50 * len(ts) * n_docs) // n_terms) m from terms_of, totals where len(ts) > 0),
occurs as (select doc_id, term, count(*) tf from (select doc_id, unnest(ts) term from terms_of) where term in (select term from asked) group by all),
weights as (select term, cast(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) as bigint) w from occurs, totals group by term, n_docs),
scores as (
  select item_id, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) as bigint) score
  from asked join occurs using (term) join weights using (term) join lengths using (doc_id) group by all),
ranked as (select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as int) as rank, doc_id, score from scores where score > 0)
select * from ranked where rank <= 50
"""
OP13_SQL = r"""
with recursive words as (
  select doc_id, coalesce(source, '') part, coalesce(text, '') t, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') ws from documents),
smallest as (select t, min(doc_id) first_id from words group by t),
good_ids as (select distinct doc_id from labels where quality = 1),
toxic_ids as (select distinct doc_id from labels where toxic = 1),
failed as (
  select doc_id, part, len(ws) < 50 a, 100 * len(list_distinct(ws)) < 65 * len(ws) b, 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) c,
    regexp_matches(t, '[#$%&*|]') d, coalesce(doc_id > first_id, false) e, doc_id in (select doc_id from good_ids) good, doc_id in (select doc_id from toxic_ids) toxic
  from words join smallest using (t)),
flags as (select part, [a, b, c, d, e] f, count(*) n, count(*) filter (good) n_good, count(*) filter (toxic) n_toxic from failed group by 1, 2),
orders(o, used) as (select '', 0 union all select o || l, used + 1 from orders, unnest(string_split('ABCDE', '')) x(l) where not contains(o, l) and used < 5),
steps as (select o filter_order, cast(s as int) step, [ord(x) - 64 for x in string_split(o[1:s - 1], '') if x <> ''] earlier, ord(o[s]) - 64 now from orders, range(1, 6) r(s) where used = 5),
hits as (
  select part, filter_order, step, now, n, n_good, n_toxic, f[now] fails, len([i for i in earlier if f[i]]) > 0 gone, len([x for x in f if x]) failures
  from flags, steps),
counted as (
  select part, filter_order, step, now, coalesce(sum(n) filter (not gone and not fails), 0) kept, coalesce(sum(n) filter (not gone and fails), 0) removed,
    coalesce(sum(n) filter (gone and fails), 0) redundant, coalesce(sum(n) filter (fails and failures = 1), 0) unique_fails,
    coalesce(sum(n_good) filter (not gone and fails), 0) good_lost, coalesce(sum(n_toxic) filter (not gone and fails), 0) toxic_lost
  from hits group by 1, 2, 3, 4)
select part, filter_order, step, cast(kept as bigint) kept, cast(removed as bigint) removed, cast(redundant as bigint) redundant, cast(unique_fails as bigint) unique_fails,
  cast(good_lost as bigint) good_lost, cast(toxic_lost as bigint) toxic_lost, cast(sum(removed) over (partition by part, now) as bigint) shapley
from counted
"""


def oracle_sql() -> dict[str, str]:
    """The others learn, hash with XXH64, tokenize or index, which DuckDB's SQL can't express: tests have plain versions."""
    return {"op1_lm_scores": OP1_SQL, "op11_search": OP11_SQL, "op13_filter_audit": OP13_SQL}
