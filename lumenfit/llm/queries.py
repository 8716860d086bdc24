"""The registered queries of the subpackage, with SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import chat, decontaminate, divergence, language, lexical, line_dedup, mixing, neighbours, ngram_join, private, quality, secrets, token_store
from .common import table


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op1_mixing(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "rate", "copies")


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def quality_model(spark: SparkSession, sf: str) -> quality.Model:
    return quality.fit(table(spark, sf, "documents"), table(spark, sf, "labels").where(~held_out()))


def op2_quality(spark: SparkSession, sf: str) -> DataFrame:
    scores = quality.score(table(spark, sf, "documents"), quality_model(spark, sf))
    return scores.select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op3_token_store(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    store = token_store.write(docs, tokenizer_path())
    return token_store.read(docs, store, ids=False)


def op4_secrets(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return secrets.scan(docs, secrets.train(secrets.labelled(docs)))


def op5_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op6_private(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return private.scan(docs, private.train(private.labelled(docs)))


def op7_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf, "embeddings"))


def op8_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf, "documents"))
    return kept.select("doc_id", "n_lines", "n_removed", F.length("text").cast("long").alias("kept_chars"), F.md5("text").alias("kept_md5"))


def op9_chat(spark: SparkSession, sf: str) -> DataFrame:
    sides = chat.rotate(table(spark, sf, "conversations"))
    joined = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    return sides.select("conv_id", "assistant", "part", "piece", "n_turns", "n_own", "text", joined("mask_starts").alias("mask_starts"), joined("mask_ends").alias("mask_ends"))


def op10_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf, "documents"), k=4, percent=85)


def op11_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return divergence.audit(table(spark, sf, "documents"))


def op12_lexical(spark: SparkSession, sf: str) -> DataFrame:
    return lexical.search(lexical.build(table(spark, sf, "documents")), table(spark, sf, "benchmark"))


def op13_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    found = language.label(docs, language.train(docs.where(~held)))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


QUERIES = {f.__name__: f for f in (op1_mixing, op2_quality, op3_token_store, op4_secrets, op5_decontamination, op6_private, op7_neighbours, op8_line_dedup, op9_chat, op10_jaccard,
                                op11_divergence, op12_lexical, op13_language)}

_LOW = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TRIM = r"trim(line, e' \t\n\x0b\x0c\r')"

ORACLES = {
    "op5_decontamination": rf"""
with d as (select doc_id, regexp_extract_all({_LOW.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select coalesce(item_id::varchar, '') as item, regexp_extract_all({_LOW.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
size as (select item, w, least(len(w), 10) as k from b where len(w) > 0),
win as (select distinct item, k, array_to_string(w[i:i + k - 1], ' ') as s from (select item, w, k, unnest(range(1, len(w) - k + 2)) as i from size)),
dk as (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as i from d, (select distinct k from size) where len(w) >= k),
occ as (select doc_id, i, dk.k, item from dk join win on win.k = dk.k and win.s = array_to_string(dk.w[i:i + dk.k - 1], ' ')),
hit as (select doc_id, count(distinct p) as n from (select doc_id, unnest(range(i, i + k)) as p from occ) group by 1),
it as (select doc_id, count(*) as n, string_agg(item, ',' order by item collate "C") as s from (select distinct doc_id, item from occ) group by 1)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(hit.n, 0)::bigint as n_hit, coalesce(it.n, 0)::bigint as n_items,
sha256(coalesce(it.s, '')) as items_sha256, coalesce(hit.n, 0) > 0 as contaminated
from d left join hit using (doc_id) left join it using (doc_id)""".replace(' collate "C"', ""),
    "op8_line_dedup": rf"""
with l as (select doc_id, source, text, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as pos from documents),
t as (select doc_id, source, pos, line, {_TRIM} as s from l),
bad as (select s from t where s <> '' group by s having count(distinct source) >= 10),
k as (select doc_id, count(*) filter (where s <> '') as n_lines, count(*) filter (where s in (select s from bad)) as n_removed,
  coalesce(string_agg(line, chr(10) order by pos) filter (where s not in (select s from bad)), '') as kept from t group by 1)
select doc_id, n_lines::bigint as n_lines, n_removed::bigint as n_removed, length(kept)::bigint as kept_chars, md5(kept) as kept_md5 from k
union all select doc_id, 0, 0, length(text), md5(text) from documents where text is null""",
    "op9_chat": r"""
with t as (select conv_id, turn, coalesce(trim(role), '') as speaker, coalesce(text, '') as content, floor(turn / 256)::bigint as part from conversations),
p as (select distinct conv_id, speaker as assistant from t),
r as (select t.conv_id, assistant, part, turn, speaker, content, speaker = assistant as own,
  case when speaker = assistant then '<|assistant|>' || chr(10) else '<|user name=' || speaker || '|>' || chr(10) end as head, content || '<|end|>' as body
  from t join p using (conv_id)),
s as (select *, coalesce(sum(length(head) + length(body) + 1) over (partition by conv_id, assistant, part order by turn, speaker, content
  rows between unbounded preceding and 1 preceding), 0)::bigint as before from r)
select conv_id, assistant, part, 0::bigint as piece, count(*)::bigint as n_turns, count(*) filter (where own)::bigint as n_own,
string_agg(head || body || chr(10), '' order by turn, speaker, content) as text,
coalesce(string_agg((before + length(head))::varchar, ',' order by turn, speaker, content) filter (where own), '') as mask_starts,
coalesce(string_agg((before + length(head) + length(body))::varchar, ',' order by turn, speaker, content) filter (where own), '') as mask_ends
from s group by conv_id, assistant, part""",
    "op11_divergence": rf"""
with d as (select coalesce(lang, '') as lang, coalesce(source, '') as source, doc_id,
  regexp_extract_all({_LOW.format("coalesce(text, '')")}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w from documents),
g as (select distinct lang, source from d),
t as (select lang, source, doc_id, unnest(w) as term from d),
v as (select lang, term from t group by lang, term having count(distinct doc_id) >= 10),
c as (select lang, source, term, count(*) as n from t join v using (lang, term) group by all),
size as (select lang, count(*) as v from v group by lang),
k as (select g.lang, g.source, v.term, coalesce(c.n, 0) as n from g join v using (lang) left join c on c.lang = g.lang and c.source = g.source and c.term = v.term),
p as (select lang, source, term, n, 1 + (1000000000::hugeint * (n + 2)) // (sum(n) over (partition by lang, source) + 2 * v) as p from k join size using (lang)),
l as (select lang, term, sum(n) as n from k group by lang, term),
q as (select lang, term, 1 + (1000000000::hugeint * (n + 2)) // (sum(n) over (partition by lang) + 2 * v) as q from l join size using (lang)),
pairs as (select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
r as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(x.value, 0)::bigint as value from g a join g b on a.lang = b.lang and a.source <> b.source
  left join pairs x on x.lang = a.lang and x.source = a.source and x.item = b.source
  union all select lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::bigint from p join q using (lang, term) where n > 0 and p > q)
select * from (select lang, source, part, item, value, row_number() over (partition by lang, source, part order by value desc, item)::int as rank from r) where part = 'pair' or rank <= 10""",
    "op12_lexical": rf"""
with d as (select row_number() over () as id, doc_id, regexp_extract_all({_LOW.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w from documents),
whole as (select count(*) filter (where len(w) > 0) as n, sum(len(w))::bigint as l from d),
asked as (select distinct item_id, unnest(regexp_extract_all({_LOW.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark),
tf as (select id, doc_id, len(w) as n, term, count(*) as tf from (select id, doc_id, w, unnest(w) as term from d) group by all),
df as (select term, count(*) as df from tf group by term),
m as (select id, 10 + (90 * len(w) * n) // l as m from d, whole where len(w) > 0),
s as (select item_id, id, doc_id, sum(floor(1000 * ln((2 * whole.n + 2)::double / (2 * df + 1)))::bigint * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score
  from asked join tf using (term) join df using (term) join m using (id), whole group by all)
select item_id, rank, doc_id, score from (select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank, doc_id, score from s where score > 0) where rank <= 10""",
}
