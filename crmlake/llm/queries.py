"""The registered queries of this folder, each over the whole of its table, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from crmlake.llm import (bpe_segment_tree, chat_preference, cross_polytope, html_main, jaccard_join, language_crf, mix_cube,
                         packing, pii_feistel, prefix_trie, quality_crf, spelling_permuterm, topk_balltree)
from crmlake.llm.shared import crc_mod, documents, session, table

QUERIES = {}
ORACLES: dict[str, str] = {}


def _crc32_sql(chars: str) -> str:
    """crc32 in SQL of a list of characters up to U+00FF, as UTF-8."""
    return f"""xor(list_reduce(list_prepend(4294967295::bigint, flatten(list_transform({chars},
      lambda c: case when unicode(c) < 128 then [unicode(c)::bigint]
                     else [192 + unicode(c)::bigint // 64, 128 + unicode(c)::bigint % 64] end))),
    lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)),
      lambda x, i: case when x % 2 = 1 then xor(x // 2, 3988292384) else x // 2 end)), 4294967295)"""


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = lambda spark, sf_dir: build(session(spark), sf_dir)
        if sql is not None:
            ORACLES[name] = sql.strip()
        return build

    return register


@query("op1_quality_lines")
def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = table(spark, sf_dir, "labels").where(crc_mod("doc_id", 3) != 1)
    model = quality_crf.learn(quality_crf.sample(docs, labels))
    return (quality_crf.score(docs, model)
            .select("doc_id", F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score", "predicted"))


@query("op2_topk_balltree", """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as e from embeddings
  where vec_id is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
p as (
  select q.vec_id as query_id, c.vec_id as vec_id,
         list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2]))::bigint as score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from p)
select query_id, rank::integer as rank, vec_id, score from r where rank <= 5
""")
def topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_balltree.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


@query("op3_packing")
def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))



@query("op4_jaccard_join", r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') as w from documents where doc_id is not null),
s as (
  select doc_id, list_distinct(case when len(w) >= 5
      then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
      when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s from w),
x as (select doc_id, unnest(s) as x from s),
p as (select a.doc_id as a, b.doc_id as b, count(*) as c from x a join x b using (x) where a.doc_id < b.doc_id group by all),
l as (
  select a, b from p join s sa on sa.doc_id = a join s sb on sb.doc_id = b
  where 100 * c >= 80 * (len(sa.s) + len(sb.s) - c)),
e as (select a, b from l union select b, a from l),
r as (select a, b from e union select r.a, e.b from r join e on r.b = e.a)
select s.doc_id, len(s.s) as n_shingles, least(s.doc_id, coalesce(m.b, s.doc_id)) as component_id
from s left join (select a, min(b) as b from r group by a) m on m.a = s.doc_id
""")
def jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join_documents(documents(spark, sf_dir))


@query("op5_chat_preference", chat_preference.PAIRS_SQL)
def chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations 2 k are the chosen ones of pair k, conversations 2 k + 1 the rejected ones."""
    side = F.pmod("conv_id", F.lit(2))
    pairs = chat_preference.sides(table(spark, sf_dir, "conversations"),
                                  F.shiftright("conv_id", 1), side == 0)
    text = lambda c: chat_preference.spans_text(F.col(c)).alias(c)
    return chat_preference.format_pairs(pairs).withColumns({
        c: text(c) for c in ("chosen_spans", "rejected_spans")})


@query("op5_chat_replies", chat_preference.REPLIES_SQL)
def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation is a chosen one; the rejected one has the last reply of a neighbour."""
    pairs = chat_preference.with_other_reply(table(spark, sf_dir, "conversations"))
    text = lambda c: chat_preference.spans_text(F.col(c)).alias(c)
    return chat_preference.format_pairs(pairs).withColumns({
        c: text(c) for c in ("chosen_spans", "rejected_spans")})


@query("op6_bpe_segment_tree")
def bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_segment_tree.digests(documents(spark, sf_dir))


@query("op7_language_words")
def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language_crf.learn(docs.where(crc_mod("doc_id", 5) != 0))
    return (language_crf.predict(docs, model)
            .select("doc_id", F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score"))


@query("op8_main_text")
def main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.extract(table(spark, sf_dir, "pages"))


@query("op9_cross_polytope")
def nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_polytope.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)


@query("op10_pseudonyms")
def pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return pii_feistel.pseudonymise(docs, count_column="n_replaced")


@query("op11_prefix_trie", r"""
with recursive o as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
         row_number() over (partition by conv_id order by turn nulls first,
           sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 as pos
  from conversations where conv_id is not null),
c as (
  select conv_id, conv_id - conv_id % 5 as head, {crc} % 9 as h from (select distinct conv_id from o)),
b as (
  select c.conv_id, 0 as part, o.pos, role, text from c join o on o.conv_id = c.head and o.pos < c.h
  union all
  select c.conv_id, 1, o.pos, role, text from c join o using (conv_id) where o.pos >= c.h),
n as (
  select *, row_number() over (partition by conv_id order by part, pos) as depth from b),
p as (
  select conv_id, 0 as depth, '' as key, 0 as bytes from c
  union all
  select p.conv_id, n.depth, sha256(p.key || strlen(n.role) || ':' || n.role || n.text), strlen(n.text)
  from p join n on n.conv_id = p.conv_id and n.depth = p.depth + 1),
v as (
  select depth, key, min(conv_id) as conv_id, count(*) as n_convs, any_value(bytes) as bytes from p group by depth, key),
u as (select v.*, q.key as parent from v left join p q on q.conv_id = v.conv_id and q.depth = v.depth - 1),
k as (select depth - 1 as depth, parent as key, count(*) as n_children from u where depth > 0 group by all),
x as (select u.*, coalesce(k.n_children, 0) as n_children from u left join k using (depth, key)),
s as (
  select p.depth, p.key, count(*) filter (where x.n_children = 0) as n_leaves,
         sum((x.n_convs - 1) * x.bytes)::bigint as saved_tokens
  from x join p on p.conv_id = x.conv_id and p.depth <= x.depth group by all),
e as (
  select depth, key, sha256(string_agg(conv_id::varchar, ',' order by conv_id)) as ends
  from (select *, max(depth) over (partition by conv_id) as last from p) where depth = last group by all)
select x.conv_id, x.depth::bigint as depth, y.conv_id as parent_conv_id, x.n_convs, x.n_children, s.n_leaves,
       s.saved_tokens, coalesce(e.ends, sha256('')) as ends_sha256
from x join s using (depth, key) left join e using (depth, key)
left join x y on y.depth = x.depth - 1 and y.key = x.parent
""".replace("{crc}", _crc32_sql("string_split(conv_id::varchar, '')")))
def trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.turns(table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(*prefix_trie.with_borrowed_starts(turns))


@query("op12_cube_mix")
def mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (mix_cube.mix(table(spark, sf_dir, "documents"))
            .select("doc_id", "size", "source_size", "target", "taken", "source", "copies"))


@query("op13_spelling_permuterm", r"""
with recursive t as (
  select coalesce(doc_id::varchar, '') as id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) as run
  from documents where text is not null),
l as (
  select id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as w, count(*) as k
  from t where length(run) >= 7 group by all),
h as (
  select w, k, {crc} as h from l),
v as (
  select case when h % 31 = 0 then left(w, (h % length(w))::int) || substr(w, (h % length(w))::int + 2) else w end as word, k from h),
w as (select word, sum(k)::bigint as n from v where length(word) >= 7 group by word having sum(k) >= 2),
s as (
  select word, n, left(word, i - 1) as head, substr(word, i + 1) as tail
  from (select word, n, unnest(range(1, length(word) + 1)) as i from w)),
p as (
  select a.word, b.word as near, b.n as near_n from s a join s b using (head, tail) where a.word <> b.word
  union
  select s.word, w.word, w.n from s join w on w.word = s.head || s.tail
  union
  select w.word, s.word, s.n from s join w on w.word = s.head || s.tail),
b as (
  select word, count(*) as n_near, arg_min(near, {'n': -near_n, 'w': near}) as near, max(near_n) as near_n
  from p group by word),
f as (
  select w.word, n, coalesce(n_near, 0) as n_near, case when near_n >= 10 * n then near end as form,
         case when near_n >= 10 * n then near_n end as form_n from w left join b using (word)),
r as (
  select word, word as root, form as further from f
  union all
  select r.word, f.word, f.form from r join f on f.word = r.further)
select f.word, f.form, r.root, f.n, f.n_near, f.form_n from f join r on r.word = f.word and r.further is null
""".replace("{crc}", _crc32_sql("string_split(id || ':' || w, '')")))
def spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_permuterm.variants(spelling_permuterm.vocabulary(table(spark, sf_dir, "documents")))


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def _sql_pipeline() -> None:
    import corpus_pipeline

    if corpus_pipeline.ORACLE_SQL is not None:
        ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL


_sql_pipeline()
