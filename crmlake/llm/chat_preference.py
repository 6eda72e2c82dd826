"""Preference pairs as training text: a shared prompt and two masked completions. DataFrame functions only.

Chosen and rejected conversations begin alike; the longest common prefix of equal turns is rendered
once as the prompt, what follows on either side is its completion. Spans of a completion that are
trained on (the text and end marker of every assistant turn) come with it as code point ranges; all
else is masked.

Defined cases: a null role or text is empty; turns go by ``turn``, then role and text, nulls first; a
row that repeats whole counts once; rows without a conversation id are left out; a pair with one side
has no common turn, and the missing side is null; a conversation that is all of the prompt leaves an
empty completion; further columns are ignored; an empty table gives no rows. A conversation is one
value of a row, so one group holds the turns of one pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

TRAINED = ("assistant",)
_HEAD, _BREAK, _END = "<|", "|>\n", "<|end|>\n"


def rendered(turn: Column) -> Column:
    return F.concat(F.lit(_HEAD), turn["role"], F.lit(_BREAK), turn["text"], F.lit(_END))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, rendered), "")


def trained_spans(turns: Column) -> Column:
    """[start, end) of what is trained on in ``render(turns)``."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(s: Column, t: Column) -> Column:
        end = s["at"] + F.length(rendered(t))
        begin = s["at"] + F.length(t["role"]) + len(_HEAD) + len(_BREAK)
        return F.struct(end.alias("at"), F.when(t["role"].isin(*TRAINED), F.concat(
            s["spans"], F.array(F.struct(begin.alias("start"), end.alias("end"))))).otherwise(s["spans"]).alias("spans"))

    return F.aggregate(turns, start, step, lambda s: s["spans"])


def common_turns(a: Column, b: Column) -> Column:
    """The number of leading turns that are equal."""
    differ = F.zip_with(a, b, lambda x, y: ~x.eqNullSafe(y))  # the shorter is filled up with nulls
    return F.when(F.size(differ) == 0, 0).otherwise(
        F.coalesce(F.nullif(F.array_position(differ, True), F.lit(0)) - 1, F.size(differ))).cast("int")


def sides(turns: DataFrame, pair: Column, chosen: Column, turn_column: str = "turn", role_column: str = "role",
          text_column: str = "text") -> DataFrame:
    """(pair_id, chosen, rejected): the ordered turns of either side, null where there are none.

    One shuffle by pair; ``chosen`` tells the side of a row.
    """
    text = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    turn = F.struct(F.col(f"`{turn_column}`").cast("long").alias("turn"), text(role_column).alias("role"),
                    text(text_column).alias("text"))
    rows = turns.select(pair.cast("long").alias("pair_id"), chosen.alias("chosen"), turn.alias("turn"))
    ordered = lambda c: F.transform(F.sort_array(F.collect_set(c)), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    both = rows.where(F.col("pair_id").isNotNull() & F.col("chosen").isNotNull()).groupBy("pair_id").agg(
        ordered(F.when(F.col("chosen"), F.col("turn"))).alias("chosen"),
        ordered(F.when(~F.col("chosen"), F.col("turn"))).alias("rejected"))
    present = lambda c: F.when(F.size(c) > 0, F.col(c)).alias(c)
    return both.select("pair_id", present("chosen"), present("rejected"))


def with_other_reply(turns: DataFrame, id_column: str = "conv_id") -> DataFrame:
    """(pair_id, chosen, rejected) of every conversation: itself, and the same turns with its last assistant
    turn replaced by the last one of conversation id + 1, or of id - 1 where the next has none.

    Rejected is null without an assistant turn or without such a neighbour. One more shuffle by id, which
    moves a conversation once and its last reply twice.
    """
    trained = lambda t: t["role"].isin(*TRAINED)
    whole = sides(turns, F.col(f"`{id_column}`"), F.lit(True)).select("pair_id", F.col("chosen").alias("turns"))
    last = F.array_max(F.transform(F.col("turns"), lambda t, i: F.when(trained(t), i)))
    own = whole.withColumn("last", last).withColumn("reply", F.get("turns", F.col("last"))["text"])
    none, no_turns = F.lit(None).cast("string"), F.lit(None).cast(whole.schema["turns"].dataType)
    row = lambda i, t, n, p: F.struct(i.alias("pair_id"), t.alias("turns"), n.alias("next"), p.alias("previous"))
    id_, reply = F.col("pair_id"), F.col("reply")
    sent = own.select(F.inline(F.array(row(id_, F.col("turns"), none, none), row(id_ - 1, no_turns, reply, none),
                                       row(id_ + 1, no_turns, none, reply))))
    met = sent.groupBy("pair_id").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("turns", "next", "previous")])
    met = met.where("turns IS NOT NULL").withColumn("last", last).withColumn("other", F.coalesce("next", "previous"))
    replaced = F.transform(F.col("turns"), lambda t, i: F.struct(
        t["role"].alias("role"), F.when(i == F.col("last"), F.col("other")).otherwise(t["text"]).alias("text")))
    return met.select("pair_id", F.col("turns").alias("chosen"), F.when(
        F.col("last").isNotNull() & F.col("other").isNotNull(), replaced).alias("rejected"))


def format_pairs(pairs: DataFrame) -> DataFrame:
    """pair_id, n_common, prompt, chosen, rejected, chosen_spans, rejected_spans of turn arrays."""
    n = F.coalesce(common_turns(F.col("chosen"), F.col("rejected")), F.lit(0))
    rest = lambda c: F.slice(c, F.col("n_common") + 1, F.greatest(F.size(c), F.lit(1)))
    cut = (pairs.select("pair_id", "chosen", "rejected", n.alias("n_common"))
           .select("pair_id", "n_common", F.slice("chosen", F.lit(1), F.col("n_common")).alias("shared"),
                   rest("chosen").alias("chosen"), rest("rejected").alias("rejected")))
    return cut.select("pair_id", "n_common", F.coalesce(render(F.col("shared")), F.lit("")).alias("prompt"),
                      render(F.col("chosen")).alias("chosen"), render(F.col("rejected")).alias("rejected"),
                      trained_spans(F.col("chosen")).alias("chosen_spans"),
                      trained_spans(F.col("rejected")).alias("rejected_spans"))


def spans_text(spans: Column) -> Column:
    """start-end,start-end,..: spans as one string."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ",")


def _sql_side(side: str, remainder: int) -> str:
    return f"""
{side} as (
  select pair_id, string_agg(r, '' order by i) as whole, string_agg(case when i > n then r else '' end, '' order by i) as rest,
         string_agg(case when i <= n then r else '' end, '' order by i) as head,
         coalesce(string_agg(case when i > n and role = 'assistant'
           then (e - length(text) - {len(_END)})::varchar || '-' || e::varchar end, ',' order by i), '') as spans
  from (select *, sum(case when i > n then length(r) else 0 end) over (partition by pair_id order by i) as e
        from (select t.*, coalesce(k.n, 0) as n from t left join k using (pair_id) where side = {remainder}))
  group by pair_id)"""


#: The same for conversations 2 k (chosen) and 2 k + 1 (rejected).
PAIRS_SQL = f"""
with d as (
  select distinct conv_id // 2 as pair_id, conv_id % 2 as side, turn, coalesce(role, '') as role, coalesce(text, '') as text
  from conversations where conv_id is not null),
t as (
  select *, row_number() over (partition by pair_id, side order by turn nulls first, role, text) as i,
         '{_HEAD}' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) as r from d),
k as (
  select pair_id, min(case when a.r is null or b.r is null or a.role <> b.role or a.text <> b.text then i end) as first,
         coalesce(first - 1, max(i)) as n
  from (select * from t where side = 0) a full join (select * from t where side = 1) b using (pair_id, i)
  group by pair_id),{_sql_side('c', 0)},{_sql_side('j', 1)}
select pair_id, n::integer as n_common, coalesce(c.head, '') as prompt, c.rest as chosen, j.rest as rejected,
       c.spans as chosen_spans, j.spans as rejected_spans
from k left join c using (pair_id) left join j using (pair_id)
"""

#: The same for every conversation (chosen) and its turns with another's last reply (rejected).
REPLIES_SQL = f"""
with d as (
  select distinct conv_id as pair_id, turn, coalesce(role, '') as role, coalesce(text, '') as text
  from conversations where conv_id is not null),
o as (select *, row_number() over (partition by pair_id order by turn nulls first, role, text) as i from d),
y as (
  select pair_id, max(i) as last, arg_max(text, i) as reply from o where role = 'assistant' group by pair_id),
g as (
  select y.pair_id, y.last, coalesce(n.reply, p.reply) as other
  from y left join y n on n.pair_id = y.pair_id + 1 left join y p on p.pair_id = y.pair_id - 1),
b as (
  select pair_id, 0 as side, i, role, text from o
  union all
  select pair_id, 1, i, role, case when i = last then other else text end
  from o join g using (pair_id) where other is not null),
t as (select *, '{_HEAD}' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) as r from b),
{PAIRS_SQL[PAIRS_SQL.index("k as ("):]}"""
