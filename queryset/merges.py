"""Upserts of every table: two snapshots made from a whole driver table, merged.

The snapshots are the same select list in both engines. The stored side has ids 2 n, the incoming
side ids 3 n, so every row of the driver table is on both sides and ids match, are new or are
absent. What the merge makes of them is written out in SQL on its own.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from crmlake import fixtures as X
from crmlake.model import tables as MT
from crmlake.operators import evolve as EV, merge as M, ordered as O
from queryset.base import query, ts

# table: driver table, its number, and the key columns by side ({n} is the id of the side)
CASES = {
    "contacts": ("customer", "c_custkey", {}),
    "companies": ("supplier", "s_suppkey", {}),
    "deals": ("orders", "o_orderkey", {}),
    "tickets": ("part", "p_partkey", {}),
    "communications": ("orders", "o_orderkey", {}),
    "emails": ("pages", "page_id", {}),
    "notes": ("documents", "doc_id", {}),
    "activities": ("events", "event_id", {}),
    "activity_calls": ("events", "event_id", {}),
    "activity_emails": ("events", "event_id", {}),
    "activity_meetings": ("events", "event_id", {}),
    "activity_notes": ("events", "event_id", {}),
    "activity_sms": ("events", "event_id", {}),
    "activity_tasks": ("events", "event_id", {}),
    "contact_company_associations": ("orders", "o_orderkey", {
        "contact_source_id": "cast(o_custkey as string)",
        "company_source_id": "cast({n} as string)"}),
    "activity_associations": ("events", "event_id", {
        "activity_source_id": "cast({n} as string)", "associated_object_type": "'contact'",
        "associated_object_id": "cast(user_id as string)"}),
    "object_associations": ("orders", "o_orderkey", {
        "source_object_type": "'contact'", "source_object_id": "cast(o_custkey as string)",
        "target_object_type": "'deal'", "target_object_id": "cast({n} as string)"}),
    "property_histories": ("events", "event_id", {
        "object_type": "'contact'", "object_id": "cast({n} as string)",
        "property_name": "'lifecyclestage'", "change_date": "timestamp '2024-01-02 00:00:00'"}),
    "contact_activity_timelines": ("events", "event_id", {
        "contact_source_id": "cast({n} as string)", "event_type": "'call_created'",
        "event_date": "timestamp '2024-01-03 00:00:00'",
        "related_object_id": "cast({n} + 1 as string)"}),
}

# Columns that do not follow the common rule, as the tables define them.
KEEPS_STORED = {"contacts": {"created_at"}, "companies": {"created_at"}, "tickets": {"created_at"},
                "contact_company_associations": {"contact_id", "company_id"},
                "activity_associations": {"activity_id"}}
BLANK_KEEPS = {
    "activity_associations": {"association_label", "association_category"},
    "object_associations": {"association_label", "association_labels_json", "association_category",
                            "association_source", "association_source_id"}}
TAKES_NEW = {"object_associations": {"is_primary"}}


def _value(kind: str, side: str, at: int, n: str) -> str:
    """A value for column ``at`` that is missing for every third id and blank for some."""
    made = {
        "string": f"case when ({n} + {at}) % 5 = 0 then ' ' else '{side}{at} ' || cast({n} as string) end",
        "timestamp": "timestamp '2023-0%d-01 00:00:00'" % (1 if side == "b" else 2),
        "boolean": "true" if side == "b" else "false",
        "decimal": f"cast({n} + {1 if side == 'b' else 2} as decimal(18,2))",
        "int": f"cast({1 if side == 'b' else 2} as int)",
        "bigint": f"cast({n} as bigint)",
    }[kind]
    return f"case when ({n} + {at}) % 3 <> 0 then {made} end"


def _select(table: str, side: str) -> dict[str, str]:
    """Column expressions of one side, in SQL both engines read."""
    source, number, keys = CASES[table]
    factor = 2 if side == "b" else 3
    n = f"({factor} * {number})"
    out = {}
    for at, field in enumerate(MT.schema(table)):
        name, kind = field.name, field.dataType.typeName().split("(")[0]
        kind = {"long": "bigint", "integer": "int"}.get(kind, kind)
        if name == "id":
            out[name] = f"cast({n} + {0 if side == 'b' else 1000000} as bigint)"
        elif name == "etl_date":
            out[name] = "timestamp '2024-01-01 00:00:00'"
        elif name in keys:
            out[name] = keys[name].format(n=n)
        elif name in MT.KEYS[table]:
            out[name] = n if kind == "bigint" else f"cast({n} as string)"
        else:
            out[name] = _value(kind, side, at, n)
    return out


def side(spark, d, table, which):
    rows = X.table(spark, d, CASES[table][0])
    made = rows.select(*[F.expr(e).alias(c) for c, e in _select(table, which).items()])
    return M.to_table(made, table)


def _sql_select(table: str, which: str) -> str:
    listed = ", ".join(f'{e} as "{c}"' for c, e in _select(table, which).items())
    return f"select {listed} from {CASES[table][0]}"


def _shown(name: str, field, expression: str) -> str:
    kind = field.dataType.typeName()
    if kind.startswith("timestamp"):
        expression = ts(expression)
    elif kind.startswith("decimal"):
        expression = f"cast({expression} as double)"
    elif kind == "integer":
        expression = f"cast({expression} as bigint)"
    return f'{expression} as "{name}"'


def merged_sql(table: str) -> str:
    keys = MT.KEYS[table]
    both = " and ".join(f'b."{k}" = i."{k}"' for k in keys)
    stored, new = f'b."{keys[0]}" is not null', f'i."{keys[0]}" is not null'
    out = []
    for field in MT.schema(table):
        c = field.name
        b, i = f'b."{c}"', f'i."{c}"'
        if c == "etl_date":
            e = f"case when {new} then timestamp '2024-01-15 00:00:00' else {b} end"
        elif c == "id" or c in KEEPS_STORED.get(table, ()):
            e = f"case when {stored} then {b} else {i} end"
        elif c in TAKES_NEW.get(table, ()):
            e = f"case when {new} then {i} else {b} end"
        elif c in BLANK_KEEPS.get(table, ()):
            e = f"case when {stored} and coalesce(trim({i}), '') = '' then {b} else {i} end"
        else:
            e = f"coalesce({i}, {b})"
        out.append(_shown(c, field, e))
    action = f"case when i.\"{keys[0]}\" is null then 'kept' when {stored} then 'updated' else 'inserted' end"
    return (f"with b as ({_sql_select(table, 'b')}), i as ({_sql_select(table, 'i')})\n"
            f"select {', '.join(out)}, {action} as action from b full join i on {both}")


_QUERIES = {
    "contacts": ("u2_upsert_contacts", M.upsert_contacts),
    "companies": ("u3_upsert_companies", M.upsert_companies),
    "deals": ("u4_upsert_deals", M.upsert_deals),
    "tickets": ("u5_upsert_tickets", M.upsert_tickets),
    "communications": ("u6_upsert_communications", M.upsert_communications),
    "emails": ("u7_upsert_emails", M.upsert_emails),
    "notes": ("u8_upsert_notes", M.upsert_notes),
    "contact_company_associations": ("u16_upsert_contact_company", M.upsert_contact_company),
    "activity_associations": ("u17_upsert_activity_edges", M.upsert_activity_edges),
    "object_associations": ("u18_upsert_object_edges", M.upsert_object_edges),
    "property_histories": ("u19_upsert_history", M.upsert_history),
    "contact_activity_timelines": ("u20_upsert_timeline", M.upsert_timeline),
}
_DETAILS = {"call": 10, "email": 11, "meeting": 12, "note": 13, "sms": 14, "task": 15}
_DETAIL_TABLE = {"call": "activity_calls", "email": "activity_emails", "note": "activity_notes",
                 "meeting": "activity_meetings", "sms": "activity_sms", "task": "activity_tasks"}

for _table, (_name, _upsert) in _QUERIES.items():
    @query(_name, merged_sql(_table))
    def _run(spark, d, table=_table, upsert=_upsert):
        return upsert(side(spark, d, table, "b"), side(spark, d, table, "i"), X.AS_OF)

for _kind, _at in _DETAILS.items():
    @query(f"u{_at}_upsert_{_kind}_details", merged_sql(_DETAIL_TABLE[_kind]))
    def _run_detail(spark, d, kind=_kind):
        table = _DETAIL_TABLE[kind]
        return M.upsert_details(kind, side(spark, d, table, "b"), side(spark, d, table, "i"), X.AS_OF)


# a column of each kind of detail that u9 shows
_SHOWN = {"call": "call_title", "email": "text_body", "meeting": "meeting_name", "note": "created_by_user_id",
          "sms": "message_body", "task": "task_type"}


@query("u9_upsert_activities", f"""
with a as ({merged_sql('activities')}), {", ".join(f"{k} as ({merged_sql(_DETAIL_TABLE[k])})" for k in _SHOWN)}
select a.source_id, a.subject, a.status, a.action,
       {", ".join(f"{k}.{c} as {k}_{c}, {k}.action as {k}_action" for k, c in _SHOWN.items())}
from a {" ".join(f"left join {k} on {k}.activity_id = cast(a.source_id as bigint)" for k in _SHOWN)}""")
def u9(spark, d):
    """Activities with details of every kind whose keys are attached through the merged activities."""
    base, new = side(spark, d, "activities", "b"), side(spark, d, "activities", "i")
    new = new.drop("id").withColumn("id", F.col("source_id").cast("bigint"))
    base = base.withColumn("id", F.col("source_id").cast("bigint"))
    details = {k: (side(spark, d, _DETAIL_TABLE[k], "b"), side(spark, d, _DETAIL_TABLE[k], "i").withColumn(
        "source_id", F.col("activity_id").cast("string")).drop("activity_id")) for k in _SHOWN}
    merged, details = M.upsert_activities(base, new, details, X.AS_OF)
    out = merged.select("id", "source_id", "subject", "status", "action")
    for k, c in _SHOWN.items():
        found = details[k].select(F.col("activity_id").alias("id"), F.col(c).alias(f"{k}_{c}"), F.col("action").alias(f"{k}_action"))
        out = out.join(found, "id", "left")
    return out.drop("id")


_REPEATED = """
select cast(3 * o_orderkey as varchar) as source_id, o_orderpriority as deal_name,
       cast(null as varchar) as deal_stage, 2 as seq from orders
union all
select cast(3 * o_orderkey as varchar), 'older', 'older', 1 from orders
union all
select ' ', 'blank', 'blank', 3 from orders"""


@query("u1_merge_coalesce", f"""
with b as (select cast(2 * o_orderkey as varchar) as source_id, 'stored' as deal_name,
                  o_orderstatus as deal_stage from orders),
i as (select * from ({_REPEATED}) where seq = 2)
select coalesce(b.source_id, i.source_id) as source_id, coalesce(i.deal_name, b.deal_name)
         as deal_name, coalesce(i.deal_stage, b.deal_stage) as deal_stage,
       case when i.source_id is null then 'kept' when b.source_id is null then 'inserted'
            else 'updated' end as action
from b full join i on b.source_id = i.source_id
union all
select ' ', 'blank', 'blank', 'inserted' from orders""")
def u1(spark, d):
    """Repeated incoming keys (the last wins) and blank keys (always inserted)."""
    o = X.table(spark, d, "orders")
    base = o.select(X.text(2 * F.col("o_orderkey")).alias("source_id"),
                    F.lit("stored").alias("deal_name"), F.col("o_orderstatus").alias("deal_stage"))

    def rows(key, name, stage, seq):
        return o.select(key.alias("source_id"), name.alias("deal_name"),
                        stage.cast("string").alias("deal_stage"), F.lit(seq).alias("seq"))

    key = X.text(3 * F.col("o_orderkey"))
    incoming = rows(key, F.col("o_orderpriority"), F.lit(None), 2).unionByName(
        rows(key, F.lit("older"), F.lit("older"), 1)).unionByName(
        rows(F.lit(" "), F.lit("blank"), F.lit("blank"), 3))
    return M.merge_coalesce(base, incoming, ["source_id"], as_of=X.AS_OF, order_by="seq",
                            blank_keys=True)


@query("j14_key_match", f"""
select action, count(*) as n from ({merged_sql('deals')}) group by action""")
def j14(spark, d):
    return M.upsert_deals(side(spark, d, "deals", "b"), side(spark, d, "deals", "i"),
                          X.AS_OF).groupBy("action").agg(F.count(F.lit(1)).alias("n"))


@query("a7_load_metrics", f"""
with m as (select action from ({merged_sql('object_associations')})
           union all select 'failed' from orders where o_orderstatus = 'O')
select 'edges' as step, count(*) filter (action <> 'kept') as total,
       count(*) filter (action = 'inserted') as inserted,
       count(*) filter (action = 'updated') as updated, count(*) filter (action = 'kept') as kept,
       count(*) filter (action = 'failed') as failed from m""")
def a7(spark, d):
    merged = M.upsert_object_edges(side(spark, d, "object_associations", "b"),
                                   side(spark, d, "object_associations", "i"), X.AS_OF)
    failed = X.table(spark, d, "orders").filter("o_orderstatus = 'O'")
    return M.load_metrics(merged, "edges", failed)


@query("w3_keep_last", """
select l_orderkey, arg_max(l_extendedprice, (l_shipdate, l_linenumber, l_extendedprice)) as price
from lineitem group by l_orderkey""")
def w3(spark, d):
    lines = X.table(spark, d, "lineitem").select(
        "l_orderkey", "l_shipdate", "l_linenumber", F.col("l_extendedprice").alias("price"))
    return O.keep_last(lines, ["l_orderkey"], ["l_shipdate", "l_linenumber"]).select("l_orderkey", "price")


@query("w4_keep_first", """
select l_orderkey, arg_min(l_extendedprice, (l_shipdate, l_linenumber, l_extendedprice)) as price
from lineitem group by l_orderkey""")
def w4(spark, d):
    lines = X.table(spark, d, "lineitem").select(
        "l_orderkey", "l_shipdate", "l_linenumber", F.col("l_extendedprice").alias("price"))
    return O.keep_first(lines, ["l_orderkey"], ["l_shipdate", "l_linenumber"]).select("l_orderkey", "price")


@query("w5_sample_ids", """
select cast(o_orderkey as varchar) as source_id from orders order by 1 limit 5""")
def w5(spark, d):
    return O.sample_ids(X.table(spark, d, "orders").select(X.text("o_orderkey").alias("source_id")))


@query("w7_first_match", "select o_orderkey, o_orderstatus from orders where o_orderkey = 17")
def w7(spark, d):
    return O.first_match(X.table(spark, d, "orders"), F.col("o_orderkey") == 17).select(
        "o_orderkey", "o_orderstatus")


@query("f8_exists", "select o_orderstatus = 'F' as found, count(*) as n from orders group by 1")
def f8(spark, d):
    """Rows that match a predicate, counted, and whether there is one."""
    o = X.table(spark, d, "orders")
    matching = F.col("o_orderstatus") == "F"
    counts = O.count_rows(o, matching)
    found = O.exists(o, matching)
    yes = counts.select(F.lit(found).alias("found"), F.col("matching").alias("n"))
    return yes.unionByName(counts.select(F.lit(False).alias("found"),
                                         (F.col("rows") - F.col("matching")).alias("n")))


@query("a6_count_rows", """
select count(*) as rows, count(*) filter (l_returnflag = 'R') as matching from lineitem""")
def a6(spark, d):
    return O.count_rows(X.table(spark, d, "lineitem"), F.col("l_returnflag") == "R")


@query("a8_distinct", "select distinct l_orderkey, l_suppkey from lineitem")
def a8(spark, d):
    from crmlake.operators.edges import distinct_pairs
    return distinct_pairs(X.table(spark, d, "lineitem"), "l_orderkey", "l_suppkey")


@query("x2_union_events", """
select 'customer' as source, cast(c_custkey as varchar) as id from customer
union all select 'orders', cast(o_custkey as varchar) from orders""")
def x2(spark, d):
    from crmlake.plans.timeline import union_events
    return union_events(
        X.table(spark, d, "customer").select(F.lit("customer").alias("source"),
                                             X.text("c_custkey").alias("id")),
        X.table(spark, d, "orders").select(F.lit("orders").alias("source"),
                                           X.text("o_custkey").alias("id")))


@query("k3_delete", """
select l_orderkey, l_linenumber, l_partkey from lineitem where l_orderkey not in (
  select o_orderkey from orders where o_orderstatus = 'F')""")
def k3(spark, d):
    gone = X.table(spark, d, "orders").filter("o_orderstatus = 'F'").select(
        F.col("o_orderkey").alias("l_orderkey"))
    return EV.delete(X.table(spark, d, "lineitem"), gone, "l_orderkey").select(
        "l_orderkey", "l_linenumber", "l_partkey")


@query("k7_cascade_delete", """
with gone as (select o_orderkey from orders where o_orderstatus = 'F')
select 'activity' as what, cast(o_orderkey as bigint) as id, o_orderkey as ref from orders
where o_orderstatus <> 'F'
union all
select 'detail', l_orderkey, l_orderkey from lineitem where l_orderkey not in (select * from gone)
union all
select 'edge', l_partkey, case when l_orderkey not in (select * from gone) then l_orderkey end
from lineitem""")
def k7(spark, d):
    orders, lines = X.table(spark, d, "orders"), X.table(spark, d, "lineitem")
    activities = orders.select(X.text("o_orderkey").alias("source_id"), F.col("o_orderkey").alias("id"))
    keys = orders.filter("o_orderstatus = 'F'").select(X.text("o_orderkey").alias("source_id"))
    left, details, edges = EV.cascade_delete(
        activities, {"line": lines.select(F.col("l_orderkey").alias("activity_id"))}, keys,
        lines.select("l_partkey", F.col("l_orderkey").alias("activity_id")))

    def shown(df, what, key, ref):
        return df.select(F.lit(what).alias("what"), F.col(key).alias("id"), F.col(ref).alias("ref"))

    return shown(left, "activity", "id", "id").unionByName(
        shown(details["line"], "detail", "activity_id", "activity_id")).unionByName(
        shown(edges, "edge", "l_partkey", "activity_id"))


@query("m1_add_column", "select c_custkey, cast(null as varchar) as created_at from customer")
def m1(spark, d):
    c = X.table(spark, d, "customer").select("c_custkey")
    once = EV.add_column_if_missing(c, "created_at", "timestamp")
    return EV.add_column_if_missing(once, "created_at", "string")


@query("m2_swap_columns", "select o_orderkey, o_orderpriority as old_value, o_orderstatus as new_value from orders")
def m2(spark, d):
    o = X.table(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("old_value"),
                                           F.col("o_orderpriority").alias("new_value"))
    return EV.swap_columns(o, "old_value", "new_value")
