"""Edge payloads, edge unions, history and the ticket and change events."""

from __future__ import annotations

from pyspark.sql import functions as F

from crmlake import fixtures as X
from crmlake.functions.associations import all_labels, last_type, primary_label
from crmlake.functions.text import labels_json
from crmlake.operators import edges as E, flatten as FL, history as H
from crmlake.operators.merge import surrogate_id, to_table
from crmlake.plans import timeline as TL, views as VW
from crmlake.sources import landed as L
from queryset.activities import edges as activity_edges
from queryset.base import query, ts
from queryset.sqlparts import (
    ACTIVITIES, ACTIVITY_EDGES, CHANGES, EDGE_CREATED, EDGE_LABEL, EDGE_LABELS, EDGE_LABELS_ONCE,
    EDGE_SOURCE, HISTORY, PAIRS, TICKETS, with_)

_CC = f"""cast(o_custkey as varchar) as contact_source_id,
  cast(l_suppkey as varchar) as company_source_id, {EDGE_LABEL} as association_type,
  {EDGE_LABELS} as association_labels_json, {ts(EDGE_CREATED)} as association_created_at,
  {EDGE_SOURCE} as association_source"""
_CC_COLUMNS = ("contact_source_id", "company_source_id", "association_type",
               "association_labels_json", "association_created_at", "association_source")


@query("s5_contact_company_edges", with_(PAIRS) + f"select {_CC} from pairs")
def s5(spark, d):
    return E.contact_company_details(X.contact_company_pages(spark, d)).select(*_CC_COLUMNS)


_REVERSE = """
select cast(o_orderkey as varchar) as company_source_id, cast(o_custkey as varchar)
  as contact_source_id from orders
union all select cast(o_orderkey as varchar), cast(o_custkey + 1 as varchar) from orders"""


@query("s6_company_contact_edges", _REVERSE)
def s6(spark, d):
    return E.company_contact_edges(X.reverse_pages(spark, d))


_OBJECT_EDGE = f"""
  cast(line as bigint) as association_type_id, 'USER' as association_category,
  {EDGE_LABEL} as association_label, {EDGE_LABELS_ONCE} as association_labels_json,
  {ts(EDGE_CREATED)} as association_created_at, {EDGE_SOURCE} as association_source,
  coalesce(flag = 'A' or (flag <> 'R' and state = 'F'), false) as is_primary"""
_OBJECT_COLUMNS = ("source_object_type", "source_object_id", "target_object_type",
                   "target_object_id", "association_type_id", "association_category",
                   "association_label", "association_labels_json", "association_created_at",
                   "association_source", "is_primary")


@query("s7_object_edges", f"""
select 'deal' as source_object_type, cast(l_orderkey as varchar) as source_object_id,
       'ticket' as target_object_type, cast(l_partkey as varchar) as target_object_id, {_OBJECT_EDGE}
from (select l_orderkey, l_partkey, l_returnflag as flag, l_linestatus as state,
             l_linenumber as line, cast(l_shipdate as timestamp) as shipped from lineitem)""")
def s7(spark, d):
    return E.object_edges(X.deal_ticket_pages(spark, d), "deal", "ticket").select(*_OBJECT_COLUMNS)


_DEAL_HISTORY = f"""object_type, object_id, property_name, new_value, old_value,
  {ts('change_date')} as change_date, source, source_id"""


@query("s10_read_property_history", with_(HISTORY) + """
select object_id, property_name, 5 as items, count(*) as with_value from deal_history group by all""")
def s10(spark, d):
    rows = L.history_payloads(X.deal_history_pages(spark, d), "deal")
    kept = F.filter("items", lambda x: (F.length(x["value"]) > 0) & (x["timestamp"] != "no date"))
    return rows.select("object_id", "property_name", F.size("items").alias("items"),
                       F.size(kept).alias("with_value"))


@query("s11_embedded_edges", """
select cast(c_custkey as varchar) as source_id, cast(c_nationkey as varchar) as target_id
from customer""")
def s11(spark, d):
    return E.embedded_edges(L.parse_objects(X.contacts(spark, d), "contacts"), "companies")


@query("p_singular_types", """
select distinct case role when 'system' then 'company' when 'user' then 'sms' else 'custom_thing' end
  as object_type from conversations""")
def singular(spark, d):
    from crmlake.functions.text import singular as one
    name = (F.when(F.col("role") == "system", "Companies").when(F.col("role") == "user", "sms")
            .otherwise("custom_things"))
    return X.table(spark, d, "conversations").select(one(name).alias("object_type")).distinct()


def _types_of_lines(spark, d):
    pages = X.deal_ticket_pages(spark, d)
    return L.association_items(pages).select(
        "from_id", "seq", F.col("to.associationTypes").alias("types"))


_LINES = """select cast(l_orderkey as varchar) as from_id, l_returnflag as flag, l_linestatus as state,
  l_linenumber as line from lineitem"""


@query("a2_primary_label", f"""
select from_id, {EDGE_LABEL} as label, {EDGE_LABELS} as labels from ({_LINES})""")
def a2(spark, d):
    return _types_of_lines(spark, d).select(
        "from_id", primary_label(F.col("types")).alias("label"),
        F.when(F.size(all_labels(F.col("types"))) > 0,
               F.to_json(all_labels(F.col("types")))).alias("labels"))


@query("a3_last_type", f"select from_id, line as type_id, 'USER' as category from ({_LINES})")
def a3(spark, d):
    t = last_type(F.col("types"))
    return _types_of_lines(spark, d).select("from_id", t["type_id"].alias("type_id"),
                                            t["category"].alias("category"))


@query("a5_labels_json", f"select from_id, {EDGE_LABELS_ONCE} as labels from ({_LINES})")
def a5(spark, d):
    types = F.col("types")
    return _types_of_lines(spark, d).select(
        "from_id", labels_json(all_labels(types), primary_label(types)).alias("labels"))


@query("a1_edge_lists", """
select source_id, span, string_agg(id, ',' order by id) as ids, count(*) as n from (
  select distinct cast(o_custkey as varchar) as source_id, l_suppkey // 10 as span,
         cast(l_suppkey as varchar) as id
  from orders join lineitem on o_orderkey = l_orderkey) group by source_id, span""")
def a1(spark, d):
    pairs = E.contact_company_edges(X.contact_company_pages(spark, d))
    lists = E.edge_lists(pairs, "contact_source_id", "company_source_id", span=10)
    return lists.select(F.col("contact_source_id").alias("source_id"), "span",
                        F.array_join("ids", ",").alias("ids"), F.size("ids").alias("n"))


def _batch_and_embedded(spark, d):
    batch = E.contact_company_details(X.contact_company_pages(spark, d))
    own = E.embedded_edges(L.parse_objects(X.contacts(spark, d), "contacts"), "companies").select(
        F.col("source_id").alias("contact_source_id"), F.col("target_id").alias("company_source_id"))
    return batch, own


@query("x3_union_edges", with_(PAIRS) + f"""
select {_CC} from pairs
union all
select cast(c_custkey as varchar), cast(c_nationkey as varchar), null, null, null, null from customer
where not exists (select 1 from pairs where o_custkey = c_custkey and l_suppkey = c_nationkey)""")
def x3(spark, d):
    return E.union_edges(*_batch_and_embedded(spark, d)).select(*_CC_COLUMNS)


@query("a9_merge_edges", with_(PAIRS) + """
select cast(o_custkey as varchar) as contact_source_id, cast(l_suppkey as varchar)
  as company_source_id from pairs
union
select cast(c_custkey as varchar), cast(c_nationkey as varchar) from customer""")
def a9(spark, d):
    batch, own = _batch_and_embedded(spark, d)
    return E.merge_edges(batch, own).select("contact_source_id", "company_source_id")


@query("x4_edges_or_reverse", _REVERSE)
def x4(spark, d):
    """No forward edge is landed, so the reverse edges are used."""
    none = spark.createDataFrame([], "contact_source_id string, company_source_id string")
    return E.edges_or_reverse(none, E.company_contact_edges(X.reverse_pages(spark, d)))


@query("x5_reverse_edges", _REVERSE)
def x5(spark, d):
    return E.reverse_edges(E.company_contact_edges(X.reverse_pages(spark, d)))


@query("j16_attach_edge_details", with_(PAIRS) + """
select cast(c_custkey as varchar) as contact_source_id, cast(c_nationkey as varchar)
         as company_source_id, case when flag = 'A' then 'Primary' when flag = 'R' then 'Returning'
         when state = 'F' then 'primary' end as association_type, state as association_source
from customer left join (select o_custkey, l_suppkey, flag,
    case when state = 'F' then 'API' end as state0, state from pairs) on o_custkey = c_custkey
  and l_suppkey = c_nationkey""".replace("state as association_source", "state0 as association_source"))
def j16(spark, d):
    batch, own = _batch_and_embedded(spark, d)
    return E.attach_edge_details(own, batch).select(
        "contact_source_id", "company_source_id", "association_type", "association_source")


@query("j7_attach_keys", with_(PAIRS) + """
select cast(o_custkey as varchar) as contact_source_id, cast(l_suppkey as varchar)
         as company_source_id, c_custkey as contact_id, s_suppkey as company_id
from pairs left join (select * from customer where c_acctbal > 0) on c_custkey = o_custkey
left join (select * from supplier where s_acctbal > 0) on s_suppkey = l_suppkey""")
def j7(spark, d):
    pairs = E.contact_company_edges(X.contact_company_pages(spark, d))
    known = [X.table(spark, d, t).filter(f"{b} > 0").select(X.text(k).alias("source_id"))
             .withColumn("id", surrogate_id(["source_id"]))
             for t, k, b in (("customer", "c_custkey", "c_acctbal"),
                             ("supplier", "s_suppkey", "s_acctbal"))]
    return E.attach_keys(pairs, *known).select("contact_source_id", "company_source_id",
                                               "contact_id", "company_id")


@query("f4_filter_pairs", """
select cast(l_orderkey as varchar) as source_object_id, cast(l_partkey as varchar)
  as target_object_id from lineitem""")
def f4(spark, d):
    both = E.object_edges(X.deal_ticket_pages(spark, d), "deal", "ticket").unionByName(
        E.object_edges(X.contact_company_pages(spark, d), "contact", "company"))
    return E.filter_pairs(both, "deal", "ticket").select("source_object_id", "target_object_id")


@query("f7_split_edges", """
select cast(o_orderkey as varchar) as target_id, case when o_orderstatus = 'O'
  then 'source_id is required' end as reject_reason from orders""")
def f7(spark, d):
    o = X.table(spark, d, "orders").select(
        F.when(F.col("o_orderstatus") == "O", F.lit(" ")).otherwise(X.text("o_custkey"))
        .alias("source_id"), X.text("o_orderkey").alias("target_id"))
    ok, bad = E.split_edges(o, ["source_id", "target_id"])
    return ok.select("target_id", F.lit(None).cast("string").alias("reject_reason")).unionByName(
        bad.select("target_id", "reject_reason"))


@query("q5_edge_diagnostics", with_(PAIRS) + """
select 'batch' as method, count(*) as edges, false as found_none from pairs
union all select 'embedded', count(*), false from customer
union all select 'reverse', 2 * count(*), false from orders
union all select 'none', 0, true""")
def q5(spark, d):
    from crmlake.operators.quality import edge_diagnostics
    batch, own = _batch_and_embedded(spark, d)
    reverse = E.company_contact_edges(X.reverse_pages(spark, d))
    return edge_diagnostics(batch=batch, embedded=own, reverse=reverse,
                            none=reverse.filter("company_source_id is null"))


@query("w1_property_history", with_(HISTORY) + f"select {_DEAL_HISTORY} from deal_history")
def w1(spark, d):
    rows = L.history_payloads(X.deal_history_pages(spark, d), "deal")
    return H.property_history(rows).drop("pos")


def contact_history(spark, d):
    keys = ["object_type", "object_id", "property_name"]
    return H.history_of_changes(X.event_changes(spark, d), keys)


@query("w1_history_of_changes", with_(CHANGES) + f"""
select object_type, object_id, property_name, new_value, old_value,
       {ts('change_date')} as change_date, source from changes""")
def w1b(spark, d):
    return contact_history(spark, d)


@query("w2_order_history", with_(CHANGES) + f"""
select object_id, old_value, {ts('change_date')} as change_date from changes""")
def w2(spark, d):
    return H.order_history(contact_history(spark, d)).select("object_id", "old_value", "change_date")


@query("f3_filter_history", with_(HISTORY) + f"""
select {_DEAL_HISTORY} from deal_history where object_id = '7'""")
def f3(spark, d):
    rows = H.property_history(L.history_payloads(X.deal_history_pages(spark, d), "deal"))
    both = rows.drop("pos").unionByName(contact_history(spark, d), allowMissingColumns=True)
    return H.filter_history(both, "deal", "dealstage", "7")


def tickets(spark, d):
    rows = FL.flatten_tickets(L.parse_objects(X.tickets(spark, d), "tickets"))
    return to_table(FL.with_etl_date(rows, X.AS_OF), "tickets")


def linked(spark, d):
    links = E.object_edges(X.contact_ticket_pages(spark, d), "contact", "ticket")
    return TL.ticket_contacts(tickets(spark, d), links)


_LINKED = """
linked as (
  select distinct cast(o_custkey as varchar) as contact_id, t.*
  from orders join lineitem on o_orderkey = l_orderkey
  join tickets t on t.source_id = cast(l_partkey as varchar))"""
_TICKET_HISTORY = """
ticket_history as (
  select cast(p_partkey as varchar) as ticket, cast(p_size as varchar) as old_value,
         cast(null as varchar) as new_value, timestamp '2024-01-03 00:00:00' as change_date from part
  union all
  select cast(p_partkey as varchar), p_brand, cast(p_size as varchar),
         timestamp '2024-01-02 00:00:00' from part)"""


@query("j12_ticket_contacts", with_(TICKETS, _LINKED) + "select source_id, contact_id from linked")
def j12(spark, d):
    return linked(spark, d).select("source_id", "contact_id")


def ticket_history(spark, d):
    return H.property_history(L.history_payloads(X.ticket_history_pages(spark, d), "ticket"))


@query("j13_ticket_history", with_(TICKETS, _LINKED, _TICKET_HISTORY) + """
select source_id, contact_id, old_value, new_value from linked
join ticket_history on ticket = source_id""")
def j13(spark, d):
    return TL.ticket_history(linked(spark, d), ticket_history(spark, d)).select(
        "source_id", "contact_id", "old_value", "new_value")


@query("t5_ticket_created", with_(TICKETS, _LINKED) + f"""
select contact_id as contact_source_id, 'ticket_created' as event_type,
       {ts("coalesce(created_at, timestamp '2024-01-15 00:00:00')")} as event_date,
       'Ticket created' || coalesce(': ' || ticket_name, '') || ' (Status: ' || ticket_status || ')'
         || ' - Assigned to ' || ticket_owner as description, 'ticket' as related_object_type,
       source_id as related_object_id, ticket_name as related_object_name,
       ticket_owner as actor_id, ticket_owner as actor_name, cast(null as varchar) as metadata
from linked""")
def t5(spark, d):
    return TL.ticket_created(linked(spark, d))


@query("t6_ticket_status_changed", with_(TICKETS, _LINKED, _TICKET_HISTORY) + f"""
select contact_id as contact_source_id, 'ticket_status_changed' as event_type,
       {ts('change_date')} as event_date,
       'Ticket status changed from ' || old_value || coalesce(' to ' || new_value, '')
         || coalesce(': ' || ticket_name, '') as description, 'ticket' as related_object_type,
       source_id as related_object_id, ticket_name as related_object_name,
       cast(null as varchar) as actor_id, cast(null as varchar) as actor_name,
       '{{"oldStatus":"' || old_value || '","newStatus":"' || coalesce(new_value, '') || '"}}'
         as metadata
from linked join ticket_history on ticket = source_id""")
def t6(spark, d):
    return TL.ticket_changes(linked(spark, d), ticket_history(spark, d))


def change_sql(event_type: str, words: str, changes: str = CHANGES) -> str:
    return with_(changes) + f"""
select object_id as contact_source_id, '{event_type}' as event_type,
       {ts('change_date')} as event_date,
       '{words} from ' || old_value || coalesce(' to ' || new_value, '') as description,
       'contact' as related_object_type, object_id as related_object_id,
       cast(null as varchar) as related_object_name, source as actor_id,
       cast(null as varchar) as actor_name,
       '{{"oldValue":"' || old_value || '","newValue":"' || coalesce(new_value, '') || '"}}'
         as metadata
from changes"""


@query("t7_lifecycle_changed", change_sql("lifecycle_changed", "Lifecycle stage changed"))
def t7(spark, d):
    return TL.change_events(contact_history(spark, d), "lifecyclestage")


_ORDER_CHANGES = """
changes as (
  select cast(o_custkey as varchar) as object_id, o_orderstatus as old_value,
         lead(o_orderstatus) over (partition by o_custkey order by o_orderdate, o_orderstatus) as new_value,
         cast(o_orderdate as timestamp) as change_date, 'orders' as source
  from orders)"""


@query("t8_lead_status_changed", change_sql("lead_status_changed", "Lead status changed", _ORDER_CHANGES))
def t8(spark, d):
    """Customers' order states as their lead status."""
    history = H.history_of_changes(X.order_changes(spark, d), ["object_type", "object_id", "property_name"])
    return TL.change_events(history, "hs_lead_status")


@query("v3_bridge_activity_contact", with_(ACTIVITIES, ACTIVITY_EDGES) + """
select activity_source_id, associated_object_id as contact_source_id from activity_edges
where associated_object_type = 'contact'""")
def v3(spark, d):
    return VW.bridge_activity(activity_edges(spark, d), "contact")


@query("v4_bridge_activity_deal", with_(ACTIVITIES, ACTIVITY_EDGES) + """
select activity_source_id, associated_object_id as deal_source_id from activity_edges
where associated_object_type = 'deal'""")
def v4(spark, d):
    return VW.bridge_activity(activity_edges(spark, d), "deal")


@query("v5_bridge_activity_company", with_(ACTIVITIES, ACTIVITY_EDGES) + """
select activity_source_id, associated_object_id as company_source_id from activity_edges
where associated_object_type = 'company'""")
def v5(spark, d):
    return VW.bridge_activity(activity_edges(spark, d), "company")


_BRIDGE = with_(PAIRS, ACTIVITIES, ACTIVITY_EDGES) + """
select distinct cast(o_custkey as varchar) as contact_source_id,
       associated_object_id as deal_source_id
from pairs join activity_edges on associated_object_id = cast(l_suppkey as varchar)
  and associated_object_type = 'deal'"""


@query("v6_bridge_contact_deal", _BRIDGE)
def v6(spark, d):
    pairs = E.contact_company_edges(X.contact_company_pages(spark, d))
    return VW.bridge_contact_deal(pairs, activity_edges(spark, d))


@query("j15_contact_deal_rows", with_(PAIRS, ACTIVITIES, ACTIVITY_EDGES) + """
select count(*) as bridges, count(distinct contact_source_id) as contacts from (
  select distinct cast(o_custkey as varchar) as contact_source_id, associated_object_id
  from pairs join activity_edges on associated_object_id = cast(l_suppkey as varchar)
    and associated_object_type = 'deal')""")
def j15(spark, d):
    return v6(spark, d).agg(F.count(F.lit(1)).alias("bridges"),
                            F.count_distinct("contact_source_id").alias("contacts"))


@query("v7_bridge_contact_company", with_(PAIRS) + f"""
select cast(o_custkey as varchar) as contact_source_id, cast(l_suppkey as varchar)
  as company_source_id, {EDGE_LABEL} as association_type from pairs""")
def v7(spark, d):
    return VW.bridge_contact_company(E.contact_company_details(X.contact_company_pages(spark, d)))
