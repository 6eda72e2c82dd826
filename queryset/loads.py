"""Whole loads: landed payloads to merged tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from crmlake import fixtures as X
from crmlake.operators import edges as OE, flatten as FL
from crmlake.operators.merge import to_table
from crmlake.plans import loads as LD
from crmlake.plans.timeline import union_events
from crmlake.plans.views import register_views
from queryset import activities as A, edges as E, quality as Q
from queryset.activities import ALL_FAMILIES
from queryset.base import ORACLES, query, ts
from queryset.sqlparts import (
    ACTIVITIES, ACTIVITY_EDGES, COMMUNICATIONS, COMPANIES, CONTACTS, DEALS, EDGE_CREATED, EDGE_LABEL,
    EDGE_LABELS, EDGE_SOURCE, EVENTS, HISTORY, OWNERS, PAIRS, STAGES, TICKETS, owned, stripped, with_)

_LOADED = "'2024-01-15 00:00:00.000000' as etl_date"
_NEW = f"{_LOADED}, 'inserted' as action"


def context(spark, d, stored=None, **landed):
    landed = LD.Landed(owners=X.owner_pages(spark, d), **landed)
    return LD.Context(spark, landed, X.AS_OF, stored=stored or {},
                      owner_overrides=X.owner_overrides(spark, d),
                      stage_overrides=X.stage_overrides(spark, d))


@query("r1_load_contacts", with_(OWNERS, CONTACTS) + f""",
i as (select x.*, {owned('contact_owner')} as owner from contacts x
      left join owner_names o on o.key = x.contact_owner),
b as (select cast(2 * c_custkey as varchar) as source_id, 'stored@example.com' as email,
             'stored' as full_name, timestamp '2020-02-02 00:00:00' as created_at from customer)
select coalesce(i.source_id, b.source_id) as source_id, coalesce(i.full_name, b.full_name)
         as full_name, coalesce(i.email, b.email) as email, i.owner as contact_owner,
       {ts('case when b.source_id is not null then b.created_at else i.created_at end')} as created_at,
       {ts('i.last_activity_date')} as last_activity_date,
       case when i.source_id is null then '2024-01-01 00:00:00.000000'
            else '2024-01-15 00:00:00.000000' end as etl_date,
       case when i.source_id is null then 'kept' when b.source_id is null then 'inserted'
            else 'updated' end as action
from i full join b on i.source_id = b.source_id""")
def r1(spark, d):
    """Contacts over a stored table whose ids match every second customer."""
    stored = X.table(spark, d, "customer").select(
        X.text(2 * F.col("c_custkey")).alias("source_id"), F.lit("stored@example.com").alias("email"),
        F.lit("stored").alias("full_name"), F.lit("2020-02-02").cast("timestamp").alias("created_at"))
    base = to_table(FL.with_etl_date(stored, X.BEFORE), "contacts")
    ctx = context(spark, d, {"contacts": base}, objects={"contacts": X.contacts(spark, d)})
    return LD.load_contacts(ctx).select("source_id", "full_name", "email", "contact_owner",
                                        "created_at", "last_activity_date", "etl_date", "action")


@query("r2_load_companies", with_(OWNERS, COMPANIES) + f"""
select x.source_id, x.record_id, x.name, {owned('company_owner')} as company_owner, x.cvr, x.type,
       {_NEW} from companies x left join owner_names o on o.key = x.company_owner""")
def r2(spark, d):
    ctx = context(spark, d, objects={"companies": X.companies(spark, d)})
    return LD.load_companies(ctx).select("source_id", "record_id", "name", "company_owner", "cvr",
                                         "type", "etl_date", "action")


@query("r3_load_contact_company_edges", with_(PAIRS) + f""",
u as (
  select o_custkey as contact, l_suppkey as company, {EDGE_LABEL} as association_type,
         {EDGE_LABELS} as association_labels_json, {ts(EDGE_CREATED)} as association_created_at,
         {EDGE_SOURCE} as association_source from pairs
  union all
  select c_custkey, c_nationkey, null, null, null, null from customer
  where not exists (select 1 from pairs where o_custkey = c_custkey and l_suppkey = c_nationkey))
select cast(contact as varchar) as contact_source_id, cast(company as varchar) as company_source_id,
       contact as contact_id, s_suppkey as company_id, association_type, association_labels_json,
       association_created_at, association_source, 'inserted' as action
from u left join supplier on s_suppkey = company""")
def r3(spark, d):
    companies = to_table(X.table(spark, d, "supplier").select(
        X.text("s_suppkey").alias("source_id")), "companies")
    ctx = context(spark, d, {"contacts": Q.contacts(spark, d), "companies": companies},
                  objects={"contacts": X.contacts(spark, d)}, reverse=X.reverse_pages(spark, d),
                  associations={("contact", "company"): X.contact_company_pages(spark, d)})
    return LD.load_contact_company_edges(ctx).select(
        "contact_source_id", "company_source_id", "contact_id", "company_id", "association_type",
        "association_labels_json", "association_created_at", "association_source", "action")


@query("r4_load_deals", with_(OWNERS, DEALS) + f""",
i as (select x.*, {owned('deal_owner')} as owner from deals x
      left join owner_names o on o.key = x.deal_owner),
b as (select cast(2 * o_orderkey as varchar) as source_id, 'stored' as deal_name,
             'stored' as deal_type, timestamp '2020-02-02 00:00:00' as created_at from orders)
select coalesce(i.source_id, b.source_id) as source_id, coalesce(i.deal_name, b.deal_name)
         as deal_name, i.deal_stage, i.amount, i.owner as deal_owner,
       coalesce(i.deal_type, b.deal_type) as deal_type, {ts('i.close_date')} as close_date,
       {ts('coalesce(i.created_at, b.created_at)')} as created_at,
       case when i.source_id is null then 'kept' when b.source_id is null then 'inserted'
            else 'updated' end as action
from i full join b on i.source_id = b.source_id""")
def r4(spark, d):
    stored = X.table(spark, d, "orders").select(
        X.text(2 * F.col("o_orderkey")).alias("source_id"), F.lit("stored").alias("deal_name"),
        F.lit("stored").alias("deal_type"), F.lit("2020-02-02").cast("timestamp").alias("created_at"))
    base = to_table(FL.with_etl_date(stored, X.BEFORE), "deals")
    ctx = context(spark, d, {"deals": base}, objects={"deals": X.deals(spark, d)})
    return LD.load_deals(ctx).select("source_id", "deal_name", "deal_stage", "amount", "deal_owner",
                                     "deal_type", "close_date", "created_at", "action")


@query("r5_load_tickets", with_(OWNERS, STAGES, TICKETS) + f"""
select x.source_id, x.ticket_name, {owned('ticket_owner')} as ticket_owner,
       case when coalesce(p.name, x.pipeline) = '0' then 'Support Pipeline'
            else coalesce(p.name, x.pipeline) end as pipeline,
       coalesce(v.name, s.name, x.ticket_status) as ticket_status, {_NEW}
from tickets x left join owner_names o on o.key = x.ticket_owner
left join pipelines p on p.key = x.pipeline left join stage_options s on s.key = x.ticket_status
left join stage_overrides v on v.key = lower(coalesce(s.name, x.ticket_status))""")
def r5(spark, d):
    ctx = context(spark, d, objects={"tickets": X.tickets(spark, d)},
                  pipelines=X.pipeline_pages(spark, d), stages=X.stage_pages(spark, d))
    return LD.load_tickets(ctx).select("source_id", "ticket_name", "ticket_owner", "pipeline",
                                       "ticket_status", "etl_date", "action")


@query("r6_load_communications", with_(OWNERS, CONTACTS, COMMUNICATIONS) + f"""
select x.source_id, x.channel_type, {stripped('x.html')} as communication_body,
       {owned('assigned')} as activity_assigned_to, c.full_name as associated_contact_name,
       c.email as associated_contact_email, 'inserted' as action
from communications x left join owner_names o on o.key = x.assigned
left join contacts c on c.source_id = x.contact_id""")
def r6(spark, d):
    ctx = context(spark, d, objects={"contacts": X.contacts(spark, d),
                                     "communications": X.communications(spark, d)})
    return LD.load_communications(ctx).select(
        "source_id", "channel_type", "communication_body", "activity_assigned_to",
        "associated_contact_name", "associated_contact_email", "action")


@query("r7_load_emails", with_(OWNERS, CONTACTS) + """
select cast(page_id as varchar) as source_id, url as email_subject, html as email_body,
       coalesce(o.name, cast(page_id as varchar)) as activity_assigned_to,
       c.full_name as associated_contact_name, 'inserted' as action
from pages left join owner_names o on o.key = cast(page_id as varchar)
left join contacts c on c.source_id = cast(page_id as varchar)""")
def r7(spark, d):
    ctx = context(spark, d, objects={"contacts": X.contacts(spark, d), "emails": X.emails(spark, d)})
    return LD.load_emails(ctx).select("source_id", "email_subject", "email_body",
                                      "activity_assigned_to", "associated_contact_name", "action")


@query("r8_load_notes", f"""
select cast(doc_id as varchar) as source_id, {stripped("'<div>' || text || '</div>'")} as body_preview,
       lang as activity_assigned_to, {_NEW} from documents""")
def r8(spark, d):
    ctx = context(spark, d, objects={"notes": X.notes(spark, d)})
    return LD.load_notes(ctx).select("source_id", "body_preview", "activity_assigned_to", "etl_date",
                                     "action")


def activity_objects(spark, d):
    from crmlake.model.objects import ACTIVITY_SOURCES
    return {ACTIVITY_SOURCES[k]: X.activities(spark, d, k) for k in A.KINDS}


@query("r9_load_activities", with_(OWNERS, CONTACTS, ACTIVITIES) + f"""
select x.source_id, x.activity_type, x.subject, x.body, x.status,
       {owned('activity_owner')} as activity_owner, x.source_object_type, x.source_object_id,
       c.full_name as source_object_name, c.email as source_object_email,
       {ts('x.activity_date')} as activity_date, {_NEW}
from activities x left join owner_names o on o.key = x.activity_owner
left join contacts c on c.source_id = x.source_object_id and x.source_object_type = 'contacts'""")
def r9(spark, d):
    ctx = context(spark, d, objects=activity_objects(spark, d) | {"contacts": X.contacts(spark, d)})
    return LD.load_activities(ctx).select(
        "source_id", "activity_type", "subject", "body", "status", "activity_owner",
        "source_object_type", "source_object_id", "source_object_name", "source_object_email",
        "activity_date", "etl_date", "action")


@query("r10_load_object_edges", f"""
with p as (
  select o_custkey, l_partkey, max(l_returnflag) as flag, min(l_linestatus) as state,
         max(l_linenumber) as line from orders join lineitem on o_orderkey = l_orderkey
  group by o_custkey, l_partkey)
select 'contact' as source_object_type, cast(o_custkey as varchar) as source_object_id,
       'ticket' as target_object_type, cast(l_partkey as varchar) as target_object_id,
       {EDGE_LABEL} as association_label, cast(line as bigint) as association_type_id,
       coalesce(flag = 'A' or (flag <> 'R' and state = 'F'), false) as is_primary, {_NEW}
from p""")
def r10(spark, d):
    ctx = context(spark, d, associations={("contact", "ticket"): X.contact_ticket_pages(spark, d)})
    return LD.load_object_edges(ctx, "contact", "ticket").select(
        "source_object_type", "source_object_id", "target_object_type", "target_object_id",
        "association_label", "association_type_id", "is_primary", "etl_date", "action")


@query("r11_load_property_history", with_(HISTORY) + f"""
select object_type, object_id, property_name, new_value, old_value, {ts('change_date')} as change_date,
       source, 'inserted' as action from deal_history
union all
select 'ticket', cast(p_partkey as varchar), 'hs_pipeline_stage', null, cast(p_size as varchar),
       '2024-01-03 00:00:00.000000', 'CRM_UI', 'inserted' from part
union all
select 'ticket', cast(p_partkey as varchar), 'hs_pipeline_stage', cast(p_size as varchar), p_brand,
       '2024-01-02 00:00:00.000000', null, 'inserted' from part""")
def r11(spark, d):
    ctx = context(spark, d, history={"deal": X.deal_history_pages(spark, d),
                                     "ticket": X.ticket_history_pages(spark, d)})
    return LD.load_property_history(ctx).select(
        "object_type", "object_id", "property_name", "new_value", "old_value", "change_date",
        "source", "action")


def timeline_context(spark, d):
    from crmlake.model.objects import DETAIL_TABLES
    activities, details, links = A.stored(spark, d)
    tickets = E.tickets(spark, d)
    history = E.contact_history(spark, d).unionByName(
        E.ticket_history(spark, d).drop("pos", "source_id"))
    stored = {
        "activities": activities, "activity_associations": links, "tickets": tickets,
        "object_associations": OE.object_edges(X.contact_ticket_pages(spark, d), "contact", "ticket"),
        "property_histories": history} | {DETAIL_TABLES[k]: v for k, v in details.items()}
    return context(spark, d, stored)


_EVENTS = [ALL_FAMILIES, ORACLES["t5_ticket_created"], ORACLES["t6_ticket_status_changed"],
           ORACLES["t7_lifecycle_changed"]]
_TIMELINE = "\nunion all by name\n".join(f"select * from ({q})" for q in _EVENTS)


@query("r12_build_timeline", f"select *, 'inserted' as action from ({_TIMELINE})")
def r12(spark, d):
    return LD.build_timeline(timeline_context(spark, d)).drop("id", "etl_date")


@query("t14_timeline", f"select event_type, count(*) as events from ({_TIMELINE}) group by event_type")
def t14(spark, d):
    """All families together, merged into the stored timeline, counted by event type."""
    from crmlake.plans.timeline import timeline
    ctx = timeline_context(spark, d)
    base = ctx.read("contact_activity_timelines")
    merged = timeline([LD.timeline_events(ctx)], base, X.AS_OF, unique=True)
    return merged.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))


_STEPS = {
    "contacts": "select count(*) from customer",
    "companies": "select count(*) from supplier",
    "deals": "select count(*) from orders",
    "tickets": "select count(*) from part",
    "contact_company_associations": """select count(*) from (
        select o_custkey, l_suppkey from orders join lineitem on o_orderkey = l_orderkey
        union select c_custkey, c_nationkey from customer)""",
    "communications": "select count(*) from conversations",
    "emails": "select count(*) from e where kind = 'EMAIL'",
    "notes": "select count(*) from e where kind = 'NOTE'",
    "object_associations": """select count(*) from (select distinct o_custkey, l_partkey
        from orders join lineitem on o_orderkey = l_orderkey)""",
    "activities": "select count(*) from activities",
    "activity_calls": "select count(*) from e where kind = 'CALL'",
    "activity_emails": "select count(*) from e where kind = 'EMAIL'",
    "activity_meetings": "select count(*) from e where kind = 'MEETING'",
    "activity_tasks": "select count(*) from e where kind = 'TASK'",
    "activity_notes": "select count(*) from e where kind = 'NOTE'",
    "activity_sms": "select count(*) from conversations",
    "activity_associations": "select count(*) from activity_edges",
    "property_histories": "select (select count(*) from deal_history) + 2 * count(*) from part",
    "contact_activity_timelines": """select (select count(*) from activities where k < 80)
        + (select count(*) from e where kind = 'EMAIL' and k between 1 and 49)
        + (select count(*) from e where kind = 'EMAIL' and k between 10 and 79)
        + 3 * (select count(*) from (select distinct o_custkey, l_partkey
               from orders join lineitem on o_orderkey = l_orderkey))""",
}
_COUNTS = "\nunion all ".join(f"select '{step}' as step, ({sql}) as n" for step, sql in _STEPS.items())


@query("r13_run_full", with_(ACTIVITIES, ACTIVITY_EDGES, HISTORY) + f"""
select step, 'done' as outcome, n as total, n as inserted, 0 as updated, 0 as kept, 0 as failed
from ({_COUNTS})""")
@Q.in_store
def r13(spark, d, store):
    """A first full run into empty tables: one metrics row per step."""
    objects = activity_objects(spark, d) | {
        "contacts": X.contacts(spark, d), "companies": X.companies(spark, d),
        "deals": X.deals(spark, d), "tickets": X.tickets(spark, d),
        "communications": X.communications(spark, d)}
    ctx = context(
        spark, d, objects=objects, reverse=X.reverse_pages(spark, d),
        associations={("contact", "company"): X.contact_company_pages(spark, d),
                      ("contact", "ticket"): X.contact_ticket_pages(spark, d)},
        history={"deal": X.deal_history_pages(spark, d), "ticket": X.ticket_history_pages(spark, d)},
        pipelines=X.pipeline_pages(spark, d), stages=X.stage_pages(spark, d))
    ctx.tables = store
    return LD.run_full(ctx).drop("message")


def _two_runs(spark, d, store):
    """A first run over customers and suppliers, then one over unclean contacts alone."""
    first = context(spark, d, objects={"contacts": X.contacts(spark, d), "companies": X.companies(spark, d)})
    first.tables = store
    LD.run_full(first)
    second = context(spark, d, objects={"contacts": X.unclean_contacts(spark, d)})
    second.tables = store
    return LD.run_full(second).drop("message")


_GOOD = "c_acctbal >= 1000 and c_acctbal <= 8000"


@query("r13_second_run", f"""
select 'contacts' as step, 'done' as outcome, count(*) as total, 0 as inserted,
       count(*) filter ({_GOOD}) as updated, count(*) filter (not ({_GOOD})) as kept,
       count(*) filter (not ({_GOOD})) as failed from customer
union all select 'companies', 'done', 0, 0, 0, count(*), 0 from supplier
union all select 'contact_company_associations', 'done', 0, 0, 0, count(*), 0 from customer
union all select x, 'done', 0, 0, 0, 0, 0 from unnest(['deals', 'tickets', 'object_associations',
       'property_histories', 'contact_activity_timelines']) as t(x)""")
@Q.in_store
def r13_second(spark, d, store):
    """Updated, kept and rejected rows of a run into filled tables; absent types are empty snapshots."""
    return _two_runs(spark, d, store)


@query("p22_rejected_table", """
select * from (
  select 'contacts' as table_name, case when c_acctbal < 1000 then 'wrong type: phone'
         when c_acctbal > 9000 then 'missing id' else 'missing properties' end as reason,
         count(*) as rows, count(*) as with_raw
  from customer where c_acctbal < 1000 or c_acctbal > 8000 group by all)""")
@Q.in_store
def p22_rejected(spark, d, store):
    """What a run could not use, with the reason and the payload, as stored."""
    _two_runs(spark, d, store)
    return store.read("rejected").groupBy("table_name", "reason").agg(
        F.count(F.lit(1)).alias("rows"), F.count("raw").alias("with_raw"))


_BROKEN = """
b as (
  select c_custkey, c_custkey % 10 as digit, c_custkey = (select min(c_custkey) from customer where c_custkey % 10 = 3) as first,
         c_custkey + 1 in (select c_custkey from customer) as taken from customer)"""


def _rules_run(spark, d, store, rules):
    """A run over clean contacts, then one over contacts that break rules in every way."""
    first = context(spark, d, objects={"contacts": X.own_contacts(spark, d)})
    first.tables, first.rules = store, rules
    LD.run_full(first)
    second = context(spark, d, objects={"contacts": X.rule_breaking_contacts(spark, d)})
    second.tables, second.rules = store, rules
    return LD.run_full(second)


@query("q1_quarantine_at_write", "with " + _BROKEN.strip() + """
select 'rejected: length: full_name' as what, count(*) as n from b where digit in (1, 4)
union all select 'rejected: unique: email', count(*) from b where (digit = 2 and taken) or (digit = 3 and not first)
union all select 'metrics: inserted', count(*) from b where digit = 3 and first
union all select 'metrics: updated', count(*) from b where digit in (0, 5, 6, 7, 8, 9) or (digit = 2 and not taken)
union all select 'metrics: failed', count(*) from b where digit in (1, 4) or (digit = 2 and taken) or (digit = 3 and not first)
union all select 'rows', count(*) + 1 from b
union all select 'addresses', count(*) + 1 from b
union all select 'too long', 0""")
@Q.in_store
def q1_quarantine(spark, d, store):
    """Rows that break a rule are set aside with the rules they break; stored rows of their keys stay."""
    metrics = _rules_run(spark, d, store, LD.QUARANTINE).filter("step = 'contacts'")
    rows = store.read("contacts")
    what = store.read("rejected").groupBy(F.concat(F.lit("rejected: "), "reason").alias("what")).agg(F.count("*").alias("n"))
    told = metrics.selectExpr("stack(3, 'metrics: inserted', inserted, 'metrics: updated', updated, 'metrics: failed', failed) as (what, n)")
    seen = rows.agg(F.count("*").alias("a"), F.count_distinct("email").alias("b"), F.count_if(F.length("full_name") > 255).alias("c"))
    return what.unionByName(told).unionByName(seen.selectExpr("stack(3, 'rows', a, 'addresses', b, 'too long', c) as (what, n)"))


@query("q3_fail_at_write", "with " + _BROKEN.strip() + """
select 'contacts' as step, count(*) as broken, (select count(*) from b) as stored from b
where digit in (1, 4) or (digit = 2 and taken) or (digit = 3 and not first)""")
@Q.in_store
def q3_fail(spark, d, store):
    """The same run where a rule may not be broken: the step fails before it writes, and the stored rows stay."""
    try:
        _rules_run(spark, d, store, LD.FAIL)
        broken = 0
    except LD.LoadFailed as error:
        broken = error.__cause__.rows
    return store.read("contacts").agg(F.lit("contacts").alias("step"), F.lit(broken).alias("broken"), F.count("*").alias("stored"))


@query("k2_touched_partitions", """
select 'contact' as source_object_type, false as rewritten, count(*) as rows from (
  select distinct o_custkey, l_partkey from orders join lineitem on o_orderkey = l_orderkey)
union all
select 'deal', true, count(*) from (select distinct l_orderkey, l_partkey from lineitem)""")
@Q.in_store
def k2_touched(spark, d, store):
    """A run in which one pair of types landed, into a store with edges of two: only that pair's files are new."""
    pairs = {("contact", "ticket"): X.contact_ticket_pages(spark, d), ("deal", "ticket"): X.deal_ticket_pages(spark, d)}
    first = context(spark, d, associations=pairs)
    first.tables = store
    LD.run_full(first)
    edges = lambda: store.read("object_associations").withColumn("file", F.col("_metadata.file_path"))
    # file names as a table of their own: what a run stages is removed at its end
    before = F.broadcast(spark.createDataFrame(edges().select("file").distinct().collect(), "file string"))
    second = context(spark, d, associations={("deal", "ticket"): pairs["deal", "ticket"]})
    second.tables = store
    LD.run_full(second)
    return edges().join(before.withColumn("old", F.lit(True)), "file", "left").groupBy(
        "source_object_type", F.col("old").isNull().alias("rewritten")).agg(F.count("*").alias("rows"))


def _changed_run(spark, d, store, events):
    """A run over calls and tickets, then one in which every hundredth call landed again."""
    calls = X.activities(spark, d, "CALL")
    landed = {"objects": {"calls": calls, "tickets": X.tickets(spark, d)},
              "associations": {("contact", "ticket"): X.contact_ticket_pages(spark, d)},
              "history": {"ticket": X.ticket_history_pages(spark, d)}}
    first = context(spark, d, **landed)
    first.tables = store
    LD.run_full(first)
    second = context(spark, d, objects={"calls": calls.filter(F.col("seq").cast("long") % 100 == 0)})
    second.tables, second.events, second.as_of = store, events, "2024-01-16 00:00:00"
    return LD.run_full(second)


@query("r12_changed_events", with_(EVENTS) + """
select 'call_created' as event_type, count(*) as events, count(*) filter (event_id % 100 = 0) as made
from e where kind = 'CALL' and k < 80
union all select t, n * c, 0 from (
  select count(*) as n from (select distinct o_custkey, l_partkey from orders join lineitem on o_orderkey = l_orderkey)),
  (values ('ticket_created', 1), ('ticket_status_changed', 2)) as v(t, c)""")
@Q.in_store
def r12_changed(spark, d, store):
    """A run that makes the events of what it changed alone: the others stay as they are stored."""
    _changed_run(spark, d, store, LD.CHANGED_EVENTS)
    rows = store.read("contact_activity_timelines")
    return rows.groupBy("event_type").agg(F.count("*").alias("events"), F.count_if(
        F.col("etl_date") == F.lit("2024-01-16 00:00:00").cast("timestamp")).alias("made"))


_COUNTED_VIEWS = {
    "fact_deals": "orders", "fact_activities": "activities",
    "bridge_activity_contact": "activity_edges where associated_object_type = 'contact'",
    "bridge_activity_deal": "activity_edges where associated_object_type = 'deal'",
    "bridge_activity_company": "activity_edges where associated_object_type = 'company'",
    "bridge_contact_deal": """(select distinct o_custkey, associated_object_id from pairs join activity_edges
        on associated_object_id = cast(l_suppkey as varchar) and associated_object_type = 'deal')""",
    "bridge_contact_company": "pairs",
}


@query("v_registered_views", with_(PAIRS, ACTIVITIES, ACTIVITY_EDGES) + "\nunion all ".join(
    f"select '{name}' as view_name, count(*) as rows from {source}" for name, source in _COUNTED_VIEWS.items()))
@Q.in_store
def v_views(spark, d, store):
    """The reporting views over stored tables, asked by name in SQL."""
    activities, _, links = A.stored(spark, d)
    tables = {"deals": Q._deals(spark, d), "activities": activities, "activity_associations": links,
              "contact_company_associations": OE.contact_company_details(X.contact_company_pages(spark, d))}
    names = register_views({name: store.write(df, name) for name, df in tables.items()})
    counts = [spark.sql(f"select '{name}' as view_name, count(*) as rows from {name}") for name in names]
    for name in names:  # the plans are made; the names are not left behind
        spark.catalog.dropTempView(name)
    return union_events(*counts)


@query("k6_rebuild", """
select 'companies' as step, count(*) as rows_before, 0 as rows_after from supplier
union all select 'contacts', 0, count(*) from customer""")
@Q.in_store
def k6(spark, d, store):
    """A rebuild starts from empty tables: what is not in its snapshots is gone."""
    store.write(X.table(spark, d, "supplier").select(F.col("s_suppkey").alias("id")), "companies")
    count = lambda name: store.read(name).count()
    before = {name: count(name) for name in ("companies", "contacts")}
    ctx = context(spark, d, objects={"contacts": X.contacts(spark, d)})
    ctx.tables = store
    LD.run_full(ctx, rebuild=True)
    return spark.createDataFrame([(n, before[n], count(n)) for n in before],
                                 "step string, rows_before long, rows_after long")


@query("s1_landed_files", """
select 'contacts' as what, count(*) as rows, count(distinct c_custkey) as ids,
       sum(c_custkey) as id_sum from customer
union all select 'deals', count(*), count(distinct o_orderkey), sum(o_orderkey) from orders
union all select 'deal history', 5 * count(*), count(*), 5 * sum(o_orderkey) from orders""")
@Q.in_store
def s1_files(spark, d, store):
    """Payload pages of whole tables landed as files, repeated ids included, and read back.

    Contacts lie in two files' worth of pages; the ones that come later win, so each id is there once
    after :func:`keep_last`.
    """
    from crmlake.operators.history import property_history
    from crmlake.operators.ordered import keep_last
    from crmlake.sources import landed as L
    root = f"{store.root}/landing"

    def page(raw):
        return raw.select(F.concat(F.lit('{"results":['), "raw", F.lit("]}")).alias("value"))

    contacts = page(X.contacts(spark, d))
    contacts.unionAll(contacts).write.text(f"{root}/objects/contacts")
    page(X.deals(spark, d)).write.text(f"{root}/objects/deals")
    X.deal_history_pages(spark, d).select("page").write.text(f"{root}/history/deal")
    landed = LD.Landed.below(spark, root)

    def summed(rows, what, key):
        return rows.agg(F.lit(what).alias("what"), F.count(F.lit(1)).alias("rows"),
                        F.count_distinct(key).alias("ids"), F.sum(F.col(key).cast("long")).alias("id_sum"))

    ids = lambda t: L.parse_objects(landed.objects[t], t).select("id", "seq")
    history = L.history_payloads(landed.history["deal"], "deal").select("object_id", F.explode("items"))
    return summed(keep_last(ids("contacts"), ["id"], "seq"), "contacts", "id").unionByName(
        summed(ids("deals"), "deals", "id")).unionByName(summed(history, "deal history", "object_id"))
