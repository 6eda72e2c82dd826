"""Sources, flatteners, rejection and lookups of the main objects."""

from __future__ import annotations

from pyspark.sql import functions as F

from crmlake import fixtures as X
from crmlake.functions import text as TX, values as V
from crmlake.functions.associations import first_contact, source_object
from crmlake.model.objects import ACTIVITY_SOURCES
from crmlake.operators import flatten as FL, resolve as R
from crmlake.plans.timeline import union_events
from crmlake.sources import landed as L
from queryset.base import query, ts
from queryset.sqlparts import (
    ACTIVITIES, COMMUNICATIONS, COMPANIES, CONTACT_COLUMNS, CONTACTS, DEALS, OWNERS, STAGES,
    TICKETS, owned, stripped, with_)


def parsed(spark, d, object_type):
    return L.parse_objects(getattr(X, object_type)(spark, d), object_type)


@query("s1_read_objects", """
select cast(o_orderkey as varchar) as id, o_orderstatus as dealstage, o_orderpriority as pipeline
from orders""")
def s1(spark, d):
    """Orders as landed pages with a cursor, opened to objects."""
    o = X.raw_object(X.table(spark, d, "orders"), F.col("o_orderkey"), {
        "dealstage": F.col("o_orderstatus"), "pipeline": F.col("o_orderpriority")})
    pages = o.select(F.concat(F.lit('{"results":['), "raw",
                              F.lit('],"paging":{"next":{"after":"9"}}}')).alias("page"))
    rows = L.parse_objects(L.page_objects(pages), "deals")
    return rows.select("id", F.col("properties.dealstage").alias("dealstage"),
                       F.col("properties.pipeline").alias("pipeline"))


@query("s2_select_properties", """
select cast(c_custkey as varchar) as id, c_name as firstname, lower(c_mktsegment) as contact_type,
       cast(null as varchar) as other
from customer""")
def s2(spark, d):
    c = X.table(spark, d, "customer")
    raw = X.raw_object(c, F.col("c_custkey"),
                       X.contact_properties() | {"not_requested": F.lit("x")})
    p = F.col("properties")
    return L.select_properties(raw, "contacts").select(
        "id", p["firstname"].alias("firstname"), p["contact-type"].alias("contact_type"),
        p["not_requested"].alias("other"))


@query("s3_owners_dim", with_(OWNERS) + "select key, name from owners")
def s3(spark, d):
    return R.owners_dim(L.owner_rows(X.owner_pages(spark, d)))


@query("s4_options_dim", with_(STAGES) + "select key, name from pipelines")
def s4(spark, d):
    return R.options_dim(L.option_rows(X.pipeline_pages(spark, d)))


@query("p1_flatten_contacts", with_(CONTACTS) + f"select {CONTACT_COLUMNS} from contacts")
def p1(spark, d):
    return FL.flatten_contacts(parsed(spark, d, "contacts")).drop("seq")


@query("p2_flatten_companies", with_(COMPANIES) + f"""
select source_id, record_id, name, company_owner, {ts('created_at')} as created_at, phone,
       {ts('last_activity_date')} as last_activity_date, city, country, cvr, postal_code, type
from companies""")
def p2(spark, d):
    return FL.flatten_companies(parsed(spark, d, "companies")).drop("seq")


_DEAL = f"""source_id, record_id, deal_name, deal_stage, pipeline, {ts('close_date')} as close_date,
  deal_owner, amount, deal_type, {ts('created_at')} as created_at"""


@query("p3_flatten_deals", with_(DEALS) + f"select {_DEAL} from deals")
def p3(spark, d):
    return FL.flatten_deals(parsed(spark, d, "deals")).drop("seq")


@query("p4_flatten_tickets", with_(TICKETS) + f"""
select source_id, record_id, ticket_name, pipeline, ticket_status, {ts('created_at')} as created_at,
       priority, ticket_owner, source, {ts('last_activity_date')} as last_activity_date
from tickets""")
def p4(spark, d):
    return FL.flatten_tickets(parsed(spark, d, "tickets")).drop("seq")


@query("p5_flatten_communications", with_(COMMUNICATIONS) + f"""
select source_id, record_id, channel_type, {stripped('html')} as communication_body,
       contact_id as associated_contact_id, cast(null as varchar) as associated_contact_name,
       cast(null as varchar) as associated_contact_email, assigned as activity_assigned_to,
       {ts('activity_date')} as activity_date
from communications""")
def p5(spark, d):
    return FL.flatten_communications(parsed(spark, d, "communications")).drop("seq")


@query("p6_flatten_emails", f"""
select cast(page_id as varchar) as source_id, cast(page_id as varchar) as record_id,
       url as email_subject, '2024-01-04 00:00:00.000000' as activity_date,
       cast(page_id as varchar) as associated_contact_id,
       cast(null as varchar) as associated_contact_name,
       cast(null as varchar) as associated_contact_email,
       cast(page_id as varchar) as activity_assigned_to, html as email_body,
       'SENT' as email_send_status
from pages""")
def p6(spark, d):
    return FL.flatten_emails(parsed(spark, d, "emails")).drop("seq")


@query("p7_flatten_notes", f"""
select cast(doc_id as varchar) as source_id, cast(doc_id as varchar) as record_id,
       {stripped("'<div>' || text || '</div>'")} as body_preview, lang as activity_assigned_to,
       '2024-01-05 00:00:00.000000' as activity_date
from documents""")
def p7(spark, d):
    return FL.flatten_notes(parsed(spark, d, "notes")).drop("seq")


@query("p15_object_id", """
select cast(c_custkey as varchar) as number_id, c_custkey || '-a' as text_id,
       cast(null as varchar) as decimal_id
from customer""")
def p15(spark, d):
    c = X.table(spark, d, "customer")
    raw = c.select(F.to_json(F.struct(
        F.col("c_custkey").alias("a"), F.concat(X.text("c_custkey"), F.lit("-a")).alias("b"),
        (F.col("c_custkey") + 0.5).alias("c"))).alias("raw"))
    o = raw.select(F.from_json("raw", "struct<a:variant,b:variant,c:variant>").alias("o"))
    return o.select(V.object_id(F.col("o.a")).alias("number_id"),
                    V.object_id(F.col("o.b")).alias("text_id"),
                    V.object_id(F.col("o.c")).alias("decimal_id"))


@query("p16_typed_properties", f"""
select o_orderstatus as as_string, {ts('cast(o_orderdate as timestamp)')} as as_timestamp,
       round(o_totalprice, 2) as as_decimal, o_custkey as as_int, o_orderkey as as_long,
       o_orderkey as as_long_text, o_orderstatus = 'F' as as_bool, false as bad_bool,
       cast(null as bigint) as bad_int, cast(null as varchar) as bad_timestamp
from orders""")
def p16(spark, d):
    o = X.table(spark, d, "orders")
    raw = o.select(F.to_json(F.struct(
        F.col("o_orderstatus").alias("s"), X.iso("o_orderdate").alias("t"),
        F.format_string("%,.2f", "o_totalprice").alias("m"), F.col("o_custkey").alias("i"),
        F.col("o_orderkey").alias("l"), F.format_string(" %d ", "o_orderkey").alias("lt"),
        F.when(F.col("o_orderstatus") == "F", "TRUE").otherwise("false").alias("b"),
        F.lit("yes").alias("bb"), F.lit("7.5").alias("bi"), F.lit("soon").alias("bt"))).alias("raw"))
    names = ("s", "t", "m", "i", "l", "lt", "b", "bb", "bi", "bt")
    schema = "struct<" + ",".join(f"{n}:variant" for n in names) + ">"
    v = raw.select(F.from_json("raw", schema).alias("o")).select("o.*")

    def get(name, kind, alias):
        return V.prop(F.col(name), kind).alias(alias)

    return v.select(
        get("s", "string", "as_string"), get("t", "timestamp", "as_timestamp"),
        get("m", "decimal", "as_decimal"), get("i", "int", "as_int"), get("l", "long", "as_long"),
        get("lt", "long", "as_long_text"), get("b", "bool", "as_bool"),
        get("bb", "bool", "bad_bool"), get("bi", "long", "bad_int"),
        get("bt", "timestamp", "bad_timestamp"))


@query("p17_strip_html", f"select page_id, {stripped('html')} as body from pages")
def p17(spark, d):
    return X.table(spark, d, "pages").select("page_id", TX.strip_html("html").alias("body"))


@query("p18_full_name", """
select c_custkey, case when c_acctbal >= 0 then trim(c_name || ' ' || case when c_acctbal >= 5000
       then c_mktsegment else '' end) end as full_name
from customer""")
def p18(spark, d):
    c = X.table(spark, d, "customer")
    first = F.when(F.col("c_acctbal") >= 0, F.col("c_name")).otherwise("")
    last = F.when(F.col("c_acctbal") >= 5000, F.col("c_mktsegment"))
    return c.select("c_custkey", TX.full_name(first, last).alias("full_name"))


@query("p19_first_contact", """
select conv_id || '-' || turn as id, cast(conv_id as varchar) as contact_id from conversations""")
def p19(spark, d):
    return parsed(spark, d, "communications").select(
        "id", first_contact(F.col("associations")).alias("contact_id"))


@query("p20_source_object", with_(ACTIVITIES) + """
select source_id as id, source_object_type as type, source_object_id as object_id from activities""")
def p20(spark, d):
    s, parts = source_object(), []
    for kind, object_type in ACTIVITY_SOURCES.items():
        rows = L.parse_objects(X.activities(spark, d, kind), object_type)
        parts.append(rows.select("id", s["type"].alias("type"), s["id"].alias("object_id")))
    return union_events(*parts)


@query("p21_raw_properties", """
select cast(o_orderkey as varchar) as id, o_orderpriority as pipeline,
       'Order ' || o_orderkey as dealname, '{}' as none
from orders""")
def p21(spark, d):
    o = X.raw_object(X.table(spark, d, "orders"), F.col("o_orderkey"), {
        "dealname": F.concat(F.lit("Order "), X.text("o_orderkey")),
        "pipeline": F.col("o_orderpriority")})
    props = L.raw_properties("raw")
    return o.select(F.get_json_object("raw", "$.id").alias("id"),
                    F.get_json_object(props, "$.pipeline").alias("pipeline"),
                    F.get_json_object(props, "$.dealname").alias("dealname"),
                    L.raw_properties(F.lit('{"id":1}')).alias("none"))


_REJECT = """
select c_custkey, case when c_acctbal < 1000 then 'wrong type: phone'
                       when c_acctbal > 9000 then 'missing id'
                       when c_acctbal > 8000 then 'missing properties' end as reason
from customer"""


@query("p22_split_valid", f"""
select 'kept' as outcome, cast(null as varchar) as reject_reason, cast(c_custkey as varchar) as seq
from ({_REJECT}) where reason is null
union all
select 'rejected', reason, cast(c_custkey as varchar) from ({_REJECT}) where reason is not null""")
def p22(spark, d):
    rows = FL.flatten_all(L.parse_objects(X.unclean_contacts(spark, d), "contacts"), "contacts")
    ok, bad = FL.split_valid(rows)
    return ok.select(F.lit("kept").alias("outcome"), F.lit(None).cast("string").alias("reject_reason"),
                     "seq").unionByName(
        bad.select(F.lit("rejected").alias("outcome"), "reject_reason", "seq"))


@query("p23_with_etl_date", """
select c_custkey, '2024-01-15 00:00:00.000000' as etl_date from customer""")
def p23(spark, d):
    return FL.with_etl_date(X.table(spark, d, "customer").select("c_custkey"), X.AS_OF)


@query("f5_not_blank", """
select o_orderkey from orders where o_orderstatus <> 'O'""")
def f5(spark, d):
    o = X.table(spark, d, "orders").withColumn(
        "padded", F.when(F.col("o_orderstatus") == "O", F.lit(" \n")).otherwise(F.col("o_orderstatus")))
    return o.filter(TX.not_blank("padded")).select("o_orderkey")


@query("j1_resolve_owner", with_(OWNERS, TICKETS) + f"""
select x.source_id, {owned('ticket_owner')} as ticket_owner
from tickets x left join owner_names o on o.key = x.ticket_owner""")
def j1(spark, d):
    rows = FL.flatten_tickets(parsed(spark, d, "tickets")).select("source_id", "ticket_owner")
    return R.resolve_owner(rows, "ticket_owner", R.owners_dim(L.owner_rows(X.owner_pages(spark, d))),
                           X.owner_overrides(spark, d))


@query("j2_resolve_route", with_(STAGES, TICKETS) + """
select x.source_id, case when coalesce(p.name, x.pipeline) = '0' then 'Support Pipeline'
                         else coalesce(p.name, x.pipeline) end as pipeline
from tickets x left join pipelines p on p.key = x.pipeline""")
def j2(spark, d):
    rows = FL.flatten_tickets(parsed(spark, d, "tickets")).select("source_id", "pipeline")
    return R.resolve_pipeline(rows, "pipeline", R.options_dim(L.option_rows(X.pipeline_pages(spark, d))))


@query("j3_resolve_stage", with_(STAGES, TICKETS) + """
select x.source_id, coalesce(v.name, s.name, x.ticket_status) as ticket_status
from tickets x left join stage_options s on s.key = x.ticket_status
left join stage_overrides v on v.key = lower(coalesce(s.name, x.ticket_status))""")
def j3(spark, d):
    rows = FL.flatten_tickets(parsed(spark, d, "tickets")).select("source_id", "ticket_status")
    return R.resolve_stage(rows, "ticket_status",
                           R.options_dim(L.option_rows(X.stage_pages(spark, d))),
                           X.stage_overrides(spark, d))


@query("j4_enrich_contact", with_(CONTACTS, COMMUNICATIONS) + """
select x.source_id, x.contact_id as associated_contact_id,
       case when c.c_acctbal >= 2000 then c.full_name when c.source_id is not null
            then 'Stored ' || c.source_id when k.s_suppkey is not null then 'Later ' || k.s_suppkey end
         as associated_contact_name,
       case when c.c_acctbal >= 2000 then c.email end as associated_contact_email
from communications x left join contacts c on c.source_id = x.contact_id
left join supplier k on cast(k.s_suppkey as varchar) = x.contact_id and c.source_id is null""")
def j4(spark, d):
    """This run knows the richer customers, the stored table all of them by record id."""
    rows = FL.flatten_communications(parsed(spark, d, "communications"))
    now = FL.flatten_contacts(L.parse_objects(X.contacts(spark, d), "contacts"))
    customers = X.table(spark, d, "customer")
    rich = customers.filter("c_acctbal >= 2000").select(X.text("c_custkey").alias("source_id"))
    current = now.join(rich, "source_id", "left_semi")
    none = F.lit(None).cast("string")
    stored = customers.select(
        F.concat(F.lit("s"), X.text("c_custkey")).alias("source_id"),
        X.text("c_custkey").alias("record_id"),
        F.concat(F.lit("Stored "), X.text("c_custkey")).alias("full_name"), none.alias("email"))
    later = X.table(spark, d, "supplier").select(
        X.text("s_suppkey").alias("source_id"), none.alias("record_id"),
        F.concat(F.lit("Later "), X.text("s_suppkey")).alias("full_name"), none.alias("email"))
    return R.enrich_contact(rows, "associated_contact_id", current, stored, later).select(
        "source_id", "associated_contact_id", "associated_contact_name",
        "associated_contact_email")


@query("j5_enrich_email_contact", with_(CONTACTS) + """
select cast(page_id as varchar) as source_id, c.full_name as associated_contact_name,
       c.email as associated_contact_email
from pages left join contacts c on c.source_id = cast(page_id as varchar)""")
def j5(spark, d):
    rows = FL.flatten_emails(parsed(spark, d, "emails"))
    current = FL.flatten_contacts(parsed(spark, d, "contacts"))
    return R.enrich_contact(rows, "associated_contact_id", current).select(
        "source_id", "associated_contact_name", "associated_contact_email")
