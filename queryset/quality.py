"""Data-quality rules and stored tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from crmlake import fixtures as X
from crmlake.model.tables import lengths, required
from crmlake.operators import flatten as FL, quality as Q
from crmlake.operators.merge import to_table
from crmlake.plans import views as VW
from crmlake.sources import landed as L
from crmlake.sources import tables as ST
from queryset.activities import stored
from queryset.base import kept, query, ts
from queryset.sqlparts import ACTIVITIES, CONTACTS, DEALS, OWNERS, owned, with_


def contacts(spark, d):
    rows = FL.flatten_contacts(L.parse_objects(X.contacts(spark, d), "contacts"))
    return to_table(FL.with_etl_date(rows, X.AS_OF), "contacts")


@query("q1_check_unique", with_(CONTACTS) + """
select email, count(*) as copies from contacts where email is not null group by email
having count(*) > 1""")
def q1(spark, d):
    return Q.check_unique(contacts(spark, d), ["email"], F.col("email").isNotNull())


@query("q1_check_unique_pair", """
select l_orderkey, l_linenumber, count(*) as copies from lineitem group by all having count(*) > 1""")
def q1b(spark, d):
    return Q.check_unique(X.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("q2_check_required", with_(CONTACTS) + """
select source_id as key, 'email' as column_name from contacts where email is null
union all select source_id, 'lead_status' from contacts where lead_status is null""")
def q2(spark, d):
    assert required("contacts") == ["id", "source_id", "etl_date"]
    return Q.check_required(contacts(spark, d), [*required("contacts"), "email", "lead_status"])


@query("q3_check_lengths", """
select cast(page_id as varchar) as key, 'email_subject' as column_name from pages
where length(url) > 40
union all select cast(page_id as varchar), 'email_body' from pages where length(html) > 2000""")
def q3(spark, d):
    limits = lengths("emails") | {"email_subject": 40, "email_body": 2000}
    rows = FL.flatten_emails(L.parse_objects(X.emails(spark, d), "emails"))
    return Q.check_lengths(to_table(rows, "emails"), limits)


@query("q4_check_references", """
select l_orderkey, l_suppkey from lineitem where l_suppkey not in (
  select s_suppkey from supplier where s_acctbal > 0)""")
def q4(spark, d):
    return Q.check_references(
        X.table(spark, d, "lineitem"), "l_suppkey",
        X.table(spark, d, "supplier").filter("s_acctbal > 0"), "s_suppkey").select(
        "l_orderkey", "l_suppkey")


def _deals(spark, d):
    rows = FL.flatten_deals(L.parse_objects(X.deals(spark, d), "deals"))
    return to_table(FL.with_etl_date(rows, "2000-06-15 12:00:00"), "deals")


@query("v1_fact_deals", with_(DEALS) + f"""
select o_orderkey as deal_id, source_id, deal_name, deal_stage, pipeline, amount,
       '2000-06-15 12:00:00.000000' as created_date, {ts('close_date')} as closed_date,
       date_diff('day', timestamp '2000-06-15 12:00:00', close_date) as days_to_close
from deals""")
def v1(spark, d):
    return VW.fact_deals(_deals(spark, d))


@query("v2_fact_activities", with_(ACTIVITIES) + f"""
select event_id as activity_id, source_id, activity_type, subject,
       {ts('activity_date')} as activity_date, status, source_object_type, source_object_id
from activities""")
def v2(spark, d):
    facts = VW.fact_activities(stored(spark, d)[0])
    return facts.withColumn("activity_id", F.when(F.col("activity_id") >= 0, F.col("activity_id")))  # hashes differ by engine


def _store(spark):
    return ST.Tables(spark, f"{ST.shared_folder(spark)}/tables-{uuid.uuid4().hex}")


def in_store(build):
    """A query over a store of its own: its rows are kept apart, and the store is removed."""
    def run(spark, d):
        store = _store(spark)
        try:
            return kept(spark, build(spark, d, store))
        finally:
            store.remove()

    return run


@query("k4_write_table", with_(DEALS) + """
select deal_id, source_id, amount from (select o_orderkey as deal_id, source_id, amount from deals)""")
@in_store
def k4(spark, d, store):
    """Deals written as a table and read back."""
    store.write(_deals(spark, d), "deals")
    return store.read("deals").select(F.col("id").alias("deal_id"), "source_id", "amount")


@query("k1_append", """
select c_custkey as id, c_name as full_name from customer
union all select -1 - s_suppkey, s_name from supplier""")
@in_store
def k1(spark, d, store):
    store.append(X.table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("full_name")), "contacts")
    rows = store.append(X.table(spark, d, "supplier").select(
        (-1 - F.col("s_suppkey")).alias("id"), F.col("s_name").alias("full_name")), "contacts")
    return rows.select("id", "full_name")


@query("k1_append_again", """
select c_custkey as id, c_name as full_name from customer
union all select -1 - s_suppkey, s_name from supplier""")
@in_store
def k1_again(spark, d, store):
    """An append that is run twice under one name, as after a failure, leaves its rows once."""
    store.write(X.table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("full_name")), "contacts")
    for _ in range(2):
        rows = store.append(X.table(spark, d, "supplier").select(
            (-1 - F.col("s_suppkey")).alias("id"), F.col("s_name").alias("full_name")), "contacts", batch="suppliers")
    return rows.select("id", "full_name")


@query("s12_read_table", with_(OWNERS, ACTIVITIES) + f"""
select x.source_id, x.activity_type, {owned('activity_owner')} as activity_owner
from activities x left join owner_names o on o.key = x.activity_owner""")
@in_store
def s12(spark, d, store):
    ST.write_table(stored(spark, d)[0], store.root, "activities")
    return ST.read_table(spark, store.root, "activities").select("source_id", "activity_type",
                                                                 "activity_owner")


@query("s13_point_lookup", "select o_orderkey as id, o_orderpriority as pipeline from orders where o_orderkey = 21")
@in_store
def s13(spark, d, store):
    store.write(X.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("pipeline")), "deals")
    return store.get("deals", 21).select("id", "pipeline")


@query("s13_filtered_scan", """
select c_custkey as id, c_mktsegment as lifecycle_stage from customer where c_mktsegment = 'BUILDING'""")
@in_store
def s13b(spark, d, store):
    store.write(X.table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("lifecycle_stage")), "contacts")
    return store.find("contacts", F.col("lifecycle_stage") == "BUILDING").select("id", "lifecycle_stage")


@query("m3_recreate_table", """
select count(*) as before, 0 as after from supplier""")
@in_store
def m3(spark, d, store):
    """Row counts of a table before and after it is recreated empty; the version before stays."""
    filled = store.write(X.table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("id")), "companies")
    empty = ST.recreate_table(spark, store.root, "companies")
    counted = filled.select(F.lit(1).alias("b"), F.lit(0).alias("a")).unionByName(
        empty.select(F.lit(0).alias("b"), F.lit(1).alias("a")))
    return counted.agg(F.sum("b").alias("before"), F.sum("a").alias("after"))


@query("k5_ensure_tables", """
select 'companies' as table_name, count(*) as rows from supplier union all select 'deals', 0""")
@in_store
def k5(spark, d, store):
    """A table that exists keeps its rows, a missing one is made empty."""
    store.write(X.table(spark, d, "supplier").select(F.col("s_suppkey").alias("id")), "companies")
    ST.ensure_tables(spark, store.root, "companies", "deals")
    one, two = store.read("companies"), store.read("deals")
    return one.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("companies").alias("table_name"), "rows"
        ).unionByName(two.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit("deals").alias("table_name"), "rows"))


@query("m4_ensure_table", "select count(*) as rows from customer")
@in_store
def m4(spark, d, store):
    store.ensure("contacts")
    store.append(X.table(spark, d, "customer").select(F.col("c_custkey").alias("id")), "contacts")
    store.ensure("contacts")
    return store.read("contacts").agg(F.count(F.lit(1)).alias("rows"))
