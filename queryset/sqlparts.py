"""Expected rows on the plain driver tables, as common table expressions for the oracle SQL."""

from __future__ import annotations

from queryset.base import ts

OWNERS = """
owners as (
  select cast(n_nationkey as varchar) as key,
         case when n_nationkey >= 10 then 'Owner ' || n_name
              when n_nationkey >= 5 then lower(n_name) || '@example.com'
              else cast(n_nationkey as varchar) end as name
  from nation),
owner_names as (
  select key, name from owners
  union all
  select cast(r_regionkey + 23 as varchar), 'Manual ' || r_name from region
  where cast(r_regionkey + 23 as varchar) not in (select key from owners))"""

_DAY = "(timestamp '2023-01-01 00:00:00' + to_days(c_nationkey))"
CONTACTS = f"""
contacts as (
  select cast(c_custkey as varchar) as source_id, cast(c_custkey as varchar) as record_id,
         case when c_acctbal >= 1000 then c_name || ' ' || c_mktsegment else c_name end as full_name,
         case when c_acctbal >= 0
              then lower(c_mktsegment) || '.' || c_nationkey || '@example.com' end as email,
         '+45 ' || c_custkey as phone, cast(c_nationkey as varchar) as contact_owner,
         cast(null as varchar) as company,
         {_DAY} + case when c_acctbal < 5000 then interval 750 minute
                       else interval 600 minute end as last_activity_date,
         case when c_acctbal > 3000 then 'OPEN' end as lead_status,
         c_mktsegment as lifecycle_stage, cast(c_nationkey as varchar) as postal_code,
         lower(c_mktsegment) as contact_type, cast(null as varchar) as inverter_brand,
         cast(null as timestamp) as last_contacted, {_DAY} as created_at,
         cast(null as varchar) as analytics_source,
         cast(null as varchar) as analytics_source_data1,
         cast(null as varchar) as analytics_source_data2, c_acctbal, c_custkey, c_nationkey
  from customer)"""

CONTACT_COLUMNS = f"""source_id, record_id, full_name, email, phone, contact_owner, company,
  {ts('last_activity_date')} as last_activity_date, lead_status, lifecycle_stage, postal_code,
  contact_type, inverter_brand, {ts('last_contacted')} as last_contacted,
  {ts('created_at')} as created_at, analytics_source, analytics_source_data1,
  analytics_source_data2"""

COMPANIES = """
companies as (
  select cast(s_suppkey as varchar) as source_id,
         case when s_acctbal >= 0 then 'R' || s_suppkey else cast(s_suppkey as varchar) end
           as record_id,
         s_name as name, cast(s_nationkey as varchar) as company_owner,
         timestamp '2022-05-05 00:00:00' as created_at, '+46 ' || s_suppkey as phone,
         cast(null as timestamp) as last_activity_date, 'City' as city,
         cast(null as varchar) as country,
         case when s_acctbal >= 3000 then 'A' || s_suppkey else 'B' || s_suppkey end as cvr,
         case when s_acctbal >= 6000 then cast(s_nationkey as varchar)
              when s_acctbal >= 1000 then 'P' || s_nationkey end as postal_code,
         case when s_acctbal >= 8000 then 'first' when s_acctbal >= 5000 then 'second'
              when s_acctbal >= 2000 then 'third' end as type
  from supplier)"""

DEALS = """
deals as (
  select cast(o_orderkey as varchar) as source_id, cast(o_orderkey as varchar) as record_id,
         'Order ' || o_orderkey as deal_name, o_orderstatus as deal_stage,
         o_orderpriority as pipeline, closed as close_date,
         cast(o_custkey as varchar) as deal_owner, round(o_totalprice, 2) as amount,
         case when o_orderstatus <> 'P' then 'newbusiness' end as deal_type,
         cast(o_orderdate as timestamp) as created_at, o_orderkey
  from orders left join (
    select l_orderkey, max(cast(l_shipdate as timestamp)) as closed from lineitem
    group by l_orderkey) on l_orderkey = o_orderkey)"""

TICKETS = """
tickets as (
  select cast(p_partkey as varchar) as source_id, cast(p_partkey as varchar) as record_id,
         case when p_size >= 5 then p_name when p_size >= 3 then p_brand end as ticket_name,
         cast(p_size // 10 as varchar) as pipeline,
         case when p_size < 45 then cast(p_size as varchar) else 'unstaged' end as ticket_status,
         case when p_size > 2 then timestamp '2024-01-02 08:00:00' end as created_at,
         case when p_size > 25 then 'HIGH' end as priority,
         cast(p_size as varchar) as ticket_owner,
         case when p_size > 40 then 'CHAT' when p_size > 20 then 'FORM'
              when p_size > 10 then 'PHONE' end as source,
         cast(null as timestamp) as last_activity_date
  from part)"""

STAGES = """
pipelines as (
  select cast(r_regionkey + 1 as varchar) as key,
         case when r_regionkey > 0 then r_name else cast(r_regionkey + 1 as varchar) end as name
  from region),
stage_options as (
  select cast(n_nationkey + 10 as varchar) as key, n_name as name from nation),
stage_overrides as (
  select case when n_nationkey < 9 then cast(n_nationkey + 1 as varchar) else lower(n_name) end
           as key, 'Stage ' || n_name as name from nation)"""

COMMUNICATIONS = """
communications as (
  select conv_id || '-' || turn as source_id, conv_id || '-' || turn as record_id,
         case when role <> 'system' then role else 'other' end as channel_type,
         '<p>' || text || '<br/>end</p> ' as html, cast(conv_id as varchar) as contact_id,
         cast(turn as varchar) as assigned, timestamp '2024-01-03 00:00:00' as activity_date
  from conversations)"""


def stripped(html: str) -> str:
    """Markup removed, then white space at both ends."""
    return (f"regexp_replace(regexp_replace(regexp_replace({html}, '<(br|BR)\\s*/?>', chr(10), 'g'),"
            " '(?s)<.*?>', '', 'g'), '^\\s+|\\s+$', '', 'g')")


NOW = "timestamp '2024-01-15 00:00:00'"

EVENTS = """
e as (
  select event_id, cast(ts as timestamp) as ts, user_id, value,
         cast(json_extract_string(props, '$.k') as int) as k,
         case event_type when 'view' then 'CALL' when 'click' then 'EMAIL'
              when 'purchase' then 'MEETING' when 'signup' then 'TASK' else 'NOTE' end as kind
  from events)"""

ACTIVITIES = EVENTS + f""",
dated as (
  select *, case when kind = 'MEETING' and value >= 100 then ts + interval 1 day else ts end as moment
  from e),
activities as (
  select cast(event_id as varchar) as source_id, cast(event_id as varchar) as record_id,
         kind as activity_type,
         case when kind <> 'NOTE' and value >= 10
              then upper(substr(kind, 1, 1)) || lower(substr(kind, 2)) || ' ' || event_id end
           as subject,
         rtrim('k ' || k || chr(10) || 'done'
               || case when kind = 'NOTE' then repeat('word ', k) else '' end) as body,
         cast(k as varchar) as activity_owner,
         case when k < 80 then 'contacts' when k >= 90 then 'companies' end as source_object_type,
         case when k < 80 then cast(user_id as varchar) when k >= 90 then cast(k as varchar) end
           as source_object_id,
         moment as activity_date,
         case kind
           when 'TASK' then case
             when k >= 90 or k < 10 then 'completed'
             when k between 45 and 50 then 'overdue'
             when k between 45 and 80 then case
               when ts + interval 2 day < {NOW} then 'overdue'
               when ts + interval 2 day <= {NOW} + interval 24 hour then 'due'
               else 'upcoming' end
             when k > 80 and ts + interval 3 day > {NOW} then 'upcoming'
             when k < 30 then case when ts > {NOW} then 'upcoming' else 'due' end
             when k < 40 then 'due'
             when ts <= {NOW} then 'completed' else 'upcoming' end
           when 'MEETING' then case when moment > {NOW} then 'upcoming' else 'completed' end
           when 'CALL' then case
             when value < 20 then case when ts > {NOW} then 'upcoming' else 'due' end
             when value < 200 then 'completed'
             when ts > {NOW} then 'upcoming' else 'completed' end
           else 'completed' end as status,
         event_id, user_id, value, k, ts
  from dated
  union all
  select conv_id || '-' || turn, conv_id || '-' || turn, 'SMS', case when turn > 0 then 'Turn ' || turn end,
         {stripped("text")}, cast(turn as varchar), 'contacts', cast(conv_id as varchar),
         timestamp '2024-01-06 00:00:00', 'completed', null, conv_id, null, 50, timestamp '2024-01-06 00:00:00'
  from conversations)"""

ACTIVITY_COLUMNS = f"""source_id, record_id, activity_type, subject, body, activity_owner,
  source_object_type, source_object_id, {ts('activity_date')} as activity_date, status"""

ACTIVITY_EDGES = """
activity_edges as (
  select source_id as activity_source_id, 'company' as associated_object_type,
         cast(k as varchar) as associated_object_id, 'to_company' as association_label,
         cast(null as bigint) as association_type_id, cast(null as varchar) as association_category
  from activities where k >= 90
  union all
  select source_id, 'deal', cast(event_id as varchar),
         case when k < 10 then 'Main deal' else 'Later' end, case when k < 10 then 7 else 9 end,
         'USER'
  from activities where k < 20
  union all
  select source_id, 'contact', cast(user_id as varchar), case when activity_type <> 'SMS' then 'to_contact' end, null, null
  from activities where k < 80)"""

PAIRS = """
pairs as (
  select o_custkey, l_suppkey, max(l_returnflag) as flag, min(l_linestatus) as state,
         max(l_linenumber) as line, max(cast(l_shipdate as timestamp)) as shipped
  from orders join lineitem on o_orderkey = l_orderkey group by o_custkey, l_suppkey)"""

# label, labels and times of an edge, from flag, state, line and shipped
EDGE_LABEL = """case when flag = 'A' then 'Primary' when flag = 'R' then 'Returning'
                     when state = 'F' then 'primary' end"""
EDGE_LABELS = """case when flag = 'A' and state = 'F' then '["Primary","primary"]'
                      when flag = 'A' then '["Primary"]'
                      when flag = 'R' and state = 'F' then '["Returning","primary"]'
                      when flag = 'R' then '["Returning"]'
                      when state = 'F' then '["primary"]' end"""
EDGE_LABELS_ONCE = """case when flag = 'A' then '["Primary"]'
                      when flag = 'R' and state = 'F' then '["Returning","primary"]'
                      when flag = 'R' then '["Returning"]'
                      when state = 'F' then '["primary"]' end"""
EDGE_CREATED = "case when flag = 'R' then shipped else timestamp '2024-01-01 00:00:00' end"
EDGE_SOURCE = "case when state = 'F' then 'API' end"

HISTORY = """
items as (
  select o_orderkey, 0 as pos, o_orderstatus as value,
         cast(o_orderdate as timestamp) + interval 1 day as moment, 'CRM_UI' as source from orders
  union all
  select o_orderkey, 3, case when o_orderstatus <> 'P' then o_orderpriority end,
         cast(o_orderdate as timestamp), null from orders
  union all
  select o_orderkey, 4, 'new', cast(o_orderdate as timestamp) - interval 1 day, 'API' from orders),
deal_history as (
  select 'deal' as object_type, cast(o_orderkey as varchar) as object_id,
         'dealstage' as property_name,
         lag(value) over (partition by o_orderkey order by pos) as new_value, value as old_value,
         moment as change_date, source, cast(null as varchar) as source_id
  from items where value is not null)"""

CHANGES = """
changes as (
  select 'contact' as object_type, cast(user_id as varchar) as object_id,
         'lifecyclestage' as property_name,
         lead(event_type) over (partition by user_id order by ts, event_type) as new_value,
         event_type as old_value, cast(ts as timestamp) as change_date,
         json_extract_string(props, '$.k') as source
  from events)"""


def with_(*parts: str) -> str:
    return "with " + ",".join(p.strip() for p in parts) + "\n"


def owned(column: str) -> str:
    """Owner name for an id column of ``x``, joined as ``o``."""
    return f"coalesce(o.name, x.{column})"
