"""Activities, their details, status, edges and timeline events."""

from __future__ import annotations

from pyspark.sql import functions as F

from crmlake import fixtures as X
from crmlake.functions import status as S
from crmlake.functions.text import is_primary
from crmlake.model.objects import ACTIVITY_SOURCES, DETAIL_TABLES
from crmlake.operators import edges as E, flatten as FL, resolve as R
from crmlake.operators.merge import surrogate_id, to_table
from crmlake.plans import timeline as TL
from crmlake.sources import landed as L
from queryset.base import kept, query, ts
from queryset.sqlparts import (
    ACTIVITIES, ACTIVITY_COLUMNS, ACTIVITY_EDGES, CONTACTS, NOW, OWNERS, owned, with_)

KINDS = ("CALL", "EMAIL", "MEETING", "TASK", "NOTE", "SMS")


def parsed(spark, d, kind):
    return L.parse_objects(X.activities(spark, d, kind), ACTIVITY_SOURCES[kind])


def flat(spark, d, kind):
    return FL.flatten_activities(parsed(spark, d, kind), kind, X.AS_OF)


def all_flat(spark, d):
    return FL.all_activities(**{k: flat(spark, d, k) for k in KINDS})


_SHOWN = ("source_id", "record_id", "activity_type", "subject", "body", "activity_owner",
          "source_object_type", "source_object_id", "activity_date", "status")


@query("p8_flatten_activities", with_(ACTIVITIES) + f"select {ACTIVITY_COLUMNS} from activities")
def p8(spark, d):
    return all_flat(spark, d).select(*_SHOWN)


@query("x1_all_activities", with_(ACTIVITIES) + """
select activity_type, count(*) as activities, count(subject) as with_subject from activities
group by activity_type""")
def x1(spark, d):
    rows = all_flat(spark, d)
    return rows.groupBy("activity_type").agg(F.count(F.lit(1)).alias("activities"),
                                             F.count("subject").alias("with_subject"))


@query("p9_call_details", with_(ACTIVITIES) + f"""
select source_id, case when value < 100 then 'INBOUND' else 'OUTBOUND' end as direction,
       case when value < 20 then 'SCHEDULED' when value < 200 then 'COMPLETED' end as status,
       subject as call_title, case when value < 100 then 'INBOUND' else 'OUTBOUND' end
         as call_direction, {ts('ts')} as created_date,
       cast(null as varchar) as created_by_user_id, cast(null as varchar) as last_modified_date
from activities where activity_type = 'CALL'""")
def p9(spark, d):
    return FL.call_details(parsed(spark, d, "CALL")).drop("seq", "raw_properties_json")


_EMAIL_DETAIL = """
  case when k < 95 then 'SENT' end as status,
  case when k < 30 then 'Incoming' when k < 90 then 'SENT' end as email_direction,
  case when value > 50 then '0.5' end as email_open_rate,
  case when value > 80 then '0.1' end as email_click_rate,
  cast(k // 10 as varchar) as number_of_email_clicks,
  case when k < 50 then cast(k as varchar) when k < 60 then 'n/a' end as number_of_email_opens"""


@query("p10_email_details", with_(ACTIVITIES) + f"""
select source_id, {_EMAIL_DETAIL}, cast(null as varchar) as text_body,
       '<p>k ' || k || '<br/>done</p>' as html_body, {ts('ts')} as created_date,
       cast(null as varchar) as created_by_user_id, cast(null as varchar) as email_reply_rate,
       cast(null as varchar) as last_modified_date, cast(null as varchar) as updated_by_user_id
from activities where activity_type = 'EMAIL'""")
def p10(spark, d):
    return FL.email_details(parsed(spark, d, "EMAIL")).drop("seq", "raw_properties_json")


_MEETING_DETAIL = """
  case when value >= 100 then ts + interval 1 day end as start_time,
  case when value >= 200 then ts + interval 2 day end as end_time,
  case when k < 50 then 'Room ' || k end as meeting_location"""


@query("p11_meeting_details", with_(ACTIVITIES) + f"""
select source_id, {ts('start_time')} as start_time, {ts('end_time')} as end_time,
       meeting_location, subject as meeting_name, {ts('ts')} as created_date,
       cast(null as varchar) as contact_first_outreach_date,
       cast(null as varchar) as created_by_user_id, cast(null as varchar) as team,
       cast(null as varchar) as attendee_owner_ids, cast(null as varchar) as last_modified_date,
       cast(null as varchar) as location_type, cast(null as varchar) as meeting_source,
       cast(null as varchar) as time_to_book_from_first_contact
from (select *, {_MEETING_DETAIL} from activities where activity_type = 'MEETING')""")
def p11(spark, d):
    return FL.meeting_details(parsed(spark, d, "MEETING")).drop("seq", "raw_properties_json")


_TASK_DETAIL = """
  case when value > 30 then 'HIGH' end as priority,
  case when k < 10 then 'COMPLETED' when k < 30 then 'WAITING' when k < 40 then 'in_progress' end
    as task_status,
  case when value > 60 then 'TODO' end as task_type"""


@query("p12_task_details", with_(ACTIVITIES) + f"""
select source_id, priority, task_status as status,
       '<p>k ' || k || '<br/>done</p>' as communication_body, {ts('ts')} as created_at,
       case when k between 40 and 50 then 'True' end as is_overdue,
       cast(null as varchar) as last_modified_at, task_type,
       cast(null as varchar) as updated_by_user_id
from (select *, {_TASK_DETAIL} from activities where activity_type = 'TASK')""")
def p12(spark, d):
    return FL.task_details(parsed(spark, d, "TASK")).drop("seq", "raw_properties_json")


@query("p13_note_details", with_(ACTIVITIES) + f"""
select source_id, {ts('ts')} as created_date, cast(null as varchar) as created_by_user_id,
       cast(null as varchar) as last_modified_date, activity_owner as raw_owner
from activities where activity_type = 'NOTE'""")
def p13(spark, d):
    return FL.note_details(parsed(spark, d, "NOTE")).withColumn(
        "raw_owner", F.get_json_object("raw_properties_json", "$.hubspot_owner_id")).drop(
        "seq", "raw_properties_json")


@query("p14_sms_details", """
select conv_id || '-' || turn as source_id, case when role = 'user' then 'IN' else 'OUT' end
         as direction, text as message_body,
       case when role = 'system' then text end as communication_body,
       coalesce('Manual ' || r_name, cast(turn as varchar)) as activity_assigned_to
from conversations left join region on r_regionkey + 23 = turn""")
def p14(spark, d):
    details = FL.sms_details(parsed(spark, d, "SMS"), X.owner_overrides(spark, d))
    return details.select("source_id", "direction", "message_body", "communication_body",
                          "activity_assigned_to")


def _table_ids(activities):
    return activities.withColumn("id", surrogate_id(["source_id"]))


def _shown_id(column):
    """A surrogate id that is the source's own number; hashes are negative and differ between engines."""
    return F.when(F.col(column) >= 0, F.col(column)).alias(column)


@query("p26_attach_activity", with_(ACTIVITIES) + """
select event_id as activity_id, activity_type, case when activity_type = 'CALL' then subject end as call_title
from activities""")
def p26(spark, d):
    """Details of every kind with the id of their activity; ids made of text (SMS) are hashes and not shown."""
    stored_ids, parts = _table_ids(all_flat(spark, d)), []
    for kind in KINDS:
        title = F.col("call_title") if kind == "CALL" else F.lit(None).cast("string")
        details = FL.details_of(parsed(spark, d, kind), kind)
        parts.append(FL.attach_activity(details, stored_ids).select(
            _shown_id("activity_id"), F.lit(kind).alias("activity_type"), title.alias("call_title")))
    return TL.union_events(*parts)


@query("p24_status_flags", with_(ACTIVITIES) + """
select source_id, status = 'upcoming' as is_upcoming, status = 'overdue' as is_overdue,
       status = 'completed' as is_completed, status = 'due' as is_due
from activities""")
def p24(spark, d):
    return FL.status_flags(all_flat(spark, d).select("source_id", "status")).drop("status")


@query("p25_is_primary", """
select o_orderkey, o_orderstatus = 'F' as is_primary from orders""")
def p25(spark, d):
    label = F.when(F.col("o_orderstatus") == "F", F.lit("the PRIMARY one")).when(
        F.col("o_orderstatus") == "O", F.lit("Other"))
    return X.table(spark, d, "orders").select("o_orderkey", is_primary(label).alias("is_primary"))


def _status_query(kind):
    return with_(ACTIVITIES) + (
        f"select source_id, status from activities where activity_type = '{kind}'")


@query("d1_task_status", _status_query("TASK"))
def d1(spark, d):
    return flat(spark, d, "TASK").select("source_id", "status")


@query("d2_meeting_status", _status_query("MEETING"))
def d2(spark, d):
    return flat(spark, d, "MEETING").select("source_id", "status")


@query("d3_call_status", _status_query("CALL"))
def d3(spark, d):
    return flat(spark, d, "CALL").select("source_id", "status")


@query("d4_other_status", f"""
select event_id, case when event_type in ('click', 'error', 'view') then 'completed'
         when cast(ts as timestamp) > {NOW} then 'upcoming' else 'completed' end as status
from events""")
def d4(spark, d):
    kind = (F.when(F.col("event_type") == "click", "EMAIL").when(F.col("event_type") == "error", "NOTE")
            .when(F.col("event_type") == "view", "SMS").otherwise("OTHER"))
    return X.table(spark, d, "events").select(
        "event_id", S.other_status(kind, F.col("ts"), X.AS_OF).alias("status"))


def records(spark, d, kind):
    return FL.flatten_activity_records(parsed(spark, d, kind), kind, X.AS_OF)


def edges(spark, d):
    made = [records(spark, d, k).select("source_id", "associations", "seq") for k in KINDS]
    return E.activity_edges(TL.union_events(*made))


_EDGE = ("activity_source_id", "associated_object_type", "associated_object_id",
         "association_label", "association_type_id", "association_category")


@query("e1_activity_edges", with_(ACTIVITIES, ACTIVITY_EDGES) + "select * from activity_edges")
def e1(spark, d):
    return edges(spark, d).select(*_EDGE)


@query("a4_first_labelled_type", with_(ACTIVITIES) + """
select source_id, case when k < 10 then 'Main deal' else 'Later' end as label,
       case when k < 10 then 7 else 9 end as type_id, 'USER' as category
from activities where k < 20""")
def a4(spark, d):
    rows = E.filter_edges(edges(spark, d), "deal")
    return rows.select(F.col("activity_source_id").alias("source_id"),
                       F.col("association_label").alias("label"),
                       F.col("association_type_id").alias("type_id"),
                       F.col("association_category").alias("category"))


@query("f1_filter_edges", with_(ACTIVITIES, ACTIVITY_EDGES) + """
select activity_source_id, associated_object_id from activity_edges
where associated_object_type = 'company'""")
def f1(spark, d):
    return E.filter_edges(edges(spark, d), "company").select("activity_source_id",
                                                             "associated_object_id")


@query("f2_activity_type", with_(ACTIVITIES) + """
select source_id, case when k >= 95 then null else activity_type end as activity_type
from activities where k >= 95 or activity_type <> 'EMAIL'""")
def f2(spark, d):
    """All but e-mails; a missing type is not an e-mail."""
    rows = all_flat(spark, d).withColumn(
        "activity_type", F.when(F.col("activity_owner").cast("int") < 95, F.col("activity_type")))
    return FL.without_type(rows, "EMAIL").select("source_id", "activity_type")


@query("f6_ids_in", with_(ACTIVITIES, ACTIVITY_EDGES) + """
select * from activity_edges where activity_source_id in (
  select source_id from activities where activity_type = 'EMAIL')""")
def f6(spark, d):
    return E.ids_in(edges(spark, d).select(*_EDGE), flat(spark, d, "EMAIL"), "activity_source_id")


@query("j6_enrich_source", with_(CONTACTS, ACTIVITIES) + """
select a.source_id, c.full_name as source_object_name, c.email as source_object_email
from activities a left join contacts c
  on c.source_id = a.source_object_id and a.source_object_type = 'contacts'""")
def j6(spark, d):
    contacts = FL.flatten_contacts(L.parse_objects(X.contacts(spark, d), "contacts"))
    return R.enrich_source(all_flat(spark, d), contacts).select(
        "source_id", "source_object_name", "source_object_email")


@query("j8_attach_activity_id", with_(ACTIVITIES, ACTIVITY_EDGES) + """
select e.activity_source_id, e.associated_object_id, a.event_id as activity_id
from activity_edges e left join (select * from activities where activity_type <> 'NOTE') a
  on a.source_id = e.activity_source_id""")
def j8(spark, d):
    stored = _table_ids(all_flat(spark, d).filter("activity_type <> 'NOTE'"))
    return E.attach_activity_id(edges(spark, d), stored).select(
        "activity_source_id", "associated_object_id", _shown_id("activity_id"))


def staged(spark, d, kinds=KINDS):
    """The usable records of all types in one written table, each payload parsed once."""
    made = None
    for k in kinds:
        r = FL.split_valid(records(spark, d, k))[0]
        r = r.withColumn("edges", E.edge_array(F.col("associations"))).drop("associations")
        r = r.withColumnRenamed("detail", f"detail_{k}")
        made = r if made is None else made.unionByName(r, allowMissingColumns=True)
    return kept(spark, made)


def stored(spark, d, kinds=KINDS):
    """Activities, details and edges as they stand in the tables after a load."""
    owners = R.owners_dim(L.owner_rows(X.owner_pages(spark, d)))
    made = staged(spark, d, kinds)
    rows = made.drop("edges", *[f"detail_{k}" for k in kinds])
    rows = R.resolve_owner(rows, "activity_owner", owners, X.owner_overrides(spark, d))
    activities = to_table(FL.with_etl_date(rows, X.AS_OF), "activities")
    details = {}
    for kind in kinds:
        own = made.filter(F.col("activity_type") == kind).select(
            f"detail_{kind}.*", surrogate_id(["source_id"]).alias("activity_id"))
        details[kind] = to_table(FL.with_etl_date(own, X.AS_OF), DETAIL_TABLES[kind])
    return activities, details, E.activity_edges(made.select("source_id", "edges", "seq"))


def of_contacts(spark, d, kinds=KINDS):
    activities, details, links = stored(spark, d, kinds)
    return TL.activities_of_contacts(TL.with_event_details(activities, details), links)


@query("j9_with_details", with_(ACTIVITIES) + f"""
select source_id, case when activity_type = 'CALL' then subject end as call_title,
       case when activity_type = 'TASK' and value > 60 then 'TODO' end as task_type,
       case when activity_type = 'MEETING' and k < 50 then 'Room ' || k end as meeting_location,
       case when activity_type = 'EMAIL' then cast(k // 10 as varchar) end as clicks,
       case when activity_type = 'NOTE' then {ts('ts')} end as note_created,
       case when activity_type = 'SMS' then activity_owner end as sms_assigned_to
from activities""")
def j9(spark, d):
    activities, details, _ = stored(spark, d)
    return TL.with_details(activities, details).select(
        "source_id", F.col("call.call_title").alias("call_title"),
        F.col("task.task_type").alias("task_type"),
        F.col("meeting.meeting_location").alias("meeting_location"),
        F.col("email.number_of_email_clicks").alias("clicks"),
        F.col("note.created_date").alias("note_created"),
        F.col("sms.activity_assigned_to").alias("sms_assigned_to"))


@query("j10_contact_activities", with_(ACTIVITIES) + """
select source_id, activity_type, cast(user_id as varchar) as contact_id from activities
where k < 80""")
def j10(spark, d):
    return TL.contact_activities(all_flat(spark, d), edges(spark, d)).select(
        "source_id", "activity_type", "contact_id")


@query("j11_source_fallback", with_(ACTIVITIES) + """
select source_id, cast(user_id as varchar) as contact_id from activities
where k < 80 and activity_type <> 'EMAIL'""")
def j11(spark, d):
    """Only the e-mails have contact edges, so the others fall back to their source object."""
    links = E.activity_edges(records(spark, d, "EMAIL"))
    return TL.source_fallback(all_flat(spark, d), links).select("source_id", "contact_id")


# Expected timeline rows, one CTE per family.
_BY = "coalesce(' by ' || owner, '')"
_SUBJECT = "coalesce(': ' || subject, '')"
_TIMELINE_HEAD = with_(OWNERS, ACTIVITIES) + f""", a as (
  select x.*, {owned('activity_owner')} as owner, cast(user_id as varchar) as contact,
         {_EMAIL_DETAIL.replace('as status', 'as email_status')},
         {_MEETING_DETAIL}, {_TASK_DETAIL},
         case when value < 20 then 'SCHEDULED' when value < 200 then 'COMPLETED' end as call_status,
         case when value < 100 then 'INBOUND' else 'OUTBOUND' end as direction
  from activities x left join owner_names o on o.key = x.activity_owner where k < 80)"""


def _pairs(*parts: tuple[str, str]) -> str:
    """JSON object of the given parts that are not null; null when none is left."""
    listed = ", ".join(f"""'"{key}":"' || ({value}) || '"'""" for key, value in parts)
    joined = f"concat_ws(',', {listed})"
    return f"case when {joined} <> '' then '{{' || {joined} || '}}' end"


def _row(kind: str, text: str, related: str, metadata: str, where: str, actor: str = "owner") -> str:
    return f"""select contact as contact_source_id, {kind} as event_type,
  {ts('activity_date')} as event_date, {text} as description, '{related}' as related_object_type,
  source_id as related_object_id, subject as related_object_name, {actor} as actor_id,
  {actor} as actor_name, {metadata} as metadata from a where {where}"""


_NONE = "cast(null as varchar)"
_START = "strftime(start_time, '%Y-%m-%d %H:%M')"


def _iso(c: str) -> str:
    text = f"strftime({c}, '%Y-%m-%dT%H:%M:%S.%f')"
    return f"regexp_replace({text}, '\\.?0+$', '')"


_FAMILIES = {
    "received": _row("'email_received'", f"'Email received from contact' || {_SUBJECT} || {_BY}",
                     "email", _pairs(("direction", "email_direction"), ("status", "email_status")),
                     "activity_type = 'EMAIL' and k < 30"),
    "sent": _row("'email_sent'", f"'Email sent to contact' || {_SUBJECT} || {_BY}", "email",
                 _pairs(("direction", "email_direction"), ("status", "email_status")),
                 "activity_type = 'EMAIL' and k >= 30"),
    "opened": _row(
        "'email_opened'", f"""'Email opened ' || k || ' time(s)' || {_SUBJECT}
          || coalesce(' (Open rate: ' || email_open_rate || ')', '')""", "email",
        """'{"openCount":' || k || ',"openRate":"' || coalesce(email_open_rate, '') || '"}'""",
        "activity_type = 'EMAIL' and k between 1 and 49", _NONE),
    "clicked": _row(
        "'email_clicked'", f"""'Email clicked ' || k // 10 || ' time(s)' || {_SUBJECT}
          || coalesce(' (Click rate: ' || email_click_rate || ')', '')""", "email",
        """'{"clickCount":' || k // 10 || ',"clickRate":"' || coalesce(email_click_rate, '') || '"}'""",
        "activity_type = 'EMAIL' and k >= 10", _NONE),
    "call": _row(
        "'call_created'", f"""'Call' || {_SUBJECT} || ' (' || direction || ')'
          || coalesce(' - Status: ' || call_status, '') || {_BY}""", "call",
        _pairs(("direction", "direction"), ("status", "call_status"), ("callDirection", "direction")),
        "activity_type = 'CALL'"),
    "meeting": _row(
        "'meeting_created'", f"""'Meeting' || {_SUBJECT} || ' - Status: ' || status
          || coalesce(' (Start: ' || {_START} || ')', '')
          || coalesce(' - Location: ' || meeting_location, '') || {_BY}""", "meeting",
        _pairs(("startTime", _iso("start_time")), ("endTime", _iso("end_time")),
               ("location", "meeting_location"), ("status", "status")),
        "activity_type = 'MEETING'"),
    "task": _row(
        "'task_created'", f"""'Task' || {_SUBJECT} || coalesce(' (Type: ' || task_type || ')', '')
          || coalesce(' - Status: ' || task_status, '')
          || coalesce(' - Priority: ' || priority, '') || {_BY}""", "task",
        _pairs(("taskType", "task_type"), ("status", "task_status"), ("priority", "priority"),
               ("activityStatus", "status")), "activity_type = 'TASK'"),
    "note": _row(
        "'note_created'", f"""'Note' || ': ' || case when length(body) > 100
          then substr(body, 1, 100) || '...' else body end || {_BY}""", "note",
        _pairs(("status", "status")), "activity_type = 'NOTE'"),
    "sms": _row("'sms_created'", f"'SMS activity' || {_SUBJECT} || {_BY}", "sms", _pairs(("status", "status")),
                "activity_type = 'SMS'"),
}


def _family(*names: str) -> str:
    return _TIMELINE_HEAD + "\n" + "\nunion all\n".join(_FAMILIES[n] for n in names)


@query("t1_email_received", _family("received"))
def t1(spark, d):
    events = TL.email_events(of_contacts(spark, d, ("EMAIL",)), X.AS_OF)
    return events.filter("event_type = 'email_received'")


@query("t2_email_sent", _family("sent"))
def t2(spark, d):
    events = TL.email_events(of_contacts(spark, d, ("EMAIL",)), X.AS_OF)
    return events.filter("event_type = 'email_sent'")


@query("t3_email_opened", _family("opened"))
def t3(spark, d):
    return TL.open_events(of_contacts(spark, d, ("EMAIL",)), X.AS_OF)


@query("t4_email_clicked", _family("clicked"))
def t4(spark, d):
    return TL.click_events(of_contacts(spark, d, ("EMAIL",)), X.AS_OF)


@query("t9_call_created", _family("call"))
def t9(spark, d):
    return TL.call_events(of_contacts(spark, d, ("CALL",)), X.AS_OF)


@query("t10_meeting_created", _family("meeting"))
def t10(spark, d):
    return TL.meeting_events(of_contacts(spark, d, ("MEETING",)), X.AS_OF)


@query("t11_task_created", _family("task"))
def t11(spark, d):
    return TL.task_events(of_contacts(spark, d, ("TASK",)), X.AS_OF)


@query("t12_note_created", _family("note"))
def t12(spark, d):
    return TL.note_events(of_contacts(spark, d, ("NOTE",)), X.AS_OF)


@query("t13_other_created", f"""
select cast(conv_id as varchar) as contact_source_id, 'sms_created' as event_type,
       '2024-01-06 00:00:00.000000' as event_date,
       'SMS activity' || case when turn > 0 then ': Turn ' || turn else '' end || ' by ' || turn
         as description, 'sms' as related_object_type, conv_id || '-' || turn as related_object_id,
       case when turn > 0 then 'Turn ' || turn end as related_object_name,
       cast(turn as varchar) as actor_id, cast(turn as varchar) as actor_name,
       '{{"status":"completed"}}' as metadata
from conversations""".replace("{{", "{").replace("}}", "}"))
def t13(spark, d):
    activities = flat(spark, d, "SMS")
    links = E.activity_edges(records(spark, d, "SMS"))
    return TL.other_events(TL.activities_of_contacts(activities, links), X.AS_OF)


ALL_FAMILIES = _family("received", "sent", "opened", "clicked", "call", "meeting", "task", "note", "sms")


@query("activity_events_in_one_pass", ALL_FAMILIES)
def one_pass(spark, d):
    return TL.activity_events(of_contacts(spark, d), X.AS_OF)


