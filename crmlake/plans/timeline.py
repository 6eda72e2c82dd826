"""The contact timeline: thirteen kinds of event, one table.

Activities meet their contacts once. Every event of an activity is then written out of that one
row, so the join is not repeated per kind of event.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from crmlake.functions.text import not_empty, suffix
from crmlake.functions.values import to_whole

from crmlake.operators.edges import filter_edges
from crmlake.operators.history import filter_history
from crmlake.model.tables import KEYS
from crmlake.operators.merge import upsert_timeline
from crmlake.operators.ordered import keep_last

# E-mail directions that mean "from the contact".
RECEIVED = ("INCOMING", "RECEIVED", "INBOUND", "IN")

# Detail columns the event texts use, per activity type.
_USED = {
    "EMAIL": ("email_direction", "status", "number_of_email_opens", "email_open_rate",
              "number_of_email_clicks", "email_click_rate"),
    "CALL": ("call_title", "call_direction", "status", "direction"),
    "MEETING": ("meeting_name", "start_time", "end_time", "meeting_location", "location_type"),
    "TASK": ("task_type", "status", "priority"),
}


def with_details(activities: DataFrame, details: dict[str, DataFrame]) -> DataFrame:
    """Activities with one struct column per kind of detail, null where there is no such row.

    ``details`` maps an activity type to its detail table. All joins are on the surrogate id, so
    the activities are shuffled once for all six.
    """
    for kind, table in details.items():
        rest = [c for c in table.columns if c not in ("id", "activity_id", "etl_date")]
        side = table.select(F.col("activity_id").alias("_activity"),
                            F.struct(*rest).alias(kind.lower()))
        activities = activities.join(side, F.col("id") == F.col("_activity"), "left").drop(
            "_activity")
    return activities


def with_event_details(activities: DataFrame, details: dict[str, DataFrame]) -> DataFrame:
    """As :func:`with_details` for the timeline: only the columns its texts use, in one join.

    An activity's own type decides which detail counts, so the details of all types can be
    stacked and joined on (activity id, type).
    """
    stacked = None
    for kind, used in _USED.items():
        if kind not in details:
            continue
        own = details[kind].select(
            F.col("activity_id").alias("_activity"), F.lit(kind).alias("_kind"),
            F.struct(*used).alias(kind.lower()))
        stacked = own if stacked is None else stacked.unionByName(own, allowMissingColumns=True)
    if stacked is None:
        return activities
    return activities.join(
        stacked, (F.col("id") == F.col("_activity")) & (F.upper("activity_type") == F.col("_kind")),
        "left").drop("_activity", "_kind")


def _linked(edges: DataFrame) -> DataFrame:
    return filter_edges(edges, "contact").select(
        F.lower("activity_source_id").alias("_key"),
        F.col("associated_object_id").alias("contact_id"))


def contact_activities(activities: DataFrame, edges: DataFrame) -> DataFrame:
    """Activities with the contacts they have an edge to: adds ``contact_id``. Ids ignore case."""
    return activities.join(_linked(edges), F.lower("source_id") == F.col("_key")).drop("_key")


def _is_contact_source() -> Column:
    return (F.lower("source_object_type").isin("contact", "contacts")
            & not_empty("source_object_id"))


def source_fallback(activities: DataFrame, edges: DataFrame) -> DataFrame:
    """Activities without a contact edge whose source object is a contact: adds ``contact_id``."""
    # each linked activity once: repeats are dropped before they are shuffled
    linked = _linked(edges).select("_key").distinct()
    alone = activities.filter(_is_contact_source()).join(
        linked, F.lower("source_id") == F.col("_key"), "left_anti")
    return alone.withColumn("contact_id", F.col("source_object_id"))


def activities_of_contacts(activities: DataFrame, edges: DataFrame) -> DataFrame:
    """:func:`contact_activities` and :func:`source_fallback` together.

    The fallback pairs are found on three narrow columns; the wide rows are joined once, and by an
    inner join, in which adaptive execution can split an activity with very many edges.
    """
    narrow = activities.select("source_id", "source_object_type", "source_object_id")
    pairs = _linked(edges).unionByName(source_fallback(narrow, edges).select(
        F.lower("source_id").alias("_key"), "contact_id"))
    return activities.join(pairs, F.lower("source_id") == F.col("_key")).drop("_key")


def _ticket_pairs(edges: DataFrame) -> DataFrame:
    """Tickets (``_key``) and contacts with an edge in either direction."""
    forward = (F.col("source_object_type") == "ticket") & (F.col("target_object_type") == "contact")
    backward = (F.col("source_object_type") == "contact") & (F.col("target_object_type") == "ticket")
    # one list for both directions, so a pair landed both ways counts once
    return edges.filter(forward | backward).select(
        F.lower(F.when(forward, F.col("source_object_id")).otherwise(F.col("target_object_id")))
        .alias("_key"),
        F.when(forward, F.col("target_object_id")).otherwise(F.col("source_object_id"))
        .alias("contact_id")).distinct()


def ticket_contacts(tickets: DataFrame, edges: DataFrame) -> DataFrame:
    """Tickets with their contacts, from ticket-contact edges in either direction."""
    return tickets.join(_ticket_pairs(edges), F.lower("source_id") == F.col("_key")).drop("_key")


def ticket_history(contacts_of_tickets: DataFrame, history: DataFrame) -> DataFrame:
    """(Tickets with contacts) with each of the ticket's stage changes."""
    stages = filter_history(history, "ticket", "hs_pipeline_stage").select(
        F.lower("object_id").alias("_ticket"), "old_value", "new_value", "change_date")
    return contacts_of_tickets.join(stages, F.lower("source_id") == F.col("_ticket")).drop("_ticket")


_FIELDS = ("contact_source_id", "event_type", "event_date", "description", "related_object_type",
           "related_object_id", "related_object_name", "actor_id", "actor_name", "metadata")


def _event(kind: Column, date: Column, text: Column, related: Column, name: Column,
           actor: Column | None, metadata: Column | None, contact: Column | None = None) -> Column:
    none = F.lit(None).cast("string")
    actor = none if actor is None else actor
    values = (F.col("contact_id") if contact is None else contact, kind, date, text, related,
              F.col("source_id"), name, actor, actor, none if metadata is None else metadata)
    return F.struct(*[v.alias(f) for v, f in zip(values, _FIELDS)])


def _metadata(**parts: Column) -> Column:
    """JSON object of the non-empty parts; null where all are empty."""
    kept = [F.when(not_empty(v), v).alias(k) for k, v in parts.items()]
    return F.nullif(F.to_json(F.struct(*kept)), F.lit("{}"))


def _iso(c: Column) -> Column:
    """ISO date and time, with fractions of a second only where there are any."""
    return F.regexp_replace(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), r"\.?0+$", "")


def _date(as_of) -> Column:
    return F.coalesce("activity_date", F.lit(as_of).cast("timestamp"))


def _subject() -> Column:
    return suffix(": ", "subject")


def _by_owner() -> Column:
    return suffix(" by ", "activity_owner")


def _owner() -> Column:
    return F.col("activity_owner")


def _email(as_of) -> Column:
    received = F.coalesce(F.upper("email.email_direction").isin(*RECEIVED), F.lit(False))
    text = F.concat(F.when(received, "Email received from contact").otherwise("Email sent to contact"),
                    _subject(), _by_owner())
    return _event(F.when(received, "email_received").otherwise("email_sent"), _date(as_of), text,
                  F.lit("email"), F.col("subject"), _owner(),
                  _metadata(direction=F.col("email.email_direction"), status=F.col("email.status")))


def _tracked(as_of, verb: str, count: str, rate: str, label: str, keys: tuple[str, str]) -> Column:
    number = to_whole(F.col(f"email.{count}"))
    text = F.concat(F.lit(f"Email {verb} "), number.cast("string"), F.lit(" time(s)"), _subject(),
                    suffix(f" ({label}: ", F.col(f"email.{rate}"), ")"))
    metadata = F.to_json(F.struct(number.alias(keys[0]),
                                  F.coalesce(F.col(f"email.{rate}"), F.lit("")).alias(keys[1])))
    event = _event(F.lit(f"email_{verb}"), _date(as_of), text, F.lit("email"), F.col("subject"),
                   None, metadata)
    return F.when(number > 0, event)


def _opened(as_of) -> Column:
    return _tracked(as_of, "opened", "number_of_email_opens", "email_open_rate", "Open rate",
                    ("openCount", "openRate"))


def _clicked(as_of) -> Column:
    return _tracked(as_of, "clicked", "number_of_email_clicks", "email_click_rate", "Click rate",
                    ("clickCount", "clickRate"))


def _titled(word: str, title: Column) -> Column:
    return F.concat(F.lit(word), F.when(not_empty(title), F.concat(F.lit(": "), title)).otherwise(
        _subject()))


def _call(as_of) -> Column:
    d = F.col("call")
    text = F.concat(_titled("Call", d["call_title"]), suffix(" (", d["call_direction"], ")"),
                    suffix(" - Status: ", d["status"]), _by_owner())
    return _event(F.lit("call_created"), _date(as_of), text, F.lit("call"),
                  F.coalesce(F.col("subject"), d["call_title"]), _owner(),
                  _metadata(direction=d["direction"], status=d["status"],
                            callDirection=d["call_direction"]))


def _meeting(as_of) -> Column:
    d = F.col("meeting")
    start = F.date_format(d["start_time"], "yyyy-MM-dd HH:mm")
    text = F.concat(_titled("Meeting", d["meeting_name"]), suffix(" - Status: ", "status"),
                    suffix(" (Start: ", start, ")"), suffix(" - Location: ", d["meeting_location"]),
                    _by_owner())
    return _event(F.lit("meeting_created"), _date(as_of), text, F.lit("meeting"),
                  F.coalesce(F.col("subject"), d["meeting_name"]), _owner(),
                  _metadata(startTime=_iso(d["start_time"]), endTime=_iso(d["end_time"]),
                            locationType=d["location_type"], location=d["meeting_location"],
                            status=F.col("status")))


def _task(as_of) -> Column:
    d = F.col("task")
    text = F.concat(F.lit("Task"), _subject(), suffix(" (Type: ", d["task_type"], ")"),
                    suffix(" - Status: ", d["status"]), suffix(" - Priority: ", d["priority"]),
                    _by_owner())
    return _event(F.lit("task_created"), _date(as_of), text, F.lit("task"), F.col("subject"),
                  _owner(), _metadata(taskType=d["task_type"], status=d["status"],
                                      priority=d["priority"], activityStatus=F.col("status")))


def _note(as_of) -> Column:
    preview = F.when(F.length("body") > 100, F.concat(F.substring("body", 1, 100), F.lit("..."))
                     ).otherwise(F.col("body"))
    text = F.concat(F.lit("Note"),
                    F.when(not_empty("subject"), _subject()).otherwise(suffix(": ", preview)),
                    _by_owner())
    return _event(F.lit("note_created"), _date(as_of), text, F.lit("note"), F.col("subject"),
                  _owner(), _metadata(status=F.col("status")))


def _other(as_of) -> Column:
    kind = F.coalesce(F.lower("activity_type"), F.lit("activity"))
    text = F.concat(F.coalesce("activity_type", F.lit("")), F.lit(" activity"), _subject(),
                    _by_owner())
    return _event(F.concat(kind, F.lit("_created")), _date(as_of), text, kind, F.col("subject"),
                  _owner(), _metadata(status=F.col("status")))


_TYPE = "activity_type"


def _is(kind: str) -> Column:
    return F.upper(_TYPE).eqNullSafe(kind)


def _events(acts: DataFrame, *events: Column) -> DataFrame:
    found = F.filter(F.array(*events), lambda e: e.isNotNull())
    return acts.select(F.inline(found))


def _with_missing(acts: DataFrame, *kinds: str) -> DataFrame:
    """Details that were not joined count as absent."""
    for kind in kinds:
        if kind.lower() not in acts.columns:
            date = ("start_time", "end_time")
            fields = ",".join(f"{c}:{'timestamp' if c in date else 'string'}" for c in _USED[kind])
            acts = acts.withColumn(kind.lower(), F.lit(None).cast(f"struct<{fields}>"))
    return acts


def email_events(acts: DataFrame, as_of) -> DataFrame:
    """email_received or email_sent, one per e-mail and contact."""
    return _events(_with_missing(acts.filter(_is("EMAIL")), "EMAIL"), _email(as_of))


def open_events(acts: DataFrame, as_of) -> DataFrame:
    return _events(_with_missing(acts.filter(_is("EMAIL")), "EMAIL"), _opened(as_of))


def click_events(acts: DataFrame, as_of) -> DataFrame:
    return _events(_with_missing(acts.filter(_is("EMAIL")), "EMAIL"), _clicked(as_of))


def call_events(acts: DataFrame, as_of) -> DataFrame:
    return _events(_with_missing(acts.filter(_is("CALL")), "CALL"), _call(as_of))


def meeting_events(acts: DataFrame, as_of) -> DataFrame:
    return _events(_with_missing(acts.filter(_is("MEETING")), "MEETING"), _meeting(as_of))


def task_events(acts: DataFrame, as_of) -> DataFrame:
    return _events(_with_missing(acts.filter(_is("TASK")), "TASK"), _task(as_of))


def note_events(acts: DataFrame, as_of) -> DataFrame:
    return _events(acts.filter(_is("NOTE")), _note(as_of))


def _is_other() -> Column:
    return ~F.coalesce(F.upper(_TYPE).isin("EMAIL", "CALL", "MEETING", "TASK", "NOTE"), F.lit(False))


def other_events(acts: DataFrame, as_of) -> DataFrame:
    return _events(acts.filter(_is_other()), _other(as_of))


def activity_events(acts: DataFrame, as_of) -> DataFrame:
    """All events of activities with their contacts (T1-T4 and T9-T13) in one pass."""
    acts = _with_missing(acts, *_USED)
    email = _is("EMAIL")
    main = (F.when(email, _email(as_of)).when(_is("CALL"), _call(as_of))
            .when(_is("MEETING"), _meeting(as_of)).when(_is("TASK"), _task(as_of))
            .when(_is("NOTE"), _note(as_of)).otherwise(_other(as_of)))
    return _events(acts, main, F.when(email, _opened(as_of)), F.when(email, _clicked(as_of)))


def ticket_created(contacts_of_tickets: DataFrame) -> DataFrame:
    text = F.concat(F.lit("Ticket created"), suffix(": ", "ticket_name"),
                    suffix(" (Status: ", "ticket_status", ")"),
                    suffix(" - Assigned to ", "ticket_owner"))
    return _events(contacts_of_tickets, _event(
        F.lit("ticket_created"), F.coalesce("created_at", "etl_date"), text, F.lit("ticket"),
        F.col("ticket_name"), F.col("ticket_owner"), None))


def _from_to() -> list[Column]:
    return [suffix(" from ", "old_value"), suffix(" to ", "new_value")]


def _change_metadata(old: str, new: str) -> Column:
    return F.to_json(F.struct(F.coalesce("old_value", F.lit("")).alias(old),
                              F.coalesce("new_value", F.lit("")).alias(new)))


def ticket_changes(contacts_of_tickets: DataFrame, history: DataFrame) -> DataFrame:
    """One event per ticket, contact and stage change."""
    rows = ticket_history(contacts_of_tickets, history)
    text = F.concat(F.lit("Ticket status changed"), *_from_to(), suffix(": ", "ticket_name"))
    return _events(rows, _event(
        F.lit("ticket_status_changed"), F.col("change_date"), text, F.lit("ticket"),
        F.col("ticket_name"), None, _change_metadata("oldStatus", "newStatus")))


def each_once(events: DataFrame) -> DataFrame:
    """One event per key of the timeline, the one that a merge of all of them takes."""
    return keep_last(events, list(KEYS["contact_activity_timelines"]), [])


def ticket_events(tickets: DataFrame, edges: DataFrame, history: DataFrame, once: bool = False) -> DataFrame:
    """:func:`ticket_created` and :func:`ticket_changes` together.

    What an event says depends on the ticket alone, so events are made once per ticket and meet its contacts in
    one join: the pairs are read and shuffled once, and the history meets tickets, not tickets with contacts.

    ``once`` gives one event per key of the timeline. Pairs do not repeat, so events that do not repeat for a
    ticket do not repeat for its contacts: the few of a ticket are shuffled for it, not those of all pairs.
    """
    keyed = tickets.withColumn("contact_id", F.lower("source_id"))  # stands for the contacts until they are met
    events = ticket_created(keyed).unionByName(ticket_changes(keyed, history))
    if once:
        events = each_once(events)
    met = events.join(_ticket_pairs(edges), F.col("contact_source_id") == F.col("_key"))
    return met.withColumn("contact_source_id", F.col("contact_id")).select(*_FIELDS)


# Contact properties with change events.
CHANGE_EVENTS = {
    "lifecyclestage": ("lifecycle_changed", "Lifecycle stage changed"),
    "hs_lead_status": ("lead_status_changed", "Lead status changed"),
}


def change_events(history: DataFrame, property_name: str) -> DataFrame:
    """Changes of one contact property; the actor is the source of the change."""
    event_type, words = CHANGE_EVENTS[property_name]
    none = F.lit(None).cast("string")
    return filter_history(history, "contact", property_name).select(
        F.col("object_id").alias("contact_source_id"), F.lit(event_type).alias("event_type"),
        F.col("change_date").alias("event_date"),
        F.concat(F.lit(words), *_from_to()).alias("description"),
        F.lit("contact").alias("related_object_type"),
        F.col("object_id").alias("related_object_id"), none.alias("related_object_name"),
        F.col("source").alias("actor_id"), none.alias("actor_name"),
        _change_metadata("oldValue", "newValue").alias("metadata"))


def union_events(*families: DataFrame) -> DataFrame:
    first, *rest = families
    for family in rest:
        first = first.unionByName(family)
    return first


def build_events(activities: DataFrame, details: dict[str, DataFrame], activity_edges: DataFrame,
                 tickets: DataFrame, object_edges: DataFrame, history: DataFrame, as_of, apart: bool = True,
                 once: bool = False) -> dict:
    """The event families, by name, so that each can fail alone. Not ``apart``, those of tickets share their joins
    and come ``once`` per key."""
    detailed = with_event_details(activities, details)
    acts = activities_of_contacts(detailed, activity_edges)
    linked = ticket_contacts(tickets, object_edges)
    of_tickets = {"tickets": ticket_created(linked), "ticket changes": ticket_changes(linked, history)} if apart else {
        "tickets": ticket_events(tickets, object_edges, history, once)}
    return {
        "activities": activity_events(acts, as_of),
        **of_tickets,
        "lifecycle": change_events(history, "lifecyclestage"),
        "lead status": change_events(history, "hs_lead_status"),
    }


def only_changed(activities: DataFrame, details: dict[str, DataFrame], activity_edges: DataFrame, tickets: DataFrame,
                 object_edges: DataFrame, history: DataFrame, as_of, kept) -> tuple:
    """The tables of :func:`build_events`, cut to what can make another event than before.

    A run stamps the rows it inserts or updates with ``as_of``. From these, keys go back along the joins
    of the events: to an activity from itself, its details and its edges; to a ticket from itself, its
    contacts and its stage changes. A change of a contact makes its own event. The keys are collected from
    narrow columns and given to ``kept`` (keys, name), which may stage and count them; the wide rows then meet
    them in a semi join, before they are shuffled or parsed into events.
    """
    def fresh(df: DataFrame) -> DataFrame:
        return df.filter(F.col("etl_date") == F.lit(as_of).cast("timestamp"))

    known = activities.select("id", F.lower("source_id").alias("key"))
    linked = fresh(activity_edges).select(F.lower("activity_source_id").alias("key")).distinct()
    ids = fresh(activities).select("id").unionByName(known.join(linked, "key", "left_semi").select("id"))
    for rows in details.values():
        ids = ids.unionByName(fresh(rows).select(F.col("activity_id").alias("id")))
    ids = kept(ids.distinct(), "changed-activities")
    activities = activities.join(ids, "id", "left_semi")
    details = {kind: rows.join(ids.select(F.col("id").alias("activity_id")), "activity_id", "left_semi")
               for kind, rows in details.items()}

    def ticket_side(rows: DataFrame) -> DataFrame:
        ends = [F.when(F.col(f"{end}_object_type") == "ticket", F.lower(f"{end}_object_id")) for end in ("source", "target")]
        return rows.select(F.explode(F.array(*ends)).alias("key")).filter("key is not null")

    stages = filter_history(fresh(history), "ticket", "hs_pipeline_stage")
    keys = (fresh(tickets).select(F.lower("source_id").alias("key")).unionByName(ticket_side(fresh(object_edges)))
            .unionByName(stages.select(F.lower("object_id").alias("key"))).distinct())
    keys = kept(keys, "changed-tickets")
    tickets = tickets.join(keys, F.lower("source_id") == F.col("key"), "left_semi")
    is_contact = F.col("object_type") == "contact"
    of_tickets = history.filter(~is_contact).join(keys, F.lower("object_id") == F.col("key"), "left_semi")
    history = fresh(history).filter(is_contact).unionByName(of_tickets)
    return activities, details, activity_edges, tickets, object_edges, history


def tickets_stand_apart(activities: DataFrame) -> bool:
    """Whether no activity can have an event of the kinds that tickets have: there is none of the type ``ticket``.

    The type is a partition column of the stored table and a literal of landed records, so this reads no rows.
    """
    return activities.filter(F.lower(_TYPE) == "ticket").isEmpty()


def events_once(families: dict[str, DataFrame], placed=lambda rows: rows) -> DataFrame:
    """Union of the families, one event per key. The events of tickets are unique by themselves and stand apart;
    ``placed`` is given the others."""
    others = union_events(*[events for name, events in families.items() if name != "tickets"])
    return placed(each_once(others)).unionByName(families["tickets"])


def timeline(families, base: DataFrame, as_of, **options) -> DataFrame:
    """Union of the families, merged into the stored timeline."""
    values = families.values() if isinstance(families, dict) else families
    return upsert_timeline(base, union_events(*values), as_of, **options)
