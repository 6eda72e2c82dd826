"""Parsed objects to typed rows, with the rows that cannot be used set aside.

Input is what :func:`crmlake.sources.landed.parse_objects` yields. All of it is one narrow
projection per object type: no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from crmlake.functions import status as rules
from crmlake.functions.associations import first_contact, source_object
from crmlake.functions.text import full_name, not_empty
from crmlake.functions.values import misfit, read, to_stamp
from crmlake.model.objects import (
    ACTIVITIES, ACTIVITY_SOURCES, ACTIVITY_TYPES, DETAILS, OBJECTS, STATUS_PROPERTIES, From,
    read_properties)
from crmlake.model.tables import columns

_WITH_CONTACT = ("communications", "emails")


def _texts(object_type: str) -> dict[str, Column]:
    return {name: F.col(f"properties.`{name}`") for name in read_properties(object_type)}


def reject_reason(specs: list[dict[str, From]], also: tuple = ()) -> Column:
    """Why a row cannot be used, or null. Checks id, properties and the type of each property."""
    sources = {source for spec in specs for source in spec.values()}
    checks = [f"WHEN {misfit(source)} THEN 'wrong type: {', '.join(source.names)}'"
              for source in sorted(sources, key=lambda s: (s.names, s.kind))]
    checks += [f"WHEN array_contains(misfits, '{name}') THEN 'wrong type: {name}'"
               for name in (*also, "hs_object_id")]
    # rows without any misfit, nearly all, skip the checks
    return (F.when(~not_empty("id"), "missing id")
            .when(F.col("properties").isNull(), "missing properties")
            .when(F.size("misfits") > 0, F.expr(f"CASE {' '.join(checks)} END")))


def flatten_all(df: DataFrame, object_type: str) -> DataFrame:
    """Every object as a typed row plus ``reject_reason``, ``raw`` and ``seq``."""
    spec = dict(OBJECTS[object_type])
    texts = _texts(object_type)
    also = ("firstname", "lastname") if object_type == "contacts" else ()
    typed = {name: read(source) for name, source in spec.items()}
    typed["source_id"] = F.col("id")
    typed["record_id"] = F.coalesce(texts["hs_object_id"], F.col("id"))
    if object_type == "contacts":
        typed["full_name"] = full_name(texts["firstname"], texts["lastname"])
    if object_type in _WITH_CONTACT:
        typed["associated_contact_id"] = first_contact(F.col("associations"))
        typed["associated_contact_name"] = F.lit(None).cast("string")
        typed["associated_contact_email"] = F.lit(None).cast("string")
    ordered = [typed[c].alias(c) for c in columns(object_type) if c in typed]
    return df.select(*ordered, reject_reason([spec], also).alias("reject_reason"),
                     "raw", "seq")


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable rows, rejected rows). Rejected rows keep the raw payload and the reason."""
    ok = df.filter(F.col("reject_reason").isNull()).drop("reject_reason", "raw")
    keep = [c for c in ("source_id", "raw", "seq", "reject_reason") if c in df.columns]
    return ok, df.filter(F.col("reject_reason").isNotNull()).select(*keep)


def _usable(df: DataFrame, object_type: str) -> DataFrame:
    return split_valid(flatten_all(df, object_type))[0]


def flatten_contacts(df: DataFrame) -> DataFrame:
    return _usable(df, "contacts")


def flatten_companies(df: DataFrame) -> DataFrame:
    return _usable(df, "companies")


def flatten_deals(df: DataFrame) -> DataFrame:
    return _usable(df, "deals")


def flatten_tickets(df: DataFrame) -> DataFrame:
    return _usable(df, "tickets")


def flatten_communications(df: DataFrame) -> DataFrame:
    return _usable(df, "communications")


def flatten_emails(df: DataFrame) -> DataFrame:
    return _usable(df, "emails")


def flatten_notes(df: DataFrame) -> DataFrame:
    return _usable(df, "notes")


def _status(activity_type: str, texts: dict[str, Column], activity_date: Column, as_of) -> Column:
    if activity_type == "TASK":
        return rules.task_status(
            texts["hs_task_status"], to_stamp(texts["hs_task_completion_timestamp"]),
            texts["hs_task_is_overdue"], to_stamp(texts["hs_task_due_date"]),
            to_stamp(texts["hs_task_start_date"]), activity_date, as_of)
    if activity_type == "MEETING":
        return rules.meeting_status(to_stamp(texts["hs_meeting_start_time"]), activity_date, as_of)
    if activity_type == "CALL":
        return rules.call_status(texts["hs_call_status"], activity_date, as_of)
    return rules.other_status(F.lit(activity_type), activity_date, as_of)


def flatten_activity_records(df: DataFrame, activity_type: str, as_of) -> DataFrame:
    """Activity rows with their detail as a struct and their associations, parsed once.

    Activities, details and edges all start from this, so a load reads each payload one time.
    """
    if activity_type not in ACTIVITY_TYPES:
        raise ValueError(f"unsupported activity type: {activity_type}")
    object_type = ACTIVITY_SOURCES[activity_type]
    texts = _texts(object_type)
    spec, detail = ACTIVITIES[activity_type], DETAILS[activity_type]
    typed = {name: read(source) for name, source in spec.items()}
    typed.setdefault("subject", F.lit(None).cast("string"))
    fields = [read(s).alias(name) for name, s in detail.items()]
    # the parts used more than once are computed in a projection of their own
    dated = df.withColumns({"activity_date": typed["activity_date"],
                            "_source": source_object()})
    return dated.select(
        F.col("id").alias("source_id"),
        F.coalesce(texts["hs_object_id"], F.col("id")).alias("record_id"),
        F.lit(activity_type).alias("activity_type"),
        typed["subject"].alias("subject"), typed["body"].alias("body"),
        typed["activity_owner"].alias("activity_owner"),
        F.col("_source.type").alias("source_object_type"),
        F.col("_source.id").alias("source_object_id"),
        F.lit(None).cast("string").alias("source_object_name"),
        F.lit(None).cast("string").alias("source_object_email"), "activity_date",
        _status(activity_type, texts, F.col("activity_date"), as_of).alias("status"),
        F.struct(*fields, F.col("properties_json").alias("raw_properties_json")).alias("detail"),
        "associations",
        reject_reason([spec, detail], STATUS_PROPERTIES.get(activity_type, ())).alias("reject_reason"),
        "raw", "seq")


def flatten_activities(df: DataFrame, activity_type: str, as_of) -> DataFrame:
    """Usable activity rows of one type."""
    records = split_valid(flatten_activity_records(df, activity_type, as_of))[0]
    return records.drop("detail", "associations")


def all_activities(**by_type: DataFrame) -> DataFrame:
    """Bag union of the activities of several types."""
    first, *rest = by_type.values()
    for other in rest:
        first = first.unionByName(other)
    return first


def without_type(activities: DataFrame, activity_type: str) -> DataFrame:
    """All activities but those of one type, case ignored; a missing type is another one."""
    return activities.filter(~F.upper("activity_type").eqNullSafe(activity_type.upper()))


def details_of(df: DataFrame, activity_type: str) -> DataFrame:
    """Detail rows of one activity type, keyed by the activity's source id."""
    records = split_valid(flatten_activity_records(df, activity_type, "1970-01-01"))[0]
    return records.select("source_id", "detail.*", "seq")


def call_details(df: DataFrame) -> DataFrame:
    return details_of(df, "CALL")


def email_details(df: DataFrame) -> DataFrame:
    return details_of(df, "EMAIL")


def meeting_details(df: DataFrame) -> DataFrame:
    return details_of(df, "MEETING")


def task_details(df: DataFrame) -> DataFrame:
    return details_of(df, "TASK")


def note_details(df: DataFrame) -> DataFrame:
    return details_of(df, "NOTE")


def sms_details(df: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """SMS details; the assignee goes through the manual owner overrides."""
    details = details_of(df, "SMS")
    if overrides is None:
        return details
    from crmlake.operators.resolve import label_dim, resolve_label
    return resolve_label(details, "activity_assigned_to", label_dim(None, overrides))


def attach_activity(details: DataFrame, activities: DataFrame) -> DataFrame:
    """Details keyed by source id get the activity's surrogate id. Details without one are left out.

    One equi join on the source id; both sides hold each id once.
    """
    keys = activities.select(F.col("source_id"), F.col("id").alias("activity_id"))
    return details.join(keys, "source_id").drop("source_id")


def with_etl_date(df: DataFrame, as_of) -> DataFrame:
    return df.withColumn("etl_date", F.lit(as_of).cast("timestamp"))


def status_flags(df: DataFrame) -> DataFrame:
    """is_upcoming, is_overdue, is_completed and is_due from ``status``."""
    return df.withColumns({
        f"is_{s}": F.col("status").eqNullSafe(s) for s in ("upcoming", "overdue", "completed", "due")})
