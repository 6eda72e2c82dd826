"""The nineteen tables and the one of rejected rows: columns, types, maximum lengths, required columns and business keys.

``string(n)`` is a maximum length. Spark stores a plain string; the limit is checked by
:func:`crmlake.operators.quality.check_lengths`.
"""

from __future__ import annotations

import re

from pyspark.sql import types as T

_DETAIL_HEAD = "id bigint not null, activity_id bigint not null, "
_DETAIL_TAIL = ", raw_properties_json string not null, etl_date timestamp not null"

# Table layouts.
TABLES: dict[str, str] = {
    "contacts": """id bigint not null, source_id string(50) not null, record_id string(50),
        full_name string(255), email string(255), phone string(50), contact_owner string(255),
        company string(255), last_activity_date timestamp, lead_status string(100),
        lifecycle_stage string(100), postal_code string(50), contact_type string(100),
        inverter_brand string(255), last_contacted timestamp, created_at timestamp,
        analytics_source string(100), analytics_source_data1 string(255),
        analytics_source_data2 string(500), etl_date timestamp not null""",
    "companies": """id bigint not null, source_id string(50) not null, record_id string(50),
        name string(255), company_owner string(255), created_at timestamp, phone string(50),
        last_activity_date timestamp, city string(100), country string(100), cvr string(50),
        postal_code string(50), type string(100), etl_date timestamp not null""",
    "deals": """id bigint not null, source_id string(50) not null, record_id string(50),
        deal_name string(255), deal_stage string(100), pipeline string(100), close_date timestamp,
        deal_owner string(255), amount decimal(18,2), deal_type string(255),
        created_at timestamp, etl_date timestamp not null""",
    "tickets": """id bigint not null, source_id string(50) not null, record_id string(50),
        ticket_name string(500), pipeline string(100), ticket_status string(100),
        created_at timestamp, priority string(50), ticket_owner string(255), source string(100),
        last_activity_date timestamp, etl_date timestamp not null""",
    "communications": """id bigint not null, source_id string(50) not null, record_id string(50),
        channel_type string(100), communication_body string, associated_contact_id string(50),
        associated_contact_name string(255), associated_contact_email string(255),
        activity_assigned_to string(255), activity_date timestamp, etl_date timestamp not null""",
    "emails": """id bigint not null, source_id string(50) not null, record_id string(50),
        email_subject string(500), activity_date timestamp, associated_contact_id string(50),
        associated_contact_name string(255), associated_contact_email string(255),
        activity_assigned_to string(255), email_body string, email_send_status string(50),
        etl_date timestamp not null""",
    "notes": """id bigint not null, source_id string(50) not null, record_id string(50),
        body_preview string, activity_assigned_to string(255), activity_date timestamp,
        etl_date timestamp not null""",
    "activities": """id bigint not null, source_id string(50) not null, record_id string(50),
        activity_type string(50), subject string(500), body string, activity_owner string(255),
        source_object_type string(50), source_object_id string(50), source_object_name string(255),
        source_object_email string(255), activity_date timestamp, status string(50),
        etl_date timestamp not null""",
    "activity_calls": _DETAIL_HEAD + """direction string(50), status string(50),
        call_title string(500), call_direction string(255), created_date timestamp,
        created_by_user_id string(255), last_modified_date timestamp""" + _DETAIL_TAIL,
    "activity_emails": _DETAIL_HEAD + """status string(50), text_body string, html_body string,
        created_date timestamp, created_by_user_id string(255), email_click_rate string(255),
        email_direction string(255), email_open_rate string(255), email_reply_rate string(255),
        last_modified_date timestamp, number_of_email_clicks string(255),
        number_of_email_opens string(255), updated_by_user_id string(255)""" + _DETAIL_TAIL,
    "activity_meetings": _DETAIL_HEAD + """start_time timestamp, end_time timestamp,
        contact_first_outreach_date timestamp, created_date timestamp,
        created_by_user_id string(255), team string(255), attendee_owner_ids string(500),
        last_modified_date timestamp, location_type string(255), meeting_location string(500),
        meeting_name string(500), meeting_source string(255),
        time_to_book_from_first_contact string(255)""" + _DETAIL_TAIL,
    "activity_notes": _DETAIL_HEAD + """created_date timestamp, created_by_user_id string(255),
        last_modified_date timestamp""" + _DETAIL_TAIL,
    "activity_sms": _DETAIL_HEAD + """direction string(50), status string(50),
        channel_account_name string(255), channel_name string(255), message_body string,
        activity_assigned_to string(255), activity_date timestamp, channel_type string(255),
        communication_body string, conversation_first_message_timestamp timestamp,
        created_by_user_id string(255), team string(255), logged_from string(255),
        object_created_date_time timestamp, object_last_modified_date_time timestamp,
        owner_assigned_date timestamp, record_source string(255),
        record_source_detail1 string(255), updated_by_user_id string(255)""" + _DETAIL_TAIL,
    "activity_tasks": _DETAIL_HEAD + """priority string(50), status string(50),
        communication_body string, created_at timestamp, is_overdue string,
        last_modified_at timestamp, task_type string(255),
        updated_by_user_id string(255)""" + _DETAIL_TAIL,
    "contact_company_associations": """id bigint not null, contact_source_id string(50) not null,
        company_source_id string(50) not null, contact_id bigint, company_id bigint,
        association_type string(100), association_labels_json string,
        association_created_at timestamp, association_updated_at timestamp,
        association_source string(100), association_source_id string(255),
        etl_date timestamp not null""",
    "activity_associations": """id bigint not null, activity_source_id string(50) not null,
        activity_id bigint, associated_object_type string(50) not null,
        associated_object_id string(50) not null, association_label string(200),
        association_type_id int, association_category string(50), etl_date timestamp not null""",
    "object_associations": """id bigint not null, source_object_type string(50) not null,
        source_object_id string(50) not null, target_object_type string(50) not null,
        target_object_id string(50) not null, association_label string(200),
        association_labels_json string, association_type_id int, association_category string(50),
        association_created_at timestamp, association_updated_at timestamp,
        association_source string(100), association_source_id string(255), is_primary boolean,
        etl_date timestamp not null""",
    "property_histories": """id bigint not null, object_type string(50) not null,
        object_id string(50) not null, property_name string(100) not null, new_value string(500),
        old_value string(500), change_date timestamp not null, source string(200),
        source_id string(255), etl_date timestamp not null""",
    "contact_activity_timelines": """id bigint not null, contact_source_id string(50) not null,
        event_type string(100) not null, event_date timestamp not null,
        description string(2000) not null, related_object_type string(50),
        related_object_id string(50), related_object_name string(500), actor_id string(255),
        actor_name string(255), metadata string(2000), etl_date timestamp not null""",
    "rejected": """table_name string not null, source_id string, reason string not null, raw string,
        etl_date timestamp not null""",
}

# Business keys (all other tables use source_id).
KEYS: dict[str, tuple[str, ...]] = {name: ("source_id",) for name in TABLES} | {
    "activity_calls": ("activity_id",),
    "activity_emails": ("activity_id",),
    "activity_meetings": ("activity_id",),
    "activity_notes": ("activity_id",),
    "activity_sms": ("activity_id",),
    "activity_tasks": ("activity_id",),
    "contact_company_associations": ("contact_source_id", "company_source_id"),
    "activity_associations": (
        "activity_source_id", "associated_object_type", "associated_object_id"),
    "object_associations": (
        "source_object_type", "source_object_id", "target_object_type", "target_object_id"),
    "property_histories": ("object_type", "object_id", "property_name", "change_date"),
    "contact_activity_timelines": (
        "contact_source_id", "event_type", "event_date", "related_object_id"),
}

# Partition columns of the stored tables: few values each, and all of them filter columns.
PARTITIONS: dict[str, tuple[str, ...]] = {
    "activities": ("activity_type",),
    "activity_associations": ("associated_object_type",),
    "object_associations": ("source_object_type", "target_object_type"),
    "property_histories": ("object_type", "property_name"),
    "contact_activity_timelines": ("event_type",),
}

# Columns whose values belong to one row only, where there is a value (beside the business keys).
UNIQUE: dict[str, tuple[str, ...]] = {"contacts": ("email",)}

# Columns that hold the id of a row of another table, where they hold anything.
REFERENCES: dict[str, dict[str, str]] = {
    "contact_company_associations": {"contact_id": "contacts", "company_id": "companies"},
    "activity_associations": {"activity_id": "activities"},
} | {f"activity_{kind}": {"activity_id": "activities"}
     for kind in ("calls", "emails", "meetings", "notes", "sms", "tasks")}

_SPARK_TYPES = {
    "bigint": T.LongType(), "int": T.IntegerType(), "string": T.StringType(),
    "timestamp": T.TimestampType(), "boolean": T.BooleanType(), "decimal": T.DecimalType(18, 2),
}
_COLUMN = re.compile(r"(\w+) (\w+)(?:\((\d+)(?:,\d+)?\))?( not null)?(?:,|$)")


def _parsed(table: str):
    return _COLUMN.findall(" ".join(TABLES[table].split()))


def schema(table: str) -> T.StructType:
    """Spark schema of a table. Nullability is a data-quality rule, so every field is nullable."""
    return T.StructType([T.StructField(n, _SPARK_TYPES[t]) for n, t, _, _ in _parsed(table)])


def columns(table: str) -> list[str]:
    return [c[0] for c in _parsed(table)]


def lengths(table: str) -> dict[str, int]:
    """Maximum lengths of the bounded string columns."""
    return {n: int(size) for n, t, size, _ in _parsed(table) if t == "string" and size}


def required(table: str) -> list[str]:
    return [n for n, _, _, flag in _parsed(table) if flag]


def key_tells_partition(table: str) -> bool:
    """Whether rows of one key always lie in one partition of the stored table."""
    return table in PARTITIONS and set(PARTITIONS[table]) <= set(KEYS[table])
