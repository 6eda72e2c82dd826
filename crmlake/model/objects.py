"""Which source properties fill which columns, per object type.

One declaration per object type drives the JSON schema that is parsed (so unlisted properties
are skipped by the parser), the typed projection and the type check of every row.
"""

from __future__ import annotations

from dataclasses import dataclass

# Singular names of the object types.
SINGULAR = {
    "contacts": "contact", "companies": "company", "deals": "deal", "tickets": "ticket",
    "communications": "communication", "emails": "email", "notes": "note", "calls": "call",
    "meetings": "meeting", "tasks": "task", "sms": "sms",
}

ACTIVITY_TYPES = ("CALL", "EMAIL", "MEETING", "TASK", "NOTE", "SMS")

# Object type that lands the activities of each type.
ACTIVITY_SOURCES = {
    "CALL": "calls", "EMAIL": "emails", "MEETING": "meetings", "TASK": "tasks", "NOTE": "notes",
    "SMS": "sms",
}


@dataclass(frozen=True)
class From:
    """A column's source: the first usable one of ``names``, read as ``kind``.

    kind ``text`` takes the first non-null, ``filled`` the first non-empty string, ``body`` is
    ``text`` with markup stripped, ``stamp`` the first that parses as a timestamp, ``money`` a
    decimal.
    """

    kind: str
    names: tuple[str, ...]


def text(*names: str) -> From:
    return From("text", names)


def filled(*names: str) -> From:
    return From("filled", names)


def body(*names: str) -> From:
    return From("body", names)


def stamp(*names: str) -> From:
    return From("stamp", names)


def money(*names: str) -> From:
    return From("money", names)


# The property that fills each column.
OBJECTS: dict[str, dict[str, From]] = {
    "contacts": {
        "email": text("email"),
        "phone": text("phone"),
        "contact_owner": text("hubspot_owner_id"),
        "company": text("company"),
        "last_activity_date": stamp("notes_last_activity_date", "notes_last_updated"),
        "lead_status": text("hs_lead_status"),
        "lifecycle_stage": text("lifecyclestage"),
        "postal_code": text("zip"),
        "contact_type": text("contact_type", "contact-type"),
        "inverter_brand": text("inverter_brand"),
        "last_contacted": stamp("notes_last_contacted"),
        "created_at": stamp("createdate"),
        "analytics_source": text("hs_analytics_source"),
        "analytics_source_data1": text("hs_analytics_source_data_1"),
        "analytics_source_data2": text("hs_analytics_source_data_2"),
    },
    "companies": {
        "name": text("name"),
        "company_owner": text("hubspot_owner_id"),
        "created_at": stamp("createdate"),
        "phone": text("phone"),
        "last_activity_date": stamp("hs_last_activity_date", "notes_last_updated"),
        "city": text("city"),
        "country": text("country"),
        "cvr": text("cvr", "company_registration_number"),
        "postal_code": text("zip", "postal_code"),
        "type": text("type", "company_type", "hs_company_type"),
    },
    "deals": {
        "deal_name": text("dealname"),
        "deal_stage": text("dealstage"),
        "pipeline": text("pipeline"),
        "close_date": stamp("closedate"),
        "deal_owner": text("hubspot_owner_id"),
        "amount": money("amount"),
        "deal_type": text("dealtype"),
        "created_at": stamp("createdate"),
    },
    "tickets": {
        "ticket_name": text("subject", "hs_ticket_subject"),
        "pipeline": text("hs_pipeline"),
        "ticket_status": text("hs_pipeline_stage", "hs_ticket_status"),
        "created_at": stamp("createdate"),
        "priority": text("hs_ticket_priority"),
        "ticket_owner": text("hubspot_owner_id"),
        "source": text("source_type", "created_by_source", "hs_ticket_source"),
        "last_activity_date": stamp("hs_lastactivitydate"),
    },
    "communications": {
        "channel_type": text("hs_communication_channel_type", "hs_channel_type"),
        "communication_body": body("hs_communication_body", "hs_body_preview"),
        "activity_assigned_to": text("hubspot_owner_id"),
        "activity_date": stamp("hs_timestamp", "hs_createdate"),
    },
    "emails": {
        "email_subject": text("hs_email_subject"),
        "activity_date": stamp("hs_timestamp", "hs_createdate"),
        "activity_assigned_to": text("hubspot_owner_id"),
        "email_body": text("hs_email_html", "hs_email_text"),
        "email_send_status": text("hs_email_status"),
    },
    "notes": {
        "body_preview": body("hs_note_body"),
        "activity_assigned_to": text("hubspot_owner_id"),
        "activity_date": stamp("hs_timestamp", "hs_createdate"),
    },
}

_OWNER_AND_TIME = {
    "activity_owner": text("hubspot_owner_id"),
    "activity_date": stamp("hs_timestamp"),
}

# The property that fills each activity column.
ACTIVITIES: dict[str, dict[str, From]] = {
    "CALL": _OWNER_AND_TIME | {"subject": text("hs_call_title"), "body": body("hs_call_body")},
    "EMAIL": _OWNER_AND_TIME | {
        "subject": text("hs_email_subject"), "body": body("hs_email_text", "hs_email_html")},
    "MEETING": _OWNER_AND_TIME | {
        "subject": text("hs_meeting_title"), "body": body("hs_meeting_body"),
        "activity_date": stamp("hs_meeting_start_time", "hs_timestamp")},
    "TASK": _OWNER_AND_TIME | {"subject": text("hs_task_subject"), "body": body("hs_task_body")},
    "NOTE": _OWNER_AND_TIME | {"body": body("hs_note_body")},
    "SMS": _OWNER_AND_TIME | {
        "subject": text("hs_sms_title"), "body": body("hs_sms_body", "hs_sms_text")},
}

# The property that fills each detail column.
DETAILS: dict[str, dict[str, From]] = {
    "CALL": {
        "direction": text("hs_call_direction"),
        "status": text("hs_call_status"),
        "call_title": text("hs_call_title"),
        "call_direction": text("hs_call_direction"),
        "created_date": stamp("hs_createdate"),
        "created_by_user_id": text("hs_created_by_user_id"),
        "last_modified_date": stamp("hs_lastmodifieddate"),
    },
    "EMAIL": {
        "status": text("hs_email_status"),
        "text_body": text("hs_email_text"),
        "html_body": text("hs_email_html"),
        "created_date": stamp("hs_createdate"),
        "created_by_user_id": text("hs_created_by_user_id"),
        "email_click_rate": text("hs_email_click_rate"),
        "email_direction": text("hs_email_direction"),
        "email_open_rate": text("hs_email_open_rate"),
        "email_reply_rate": text("hs_email_reply_rate"),
        "last_modified_date": stamp("hs_lastmodifieddate"),
        "number_of_email_clicks": text("hs_num_email_clicks"),
        "number_of_email_opens": text("hs_num_email_opens"),
        "updated_by_user_id": text("hs_updated_by_user_id"),
    },
    "MEETING": {
        "start_time": stamp("hs_meeting_start_time"),
        "end_time": stamp("hs_meeting_end_time"),
        "contact_first_outreach_date": stamp("hs_contact_first_outreach_date"),
        "created_date": stamp("hs_createdate"),
        "created_by_user_id": text("hs_created_by_user_id"),
        "team": text("hubspot_team_id"),
        "attendee_owner_ids": text("hs_attendee_owner_ids"),
        "last_modified_date": stamp("hs_lastmodifieddate"),
        "location_type": text("hs_meeting_location_type"),
        "meeting_location": text("hs_meeting_location"),
        "meeting_name": text("hs_meeting_title"),
        "meeting_source": text("hs_meeting_source"),
        "time_to_book_from_first_contact": text("hs_time_to_book_meeting_from_first_contact"),
    },
    "TASK": {
        "priority": text("hs_task_priority"),
        "status": text("hs_task_status"),
        "communication_body": text("hs_task_body"),
        "created_at": stamp("hs_createdate"),
        "is_overdue": text("hs_task_is_overdue"),
        "last_modified_at": stamp("hs_lastmodifieddate"),
        "task_type": text("hs_task_type"),
        "updated_by_user_id": text("hs_updated_by_user_id"),
    },
    "NOTE": {
        "created_date": stamp("hs_createdate"),
        "created_by_user_id": text("hs_created_by_user_id"),
        "last_modified_date": stamp("hs_lastmodifieddate"),
    },
    "SMS": {
        "direction": filled("hs_sms_direction", "hs_sms_message_direction"),
        "status": filled("hs_sms_status", "hs_sms_message_status"),
        "channel_account_name": filled("hs_sms_channel_account_name"),
        "channel_name": filled("hs_sms_channel_name"),
        "message_body": filled("hs_sms_message_body", "hs_sms_body", "hs_sms_text"),
        "activity_assigned_to": text("hs_activity_assigned_to"),
        "activity_date": stamp("hs_activity_date"),
        "channel_type": text("hs_sms_channel_type"),
        "communication_body": text("hs_sms_message_body"),
        "conversation_first_message_timestamp": stamp(
            "hs_sms_conversation_first_message_timestamp"),
        "created_by_user_id": text("hs_created_by_user_id"),
        "team": text("hubspot_team_id"),
        "logged_from": text("hs_logged_from"),
        "object_created_date_time": stamp("hs_object_create_date"),
        "object_last_modified_date_time": stamp("hs_object_last_modified_date"),
        "owner_assigned_date": stamp("hs_owner_assigneddate"),
        "record_source": text("hs_record_source"),
        "record_source_detail1": text("hs_record_source_detail_1"),
        "updated_by_user_id": text("hs_updated_by_user_id"),
    },
}

DETAIL_TABLES = {
    "CALL": "activity_calls", "EMAIL": "activity_emails", "MEETING": "activity_meetings",
    "TASK": "activity_tasks", "NOTE": "activity_notes", "SMS": "activity_sms",
}

# Properties read by the status rules only.
# Properties that decide an activity's status.
STATUS_PROPERTIES = {
    "TASK": ("hs_task_status", "hs_task_completion_timestamp", "hs_task_is_overdue",
             "hs_task_due_date", "hs_task_start_date"),
    "MEETING": ("hs_meeting_start_time",),
    "CALL": ("hs_call_status",),
}

# Properties that are landed beside those read into columns.
LANDED_ONLY = {
    "contacts": ("hs_marketing_contact_status", "epicore_package"),
    "companies": ("hs_record_source", "hs_created_by_source"),
    "deals": ("hs_tag_ids", "description"),
    "emails": ("hs_activity_assigned_to", "hs_activity_created_by", "hs_activity_date",
               "hs_email_bcc_address", "hs_email_cc_address", "hs_email_from_address",
               "hs_email_to_address", "hubspot_team_id", "hs_num_email_replies",
               "hs_num_emails_sent", "hs_record_source", "hs_record_source_detail_1"),
    "notes": ("hs_activity_assigned_to", "hs_activity_created_by", "hs_activity_date",
              "hubspot_team_id", "hs_record_source", "hs_record_source_detail_1"),
    "calls": ("hs_activity_assigned_to", "hs_activity_created_by", "hs_activity_date",
              "hs_call_source", "hs_call_meeting_type", "hs_call_duration", "hs_call_outcome",
              "hs_call_summary", "hs_call_from_number_name", "hs_call_from_number",
              "hubspot_team_id", "hs_call_to_number", "hs_call_to_number_name",
              "hs_record_source", "hs_record_source_detail_1"),
    "meetings": ("hs_meeting_assigned_to", "hs_meeting_activity_created_by", "hs_activity_date",
                 "hs_meeting_type", "hs_internal_meeting_notes", "hs_record_source"),
    "tasks": ("hs_activity_assigned_to", "hs_activity_date", "hs_task_channel_type",
              "hs_conversation_first_message_timestamp", "hs_created_by_user_id",
              "hubspot_team_id", "hs_logged_from", "hs_object_create_date",
              "hs_object_last_modified_date", "hs_contact_timezone", "hs_created_by",
              "hs_last_engagement_date", "hs_notes_preview", "hs_task_pipeline",
              "hs_task_pipeline_stage", "hs_task_queue", "hs_record_source",
              "hs_record_source_detail_1", "hs_task_reminders", "hs_task_notes",
              "hs_task_title"),
}


def read_properties(object_type: str) -> list[str]:
    """Names of the properties that any operator reads from objects of this type, sorted."""
    names = {"hs_object_id"}
    if object_type == "contacts":
        names |= {"firstname", "lastname"}
    specs = [OBJECTS.get(object_type, {})]
    for activity, source in ACTIVITY_SOURCES.items():
        if source == object_type:
            specs += [ACTIVITIES[activity], DETAILS[activity]]
            names |= set(STATUS_PROPERTIES.get(activity, ()))
    for spec in specs:
        for column in spec.values():
            names |= set(column.names)
    return sorted(names)


def requested_properties(object_type: str) -> list[str]:
    """Names to ask the source for: everything read plus what is only landed, sorted."""
    return sorted(set(read_properties(object_type)) | set(LANDED_ONLY.get(object_type, ())))


PROPERTIES = {object_type: requested_properties(object_type) for object_type in SINGULAR}
