"""Activity status at a given time: upcoming, due, overdue or completed."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from crmlake.functions.text import not_blank


def _moment(as_of) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")


def _by_date(date: Column, now: Column, default: str) -> Column:
    return (F.when(date > now, "upcoming").when(date <= now, "completed").otherwise(default))


def task_status(status: Column, completed_at: Column, overdue: Column, due: Column,
                start: Column, activity_date: Column, as_of) -> Column:
    now = _moment(as_of)
    word = F.upper(status)
    late = F.lower(overdue).isin("true", "1")
    return (
        F.when(completed_at.isNotNull(), "completed")
        .when(word.isin("COMPLETE", "COMPLETED", "END"), "completed")
        .when(due.isNotNull() & (late | (due < now)), "overdue")
        .when(due <= now + F.expr("interval 24 hours"), "due")
        .when(due.isNotNull(), "upcoming")
        .when(start > now, "upcoming")
        .when(word.isin("WAITING", "NOT_STARTED", "DEFERRED"),
              F.when(activity_date > now, "upcoming").otherwise("due"))
        .when(word == "IN_PROGRESS", "due")
        .otherwise(_by_date(activity_date, now, "due")))


def meeting_status(start: Column, activity_date: Column, as_of) -> Column:
    return _by_date(F.coalesce(start, activity_date), _moment(as_of), "completed")


def call_status(status: Column, activity_date: Column, as_of) -> Column:
    now = _moment(as_of)
    return (
        F.when(F.upper(status) == "SCHEDULED",
               F.when(activity_date > now, "upcoming").otherwise("due"))
        .when(not_blank(status), "completed")
        .otherwise(_by_date(activity_date, now, "completed")))


def other_status(activity_type: Column, activity_date: Column, as_of) -> Column:
    return F.when(activity_type.isin("EMAIL", "NOTE", "SMS"), "completed").otherwise(
        _by_date(activity_date, _moment(as_of), "completed"))
