"""Reading JSON values whose type matters, held as variants."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from crmlake.functions.text import col, strip_html
from crmlake.model.objects import From


def _kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def present(value: Column) -> Column:
    """The key exists and does not hold a JSON null."""
    return F.coalesce(_kind(value) != "VOID", F.lit(False))


def is_text(value: Column) -> Column:
    return F.coalesce(_kind(value) == "STRING", F.lit(False))


def as_text(value: Column) -> Column:
    """The value of a JSON string, else null."""
    return F.when(_kind(value) == "STRING", F.try_variant_get(value, "$", "string"))


def object_id(value: Column) -> Column:
    """An id given as a JSON string or whole number, as a string; else null."""
    return F.when(_kind(value).isin("STRING", "BIGINT"), F.try_variant_get(value, "$", "string"))


def whole_number(value: Column) -> Column:
    """A JSON number as int, else null."""
    return F.when(_kind(value) == "BIGINT", F.try_variant_get(value, "$", "int"))


def to_stamp(c: Column | str) -> Column:
    """Timestamp of an ISO-like string, null where it does not parse."""
    return F.try_to_timestamp(col(c))


def to_money(c: Column | str) -> Column:
    """Decimal(18,2) of a string, thousands separators allowed, null where it does not parse."""
    return F.translate(col(c), ",", "").try_cast("decimal(18,2)")


def to_whole(c: Column | str, kind: str = "int") -> Column:
    """Whole number of a string; surrounding space is allowed, a decimal point is not."""
    text = col(c)
    return F.when(text.rlike(r"^\s*[+-]?\d+\s*$"), F.trim(text).try_cast(kind))


def prop(value: Column, kind: str) -> Column:
    """Typed property getter over a variant: string, timestamp, decimal, int, long or bool.

    Values that do not parse are null, except bool, where they are false.
    """
    if kind == "string":
        return as_text(value)
    if kind == "timestamp":
        return to_stamp(as_text(value))
    if kind == "decimal":
        return to_money(as_text(value))
    if kind == "int":
        return whole_number(value)
    if kind == "long":
        number = F.when(_kind(value) == "BIGINT", F.try_variant_get(value, "$", "bigint"))
        return F.coalesce(number, to_whole(as_text(value), "bigint"))
    if kind == "bool":
        spoken = F.lower(F.trim(as_text(value)))
        return F.coalesce(
            F.when(_kind(value) == "BOOLEAN", F.try_variant_get(value, "$", "boolean")),
            F.when(spoken.isin("true", "false"), spoken == "true"), F.lit(False))
    raise ValueError(f"unknown property kind: {kind}")


def read(source: From) -> Column:
    """The column a :class:`From` describes, over the texts in ``properties``.

    Stated as expression text: a load has some hundred such columns, and one text each is handed to
    the JVM far quicker than a tree of calls.
    """
    found = [f"properties.`{n}`" for n in source.names]
    if source.kind == "stamp":
        return F.expr(f"coalesce({', '.join(f'try_to_timestamp({t})' for t in found)})")
    if source.kind == "filled":
        return F.expr("coalesce({})".format(", ".join(f"nullif({t}, '')" for t in found)))
    first = F.expr(f"coalesce({', '.join(found)})")
    if source.kind == "body":
        return strip_html(first)
    return to_money(first) if source.kind == "money" else first


def misfit(source: From) -> str:
    """SQL test over ``properties`` and ``misfits``: a property of the wrong type is met before the
    fallback chain has found its value.
    """
    unusable = {"stamp": "try_to_timestamp({0}) IS NULL", "filled": "coalesce({0}, '') = ''"}.get(
        source.kind, "{0} IS NULL")

    def wrong(name: str) -> str:
        return f"array_contains(misfits, '{name}')"

    def still_open(name: str) -> str:
        return unusable.format(f"properties.`{name}`")

    *rest, last = source.names
    return reduce(lambda later, name: f"({wrong(name)} OR ({still_open(name)} AND {later}))",
                  reversed(rest), wrong(last))
