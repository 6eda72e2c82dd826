"""Expressions over the association parts of a payload: first ids, labels, type ids."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from crmlake.functions.text import let, not_blank
from crmlake.functions.values import as_text, object_id, present, whole_number

# How associations sit inside an object payload.
TYPE_ITEMS = "array<struct<label:variant,associationTypeId:variant,typeId:variant,category:variant>>"
EMBEDDED = (f"map<string,struct<results:array<struct<id:variant,type:variant,"
            f"associationTypes:{TYPE_ITEMS},types:{TYPE_ITEMS}>>>>")


def _last(values: Column) -> Column:
    return F.try_element_at(values, F.lit(-1))


def first_contact(associations: Column) -> Column:
    """Id of the first associated contact."""
    results = F.try_element_at(associations, F.lit("contacts")).getField("results")
    return object_id(F.try_element_at(results, F.lit(1)).getField("id"))


def source_object() -> Column:
    """Struct(type, id) of the object an activity belongs to, from the column ``associations``.

    Contacts, deals, tickets and companies are tried in that order, then any other type in the
    order of the payload. Only an id that is not in the payload at all lets the search go on.
    """
    as_id = ("CASE WHEN schema_of_variant({0}) IN ('STRING', 'BIGINT') "
             "THEN try_variant_get({0}, '$', 'string') END")

    def source(kind: str, entry: str) -> str:
        first = f"try_element_at({entry}.results, 1).id"
        return (f"CASE WHEN {first} IS NOT NULL THEN "
                f"named_struct('type', {kind}, 'id', {as_id.format(first)}) END")

    preferred = ", ".join(source(f"'{name}'", f"try_element_at(associations, '{name}')")
                          for name in ("contacts", "deals", "tickets", "companies"))
    others = f"array_compact(transform(map_entries(associations), e -> {source('e.key', 'e.value')}))"
    return F.expr(f"coalesce({preferred}, try_element_at({others}, 1))")


def all_labels(types: Column) -> Column:
    """Non-blank labels of an association's types, in order."""
    return F.filter(F.transform(types, lambda t: as_text(t["label"])), lambda x: not_blank(x))


def primary_label(types: Column) -> Column:
    """First non-blank label."""
    return F.try_element_at(all_labels(types), F.lit(1))


def _type_number(t: Column) -> Column:
    return F.coalesce(whole_number(t["associationTypeId"]), whole_number(t["typeId"]))


def last_type(types: Column) -> Column:
    """Struct(type_id, category): the last one given over the types of an association."""
    numbers = F.array_compact(F.transform(types, _type_number))
    categories = F.array_compact(F.transform(types, lambda t: as_text(t["category"])))
    return F.struct(_last(numbers).alias("type_id"), _last(categories).alias("category"))


def last_plain_type(types: Column) -> Column:
    """As :func:`last_type` for types read as plain texts and numbers. The last type mostly gives both; the others
    are looked at only where it does not."""
    def number(t: Column) -> Column:
        return F.coalesce(t["associationTypeId"].try_cast("int"), t["typeId"].try_cast("int"))

    last = _last(types)
    return F.struct(
        F.coalesce(number(last), _last(F.array_compact(F.transform(types, number)))).alias("type_id"),
        F.coalesce(last["category"], _last(F.array_compact(types["category"]))).alias("category"))


def _until_labelled(types: Column) -> Column:
    """The types up to and including the first with a non-blank label; all if there is none."""
    at = F.array_position(F.transform(types, lambda t: not_blank(as_text(t["label"]))), True)
    return F.when(at > 0, F.slice(types, F.lit(1), at.cast("int"))).otherwise(types)


def first_labelled_type(types: Column) -> Column:
    """Struct(label, type_id, category) as they stand at the first labelled type."""

    def number(t: Column) -> Column:
        # the second name counts only where the first is absent
        return whole_number(F.coalesce(t["associationTypeId"], t["typeId"]))

    def at(seen: Column) -> Column:
        def last_of(read) -> Column:
            return _last(F.array_compact(F.transform(seen, read)))

        return F.struct(
            last_of(lambda t: as_text(t["label"])).alias("label"), last_of(number).alias("type_id"),
            last_of(lambda t: as_text(t["category"])).alias("category"))

    return let(_until_labelled(types), at)


def _first_labelled_plain(types: Column) -> Column:
    """As :func:`first_labelled_type` for the older ``types`` array, where null also replaces."""

    def at(seen: Column) -> Column:
        def last_given(name: str) -> Column:
            return as_text(_last(F.filter(F.transform(seen, lambda t: t[name]),
                                          lambda x: x.isNotNull())))

        numbers = F.transform(seen, lambda t: whole_number(t["associationTypeId"]))
        return F.struct(last_given("label").alias("label"),
                        _last(F.array_compact(numbers)).alias("type_id"),
                        last_given("category").alias("category"))

    return let(_until_labelled(types), at)


def edge_type(result: Column) -> Column:
    """Struct(label, type_id, category) of one associated object, whatever form it has."""
    plain = F.struct(as_text(result["type"]).alias("label"),
                     F.lit(None).cast("int").alias("type_id"),
                     F.lit(None).cast("string").alias("category"))
    return (F.when(result["associationTypes"].isNotNull(),
                   first_labelled_type(result["associationTypes"]))
            .when(result["types"].isNotNull(), _first_labelled_plain(result["types"]))
            .otherwise(plain))


def target_id(item: Column) -> Column:
    """Id of the far end: ``toObjectId`` where that key is given, else ``id``."""
    return F.when(item["toObjectId"].isNotNull(), object_id(item["toObjectId"])).otherwise(
        object_id(item["id"]))


def plain_target_id(item: Column) -> Column:
    """As :func:`target_id` for ends read as texts, where a ``toObjectId`` of another kind leaves no ``id`` either."""
    return F.coalesce(item["toObjectId"], item["id"])


__all__ = ["EMBEDDED", "TYPE_ITEMS", "all_labels", "edge_type", "first_contact",
           "first_labelled_type", "last_plain_type", "last_type", "plain_target_id", "present", "primary_label", "source_object",
           "target_id"]
