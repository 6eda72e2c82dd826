"""Ids to labels and contacts: lookup dimensions and the joins that use them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from crmlake.functions.text import not_blank
from crmlake.operators.ordered import keep_last

# A side is broadcast only after its rows and bytes were counted to be within these.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024


def within_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS,
                     size: int = BROADCAST_BYTES) -> bool:
    """Count a lookup side and its bytes, in the map tasks, and compare with the bounds."""
    text = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in df.columns]
    total = text[0]
    for part in text[1:]:
        total = total + part
    seen = df.agg(F.count(F.lit(1)).alias("n"), F.sum(total).alias("b")).first()
    return seen["n"] <= rows and (seen["b"] or 0) <= size


def sized(dim: DataFrame) -> DataFrame:
    """A lookup with unique keys, marked for broadcast if it was counted to be small.

    The mark stays on what is selected from it, so a run counts a lookup once. One that is not marked
    is left to a shuffle join, where adaptive execution splits hot keys of the left side.
    """
    return F.broadcast(dim) if within_broadcast(dim) else dim


def _named(rows: DataFrame) -> DataFrame:
    return rows.filter(not_blank("id"))


def owners_dim(rows: DataFrame) -> DataFrame:
    """Owner rows to one name per id; the last row of an id wins."""
    named = _named(rows).select(F.lower("id").alias("key"), "name", "seq")
    return keep_last(named, ["key"], "seq").select("key", "name")


def options_dim(rows: DataFrame) -> DataFrame:
    """Property-option rows to one label per value, case ignored; the last row wins."""
    return owners_dim(rows)


def _manual(overrides: DataFrame) -> DataFrame:
    return overrides.groupBy(F.lower("key").alias("key")).agg(F.max("name").alias("name"))


def label_dim(dim: DataFrame | None, overrides: DataFrame | None) -> DataFrame:
    """One mapping id to label from a dimension and a table of manual overrides (key, name).

    Overrides apply to what the dimension gives, as well as to ids it does not know. Both are
    lookup lists, so this is settled here and the big side is joined once.
    """
    if overrides is None:
        return dim
    manual = _manual(overrides)
    if dim is None:
        return manual
    named = dim.join(manual.select(F.col("key").alias("_k"), F.col("name").alias("_n")),
                     F.lower("name") == F.col("_k"), "left")
    known = named.select("key", F.coalesce("_n", "name").alias("name"))
    return known.unionByName(manual.join(dim, "key", "left_anti"))


def owner_label_dim(owners: DataFrame, overrides: DataFrame | None) -> DataFrame:
    """Owner names, then manual overrides for ids the owner list does not know."""
    if overrides is None:
        return owners
    manual = _manual(overrides)
    return owners.unionByName(manual.join(owners, "key", "left_anti"))


def resolve_label(df: DataFrame, column: str, dim: DataFrame) -> DataFrame:
    """Replace ids by labels, ignoring case; unknown and blank ids stay as they are."""
    side = dim.select(F.col("key").alias("_key"), F.col("name").alias("_name"))
    joined = df.join(side, F.lower(F.col(column)) == F.col("_key"), "left")
    return joined.withColumn(column, F.coalesce("_name", column)).drop("_key", "_name")


def resolve_owner(df: DataFrame, column: str, owners: DataFrame,
                  overrides: DataFrame | None = None) -> DataFrame:
    return resolve_label(df, column, owner_label_dim(owners, overrides))


# The default ticket pipeline.
DEFAULT_PIPELINE = ("0", "Support Pipeline")


def resolve_pipeline(df: DataFrame, column: str, options: DataFrame) -> DataFrame:
    """Pipeline id to label; what is still "0" afterwards is the support pipeline."""
    unnamed, label = DEFAULT_PIPELINE
    resolved = resolve_label(df, column, options)
    return resolved.withColumn(
        column, F.when(F.col(column) == unnamed, label).otherwise(F.col(column)))


def resolve_stage(df: DataFrame, column: str, options: DataFrame,
                  overrides: DataFrame | None = None) -> DataFrame:
    """Stage id to label, then the override table on the result."""
    return resolve_label(df, column, label_dim(options, overrides))


def display_name(full_name: str, email: str, fallback: str) -> Column:
    return (F.when(not_blank(full_name), F.col(full_name))
            .when(not_blank(email), F.col(email)).otherwise(F.col(fallback)))


def contact_dim(*tiers: DataFrame) -> DataFrame:
    """Lookup of contacts by source id or record id: key, contact_name, contact_email.

    ``tiers`` come in order of trust: this run, the stored table, a later snapshot. Both ids
    become keys first, so the lookup is one equi join instead of an "or" join. Within the first
    tier the last contact wins; where no order is known the contact's own source id goes first.
    """
    order_type = next((t.schema["seq"].dataType for t in tiers if "seq" in t.columns), None)
    parts = []
    for rank, tier in enumerate(tiers):
        seq = F.col("seq") if "seq" in tier.columns else F.lit(None).cast(order_type or "string")
        both = F.array(F.lower("source_id"), F.lower("record_id"))
        parts.append(tier.select(
            F.explode(F.array_distinct(both)).alias("key"),
            F.lower("source_id").alias("own"),
            display_name("full_name", "email", "source_id").alias("contact_name"),
            F.col("email").alias("contact_email"), seq.alias("seq"), F.lit(-rank).alias("rank")))
    keyed = parts[0]
    for part in parts[1:]:
        keyed = keyed.unionByName(part)
    keyed = keyed.filter(not_blank("key")).select(
        "key", "rank", "seq", (F.col("key") == F.col("own")).alias("direct"), "contact_name",
        "contact_email")
    best = keep_last(keyed, ["key"], ["rank", "seq", "direct"])
    return best.select("key", "contact_name", "contact_email")


def enrich_contact(df: DataFrame, id_column: str, *tiers: DataFrame,
                   name: str = "associated_contact_name",
                   email: str = "associated_contact_email",
                   when: Column | None = None) -> DataFrame:
    """Fill the contact name and email of rows that refer to a contact.

    Contacts can be as large as the fact side, so they are not counted: adaptive execution broadcasts
    them where they turn out small. Rows the lookup does not know keep a null name and email.
    """
    dim = contact_dim(*tiers)
    on = F.lower(F.col(id_column)) == F.col("key")
    joined = df.join(dim, on if when is None else on & when, "left")
    return joined.withColumns({name: F.col("contact_name"), email: F.col("contact_email")}).drop(
        "key", "contact_name", "contact_email")


def enrich_source(activities: DataFrame, *tiers: DataFrame) -> DataFrame:
    """Source object name and email of activities, where the source object is a contact."""
    return enrich_contact(
        activities, "source_object_id", *tiers, name="source_object_name",
        email="source_object_email", when=F.lower("source_object_type") == "contacts")
