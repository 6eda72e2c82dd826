"""Upsert that never lets a null replace a known value.

The incoming side is reduced to one row per key inside each map task first, then one full outer
join on the key brings both sides together. Keys are unique on both sides, so no key is hot.
"""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import Column, DataFrame, functions as F

from crmlake.functions.text import not_blank
from crmlake.model.tables import KEYS, columns, schema
from crmlake.operators.ordered import keep_last

INSERTED, UPDATED, KEPT = "inserted", "updated", "kept"


def surrogate_id(keys: list[str] | tuple[str, ...]) -> Column:
    """Surrogate id from the business key: the id itself where it is one whole number, else a hash.

    It depends on the row alone, so no counter is shared between tasks and a task that is run again
    gives the same id. Hashes are set negative to stay apart from source ids.
    """
    hashed = -F.shiftrightunsigned(F.xxhash64(*keys), 1) - 1
    if len(keys) > 1:
        return hashed
    number = F.col(keys[0]).try_cast("bigint")
    return F.coalesce(F.when(number.cast("string") == F.col(keys[0]).cast("string"), number), hashed)


def _aligned(df: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``like``, missing ones as null, in its types."""
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in like.schema])


def merge_coalesce(base: DataFrame, incoming: DataFrame, keys, *, as_of,
                   never: tuple[str, ...] = (), blank_is_null: tuple[str, ...] = (),
                   replace: tuple[str, ...] = (), order_by=None, blank_keys: bool = False,
                   unique: bool = False) -> DataFrame:
    """Merge a snapshot into a table. Returns the base columns and ``action``.

    Matched rows take each incoming value that is not null and a new load time; unmatched incoming
    rows are inserted; base rows that are not in the snapshot stay.

    never          columns whose stored value stays once a row exists
    blank_is_null  columns where a blank incoming value also keeps the stored one
    replace        columns always taken from the incoming row
    order_by       order of repeated incoming keys, the last one wins
    blank_keys     rows with a blank key are always inserted (otherwise keys are required)
    unique         the caller knows incoming keys do not repeat
    """
    keys = list(keys)
    order = [order_by] if isinstance(order_by, str) else list(order_by or ())
    names = base.columns
    extra = [c for c in order if c not in names]
    absent = "id" in names and "id" not in incoming.columns
    # a hash of the key is as large as all that is compressed of a narrow row: it is made after repeated keys are reduced
    late = absent and all(dict(incoming.dtypes).get(k) == t for k, t in base.select(*keys).dtypes)
    if absent and not late:
        incoming = incoming.withColumn("id", surrogate_id(keys))
    staged = _aligned(incoming, base.select(*names))
    if extra:
        staged = incoming.select(*[F.col(c) for c in extra], *[
            (F.col(f.name) if f.name in incoming.columns else F.lit(None)).cast(f.dataType)
            .alias(f.name) for f in base.schema])
    on = keys
    if blank_keys:
        # a blank key gets a key of its own, so it never matches and does not gather in one task
        blank = reduce(lambda x, y: x | y, [~not_blank(F.col(k).cast("string")) for k in keys])
        base, staged = [
            df.withColumn("_alone", F.when(blank, F.concat(
                F.lit(side), F.monotonically_increasing_id().cast("string"))).otherwise(""))
            .withColumns({f"_on_{k}": F.when(F.col("_alone") == "", F.col(k)) for k in keys})
            for side, df in (("b", base), ("i", staged))]
        on = [f"_on_{k}" for k in keys] + ["_alone"]
    if not unique:
        staged = keep_last(staged, on, order)
    if late:
        staged = staged.withColumn("id", surrogate_id(keys))
    values = [c for c in names if c not in on]
    old = base.select(*on, *[F.col(c).alias(f"_old_{c}") for c in values],
                      F.lit(True).alias("_in_base"))
    new = staged.select(*on, *[F.col(c).alias(f"_new_{c}") for c in values],
                        F.lit(True).alias("_in_new"))
    joined = old.join(new, on, "full")
    in_base, in_new = F.col("_in_base").isNotNull(), F.col("_in_new").isNotNull()
    moment = F.lit(as_of).cast("timestamp")

    def merged(c: str) -> Column:
        if c in on:
            return F.col(c)
        was, now = F.col(f"_old_{c}"), F.col(f"_new_{c}")
        if c == "etl_date":
            return F.when(in_new, moment).otherwise(was)
        if c in never or c == "id":
            return F.when(in_base, was).otherwise(now)
        if c in replace:
            return F.when(in_new, now).otherwise(was)
        if c in blank_is_null:
            return F.when(in_base, F.when(not_blank(now), now).otherwise(was)).otherwise(now)
        return F.coalesce(now, was)

    action = (F.when(~in_new, KEPT).when(in_base, UPDATED).otherwise(INSERTED))
    return joined.select(*[merged(c).alias(c) for c in names], action.alias("action"))


# What differs from the common rule, per table.
MERGE_RULES: dict[str, dict] = {name: {} for name in KEYS} | {
    "contacts": {"never": ("created_at",)},
    "companies": {"never": ("created_at",)},
    "tickets": {"never": ("created_at",)},
    "contact_company_associations": {"never": ("contact_id", "company_id")},
    "activity_associations": {
        "never": ("activity_id",),
        "blank_is_null": ("association_label", "association_category")},
    "object_associations": {
        "blank_is_null": ("association_label", "association_labels_json", "association_category",
                          "association_source", "association_source_id"),
        "replace": ("is_primary",)},
}


def upsert(table: str, base: DataFrame, incoming: DataFrame, as_of, order_by="seq",
           **options) -> DataFrame:
    """Merge into one of the known tables by its own key and rules."""
    if isinstance(order_by, str):
        order_by = [order_by]
    order = [c for c in (order_by or ()) if c in incoming.columns]
    return merge_coalesce(base, incoming, KEYS[table], as_of=as_of, order_by=order,
                          **(MERGE_RULES[table] | options))


def _listed(table: str):
    return partial(upsert, table, order_by=("seq", "pos"))


upsert_contacts = partial(upsert, "contacts")
upsert_companies = partial(upsert, "companies")
upsert_deals = partial(upsert, "deals")
upsert_tickets = partial(upsert, "tickets")
upsert_communications = partial(upsert, "communications")
upsert_emails = partial(upsert, "emails")
upsert_notes = partial(upsert, "notes")
upsert_contact_company = _listed("contact_company_associations")
upsert_activity_edges = _listed("activity_associations")
upsert_object_edges = _listed("object_associations")
upsert_history = _listed("property_histories")
upsert_timeline = partial(upsert, "contact_activity_timelines")

_DETAIL_TABLE = {"call": "activity_calls", "email": "activity_emails",
                 "meeting": "activity_meetings", "note": "activity_notes", "sms": "activity_sms",
                 "task": "activity_tasks"}


def upsert_details(kind: str, base: DataFrame, incoming: DataFrame, as_of) -> DataFrame:
    """Detail rows of one kind: attached where absent, else merged column by column.

    Raw properties are never null, so the common rule replaces them.
    """
    return upsert(_DETAIL_TABLE[kind], base, incoming, as_of)


def upsert_activities(base: DataFrame, incoming: DataFrame, details: dict, as_of):
    """Activities and their details.

    ``details`` maps a kind to (stored details, incoming details keyed by the activity's source
    id). Returns the merged activities and a dict of merged details.
    """
    merged = upsert("activities", base, incoming, as_of)
    keys = merged.select("source_id", F.col("id").alias("activity_id"))
    return merged, {
        kind: upsert_details(kind, stored, new.join(keys, "source_id").drop("source_id"), as_of)
        for kind, (stored, new) in details.items()}


def load_metrics(merged: DataFrame, step: str, failed: DataFrame | None = None) -> DataFrame:
    """One row: step, total, inserted, updated, kept, failed. Total counts the incoming rows."""
    outcomes = merged.select("action")
    if failed is not None:
        outcomes = outcomes.unionAll(failed.select(F.lit("failed").alias("action")))

    def count(*actions: str) -> Column:
        return F.count_if(F.col("action").isin(*actions))

    return outcomes.agg(
        F.lit(step).alias("step"), count(INSERTED, UPDATED, "failed").alias("total"),
        count(INSERTED).alias("inserted"), count(UPDATED).alias("updated"),
        count(KEPT).alias("kept"), count("failed").alias("failed"))


def empty_table(spark, table: str) -> DataFrame:
    return spark.createDataFrame([], schema(table))


def absent_table(spark, table: str) -> DataFrame:
    """A table that is not there yet. Its plan shows that it is empty, so joins with it move no rows to find nothing."""
    return empty_table(spark, table).where(F.lit(False))


def to_table(df: DataFrame, table: str) -> DataFrame:
    """Exactly the columns of a table; missing ones null, the surrogate id derived if absent."""
    if "id" in columns(table) and "id" not in df.columns:
        df = df.withColumn("id", surrogate_id(KEYS[table]))
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema(table)])
