"""Property change history: each kept value with the value listed before it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from crmlake.functions.text import not_empty
from crmlake.functions.values import to_stamp


def property_history(payloads: DataFrame, order: str = "pos") -> DataFrame:
    """History payloads (one row per object and property, ``items`` in order) to change rows.

    Items without a timestamp that parses or without a value are dropped first; then each item is
    paired with the kept item listed before it. ``old_value`` is the item's own value and
    ``new_value`` the one before it in the list, which is the newer one in a newest-first list.
    ``order='time'`` puts the newest item first, for sources that do not keep an order.

    The list is already together in its row, so pairing is done inside the row: no shuffle.
    """
    read = F.transform("items", lambda x: F.struct(
        to_stamp(x["timestamp"]).alias("change_date"), x["value"].alias("value"),
        x["source"].alias("source"), x["source_id"].alias("source_id")))
    kept = F.filter(read, lambda x: x["change_date"].isNotNull() & not_empty(x["value"]))
    if order == "time":
        kept = F.reverse(F.array_sort(kept))  # newest first
    rows = payloads.select("object_type", "object_id", "property_name", kept.alias("kept"))
    paired = F.transform("kept", lambda x, i: F.struct(
        F.when(i > 0, F.get("kept", i - 1)["value"]).alias("new_value"),
        x["value"].alias("old_value"), x["change_date"].alias("change_date"),
        x["source"].alias("source"), x["source_id"].alias("source_id"), i.alias("pos")))
    return rows.select("object_type", "object_id", "property_name", F.inline(paired))


def history_of_changes(changes: DataFrame, keys: list[str],
                       spans: tuple[str, str] = ("minute", "day")) -> DataFrame:
    """As :func:`property_history` of a newest-first list, for changes landed one per row.

    Adds ``new_value``, the value that comes next in time, and renames value to ``old_value``. Ties on
    time are broken by ``value``. A plain lead would bring all changes of one object into one task.
    Here it runs inside an object's minute; the last change of a minute takes the first value of the
    next minute of that day, or of the object's next day, found among one summary row per minute and
    one per day. So no window holds more than a minute's rows, a day's minutes or an object's days.
    """
    fine, coarse = spans
    usable = changes.filter(F.col("change_date").isNotNull() & not_empty("value"))
    cut = usable.withColumn("_span", F.date_trunc(fine, "change_date"))
    inside = cut.withColumn("_after", F.lead("value").over(
        Window.partitionBy(*keys, "_span").orderBy("change_date", "value")))
    starts = cut.groupBy(*keys, "_span").agg(
        F.min(F.struct("change_date", "value"))["value"].alias("_first"))
    starts = starts.withColumn("_block", F.date_trunc(coarse, "_span"))
    blocks = starts.groupBy(*keys, "_block").agg(
        F.min(F.struct("_span", "_first"))["_first"].alias("_first"))
    blocks = blocks.select(*keys, "_block", F.lead("_first").over(
        Window.partitionBy(*keys).orderBy("_block")).alias("_next_block"))
    starts = starts.withColumn("_next", F.lead("_first").over(
        Window.partitionBy(*keys, "_block").orderBy("_span")))
    carried = starts.join(blocks, [*keys, "_block"]).select(
        *keys, "_span", F.coalesce("_next", "_next_block").alias("_carried"))
    return (inside.join(carried, [*keys, "_span"])
            .withColumn("new_value", F.coalesce("_after", "_carried"))
            .withColumnRenamed("value", "old_value").drop("_span", "_after", "_carried"))


def filter_history(history: DataFrame, object_type: str | None = None,
                   property_name: str | None = None, object_id: str | None = None) -> DataFrame:
    """History of one object type, property or object; type and property prune partitions."""
    wanted = {"object_type": object_type, "property_name": property_name, "object_id": object_id}
    tests: list[Column] = [F.col(c) == v for c, v in wanted.items() if v is not None]
    return history.filter(reduce(lambda a, b: a & b, tests)) if tests else history


def order_history(history: DataFrame) -> DataFrame:
    """Each object's history together and by change date; further columns settle equal dates.

    The order holds inside an object, which is what readers of a history need; objects are ranges of
    partitions, so a hot object is split and no row order is forced on the whole table.
    """
    order = ["object_type", "object_id", "property_name", "change_date", "old_value"]
    return history.repartitionByRange(*order).sortWithinPartitions(*order)
