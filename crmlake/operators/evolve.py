"""Schema changes and row removal, as DataFrame transformations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def add_column_if_missing(df: DataFrame, name: str, kind: str) -> DataFrame:
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(kind))


def swap_columns(df: DataFrame, a: str, b: str) -> DataFrame:
    """Exchange the contents of two columns: their names are exchanged, no data moves."""
    other = {a: b, b: a}
    return df.select(*[F.col(other.get(c, c)).alias(c) for c in df.columns])


def delete(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    """The rows whose key is not listed."""
    on = [on] if isinstance(on, str) else list(on)
    return df.join(keys.select(*on).distinct(), on, "left_anti")


def cascade_delete(activities: DataFrame, details: dict[str, DataFrame], keys: DataFrame,
                   edges: DataFrame | None = None):
    """Delete activities by source id: details go with them, edges stay without the activity id.

    Returns (activities, details, edges).
    """
    gone = activities.join(keys.select("source_id").distinct(), "source_id", "left_semi").select(
        F.col("id").alias("activity_id"))
    left = delete(activities, keys, "source_id")
    kept = {kind: d.join(gone, "activity_id", "left_anti") for kind, d in details.items()}
    if edges is None:
        return left, kept, None
    return left, kept, set_null_where_gone(edges, "activity_id", gone, "activity_id")


def set_null_where_gone(edges: DataFrame, fk: str, gone: DataFrame, pk: str) -> DataFrame:
    """Edges keep their row; the reference to a removed parent becomes null."""
    lost = gone.select(F.col(pk).alias("_gone")).distinct()
    joined = edges.join(lost, F.col(fk) == F.col("_gone"), "left")
    return joined.withColumn(fk, F.when(F.col("_gone").isNull(), F.col(fk))).drop("_gone")
