"""Data-quality rules: as violation tables, and as what a row of a snapshot breaks before it is merged.

The caller decides whether to fail or set rows aside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from crmlake.model.tables import KEYS, UNIQUE, lengths, required
from crmlake.operators.ordered import keep_last


def check_unique(df: DataFrame, keys, where: Column | None = None) -> DataFrame:
    """Keys that occur more than once, with their count. Counts combine before the shuffle."""
    rows = df if where is None else df.filter(where)
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def _long(df: DataFrame, tests: dict[str, Column], key: str) -> DataFrame:
    """One row per key and failed test, from a single pass over the rows."""
    found = F.filter(F.array(*[F.when(t, F.lit(name)) for name, t in tests.items()]),
                     lambda x: x.isNotNull())
    return df.select(F.col(key).alias("key"), F.explode(found).alias("column_name"))


def check_required(df: DataFrame, cols, key: str = "source_id") -> DataFrame:
    """Null required columns: key, column_name."""
    return _long(df, {c: F.col(c).isNull() for c in cols}, key)


def check_lengths(df: DataFrame, limits: dict[str, int], key: str = "source_id") -> DataFrame:
    """Strings over their maximum length: key, column_name."""
    return _long(df, {c: F.length(c) > n for c, n in limits.items()}, key)


def check_references(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose reference is set but not found."""
    keys = parent.select(F.col(pk).alias("_pk"))
    return child.filter(F.col(fk).isNotNull()).join(keys, F.col(fk) == F.col("_pk"), "left_anti")


def check_table(df: DataFrame, table: str, key: str = "source_id") -> DataFrame:
    """Required and length violations of a known table: rule, key, column_name."""
    empty = check_required(df, [c for c in required(table) if c in df.columns], key)
    long = check_lengths(df, {c: n for c, n in lengths(table).items() if c in df.columns}, key)
    return empty.select(F.lit("required").alias("rule"), "*").unionByName(
        long.select(F.lit("length").alias("rule"), "*"))


def broken_rules(df: DataFrame, table: str, made: tuple[str, ...] = ("id", "etl_date")) -> Column:
    """The required and length rules that a row breaks, as an array of texts; empty where it breaks none.

    Columns the frame does not have are not looked at, nor those in ``made``, which the write fills in.
    """
    needed = [c for c in required(table) if c in df.columns and c not in made]
    tests = {f"required: {c}": F.col(c).isNull() for c in needed}
    tests |= {f"length: {c}": F.length(c) > n for c, n in lengths(table).items() if c in df.columns}
    return F.filter(F.array(*[F.when(t, F.lit(name)) for name, t in tests.items()]), lambda x: x.isNotNull())


def taken_values(incoming: DataFrame, stored: DataFrame, table: str, column: str, order: list[str]) -> DataFrame:
    """Keys of incoming rows that may not have their value of a unique column.

    A value stays with the stored row that has it; of incoming rows it goes to the one with the smallest
    key. So values are unique after the merge whatever the refused rows had before.

    Values that two keys hold are found by one aggregate of a few fields a value, combined before the
    shuffle; only rows with such a value are then joined, on a side with one row a value.
    """
    key, = KEYS[table]
    new = keep_last(incoming.select(key, column, *order), [key], order).select(
        F.col(key).alias("key"), F.col(column).alias("value"), F.lit(1).alias("fresh"))
    old = stored.select(F.col(key).alias("key"), F.col(column).alias("value"), F.lit(0).alias("fresh"))
    owner = (new.unionByName(old).filter(F.col("value").isNotNull()).groupBy("value")
             .agg(F.min(F.struct("fresh", "key")).alias("first"), F.min("key").alias("one"), F.max("key").alias("two"))
             .filter("one <> two").select("value", F.col("first.key").alias("owner")))
    return new.join(owner, "value").filter("key <> owner").select(F.col("key").alias(key))


def with_broken_rules(incoming: DataFrame, stored: DataFrame, table: str, order: list[str], column: str = "broken_rules",
                      kept=lambda keys, name: keys) -> DataFrame:
    """Rows for a merge into ``stored`` with every rule of the table they break: required columns, maximum
    lengths and unique values. A row that breaks a rule of its own does not compete for a unique value.
    Refused keys, few where rules mostly hold, are given to ``kept``, which may stage them."""
    rows = incoming.withColumn(column, broken_rules(incoming, table))
    for unique in UNIQUE.get(table, ()):
        if unique not in incoming.columns:
            continue
        key, = KEYS[table]
        lost = taken_values(rows.filter(F.size(column) == 0), stored, table, unique, order)
        lost = kept(lost, f"refused-{table}").select(F.col(key).alias("_lost"))
        rows = rows.join(lost, F.col(key) == F.col("_lost"), "left").withColumn(column, F.when(
            F.col("_lost").isNotNull(), F.array_append(column, F.lit(f"unique: {unique}"))).otherwise(F.col(column))).drop("_lost")
    return rows


def with_broken_references(rows: DataFrame, references: dict[str, DataFrame], column: str = "broken_rules") -> DataFrame:
    """Adds the references, as column to parent table, that are set and whose row is not there."""
    for child, parent in references.items():
        keys = parent.select(F.col("id").alias("_found"))
        rows = rows.join(keys, F.col(child) == F.col("_found"), "left").withColumn(column, F.when(
            F.col(child).isNotNull() & F.col("_found").isNull(), F.array_append(column, F.lit(f"reference: {child}")))
            .otherwise(F.col(column))).drop("_found")
    return rows


def edge_diagnostics(**sources: DataFrame) -> DataFrame:
    """Edge counts per method, with a flag for methods that gave none: method, edges, found_none."""
    counted = None
    for method, edges in sources.items():
        one = edges.agg(F.lit(method).alias("method"), F.count(F.lit(1)).alias("edges"))
        counted = one if counted is None else counted.unionByName(one)
    return counted.withColumn("found_none", F.col("edges") == 0)
