"""Keep-first, keep-last, samples and first matches, without a window.

A window would sort every copy of a key in one task. These are aggregates, so copies are
combined inside each map task and one row per key and task is shuffled, however hot the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _pick(df: DataFrame, keys: list[str], order: list[str], largest: bool) -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c not in order]
    # the remaining columns break ties, so the choice does not depend on arrival order
    row = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest])
    chosen = (F.max if largest else F.min)(row).alias("_row")
    picked = df.groupBy(*keys).agg(chosen)
    return picked.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c)
                           for c in df.columns])


def keep_last(df: DataFrame, keys: list[str], seq: str | list[str]) -> DataFrame:
    """One row per key: the one with the highest ``seq``."""
    return _pick(df, list(keys), [seq] if isinstance(seq, str) else list(seq), True)


def keep_first(df: DataFrame, keys: list[str], seq: str | list[str]) -> DataFrame:
    """One row per key: the one with the lowest ``seq``."""
    return _pick(df, list(keys), [seq] if isinstance(seq, str) else list(seq), False)


def sample_ids(df: DataFrame, n: int = 5, key: str = "source_id") -> DataFrame:
    """The first n ids, as a probe."""
    return df.select(key).orderBy(key).limit(n)


def first_match(df: DataFrame, predicate: Column) -> DataFrame:
    """One matching row or none."""
    return df.filter(predicate).limit(1)


def exists(df: DataFrame, predicate: Column) -> bool:
    return not df.filter(predicate).isEmpty()


def count_rows(df: DataFrame, predicate: Column | None = None) -> DataFrame:
    """One row: all rows and those that match."""
    wanted = F.lit(True) if predicate is None else predicate
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(wanted).alias("matching"))
