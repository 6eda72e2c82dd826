"""Registry of the queries and, beside each, the SQL that states its expected result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from crmlake.session import configure
from crmlake.sources.tables import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Types that compare alike in both engines: text times, bigint, double, JSON for nested."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind.startswith("timestamp"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif kind in ("int", "smallint", "tinyint"):
            c = c.cast("bigint")
        elif kind.startswith("decimal"):
            c = c.cast("double")
        elif kind.startswith(("array", "map", "struct")):
            c = F.to_json(c)
        out.append(c.alias(name))
    return df.select(*out)


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(build(configure(spark), sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return build

    return register


def kept(spark: SparkSession, df: DataFrame) -> DataFrame:
    """The rows written below the shared folder, once, and read from there."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_folder(spark)}/checkpoints")
    return df.checkpoint()


def ts(expression: str) -> str:
    """DuckDB text of a timestamp, as :func:`plain` writes it."""
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S.%f')"
