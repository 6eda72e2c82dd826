"""Stored tables: versioned parquet folders below one root.

``root/<table>/v=<n>`` holds one complete version. A reader takes the highest version whose write
was committed, so a run that dies half way leaves the last good version in place, and a merge can
read the table it is about to replace.

Where the business key tells the partition (edges, history, timeline), a merge concerns only the partitions
that its rows are in. :meth:`Tables.replace` puts those in place of the stored ones and leaves all other
files alone.

The files of the other tables lie in batches: a merge writes one, an append adds one of its own beside it,
so that what an append writes does not depend on the table, and an append that is run again replaces itself.
Ids and keys have Bloom filters in the files, so a lookup skips row groups that do not hold its value.
"""

from __future__ import annotations

import re
import uuid
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from crmlake.model.tables import KEYS, PARTITIONS, TABLES, columns, schema
from crmlake.operators.merge import absent_table, empty_table, to_table


def shared_folder(spark: SparkSession) -> str:
    """A folder that all executors reach: spark.checkpoint.dir, else the warehouse."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")


@contextmanager
def shuffles_end_with_queries(spark: SparkSession):
    """Shuffle files go when the query that wrote them ends.

    Spark keeps them until the driver collects garbage, which a run of many large writes and small plans hardly
    causes, so those of all its steps would lie on disk together. A frame that is collected twice meanwhile makes
    its shuffles again; steps write theirs once.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def together(df: DataFrame, table: str) -> DataFrame:
    """Rows of a partition value together, so that a task opens files of few values; values with many
    rows are split by adaptive execution."""
    return df.hint("rebalance", *PARTITIONS[table]) if table in PARTITIONS else df


def _lies_in(table: str, values: list[tuple]) -> Column:
    """Whether a row is in one of these partitions; Spark prunes the others' files."""
    each = [reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(PARTITIONS[table], one)])
            for one in values]
    return reduce(lambda a, b: a | b, each, F.lit(False))


def _with_filters(writer, table: str):
    """The surrogate id and the first key column can be looked up; filters follow the values of a
    row group, from 64 KB to 1 MB. Files are compressed by zstd, which takes less room than Spark's default."""
    writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true").option("compression", "zstd")
    for column in {"id", KEYS[table][0]} & set(columns(table)) - set(PARTITIONS.get(table, ())):
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    return writer


#: Rows that lie in so few partitions are written by the tasks they are in: each opens so many files at most.
FEW_PARTITIONS = 4

#: The batch that a write or merge of a whole table leaves.
WHOLE = "whole"

#: A snapshot that lies in more partitions than this is merged with the whole table.
MOST_PARTITIONS = 1000


class Tables:
    """Reads and writes the known tables below a root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._written: list[str] = []
        self._staged: list[str] = []

    def _folder(self, path: str):
        jvm = self.spark._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def _versions(self, table: str, committed: bool) -> list[int]:
        fs, where = self._folder(f"{self.root}/{table}")
        if not fs.exists(where):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(where)]
        found = sorted(int(n[2:]) for n in names if n.startswith("v="))
        if not committed:
            return found
        done = lambda v: fs.exists(self._folder(f"{self.root}/{table}/v={v}/_SUCCESS")[1])
        return [v for v in found if done(v)]

    def exists(self, table: str) -> bool:
        return bool(self._versions(table, committed=True))

    def read(self, table: str, within: list[tuple] | None = None, without: list[tuple] | None = None) -> DataFrame:
        """The current version; an empty table where there is none yet.

        ``within`` and ``without`` are partition values; only files of those, or of all others, are read.
        """
        versions = self._versions(table, committed=True)
        if not versions:
            return absent_table(self.spark, table)
        stored = self.spark.read.schema(schema(table)).parquet(f"{self.root}/{table}/v={versions[-1]}")
        stored = stored.drop("batch")
        if within is not None:
            stored = stored.filter(_lies_in(table, within))
        return stored if without is None else stored.filter(~_lies_in(table, without))

    def partitions_of(self, df: DataFrame, table: str) -> list[tuple] | None:
        """The partition values that rows of a table are in; None where they are too many to list."""
        found = df.select(*PARTITIONS[table]).distinct().limit(MOST_PARTITIONS + 1).collect()
        return None if len(found) > MOST_PARTITIONS else sorted((tuple(r) for r in found), key=str)

    def replace(self, df: DataFrame, table: str, spread: bool = True) -> None:
        """Write rows in place of the partitions they are in. Spark stages the new files and moves them
        when all are written, so the rows may be made of the partitions they replace."""
        versions = self._versions(table, committed=True)
        if not versions:
            self.write(df, table, spread)
            return
        (self._writer(df, table, WHOLE, spread).mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .parquet(f"{self.root}/{table}/v={versions[-1]}"))

    def write(self, df: DataFrame, table: str, spread: bool = True) -> DataFrame:
        """Write a new version in one distributed job and return it as read back.

        Rows of a partition are brought together first, unless the caller says not to ``spread`` them: tasks hold
        rows of few partitions anyway. That saves a shuffle of the whole table.
        """
        version = max(self._versions(table, committed=False), default=0) + 1
        path = f"{self.root}/{table}/v={version}"
        self._written.append(path)
        self._writer(df, table, WHOLE, spread).mode("errorifexists").parquet(path)
        return self.read(table)

    @staticmethod
    def _writer(df: DataFrame, table: str, batch: str, spread: bool = True):
        rows = to_table(df, table)
        if spread:
            rows = together(rows, table)
        if table not in PARTITIONS:
            rows = rows.withColumn("batch", F.lit(batch))
        return _with_filters(rows.write.partitionBy(*PARTITIONS.get(table, ("batch",))), table)

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """Write an intermediate result below the root and return it as read back.

        What several outputs are built from is computed once, and its lineage ends here.
        """
        path = f"{self.root}/_staged/{name}-{uuid.uuid4().hex}"
        self._staged.append(path)
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop_staged(self) -> None:
        """Remove the intermediate results of this object; nothing may read them any more."""
        for path in self._staged:
            fs, where = self._folder(path)
            fs.delete(where, True)
        self._staged = []

    def begin(self) -> None:
        """Versions written from here on belong to one group, see :meth:`roll_back`."""
        self._written = []

    def roll_back(self) -> None:
        """Remove the versions written since :meth:`begin`; readers see the ones before again."""
        for path in self._written:
            fs, where = self._folder(path)
            fs.delete(where, True)
        self._written = []

    def remove(self) -> None:
        """Remove all tables and everything else below the root."""
        fs, where = self._folder(self.root)
        fs.delete(where, True)

    def prune(self, table: str, keep: int = 2) -> None:
        """Remove all but the last ``keep`` committed versions."""
        for version in self._versions(table, committed=True)[:-keep]:
            fs, where = self._folder(f"{self.root}/{table}/v={version}")
            fs.delete(where, True)

    def append(self, df: DataFrame, table: str, batch: str | None = None) -> DataFrame:
        """Add rows. They become a batch of files beside the stored ones, which are not read or written; the
        same ``batch`` appended again replaces what it wrote before. A write that breaks off is never read,
        and :meth:`roll_back` takes it back like any other. The next write of the whole table joins them.

        Of a partitioned table, the partitions that the rows are in are written anew with them.
        """
        versions = self._versions(table, committed=True)
        if table in PARTITIONS:
            rows = self.stage(to_table(df, table), f"append-{table}")
            self.replace(self.read(table, self.partitions_of(rows, table)).unionByName(rows), table)
            return self.read(table)
        batch = batch or uuid.uuid4().hex
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch) or batch == WHOLE:
            raise ValueError(f"not a name for a batch: {batch!r}")
        version = versions[-1] if versions else max(self._versions(table, committed=False), default=0) + 1
        path = f"{self.root}/{table}/v={version}"
        self._written.append(f"{path}/batch={batch}" if versions else path)
        writer = self._writer(df, table, batch)
        if versions:  # a version is there: its other batches stay
            writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.parquet(path)
        return self.read(table)

    def find(self, table: str, predicate: Column) -> DataFrame:
        """Filtered scan; the predicate is pushed to the parquet reader."""
        return self.read(table).filter(predicate)

    def get(self, table: str, row_id: int) -> DataFrame:
        """Point lookup by surrogate id: one row or none. Row groups are skipped by their Bloom filters."""
        return self.find(table, F.col("id") == row_id).limit(1)

    def ensure(self, *tables: str) -> list[str]:
        """Create the missing ones of these tables (default: all), empty. Returns what was made."""
        missing = [t for t in (tables or TABLES) if not self.exists(t)]
        for table in missing:
            self.write(empty_table(self.spark, table), table)
        return missing

    def recreate(self, *tables: str) -> None:
        """A fresh empty version of these tables (default: all). Older versions stay on disk."""
        for table in tables or TABLES:
            self.write(empty_table(self.spark, table), table)


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return Tables(spark, root).read(name)


def append(df: DataFrame, root: str, table: str) -> DataFrame:
    return Tables(df.sparkSession, root).append(df, table)


def write_table(df: DataFrame, root: str, table: str) -> DataFrame:
    return Tables(df.sparkSession, root).write(df, table)


def ensure_tables(spark: SparkSession, root: str, *tables: str) -> list[str]:
    return Tables(spark, root).ensure(*tables)


def recreate_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    store = Tables(spark, root)
    store.recreate(table)
    return store.read(table)
