"""Reading, checkpoints and digests that several operators share."""

from __future__ import annotations

import gc
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from crmlake.session import configure

#: Rows of an Arrow batch; texts can be long, so batches are short.
ROWS_PER_BATCH = 256


def session(spark: SparkSession) -> SparkSession:
    """The session with the library's settings, small Arrow batches and a checkpoint folder.

    The folder is the one the cluster names in ``spark.checkpoint.dir``; only where none is named,
    as in tests, a temporary one is made.
    """
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    # what is broadcast passes through the driver, and iterated joins do so again and again
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "1MB")
    # rows are texts and vectors here, not payloads, and Python is started per task: Spark's own size
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64MB")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = context.getConf().get("spark.checkpoint.dir", None)
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints-"))
    return spark


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of what was checkpointed since.

    It does so when the driver collects garbage, which an iterated job of small plans hardly causes;
    ``spark.cleaner.periodicGC.interval`` has the same purpose, by the clock.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(session(spark), sf_dir, "documents")


def with_text(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Id as long and text as string under fixed names; a null text is empty."""
    return docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")).alias("text"))


def crc_mod(column: str, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``: the fold of a row."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % by


def temporary(*names: str, avoid: list[str]) -> list[str]:
    """Column names for intermediate use that clash with none of ``avoid``."""
    taken = {a.lower() for a in avoid}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def public_file(name: str) -> str:
    """Where a public vocabulary file is; the package is on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)
