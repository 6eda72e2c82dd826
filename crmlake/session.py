"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # timestamps without a zone are UTC
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # hot keys of a join are split at run time, also where that costs one more shuffle
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # no broadcast on an estimate: only sides counted beforehand or measured after their shuffle
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    # what a task makes of the shuffled rows it reads (payloads, their parsing, events) costs far more than reading
    # them, so tasks are cut small: with 64 MB, a GB of them leaves most cores idle in the last of two rounds
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB",
    # a payload is many times its compressed row and dear to read, so files of a few MB go to all cores too;
    # by default a task takes 4 MB at least
    "spark.sql.files.openCostInBytes": "256KB",
}

# Settings that can only be given when a session is made.
AT_START = {
    # checkpoints are removed when nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # recording a call site per column expression about doubles the time to state a plan
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def builder(app: str = "crmlake") -> SparkSession.Builder:
    """A session builder with all settings; add master and resources where they are not given."""
    made = SparkSession.builder.appName(app)
    for key, value in (SETTINGS | AT_START).items():
        made = made.config(key, value)
    return made


def configure(spark: SparkSession) -> SparkSession:
    """Put the settings on a session that already runs."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
