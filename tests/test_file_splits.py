"""Small compressed files hold much work, so they are read by several tasks."""

from pyspark.sql import functions as F


def test_a_small_file_of_many_row_groups_goes_to_all_cores(spark, tmp_path):
    rows = spark.range(30_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    rows.coalesce(1).write.option("parquet.block.size", 128 * 1024).parquet(f"{tmp_path}/t")
    read = spark.read.parquet(f"{tmp_path}/t")
    by_task = read.groupBy(F.spark_partition_id()).count().collect()
    assert len(by_task) >= 3
    assert sum(r["count"] for r in by_task) == 30_000
    assert read.distinct().count() == 30_000
