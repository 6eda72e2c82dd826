"""Shuffled rows are read in tasks of a few MB, and batches are searched for odd values only where one may be."""

from pyspark.sql import functions as F

from crmlake.operators import edges as E
from crmlake.session import configure


def test_shuffled_rows_are_cut_into_small_tasks(spark):
    given = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    before = {name: spark.conf.get(name) for name in given}
    try:
        for name, value in given.items():
            spark.conf.set(name, value)
        digest = [F.unhex(F.sha2(F.concat("id", F.lit(f"-{k}")), 512)).alias(f"d{k}") for k in range(4)]
        rows = configure(spark).range(0, 160_000, 1, 8).select("id", *digest)  # 41 MB that cannot be packed
        tasks = rows.repartition("id").groupBy(F.spark_partition_id()).agg(
            F.count("*").alias("count"), *[F.max(f"d{k}") for k in range(4)]).collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sum(r["count"] for r in tasks) == 160_000
    assert len(tasks) >= 3


def test_batches_of_whole_numbers_are_not_searched(spark):
    """The text of a batch is searched after an id read from it left doubt, not before."""
    edges = E.contact_company_edges(spark.createDataFrame([("{}",)], "page string"))
    text = next(line for line in edges._jdf.queryExecution().optimizedPlan().toString().splitlines() if "posexplode(CASE WHEN" in line)
    assert 0 <= text.find("exists(") < text.find("toObjectId[")


def test_the_last_type_is_found_where_the_last_entry_gives_none(spark, pages):
    to = [{"toObjectId": 7, "associationTypes": [{"associationTypeId": 3, "category": "USER"}, {"typeId": 4}, {"label": "x"}]},
          {"toObjectId": 8, "associationTypes": [{"associationTypeId": 3, "category": "A"}, {"typeId": 5, "category": "B"}]},
          {"toObjectId": 9, "associationTypes": []}]
    edges = E.object_edges(pages({"results": [{"from": {"id": 1}, "to": to}]}), "deal", "ticket")
    assert [(r[0], r[1], r[2]) for r in edges.orderBy("pos").select("target_object_id", "association_type_id", "association_category").collect()] == [
        ("7", 4, "USER"), ("8", 5, "B"), ("9", None, None)]
