"""What a run leaves on local disk and what it moves."""

import time

from pyspark.sql import functions as F

from crmlake.plans import loads as LD
from crmlake.sources.tables import Tables


def shuffle_files(spark) -> set:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    found = (files.apply(i).getName() for i in range(files.size()))
    return {name for name in found if name.startswith("shuffle_")}


def contacts(spark, n):
    return spark.range(n).select(F.format_string('{"id": "%d", "properties": {"firstname": "n%d"}}', "id", "id").alias("raw"),
                                 F.col("id").cast("string").alias("seq"))


def test_a_run_leaves_no_shuffle_files(spark, tmp_path):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, files = spark.conf.get(name, None), shuffle_files(spark)
    ctx = LD.Context(spark, LD.Landed(objects={"contacts": contacts(spark, 50)}), "2024-01-15", tables=Tables(spark, str(tmp_path)))
    LD.run_full(ctx)
    for _ in range(50):  # they are removed in the background
        left = shuffle_files(spark) - files
        if not left:
            break
        time.sleep(0.2)
    assert sorted(left) == []
    assert spark.conf.get(name, None) == before
    assert ctx.tables.read("contacts").count() == 50


def _stored(spark, activity_type):
    """Tickets and changes that repeat a key, and an activity of some type with the id, day and contact of a ticket."""
    from crmlake.operators.merge import empty_table, to_table
    made = {
        "tickets": "select * from values ('t1', 'one', 'a'), ('t1', 'two', 'b'), ('T1', 'three', 'c') as t(source_id, ticket_name, ticket_owner)",
        "object_associations": "select * from values ('contact', 'c1', 'ticket', 't1'), ('ticket', 'T1', 'contact', 'c1'), ('contact', 'c2', 'ticket', 't1') "
                               "as t(source_object_type, source_object_id, target_object_type, target_object_id)",
        "property_histories": "select 'ticket' as object_type, 'hs_pipeline_stage' as property_name, * from values ('t1', 'a', 'b'), ('T1', 'b', 'c'), "
                              "('t1', 'a', 'b') as t(object_id, old_value, new_value)",
        "activities": f"select 't1' as source_id, 1L as id, '{activity_type}' as activity_type, 'zzz' as subject",
        "activity_associations": "select 't1' as activity_source_id, 'contact' as associated_object_type, 'c1' as associated_object_id"}
    day = {"tickets": "created_at", "property_histories": "change_date", "activities": "activity_date"}
    tables = {n: to_table(spark.sql(sql).withColumn(day.get(n, "etl_date"), F.lit("2024-01-02").cast("timestamp")), n) for n, sql in made.items()}
    return tables | {t: empty_table(spark, t) for t in LD.DETAIL_TABLES.values()}


def _rows(df):
    return sorted(map(str, df.collect()))


def test_a_timeline_chooses_among_repeated_keys_as_a_merge_of_all_events(spark):
    from crmlake.plans import timeline as TL
    for kind, apart in (("Call", True), ("Ticket", False)):
        ctx = LD.Context(spark, LD.Landed(), "2024-01-15", stored=_stored(spark, kind))
        assert TL.tickets_stand_apart(ctx.read("activities")) == apart
        everything = TL.timeline(LD.timeline_families(ctx), ctx.read("contact_activity_timelines"), "2024-01-15")
        assert _rows(LD.build_timeline(ctx)) == _rows(everything)
        assert everything.count() == (9 if apart else 8)  # tickets t1 and T1, each created and changed, for two contacts


def test_events_of_tickets_are_not_shuffled_for_every_contact(spark):
    ctx = LD.Context(spark, LD.Landed(), "2024-01-15", stored=_stored(spark, "Call"))
    plan = LD.build_timeline(ctx)._jdf.queryExecution().optimizedPlan().toString()  # the table is not there yet
    above = plan[:plan.index("Union")]  # of the plan, what all events go through
    assert "Aggregate" not in above and "Join" not in above


def _edge_pages(spark, *pairs):
    rows = [(f'{{"results": [{{"from": {{"id": "{a}"}}, "to": [{{"toObjectId": "{b}"}}]}}]}}',) for a, b in pairs]
    return spark.createDataFrame(rows, "page string")


def test_rows_of_few_partitions_are_written_without_one_more_shuffle(spark, tmp_path, monkeypatch):
    from crmlake.operators.merge import KEPT
    from crmlake.sources import tables as ST
    spread = []
    monkeypatch.setattr(ST, "together", lambda rows, table, real=ST.together: spread.append(table) or real(rows, table))
    store = Tables(spark, str(tmp_path))
    pages = {("contact", "ticket"): _edge_pages(spark, ("c1", "t1"), ("c1", "t1"), ("c2", "t1")), ("deal", "ticket"): _edge_pages(spark, ("d1", "t1"))}

    def load(*pairs):
        ctx = LD.Context(spark, LD.Landed(associations={p: pages[p] for p in pairs}), "2024-01-15", tables=store)
        return LD._save(ctx, "object_associations", LD.load_object_edges(ctx))

    assert load(*pages)["inserted"] == 3
    assert load(("deal", "ticket")) == {"inserted": 0, "updated": 1, KEPT: 2}
    assert spread == []
    ends = store.read("object_associations").select("source_object_type", "source_object_id", "target_object_id")
    assert _rows(ends) == _rows(spark.sql("select * from values ('contact', 'c1', 't1'), ('contact', 'c2', 't1'), ('deal', 'd1', 't1') "
                                          "as t(source_object_type, source_object_id, target_object_id)"))
    store.write(store.read("object_associations"), "object_associations")
    assert spread == ["object_associations"]


def test_a_surrogate_id_does_not_depend_on_when_it_is_made(spark):
    from crmlake.operators.merge import absent_table, surrogate_id, upsert
    rows = spark.sql("select 'c1' as contact_source_id, 'e' as event_type, timestamp '2024-01-02' as event_date, 'x' as related_object_id, d as description "
                     "from values ('a'), ('b') as t(d)")
    known = rows.withColumn("id", surrogate_id(["contact_source_id", "event_type", "event_date", "related_object_id"]))
    table = "contact_activity_timelines"
    merged = [_rows(upsert(table, absent_table(spark, table), r, "2024-01-15")) for r in (rows, known)]
    assert merged[0] == merged[1] and len(merged[0]) == 1
